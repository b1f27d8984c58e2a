"""Readers, writers and input tables."""
