"""Registered queries with their SQL checks, and the layer runner."""
