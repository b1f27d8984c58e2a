"""Operators for preparing training text and vectors at scale; nothing else in the library imports this package."""
