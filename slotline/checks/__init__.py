"""Checks of layouts, documents and produced records."""
