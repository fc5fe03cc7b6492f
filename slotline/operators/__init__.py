"""Operators over claims and payment responses."""
