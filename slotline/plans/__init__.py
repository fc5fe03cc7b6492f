"""Whole extracts put together from the operators."""

from slotline.plans.extract import Extract

__all__ = ["Extract"]
