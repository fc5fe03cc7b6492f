"""Fixed-width record layouts and their rendering."""

from slotline.layouts.model import Layout, Slot
from slotline.layouts.records import CLAIM_HEADER, CLAIM_LINE, FILE_HEADER, FILE_TRAILER, LAYOUTS

__all__ = ["CLAIM_HEADER", "CLAIM_LINE", "FILE_HEADER", "FILE_TRAILER", "LAYOUTS", "Layout", "Slot"]
