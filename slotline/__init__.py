"""Fixed-width claim extracts on Spark."""

from slotline.plans.extract import Extract
from slotline.session import build_session
from slotline.sources import extract_parameters, read_claims, read_payments, read_result_table, read_staged_claims, stage_claims

__all__ = [
    "Extract",
    "build_session",
    "extract_parameters",
    "read_claims",
    "read_payments",
    "read_result_table",
    "read_staged_claims",
    "stage_claims",
]
