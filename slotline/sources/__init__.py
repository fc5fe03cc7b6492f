"""Readers for claims, payment responses, parameters and result tables."""

from slotline.sources.claims import (
    claim_keys,
    narrow_claims,
    parsed_claims,
    read_claims,
    read_jdbc,
    read_payments,
    read_staged_claims,
    stage_claims,
)
from slotline.sources.parameters import extract_parameters
from slotline.sources.result_table import parse_result_lines, read_result_table

__all__ = [
    "claim_keys",
    "extract_parameters",
    "narrow_claims",
    "parse_result_lines",
    "parsed_claims",
    "read_claims",
    "read_jdbc",
    "read_payments",
    "read_result_table",
    "read_staged_claims",
    "stage_claims",
]
