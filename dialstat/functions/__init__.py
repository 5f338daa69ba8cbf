"""Scalar column functions."""

from dialstat.functions.scalars import (
    MONEY_TYPE,
    POSTCODE_PATTERN,
    extract_pattern,
    money_sum,
    money_text,
    percentage,
    postcode,
    predicate,
)

__all__ = [
    "MONEY_TYPE",
    "POSTCODE_PATTERN",
    "extract_pattern",
    "money_sum",
    "money_text",
    "percentage",
    "postcode",
    "predicate",
]
