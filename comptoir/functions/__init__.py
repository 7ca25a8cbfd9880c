"""Column expressions shared by the batch and the streaming jobs."""

from comptoir.functions.columns import (
    blank,
    city_standard,
    identifier,
    joined_labels,
    line_amount,
    missing,
    strict_date,
    total_amount,
    whole_number,
)

__all__ = [
    "blank",
    "city_standard",
    "identifier",
    "joined_labels",
    "line_amount",
    "missing",
    "strict_date",
    "total_amount",
    "whole_number",
]
