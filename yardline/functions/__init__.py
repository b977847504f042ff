"""Column expressions shared by the operators. All are built-in Spark expressions."""

from yardline.functions.measures import all_present, gap, met_target, percentage, weighted_mean
from yardline.functions.text import (
    blank_to_null,
    code_label,
    decode_payload,
    id_prefix,
    normalise,
    parse_number,
    plain_number,
    strip_marker,
    to_type,
    whole_number,
)

__all__ = [
    "all_present",
    "blank_to_null",
    "code_label",
    "decode_payload",
    "gap",
    "id_prefix",
    "met_target",
    "normalise",
    "parse_number",
    "percentage",
    "plain_number",
    "strip_marker",
    "to_type",
    "weighted_mean",
    "whole_number",
]
