"""Parsing and normalisation of text columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Markers the published sheets use for "no value".
NULL_MARKERS = ("-", "--", "...", "")

# Administrative network codes of the microdata.
NETWORKS = {1: "federal", 2: "estadual", 3: "municipal", 4: "privada"}

_SPACE = " \t\n\r\f\x0b"
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def normalise(col: Column, form: str | None) -> Column:
    """``upper``/``lower`` also trim; only spaces are trimmed, as ``trim`` does."""
    if form is None:
        return col
    trimmed = F.trim(col)
    return {"trim": trimmed, "upper": F.upper(trimmed), "lower": F.lower(trimmed)}[form]


def to_type(col: Column, source: T.DataType, target: str) -> Column:
    """Tolerant typing: what does not parse becomes NULL.

    Text holding a decimal number is truncated when an integer is wanted, which
    is how Spark casts text outside ANSI mode.
    """
    plain = col.try_cast(target)
    if target in ("int", "bigint") and isinstance(source, T.StringType):
        whole = F.regexp_replace(F.trim(col), r"^([+-]?\d+)\.\d*$", "$1")
        return F.coalesce(plain, whole.try_cast(target))
    return plain


def blank_to_null(col: Column, markers: Sequence[str] = NULL_MARKERS) -> Column:
    return F.when(~F.btrim(col, F.lit(_SPACE)).isin(*markers), col)


def plain_number(col: Column) -> Column:
    """A number written as text; anything else is NULL."""
    text = F.btrim(col, F.lit(_SPACE))
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def whole_number(col: Column, target: str = "bigint") -> Column:
    """A whole number written as text, exact to the last digit; decimals are cut off."""
    exact = to_type(F.btrim(col, F.lit(_SPACE)), T.StringType(), target)
    return F.coalesce(exact, plain_number(col).try_cast(target))


def parse_number(col: Column) -> Column:
    """As ``plain_number``, with ``>`` markers left out first."""
    return plain_number(F.translate(col, ">", ""))


def strip_marker(col: Column, marker: str = "*", default: str | None = None) -> Column:
    """Remove a footnote marker; ``default`` stands in for a missing code."""
    known = col if default is None else F.coalesce(col, F.lit(default))
    return F.btrim(F.replace(known, F.lit(marker), F.lit("")), F.lit(_SPACE))


def id_prefix(col: Column, length: int) -> Column:
    return F.substring(col.cast("string"), 1, length).try_cast("int")


def code_label(col: Column, labels: Mapping[int, str] = NETWORKS) -> Column:
    """Label of a code; an unknown code gives NULL."""
    pairs = [F.lit(item) for pair in labels.items() for item in pair]
    return F.try_element_at(F.create_map(*pairs), col.try_cast("int"))


def decode_payload(col: Column) -> Column:
    """Base64 payload to one line of text; an undecodable payload is kept as it came."""
    decoded = F.try_to_binary(col, F.lit("base64")).cast("string")
    return F.regexp_replace(F.coalesce(decoded, col), r"[\r\n]+", " ")
