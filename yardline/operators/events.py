"""Event lines to columns; the same for landed files and for streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yardline.names import DOMAIN, Names
from yardline.tables import event_schema

CORRUPT = "_corrupt_record"


def parsed(line: Column, names: Names = DOMAIN) -> Column:
    schema = T.StructType(
        [*event_schema(names).fields, T.StructField(CORRUPT, T.StringType())]
    )
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return F.from_json(line, schema, options)


def filled_lines(lines: DataFrame) -> DataFrame:
    return lines.filter(F.length(F.trim("value")) > 0)


def parse_lines(lines: DataFrame, names: Names = DOMAIN) -> DataFrame:
    """Event fields as text plus ``_corrupt_record``, beside any other column.

    The fields come out of a generator, below which no later filter is moved, so each
    line is parsed once however many of its fields are filtered on.
    """
    other = [c for c in lines.columns if c != "value"]
    return filled_lines(lines).select(*other, F.inline(F.array(parsed(F.col("value"), names))))


def valid_events(lines: DataFrame, names: Names = DOMAIN) -> DataFrame:
    """As ``parse_lines``, without the lines that are no JSON event."""
    other = [c for c in lines.columns if c != "value"]
    every = F.array(parsed(F.col("value"), names))
    good = F.filter(every, lambda event: event[CORRUPT].isNull())
    return filled_lines(lines).select(*other, F.inline(good)).drop(CORRUPT)


def malformed_lines(lines: DataFrame, names: Names = DOMAIN) -> DataFrame:
    return filled_lines(lines).filter(parsed(F.col("value"), names)[CORRUPT].isNotNull())
