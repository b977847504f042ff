from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from yardline.functions import (
    blank_to_null,
    code_label,
    decode_payload,
    gap,
    id_prefix,
    met_target,
    normalise,
    parse_number,
    percentage,
    strip_marker,
    to_type,
    weighted_mean,
)


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [r[0] for r in df.select(expression(F.col("v"))).collect()]


def test_ratios_give_null_on_zero_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    df = spark.createDataFrame([(1, 0), (1, 8), (980, 1200)], "a long, b long")
    assert [r[0] for r in df.select(percentage(F.col("a"), F.col("b"))).collect()] == [None, 12.5, 81.7]
    mean = weighted_mean(F.col("a").cast("double"), F.col("b"))
    assert [r[0] for r in df.select(mean).collect()] == [None, 0.1, 0.8]


def test_target_is_three_valued_and_gap_is_half_up(spark):
    df = spark.createDataFrame([(80.0, 80.0), (79.9, 80.0), (50.0, None)], "a double, b double")
    found = df.select(met_target(F.col("a"), F.col("b")), gap(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in found] == [(True, 0.0), (False, -0.1), (None, None)]
    assert column(spark, [0.25, -0.25], lambda c: gap(c, F.lit(0.0)), "double") == [0.3, -0.3]


def test_bad_text_becomes_null_not_an_error(spark):
    text = T.StringType()
    values = ["7", " 7 ", "2024.0", "7.9", "x", "", None, "99999999999"]
    assert column(spark, values, lambda c: to_type(c, text, "int")) == [
        7, 7, 2024, 7, None, None, None, None,
    ]
    assert column(spark, ["99999999999"], lambda c: to_type(c, text, "bigint")) == [99999999999]
    assert column(spark, ["1.5", "x"], lambda c: to_type(c, text, "double")) == [1.5, None]


def test_normal_forms_trim_spaces_only(spark):
    assert column(spark, [" sp ", "\tsp"], lambda c: normalise(c, "upper")) == ["SP", "\tSP"]
    assert column(spark, [" Publica "], lambda c: normalise(c, "lower")) == ["publica"]
    assert column(spark, [" a "], lambda c: normalise(c, None)) == [" a "]


def test_marked_numbers(spark):
    values = [">80", " 80,5", "80.5 ", "-", "--", "...", "", None, "0", "5d", "NaN", "1e2", "\t7", "-3", "1 0"]
    assert column(spark, values, parse_number) == [
        80.0, None, 80.5, None, None, None, None, None, 0.0, None, None, 100.0, 7.0, -3.0, None,
    ]


def test_null_markers_and_default_code(spark):
    values = ["SP*", " RJ ", None, "-", " ", "..."]
    expected = ["SP", "RJ", "BR", "BR", "BR", "BR"]
    assert column(spark, values, lambda c: strip_marker(blank_to_null(c), default="BR")) == expected


def test_codes_and_prefixes(spark):
    assert column(spark, [1, 4, 5, None], code_label, "int") == ["federal", "privada", None, None]
    assert column(spark, [3550308, 1100015], lambda c: id_prefix(c, 2), "long") == [35, 11]


def test_payload_decoding_keeps_what_it_cannot_decode(spark):
    values = ["eyJhIjoxfQ==", "%%%", "ewogImEiOiAxCn0=", None]
    assert column(spark, values, decode_payload) == ['{"a":1}', "%%%", '{  "a": 1 }', None]


def test_rounding_of_exact_ratios_matches_decimal_half_up(spark):
    from decimal import ROUND_HALF_UP, Decimal

    df = spark.range(1, 401).selectExpr("id as n").selectExpr("n", "explode(sequence(0l, n)) as k")
    found = rows(df.select("n", "k", percentage(F.col("k"), F.col("n")).alias("p")))
    for n, k, p in found:
        exact = (Decimal(100 * k) / Decimal(n)).quantize(Decimal("0.1"), ROUND_HALF_UP)
        assert Decimal(repr(p)) == exact, (n, k, p)
