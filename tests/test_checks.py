import pytest

from tests.conftest import rows
from yardline.operators.checks import (
    WARNING,
    AtMost,
    Filled,
    InRange,
    Refers,
    Unique,
    check,
    check_all,
)
from yardline.plans.suite import QualityGateError, gate, gold_suite, silver_suite


def violations(df, rule, parents=None):
    return check(df, [rule], parents).first().violations


def test_unique(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "id long")
    assert violations(df, Unique("t", ("id",))) == 1
    assert violations(spark.range(3), Unique("t", ("id",))) == 0
    nulls = spark.createDataFrame([(None, 1), (None, 1)], "a int, b int")
    assert violations(nulls, Unique("t", ("a", "b"))) == 1


def test_filled(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, None)], "id long, nome string")
    assert violations(df, Filled("t", ("nome",))) == 2
    assert violations(df, Filled("t", ("id", "nome"))) == 2
    assert violations(df, Filled("t", ())) == 0


def test_references(spark):
    child = spark.createDataFrame([(1,), (2,), (99,), (99,), (None,)], "id_uf long")
    parent = spark.createDataFrame([(1,), (2,), (2,)], "uf long")
    assert violations(child, Refers("t", ("id_uf",), "p", ("uf",)), {"p": parent}) == 3
    with pytest.raises(ValueError):
        Refers("t", ("a", "b"), "p", ("a",))


def test_two_column_reference(spark):
    child = spark.createDataFrame([(1, "a"), (1, "b")], "x long, y string")
    parent = spark.createDataFrame([(1, "a"), (2, "b")], "p long, q string")
    assert violations(child, Refers("t", ("x", "y"), "p", ("p", "q")), {"p": parent}) == 1


def test_range(spark):
    df = spark.createDataFrame([(50.0,), (150.0,), (None,), (float("nan"),), (0.0,), (100.0,)], "v double")
    assert violations(df, InRange("t", "v", 0, 100)) == 2


def test_at_most(spark):
    df = spark.createDataFrame([(10, 8), (8, 8), (None, 1), (1, None)], "a long, b long")
    assert violations(df, AtMost("t", "a", "b")) == 1


def test_empty_table_passes(spark):
    df = spark.createDataFrame([], "id long, v double")
    result = check(df, [Unique("u", ("id",)), Filled("f", ("v",)), InRange("r", "v", 0, 1)])
    assert rows(result, "name", "passed", "violations") == [("f", True, 0), ("r", True, 0), ("u", True, 0)]


def test_row_rules_and_first_key_rule_are_one_scan(spark, tmp_path):
    spark.createDataFrame([(1, 5, 2.0), (1, 6, 9.0)], "id long, k long, v double").write.parquet(f"{tmp_path}/x")
    df = spark.read.parquet(f"{tmp_path}/x")
    rules = [Unique("u", ("id",)), Filled("f", ("v",)), InRange("r", "v", 0, 5), AtMost("a", "v", "k")]
    result = check(df, rules)
    assert result._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert rows(result, "name", "violations") == [("a", 1), ("f", 0), ("r", 1), ("u", 1)]
    more = check(df, [*rules, Unique("u2", ("k",))])
    assert rows(more, "name", "violations")[-1] == ("u2", 0)


def test_gate_stops_on_critical_only(spark):
    df = spark.createDataFrame([(1, None), (1, None)], "id long, v double")
    tables = {"t": df}
    warned = check_all([("t", [Unique("u", ("id",), WARNING)])], tables)
    assert [r.passed for r in gate(warned)] == [False]
    failed = check_all([("t", [Unique("u", ("id",)), Filled("f", ("v",)), Filled("ok", ("id",))])], tables)
    with pytest.raises(QualityGateError, match="f, u"):
        gate(failed)
    details = {r["name"]: r.details for r in failed.collect()}
    assert details["f"] == "2 row(s) with a missing value in ['v']"


def test_suite_has_eleven_rules():
    rules = [rule for _, rules in [*silver_suite(), *gold_suite()] for rule in rules]
    assert len(rules) == 11 == len({r.name for r in rules})
    assert {r.severity for r in rules} == {"critical"}
