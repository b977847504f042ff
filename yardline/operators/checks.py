"""Data-quality rules, evaluated with as few passes as the rules allow."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CRITICAL = "critical"
WARNING = "warning"

CHECK_SCHEMA = "name string, passed boolean, severity string, details string, violations bigint"


@dataclass(frozen=True)
class Unique:
    """Counts keys that occur more than once; NULL keys are equal."""

    name: str
    keys: tuple[str, ...]
    severity: str = CRITICAL

    @property
    def what(self) -> str:
        return f"duplicated key(s) in {list(self.keys)}"


@dataclass(frozen=True)
class Filled:
    """Counts rows with NULL in any listed column; no columns means no violations."""

    name: str
    columns: tuple[str, ...]
    severity: str = CRITICAL

    @property
    def what(self) -> str:
        return f"row(s) with a missing value in {list(self.columns)}"

    def violated(self) -> Column:
        return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in self.columns], F.lit(False))


@dataclass(frozen=True)
class InRange:
    """Counts values outside the closed range; NULL passes, NaN does not."""

    name: str
    column: str
    low: float
    high: float
    severity: str = CRITICAL

    @property
    def what(self) -> str:
        return f"value(s) of {self.column} outside [{self.low}, {self.high}]"

    def violated(self) -> Column:
        value = F.col(self.column)
        return value.isNotNull() & ((value < self.low) | (value > self.high))


@dataclass(frozen=True)
class AtMost:
    """Counts rows where one column exceeds another; NULL on either side passes."""

    name: str
    column: str
    limit: str
    severity: str = CRITICAL

    @property
    def what(self) -> str:
        return f"row(s) with {self.column} above {self.limit}"

    def violated(self) -> Column:
        return F.col(self.column) > F.col(self.limit)


@dataclass(frozen=True)
class Refers:
    """Counts rows whose key is not in the parent table; a NULL key is an orphan."""

    name: str
    keys: tuple[str, ...]
    parent: str
    parent_keys: tuple[str, ...]
    severity: str = CRITICAL

    def __post_init__(self) -> None:
        if len(self.keys) != len(self.parent_keys):
            raise ValueError(f"{self.name}: key lists differ in length")

    @property
    def what(self) -> str:
        return f"row(s) without a match in {self.parent}{list(self.parent_keys)}"


Rule = Unique | Filled | InRange | AtMost | Refers


def check(
    df: DataFrame, rules: Sequence[Rule], parents: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """One row per rule: name, passed, severity, details, violations.

    All row rules and the first key rule come from one pass over the table: rows are
    grouped by the key, which also carries the row violations along. Each further key
    rule is one grouping and each reference rule one anti-join of grouped keys, so a
    key holding much of the table shrinks to one row per task before any shuffle.
    """
    row_rules = [r for r in rules if isinstance(r, Filled | InRange | AtMost)]
    key_rules = [r for r in rules if isinstance(r, Unique)]
    references = [r for r in rules if isinstance(r, Refers)]
    parts = []
    if row_rules or key_rules:
        parts.append(_one_pass(df, row_rules, key_rules[:1]))
    parts += [_one_pass(df, [], [rule]) for rule in key_rules[1:]]
    parts += [_orphans(df, rule, (parents or {})[rule.parent]) for rule in references]
    return reduce(DataFrame.unionByName, parts)


def check_all(
    suite: Sequence[tuple[str, Sequence[Rule]]], tables: Mapping[str, DataFrame]
) -> DataFrame:
    """A suite over several tables as one plan, hence one job when collected."""
    return reduce(
        DataFrame.unionByName, [check(tables[name], rules, tables) for name, rules in suite]
    )


def _one_pass(df: DataFrame, row_rules: list, key_rules: list[Unique]) -> DataFrame:
    counts = [F.count_if(r.violated()).alias(f"_v{i}") for i, r in enumerate(row_rules)]
    if key_rules:
        grouped = df.groupBy(*key_rules[0].keys).agg(F.count(F.lit(1)).alias("_n"), *counts)
        counts = [F.sum(f"_v{i}").alias(f"_v{i}") for i in range(len(row_rules))]
        row = grouped.agg(F.count_if(F.col("_n") > 1).alias("_k"), *counts)
    else:
        row = df.agg(*counts)
    results = [_result(r, F.col(f"_v{i}")) for i, r in enumerate(row_rules)]
    results += [_result(r, F.col("_k")) for r in key_rules]
    return row.select(F.inline(F.array(*results)))


def _orphans(child: DataFrame, rule: Refers, parent: DataFrame) -> DataFrame:
    sides = list(enumerate(zip(rule.keys, rule.parent_keys, strict=True)))
    left = child.groupBy(*[F.col(c).alias(f"_k{i}") for i, (c, _) in sides]).agg(
        F.count(F.lit(1)).alias("_n")
    )
    right = parent.select(*[F.col(p).alias(f"_k{i}") for i, (_, p) in sides]).distinct()
    lost = left.join(right, [f"_k{i}" for i, _ in sides], "left_anti")
    return lost.agg(F.sum("_n").alias("_v")).select(F.inline(F.array(_result(rule, F.col("_v")))))


def _result(rule: Rule, violations: Column) -> Column:
    count = F.coalesce(violations, F.lit(0)).cast("bigint")
    return F.struct(
        F.lit(rule.name).alias("name"),
        (count == 0).alias("passed"),
        F.lit(rule.severity).alias("severity"),
        F.concat(count.cast("string"), F.lit(f" {rule.what}")).alias("details"),
        count.alias("violations"),
    )


def grain_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows and distinct keys of a table in one pass; equal numbers mean a unique grain."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("keys")
    )
