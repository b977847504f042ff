"""What must hold at size: no key gathers its rows in one task, scans read what is used."""

import os
import random
from collections import Counter

import pytest
from pyspark.errors import AnalysisException

from tests.conftest import rows
from workload import lake_queries  # noqa: F401  (registers its queries)
from workload import queries as q
from workload import tables as t
from yardline.operators import marts
from yardline.operators.checks import Refers, Unique, check
from yardline.operators.clean import newest_per_key
from yardline.operators.integrate import first_per_event, grain_sums
from yardline.operators.microdata import weighted_sums
from yardline.tables import BATCH_TABLES

DATA = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def skewed(n=6000, keys=500, seed=5):
    """Pairs of which 40 % share key 0."""
    rng = random.Random(seed)
    return [(0 if rng.random() < 0.4 else rng.randrange(1, keys), i) for i in range(n)]


def shuffled_records(spark, df):
    """Rows each exchange of an executed plan wrote, by reading its metrics."""
    df.collect()
    found, queue = [], [df._jdf.queryExecution().executedPlan()]
    while queue:
        node = queue.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            queue.append(node.executedPlan())
            continue
        if name.endswith("QueryStage"):
            queue.append(node.plan())
            continue
        if name == "Exchange":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        queue.extend(children.apply(i) for i in range(children.size()))
    return found


def test_hot_key_is_reduced_before_the_shuffle_in_dedup(spark):
    data = skewed()
    df = spark.createDataFrame(data, "k long, v long").repartition(4).cache()
    result = newest_per_key(df, ["k"], ["v"])
    newest = {}
    for k, v in data:
        newest[k] = max(v, newest.get(k, -1))
    assert dict(rows(result)) == newest
    assert shuffled_records(spark, result)[0] <= 4 * len(newest)
    events = df.selectExpr("if(k = 1, null, k) as event_id", "v")
    nulls = sum(k == 1 for k, _ in data)
    deduplicated = first_per_event(events)
    assert deduplicated.count() == len(newest) - 1 + nulls
    assert shuffled_records(spark, deduplicated)[0] <= 4 * len(newest) + nulls


def test_hot_key_is_reduced_before_the_shuffle_in_checks(spark):
    data = skewed()
    df = spark.createDataFrame(data, "k long, v long").repartition(4).cache()
    parent = spark.createDataFrame([(k,) for k in range(1, 400)], "p long")
    counts = Counter(k for k, _ in data)
    unique = check(df, [Unique("u", ("k",))])
    assert unique.first().violations == sum(n > 1 for n in counts.values())
    orphans = check(df, [Refers("r", ("k",), "p", ("p",))], {"p": parent})
    assert orphans.first().violations == sum(n for k, n in counts.items() if not 1 <= k < 400)
    assert max(shuffled_records(spark, orphans)) <= 4 * len(counts)


def test_hot_key_is_reduced_before_the_shuffle_in_sums(spark):
    data = [(2024, k, "p", v, 1, 1.0) for k, v in skewed()]
    measures = spark.createDataFrame(
        data,
        "ano int, id_municipio long, rede string, qtd_avaliados long, "
        "qtd_alfabetizados long, media_proficiencia double",
    )
    sums = grain_sums(measures.repartition(4).cache())
    assert sum(r.qtd_avaliados for r in sums.collect()) == sum(d[3] for d in data)
    assert shuffled_records(spark, sums)[0] <= 4 * 500
    persons = spark.createDataFrame(skewed(), "entity long, weight long").selectExpr(
        "entity", "weight", "1 as flag", "700 as score"
    )
    weighted = weighted_sums(persons.repartition(4).cache(), ["entity"])
    assert sum(r.n for r in weighted.collect()) == 6000
    assert shuffled_records(spark, weighted)[0] <= 4 * 500


PLANNED = [name for name, function in q.QUERIES.items() if function.__module__ == q.__name__]


@needs_data
@pytest.mark.parametrize("name", PLANNED)
def test_no_query_crosses_or_leaves_the_jvm(spark, name):
    text = plan(q.QUERIES[name](spark, DATA))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython"):
        assert node not in text


@needs_data
def test_scan_reads_only_used_columns(spark):
    text = plan(t.batch(spark, DATA))
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_extendedprice:double,l_returnflag:string>" in text
    checked = plan(q.QUERIES["check_leq"](spark, DATA))
    assert "ReadSchema: struct<l_linenumber:int,l_quantity:double>" in checked


@needs_data
def test_key_filters_reach_the_scan(spark):
    events = t.load(spark, DATA, "events").selectExpr(
        "2024 as year", "user_id as entity_id", "event_type as segment", "event_id as assessed",
        "event_id as reached", "value as mean_score",
    )
    assert "PushedFilters: [IsNotNull(user_id), IsNotNull(event_type)]" in plan(grain_sums(events, t.E))


@needs_data
def test_entity_window_and_totals_reuse_the_join_partitioning(spark):
    """Totals and year-over-year change add no shuffle to the enriched grain."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        enriched = plan(t.integrated(spark, DATA)).count("Exchange hashpartitioning")
        series = plan(t.evolution(spark, DATA)).count("Exchange hashpartitioning")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert series == enriched


def test_every_sql_belongs_to_a_query():
    assert set(q.ORACLES) <= set(q.QUERIES)


def test_entity_targets_are_not_broadcast(spark):
    """Files of targets are far smaller than their rows, so their size must not decide for a broadcast."""
    total = spark.createDataFrame(
        [(2024, k, f"m{k}", "A", 1, "N", "p", 10, 5, 500.0, 50.0) for k in range(20)] + [(2024, None, None, None, None, None, "p", 1, 1, 1.0, 100.0)],
        "ano int, id_municipio long, nome_municipio string, sigla_uf string, id_uf int, nome_regiao string, rede string, "
        "qtd_avaliados long, qtd_alfabetizados long, media_proficiencia double, indicador_pct double",
    )
    targets = spark.createDataFrame([(2024, k, 40.0) for k in range(0, 20, 2)], "ano int, id_municipio long, meta_indicador double")
    for mart in (marts.indicator(total, targets), marts.fact(total, targets)):
        assert "BroadcastHashJoin" not in plan(mart)
        met = {r.id_municipio: r.atingiu_meta for r in mart.collect()}
        assert met == {k: True if k is not None and k % 2 == 0 else None for k in [*range(20), None]}


def test_every_layered_query_runs_all_of_its_stages(spark, monkeypatch):
    runs = []
    monkeypatch.setattr(lake_queries, "_prepared", lambda spark, folder, root, date: root)
    monkeypatch.setattr(lake_queries, "run_stages", runs.append)
    assert lake_queries._layered_run(spark, DATA) != lake_queries._layered_run(spark, DATA)
    assert len(set(runs)) == 2


@needs_data
def test_sources_of_several_dates_are_exported_once(spark, monkeypatch):
    made, ran = [], []
    monkeypatch.setattr(lake_queries, "write_csv", lambda rows, path, columns: made.append(path.rpartition("/")[2]))
    monkeypatch.setattr(lake_queries, "run_stages", lambda run, stages, tables=None: ran.append((run.ingestion_date, tuple(stages))))
    with pytest.raises(AnalysisException):  # nothing was written that could be read
        q.QUERIES["backfill_run"](spark, DATA)
    assert Counter(made) == Counter([f"{name}.csv" for name in BATCH_TABLES] + ["meta_uf.csv"])
    assert [date for date, stages in ran if "silver" in stages] == ["2026-01-01", "2026-01-02", "2026-01-01"]
    made.clear()
    with pytest.raises(AnalysisException):
        q.QUERIES["incremental_silver_run"](spark, DATA)
    assert sorted(made) == sorted(f"{name}.csv" for name in BATCH_TABLES)
