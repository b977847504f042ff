"""Whitening and the Merkle manifest against plain versions."""

import hashlib
import math
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.llm import corpus
from yardline.llm import merkle, whitening

EMBEDDINGS = "vec_id long, embedding array<float>, label int, x string, n string, component string"


def vectors(count=300, dimension=9):
    rnd = np.random.default_rng(3)
    mixed = rnd.standard_normal((count, dimension)) @ rnd.standard_normal((dimension, dimension)) / 4
    found = [(i, [float(c) for c in v], 0, "a", "b", "c") for i, v in enumerate(mixed.astype(np.float32))]
    found += [found[5], (None, found[7][1], 0, None, None, None), (400, None, 0, "a", "b", "c")]
    found += [(401 + k, [bad] + [0.0] * (dimension - 1), 0, "a", "b", "c") for k, bad in enumerate([None, math.nan, math.inf, -math.inf])]
    found += [(410, [1.0, 2.0], 0, "a", "b", "c"), (411, [], 0, "a", "b", "c"), (412, [-0.0] * dimension, 0, "a", "b", "c")]
    return found


def plain_whitening(table, dimension, components=4):
    """Exact moments as fractions, eigenvectors by the library's dense solver."""
    kept = [
        (r[0], [math.floor(256 * float(np.float32(c))) for c in r[1]])
        for r in table if r[1] is not None and len(r[1]) == dimension and all(c is not None and math.isfinite(c) for c in r[1])
    ]
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    mean = [Fraction(s, n) for s in sums]
    v = np.array([[float(sum((x[i] - mean[i]) * (x[j] - mean[j]) for x in fit) / n) for j in range(dimension)] for i in range(dimension)])
    values, columns = np.linalg.eigh(v)
    order = np.argsort(-values)[:components]
    white = [(key, ((np.array(x) - np.array(mean, float)) @ columns[:, order]) / np.sqrt(values[order])) for key, x in kept]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True)) for _, x in kept]
    return n, white, deviation, values[order] / np.trace(v)


def test_whitening(spark):
    table = vectors()
    found = whitening.whiten(spark.createDataFrame(table, EMBEDDINGS)).collect()
    n, white, deviation, explained = plain_whitening(table, 9)
    assert len(found) == 4 * len(white) and {r["n"] for r in found} == {n} and max(r["identity_error"] for r in found) < 1e-12
    want = sorted((str(key), d) for (key, _), d in zip(white, deviation, strict=True))
    for k in range(4):
        mine = [r for r in found if r["component"] == k + 1]
        assert sorted((str(r["vec_id"]), r["deviation"]) for r in mine) == want
        by_key = {r["vec_id"]: r["whitened"] for r in mine}
        sign = np.sign(by_key[0] * dict(white)[0][k])
        assert all(abs(by_key[key] - sign * w[k]) < 1e-9 for key, w in white)
        assert all(abs(r["explained"] - explained[k]) < 1e-12 for r in mine)


def test_whitening_of_special_tables(spark):
    frame = spark.createDataFrame(vectors(), EMBEDDINGS)
    assert whitening.whiten(frame.filter("false")).count() == 0
    assert whitening.whiten(frame.filter("vec_id between 400 and 404")).count() == 0
    assert whitening.whiten(frame.filter("vec_id = 5")).count() == 0  # one vector has no variance
    two = whitening.whiten(frame.filter("vec_id in (5, 6)")).collect()
    assert {r["component"] for r in two} == {1} and {round(abs(r["whitened"]), 9) for r in two} == {1.0} and len(two) == 3
    large = spark.createDataFrame([(i, [v, 1.0]) for i, v in enumerate([1e7, -1e7, 3e6, 0.0])], "vec_id long, embedding array<double>")
    assert {(r["component"], r["n"]) for r in whitening.whiten(large).collect()} == {(1, 4)}


def test_deviations_beyond_64_bits():
    assert whitening.deviations(np.array([[1 << 40, 0], [3, 4]]), 1 << 30, [0, 0]) == [None, None]
    assert whitening.deviations(np.array([[3, 4], [1 << 30, 0]]), 2, [1, 1]) == [25 + 49, ((1 << 31) - 1) ** 2 + 1]


def test_products_are_exact_at_any_size():
    rnd = np.random.default_rng(5)
    for top in (3, 1 << 20, 1 << 24, 1 << 40):
        x = rnd.integers(-top, top, (500, 3))
        assert (whitening._product(x) == x.astype(object).T @ x.astype(object)).all()


@pytest.mark.parametrize("spectrum", [
    [5, 4, 3, 2, 1, 0.5], [2, 2, 2, 2, 2, 1], [1] * 6, [1, 0, 0, 0, 0, 0], [0] * 6, [1e9, 1, 1e-3, 1e-6, 1e-7, 0], [3], [3, 3 - 1e-9],
    [9 - 0.3 * k for k in range(30)],
])
def test_contour_pairs_against_dense_solver(spectrum):
    n = len(spectrum)
    turn, _ = np.linalg.qr(np.random.default_rng(n).standard_normal((n, n)))
    matrix = (turn * np.array(spectrum, float)) @ turn.T
    matrix = (matrix + matrix.T) / 2
    for components in (1, 4, 20):
        values, columns = whitening.leading_pairs(matrix, components)
        want = [s for s in sorted(spectrum, reverse=True) if s > 1e-13 * sum(spectrum)][:components]
        assert len(values) == len(want) and np.allclose(values, want, rtol=0, atol=1e-12 * max(spectrum))
        assert np.allclose(columns.T @ columns, np.eye(len(want)), atol=1e-9)
        assert np.abs(matrix @ columns - columns * values).max(initial=0) <= 1e-12 * max(max(spectrum), 1e-300)


@pytest.mark.parametrize("seed", range(4))
def test_inertia_counts(seed):
    rnd = np.random.default_rng(seed)
    matrix = rnd.standard_normal((12, 12))
    matrix = matrix + matrix.T
    inertia, values = whitening.Inertia(matrix), np.linalg.eigvalsh(matrix)
    for shift in [*rnd.uniform(-8, 8, 30), *(values + 1e-9), *(values - 1e-9)]:
        assert inertia.above(float(shift)) == int((values > shift).sum())


# --- Merkle manifest --------------------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_tree(nodes):
    """Root, and for each node its siblings from the leaf up: (before, after)."""
    level, at, paths = list(nodes), list(range(len(nodes))), [[] for _ in nodes]
    while len(level) > 1:
        for k, place in enumerate(at):
            run = place // 8 * 8
            paths[k].append(("".join(level[run:place]), "".join(level[place + 1 : run + 8])))
        at = [place // 8 for place in at]
        level = [sha("".join(level[k : k + 8])) for k in range(0, len(level), 8)]
    return level[0], paths


def plain_manifest(table):
    def value(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(r, text):
        return sha("".join(value(v) for v in (r[0], r[3], r[2], r[4], text)))

    by_lang = {}
    for r in table:
        by_lang.setdefault(r[2], []).append((r, leaf(r, r[1])))
    order = sorted(by_lang, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        by_lang[g].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
    trees = {g: plain_tree([x[1] for x in by_lang[g]]) for g in order}
    root, tops = plain_tree([trees[g][0] for g in order])
    found = []
    for g, top in zip(order, tops, strict=True):
        for (r, own), path in zip(by_lang[g], trees[g][1], strict=True):
            steps, node = [*path, *top], own
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None:
                node = leaf(r, r[1].translate({65 + i: 97 + i for i in range(26)}))
            for before, after in steps:
                node = sha(before + node + after)
            found.append((r[0], own, trees[g][0], root, sha("".join(b + a for b, a in steps)), node, node == root))
    return found


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def manifest_rows(spark, table, levels):
    frame = spark.createDataFrame(table, corpus.SCHEMA) if table else corpus.table(spark, [])
    return rows(merkle.tampered_proofs(frame, FIELDS, levels=levels))


def in_order(table):
    return sorted(table, key=lambda t: [(v is not None, str(type(v)), v) for v in t])


@pytest.mark.parametrize("levels", [1, 4])
def test_manifest_of_awkward_rows(spark, levels):
    table = corpus.documents()
    langs = ["en", None, "de", "zz", "Zé", "", "é", "漢", "a", "b", "c", "d"]
    table = [(*r[:2], langs[k % 12] if k % 3 else "en", *r[3:]) for k, r in enumerate(table)]
    table += [(100 + k, f"Text {k} A-Z", "en", None, k, "a", "b", "c", "d", "e") for k in range(150)]
    table += [table[-1]] * 20 + [(None, "null KEY", "en", None, 1, "a", "b", "c", "d", "e")] * 70
    assert manifest_rows(spark, table, levels) == in_order(plain_manifest(table))


@pytest.mark.parametrize("count", [0, 1, 8, 9, 64, 65])
def test_manifest_sizes(spark, count):
    table = [(k, f"Row {k}", "en", "s", k, "a", "b", "c", "d", "e") for k in range(count)]
    assert manifest_rows(spark, table, 1) == in_order(plain_manifest(table) if table else [])


@pytest.mark.parametrize("count", [1, 2, 7, 8, 9, 63, 64, 65, 100, 513])
def test_open_tree(count):
    nodes = [sha(str(k)) for k in range(count)]
    tree = merkle.OpenTree()
    for k, node in enumerate(nodes):
        tree.append(node)
        steps = [len(path) for path in tree.witness]
        assert steps == sorted(steps, reverse=True)  # earlier leaves are never behind later ones
    root = tree.close(merkle.levels_of(count, 4))
    assert (root, tree.witness) == plain_tree(nodes)


def test_hot_group_spreads_over_tasks(spark):
    """Equal rows of one key and group, a third of the table, stand in several ranges."""
    frame = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.lit("en").alias("lang"), F.lit("same").alias("text")
    )
    numbered = merkle._numbered(
        frame.select(F.col("lang").alias("group"), F.sha2("text", 256).alias("digest"), F.col("doc_id").alias("by")), ("by", "digest"), 1
    )
    assert sorted(r["position"] for r in numbered.select("position").collect()) == list(range(3000))
    nulls = numbered.filter("by is null").select(F.max("position"), F.min("position")).first()
    assert tuple(nulls) == (999, 0)
