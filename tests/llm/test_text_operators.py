"""Quality rules, near duplicates, repeated strings and benchmark leaks against plain versions."""

import hashlib
import os
import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.llm import corpus
from yardline.llm import decontaminate, near_dup, quality_rules, suffix_dedup


@pytest.fixture(scope="module")
def docs(spark):
    return corpus.table(spark)


@pytest.fixture(scope="module")
def empty(spark):
    return corpus.table(spark, [])


def base_statistics(text):
    text = text or ""
    found = corpus.words(text)
    lines = [x for x in text.split("\n") if corpus.words(x)]
    windows = [tuple(found[k : k + 3]) for k in range(len(found) - 2)]
    twice = {w for w in windows if windows.count(w) > 1} if len(windows) < 3000 else set(windows)
    covered = {k + j for k, w in enumerate(windows) if w in twice for j in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(found), sum(map(len, found)), symbols, len(lines) - len(set(lines)), len(covered)


def test_quality_statistics(docs):
    kept = [r for r in corpus.documents() if len(r[1] or "") < 20000 or len(set(corpus.words(r[1]))) < 9]
    chosen = docs.filter(F.coalesce(F.length("text"), F.lit(0)) < 20000).unionByName(docs.filter("text like 'a b c %'")).distinct()
    got = rows(quality_rules.score_rules(chosen), "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    want = {(r[0], *base_statistics(r[1])) for r in kept}
    assert set(got) == want


@pytest.mark.parametrize(
    ("line", "fails"),
    [
        ("A plain sentence, with commas and a stop.", False),
        ("word### other$$$ third%%% more&&&", True),
        ("WHY!! ARE!! WE!! SHOUTING!!", True),
        ("Home | News | Sport | Contact us", True),
        ("This site uses cookies to work.", True),
        ("ALL CAPS TITLE", False),
        ("THIS LINE IS SHOUTED WITHOUT MARKS", True),
        ("", False),
        ("Mail me: a.b@example.com or call +1 (487) 555-7209 today.", False),
    ],
)
def test_line_rules(spark, line, fails):
    frame = spark.createDataFrame([(line,)], "x string")
    assert frame.select(quality_rules.line_fails(F.col("x"))).first()[0] is fails


def test_lines_go_before_documents(spark):
    good, menu = corpus.prose(20, 60), "Home | News | Sport | About"
    rows_ = [(1, f"{good}\n{menu}", *[None] * 8), (2, "\n".join([good[:60]] + [menu] * 30), *[None] * 8), (3, good, *["z"] * 2, 5, *["q"] * 5)]
    frame = corpus.table(spark, rows_)
    cleaned = {r["doc_id"]: r for r in quality_rules.clean_documents(frame).collect()}
    assert set(cleaned) == {1, 3}
    assert cleaned[1]["text"] == good and cleaned[1]["n_chars"] == len(good) and cleaned[3]["row"] == "q"
    assert quality_rules.clean_documents(frame).columns == frame.columns


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(docs, size):
    found = near_dup.near_duplicates(docs, words=size)
    sets = {r[0]: corpus.shingles(r[1], size) for r in corpus.documents() if r[0] is not None}
    root = corpus.components(sets)
    want = {(k, len(sets[k]), root[k], root[k] == k) for k in sets}
    got = rows(found)
    assert len(got) == len(corpus.documents())
    assert {g for g in got if g[0] is not None} == want
    assert {g[2:] for g in got if g[0] is None} == {(None, True)}


@pytest.mark.parametrize("family", [2, 64])
def test_loose_copies_of_one_text(spark, family):
    """Copies that are near their source but not near each other, and others that are not near it."""
    import random

    rnd, base, texts = random.Random(3), corpus.prose(30, 300).split(" "), []
    for k in range(60):
        copy = list(base)
        for place in rnd.sample(range(300), 12 + k % 12):
            copy[place] = f"w{k}x{place}"
        texts.append(" ".join(copy))
    table = [(k + 1, t, *[None] * 8) for k, t in enumerate(texts)] + [(100, " ".join(base), *[None] * 8)]
    want = corpus.components({r[0]: corpus.shingles(r[1], 2) for r in table})
    got = near_dup.near_duplicates(corpus.table(spark, table), words=2, family=family)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == want


def test_one_of_each_group_stays(docs):
    left = near_dup.drop_near_duplicates(docs)
    sets = {r[0]: corpus.shingles(r[1], 5) for r in corpus.documents() if r[0] is not None}
    root = corpus.components(sets)
    assert left.columns == docs.columns
    assert [r[0] for r in rows(left, "doc_id") if r[0] is not None] == sorted(set(root.values()))


@pytest.mark.parametrize("group", [1, 1000])
def test_repeated_strings(docs, group):
    length = 40
    got = rows(
        suffix_dedup.remove_repeats(docs, length=length, gram=12, group=group), "row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )
    order = sorted(corpus.documents(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is None))
    plain = corpus.without_repeats([(r[1] or "").encode() for r in order], length)
    want = [
        (r[0], len((r[1] or "").encode()), n, runs, hashlib.sha256(left).hexdigest()) for r, (n, runs, left) in zip(order, plain, strict=True)
    ]
    # Rows of one key keep the table's order, which a list of rows does not fix: compare them as sets of totals.
    single = {k for k in (r[0] for r in order) if [x[0] for x in order].count(k) == 1}
    assert [g for g in got if g[0] in single] == sorted(w for w in want if w[0] in single)
    assert sorted(g[2] for g in got if g[0] == 4) == sorted(w[2] for w in want if w[0] == 4)


def test_one_string_in_many_contexts_is_never_in_one_place(spark, monkeypatch):
    """Windows inside a notice agree in all hashes, and the contexts make every segment different."""
    notice = corpus.prose(95, 40)[:120]
    table = [(k, f"{corpus.prose(1000 + k, 30)}{notice}{corpus.prose(2000 + k, 30)}", *[None] * 8) for k in range(80)]
    gathered, whole = [], suffix_dedup.suffix_spans

    def spied(wanted, **options):
        gathered.append(max((r["count"] for r in wanted.groupBy("g").count().collect()), default=0))
        return whole(wanted, **options)

    monkeypatch.setattr(suffix_dedup, "suffix_spans", spied)
    got = rows(suffix_dedup.remove_repeats(corpus.table(spark, table), group=8), "row.doc_id", "n_removed", "n_spans", "kept_sha256")
    plain = corpus.without_repeats([r[1].encode() for r in table], 100)
    assert got == [(k, n, runs, hashlib.sha256(left).hexdigest()) for k, (n, runs, left) in enumerate(plain)]
    assert sum(n >= 120 for n, _, _ in plain) == 79 and max(gathered) <= 8


def test_early_tables_of_repeated_strings_are_removed(docs, monkeypatch):
    folders, made = [], suffix_dedup.scratch_dir
    monkeypatch.setattr(suffix_dedup, "scratch_dir", lambda *a: folders.append(made(*a)) or folders[-1])
    found = suffix_dedup.remove_repeats(docs, length=40, gram=12, group=1)
    assert len(folders) == 1 and not os.path.exists(folders[0].removeprefix("file:"))
    assert found.count() == docs.count()


def test_repeats_leave_other_columns(docs):
    done = suffix_dedup.drop_repeats(docs.filter("doc_id in (0, 1, 4)").dropDuplicates(["doc_id"]))
    found = {r["doc_id"]: r for r in done.collect()}
    assert done.columns == docs.columns
    assert found[1]["text"] == "" and found[1]["n_chars"] == 0 and found[1]["row"] == "a"
    assert found[0]["text"] == corpus.documents()[0][1]


def overlap(a, b, width=12, percent=80):
    m = min(width, len(b))
    if not b or len(a) < m:
        return False
    for shift in range(-(len(b) - m), len(a) - m + 1):
        low, high = max(shift, 0), min(len(a), shift + len(b))
        equal = [a[k] == b[k - shift] for k in range(low, high)]
        if any(100 * sum(equal[k : k + m]) >= percent * m for k in range(len(equal) - m + 1)):
            return True
    return False


@pytest.mark.parametrize("broadcast", [0, 10**6])
def test_benchmark_overlaps(spark, broadcast):
    items = [corpus.prose(40, 30), corpus.prose(41, 14), "short one", None, corpus.prose(42, 9), "Stonely", corpus.prose(43, 6), ""]
    changed = items[0].split(" ")
    changed[5], changed[17] = "swapped", "again"
    texts = [
        f"{corpus.prose(50, 40)} {items[0]} {corpus.prose(51, 20)}", f"{corpus.prose(52, 5)} {' '.join(changed)}", items[1].upper(),
        items[4], corpus.prose(53, 400), None, "", items[0][: len(items[0]) // 3], items[0],
        f"{corpus.prose(54, 30)} a SHORT, one. {corpus.prose(55, 9)}", f"x stonely! {items[6]}", "short and one",
    ]
    table = [(k, t, *[None] * 8) for k, t in enumerate(texts)] + [(None, items[1], *[None] * 8), (8, items[0], *[None] * 8)]
    texts = len(texts)
    bench = spark.createDataFrame([*enumerate(items), (0, items[0])], "item_id long, text string")
    docs = corpus.table(spark, table)
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.overlaps(docs, bench, max_broadcast=broadcast).collect()}

    def cut(text):
        return re.findall(r"[^\W_]+", (text or "").lower())

    assert got == {(r[0], k) for r in table for k, x in enumerate(items) if overlap(cut(r[1]), cut(x))}
    left = decontaminate.drop_contaminated(docs, bench)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [k for k in range(texts) if not any(g[0] == k for g in got)]


@pytest.mark.parametrize("words", [8, 9, 10, 11, 12])
def test_overlaps_under_all_substitutions(spark, words):
    """Whichever words the rule lets differ, the copy is found."""
    from itertools import combinations

    lost = words - -(-words * decontaminate.MIN_PERCENT // 100)
    for k in range(lost + 1):
        assert decontaminate.unseeded(decontaminate.MASKS, words, k) == []
    item = [f"i{k}" for k in range(words)]
    patterns = list(combinations(range(words), lost))
    texts = [" ".join("other" if j in p else w for j, w in enumerate(item)) for p in patterns]
    around = [*texts, *(f"before it {t} and after" for t in texts)]
    too_far = " ".join("other" if j <= lost else w for j, w in enumerate(item))
    docs = corpus.table(spark, [(k, t, *[None] * 8) for k, t in enumerate([*around, too_far])])
    # Items that are longer hold the same words at their end.
    items = [" ".join(item), " ".join([*(f"x{k}" for k in range(20)), *item])]
    bench = spark.createDataFrame([*enumerate(items)], "item_id long, text string")
    got = rows(decontaminate.overlaps(docs, bench), "item_id", "doc_id", "n_equal")
    want = [(k, d, words - lost) for k in range(2 if words == 12 else 1) for d in range(len(around))]
    assert got == want


@pytest.mark.parametrize("broadcast", [0, 10**6])
def test_items_of_few_words(spark, broadcast):
    """Items of 1 to 7 words are found by the same rule: exactly up to 4 words, with one word replaced from 5 on."""
    items = {n: [f"s{n}x{k}" for k in range(n)] for n in range(1, 8)} | {0: [], 20: [f"long{k}" for k in range(20)]}
    texts, want = ["nothing of it here", "", None, " ".join(items[20])], {(3, 20)}
    for n in range(1, 8):
        for gone in [(), *((k,) for k in range(n)), *((k, k + 1) for k in range(n - 1))]:
            copy = ["other" if k in gone else w for k, w in enumerate(items[n])]
            for text in (" ".join(copy), f"Before, {' '.join(copy).upper()}! After"):
                if len(gone) <= (0 if n < 5 else 1):
                    want.add((len(texts), n))
                texts.append(text)
    docs = corpus.table(spark, [(k, t, *[None] * 8) for k, t in enumerate(texts)])
    bench = spark.createDataFrame([(n, " ".join(x)) for n, x in items.items()], "item_id long, text string")
    found = decontaminate.overlaps(docs, bench, max_broadcast=broadcast).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == want and len(found) == len(want)


def test_many_items_of_one_stem(spark):
    """Items that share most of their words, and items of one common word."""
    stem = "which of the following best describes the main idea of"
    items = [f"{stem} passage{k} about topic{k % 7}" for k in range(300)] + ["the", "idea of"]
    texts = [f"Before it. {items[k]} After it." for k in (3, 50, 299)] + [corpus.prose(k, 60) for k in range(300, 310)] + ["The end of an idea, of sorts"]
    docs = corpus.table(spark, [(k, t, *[None] * 8) for k, t in enumerate(texts)])
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.overlaps(docs, bench).collect()}

    def cut(text):
        return re.findall(r"[^\W_]+", text.lower())

    assert got == {(d, k) for d, t in enumerate(texts) for k, x in enumerate(items) if overlap(cut(t), cut(x))}


def test_factor_lengths_against_all_earlier_places():
    import random

    import numpy as np

    rnd = random.Random(3)
    for trial in range(200):
        parts = [bytes(rnd.choices(b"ab" if trial % 2 else b"a\x00b", k=rnd.randrange(1, 60))) for _ in range(rnd.randrange(1, 6))]
        data, size = np.frombuffer(b"".join(parts), np.uint8), np.array([len(x) for x in parts])
        ends = np.repeat(np.cumsum(size), size)
        place = np.array(sorted(rnd.sample(range(len(data)), rnd.randrange(1, len(data) + 1))))
        position = np.array(rnd.sample(range(1000), len(place)))
        strings = [bytes(data[p : ends[p]]) for p in place]

        def shared(x, y):
            return next((k for k, (a, b) in enumerate(zip(x, y, strict=False)) if a != b), min(len(x), len(y)))

        want = [max((shared(s, o) for o, q in zip(strings, position, strict=True) if q < p), default=0) for s, p in zip(strings, position, strict=True)]
        assert suffix_dedup.previous_factors(data, ends, place, position).tolist() == want


def test_near_duplicates_of_repeated_and_null_keys(spark):
    """Rows of one key are judged by their own texts; of a group one stays."""
    base, other, third = corpus.prose(70, 120), corpus.prose(71, 100), corpus.prose(72, 90)
    near = base.replace(base.split(" ")[40], "novelty", 1)
    table = [(1, base), (2, near), (2, other), (2, other), (3, third), (None, third), (None, None), (None, None), (4, ""), (4, "")]
    docs = corpus.table(spark, [(*r, *[None] * 8) for r in table])
    left = near_dup.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    kept = sorted((tuple(r)[:2] for r in left.collect()), key=lambda r: (r[0] or 0, r[1] or ""))
    assert kept == [(None, None), (None, None), (None, third), (1, base), (2, other), (4, ""), (4, "")]


def test_near_duplicates_of_null_string_keys(spark):
    """A null key counts as the empty string, and of equal keys the earlier row stays."""
    base, other = corpus.prose(73, 100), corpus.prose(74, 100)
    docs = spark.createDataFrame([("", base), (None, base), ("a", other), (None, other)], "doc_id string, text string").coalesce(1)
    left = near_dup.drop_near_duplicates(docs)
    assert sorted(map(tuple, left.collect()), key=str) == [("", base), (None, other)]


def test_sketches_do_not_lose_links():
    """Pairs of the least linked similarity lie far above the share of equal sketch bytes that is asked for."""
    from math import comb

    import numpy as np

    from yardline.llm.hashing import mix, numbers

    factor, shift = numbers(near_dup.PERMUTATIONS, 11) | np.uint64(1), numbers(near_dup.PERMUTATIONS, 12)
    rnd, shares = np.random.default_rng(1), []
    with np.errstate(over="ignore"):
        for size in (50, 200, 900):
            for _ in range(120):
                every = rnd.integers(0, 1 << 63, size, dtype=np.uint64)
                own = size // 10  # each has a tenth of the union for itself: similarity 0.8
                sets = every[own:], every[: size - own]
                bytes_ = [mix(near_dup.min_max(s, factor, shift)) >> np.uint64(56) for s in sets]
                shares.append(float((bytes_[0] == bytes_[1]).mean()))
    assert abs(np.mean(shares) - 0.8) < 0.02 and min(shares) > near_dup.SKETCH_FLOOR + 0.08
    n, floor = 2 * near_dup.PERMUTATIONS, near_dup.SKETCH_FLOOR
    assert sum(comb(n, k) * 0.8**k * 0.2 ** (n - k) for k in range(int(floor * n))) < 1e-13


def test_rows_of_one_key_are_judged_one_by_one(spark):
    leak, clean = corpus.prose(60, 30), [corpus.prose(61 + k, 40) for k in range(4)]
    table = [(None, leak), (None, clean[0]), (None, None), (1, leak), (1, clean[1]), (1, clean[1]), (2, clean[2]), (3, leak), (4, clean[3])]
    docs = corpus.table(spark, [(*r, *[None] * 8) for r in table])
    bench = spark.createDataFrame([(0, leak)], "item_id long, text string")
    left = decontaminate.drop_contaminated(docs, bench)
    assert left.columns == docs.columns
    key = lambda r: (r[0] or 0, r[1] or "")
    assert sorted((tuple(r)[:2] for r in left.collect()), key=key) == sorted((r for r in table if r[1] != leak), key=key)


def test_empty_tables(spark, empty):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert quality_rules.score_rules(empty).count() == 0
    assert near_dup.near_duplicates(empty).count() == 0
    assert suffix_dedup.remove_repeats(empty).count() == 0
    assert decontaminate.overlaps(empty, bench).count() == 0
    assert decontaminate.overlaps(corpus.table(spark), bench).count() == 0
