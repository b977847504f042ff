"""BPE and token files against the tokenizers library."""

import hashlib
import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.conftest import rows
from tests.llm import corpus
from yardline.llm import bpe, pretokens, token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def encoded(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("abcdestlmvr' \n\t19.,!é漢ñ　\u0085😀\x00")) | st.text() | st.sampled_from(["x<|endoftext|>y", "don't  we'll 'tis"]))
def test_any_text(text):
    library, (merges, words) = Tokenizer.from_file(PATH) if not hasattr(test_any_text, "t") else test_any_text.t, bpe.worker(PATH)
    test_any_text.t = library
    (ids,) = bpe.encode_texts([text], words, merges.special)
    assert ids.tolist() == encoded(library, text)
    assert merges.decoded(ids).decode() == library.decode(ids.tolist(), skip_special_tokens=False)


def test_pieces_do_not_change_tokens(library, monkeypatch):
    monkeypatch.setattr(pretokens, "PIECE_CHARS", 64)
    merges, words = bpe.worker(PATH)
    texts = [corpus.prose(60, 300) + "  \n x", "y" * 500, "", "a  b " * 60]
    parts = [[p for p, _ in pretokens.pieces(t, (), 64)] for t in texts]
    assert ["".join(p) for p in parts] == texts and len(parts[0]) > 5
    assert [x.tolist() for x in bpe.encode_texts(texts, words, merges.special)] == [encoded(library, t) for t in texts]


def test_failing_proposals_are_merged():
    merges, _ = bpe.worker(PATH)
    words = [w.encode() for w in {" " + w for w in corpus.prose(61, 4000).split(" ")}]
    proposed, merged = [merges.proposed(w) for w in words], [merges.merged(w) for w in words]
    assert merges.encode_words(words) == merged
    flags = [
        bool(np.all(merges.compatible(np.array(p[:-1], np.int64), np.array(p[1:], np.int64)))) for p in proposed
    ]
    assert flags == [p == m for p, m in zip(proposed, merged, strict=True)] and not all(flags)


def test_class_runs_give_the_table(monkeypatch):
    table, runs = pretokens.character_classes().copy(), pretokens.class_runs()
    monkeypatch.setattr(pretokens, "_classes", None)
    pretokens.use_class_runs(runs)
    assert (pretokens.character_classes() == table).all() and sum(r.nbytes for r in runs) < 1 << 16


def test_word_table_starts_anew():
    calls = []
    table = pretokens.WordTable(lambda new: calls.append(len(new)) or [[len(w)] for w in new], max_words=2)
    assert table.places([b"a", b"bb", b"ccc", b"a"]).tolist() == [0, 1, 2, 0]
    place = table.places([b"dddd"])
    assert table.ids[table.start[place]].tolist() == [4] and calls == [3, 1]


def test_words_met_again_come_back_from_the_earlier_generation():
    calls = []
    table = pretokens.WordTable(lambda new: calls.append(list(new)) or [[len(w)] * len(w) for w in new], max_words=2)
    for words in ([b"a", b"bb", b"ccc"], [b"bb", b"dddd", b"e"], [b"bb", b"a", b"ff"]):
        rows = table.places(words)
        got = [table.ids[table.start[k] : table.start[k + 1]].tolist() for k in rows]
        assert got == [[len(w)] * len(w) for w in words]
    # "bb" stays as it is met in each generation; "a" was not met in the second one.
    assert calls == [[b"a", b"bb", b"ccc"], [b"dddd", b"e"], [b"a", b"ff"]]


def test_short_words_are_looked_up_as_numbers():
    """Words of all lengths around eight and sixteen bytes, zero bytes included, over several generations."""
    rnd, calls = random.Random(5), []
    table = pretokens.WordTable(lambda new: calls.extend(new) or [list(w) for w in new], max_words=300)
    stems = [rnd.randbytes(rnd.randrange(1, 20)) for _ in range(150)] + [b"a" * k + b"\0" * z for k in range(1, 18) for z in range(3)]
    for part in range(8):
        words = rnd.choices(stems, k=400) + [part.to_bytes(1) + x for x in stems]
        at = np.cumsum([0, *map(len, words)])
        rows = pretokens._word_places(b"".join(words), at[:-1], np.diff(at), table)
        assert [bytes(table.ids[table.start[k] : table.start[k + 1]].tolist()) for k in rows] == words
        assert all(len(w) > 15 for w in table.place)
        # A word that both generations lack is encoded once, whatever its number of places.
        assert len(calls) == len(set(calls)) and set(calls) <= set(words)
        calls.clear()


def test_short_words_of_one_key_are_not_mixed_up():
    held, one = pretokens.ShortWords(), np.ones(1, np.uint64)
    for low, row in ((7, 3), (8, 4)):
        assert held.find(5 * one, low * one, one).tolist() == [-1]
        held.add(5 * one, low * one, one, np.array([row]))
    assert [held.find(5 * one, low * one, one).tolist() for low in (7, 8, 9)] in ([[3], [-1], [-1]], [[-1], [4], [-1]])


def test_words_held_take_few_bytes():
    table = pretokens.WordTable(lambda new: [[1, 2, 3] for _ in new], max_words=10**6)
    data = b"".join(b"%010d" % k for k in range(50_000))
    at = np.arange(0, len(data), 10)
    tracemalloc.start()
    pretokens._word_places(data, at, np.full(len(at), 10), table)
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert len(table.start) == 50_001 and held < 100 * 50_000


def test_encode(spark, library):
    got = rows(bpe.encode(corpus.table(spark), PATH, with_text=True), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "decoded")
    want = []
    for row in corpus.documents():
        ids = encoded(library, row[1])
        text = library.decode(ids, skip_special_tokens=False)
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        want.append((row[0], len(ids), digest, hashlib.sha256(text.encode()).hexdigest(), text))
    assert got == sorted(want, key=lambda t: [(v is not None, str(type(v)), v) for v in t])


def test_token_files(spark, library, tmp_path):
    docs, path = corpus.table(spark), str(tmp_path / "tokens")
    got = rows(token_files.with_checksums(token_files.write_and_read(docs, PATH, path=path)))
    order = sorted(corpus.documents(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start, want = 0, []
    for row in order:
        ids = np.array([*encoded(library, row[1]), token_files.END_ID], "<u4")
        want.append((row[0], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(got, key=lambda g: g[1]) == want
    some = token_files.read_tokens(spark, path, token_files.file_schema(docs), keys=[3, 5])
    assert rows(some, "doc_id", "start") == [w[:2] for w in want if w[0] in (3, 5)]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(doc_id, [3,5])" in plan or "PushedFilters: [IsNotNull(part), In(doc_id" in plan or "In(doc_id, [3,5])" in plan


def test_empty_tables(spark):
    empty = corpus.table(spark, [])
    assert bpe.encode(empty, PATH).count() == 0
    assert token_files.with_checksums(token_files.write_and_read(empty, PATH)).count() == 0
