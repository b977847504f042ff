"""The pipeline stage by stage against plain versions, and what is registered."""

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from tests.conftest import rows
from tests.llm import corpus

ITEMS = [corpus.prose(90, 40), corpus.prose(91, 25)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("corpus"))
    texts = [corpus.prose(100 + k, 150) for k in range(6)]
    near = texts[0].split(" ")
    near[70] = "novelty"
    passage = corpus.prose(92, 60)
    texts += [
        texts[0], " ".join(near), f"{corpus.prose(110, 70)} {ITEMS[0]} {corpus.prose(111, 60)}",
        f"{passage} {corpus.prose(112, 90)}", f"{corpus.prose(113, 90)}\n{passage}\nHome | News | Sport | About",
        "\n".join(["Home | News | Sport | About | Contact"] * 40), "short text", None, " ".join(w + "###" for w in texts[1].split(" ")),
    ]
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in enumerate(texts)], columns)
    docs.write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(list(enumerate(ITEMS)), "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, texts = docs.columns, dict(rows(docs, "doc_id", "text"))
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    outputs = []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialise(stage(spark, docs, folder), name)
        outputs.append(docs)
    for frame in outputs[:-1]:
        assert frame.columns == columns
        assert all(r.n_chars == len(r.text) for r in frame.collect())
    kept = {k: t for k, t in texts.items() if k not in (11, 12, 13, 14)}
    kept[10] = kept[10].rsplit("\n", 1)[0]
    assert dict(rows(outputs[0], "doc_id", "text")) == kept
    root = corpus.components({k: corpus.shingles(t, 5) for k, t in kept.items()})
    kept = {k: t for k, t in kept.items() if root[k] == k}
    assert dict(rows(outputs[1], "doc_id", "text")) == kept and {6, 7}.isdisjoint(kept)
    plain = corpus.without_repeats([kept[k].encode() for k in sorted(kept)], 100)
    kept = {k: left.decode() for k, (_, _, left) in zip(sorted(kept), plain, strict=True)}
    assert dict(rows(outputs[2], "doc_id", "text")) == kept and any(n for n, _, _ in plain)
    kept.pop(8)
    assert dict(rows(outputs[3], "doc_id", "text")) == kept
    ids = {r["doc_id"]: r["ids"] for r in outputs[4].collect()}
    assert ids == {k: library.encode(t, add_special_tokens=False).ids for k, t in kept.items()}
    done = {r["doc_id"]: r["ids"] for r in corpus_pipeline.run(spark, folder).collect()}
    assert done == ids and all(np.array(v).size for v in done.values())


def test_registered():
    queries, oracles = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    for number in range(1, 14):
        assert sum(name.startswith(f"op{number}_") for name in queries) == 1
    assert queries["pipeline"] is corpus_pipeline.run and set(oracles) <= set(queries)
