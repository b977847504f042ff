"""Token ids in ORC files: ids of integer run-length encoding, row index and Bloom filter on keys.

Files hold documents in ascending key order, one file for each range of keys. Readers prune
stripes and row groups by the key's statistics and Bloom filters, and large files are read by
stripes in parallel. A document's global start is its file's start, from per-file sums, plus its
start inside the file, so no task ever sees more than one range.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from yardline.llm.bpe import byte_alphabet
from yardline.llm.pretokens import WordTable, class_runs, encode_texts, use_class_runs
from yardline.llm.text import map_batches, materialise, scratch_dir, text_slices

END_ID = 2
STRIPE_BYTES = 64 << 20
INDEX_ROWS = 1_000
#: Words of a generation here; two hold some 50 MB.
MAX_WORDS = 400_000
#: Code points encoded together, and bytes of text taken from an Arrow batch for them.
CHARS_AT_ONCE = 1 << 20
SLICE_BYTES = 1 << 21

_workers: dict[str, tuple[WordTable, tuple[str, ...]]] = {}


def library_words(path: str) -> tuple[WordTable, tuple[str, ...]]:
    """Ids of distinct pre-tokens by the tokenizers library's model, kept from task to task.

    Truncation and padding, which a file may name, are steps after the model and do not apply.
    """
    if path not in _workers:
        tokenizer = Tokenizer.from_file(path)
        model, alphabet = tokenizer.model, {b: c for c, b in byte_alphabet().items()}
        added = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
        special = {t.encode(): [i] for t, i in added.items()}

        def encode(words: list[bytes]) -> list[list[int]]:
            # A character for each byte, so words are cut where their bytes end.
            spelled = b"".join(words).decode("latin-1").translate(alphabet)
            ends = list(accumulate(map(len, words)))
            cut = map(spelled.__getitem__, map(slice, [0, *ends[:-1]], ends))
            return [special[w] if w in special else [t.id for t in model.tokenize(x)] for w, x in zip(words, cut, strict=True)]

        _workers[path] = WordTable(encode, MAX_WORDS), tuple(added)
    return _workers[path]


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    *,
    key: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
    stripe_bytes: int = STRIPE_BYTES,
    index_rows: int = INDEX_ROWS,
) -> None:
    """Encode texts and write their ids, each document closed by ``end_id``, in key order.

    Columns of the files: key, part (number of the range), start_in_part, n_tokens, ids. A null
    text counts as empty and gives the end id alone; null keys come first; documents of equal key
    are neighbours, ordered by text; an empty table gives a folder without rows. Other columns
    are not read. Texts are dealt out before they are encoded, as they are smaller than ids in
    rows and the sampling of ranges then reads keys only.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, part int, start_in_part bigint, n_tokens bigint, ids array<int>"

    runs = class_runs()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use_class_runs(runs)
        table, special = library_words(tokenizer)
        part, start, last = TaskContext.get().partitionId(), 0, np.array([end_id], np.int32)
        for batch in (some for whole in batches for some in text_slices(whole, 1, SLICE_BYTES)):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            coded = list(encode_texts(texts, table, special, CHARS_AT_ONCE))
            size = np.fromiter(map(len, coded), np.int64, len(coded)) + 1
            ends = start + np.cumsum(size)
            flat = np.concatenate([x for ids in coded for x in (ids, last)])
            offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.full(len(coded), part, np.int32)),
                    pa.array(ends - size),
                    pa.array(size),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                ],
                names=[key, "part", "start_in_part", "n_tokens", "ids"],
            )
            start = int(ends[-1]) if len(ends) else start

    chosen = docs.select(F.col(f"`{key}`"), F.col(f"`{text}`").cast("string").alias("__text"))
    # A stated number, since encoding a partition takes much longer than its bytes tell.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = chosen.repartitionByRange(parts, F.col(f"`{key}`")).sortWithinPartitions(f"`{key}`", "__text")
    (
        map_batches(ordered, run, schema)
        .write.option("orc.compress", "ZSTD")
        .option("orc.stripe.size", str(stripe_bytes))
        .option("orc.row.index.stride", str(index_rows))
        .option("orc.create.index", "true")
        .option("orc.bloom.filter.columns", key)
        .option("orc.bloom.filter.fpp", "0.01")
        .option("maxRecordsPerFile", "0")
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str, schema: str, *, key: str = "doc_id", keys: list | None = None) -> DataFrame:
    """Documents of the files with their global start: key, start, n_tokens, ids.

    ``keys`` are sought by a filter that the scan takes, so that stripes and row groups without
    them are skipped. Starts come from the files' part and n_tokens columns alone: one sum for
    each part, then a running sum over parts.
    """
    files = spark.read.schema(schema).orc(path)
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    # A row for each part; written, its size lets Spark broadcast it rather than shuffle all ids.
    bases = materialise(bases, "token-bases")
    wanted = files if keys is None else files.filter(F.col(f"`{key}`").isin(keys))
    return wanted.join(bases, "part").select(
        F.col(f"`{key}`"), (F.col("base") + F.col("start_in_part")).alias("start"), "n_tokens", "ids"
    )


def file_schema(docs: DataFrame, key: str = "doc_id") -> str:
    kind = docs.schema[key].dataType.simpleString()
    return f"`{key}` {kind}, part int, start_in_part bigint, n_tokens bigint, ids array<int>"


def with_checksums(tokens: DataFrame, *, key: str = "doc_id") -> DataFrame:
    """key, start, n_tokens, ids_crc32 of rows that ``read_tokens`` gives."""
    kind = tokens.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(3)
            values = column.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)
            edges = column.offsets.to_numpy()
            sums = [zlib.crc32(values[a:b].data) for a, b in zip(edges[:-1], edges[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.diff(edges).astype(np.int64)), pa.array(sums, pa.int64())],
                names=[key, "start", "n_tokens", "ids_crc32"],
            )

    chosen = tokens.select(f"`{key}`", "start", "n_tokens", "ids")
    return map_batches(chosen, run, f"`{key}` {kind}, start bigint, n_tokens bigint, ids_crc32 bigint")


def write_and_read(docs: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """Write files below the shared scratch folder (or at ``path``) and read them back."""
    spark = docs.sparkSession
    path = path or scratch_dir(spark, "tokens")
    write_tokens(docs, path, tokenizer, key=key, text=text)
    return read_tokens(spark, path, file_schema(docs, key), key=key)
