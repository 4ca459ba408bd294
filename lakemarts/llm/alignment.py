"""Operator 12, cross-tokenizer alignment.

Every text is encoded by a byte-level BPE (left side) and a sentencepiece
model (right side).  Byte offsets where both sides end a token cut a text into
groups; tokens whose byte ranges overlap are linked.  A pair of ids counts the
documents, corpus-wide, that hold it linked; a link is best where its pair's
count is the highest of its left id.

The pairs are counted by external spill counting:

1. Documents are aligned in chunks of about ``CHUNK_BYTES``.  A chunk's
   records (pair, document, links) are sorted and dealt by the left id's radix
   into zstd runs, which one stored table holds beside the documents' figures.
   A run has its pairs with document counts apart from the documents of each,
   so a pair travels to the counting once a chunk, however frequent it is.
2. Runs of a radix are merged by a k-way heap merge, at most ``FAN`` chunks or
   so in a task, then the merged runs likewise until one is left.  A task has
   one open frame a run in memory.  The last run of a radix is bounded by its
   ids' pairs, not by the corpus.
3. Keys are ordered by the left id first, so the maxima take one pass.  Counts
   meet the runs again in groups of ``JOIN_FAN`` chunks, and what each run
   contributes is summed for its documents and streamed back to their chunk.

No group of a shuffle grows with the corpus: groups of chunks are as many as
the chunks need, and the rest is bounded by a chunk or by the vocabularies.

Inputs: null and empty texts, and texts whose joined token bytes differ from
space + text on a side, have no tokens: zeros and an empty digest.  A very
long text is encoded whole, in a chunk of its own, so a worker needs memory
in proportion to the longest text.  Repeated rows and rows that share a doc_id
or have none are documents of their own.  Ties of counts are all best.  Other
columns are ignored, whatever their names.  An empty table gives an empty
result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lakemarts.llm import alignment_core as core
from lakemarts.llm.common import ship, stored

CHUNK_BYTES = 4 << 20
CHUNK_DOCS = 8192
RADICES = 32
FAN = 32
JOIN_FAN = 128

_FIGURES = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_RUN = "pairs array<binary>, counts array<binary>, doc binary, links binary"


@functools.lru_cache(maxsize=1)
def _aligner(left: bytes, right: bytes, pattern: str) -> core.Aligner:
    return core.Aligner(core.ByteLevel(left, pattern), core.Pieces(right))


def _content(spark: SparkSession, path: str) -> bytes:
    if "://" in path:
        return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])
    return Path(path).read_bytes()


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    ids, texts, size = [], [], 0
    for batch in batches:
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py()
            ids.append(i)
            texts.append(text)
            size += 4 * len(text) if text and not text.isascii() else len(text or "")
            if size >= CHUNK_BYTES or len(ids) >= CHUNK_DOCS:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _spilled(docs: DataFrame, left: bytes, right: bytes, pattern: str, radices: int) -> DataFrame:
    """Rows of documents (``idx``, figures) and of runs (``radix``), by chunk."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType([
        T.StructField("chunk", T.LongType()), T.StructField("docs", T.LongType()),
        T.StructField("doc_id", kind), T.StructField("idx", T.LongType()),
        *T.StructType.fromDDL(_FIGURES).fields, T.StructField("radix", T.IntegerType()),
        *T.StructType.fromDDL(_RUN).fields,
    ])
    arrow = to_arrow_schema(schema)
    held = spark.sparkContext.broadcast((left, right))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(*held.value, pattern)
        first = TaskContext.get().partitionId() << 32
        for n, (ids, texts) in enumerate(_chunks(batches)):
            figures, keys, doc = aligner.chunk(texts)
            own = {"chunk": first + n, "docs": len(ids)}
            rows = {"chunk": [own["chunk"]] * len(ids), "docs": [len(ids)] * len(ids), "doc_id": ids}
            rows |= {"idx": list(range(len(ids)))} | figures
            empty = pa.nulls(len(ids))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[f.name], f.type) if f.name in rows else empty.cast(f.type) for f in arrow], schema=arrow
            )
            spill = core.runs(*core.records(keys, doc, len(ids)), aligner.width, radices)
            for found in spill:
                yield pa.RecordBatch.from_pylist([own | found], schema=arrow)

    return stored(docs.select("doc_id", "text").mapInArrow(run, schema), "alignment")


def _column(table: pa.Table, name: str) -> list:
    return table.column(name).to_pylist()


def _merge(table: pa.Table) -> pa.Table:
    """One run of a group's runs."""
    runs = [list(zip(p, c)) for p, c in zip(_column(table, "pairs"), _column(table, "counts"))]
    frames, keys, counts, held = [], [], [], 0
    for k, c in core.merged(runs):
        keys.append(k)
        counts.append(c)
        held += len(k)
        if held >= core.FRAME:
            frames += core.frames_of(np.concatenate(keys), np.concatenate(counts))
            keys, counts, held = [], [], 0
    if held:
        frames += core.frames_of(np.concatenate(keys), np.concatenate(counts))
    return pa.table({
        "radix": pa.array(_column(table, "radix")[:1], pa.int32()),
        "part": pa.array(_column(table, "part")[:1], pa.int64()),
        "pairs": pa.array([[f for f, _ in frames]], pa.list_(pa.binary())),
        "counts": pa.array([[f for _, f in frames]], pa.list_(pa.binary())),
    })


def _parts(chunks: int, fan: int) -> int:
    return max(1, -(-chunks // fan))


def pair_counts(runs: DataFrame, chunks: int, fan: int = FAN) -> DataFrame:
    """Merged runs, one a radix: ``radix, pairs, counts``."""
    parts = _parts(chunks, fan)
    part = F.pmod(F.xxhash64("chunk"), F.lit(parts))
    while True:
        runs = runs.select("radix", part.alias("part"), "pairs", "counts").groupBy("radix", "part").applyInArrow(
            _merge, "radix int, part long, pairs array<binary>, counts array<binary>"
        )
        if parts == 1:
            return runs.select("radix", "pairs", "counts")
        parts = _parts(parts, fan)
        part = F.pmod("part", F.lit(parts))


def align(
    docs: DataFrame, left_path: str, right_path: str, pattern: str,
    radices: int = RADICES, fan: int = FAN, join_fan: int = JOIN_FAN,
) -> DataFrame:
    """One row per document: ``doc_id, n_a, n_b, n_groups, n_links,
    groups_sha256, n_best, count_sum``."""
    spark = docs.sparkSession
    ship(spark)
    left, right = _content(spark, left_path), _content(spark, right_path)
    width = len(core.Pieces(right).tokens)
    spilled = _spilled(docs, left, right, pattern, radices)
    runs = spilled.where("radix is not null")
    chunks = spilled.where("idx = 0").count()
    parts = _parts(chunks, join_fan)

    def contribute(own: pa.Table, counted: pa.Table) -> pa.Table:
        frames = zip(_column(counted, "pairs")[0], _column(counted, "counts")[0])
        maxima = core.Maxima(frames, width)
        best, sums = [], []
        for i in range(own.num_rows):
            run = own.slice(i, 1).to_pylist()[0]
            b, s = maxima.contributions(run, run["docs"])
            best.append(core.pack(b, 8))
            sums.append(core.pack(s, 8))
        return pa.table({
            "chunk": own.column("chunk"), "best": pa.array(best, pa.binary()), "sums": pa.array(sums, pa.binary()),
        })

    counted = pair_counts(runs.select("chunk", "radix", "pairs", "counts"), chunks, fan).withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))
    )
    dealt = runs.select(
        "chunk", "docs", "radix", F.pmod(F.xxhash64("chunk"), F.lit(parts)).alias("part"),
        "pairs", "counts", "doc", "links",
    )
    contributions = dealt.groupBy("radix", "part").cogroup(counted.groupBy("radix", "part")).applyInArrow(
        contribute, "chunk long, best binary, sums binary"
    )
    figures = spilled.where("radix is null").select("chunk", "idx", "doc_id", *T.StructType.fromDDL(_FIGURES).names)

    def add(rows: pa.Table, found: pa.Table) -> pa.Table:
        best = np.zeros(rows.num_rows, dtype=np.int64)
        sums = np.zeros(rows.num_rows, dtype=np.int64)
        for b, s in zip(_column(found, "best"), _column(found, "sums")):
            best += core.unpack(b, 8)
            sums += core.unpack(s, 8)
        at = rows.column("idx").to_numpy()
        kept = rows.drop_columns(["chunk", "idx"])
        return kept.append_column("n_best", pa.array(best[at])).append_column("count_sum", pa.array(sums[at]))

    schema = T.StructType([
        *figures.drop("chunk", "idx").schema.fields,
        T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType()),
    ])
    return figures.groupBy("chunk").cogroup(contributions.groupBy("chunk")).applyInArrow(add, schema)
