"""Operator 13, vector codes by product quantization with Orchard search.

Vectors become integers, floor(1024 * x), and are cut into four equal
consecutive parts.  Each part position has a codebook, which starts as that
part of the smallest vec_ids and is refined in rounds: every part goes to its
nearest entry (squared distance, ties to the lower index, see
``quantize_core.Orchard``), every entry becomes the floored mean of its parts.
A last assignment gives the codes.

The integer vectors are stored once.  A round reads them in Arrow batches
against the broadcast codebooks; a task sums what it assigned, at most one row
per codebook entry and task, and Spark adds these up.  The codebooks, bounded
by 256 entries whatever the number of vectors, are all that passes through the
driver.  Label totals are joined back over salts, so a label that holds a
large share of the rows is spread.

Inputs: rows whose vector is null, empty or holds null or non-finite
components are dropped, as are rows whose vector has another length than that
of the smallest vec_id.  That length must be a multiple of four, and
components less than 16,384, or an error says so.  Rows without a vec_id stand
behind all others; ties of vec_id (repeated rows) are ordered by their vector
when the first codebooks are taken, and every row has its own code.  Null
labels are one label.  Fewer than 256 vectors give as many entries.  Other
columns are ignored, whatever their names.  An empty table gives an empty
result.  Vectors are as long as their dimension; there are no texts.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lakemarts.llm import quantize_core as core
from lakemarts.llm.common import ship, stored

ENTRIES = 256
ROUNDS = 4
SALTS = 32

_VALUES = "array<long>"


def _kept(vectors: DataFrame) -> DataFrame:
    """``vec_id, label, v``: integer vectors of usable rows."""
    fields = {f.name: f.dataType for f in vectors.select("vec_id", "label").schema}
    schema = T.StructType([
        T.StructField("vec_id", fields["vec_id"]), T.StructField("label", fields["label"]),
        T.StructField("v", T.ArrayType(T.LongType())),
    ])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("embedding").to_pylist()
            good = [i for i, v in enumerate(rows) if v is not None and None not in v and core.usable(v)]
            out = batch.take(pa.array(good, pa.int64()))
            v = [core.integers([rows[i]])[0].tolist() for i in good]
            yield pa.RecordBatch.from_arrays(
                [out.column("vec_id"), out.column("label"), pa.array(v, arrow.field("v").type)], schema=arrow
            )

    return vectors.select("vec_id", "label", "embedding").mapInArrow(run, schema)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _searches(books: Broadcast) -> list[core.Orchard]:
    return [core.Orchard(np.array(b, dtype=np.int64)) for b in books.value]


def _assigned_sums(vectors: DataFrame, books: Broadcast) -> DataFrame:
    """``part, entry, place, n, total``: what a round assigns, added up; a
    task's rows are bounded by the codebooks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = _searches(books)
        counts = [np.zeros(len(s.entries), dtype=np.int64) for s in searches]
        totals = [np.zeros_like(s.entries) for s in searches]
        for batch in batches:
            if not batch.num_rows:
                continue
            for p, own in enumerate(core.parts(_matrix(batch.column("v")))):
                entry, _ = searches[p].nearest(own)
                counts[p] += np.bincount(entry, minlength=len(counts[p]))
                np.add.at(totals[p], entry, own)
        for p, n in enumerate(counts):
            used = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([p] * len(used), pa.int32()), "entry": pa.array(used, pa.int32()),
                "n": pa.array(n[used], pa.int64()), "total": pa.array(totals[p][used].tolist(), pa.list_(pa.int64())),
            })

    rows = vectors.select("v").mapInArrow(run, f"part int, entry int, n long, total {_VALUES}")
    places = rows.select("part", "entry", "n", F.posexplode("total").alias("place", "total"))
    # exact beyond a long: very many vectors may add up to more
    return places.groupBy("part", "entry", "place").agg(
        F.sum(F.col("n").cast("decimal(38,0)")).alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    )


def codebooks(vectors: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[list[list[int]]]:
    """Entries by part of the stored integer vectors (``vec_id, v``)."""
    spark = vectors.sparkSession
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    books = [b.tolist() for b in core.parts(np.array([r.v for r in first], dtype=np.int64))]
    for _ in range(rounds):
        sums: list[dict] = [defaultdict(lambda: [0, [0] * len(books[0][0])]) for _ in books]
        for r in _assigned_sums(vectors, spark.sparkContext.broadcast(books)).collect():
            own = sums[r.part][r.entry]
            own[0], own[1][r.place] = int(r.n), int(r.total)
        books = [core.replaced(np.array(b, dtype=np.int64), s).tolist() for b, s in zip(books, sums)]
    return books


def digest(books: list[list[list[int]]]) -> str:
    """SHA-256 of all entries' components by part, entry and place."""
    return hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def codes(vectors: DataFrame, books: list[list[list[int]]]) -> DataFrame:
    """``vec_id, label, code, error`` of integer vectors."""
    held = vectors.sparkSession.sparkContext.broadcast(books)
    schema = T.StructType([
        *vectors.select("vec_id", "label").schema.fields, T.StructField("code", T.StringType()),
        T.StructField("error", T.LongType()),
    ])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = _searches(held)
        for batch in batches:
            if not batch.num_rows:
                continue
            found = [s.nearest(p) for s, p in zip(searches, core.parts(_matrix(batch.column("v"))))]
            code = np.stack([f[0] for f in found], axis=1)
            error = sum(f[1] for f in found)
            text = pa.array(["".join(f"{i:02x}" for i in row) for row in code.tolist()], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), text, pa.array(error, pa.int64())], schema=arrow
            )

    return vectors.select("vec_id", "label", "v").mapInArrow(run, schema)


def quantized(
    vectors: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS, salts: int = SALTS
) -> DataFrame:
    """One row per usable vector: ``vec_id, code, error, label_error,
    codebooks_sha256``."""
    ship(vectors.sparkSession)
    kept = stored(_kept(vectors), "vectors")
    smallest = kept.orderBy(F.col("vec_id").asc_nulls_last(), "v").select(F.size("v").alias("n")).first()
    books: list[list[list[int]]] = []
    if smallest is not None:
        if smallest.n % core.PARTS:
            raise ValueError(f"vectors of {smallest.n} components cannot be cut into {core.PARTS} equal parts")
        kept = kept.where(F.size("v") == smallest.n)
        books = codebooks(kept, entries, rounds)
    found = stored(codes(kept, books), "codes")
    totals = found.groupBy("label").agg(F.sum("error").alias("label_error"))
    # a row of a label's total for every salt: a frequent label is as many keys
    salt = F.pmod(F.xxhash64("vec_id", "code"), F.lit(salts))
    every = F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))
    spread = totals.select(F.col("label").alias("of"), "label_error", F.explode(every).alias("s"))
    rows = found.withColumn("salt", salt)
    joined = rows.join(spread, F.col("label").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("s")))
    return joined.select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )
