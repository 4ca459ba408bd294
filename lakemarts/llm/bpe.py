"""Operator 4, byte-level BPE encoding and decoding.

Texts are split by the vocabulary's pattern and every match is merged
separately by ranks, with a segment tree over its byte positions (see
``bpe_core``); there are no special tokens.  Arrow batches go through Python
once to encode and once to decode; nothing is shuffled.  The rank file is read
by the driver and broadcast (about 1 MB).

Inputs: a null text counts as empty; an empty text has no ids and decodes to
no bytes.  Very long texts are merged whole, in time n log n and memory linear
in the longest match of the pattern.  Of pairs that tie for the least rank the
leftmost is merged first.  Repeated rows are encoded each.  A null list of ids
decodes to null.  Rows, ids and other columns
stay as they are; columns named ``ids`` and ``decoded`` are replaced.  An
empty table stays empty.  Ids outside the vocabulary raise an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakemarts.llm import bpe_core
from lakemarts.llm.common import ship


def vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """The rank file, broadcast: a file of the driver or a URL Spark reads."""
    if "://" in path:
        content = bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])
    else:
        content = Path(path).read_bytes()
    return spark.sparkContext.broadcast(content)


def _with(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name != name] + [T.StructField(name, kind)])


def _replaced(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    kept = [f for f in batch.schema.names if f != name]
    return pa.RecordBatch.from_arrays([batch.column(f) for f in kept] + [column], names=[*kept, name])


def _ids(tokenizer: bpe_core.Tokenizer, texts: pa.Array) -> pa.Array:
    found = list(tokenizer.encode_all(t.as_py() for t in texts))
    ends = np.cumsum([0, *map(len, found)])
    if ends[-1] >= 1 << 31:
        raise ValueError("a batch has too many tokens; lower spark.sql.execution.arrow.maxRecordsPerBatch")
    values = np.concatenate(found).astype(np.int32) if found else np.empty(0, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))


def _bytes(tokenizer: bpe_core.Tokenizer, ids: pa.Array) -> pa.Array:
    decoded = [
        None if row.values is None else tokenizer.decode_flat(row.values.to_numpy(zero_copy_only=False)).tobytes()
        for row in ids
    ]
    return pa.array(decoded, pa.binary())


_IDS = T.ArrayType(T.IntegerType())


def encode(docs: DataFrame, ranks: Broadcast, pattern: str, text: str = "text") -> DataFrame:
    """The documents with a column ``ids`` (array of int)."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = bpe_core.loaded(ranks.value, pattern)
        for batch in batches:
            yield _replaced(batch, "ids", _ids(tokenizer, batch.column(text)))

    return docs.mapInArrow(run, _with(docs.schema, "ids", _IDS))


def decode(encoded: DataFrame, ranks: Broadcast, pattern: str, ids: str = "ids") -> DataFrame:
    """The rows with a column ``decoded`` (binary): the bytes of ``ids``."""
    ship(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = bpe_core.loaded(ranks.value, pattern)
        for batch in batches:
            yield _replaced(batch, "decoded", _bytes(tokenizer, batch.column(ids)))

    return encoded.mapInArrow(run, _with(encoded.schema, "decoded", T.BinaryType()))


def round_trip(docs: DataFrame, ranks: Broadcast, pattern: str, text: str = "text") -> DataFrame:
    """The documents with ``ids`` and, from these alone, ``decoded``: both
    steps in one Python worker, which then holds the vocabulary once."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = bpe_core.loaded(ranks.value, pattern)
        for batch in batches:
            ids = _ids(tokenizer, batch.column(text))
            yield _replaced(_replaced(batch, "ids", ids), "decoded", _bytes(tokenizer, ids))

    return docs.mapInArrow(run, _with(_with(docs.schema, "ids", _IDS), "decoded", T.BinaryType()))
