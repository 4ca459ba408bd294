"""Operator 10, benchmark decontamination by greedy string tiling.

Documents and benchmark items are joined on shared seeds of ``SEED_WORDS``
consecutive words.  An item whose seeds in a document could cover enough of
it is tiled: the longest non-overlapping matches are marked again and again
by running Karp-Rabin, so a passage is recognised whatever the order of its
parts.  A document is contaminated by an item if tiles cover at least
``COVERAGE`` of the item's words.

The benchmark's side of the join is held by every task.  Its words are
counted first: it is dealt row by row into blocks of about ``BLOCK_WORDS``
words, of which the driver and a task hold one at a time; the documents are
read once per block, and a block's result is stored before the next.  No
document is shuffled.

Inputs: null and empty texts match nothing.  Items of fewer than
``SEED_WORDS`` words are too short to be recognised and match nothing.
Repeated documents and repeated items give a row for each pair; a null
doc_id or item_id stays null in the result.  Of tiles of equal length the one
that starts first in the item, then in the document, is taken.  Very long
texts are read whole; a word or passage that a text repeats is looked up once.  Extra columns are ignored
(``overlaps``) or kept (``drop_contaminated``).  Empty tables give no pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemarts.llm.common import ship, stored, union
from lakemarts.llm.tiling_core import SEED_WORDS, Items

#: Share of an item's words that tiles must cover.
COVERAGE = 0.6
#: Benchmark words that a task holds at a time.
BLOCK_WORDS = 2_000_000

_PAIRS = "array<struct<item int, coverage double, tiles array<struct<item_start int, doc_start int, n_words int>>>>"


def _blocks(benchmark: DataFrame, block_words: int) -> list[DataFrame]:
    """The items ``(item_id, text)`` in blocks of about ``block_words``.  Rows
    are dealt one by one, so that equal items do not share a block; they are
    stored with their numbers first, which then stay."""
    words = F.size(F.split(F.coalesce("text", F.lit("")), r"\s+"))
    total = benchmark.agg(F.sum(words)).first()[0] or 0
    n = max(1, math.ceil(total / block_words))
    items = benchmark.select("item_id", "text")
    if n == 1:
        return [items]
    items = stored(items.withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n))), "items")
    return [items.where(F.col("block") == k).select("item_id", "text") for k in range(n)]


def _matches(docs: DataFrame, block: list[tuple], coverage: float, text: Column) -> Column:
    held = docs.sparkSession.sparkContext.broadcast([t for _, t in block])

    @F.pandas_udf(_PAIRS)
    def matches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        items = Items(held.value)
        for texts in batches:
            yield pd.Series(
                [
                    [
                        {
                            "item": k,
                            "coverage": share,
                            "tiles": [{"item_start": i, "doc_start": d, "n_words": n} for i, d, n in tiles],
                        }
                        for k, share, tiles in items.matches(t, coverage)
                    ]
                    for t in texts
                ]
            )

    return matches(text)


def overlaps(
    docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """One row per contaminated document and item: ``doc_id, item_id,
    coverage, tiles``."""
    ship(docs.sparkSession)
    kind = benchmark.schema["item_id"].dataType.simpleString()
    blocks = _blocks(benchmark, block_words)
    found = []
    for rows in blocks:
        block = [tuple(r) for r in rows.collect()]
        pairs = docs.select("doc_id", _matches(docs, block, coverage, F.col("text")).alias("pairs"))
        names = docs.sparkSession.createDataFrame([(k, i) for k, (i, _) in enumerate(block)], f"item int, item_id {kind}")
        one = (
            pairs.select("doc_id", F.explode("pairs").alias("p"))
            .select("doc_id", "p.item", "p.coverage", "p.tiles")
            .join(F.broadcast(names), "item")  # one block's ids
            .select("doc_id", "item_id", "coverage", "tiles")
        )
        # a block is done with before the next one is read
        found.append(stored(one, "overlaps") if len(blocks) > 1 else one)
    return union(found)


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """The documents that no item contaminates; all columns stay."""
    ship(docs.sparkSession)
    blocks = _blocks(benchmark, block_words)
    for rows in blocks:
        block = [tuple(r) for r in rows.collect()]
        docs = docs.where(F.size(_matches(docs, block, coverage, F.col("text"))) == 0)
        if len(blocks) > 1:
            docs = stored(docs, "decontaminated")
    return docs


__all__ = ["BLOCK_WORDS", "COVERAGE", "SEED_WORDS", "drop_contaminated", "overlaps"]
