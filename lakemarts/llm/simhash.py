"""Operator 2, SimHash near-dedup by covering locality-sensitive hashing.

Every document gets a 64-bit fingerprint; fingerprints within ``radius``
differing bits are linked, and documents connected by links form a group.
A covering family of bit masks (see ``simhash_core.covering_masks``) puts
every such pair into one bucket of at least one of its 2^(radius+1) - 1
tables, so no link is missed.

Work is done on distinct fingerprints, so exact copies cost one row.  Two
members of a bucket are compared directly.  A bucket of up to ``pair_limit``
members compares all of them; the members of larger ones instead meet at the
points that differ from them in at most radius / 2 bits.  Two fingerprints
are within ``radius`` exactly if they share such a point, so hanging every
fingerprint on the smallest one at each of its points links the same groups
with a number of rows linear in the bucket.

Inputs: null and word-free texts have fingerprint zero and are linked like
any other.  Very long texts are read whole.  A fingerprint bit that is set in
exactly half the shingles is 0; of ids that tie for a group's smallest there
is one value.  Repeated rows keep their rows.  A null doc_id stays null; it is
no candidate for a group's smallest doc_id, so a group without ids has a
null component_id.  Other columns are ignored.  An empty table gives an empty
result.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemarts.llm.common import components, fresh, ship, stored
from lakemarts.llm.simhash_core import covering_masks, fingerprint

SHINGLE_WORDS = 4
RADIUS = 4
#: Members up to which a bucket compares all its pairs.
PAIR_LIMIT = 512


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _simhash(docs: DataFrame, shingle: int) -> Column:
    ship(docs.sparkSession)

    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        found = np.fromiter((fingerprint(t, shingle) for t in texts), dtype=np.uint64, count=len(texts))
        return pd.Series(found.view(np.int64))

    return simhash("text")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``(doc_id, fp)``; ``fp`` holds the 64 bits as a signed long."""
    return docs.select("doc_id", _simhash(docs, shingle).alias("fp"))


def _ball(radius: int, bits: int = 64) -> list[int]:
    """Masks of at most ``radius`` set bits."""
    return [
        _signed(sum(1 << b for b in picked))
        for n in range(radius + 1)
        for picked in itertools.combinations(range(bits), n)
    ]


def links(fps: DataFrame, radius: int = RADIUS, pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """Edges ``(a, b)`` between distinct fingerprints (column ``fp``) that
    connect exactly the pairs within ``radius`` bits of each other."""
    masks = [_signed(m) for m in covering_masks(radius)]
    tables = F.array(*(F.xxhash64(F.lit(t), F.col("fp").bitwiseAND(F.lit(m))) for t, m in enumerate(masks)))
    rows = fps.select("fp", F.explode(tables).alias("bucket"))
    buckets = stored(
        rows.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
        .where("n > 1"),
        "buckets",
    )
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    edges = buckets.where("n = 2").where(near).select("a", "b")
    # a bucket id is a hash; members of two buckets that share one only meet
    # additional candidates, which the bit count rejects
    members = stored(
        rows.join(buckets.where("n > 2").select("bucket", "n"), "bucket").select("bucket", "n", "fp"), "members"
    )
    few = members.where(F.col("n") <= pair_limit)
    pairs = (
        few.select("bucket", F.col("fp").alias("a"))
        .join(few.select("bucket", F.col("fp").alias("b")), "bucket")
        .where((F.col("a") < F.col("b")) & near)
        .select("a", "b")
    )
    many = members.where(F.col("n") > pair_limit).select("fp").distinct()
    edges = edges.unionByName(pairs)
    if not many.isEmpty():
        points = F.array(*(F.lit(m) for m in _ball(radius // 2)))
        at = many.select("fp", F.explode(points).alias("flip")).select(
            "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("point")
        )
        centres = at.groupBy("point").agg(F.min("fp").alias("b"), F.max("fp").alias("top")).where("b < top")
        edges = edges.unionByName(
            at.join(centres, "point").where("fp <> b").select(F.col("fp").alias("a"), "b")
        )
    return edges.distinct()


def simhash_components(
    docs: DataFrame, shingle: int = SHINGLE_WORDS, radius: int = RADIUS, pair_limit: int = PAIR_LIMIT
) -> DataFrame:
    """One row per document: ``doc_id, fp, component_id``."""
    if radius % 2:
        raise ValueError("radius must be even")
    fps = stored(fingerprints(docs, shingle), "fingerprints")
    classes = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
    groups = components(links(classes.select("fp"), radius, pair_limit))
    linked = classes.join(groups.withColumnRenamed("node", "fp"), "fp")
    smallest = linked.groupBy("label").agg(F.min("first_id").alias("component_id"))
    of_group = linked.join(smallest, "label").select("fp", "component_id", F.lit(True).alias("is_linked"))
    # a linked class without ids in a group without ids keeps the null
    of_class = classes.join(of_group, "fp", "left").select(
        "fp", F.when(F.col("is_linked"), F.col("component_id")).otherwise(F.col("first_id")).alias("component_id")
    )
    return fps.join(of_class, "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, **parameters) -> DataFrame:
    """The documents with one of each group: the row of the smallest doc_id;
    of rows that repeat this id, and of a group without ids, one row."""
    found = simhash_components(docs, **parameters)
    kept = found.where("doc_id = component_id").select("doc_id").distinct()
    rows = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    # documents without an id: one per group that has no id at all
    nameless = docs.where("doc_id is null")
    if not nameless.isEmpty():
        orphans = found.where("component_id is null").groupBy("fp").agg(F.lit(1).alias("one")).select("fp")
        groups = components(links(orphans))
        rest = orphans.join(groups.withColumnRenamed("node", "fp"), "fp", "left").where(
            F.col("label").isNull() | (F.col("label") == F.col("fp"))
        )
        fp = fresh(docs, "_fp")
        unnamed = nameless.withColumn(fp, _simhash(docs, parameters.get("shingle", SHINGLE_WORDS))).join(
            rest.select(F.col("fp").alias(fp)), fp, "left_semi"
        )
        rows = rows.unionByName(unnamed.dropDuplicates([fp]).select(*docs.columns))
    return rows.select(*docs.columns)
