"""Operator 3, embedding near-dedup by sorted projection passes.

Equal vectors are one class.  In each pass the classes are ordered by the
concatenated bits of random hyperplane hashes (and by class where they tie),
and every class is compared, by cosine in double precision, with its
``WINDOW`` neighbours on either side.  The links of all passes are united.
The hyperplanes cut what is left of unit vectors without their common
direction (the mean): embeddings often lie in a cone, and signs of whole
vectors would all but agree there.

The order is global: one sort gives the ranks of all passes, and blocks of
consecutive ranks, each with the first ``WINDOW`` rows of the next one, are
compared as matrices.  A block knows its rows' ranks in all passes, so a pair
is counted only in the first pass whose window holds it: links are counted
without being listed, and a block returns at most a row per class.

The number of passes follows the number of classes and how far they spread
around their mean, so that a pair at the threshold meets in some window with
probability ``RECALL`` where the vectors lie evenly (``passes_for``,
``residual_cosine``).  In a dense group a window is full before it
holds all partners.  So every class that the windows link to ``window *
CROWDED`` others or more is crowded, and is compared with all classes that can
link to it: pivots are taken until each crowded class is within the threshold's
angle of one, which is its home; all its partners are within twice that angle
of the home.  These pairs are compared in blocks, and those that no window
held are added: the links of crowded classes are exact.  A group's own pairs
are all compared, and every class once with every pivot.

Inputs: vectors that are null, empty or zero, or hold null or non-finite
components, link with nothing; vectors of other lengths never link.  Repeated
rows are vectors of their own, and cosines that tie with the threshold are
links.  The driver holds a mean for each length that occurs.  A null vec_id stays null and is no smallest
id.  Extra columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemarts.llm.common import components, ship, stored

COSINE = 0.95
WINDOW = 512
BLOCK = 2048
#: Share of a window's size from which the links of a class are crowded.
CROWDED = 0.25
#: Uncovered crowded vectors looked at by the driver at a time, for pivots.
SAMPLE = 1000
#: Classes of a side in a block of crowded pairs.
SIDE = 4096
#: Allowance for rounding where vectors are only chosen to be compared.
SLACK = 1e-6
#: Probability that a pair at the threshold meets in a window.
RECALL = 0.995
LEAST_PASSES = 8
#: Cosine beside the mean that passes are counted for at least.
LEAST_COSINE = 0.3
#: Bits of a pass's sort key.
BITS = 62
SEED = 20_260


def passes_for(n: int, cosine: float = COSINE, window: int = WINDOW, recall: float = RECALL) -> int:
    """Passes for ``n`` vectors: about log2(n / window) leading bits have to
    agree for a pair to share a window, each with probability
    1 - angle / pi."""
    bits = math.log2(max(1.0, n / window))
    agree = (1 - math.acos(cosine) / math.pi) ** bits
    if agree >= 1:
        return LEAST_PASSES
    return max(LEAST_PASSES, math.ceil(math.log(1 - recall) / math.log(1 - agree)))


def residual_cosine(cosine: float, spread: float) -> float:
    """The cosine of what a pair at the threshold has beside the mean, for
    vectors whose mean squared distance from it is ``spread``; at least
    ``LEAST_COSINE``, since in a narrower cone a vector has so many partners
    that its windows make it crowded."""
    return max(LEAST_COSINE, 1 - (1 - cosine) / max(spread, 1e-12))


def _means(classes: DataFrame) -> dict[int, np.ndarray]:
    """By vector length, the mean of the classes' unit vectors.  A task sums
    its rows; a mean of each length is all that reaches the driver."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, list] = {}
        for batch in batches:
            for size, rows in batch.groupby(batch["embedding"].map(len)):
                held = sums.setdefault(size, [0, np.zeros(size)])
                held[0] += len(rows)
                held[1] += _unit(rows["embedding"]).sum(axis=0)
        if sums:
            yield pd.DataFrame([(size, n, total.tolist()) for size, (n, total) in sums.items()], columns=["size", "n", "total"])

    parts = classes.select("embedding").mapInPandas(run, "size int, n long, total array<double>")
    places = parts.select("size", "n", F.posexplode("total").alias("place", "x"))
    mean = F.sum("x") / F.sum("n")
    rows = places.groupBy("size", "place").agg(F.round(mean, 9).alias("x")).groupBy("size").agg(
        F.array_sort(F.collect_list(F.struct("place", "x"))).getField("x").alias("mean")
    )
    return {r["size"]: np.array(r["mean"]) for r in rows.collect()}


def _planes(size: int, passes: int) -> np.ndarray:
    return np.random.default_rng([SEED, size]).standard_normal((size, passes * BITS))


def _keys(classes: DataFrame, passes: int, means: dict[int, np.ndarray]) -> DataFrame:
    """``(pass, key, cid)``: the sort key of every class in every pass."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        planes: dict[int, np.ndarray] = {}
        weights = np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64)
        for batch in batches:
            sizes = batch["embedding"].map(len)
            for size, rows in batch.groupby(sizes):
                if size not in planes:
                    planes[size] = _planes(size, passes)
                x = _unit(rows["embedding"]) - means[size]
                bits = (x @ planes[size] > 0).reshape(len(x), passes, BITS)
                keys = bits.astype(np.int64) @ weights
                yield pd.DataFrame(
                    {
                        "pass": np.tile(np.arange(passes, dtype=np.int32), len(x)),
                        "key": keys.ravel(),
                        "cid": np.repeat(rows["cid"].to_numpy(), passes),
                    }
                )

    return classes.select("cid", "embedding").mapInPandas(run, "pass int, key long, cid long")


def _ranks(keys: DataFrame, n: int) -> DataFrame:
    """``(cid, ranks)``: the place of every class in the order of each pass."""
    part = F.spark_partition_id()
    # the order within a partition has to stay when a task is run again, so it is stored with its numbers
    rows = (
        keys.repartitionByRange("pass", "key", "cid").sortWithinPartitions("pass", "key", "cid")
        .select("pass", "cid", part.alias("part"), F.monotonically_increasing_id().alias("id"))
    )
    rows = stored(rows, "order")
    # the id counts within a partition from partition << 33
    local = F.col("id").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = rows.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    before = F.coalesce(
        F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    offsets = sizes.select("part", before.alias("before"))  # a row per partition
    placed = rows.join(F.broadcast(offsets), "part").select(
        "cid", "pass", (F.col("before") + local - F.col("pass") * F.lit(n)).alias("rank")
    )
    pairs = F.array_sort(F.collect_list(F.struct("pass", "rank")))
    return placed.groupBy("cid").agg(pairs.getField("rank").alias("ranks"))


def _smallest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest row connected with each of ``n`` rows by the pairs."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _unit(vectors) -> np.ndarray:
    """Vectors of one length as rows of length 1."""
    x = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    x /= np.abs(x).max(axis=1)[:, None]  # against overflow and underflow of squares
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    return x


_FOUND = "cid long, links long, degree long, to long"


def _block_links(rows: pd.DataFrame, cosine: float, window: int, block: int) -> pd.DataFrame:
    """Links of one block of one pass: ``(cid, links, degree, to)``, the degree
    being the links without the copies."""
    p = int(rows["pass"].iloc[0])
    ranks = np.stack(rows["ranks"].to_list())
    order = np.argsort(ranks[:, p], kind="stable")
    ranks = ranks[order]
    own = int((ranks[:, p] // block == int(rows["block"].iloc[0])).sum())
    cid, n = rows["cid"].to_numpy()[order], rows["n"].to_numpy()[order]
    vectors = [np.asarray(v, dtype=np.float64) for v in rows["embedding"].to_numpy()[order]]
    sizes = np.array([len(v) for v in vectors])
    firsts, seconds = [], []
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        x = _unit([vectors[i] for i in at])
        for k in range(0, len(at), 256):
            i, j = np.nonzero(x[k : k + 256] @ x.T >= cosine)
            i, j = at[i + k], at[j]
            keep = (i < own) & (j > i) & (j - i <= window)
            firsts.append(i[keep])
            seconds.append(j[keep])
    i, j = np.concatenate(firsts), np.concatenate(seconds)
    # pairs that an earlier pass's window holds were counted there
    new = np.ones(len(i), dtype=bool)
    for q in range(p):
        new &= np.abs(ranks[i, q] - ranks[j, q]) > window
    links = np.bincount(i[new], n[j[new]], len(cid)) + np.bincount(j[new], n[i[new]], len(cid))
    degree = np.bincount(i[new], minlength=len(cid)) + np.bincount(j[new], minlength=len(cid))
    to = _smallest(len(cid), i, j)
    linked = np.flatnonzero((links > 0) | (to != np.arange(len(cid))))
    return pd.DataFrame(
        {"cid": cid[linked], "links": links[linked].astype(np.int64), "degree": degree[linked], "to": cid[to[linked]]}
    )


Pivots = dict[int, tuple[np.ndarray, np.ndarray]]


def _uncovered(pivots, cosine: float):
    """A function of vectors: whether no pivot is within the angle."""

    @F.pandas_udf("boolean")
    def uncovered(vectors: pd.Series) -> pd.Series:
        out = np.ones(len(vectors), dtype=bool)
        sizes = vectors.map(len).to_numpy()
        for size in np.unique(sizes):
            if size in pivots.value:
                at = np.flatnonzero(sizes == size)
                out[at] = (_unit(vectors.iloc[at]) @ pivots.value[size][1].T).max(axis=1) < cosine - SLACK
        return pd.Series(out)

    return uncovered


def _pivots(crowded: DataFrame, cosine: float) -> Pivots:
    """By vector length: numbers and unit vectors of pivots, such that every
    crowded class is within the threshold's angle of one."""
    spark = crowded.sparkSession
    held: Pivots = {}
    rest, n = crowded, 0
    while True:
        sample = [r.embedding for r in rest.select("embedding").limit(SAMPLE).collect()]
        if not sample:
            return held
        for size in {len(v) for v in sample}:
            new: list[np.ndarray] = []  # the first one always: no earlier pivot covers it
            for v in _unit([v for v in sample if len(v) == size]):
                if not new or (np.stack(new) @ v).max() < cosine - SLACK:
                    new.append(v)
            ids, units = held.get(size, (np.empty(0, dtype=np.int64), np.empty((0, size))))
            held[size] = np.append(ids, np.arange(n, n + len(new))), np.concatenate([units, new])
            n += len(new)
        rest = crowded.where(_uncovered(spark.sparkContext.broadcast(held), cosine)("embedding"))


def _near_pivots(placed: DataFrame, pivots: Pivots, cosine: float) -> DataFrame:
    """``placed`` once for every pivot that a partner of it may have as its
    home, with ``home``: whether it is a crowded class of this home."""
    held = placed.sparkSession.sparkContext.broadcast(pivots)
    least = math.cos(min(math.pi, 2 * math.acos(min(1.0, max(-1.0, cosine))))) - 10 * SLACK

    @F.pandas_udf("struct<home long, near array<long>>")
    def near(vectors: pd.Series) -> pd.DataFrame:
        home, lists = np.full(len(vectors), -1), [[] for _ in range(len(vectors))]
        sizes = vectors.map(len).to_numpy()
        for size in np.unique(sizes):
            if size not in held.value:
                continue
            ids, units = held.value[size]
            at = np.flatnonzero(sizes == size)
            cosines = _unit(vectors.iloc[at]) @ units.T
            home[at] = ids[cosines.argmax(axis=1)]
            for k, row in zip(at, cosines):
                lists[k] = ids[row >= least].tolist()
        return pd.DataFrame({"home": home, "near": lists})

    return (
        placed.withColumn("at", near("embedding")).select("*", F.explode("at.near").alias("pivot"))
        .withColumn("home", F.col("crowded") & (F.col("at.home") == F.col("pivot"))).drop("at")
    )


def _side_links(rows: pd.DataFrame, cosine: float, window: int) -> pd.DataFrame:
    """Links of one block of crowded classes with classes near their home,
    counted where no window held the pair: ``(cid, links, degree, to)``.  The
    link of two crowded classes is counted for each at its own home."""
    first = rows["first"].to_numpy()
    x, y = rows[first], rows[~first]
    if not len(x) or not len(y):
        return pd.DataFrame({"cid": [], "links": [], "degree": [], "to": []}, dtype=np.int64)
    a, b = _unit(x["embedding"]), _unit(y["embedding"])
    x_cid, y_cid, x_n, y_n = (c.to_numpy() for c in (x["cid"], y["cid"], x["n"], y["n"]))
    x_ranks, y_ranks = (np.stack(c["ranks"].to_list()).T for c in (x, y))
    hit = np.empty((len(x), len(y)), dtype=bool)
    links, degree = np.zeros(len(rows), dtype=np.int64), np.zeros(len(rows), dtype=np.int64)
    for k in range(0, len(x), 256):
        some = slice(k, k + 256)
        hit[some] = (a[some] @ b.T >= cosine) & (x_cid[some, None] != y_cid)
        new = hit[some].copy()
        for p, q in zip(x_ranks, y_ranks):
            new &= np.abs(p[some, None] - q) > window
        links[: len(x)][some] = np.where(new, y_n, 0).sum(axis=1)
        degree[: len(x)][some] = new.sum(axis=1)
        links[len(x) :] += np.where(new, x_n[some, None], 0).sum(axis=0)
        degree[len(x) :] += new.sum(axis=0)
    own = len(x) + np.flatnonzero(y["crowded"].to_numpy())
    links[own] = degree[own] = 0
    # the smallest row connected with each row
    none = len(rows)
    to = np.arange(none)
    while True:
        before = to.copy()
        up = np.array([np.where(h, to[len(x) :], none).min() for h in hit])
        to[: len(x)] = np.minimum(to[: len(x)], up)
        for k, h in enumerate(hit):
            np.minimum(to[len(x) :], to[k], out=to[len(x) :], where=h)
        if (to == before).all():
            break
    cid = np.concatenate([x_cid, y_cid])
    linked = np.flatnonzero((links > 0) | (to != np.arange(none)))
    return pd.DataFrame({"cid": cid[linked], "links": links[linked], "degree": degree[linked], "to": cid[to[linked]]})


def _crowded_links(placed: DataFrame, found: DataFrame, cosine: float, window: int, side: int) -> DataFrame | None:
    """The links of crowded classes that no window held, as ``found`` has
    those of the windows; ``None`` where no class is crowded."""
    crowded = stored(
        found.groupBy("cid").agg(F.sum("degree").alias("degree"))
        .where(F.col("degree") >= max(1, window * CROWDED)).select("cid", F.lit(True).alias("crowded")), "crowded",
    )
    if crowded.isEmpty():
        return None
    placed = stored(
        placed.join(crowded, "cid", "left").withColumn("crowded", F.coalesce("crowded", F.lit(False))), "placed"
    )
    pivots = _pivots(placed.where("crowded").select("embedding"), cosine)
    near = stored(_near_pivots(placed, pivots, cosine), "near")
    sides = near.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / side).cast("int").alias("sides"))
    dealt = near.join(sides, "pivot").withColumn("own", F.pmod(F.xxhash64("cid"), F.col("sides")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("sides") - 1))
    columns = ["pivot", "cid", "n", "embedding", "ranks", "crowded"]
    firsts = dealt.where("home").select(*columns, F.lit(True).alias("first"), F.col("own").alias("i"), every.alias("j"))
    seconds = dealt.select(*columns, F.lit(False).alias("first"), F.col("own").alias("j"), every.alias("i"))
    return stored(
        firsts.unionByName(seconds).groupBy("pivot", "i", "j")
        .applyInPandas(lambda rows: _side_links(rows, cosine, window), _FOUND), "crowd",
    )


def near_vectors(
    vectors: DataFrame, cosine: float = COSINE, window: int = WINDOW, block: int = BLOCK, passes: int | None = None,
    side: int = SIDE,
) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``."""
    if block < window:
        raise ValueError("a block holds a window at least")
    ship(vectors.sparkSession)
    e = F.col("embedding")
    finite = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = e.isNotNull() & (F.size(e) > 0) & finite & F.exists(e, lambda v: v != 0)
    rows = vectors.select(
        "vec_id", e.cast("array<double>").alias("embedding"), F.coalesce(usable, F.lit(False)).alias("usable")
    )
    # two independent hashes of the components name a class
    same = [F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(1), "embedding").alias("h2")]
    members = stored(rows.where("usable").select("vec_id", *same), "members")
    classes = stored(
        rows.where("usable").select("vec_id", "embedding", *same).groupBy("h1", "h2")
        .agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("n"), F.first("embedding").alias("embedding"))
        .withColumn("cid", F.monotonically_increasing_id()),
        "classes",
    )
    n = classes.count()
    means = _means(classes)
    if passes is None:
        spreads = [1 - float(m @ m) for m in means.values()]
        passes = max((passes_for(n, residual_cosine(cosine, s), window) for s in spreads), default=LEAST_PASSES)
    ranks = _ranks(_keys(classes, passes, means), n)
    placed = classes.select("cid", "n", "embedding").join(ranks, "cid")
    by_pass = placed.select("*", F.posexplode("ranks").alias("pass", "rank"))
    home = F.floor(F.col("rank") / block)
    # the first rows of a block also end the block before
    blocks = F.when(
        (F.col("rank") % block < window) & (home > 0), F.array(home, home - 1)
    ).otherwise(F.array(home))
    found = stored(
        by_pass.select("cid", "n", "embedding", "ranks", "pass", F.explode(blocks).alias("block"))
        .groupBy("pass", "block")
        .applyInPandas(lambda rows: _block_links(rows, cosine, window, block), _FOUND),
        "links",
    )
    crowd = _crowded_links(placed, found, cosine, window, side)
    if crowd is not None:
        found = found.unionByName(crowd)
    counted = found.groupBy("cid").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("cid").alias("a"), F.col("to").alias("b")))
    of_class = (
        classes.select("h1", "h2", "cid", "first_id", "n").join(counted, "cid", "left")
        .join(groups.withColumnRenamed("node", "cid"), "cid", "left")
        .withColumn("label", F.coalesce("label", "cid"))
    )
    smallest = of_class.groupBy("label").agg(F.min("first_id").alias("component_id"))
    named = of_class.join(smallest, "label").select(
        "h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"
    )
    linked = members.join(named, ["h1", "h2"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("not usable").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    )
