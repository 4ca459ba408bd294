"""Product codes against full searches with Python's integers."""

import hashlib
import math
import random
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from lakemarts.llm import quantize, quantize_core, queries
from lakemarts.llm.common import table

SF = "/root/testdata/sf0.001"


def plain_nearest(entries, x):
    return min((sum((a - b) ** 2 for a, b in zip(e, x)), i) for i, e in enumerate(entries))


def brute(rows, entries=256, rounds=4):
    """``rows``: (vec_id, vector, label).  The contract, step by step."""
    good = [
        (i, [math.floor(1024 * x) for x in v], label) for i, v, label in rows
        if v and all(x is not None and math.isfinite(x) for x in v)
    ]
    if not good:
        return []
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    good = [r for r in good if len(r[1]) == len(good[0][1])]
    d = len(good[0][1]) // 4
    cut = [[r[1][p * d : (p + 1) * d] for r in good] for p in range(4)]
    books = [own[:entries] for own in cut]
    for _ in range(rounds):
        for p in range(4):
            members = defaultdict(list)
            for x in cut[p]:
                members[plain_nearest(books[p], x)[1]].append(x)
            books[p] = [
                [sum(c) // len(members[i]) for c in zip(*members[i])] if i in members else e
                for i, e in enumerate(books[p])
            ]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    coded, by_label = [], defaultdict(int)
    for n, (i, _, label) in enumerate(good):
        found = [plain_nearest(books[p], cut[p][n]) for p in range(4)]
        error = sum(f[0] for f in found)
        by_label[label] += error
        coded.append((i, "".join(f"{f[1]:02x}" for f in found), error, label))
    return [(i, code, error, by_label[label], digest) for i, code, error, label in coded]


def same(df, expected):
    return sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, expected))


@pytest.mark.parametrize("spread", [1, 3, 1000])
def test_orchard_search_equals_full_search(spread):
    """Ties, equal entries and one entry included; many of them at spread 1."""
    rnd = np.random.default_rng(spread)
    for size in (1, 2, 40):
        entries = rnd.integers(-spread, spread + 1, (size, 4))
        vectors = rnd.integers(-2 * spread, 2 * spread + 1, (300, 4))
        index, distance = quantize_core.Orchard(entries).nearest(vectors)
        full = ((vectors[:, None] - entries[None]) ** 2).sum(axis=2)
        assert (distance == full.min(axis=1)).all() and (index == full.argmin(axis=1)).all()


def test_orchard_search_stops_early():
    """Vectors near an entry of far-apart clusters meet few entries."""
    entries = np.array([[1000 * i, 0] for i in range(50)])
    search = quantize_core.Orchard(entries)
    tried = 0

    class Counted(np.ndarray):
        def __getitem__(self, key):
            nonlocal tried
            tried += np.size(key) if not isinstance(key, int) else 0
            return super().__getitem__(key)

    search.entries = entries.view(Counted)
    index, _ = search.nearest(np.array([[0, 1]] * 10))
    assert (index == 0).all() and tried < 50  # of 500 pairs


SCHEMA = "vec_id long, embedding array<float>, label int, code string, error double"


def test_operator_equals_brute_force(ready):
    rnd = random.Random(2)
    rows = [
        (rnd.choice([None, *range(60)]), [rnd.choice([-0.5, 0.25, 0.0009, rnd.uniform(-2, 2)]) for _ in range(8)],
         rnd.choice([None, 0, 0, 0, 7])) for _ in range(150)
    ]
    rows += rows[:20]
    rows += [
        (-9, None, 1), (-8, [], 1), (-7, [0.0, None] * 4, 1), (-6, [float("nan")] * 8, 1), (-5, [float("inf")] * 8, 1),
        (500, [1.0] * 4, 1),
    ]
    frame = ready.createDataFrame([(*r, "clash", 1.0) for r in rows], SCHEMA).repartition(3)
    for entries in (7, 256):
        assert same(quantize.quantized(frame, entries=entries), brute(rows, entries))
    assert same(quantize.quantized(frame, entries=7, rounds=1, salts=1), brute(rows, 7, 1))


def test_query_equals_brute_force_and_sql(ready):
    rows = [tuple(r) for r in table(ready, SF, "embeddings").select("vec_id", "embedding", "label").collect()]
    out = queries.op13_vector_codes(ready, SF)
    assert same(out, brute(rows))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    assert same(out, con.execute(queries.oracle_sql()["op13_vector_codes"]).fetchall())


def test_edges(ready):
    none = ready.createDataFrame([], SCHEMA)
    assert quantize.quantized(none).collect() == []
    broken = ready.createDataFrame([(1, None, None, "x", 0.0), (2, [], 3, "x", 0.0)], SCHEMA)
    assert quantize.quantized(broken).collect() == []
    equal = [(None, [0.5] * 4, None)] * 5
    frame = ready.createDataFrame([(*r, "x", 0.0) for r in equal], SCHEMA)
    assert same(quantize.quantized(frame), brute(equal))
    with pytest.raises(ValueError, match="equal parts"):
        quantize.quantized(ready.createDataFrame([(1, [1.0] * 6, 0, "x", 0.0)], SCHEMA))
