"""The operators on Spark: brute force on small tables, and defined results
for nulls, empty and very long texts, repeated rows, clashing names and empty
tables."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from lakemarts.llm import (
    bpe, chat, decontaminate, embeddings, langid, langid_core, licenses, licenses_core, pii, pii_core, queries, simhash, simhash_core, substring,
    toxicity,
)
from lakemarts.llm import tiling_core
from lakemarts.llm.common import components, table
from test_cores import plain_overlaps

SF = "/root/testdata/sf0.001"


def rows(df):
    return [tuple(r) for r in df.collect()]


def union_find(nodes, edges):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def words_text(rnd, n, size=5):
    return " ".join("".join(rnd.choice("abcdefghijkl") for _ in range(size)) for _ in range(n))


def test_components(ready):
    rnd = random.Random(1)
    edges = [(rnd.randint(0, 60), rnd.randint(0, 60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 130)]
    edges += [(7, 7), (3, 4), (4, 3)]
    got = dict(rows(components(ready.createDataFrame(edges, "a long, b long"))))
    real = [(a, b) for a, b in edges if a != b]
    assert got == union_find({n for e in real for n in e}, real)
    assert rows(components(ready.createDataFrame([], "a long, b long"))) == []


# --- 1, substring dedup ------------------------------------------------------


def test_repeated_passages_are_found_and_others_are_not(ready):
    rnd = random.Random(11)
    passage, common = words_text(rnd, 60), words_text(rnd, 8)
    docs = [(i, f"{words_text(rnd, 80)} {passage} {words_text(rnd, 40)}") for i in range(40)]  # frequent
    docs += [(100 + i, f"{words_text(rnd, 90)} {common} {words_text(rnd, 90)}") for i in range(40)]  # a line only
    copy = words_text(rnd, 70)
    docs += [(200, copy), (201, copy), (202, copy.upper() + " tail")]
    edited = passage.split()
    edited[30] = "edited"
    docs += [(300, words_text(rnd, 20) + " " + " ".join(edited)), (301, words_text(rnd, 49))]
    found = rows(substring.repeated_passages(ready.createDataFrame(docs, "doc_id long, text string")))
    by_doc = defaultdict(list)
    for doc_id, start, end, passage_id, first, n in found:
        by_doc[doc_id].append((start, end, passage_id, first, n))
    assert set(by_doc) == {*range(40), 200, 201, 202, 300}
    assert all(by_doc[i][0][:2] == (80, 140) and by_doc[i][0][3:] == (0, 41) for i in range(40))
    assert by_doc[300][0][2] == by_doc[0][0][2]
    assert [by_doc[i][0][3:] for i in (200, 201, 202)] == [(200, 3)] * 3


def test_classes_left_after_the_last_round_are_paired(ready):
    # two texts share a passage; every half of it is also in decoys, which
    # have no whole passage of it and smaller class numbers
    passage = [f"w{i}" for i in range(60)]

    def variants(body, n=25):
        edge = lambda v, side: [f"{len(body)}{body[0]}{side}{v}y{i}" for i in range(30)]
        texts = [" ".join(edge(v, "l") + body + edge(v, "r")) for v in range(n)]
        frame = ready.createDataFrame([(t,) for t in texts], "text string").select(F.xxhash64("text").alias("h"), "text")
        return sorted(map(tuple, frame.collect()))

    pair = variants(passage)[-2:]
    decoys = [v for at in range(0, 21, 5) for v in variants(passage[at:at + 40]) if v < pair[0]]
    texts = [t for _, t in pair + decoys]
    docs = ready.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = rows(substring.repeated_passages(docs, pair_limit=1, rounds=1).select("doc_id", "first_doc_id", "n_documents"))
    assert sorted(found) == [(0, 0, 2), (1, 0, 2)]


def test_a_text_that_links_only_to_one_already_linked_is_found(ready):
    # every copy differs from the text in one word, and from one another in
    # two, which is too much; the copies that all texts are first compared
    # with are not the text itself
    passage = [f"w{i}" for i in range(60)]

    def variants(at, n=25):
        body = [f"new{at}" if i == at else w for i, w in enumerate(passage)]
        edge = lambda v, side: [f"{at}{side}{v}y{i}" for i in range(30)]
        texts = [" ".join(edge(v, "l") + body + edge(v, "r")) for v in range(n)]
        frame = ready.createDataFrame([(t,) for t in texts], "text string").select(F.xxhash64("text").alias("h"), "text")
        return sorted(map(tuple, frame.collect()))

    text, last = variants(None)[-1], variants(30)[-1]
    copies = [v for at in (10, 14, 45, 49) for v in variants(at)[:6]]
    assert max(copies) < min(text, last)
    docs = ready.createDataFrame(list(enumerate(t for _, t in [*copies, text, last])), "doc_id long, text string")
    found = rows(substring.repeated_passages(docs, pair_limit=1).select("doc_id", "first_doc_id", "n_documents"))
    assert sorted(found) == [(i, 0, 26) for i in range(26)]


def test_common_lines_alone_leave_no_segment(ready):
    rnd = random.Random(17)
    line, passage = words_text(rnd, 20), words_text(rnd, 60)
    texts = [(i, f"{words_text(rnd, 80)} {line} {words_text(rnd, 80)}") for i in range(40)]
    texts += [(100 + i, f"{words_text(rnd, 30)} {passage} {line} {words_text(rnd, 9)}") for i in range(2)]
    texts = ready.createDataFrame(texts, "cid long, text string")
    for words in (100, 5 * substring.CHUNK_WORDS):  # in one chunk, and in five
        found = rows(substring._segments(texts, words, 50).select("cid", "spans"))
        assert sorted((cid, list(spans)) for cid, spans in found) == [(100, [30, 106]), (101, [30, 106])]


def test_classes_of_one_passage_class_are_not_paired_over_a_common_line(ready):
    rnd = random.Random(18)
    line = words_text(rnd, 20)
    bodies = [words_text(rnd, 60) for _ in range(2)]  # two classes of texts, all with the line
    texts = ready.createDataFrame(
        [(10 * k + i, f"{bodies[k]} {line} {words_text(rnd, 30)}") for k in range(2) for i in range(3)],
        "cid long, text string",
    )
    segments = substring._segments(texts, 100, 50)
    rest = [(1, 10 * k + i, place, 60 + place) for k in range(2) for i in range(3) for place in (5, 9)]
    rest = ready.createDataFrame(rest, "side long, cid long, place long, at int")
    links = [(10 * k, 10 * k + i, 0, 80, 0, 80) for k in range(2) for i in (1, 2)]
    links = ready.createDataFrame(links, "a long, b long, a_start int, a_end int, b_start int, b_end int")
    labelled = substring._labelled(rest, links)
    assert sorted(rows(labelled.select("cid", "label").distinct())) == [(10 * k + i, 10 * k) for k in range(2) for i in range(3)]
    assert rows(substring._connectable(labelled, segments, 50)) == []
    # without the links, each text's own body may connect it
    alone = rows(substring._connectable(substring._labelled(rest, links.limit(0)), segments, 50).select("cid", "place"))
    assert sorted(alone) == sorted((10 * k + i, place) for k in range(2) for i in range(3) for place in (5, 9))


def test_repeated_passages_edges(edge_docs, no_docs):
    found = rows(substring.repeated_passages(edge_docs).select("doc_id", "first_doc_id", "n_documents"))
    assert set(found) == {(6, 6, 2)} and len(found) == 2  # the long text, which is there twice
    assert rows(substring.repeated_passages(no_docs)) == []


# --- 2, SimHash --------------------------------------------------------------


@pytest.mark.parametrize("pair_limit", [512, 2])
def test_simhash_components_equal_brute_force(ready, pair_limit):
    docs = table(ready, SF, "documents")
    got = {r.doc_id: (r.fp, r.component_id) for r in simhash.simhash_components(docs, pair_limit=pair_limit).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    fps = {i: simhash_core.fingerprint(t) for i, t in texts.items()}
    ids = sorted(fps)
    edges = [(a, b) for k, a in enumerate(ids) for b in ids[:k] if (fps[a] ^ fps[b]).bit_count() <= 4]
    assert {i: c for i, (_, c) in got.items()} == union_find(ids, edges)
    assert all(f & (1 << 64) - 1 == fps[i] for i, (f, _) in got.items())


def test_simhash_links_of_dense_buckets(ready):
    rnd = random.Random(5)
    centres = [rnd.getrandbits(64) for _ in range(6)]
    fps = sorted({c ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 3))) for c in centres for _ in range(40)})
    frame = ready.createDataFrame([(simhash._signed(f),) for f in fps], "fp long")
    want = union_find(fps, [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 4])
    for limit in (3, 512):
        label = dict(rows(components(simhash.links(frame, pair_limit=limit))))
        groups = defaultdict(set)
        for f in fps:
            groups[label.get(simhash._signed(f), simhash._signed(f))].add(f)
        wanted = defaultdict(set)
        for f, c in want.items():
            wanted[c].add(f)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_simhash_edges(edge_docs, no_docs):
    got = defaultdict(list)
    for doc_id, fp, component in rows(simhash.simhash_components(edge_docs)):
        got[doc_id].append((fp, component))
    assert {i: got[i] for i in (1, 2, 3)} == {1: [(0, 1)], 2: [(0, 1)], 3: [(0, 1)]}  # no words: zero, linked
    assert [c for _, c in got[6]] == [6, 6] and got[7][0][1] == got[8][0][1] == 7
    assert len(got[None]) == 2 and (0, 1) in got[None]
    kept = simhash.keep_first(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert sorted(i for i in ids if i) == [1, 4, 5, 6, 7, 9, 10] and ids.count(None) == 1  # "no id" has no other
    assert rows(simhash.simhash_components(no_docs)) == rows(simhash.keep_first(no_docs)) == []


# --- 3, embeddings -----------------------------------------------------------


def test_vectors_equal_brute_force(ready):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((60, 16))
    x = np.concatenate([base, base[:20] + 0.05 * rng.standard_normal((20, 16)), base[:5], np.repeat(base[:1], 30, 0),
                        base[7] + 0.02 * rng.standard_normal((80, 16))]).astype(np.float32)
    data = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(1000, None), (1001, []), (1002, [0.0] * 16), (1003, [float("nan")] * 16), (1004, [1.0] * 3),
           (1005, [float("inf")] + [0.0] * 15), (None, x[0].tolist()), (0, x[0].tolist()), (1006, [None] * 16)]
    frame = ready.createDataFrame([(i, v, 1, 2) for i, v in data + odd], "vec_id long, embedding array<float>, n int, cid int")
    vectors = [(i, np.array(v, dtype=float)) for i, v in data + odd[6:8]]
    unit = np.stack([v / np.linalg.norm(v) for _, v in vectors])
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    comp = union_find(range(len(unit)), zip(*np.nonzero(linked)))
    smallest = defaultdict(lambda: 10**9)
    for k, c in comp.items():
        smallest[c] = min(smallest[c], vectors[k][0] if vectors[k][0] is not None else 10**9)
    want = sorted(((i if i is not None else -1), int(linked[k].sum()), smallest[comp[k]]) for k, (i, _) in enumerate(vectors))
    for window, block in ((512, 2048), (64, 64)):
        got = rows(embeddings.near_vectors(frame, window=window, block=block, passes=24))
        alone = {r[0]: r[1:] for r in got if r[0] is not None and r[0] >= 1000}
        assert alone == {i: (0, i, True) for i in range(1000, 1007)}
        rest = sorted(((i if i is not None else -1), n, c) for i, n, c, _ in got if i is None or i < 1000)
        assert rest == want
        assert all(kept == (i == c) for i, _, c, kept in got)
    assert rows(embeddings.near_vectors(frame.where("false"))) == []


@pytest.mark.parametrize("side", [4096, 150])
def test_links_of_dense_groups_are_exact(ready, side):
    rng = np.random.default_rng(8)
    centre = rng.standard_normal((2, 32))
    x = np.concatenate([
        rng.standard_normal((300, 32)), centre[0] + 0.15 * rng.standard_normal((900, 32)),
        centre[1] + 0.28 * rng.standard_normal((500, 32)),  # only a part of its pairs link
    ])
    x = np.concatenate([x, x[400:410]])
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    comp = union_find(range(len(x)), zip(*(a.tolist() for a in np.nonzero(linked))))
    frame = ready.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = rows(embeddings.near_vectors(frame, window=32, block=256, passes=8, side=side))
    assert {i: (n, c) for i, n, c, _ in got} == {i: (int(linked[i].sum()), comp[i]) for i in range(len(x))}


def test_links_in_a_cone(ready):
    """Vectors that share a direction, median cosine about 0.9: what the
    windows lose stays under one in a hundred links."""
    rnd = np.random.default_rng(8)
    n, size = 4000, 64
    x = rnd.standard_normal((n, size)) / 8 * 0.32
    x[:, 0] += 1
    x[: n // 8] += rnd.standard_normal((n // 8, size)) / 8 * 0.05 + x[n // 8 : n // 4] - x[: n // 8]
    x /= np.linalg.norm(x, axis=1)[:, None]
    cosines = x @ x.T
    assert 0.88 < np.median(cosines) < 0.93
    linked = cosines >= 0.95
    np.fill_diagonal(linked, False)
    frame = ready.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in embeddings.near_vectors(frame, window=64, block=512).collect()}
    assert all(got[i] <= linked[i].sum() for i in range(n))  # exact checks: none too many
    assert sum(got.values()) >= 0.99 * linked.sum() > 1000
    assert embeddings.residual_cosine(0.95, 1.0) == 0.95 and embeddings.residual_cosine(0.95, 0.01) == 0.3


def test_more_vectors_need_more_passes():
    assert embeddings.passes_for(0) == embeddings.passes_for(500) == embeddings.LEAST_PASSES
    counts = [embeddings.passes_for(10**k) for k in range(3, 10)]
    assert counts == sorted(counts) and counts[-1] > counts[0]


# --- 4, byte-level BPE -------------------------------------------------------


def test_bpe_query_equals_the_reference_library(ready):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        import base64

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text for r in table(ready, SF, "documents").collect()}
    got = rows(queries.op4_byte_bpe(ready, SF))
    assert len(got) == len(texts)
    for doc_id, n, ids_sha, decoded_sha in got:
        ids = own.encode_ordinary(texts[doc_id])
        assert n == len(ids) and ids_sha == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert decoded_sha == hashlib.sha256(texts[doc_id].encode()).hexdigest()


def test_bpe_edges(ready, edge_docs, no_docs):
    ranks = bpe.vocabulary(ready, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    clash = edge_docs.withColumn("ids", F.lit("x")).withColumn("decoded", F.lit(1))
    out = bpe.decode(bpe.encode(clash, ranks, public_tokenizers.PATTERN), ranks, public_tokenizers.PATTERN)
    assert set(out.columns) == set(clash.columns) and out.count() == edge_docs.count()
    assert out.where("decoded <> encode(coalesce(text, ''), 'utf-8')").count() == 0
    assert {(r.doc_id, r.n) for r in out.select("doc_id", F.size("ids").alias("n")).where("doc_id < 3").collect()} == {(1, 0), (2, 0)}
    again = bpe.decode(edge_docs.select(F.lit(None).cast("array<int>").alias("ids")), ranks, public_tokenizers.PATTERN)
    assert again.where("decoded is not null").count() == 0
    both = bpe.round_trip(clash, ranks, public_tokenizers.PATTERN)
    assert sorted(both.columns) == sorted(out.columns)
    assert both.select("ids", "decoded").exceptAll(out.select("ids", "decoded")).count() == 0
    assert rows(bpe.encode(no_docs, ranks, public_tokenizers.PATTERN)) == []


# --- 5, language -------------------------------------------------------------


def test_language_held_out_accuracy_and_edges(ready, edge_docs, no_docs):
    docs = table(ready, "/root/testdata/sf0.01", "documents")
    got = langid.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    held = got[got.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.97 and got.score.between(0, 1).all()
    odd = {(r.doc_id, r.lang_pred, r.score) for r in langid.languages(edge_docs).collect()}
    assert len(odd) and all(p == "und" and s == 0 for _, p, s in odd)  # nothing to learn from
    learned = langid.learn(docs)
    seen = {r.doc_id: r.p for r in edge_docs.select("doc_id", langid.identify(edge_docs, learned).alias("p")).collect()}
    assert [tuple(seen[i]) for i in (1, 2, 3, 5)] == [("und", 0.0)] * 4 and seen[6].lang_pred in learned.languages
    assert rows(langid.languages(no_docs)) == []


def test_language_filters_equal_exact_sets(ready):
    """Every language containing an n-gram is returned, and the predictions
    are those of sets without false answers."""
    docs = table(ready, "/root/testdata/sf0.01", "documents")
    train = [r for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 and r.text is not None and r.lang is not None]
    counts: dict = defaultdict(lambda: defaultdict(int))
    for r in train:
        for code, n in zip(*(x.tolist() for x in langid_core.ngrams(r.text))):
            counts[r.lang][code] += n
    names = sorted(counts)
    sets = [{c for c, n in counts[x].items() if n >= langid.LEAST_SHARE * sum(counts[x].values())} for x in names]
    learned = langid.learn(docs.where(~langid.held_out()))
    assert learned.languages == names
    every = np.array(sorted(set().union(*sets)), dtype=np.uint64)
    held = learned.languages_of(every)[:, 0]
    exact = np.array([[c in s for s in sets] for c in every.tolist()])
    got = np.array([[bool(h >> np.uint64(k) & np.uint64(1)) for k in range(len(names))] for h in held])
    assert got[exact].all() and got[~exact].mean() < 0.01
    compared = 0
    for r in langid.languages(docs).join(docs.select("doc_id", "text"), "doc_id").collect():
        codes, n = langid_core.ngrams(r.text)
        hits = [sum(k for c, k in zip(codes.tolist(), n.tolist()) if c in s) for s in sets]
        best, second = sorted(hits)[-1], sorted(hits)[-2]
        if best - second > 0.02 * n.sum():  # a lead that false answers cannot make
            compared += 1
            assert r.lang_pred == names[int(np.argmax(hits))]
    assert compared > 900


# --- 6, personal data --------------------------------------------------------


@pytest.fixture(scope="module")
def clashing():
    """Addresses whose first surrogates meet, and one that is a surrogate."""
    first = defaultdict(list)
    for a in range(200):
        for b in range(256):
            first[pii_core.surrogate("ip", f"192.168.{a}.{b}", 0, pii.KEY)].append(f"192.168.{a}.{b}")
    meet = [e for group in first.values() if len(group) > 1 for e in group]
    assert len(meet) > 20
    return [*meet, "192.168.250.1", pii_core.surrogate("ip", "192.168.250.1", 0, pii.KEY)]


@pytest.mark.parametrize("held", [100_000, 0])
def test_surrogates_are_distinct_and_consistent(ready, clashing, held):
    names = [f"{a}{b}" for a in ("Alt", "Berg", "Claus", "Dorn", "Eich") for b in ("mann", "er", "ing", "ow")]
    docs = [(i, f"Dear Mrs. {n}, and Mr. {n}son, write {n.lower()}@example.com") for i, n in enumerate(names * 2)]
    docs += [(None, None), (98, ""), (99, "nothing here")]
    docs += [(1000 + i, f"host {e} and {clashing[i - 1]} up") for i, e in enumerate(clashing)]
    frame = ready.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, _pii int")
    out = pii.replace_pii(frame, held_entities=held)
    assert out.columns == ["doc_id", "text", "_pii", "pii_spans"]
    got = {r.doc_id: r for r in out.collect()}
    assert got[None].text is None and got[98].text == "" and got[99].text == "nothing here" and not got[99].pii_spans
    for i, n in enumerate(names):
        assert n not in got[i].text and got[i].text == got[i + len(names)].text
        assert re.fullmatch(r"Dear Mrs. [A-Z]\w+, and Mr. [A-Z]\w+, write \w+@\w+\.example\.com", got[i].text)
    new = {e: got[1000 + i].text.split()[1] for i, e in enumerate(clashing)}
    assert len(set(new.values())) == len(new) and not set(new.values()) & set(clashing)
    assert all(got[1000 + i].text.split()[3] == new[clashing[i - 1]] for i in range(len(clashing)))


def test_collisions_are_resolved_in_a_crowded_format(ready):
    numbers = [f"555{i:04d}" for i in range(0, 10_000, 12)]  # of 10,000 first draws
    found = ready.createDataFrame([("phone", n) for n in numbers], "kind string, entity string")
    later = {r.entity: r.attempt for r in pii.later_attempts(found).collect()}
    final = [pii_core.surrogate("phone", n, later.get(n, 0), pii.KEY) for n in numbers]
    assert later and len(set(final)) == len(numbers) and not set(final) & set(numbers)


def test_placeholders_and_exhausted_formats_end(ready):
    secrets = [f"-------{d}" for d in range(10)]  # every value that the format has
    docs = [(i, f"password={e} here") for i, e in enumerate([*secrets, "--------", "________"])]
    out = {r.doc_id: r.text for r in pii.replace_pii(ready.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert [out[i] for i in (10, 11)] == ["password=-------- here", "password=________ here"]
    new = [out[i].split()[0].removeprefix("password=") for i in range(10)]
    assert len(set(new)) == 10 and not set(new) & set(secrets) and all(x.startswith("-------") for x in new)


def test_pii_edges(edge_docs, no_docs):
    out = pii.replace_pii(edge_docs)
    assert out.count() == edge_docs.count() and out.columns == [*edge_docs.columns, "pii_spans"]
    assert rows(pii.replace_pii(no_docs)) == []


# --- 7, chat -----------------------------------------------------------------


def test_chat_reads_back_and_equals_sql(ready):
    got = {r.conv_id: r for r in queries.op7_chat_format(ready, SF).collect()}
    turns = defaultdict(list)
    for r in table(ready, SF, "conversations").collect():
        turns[r.conv_id].append((r.turn, r.role, r.text or ""))
    turns[-7] = [(0, "user", queries.CONTROL_TEXT), (1, "assistant", queries.CONTROL_TEXT)]
    assert set(got) == set(turns)
    for conv, said in turns.items():
        said = sorted(said)
        loss = "".join(t for _, role, t in said if role == "assistant")
        r = got[conv]
        assert r.n_turns == len(said) and r.loss_chars == len(loss)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{t}\n" for _, a, t in said).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF}/conversations.parquet')")
    res = con.execute(queries.oracle_sql()["op7_chat_format"])
    names = [c[0] for c in res.description]
    sql = {r[names.index("conv_id")]: dict(zip(names, r)) for r in res.fetchall()}
    assert sql == {c: r.asDict() for c, r in got.items()}


def test_chat_edges(ready):
    nasty = [r"\1 \2 \0 \\", "<turn>x<text>y</turn>\nz", "</turn>", "<", "", None, "\n\n", r"\3</turn>" + "\n"]
    data = [(1, i, "user" if i % 2 == 0 else "assistant", t, "extra") for i, t in enumerate(nasty)]
    data += [(2, 0, None, "x", ""), (2, 0, "<turn>", "y", ""), (3, 5, "assistant", "first", ""), (None, 1, "user", "q", ""),
             (4, 1, "user", "a", ""), (4, 1, "user", "a", ""), (5, None, "user", "z" * 200_000, ""), (5, 1, "assistant", "b", "")]
    frame = ready.createDataFrame(data, "conv_id long, turn long, role string, text string, segments string")
    template = chat.Template()
    out = chat.formatted(frame, template)
    got = {
        r.conv_id: r
        for r in out.select("conv_id", "valid", chat.read_back(F.col("formatted")).alias("turns"),
                            chat.loss_text(F.col("segments")).alias("loss")).collect()
    }
    assert [t.text for t in got[1].turns] == [t or "" for t in nasty] and got[1].valid
    assert got[1].loss == "".join(t or "" for t in nasty[1::2])
    assert {c: r.valid for c, r in got.items()} == {1: True, 2: False, 3: False, None: True, 4: False, 5: True}
    assert sorted((t.role, t.text) for t in got[2].turns) == [("", "x"), ("<turn>", "y")]
    assert len(got[4].turns) == 2 and len(got[5].turns[0].text) == 200_000
    steps = {(r.conv_id, r.position): r.allowed for r in chat.segments(frame).collect()}
    assert steps[1, 0] and not steps[3, 0] and steps[4, 0] and not steps[4, 1]
    assert rows(chat.formatted(frame.where("false"))) == rows(chat.segments(frame.where("false"))) == []
    for bad in ({"stop": ""}, {"escape": "<"}, {"start": "<t", "middle": "<tx"}, {"stop": "a<"},
                {"escape": "~", "stop": "</turn\\E>"}):
        with pytest.raises(ValueError):
            chat.Template(**bad)
    assert not re.search("Python|Arrow|Pandas", out._jdf.queryExecution().executedPlan().toString())


# --- 8, toxicity -------------------------------------------------------------


def test_toxicity_held_out_accuracy(ready):
    sf = "/root/testdata/sf0.1"
    docs, labels = table(ready, sf, "documents"), table(ready, sf, "labels")
    got = toxicity.toxicity_scores(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id").where("held_out").toPandas()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.5)).all()
    assert (got.predicted == got.toxic).mean() > 0.97
    clean = got[got.toxic == 0]
    assert (clean.predicted == 0).mean() > 0.99


def test_toxicity_edges(ready, edge_docs, no_docs):
    labels = ready.createDataFrame([(1, None), (2, 1), (2, 0), (None, 1), (77, 1)], "doc_id long, toxic int")
    for frame in (labels, labels.where("false")):
        got = rows(toxicity.toxicity_scores(edge_docs, frame))
        assert len(got) == edge_docs.count() and all(0 <= s <= 1 for _, _, s, _ in got)
    kept = toxicity.reject_toxic(edge_docs, labels.where("false"))
    assert kept.count() == edge_docs.count() and kept.columns == edge_docs.columns  # nothing learned: all stay
    assert rows(toxicity.toxicity_scores(no_docs, labels)) == []


# --- 9, licences -------------------------------------------------------------


def test_licence_query_equals_brute_force(ready):
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    texts = {r.doc_id: r.text for r in table(ready, "/root/testdata/sf0.01", "documents").collect()}
    got = {r.doc_id: r for r in queries.op9_license_scan(ready, "/root/testdata/sf0.01").collect()}
    assert set(got) == set(texts) and any(r.n_base for r in got.values())
    for i, t in texts.items():
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate(low))
        at = [(k, label) for p, label in phrases.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        r = got[i]
        assert (r.n_words, r.n_base) == (len(w), len(at)) and r.base_labels == ",".join(sorted({x for _, x in at}))
        assert (r.first_word, r.last_word) == ((min(at)[0], max(at)[0]) if at else (None, None))
        # every notice at every place: enough words in place, and its key phrases within the slack
        notices, most = set(), 1.0 if at else 0.0
        number = {x: n for n, x in enumerate(dict.fromkeys(w))}
        tokens = np.array([number[x] for x in w], dtype=int)
        joined = f" {' '.join(w)} "
        for label, text, keys in licenses_core.NOTICES:
            own = [x.decode() for x in licenses_core.words(text)]
            shift = len(own)
            padded = np.concatenate([np.full(shift, -1), tokens, np.full(shift, -1)])
            share = sum(padded[k : k + len(w) + shift] == number.get(x, -2) for k, x in enumerate(own)) / len(own)
            most = max(most, share.max())
            if all(f" {key} " in joined for key in keys):
                for start in np.flatnonzero(share >= licenses_core.SHARE) - shift:
                    near = True
                    for key in keys:
                        k = key.split()
                        place = start + next(i for i in range(len(own)) if own[i : i + len(k)] == k)
                        some = range(max(0, place - licenses_core.SLACK), place + licenses_core.SLACK + 1)
                        near &= any(w[i : i + len(k)] == k for i in some)
                    if near:
                        notices.add(label)
        assert r.labels == ",".join(sorted({x for _, x in at} | notices))
        assert (r.score == 1 if at else 0 <= r.score <= most + 1e-9)


def test_licence_edges(edge_docs, no_docs):
    index = licenses.rare_word_index(no_docs)
    got = rows(edge_docs.select("doc_id", licenses.scan(edge_docs, index).alias("s")).select("doc_id", "s.n_words", "s.places"))
    assert len(got) == edge_docs.count() and all(p == [] for _, _, p in got)
    assert rows(no_docs.select(licenses.scan(no_docs, index).alias("s"))) == []


# --- 10, decontamination -----------------------------------------------------


def test_decontamination_finds_passages_whole_and_reordered(ready, edge_docs, no_docs):
    rnd = random.Random(21)
    items = [(i, words_text(rnd, 15 + i)) for i in range(40)] + [(None, words_text(rnd, 20)), (50, "short one"), (51, None), (52, "")]
    docs = []
    for i, text in items[:40]:
        w = text.split()
        mixed = " ".join([*w[len(w) // 2 :], "between", *w[: len(w) // 2]]).upper()
        half = " ".join(w[: len(w) // 2])
        docs += [(3 * i, f"{words_text(rnd, 30)} {text}, {words_text(rnd, 30)}"), (3 * i + 1, f"{words_text(rnd, 30)} {mixed}."),
                 (3 * i + 2, f"{words_text(rnd, 30)} {half}")]
    docs += [(None, items[40][1]), (500, None), (501, "short one")]
    frame = ready.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, item int")
    bench = ready.createDataFrame(items, "item_id long, text string")
    want = {(3 * i + k, i) for i in range(40) for k in (0, 1)} | {(None, None)}
    for block_words in (2_000_000, 200):
        found = decontaminate.overlaps(frame, bench, block_words=block_words)
        assert {(r.doc_id, r.item_id) for r in found.collect()} == want
        kept = decontaminate.drop_contaminated(frame, bench, block_words=block_words)
        assert kept.columns == frame.columns
        assert {r.doc_id for r in kept.collect()} == {3 * i + 2 for i in range(40)} | {500, 501}
    assert rows(decontaminate.overlaps(edge_docs, bench)) == rows(decontaminate.overlaps(no_docs, bench)) == []
    assert decontaminate.drop_contaminated(edge_docs, bench.where("false")).count() == edge_docs.count()


def test_decontamination_on_the_given_tables(ready):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in table(ready, sf, "documents").collect()}
    items = {r.item_id: r.text for r in table(ready, sf, "benchmark").collect()}
    got = {(r.doc_id, r.item_id): (round(r.coverage, 9), r.n_tiles) for r in queries.op10_decontamination(ready, sf).collect()}
    assert {(d, i) for d, t in docs.items() for i, b in items.items() if b in t} <= set(got)
    assert got == plain_overlaps(docs, items)
