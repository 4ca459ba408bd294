"""Cross-tokenizer alignment against a plain walk over both token lists."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakemarts.llm import alignment, alignment_core, queries
from lakemarts.llm.common import table

SF = "/root/testdata/sf0.001"
LEFT, RIGHT = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "   ", " a", "a ", "a  ", "a  b\n  c \n", "a \n", "▁x", "a▁ b", "<s> </s><unk><|endoftext|> z",
    "\u0000 � \U0001f600 é", "é ́ x", "\x1c a\x1c b", "  x 　y", "\n" * 3000 + " x", " " * 5000,
    "x" * 20_000, "same words here now", "same words here now",
]


@pytest.fixture(scope="module")
def sides():
    left = Tokenizer.from_file(LEFT)
    left.encode_special_tokens = True
    return left, sentencepiece.SentencePieceProcessor(model_file=RIGHT)


@pytest.fixture(scope="module")
def aligner():
    with open(LEFT, "rb") as a, open(RIGHT, "rb") as b:
        return alignment_core.Aligner(
            alignment_core.ByteLevel(a.read(), public_tokenizers.PATTERN), alignment_core.Pieces(b.read())
        )


def ends(pieces):
    out, at = [], 0
    for p in pieces:
        at += len(p)
        out.append(at)
    return out


def walked(sides, text):
    """Links and groups of one text, token by token."""
    left, right = sides
    none = {"n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups_sha256": ""}
    if not text:
        return none, []
    alphabet = alignment_core.byte_alphabet()
    a = left.encode(" " + text, add_special_tokens=False)
    b = right.encode(text)
    in_a = [bytes(alphabet[c] for c in t) for t in a.tokens]
    pieces = [right.id_to_piece(i) for i in b]
    in_b = [
        bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()
        for p in pieces
    ]
    if b"".join(in_a) != (" " + text).encode() or b"".join(in_b) != (" " + text).encode():
        return none, []
    ids, end_a, end_b = a.ids, ends(in_a), ends(in_b)
    i = j = 0
    links, groups, own = [], [], ([], [])
    while i < len(end_a):
        links.append((ids[i], b[j]))
        if end_a[i] <= end_b[j]:
            own[0].append(str(ids[i]))
        if end_b[j] <= end_a[i]:
            own[1].append(str(b[j]))
        if end_a[i] == end_b[j]:
            groups.append(",".join(own[0]) + "|" + ",".join(own[1]))
            own = ([], [])
            i, j = i + 1, j + 1
        elif end_a[i] < end_b[j]:
            i += 1
        else:
            j += 1
    return {
        "n_a": len(end_a), "n_b": len(end_b), "n_groups": len(groups), "n_links": len(links),
        "groups_sha256": hashlib.sha256(";".join(groups).encode()).hexdigest(),
    }, links


def brute(sides, texts):
    found = [walked(sides, t) for t in texts]
    count = Counter(pair for _, links in found for pair in set(links))
    top = defaultdict(int)
    for (a, _), n in count.items():
        top[a] = max(top[a], n)
    return [
        f | {"n_best": sum(count[p] == top[p[0]] for p in links), "count_sum": sum(count[p] for p in links)}
        for f, links in found
    ]


def random_texts(n):
    rnd = random.Random(3)
    return [
        "".join(rnd.choice("ab é\n\t  漢's1!\U0001f600́\x1c  ▁"[: 14 + i % 5]) for _ in range(rnd.randint(1, 60)))
        for i in range(n)
    ]


def test_chunks_equal_the_walk(sides, aligner):
    assert aligner.cuts
    texts = ODD + random_texts(400)
    figures, keys, doc = aligner.chunk(texts)
    for i, text in enumerate(texts):
        expected, links = walked(sides, text)
        assert {k: v[i] for k, v in figures.items()} == expected, text
        assert [divmod(k, aligner.width) for k in keys[doc == i].tolist()] == links


def test_whole_texts_give_the_same_as_units(sides, aligner, monkeypatch):
    texts = random_texts(60)
    cut = aligner.chunk(texts)
    monkeypatch.setattr(aligner, "cuts", False)
    whole = aligner.chunk(texts)
    assert cut[0] == whole[0] and np.array_equal(cut[1], whole[1]) and np.array_equal(cut[2], whole[2])


def test_runs_merge_to_summed_counts(monkeypatch):
    monkeypatch.setattr(alignment_core, "FRAME", 7)
    rnd = np.random.default_rng(1)
    total, runs = Counter(), []
    for size in (0, 1, 7, 100, 250):
        keys = np.unique(rnd.integers(0, 1 << 40, size) % 300)
        counts = rnd.integers(1, 9, len(keys))
        total.update(dict(zip(keys.tolist(), counts.tolist())))
        runs.append(list(alignment_core.frames_of(keys, counts)))
    merged = [(int(k), int(c)) for ks, cs in alignment_core.merged(runs) for k, c in zip(ks, cs)]
    assert merged == sorted(total.items())


def test_sums_are_exact_beyond_doubles():
    group, values = np.array([0, 1, 0]), np.array([(1 << 60) + 1, 3, 1 << 60])
    assert alignment_core._sums(group, values, 2).tolist() == [(1 << 61) + 1, 3]


@pytest.mark.parametrize(("chunk_docs", "fan"), [(8192, 32), (7, 2)])
def test_operator_equals_brute_force(ready, sides, monkeypatch, chunk_docs, fan):
    """Whole in one chunk, and with chunks and merges in several levels."""
    monkeypatch.setattr(alignment, "CHUNK_DOCS", chunk_docs)
    texts = ODD + random_texts(150)
    rows = [(None if i == 3 else i // 2, t, "clash", 1) for i, t in enumerate(texts)]
    docs = ready.createDataFrame(rows, "doc_id long, text string, chunk string, n_best long").repartition(3)
    out = alignment.align(docs, LEFT, RIGHT, public_tokenizers.PATTERN, radices=3, fan=fan, join_fan=fan)
    expected = [(r[0], *e.values()) for r, e in zip(rows, brute(sides, texts))]
    got = [tuple(r) for r in out.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))


def test_query_equals_brute_force(ready, sides):
    docs = table(ready, SF, "documents").select("doc_id", "text").orderBy("doc_id").collect()
    out = queries.op12_tokenizer_alignment(ready, SF).orderBy("doc_id")
    got = [r.asDict() for r in out.collect()]
    expected = brute(sides, [r.text for r in docs])
    assert got == [{"doc_id": r.doc_id} | e for r, e in zip(docs, expected)]
    assert {t for c, t in out.dtypes if c != "groups_sha256"} == {"bigint"}


def test_empty_table_and_edges(ready, edge_docs, no_docs, sides):
    def run(docs):
        return alignment.align(docs, LEFT, RIGHT, public_tokenizers.PATTERN)

    assert run(no_docs).collect() == []
    rows = edge_docs.select("doc_id", "text").collect()
    expected = sorted(map(repr, [(r.doc_id, *e.values()) for r, e in zip(rows, brute(sides, [r.text for r in rows]))]))
    assert sorted(map(repr, map(tuple, run(edge_docs).collect()))) == expected
    assert run(edge_docs.where(F.col("text").isNull())).agg(F.sum("n_links")).first()[0] == 0
