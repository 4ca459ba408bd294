"""The pipeline against its stages' meaning, and stage by stage on odd rows."""

import public_tokenizers
import tiktoken
from pyspark.sql import functions as F
from tiktoken.load import load_tiktoken_bpe

import corpus_pipeline
from lakemarts.llm import pii_core, simhash, toxicity
from lakemarts.llm.common import table
from test_cores import plain_overlaps

SF = "/root/testdata/sf0.001"


def test_run_equals_brute_force(ready):
    got = {r.doc_id: r for r in corpus_pipeline.run(ready, SF).collect()}
    docs, labels = table(ready, SF, "documents"), table(ready, SF, "labels")
    scores = {r.doc_id: r.score for r in toxicity.toxicity_scores(docs, labels).collect()}
    texts = {r.doc_id: r.text for r in docs.collect() if scores[r.doc_id] < 0.5}
    fps = {i: simhash.fingerprint(t) for i, t in texts.items()}
    kept, seen = [], set()
    for i in sorted(texts):  # groups by search, the smallest id first
        if i in seen:
            continue
        kept.append(i)
        todo = [i]
        while todo:
            a = todo.pop()
            seen.add(a)
            todo += [b for b in texts if b not in seen and (fps[a] ^ fps[b]).bit_count() <= 4]
    items = {r.item_id: r.text for r in table(ready, SF, "benchmark").collect()}
    contaminated = {d for d, _ in plain_overlaps({i: texts[i] for i in kept}, items)}
    assert contaminated and set(got) == set(kept) - contaminated
    own = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, special_tokens={},
        mergeable_ranks=load_tiktoken_bpe(public_tokenizers.path("byte_bpe_50k.tiktoken")),
    )
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in got.values())
    for i, r in got.items():
        if not pii_core.find(texts[i]):
            assert r.ids == own.encode_ordinary(texts[i])
        else:
            assert own.decode(r.ids) != texts[i]


def test_stages_keep_columns_and_survive_odd_rows(ready, edge_docs, no_docs):
    docs = edge_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(ready, docs, SF)
        assert out.count() <= docs.count()
        assert stage(ready, no_docs.select(*docs.columns), SF).count() == 0
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_dedup", "decontamination", "pii", "byte_bpe"]


def test_pii_stage_updates_the_length(ready):
    docs = ready.createDataFrame(
        [(1, "mail a.b@example.com now", "en", "s", 24), (2, None, None, None, 7)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    out = {r.doc_id: r for r in corpus_pipeline.pii(ready, docs, SF).withColumn("n", F.length("text")).collect()}
    assert "a.b@example.com" not in out[1].text and out[1].n_chars == out[1].n and out[2].n_chars == 7
