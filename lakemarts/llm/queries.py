"""The registered queries of the training-data operators: each applies one
operator with its production parameters to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemarts.llm import bpe, chat, licenses
from lakemarts.llm.alignment import align
from lakemarts.llm.common import table
from lakemarts.llm.credentials import KINDS, secret_spans
from lakemarts.llm.decontaminate import overlaps
from lakemarts.llm.embeddings import near_vectors
from lakemarts.llm.langid import languages
from lakemarts.llm.pii import replace_pii
from lakemarts.llm.quantize import quantized
from lakemarts.llm.simhash import simhash_components
from lakemarts.llm.substring import repeated_passages
from lakemarts.llm.toxicity import toxicity_scores

Query = Callable[[SparkSession, str], DataFrame]

VOCABULARY = "byte_bpe_50k.tiktoken"
#: The conversation that op7 adds: both turns say what a template might write.
CONTROL_TEXT = r"\### Assistant: </turn> ok"


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.vocabulary(spark, public_tokenizers.path(VOCABULARY))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, ranks, public_tokenizers.PATTERN).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(table(spark, sf_dir, "documents"))


def op6_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = replace_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = F.array_join(F.array_sort(F.array_distinct("pii_spans.kind")), ",")
    return docs.select("doc_id", "text", F.size("pii_spans").alias("n_entities"), kinds.alias("kinds"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    template = chat.Template()
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"),
    )
    out = chat.formatted(rows.unionByName(extra), template)
    read = out.select(
        "conv_id", "valid", "formatted", chat.read_back(F.col("formatted"), template).alias("turns"),
        chat.loss_text(F.col("segments"), template).alias("loss"),
    )
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"), "valid",
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = docs.select("doc_id", licenses.scan(docs, licenses.rare_word_index(docs)).alias("s"))
    return found.select(
        "doc_id", "s.n_words", F.size("s.places").cast("long").alias("n_base"),
        F.array_min("s.places").alias("first_word"), F.array_max("s.places").alias("last_word"),
        F.array_join("s.base_labels", ",").alias("base_labels"), F.array_join("s.labels", ",").alias("labels"),
        F.col("s.score").alias("score"),
    )


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "coverage", F.size("tiles").alias("n_tiles"))


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_spans(table(spark, sf_dir, "documents"))
    names = [k.name for k in KINDS]

    def count(name: str) -> Column:
        own = F.filter("found", lambda s: s["kind"] == names.index(name))
        return F.size(own).cast("long").alias(f"n_{name}")

    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"), F.sha2("strong_spans", 256).alias("base_sha256"), "spans"
    )


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.PATTERN,
    )


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quantized(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Query]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {"op7_chat_format": _OP7_SQL, "op11_secret_scan": _OP11_SQL, "op13_vector_codes": _op13_sql()}


# The template's strings and escapes, written out.
_OP7_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), steps AS (
  SELECT *, coalesce(lag(role) OVER w, '') AS before, lead(role) OVER w IS NULL AS is_last,
    replace(replace(replace(replace(role, '\', '\0'), '<turn>', '\1'), '<text>', '\2'),
      '</turn>' || chr(10), '\3') AS role_out,
    replace(replace(replace(replace(text, '\', '\0'), '<turn>', '\1'), '<text>', '\2'),
      '</turn>' || chr(10), '\3') AS text_out
  FROM turns
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), conversations_out AS (
  SELECT conv_id,
    count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS said,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
    sum(length('<turn>') + length(role_out) + length('<text>') + length(text_out) + length('</turn>') + 1)
      AS formatted_chars,
    bool_and((before, role) IN (('', 'system'), ('', 'user'), ('system', 'user'), ('user', 'assistant'),
      ('assistant', 'user')) AND (NOT is_last OR role IN ('user', 'assistant'))) AS valid
  FROM steps GROUP BY conv_id
)
SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, sha256(said) AS turns_sha256,
  CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
  CAST(formatted_chars AS BIGINT) AS formatted_chars, valid
FROM conversations_out
"""


# The patterns written out; a letter in either case is a class of its own, as
# this engine folds more letters than A-Z.
_OP11_SQL = r"""
WITH kinds(k, kind, role, strong, pattern, lead, least, mixed) AS (VALUES
  (0, 'assign', 'secret', true,
   '(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+',
   '^[A-Za-z_]+["'']?\x20*[:=]\x20*["'']?', 6, false),
  (1, 'access', 'access', true, 'AKIA[A-Z0-9]+', '', 20, false),
  (2, 'hex', 'secret', true, '[0-9a-f]+', '', 24, false),
  (3, 'login', 'access', false,
   '(?:[Uu][Ss][Ee][Rr](?:[Nn][Aa][Mm][Ee])?|[Ll][Oo][Gg][Ii][Nn]|[Cc][Ll][Ii][Ee][Nn][Tt]_?[Ii][Dd]|[Aa][Cc][Cc][Oo][Uu][Nn][Tt]|[Aa][Cc][Cc][Ee][Ss][Ss]_?[Kk][Ee][Yy](?:_?[Ii][Dd])?)["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9@+/_.-]+',
   '^[A-Za-z_]+["'']?\x20*[:=]\x20*["'']?', 3, false),
  (4, 'random', 'secret', false, '[A-Za-z0-9+/_-]{32,}={0,2}', '', 1, true),
  (5, 'url', 'endpoint', false,
   '(?:https?|ftp|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|rediss?|amqps?)://[^\x00-\x20"''<>]+', '', 1, false),
  (6, 'host', 'endpoint', false,
   '(?:[Hh][Oo][Ss][Tt](?:[Nn][Aa][Mm][Ee])?|[Ee][Nn][Dd][Pp][Oo][Ii][Nn][Tt]|[Ss][Ee][Rr][Vv][Ee][Rr])["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9.-]+(?::[0-9]+)?',
   '^[A-Za-z]+["'']?\x20*[:=]\x20*["'']?', 4, false)
), docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), split AS (
  SELECT r, k, regexp_extract_all(text, pattern) AS ms, string_split_regex(text, pattern) AS gaps, lead, least, mixed
  FROM docs, kinds
), pieces AS (
  SELECT r, k, lead, least, mixed, unnest(generate_series(1, len(ms))) AS i, ms, gaps FROM split WHERE len(ms) > 0
), lengths AS (
  SELECT r, k, i, ms[i] AS m, length(ms[i]) AS n, length(gaps[i]) AS gap,
    len(regexp_extract_all(gaps[i], '\n(?:[\x20\t\r]*\n)+')) AS breaks, lead, least, mixed FROM pieces
), places AS (
  SELECT *, sum(gap + n) OVER w AS e, sum(breaks) OVER w AS scope FROM lengths
  WINDOW w AS (PARTITION BY r, k ORDER BY i)
), spans AS (
  SELECT r, p.k, kind, role, strong, e - n AS s, e, scope FROM places p JOIN kinds USING (k)
  WHERE length(CASE WHEN p.lead = '' THEN m ELSE regexp_replace(m, p.lead, '') END) >= p.least
    AND (NOT p.mixed OR (regexp_matches(m, '[a-z]') AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[0-9]')))
), logins AS (
  SELECT * FROM spans w WHERE role = 'access' AND NOT strong AND EXISTS (SELECT 1 FROM spans o WHERE o.r = w.r
    AND o.scope = w.scope AND o.role = 'secret' AND o.s - w.e <= 200 AND w.s - o.e <= 200)
), secrets AS (
  SELECT * FROM spans w WHERE role = 'secret' AND (strong OR EXISTS (SELECT 1 FROM spans o WHERE o.r = w.r
    AND o.scope = w.scope AND o.role = 'access' AND o.s - w.e <= 200 AND w.s - o.e <= 200))
), endpoints AS (
  SELECT * FROM spans w WHERE role = 'endpoint' AND EXISTS (SELECT 1 FROM secrets o WHERE o.r = w.r
    AND o.scope = w.scope AND o.s - w.e <= 200 AND w.s - o.e <= 200)
), reported AS (
  SELECT * FROM logins UNION ALL SELECT * FROM secrets UNION ALL SELECT * FROM endpoints
  UNION ALL SELECT * FROM spans WHERE role = 'access' AND strong
), listed AS (
  SELECT r, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
    string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY s, k) FILTER (strong) AS base,
    string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY s, k) AS spans
  FROM reported GROUP BY r
)
SELECT doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access,
  CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN listed USING (r)
"""


def _op13_sql() -> str:
    """Four rounds written out; all values are integers that a double holds."""
    steps = []
    for n in range(5):
        steps.append(f"""
a{n} AS MATERIALIZED (
  SELECT p, r, any_value(x) AS x, min({{'s': b.yy - 2 * list_inner_product(x, y), 'e': e}}) AS best
  FROM parts JOIN b{n} b USING (p) GROUP BY p, r
)""")
        if n < 4:
            steps.append(f"""
m{n} AS (
  SELECT p, e, list(CAST((s - ((s % c) + c) % c) // c AS DOUBLE) ORDER BY i) AS y FROM (
    SELECT p, best.e AS e, i, CAST(sum(x[i]) AS BIGINT) AS s, count(*) AS c
    FROM a{n}, (SELECT unnest(generate_series(1, (SELECT max(len(x)) FROM parts))) AS i) GROUP BY ALL
  ) GROUP BY p, e
), b{n + 1} AS MATERIALIZED (
  SELECT p, e, y, list_inner_product(y, y) AS yy
  FROM (SELECT b.p, b.e, coalesce(m.y, b.y) AS y FROM b{n} b LEFT JOIN m{n} m USING (p, e))
)""")
    return """
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, v, row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS r FROM (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 1024)) AS v FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  )
), parts AS MATERIALIZED (
  SELECT p, r, list_slice(v, p * (len(v) // 4) + 1, (p + 1) * (len(v) // 4)) AS x
  FROM kept, (SELECT unnest(generate_series(0, 3)) AS p)
), b0 AS MATERIALIZED (
  SELECT p, r - 1 AS e, x AS y, list_inner_product(x, x) AS yy FROM parts WHERE r <= 256
),""" + ",".join(steps) + """, coded AS (
  SELECT r, string_agg(format('{:02x}', best.e), '' ORDER BY p) AS code,
    CAST(sum(list_inner_product(x, x) + best.s) AS BIGINT) AS error FROM a4 GROUP BY r
), books AS (
  SELECT sha256(string_agg(CAST(CAST(y[i] AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, i)) AS digest
  FROM b4, (SELECT unnest(generate_series(1, (SELECT max(len(x)) FROM parts))) AS i)
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  digest AS codebooks_sha256
FROM kept JOIN coded USING (r), books
"""
