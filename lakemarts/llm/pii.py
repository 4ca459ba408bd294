"""Operator 6, personal data: every detected entity gets a keyed surrogate of
its type, gender, script and format.

Kinds: mail addresses; secrets behind a keyword and AWS access keys; IPv4
addresses but for versions and single digits, whole IPv6 addresses; phone
numbers in North American form (with and without +1 one number) or with a
country code; social security numbers; card numbers and IBANs whose check
digits are right; names behind titles.

An entity is a kind and a canonical form; all its mentions, in all documents,
get the same surrogate, and different entities get different ones.  A name is
found behind a title; its given names and its family name are entities of
their own, so that full and family name of one person agree, and every
further capitalised mention of one of these words in the document is replaced
too.  A name that no title of its document announces is not found.  A
surrogate is drawn by a keyed hash of the entity and an attempt number.
``later_attempts`` checks the first draws of all distinct entities against
each other and against all entities that occur: who loses a collision draws
again until none is left.  Only these losers, few unless a format is crowded,
have to be known when texts are rewritten.  Up to ``HELD_ENTITIES`` of them
are held by every task and no text is shuffled; beyond it each document gets
its own ones by a join on a hash of its text.

Inputs: null texts stay null, texts without entities stay as they are.  Very
long texts are read whole.  Of mentions that overlap the earlier one is taken,
of those that tie the longer one.  Repeated rows keep their rows and get the
same surrogates.  Null ids stay.
All columns stay in ``replace_pii``; the two columns it adds (``pii_spans``
in its full form) replace columns of that name.  An empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemarts.llm import pii_core as core
from lakemarts.llm.common import fresh, ship, stored

#: Entities with a later attempt that every task may hold.
HELD_ENTITIES = 100_000
#: The default key of the surrogates; a production run passes its own secret.
KEY = b"lakemarts surrogate key"

_ENTITIES = "array<struct<kind string, entity string>>"


def entities(docs: DataFrame, text: str = "text") -> DataFrame:
    """Distinct ``(kind, entity)`` of all texts."""
    ship(docs.sparkSession)

    @F.pandas_udf(_ENTITIES)
    def found(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"kind": k, "entity": e} for k, e in core.entities(t)] for t in texts])

    return docs.select(F.explode(found(text)).alias("e")).select("e.kind", "e.entity").distinct()


def later_attempts(found: DataFrame, key: bytes = KEY) -> DataFrame:
    """``(kind, entity, attempt)`` of the entities whose first surrogate is
    another's, or is an entity itself."""

    @F.pandas_udf("string")
    def draw(kinds: pd.Series, names: pd.Series, attempts: pd.Series) -> pd.Series:
        return pd.Series([core.surrogate(k, e, a, key) for k, e, a in zip(kinds, names, attempts)], dtype=object)

    found = stored(found, "entities")
    drawn = found.withColumn("attempt", F.lit(0)).withColumn("surrogate", draw("kind", "entity", "attempt"))
    drawn = stored(drawn, "drawn")
    # a surrogate has to differ across all parts of names, and across addresses
    named = F.col("kind").startswith("given") | (F.col("kind") == "family")
    family = F.when(named, "name").when(F.col("kind").isin("ip", "ipv6"), "ip").otherwise(F.col("kind"))
    while True:
        rows = drawn.withColumn("family", family)
        holder = rows.groupBy("family", "surrogate").agg(
            F.min(F.struct("attempt", "kind", "entity")).alias("holder"), F.count(F.lit(1)).alias("n")
        )
        taken = found.select(family.alias("family"), F.col("entity").alias("surrogate")).distinct().withColumn(
            "taken", F.lit(True)
        )
        clash = holder.join(taken, ["family", "surrogate"], "left").where("n > 1 or taken")
        lost = stored(
            rows.join(clash, ["family", "surrogate"])
            .where(F.col("taken") | (F.struct("attempt", "kind", "entity") != F.col("holder")))
            .select("kind", "entity", "attempt"),
            "lost",
        )
        if lost.isEmpty():
            return drawn.where("attempt > 0").select("kind", "entity", "attempt")
        again = lost.select("kind", "entity", (F.col("attempt") + 1).alias("attempt")).withColumn(
            "surrogate", draw("kind", "entity", "attempt")
        )
        drawn = stored(
            drawn.join(lost.select("kind", "entity"), ["kind", "entity"], "left_anti").unionByName(again), "drawn"
        )


def replace_pii(
    docs: DataFrame, key: bytes = KEY, text: str = "text", held_entities: int = HELD_ENTITIES
) -> DataFrame:
    """The documents with every entity of ``text`` replaced, and a column
    ``pii_spans`` of the replacements: kind, start and end in the new text."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.drop("pii_spans")
    later = stored(later_attempts(entities(docs, text), key), "later")
    pii, at_name, own_name = (fresh(docs, c) for c in ("_pii", "_at", "_own"))
    result = f"struct<{text} string, pii_spans array<struct<kind string, start int, stop int>>>"

    def rewritten(t, attempts):
        new, spans = core.replace(t, key, attempts)
        return {text: new, "pii_spans": [{"kind": k, "start": a, "stop": b} for k, a, b in spans]}

    if later.count() <= held_entities:
        held = spark.sparkContext.broadcast({(k, e): n for k, e, n in later.collect()})

        @F.pandas_udf(result)
        def rewrite(texts: pd.Series) -> pd.DataFrame:
            return pd.DataFrame([rewritten(t, held.value) for t in texts], columns=[text, "pii_spans"])

        out = docs.withColumn(pii, rewrite(text))
    else:

        @F.pandas_udf(_ENTITIES)
        def named(texts: pd.Series) -> pd.Series:
            return pd.Series([[{"kind": k, "entity": e} for k, e in core.entities(t)] for t in texts])

        # a document's own losers, met by the hash of its text; copies share them
        at = F.xxhash64(text)
        mentions = docs.select(at.alias(at_name), F.explode(named(text)).alias("e")).distinct()
        own = (
            mentions.select(at_name, "e.kind", "e.entity").join(later, ["kind", "entity"])
            .groupBy(at_name).agg(F.collect_list(F.struct("kind", "entity", "attempt")).alias(own_name))
        )

        @F.pandas_udf(result)
        def rewrite_own(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
            for texts, lists in batches:
                yield pd.DataFrame(
                    [
                        rewritten(t, {(x["kind"], x["entity"]): x["attempt"] for x in (own_ if own_ is not None else ())})
                        for t, own_ in zip(texts, lists)
                    ],
                    columns=[text, "pii_spans"],
                )

        out = docs.withColumn(at_name, at).join(own, at_name, "left").withColumn(pii, rewrite_own(text, own_name))
    kept = [F.col(f"{pii}.{text}").alias(c) if c == text else F.col(c) for c in docs.columns]
    return out.select(*kept, F.col(f"{pii}.pii_spans").alias("pii_spans"))
