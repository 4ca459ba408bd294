"""Operator 5, language identification by bit-sliced Bloom filters.

``learn`` counts the character 3-grams of every training text by language (a
map-side and a Spark aggregation), gives an n-gram to every language whose
texts contain it, and packs the filters of all languages into one table of
slots with a bit per language.  An n-gram that is less than ``LEAST_SHARE`` of
a language's n-grams is taken for a name, a foreign word or a misprint there.
The table is sized by the n-grams counted, within the bounds that
``langid_core`` states, and broadcast.  ``identify`` reads
the languages of each n-gram of a text by one AND per hash function, counts
per language, corrects the counts for the filters' false answers and takes the
largest.

Inputs: training uses text and lang only, of rows whose text and lang are not
null.  A null text and a text without letters give ``und`` with score 0, and
so does everything when nothing was learned; a text none of whose n-grams was
learned gives the first language with an equal share.  Ties go to the first
language in alphabetical order.  Repeated rows count as often as they occur
and are classified each.  A null doc_id counts as not held out.  Very long texts
are read whole, a piece at a time.  Other columns are ignored, whatever their
names.  Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemarts.llm import langid_core as core
from lakemarts.llm.common import ship, stored
from lakemarts.llm.toxicity import held_out

#: Share of a language's n-grams from which it contains an n-gram.
LEAST_SHARE = 1e-5
#: Counts that a task holds before it passes them on.
HELD_COUNTS = 1 << 20


def ngram_counts(training: DataFrame) -> DataFrame:
    """``(lang, code, n)`` over all rows of ``training(text, lang)``."""
    ship(training.sparkSession)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts: list[pd.DataFrame] = []
        size = 0
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                found = [core.ngrams(t) for t in texts]
                codes, back = np.unique(np.concatenate([c for c, _ in found]), return_inverse=True)
                n = np.bincount(back, np.concatenate([k for _, k in found]), len(codes)).astype(np.int64)
                parts.append(pd.DataFrame({"lang": lang, "code": codes.view(np.int64), "n": n}))
                size += len(codes)
            if size > HELD_COUNTS:
                merged = pd.concat(parts).groupby(["lang", "code"], as_index=False)["n"].sum()
                parts, size = [merged], len(merged)
                if size > HELD_COUNTS:
                    yield merged
                    parts, size = [], 0
        if parts:
            yield pd.concat(parts).groupby(["lang", "code"], as_index=False)["n"].sum()

    known = training.where("text is not null and lang is not null").select("text", "lang")
    return known.mapInPandas(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))


def learn(training: DataFrame, least_share: float = LEAST_SHARE) -> core.Filter:
    counts = stored(ngram_counts(training), "ngrams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    languages = sorted(r["lang"] for r in totals.select("lang").collect())  # one value a language
    if not languages:
        return core.Filter([], np.empty(0, int), np.empty(0, int), np.empty(0, np.uint64))
    number = F.array_position(F.array(*(F.lit(x) for x in languages)), F.col("lang")) - 1
    members = stored(
        counts.join(F.broadcast(totals), "lang").where(F.col("n") >= F.lit(least_share) * F.col("total"))
        .select(number.alias("number"), "code"), "members",
    )
    largest = members.groupBy("number").count().agg(F.max("count")).first()[0]
    bits = core.slot_bits(largest)

    @F.pandas_udf("array<int>")
    def slots(codes: pd.Series) -> pd.Series:
        return pd.Series(list(core.slots(codes.to_numpy().view(np.uint64), bits).T.astype(np.int32)))

    # every member sets its language's bit in its slots
    bit = F.expr("shiftleft(1L, cast(number % 64 as int))")
    rows = (
        members.select("code", F.floor(F.col("number") / 64).cast("int").alias("word"), bit.alias("mask"))
        .groupBy("code", "word").agg(F.bit_or("mask").alias("mask"))
        .select(F.explode(slots("code")).alias("slot"), "word", "mask")
        .groupBy("slot", "word").agg(F.bit_or("mask").alias("mask"))
        .toPandas()  # a row per slot and 64 languages at most
    )
    return core.Filter(
        languages, rows["slot"].to_numpy(dtype=np.int64), rows["word"].to_numpy(dtype=np.int64),
        rows["mask"].to_numpy(dtype=np.int64).view(np.uint64), bits,
    )


def identify(docs: DataFrame, learned: core.Filter, text: str = "text") -> Column:
    """Struct column ``(lang_pred, score)``."""
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(learned)

    @F.pandas_udf("struct<lang_pred string, score double>")
    def classify(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([held.value.classify(t) for t in texts], columns=["lang_pred", "score"])

    return classify(F.col(text))


def languages(docs: DataFrame, least_share: float = LEAST_SHARE) -> DataFrame:
    """One row per document, learned from those not held out: ``doc_id,
    held_out, lang_pred, score``."""
    learned = learn(docs.where(~held_out()), least_share)
    return docs.select("doc_id", held_out().alias("held_out"), identify(docs, learned).alias("_p")).select(
        "doc_id", "held_out", "_p.lang_pred", "_p.score"
    )
