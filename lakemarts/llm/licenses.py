"""Operator 9, licence scans by a positional rare-token index.

A first pass counts in how many documents each word of the licence templates
occurs; these few hundred numbers make the index, which lists each template's
highest-IDF words with their positions.  The second pass looks up the words a
text has of it, intersects their postings by relative position, and verifies
the words in place and the mandatory key phrases.  Phrases (``PHRASES``) are
templates all of whose words have to stand in place and all of whose places
are reported; notices (``NOTICES``) add labels of their own.  Texts are not
shuffled.

Inputs: a null text counts as empty; it has no word, no place and score 0.
Very long texts are read whole.  Words of equal IDF are taken in alphabetical
order, and all notices that fit equally well are labels.  Repeated rows are scanned
each (and count each in the frequencies); null ids and extra columns do not
matter.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemarts.llm import licenses_core as core
from lakemarts.llm.common import ship

_RESULT = (
    "struct<n_words long, places array<long>, base_labels array<string>, labels array<string>, score double>"
)


def rare_word_index(docs: DataFrame, text: str = "text") -> core.Index:
    """The index with document frequencies over all of ``docs``."""
    ship(docs.sparkSession)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wanted = set(core.VOCABULARY)
        seen: Counter = Counter()
        for batch in batches:
            for t in batch[text]:
                seen["\n"] += 1  # no word; the number of documents
                seen.update(w.decode() for w in wanted.intersection(core.words(t)))
        if seen:
            yield pd.DataFrame({"word": list(seen), "n": list(seen.values())})

    rows = (
        docs.select(text).mapInPandas(count, "word string, n long")
        .groupBy("word").agg(F.sum("n").alias("n")).collect()  # the vocabulary of the templates
    )
    n = {r["word"]: r["n"] for r in rows}
    total = n.pop("\n", 0)
    return core.Index({w: math.log((1 + total) / (1 + n.get(w.decode(), 0))) for w in core.VOCABULARY})


def scan(docs: DataFrame, index: core.Index, text: str = "text") -> Column:
    """Struct column: words, starts of all phrase places in order, labels of
    phrases, all labels, and the best share of a template's words in place."""
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(index)

    @F.pandas_udf(_RESULT)
    def scanned(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(
            [held.value.scan(t) for t in texts], columns=["n_words", "places", "base_labels", "labels", "score"]
        )

    return scanned(F.col(text))
