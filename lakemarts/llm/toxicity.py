"""Operator 8, toxicity: a character n-gram linear classifier whose features
are scaled by naive Bayes log-count ratios, fitted on labelled text.

``fit_model`` takes a bounded sample of the labelled rows (``FIT_ROWS``, the
rows with the smallest hash of doc_id): a Spark job counts the rows of either
label per feature, the clearest features and their ratios are chosen from
these counts, and logistic regression is fitted on the sample's rows reduced
to those features.  ``score_texts`` applies the model to every whole text in
Arrow batches; nothing is shuffled.

Inputs: a document with several labels counts as toxic if one says so; null
labels and labels of unknown documents are ignored, and of documents that
repeat a doc_id one row is learned from.  Without labels of both classes all
scores are the smoothed share of toxic labels (no labels: 1/3, not toxic).
Null and empty texts get the model's intercept as score.  Very long texts are
read whole, a piece at a time.  Features of equal ratio are taken in order of
their hash, rows of equal hash in order of doc_id.  Other columns are ignored,
whatever their names.  Repeated rows are
scored each; a null doc_id is never learned from and counts as not held out.
Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemarts.llm import nbsvm_core as core
from lakemarts.llm.common import ship, stored

#: Labelled rows that the model is fitted on, at most.
FIT_ROWS = 8000
FOLDS = 5
#: Sampled rows that a feature occurs in at least.
LEAST_ROWS = 3


def held_out(doc_id: str = "doc_id", folds: int = FOLDS) -> Column:
    """True for documents that no model learns from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == 0, F.lit(False))


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    @property
    def wanted(self) -> np.ndarray:
        """Per hash bucket, whether one of its features has a weight."""
        return (self.weights != 0).reshape(len(core.LEVELS), -1).any(axis=0)


def fit_model(docs: DataFrame, labels: DataFrame, label: str = "toxic", fit_rows: int = FIT_ROWS) -> Model:
    spark = docs.sparkSession
    ship(spark)
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out())
        .groupBy("doc_id").agg((F.max(label) > 0).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    )
    # at most fit_rows pairs of numbers
    sample = stored(
        docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]), "toxicity-sample"
    )

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = np.zeros((2, core.SIZE), dtype=np.int64)
        for batch in batches:
            for text, y in zip(batch["text"], batch["label"]):
                held[y, core.features(text)] += 1
        y, feature = np.nonzero(held)
        yield pd.DataFrame({"label": y, "feature": feature, "n": held[y, feature]})

    # no feature of fewer rows can be clear enough; this leaves most of them out
    counts = (
        sample.select("text", "label").mapInPandas(count, "label int, feature int, n long")
        .groupBy("feature")
        .agg(F.sum(F.col("n") * (1 - F.col("label"))).alias("n0"), F.sum(F.col("n") * F.col("label")).alias("n1"))
        .where(F.col("n0") + F.col("n1") >= LEAST_ROWS).toPandas()  # a row per feature of the hash space at most
    )
    held = np.zeros((2, core.SIZE), dtype=np.int64)
    held[0, counts["feature"]], held[1, counts["feature"]] = counts["n0"], counts["n1"]
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    r = core.ratios(held, sizes.get(0, 0), sizes.get(1, 0))
    wanted = spark.sparkContext.broadcast((r != 0).reshape(len(core.LEVELS), -1).any(axis=0))
    useful = spark.sparkContext.broadcast(r != 0)

    @F.pandas_udf("binary")
    def reduced(texts: pd.Series) -> pd.Series:
        rows = (core.features(t, wanted.value) for t in texts)
        return pd.Series([row[useful.value[row]].tobytes() for row in rows])

    rows = sample.select("doc_id", "label", reduced("text").alias("features")).toPandas().sort_values("doc_id")
    weights, bias = core.fit(
        [np.frombuffer(b, dtype=np.int32) for b in rows["features"]], rows["label"].to_numpy(dtype=float), r
    )
    return Model(weights, bias)


def score_texts(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """Column of scores (0 to 1) of the texts."""
    ship(docs.sparkSession)
    used = np.flatnonzero(model.weights)
    held = docs.sparkSession.sparkContext.broadcast((used, model.weights[used], model.bias))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features, values, bias = held.value
        weights = np.zeros(core.SIZE)
        weights[features] = values
        wanted = Model(weights, bias).wanted
        for texts in batches:
            yield pd.Series([core.score(core.features(t, wanted), weights, bias) for t in texts], dtype=float)

    return score(F.col(text))


def toxicity_scores(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``."""
    model = fit_model(docs, labels, fit_rows=fit_rows)
    return docs.select("doc_id", held_out().alias("held_out"), score_texts(docs, model).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The documents that score under ``threshold``; all columns stay."""
    model = fit_model(docs, labels, fit_rows=fit_rows)
    return docs.where(score_texts(docs, model) < threshold)
