"""Toxicity scores by FTRL-proximal logistic regression over hashed words, pairs of words and skip pairs."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import U, hashes, mix, plain_words, store

BITS = 22  # hash space: the lower half for words, the upper half for pairs and skip pairs
SAMPLE = 24_000  # bound of the labelled rows that the model is fitted on
ROWS_PER_LEARNER = 3_000  # the sample is dealt to learners of about so many rows, whose sparse weights are averaged
SEEN = (5, 0.1)  # a feature is admitted if at least 5 and at most a tenth of a learner's rows have it
POSITIVE = 6.0  # weight of a toxic row's gradient


class Model(NamedTuple):
    """Sparse weights: sorted feature numbers and their values, and the intercept."""

    features: np.ndarray
    weights: np.ndarray
    bias: float


def features(text: bytes | None) -> np.ndarray:
    """Distinct feature numbers of a whole text."""
    h = hashes(plain_words(text or b""))
    half = U(1 << (BITS - 1))
    one = h >> U(65 - BITS)
    pair = (mix(h[:-1] * U(3) + h[1:]) >> U(65 - BITS)) + half
    skip = (mix(h[:-2] * U(5) + h[2:]) >> U(65 - BITS)) + half
    return np.unique(np.concatenate([one, pair, skip])).astype(np.int32)


class Ftrl:
    """One learner: per-coordinate rates from summed squared gradients, L1 keeps unneeded weights at exactly zero."""

    def __init__(
        self, alpha: float = 2.0, beta: float = 1.0, l1: float = 6.0, l2: float = 0.001, size: int = 1 << BITS, positive: float = POSITIVE
    ):
        self.alpha, self.beta, self.l1, self.l2, self.size, self.positive = alpha, beta, l1, l2, size, positive
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, at: np.ndarray, y: float) -> None:
        at = np.append(at, self.size)  # the last coordinate is the intercept
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y
        g *= self.positive if y else 1.0
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, sample: int) -> DataFrame:
    """Rows ``text, y`` to learn from: label rows outside the held-out third, at most about ``sample``, chosen by hash of the id.

    Contradicting labels of one id count as toxic. Null labels, null ids and null texts teach nothing.
    """
    truth = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("__id"))
    truth = truth.agg(F.max("toxic").cast("double").alias("y")).where(~held_out(F.col("__id")))
    share = min(1.0, sample / max(1, truth.count()))
    picked = truth.where(F.pmod(F.xxhash64(F.lit(7), "__id"), F.lit(1_000_000)) < int(share * 1_000_000))
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("binary").alias("text"))
    return rows.where(F.col("text").isNotNull()).join(picked, "__id").select("__id", "text", "y")


def held_out(id_: Column) -> Column:
    return F.coalesce(F.crc32(id_.cast("string")) % 3 == 1, F.lit(False))


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, epochs: int = 8
) -> Model:
    """Fit on a bounded sample of labelled rows: each part of it trains a learner, and their sparse weights are averaged.

    Without any labelled row the model is empty and scores 0.5 everywhere.
    """
    rows = labelled(docs, labels, id_col, text_col, sample)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, ys = b.column(0).to_pylist(), b.column(2).to_pylist()
            found = [features(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({"id": pa.array(ids, pa.int64()), "y": pa.array(ys, pa.float64()), "at": pa.array(found, pa.list_(pa.int32()))})

    rows = rows.select(F.xxhash64("__id").alias("id"), "text", "y")
    sampled = store(rows.mapInArrow(extract, "id bigint, y double, at array<int>"), "toxic-features")
    learners = max(1, round(sampled.count() / ROWS_PER_LEARNER))
    sampled = sampled.withColumn("part", F.pmod("id", F.lit(learners)).cast("int"))

    def train(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["id", "y"])
        learner = Ftrl()
        seen = np.bincount(np.concatenate([*part["at"], np.zeros(0, np.int32)]).astype(np.int64), minlength=1 << BITS)
        admitted = (seen >= SEEN[0]) & (seen <= max(SEEN[1] * len(part), SEEN[0]))
        cases = [(at[admitted[at]].astype(np.int64), y) for at, y in zip(part["at"], part["y"])]
        for epoch in range(epochs):
            for i in np.random.default_rng(epoch).permutation(len(cases)):
                learner.learn(*cases[i])
        w = learner.weights(np.arange((1 << BITS) + 1))
        at = np.flatnonzero(w)
        return pd.DataFrame({"f": at, "w": w[at]})

    learned = sampled.groupBy("part").applyInPandas(train, "f bigint, w double")
    mean = learned.groupBy("f").agg((F.sum("w") / learners).alias("w")).orderBy("f").toPandas()
    bias = float(mean.loc[mean["f"] == 1 << BITS, "w"].sum())
    mean = mean[mean["f"] < 1 << BITS]
    return Model(mean["f"].to_numpy(np.int64), mean["w"].to_numpy(np.float64), bias)


def score(spark, text: Column, model: Model) -> Column:
    """A column with the probability of label 1; null texts score as empty ones."""
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        dense = np.zeros(1 << BITS)
        dense[m.features] = m.weights
        half = U(1 << (BITS - 1))
        shift = U(65 - BITS)
        for batch in batches:
            out = np.empty(len(batch))
            for i, t in enumerate(batch):
                h = hashes(plain_words(t or b""))
                at = np.concatenate([
                    h >> shift, (mix(h[:-1] * U(3) + h[1:]) >> shift) + half, (mix(h[:-2] * U(5) + h[2:]) >> shift) + half,
                ])
                at = at[dense[at] != 0]  # few: distinct ones are counted after this
                out[i] = dense[np.unique(at)].sum() + m.bias
            yield pd.Series(1 / (1 + np.exp(-np.clip(out, -35, 35))))

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "double")(text.cast("binary"))


def toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7, sample: int = SAMPLE
) -> DataFrame:
    """Per row ``doc_id, held_out, score, predicted``.

    Empty and null texts get the intercept's score. A null id is never held out and never learned from. Repeated rows get
    equal scores. Whole texts of any length are read. An empty table gives no rows. Only id, text and the labels are read.
    """
    model = fit(docs, labels, id_col, text_col, sample)
    return docs.select(
        F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), score(docs.sparkSession, F.col(text_col), model).alias("score")
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def reject_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns."""
    model = fit(docs, labels, id_col, text_col)
    return docs.where(score(docs.sparkSession, F.col(text_col), model) < threshold)
