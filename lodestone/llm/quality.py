"""Quality by co-training: a classifier of the text and one of the page's metadata teach each other, then both are calibrated and combined."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import U, hashes, plain_words, store
from lodestone.llm.toxicity import Ftrl

BITS = 18
SOURCES, LANGS, SHAPE = 64, 16, 8
META = SHAPE + SOURCES + LANGS + 1
SAMPLE = 12_000  # bound of the labelled rows, and of the unlabelled ones, that take part in training
ROWS_PER_LEARNER = 3_000
ROUNDS = 3
SURE = 0.95  # a view's probability beyond which it labels a row for the other view


class Model(NamedTuple):
    text: np.ndarray  # weights of hashed words, the last one the intercept
    meta: np.ndarray
    text_scale: np.ndarray  # slope and intercept that calibrate a view's logit
    meta_scale: np.ndarray
    both: np.ndarray  # weights of the two calibrated logits and the intercept


def text_view(text: bytes | None) -> np.ndarray:
    """Distinct hashed words."""
    return np.unique(hashes(plain_words(text or b"")) >> U(64 - BITS)).astype(np.int32)


def meta_view(text: bytes | None, source: str | None, lang: str | None) -> np.ndarray:
    """What is known of the page besides its words: lengths, shares of kinds of characters, source and language."""
    t = text or b""
    x = np.zeros(META)
    b = np.frombuffer(t, np.uint8)
    n = max(1, len(b))
    lines = t.count(b"\n") + 1
    x[:SHAPE] = (
        np.log1p(len(b)) / 10, np.log1p(lines) / 5, np.log1p(len(b) / lines) / 8, np.count_nonzero((b >= 48) & (b < 58)) / n,
        np.count_nonzero((b >= 65) & (b < 91)) / n, np.count_nonzero(b == 32) / n, np.count_nonzero(b > 127) / n,
        np.count_nonzero((b > 32) & (b < 48) | (b > 57) & (b < 65) | (b > 90) & (b < 97) | (b > 122) & (b < 127)) / n,
    )
    named = hashes([str(source).encode(), str(lang).encode()])
    x[SHAPE + int(named[0] % U(SOURCES))] = 1
    x[SHAPE + SOURCES + int(named[1] % U(LANGS))] = 1
    x[-1] = 1
    return x


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, steps: int = 12) -> np.ndarray:
    """Weighted logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = _sigmoid(x @ w)
        g = x.T @ (weight * (p - y)) + ridge * w
        h = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w))
        w = w - np.linalg.solve(h, g)
    return w


def _logits(model: Model, text: bytes | None, source, lang) -> tuple[float, float]:
    return model.text[text_view(text)].sum() + model.text[-1], float(model.meta @ meta_view(text, source, lang))


def _combine(model: Model, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ca, cb = a * model.text_scale[0] + model.text_scale[1], b * model.meta_scale[0] + model.meta_scale[1]
    return _sigmoid(ca), _sigmoid(cb), _sigmoid(ca * model.both[0] + cb * model.both[1] + model.both[2])


def _bounded(rows: DataFrame, n: int, bound: int) -> DataFrame:
    return rows.where(F.pmod(F.xxhash64(F.lit(11), "__id"), F.lit(1_000_000)) < int(min(1.0, bound / max(1, n)) * 1_000_000))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, rounds: int = ROUNDS) -> Model:
    """Train on at most about ``sample`` labelled and as many unlabelled rows, chosen by hash of the id.

    A fifth of the labelled rows is left for calibration. In each round every learner trains both views on its part: labelled
    rows, and unlabelled ones that the other view of the last round is sure of; the weights are averaged over the learners.
    """
    truth = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("__id"))
    truth = truth.agg(F.min("quality").cast("double").alias("y"))
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("binary").alias("text"), "source", "lang").where(F.col("__id").isNotNull())
    known = rows.join(_bounded(truth, truth.count(), sample), "__id")
    unknown = _bounded(rows, docs.count(), sample).join(truth, "__id", "left_anti").withColumn("y", F.lit(None).cast("double"))

    def extract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            at = [text_view(t) for t in f["text"]]
            meta = [meta_view(t, s, g) for t, s, g in zip(f["text"], f["source"], f["lang"])]
            yield pd.DataFrame({"id": f["id"], "y": f["y"], "at": at, "meta": meta})

    both = known.unionByName(unknown).select(F.xxhash64("__id").alias("id"), "y", "text", "source", "lang")
    both = store(both.mapInPandas(extract, "id bigint, y double, at array<int>, meta array<double>"), "quality-features")
    learners = max(1, round(both.where("y is not null").count() / ROWS_PER_LEARNER))
    kept_out = F.col("y").isNotNull() & (F.pmod("id", F.lit(5)) == 0)
    train = both.where(~kept_out).withColumn("part", F.pmod(F.xxhash64("id"), F.lit(learners)).cast("int"))
    spark = docs.sparkSession
    size = 1 << BITS
    text_w, meta_w = np.zeros(size + 1), np.zeros(META)
    for turn in range(rounds):
        last, told_before = spark.sparkContext.broadcast((text_w, meta_w)), turn > 0

        def learn(part: pd.DataFrame) -> pd.DataFrame:
            a, b = last.value
            part = part.sort_values("id")
            at, x, y = [np.asarray(i, np.int64) for i in part["at"]], np.stack(part["meta"].to_numpy()), part["y"].to_numpy()
            by_text, by_meta = _sigmoid(np.array([a[i].sum() + a[-1] for i in at])), _sigmoid(x @ b)
            told = lambda p: np.where(p >= SURE, 1.0, np.where(p <= 1 - SURE, 0.0, np.nan)) if told_before else np.full(len(p), np.nan)
            y_text, y_meta = np.where(np.isnan(y), told(by_meta), y), np.where(np.isnan(y), told(by_text), y)
            seen = np.bincount(np.concatenate([*at, np.zeros(0, np.int64)]), minlength=size)
            good = (seen >= 5) & (seen <= max(0.5 * len(at), 5))
            learner = Ftrl(size=size, alpha=1.0, l1=3.0, positive=1.0)
            cases = [(i[good[i]], t) for i, t in zip(at, y_text) if not np.isnan(t)]
            for epoch in range(4):
                for k in np.random.default_rng(epoch).permutation(len(cases)):
                    learner.learn(*cases[k])
            use = ~np.isnan(y_meta)
            w_meta = logistic(x[use], y_meta[use], np.where(np.isnan(y[use]), 0.5, 1.0))
            w = learner.weights(np.arange(size + 1))
            f = np.flatnonzero(w)
            return pd.DataFrame({"view": [0] * len(f) + [1] * META, "f": np.append(f, np.arange(META)), "w": np.append(w[f], w_meta)})

        learned = train.groupBy("part").applyInPandas(learn, "view int, f bigint, w double")
        mean = learned.groupBy("view", "f").agg((F.sum("w") / learners).alias("w")).toPandas()
        text_w, meta_w = np.zeros(size + 1), np.zeros(META)
        for view, into in ((0, text_w), (1, meta_w)):
            of = mean[mean["view"] == view]
            into[of["f"].to_numpy(np.int64)] = of["w"].to_numpy()
    final = spark.sparkContext.broadcast((text_w, meta_w))

    def calibrate(rows: pd.DataFrame) -> pd.DataFrame:
        a, b = final.value
        rows = rows.sort_values("id")
        y = rows["y"].to_numpy()
        la = np.array([a[np.asarray(i, np.int64)].sum() + a[-1] for i in rows["at"]])
        lb = np.stack(rows["meta"].to_numpy()) @ b
        one = np.ones(len(y))
        sa, sb = (logistic(np.stack([v, one], 1), y, one, 0.1) for v in (la, lb))
        c = logistic(np.stack([la * sa[0] + sa[1], lb * sb[0] + sb[1], one], 1), y, one, 0.1)
        return pd.DataFrame({"k": range(7), "w": np.concatenate([sa, sb, c])})

    held = both.where(kept_out).withColumn("all", F.lit(0)).groupBy("all").applyInPandas(calibrate, "k int, w double").orderBy("k").toPandas()["w"].to_numpy()
    if len(held) != 7:
        held = np.array([1.0, 0, 1, 0, 0.5, 0.5, 0])
    return Model(text_w, meta_w, held[:2], held[2:4], held[4:])


def score(spark, text: Column, source: Column, lang: Column, model: Model) -> Column:
    """A struct of the calibrated probabilities of both views and of their combination."""
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for t, s, g in batches:
            logits = np.array([_logits(m, *row) for row in zip(t, s, g)]).reshape(-1, 2)
            a, b, c = _combine(m, logits[:, 0], logits[:, 1])
            yield pd.DataFrame({"text_score": a, "meta_score": b, "score": c})

    run.__annotations__ = {"batches": Iterator[tuple[pd.Series, pd.Series, pd.Series]], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, "text_score double, meta_score double, score double")(text.cast("binary"), source.cast("string"), lang.cast("string"))


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """Per row ``doc_id, text_score, meta_score, score, keep``; ``score`` is the probability of label 1, ``keep`` is 1 from 0.5 on.

    Null and empty texts have no words and are scored by their metadata and the intercepts. A null source or language is a value of
    its own. Null ids are scored and never learned from. Contradicting labels of an id count as 0. Without labels every score is
    0.5. Repeated rows get equal scores. Whole texts are read. An empty table gives no rows.
    """
    model = fit(docs, labels, id_col, text_col, **how)
    s = score(docs.sparkSession, F.col(text_col), F.col("source"), F.col("lang"), model)
    return docs.select(F.col(id_col).alias("doc_id"), s.alias("s")).select("doc_id", "s.*", (F.col("s.score") >= 0.5).cast("int").alias("keep"))
