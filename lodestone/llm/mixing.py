"""Mixing sources to target weights: iterative proportional fitting of token weights, then calibrated sampling."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestone.llm.common import U, apart, given_back, hashes, plain_words, row_key, store, unit
from lodestone.session import small_side

TOPICS = 8


def topic_and_tokens(text: Column, topics: int = TOPICS) -> Column:
    """A struct of the number of words and a topic: words of six bytes or more are dealt to topics by hash, and the topic with
    most of the text's words wins, the smaller number on a tie; -1 without such words."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            n, best = np.zeros(len(texts), np.int64), np.full(len(texts), -1, np.int32)
            for i, t in enumerate(texts):
                words = plain_words(t or b"")
                n[i] = len(words)
                long = [w for w in words if len(w) >= 6]
                if long:
                    best[i] = np.bincount((hashes(long) % U(topics)).astype(np.int64), minlength=topics).argmax()
            yield pd.DataFrame({"tokens": n, "topic": best})

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, "tokens bigint, topic int")(text.cast("binary"))


def tempered(cells: DataFrame, column: str, power: float) -> DataFrame:
    """Target shares of a column's values: token shares raised to a power below one, which lifts rare values."""
    sums = cells.groupBy(column).agg(F.pow(F.sum("tokens"), F.lit(power)).alias("s")).where("s > 0")
    total = sums.agg(F.sum("s").alias("all"))
    whole = total.first()["all"] or 1.0
    return sums.select(column, (F.col("s") / F.lit(float(whole))).alias("share"))


def rake(
    cells: DataFrame, targets: dict[str, DataFrame], fraction: float, sweeps: int = 12, tolerance: float = 1e-3
) -> DataFrame:
    """Weights ``w`` of cells such that their sums meet the target shares of ``fraction`` of all tokens in every marginal.

    ``targets`` names for each column a table ``(value, share)``. Each sweep scales the weights to one marginal after another and
    never above the cell's own tokens. Sweeps end when all marginals are met within ``tolerance`` of the budget, or after
    ``sweeps`` rounds: targets that the tokens cannot meet are met as nearly as the sweeps come. A value without a target gets
    weight 0. The cells are one row per combination of values, however many documents they hold.
    """
    budget = fraction * float(cells.agg(F.sum("tokens")).first()[0] or 0)
    for i, (column, shares) in enumerate(targets.items()):
        goal = shares.select(F.col(column).alias("__v"), (F.col("share") * budget).alias(f"__t{i}"))
        cells = cells.join(goal, cells[column].eqNullSafe(goal["__v"]), "left").drop("__v").fillna(0.0, [f"__t{i}"])
    now = store(cells.withColumn("w", F.col("tokens") * fraction), "cells")
    for _ in range(sweeps):
        step = now
        for i, column in enumerate(targets):
            total = F.sum("w").over(Window.partitionBy(column))
            step = step.withColumn("w", F.when(total > 0, F.least(F.col("tokens").cast("double"), F.col("w") * F.col(f"__t{i}") / total)).otherwise(0.0))
        now = store(step, "cells")
        off = None
        for i, column in enumerate(targets):
            d = now.groupBy(column).agg(F.abs(F.sum("w") - F.first(f"__t{i}")).alias("d")).agg(F.sum("d").alias("d"))
            off = d if off is None else off.unionAll(d)
        if (off.agg(F.max("d")).first()[0] or 0.0) <= tolerance * budget:
            break
    return now.drop(*[f"__t{i}" for i in range(len(targets))])


def calibrated(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", by: Sequence[str] = ("source", "lang"),
    power: float = 0.7, fraction: float = 0.7, seed: int = 5, topics: int = TOPICS, targets: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Every row with ``__tokens, __topic, __probability, __sampled`` behind its own columns; where the caller has a column of such
    a name, it keeps it and ours gets an underscore behind.

    Target shares are the tempered token shares of each column of ``by`` and of the topic, or those of ``targets`` (keys as ``by``
    and ``topic``). A row is sampled if the hash of its id and text, as a number in [0, 1), is below its cell's weight over
    the cell's tokens; so equal rows are sampled together, and a rerun samples the same rows.

    A null value of ``by`` is a value of its own. Rows without words have no tokens to weigh: probability 1. An empty table gives
    no rows.
    """
    out, names = _calibrated(docs, id_col, text_col, by, power, fraction, seed, topics, targets)
    return given_back(out, names, ["__tokens", "__topic", "__probability", "__sampled"])


def _calibrated(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", by: Sequence[str] = ("source", "lang"),
    power: float = 0.7, fraction: float = 0.7, seed: int = 5, topics: int = TOPICS, targets: dict[str, DataFrame] | None = None,
) -> tuple[DataFrame, dict[str, str]]:
    """:func:`calibrated` before the caller's columns get their names back, and their names there."""
    targets = targets or {}
    docs, names = apart(docs)
    id_col, text_col, columns = names[id_col], names[text_col], [names[c] for c in by]
    k1, k2 = row_key(F.col(id_col), F.col(text_col))
    marked = docs.withColumn("__m", topic_and_tokens(F.col(text_col), topics)).withColumns(
        {"__tokens": F.col("__m.tokens"), "__topic": F.col("__m.topic")}
    ).drop("__m")
    parts = [f"b{i}" for i in range(len(by))]
    cells = marked.groupBy(*[F.col(c).alias(n) for c, n in zip(columns, parts)], F.col("__topic").alias("topic")).agg(F.sum("__tokens").alias("tokens"))
    cells = store(cells.where("tokens > 0"), "tokens-by-cell")
    goals = {}
    for column, name in [*zip(by, parts), ("topic", "topic")]:
        given = targets.get(column)
        goals[name] = given.select(F.col(column).alias(name), "share") if given is not None else tempered(cells, name, power)
    share = rake(cells, goals, fraction).select(*[F.col(n).alias(f"__{n}") for n in parts], F.col("topic").alias("__t"), (F.col("w") / F.col("tokens")).alias("__p"))
    share = small_side(share)
    on = F.col("__topic") == F.col("__t")
    for column, name in zip(columns, parts):
        on &= marked[column].eqNullSafe(share[f"__{name}"])
    out = marked.join(share, on, "left").drop("__t", *[f"__{n}" for n in parts])
    out = out.withColumn("__probability", F.when(F.col("__tokens") > 0, F.coalesce("__p", F.lit(0.0))).otherwise(1.0)).drop("__p")
    return out.withColumn("__sampled", unit(F.xxhash64(F.lit(seed), k1, k2)) < F.col("__probability")), names


def mixed(docs: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """Per row ``doc_id, source, lang, topic, tokens, probability, sampled``."""
    out, names = _calibrated(docs, id_col, **how)
    return out.select(
        F.col(names[id_col]).alias("doc_id"), "source", "lang", F.col("__topic").alias("topic"), F.col("__tokens").alias("tokens"),
        F.col("__probability").alias("probability"), F.col("__sampled").alias("sampled"),
    )


def sample(docs: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """The sampled rows with their own columns."""
    out, names = _calibrated(docs, id_col, **how)
    return given_back(out.where("__sampled"), names)
