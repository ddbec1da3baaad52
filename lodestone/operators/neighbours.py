"""Nearest neighbours: exact, thresholded, bucketed approximate, hybrid; many queries are in ``knn``."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions import vectors as vx
from lodestone.operators.knn import nearest_join  # noqa: F401  (part of this module's interface)
from lodestone.operators.order import top
from lodestone.operators.ranking import bm25, corpus_stats


def nearest(
    df: DataFrame,
    key: str,
    vector: str,
    query: Sequence[float],
    k: int = 10,
    metric: str = "euclidean",
    where: Column | None = None,
    threshold: float | None = None,
    label: str = "distance",
) -> DataFrame:
    """Exact top ``k``: filter, distance, bounded top-k; ties by id.

    ``label`` names the distance column.  For ``dotproduct`` the best rows have the
    largest product and ``threshold`` is a lower bound.
    """
    if where is not None:
        df = df.where(where)
    score = vx.METRICS[metric](vector, query)
    out = df.withColumn(label, score).where(F.col(label).isNotNull())
    higher = metric == "dotproduct"
    if threshold is not None:
        out = out.where(F.col(label) >= threshold if higher else F.col(label) <= threshold)
    first = F.col(label).desc() if higher else F.col(label).asc()
    return top(out, [first, F.col(key).asc()], k)


# -- approximate: random hyperplane buckets ----------------------------------------------------


def hyperplanes(dims: int, bits: int, tables: int, seed: int = 7) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((tables, bits, dims))


def _planes_literal(planes: np.ndarray) -> str:
    rows = [[f"array({', '.join(f'{x!r}D' for x in p)})" for p in table] for table in planes.tolist()]
    return f"array({', '.join(f'array({", ".join(r)})' for r in rows)})"


def bucket_codes(vector: str, planes: np.ndarray) -> Column:
    """Per table the side of each random hyperplane a vector lies on, as bits; JVM-side, in higher-order functions."""
    inner = f"aggregate(zip_with(`{vector}`, p, (x, y) -> double(x) * y), 0D, (a, x) -> a + x)"
    bits = f"transform(t, (p, i) -> IF({inner} > 0, shiftleft(1, i), 0))"
    return F.expr(f"transform({_planes_literal(planes)}, t -> aggregate({bits}, 0, (a, x) -> a + x))")


def with_buckets(df: DataFrame, vector: str, planes: np.ndarray) -> DataFrame:
    """Adds ``bucket_0..``, the code of each table; a null vector has none."""
    out = df.withColumn("_codes", F.when(F.col(vector).isNotNull(), bucket_codes(vector, planes)))
    return out.withColumns({f"bucket_{t}": F.get("_codes", F.lit(t)) for t in range(len(planes))}).drop("_codes")


def write_buckets(df: DataFrame, vector: str, planes: np.ndarray, path: str, mode: str = "error") -> None:
    """Store every row once a table below ``bucket_table=/bucket=``; codes are computed here and never again.

    Rows are rebalanced by folder: small folders share a task, a folder that holds a large share of the rows is split over several.
    """
    rows = df.where(F.col(vector).isNotNull()).select("*", F.posexplode(bucket_codes(vector, planes)).alias("bucket_table", "bucket"))
    rows.hint("rebalance", "bucket_table", "bucket").write.partitionBy("bucket_table", "bucket").mode(mode).parquet(path)


def probes(query: Sequence[float], planes: np.ndarray, flips: int = 1) -> list[list[int]]:
    """Per table the query's bucket and those up to ``flips`` uncertain bits away."""
    out = []
    for table in planes:
        side = table @ np.asarray(query, dtype="f8")
        home = int(sum(1 << i for i, s in enumerate(side) if s > 0))
        near = np.argsort(np.abs(side))
        found = {home}
        for i in near[: flips * 2]:
            found |= {c ^ (1 << int(i)) for c in found if bin(c ^ home).count("1") < flips}
        out.append(sorted(found))
    return out


def nearest_approximate(
    bucketed: DataFrame, key: str, vector: str, query: Sequence[float], planes: np.ndarray, k: int = 10,
    metric: str = "euclidean", flips: int = 2, where: Column | None = None,
) -> DataFrame:
    """Candidates from the probed buckets of any table, then exact distances."""
    cond = None
    for t, codes in enumerate(probes(query, planes, flips)):
        c = F.col(f"bucket_{t}").isin(codes)
        cond = c if cond is None else cond | c
    return nearest(bucketed.where(cond), key, vector, query, k, metric, where)


def nearest_in_buckets(
    stored: DataFrame, key: str, vector: str, query: Sequence[float], planes: np.ndarray, k: int = 10,
    metric: str = "euclidean", flips: int = 2, where: Column | None = None,
) -> DataFrame:
    """As ``nearest_approximate``, over what ``write_buckets`` has stored: the scan lists the probed folders only."""
    cond = F.lit(False)
    for t, codes in enumerate(probes(query, planes, flips)):
        cond = cond | ((F.col("bucket_table") == t) & F.col("bucket").isin(codes))
    rows = stored.where(cond).drop("bucket_table", "bucket")
    # a row comes once a table at most, so the k best rows are among so many
    hits = nearest(rows, key, vector, query, k * len(planes), metric, where).dropDuplicates([key])
    return top(hits, [F.col("distance").desc() if metric == "dotproduct" else F.col("distance").asc(), F.col(key).asc()], k)


# -- hybrid ---------------------------------------------------------------------------------------


def hybrid(
    docs: DataFrame, key: str, text: str, vector: str, query: Sequence[float], terms: Sequence[str],
    target_hits: int = 100, text_weight: float = 1.0, where: Column | None = None, metric: str = "euclidean",
    stats: DataFrame | None = None, vectors: DataFrame | None = None,
) -> DataFrame:
    """Neighbours retrieve, text adds to the score: ``closeness + weight * bm25``.

    Only the ``target_hits`` retrieved rows are scored on their text.  Where the vectors stand in a table of their own (``vectors``, with the
    same key), rows are retrieved by keys alone, and the texts meet no more than those hits.
    """
    if vectors is None:
        hits = nearest(docs, key, vector, query, target_hits, metric, where)
    else:
        wanted = (docs if where is None else docs.where(where)).select(key)
        found = nearest(vectors.select(key, vector).join(wanted, key, "left_semi"), key, vector, query, target_hits, metric)
        hits = docs.join(F.broadcast(found.select(key, "distance")), key)  # target_hits rows
    if stats is None:
        stats = corpus_stats(docs, text, terms)
    scored = bm25(hits, text, terms, stats=stats, matched_only=False)
    near = F.col("distance") if metric == "dotproduct" else vx.closeness(F.col("distance"))
    out = scored.withColumn("relevance", near + F.lit(float(text_weight)) * F.col("bm25"))
    return out.orderBy(F.col("relevance").desc(), F.col(key).asc())
