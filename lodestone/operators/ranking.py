"""Scores and ranking phases."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions import text as tx
from lodestone.functions.text import DEFAULT, Analyzer, as_col
from lodestone.operators.order import ONE_TASK_ROWS, number_rows, top, with_position
from lodestone.session import BROADCAST_ROWS, cut

# The usual BM25 parameters.
K1, B = 1.2, 0.75


def corpus_stats(docs: DataFrame, text: Column | str, terms: Sequence, an: Analyzer = DEFAULT, length: Column | None = None) -> DataFrame:
    """One row: document count, mean token count, document frequency per term.

    A maintained one-row table of the same shape can stand in for it; ``length`` is a
    stored token count, which spares tokenising the whole corpus.
    """
    length = tx.token_count(text, an) if length is None else length
    has = [F.count_if(_has(text, t, an)).alias(f"df{i}") for i, t in enumerate(terms)]
    return docs.agg(F.count(F.lit(1)).alias("n"), F.avg(length).alias("avg_len"), *has)


def _has(text, term, an: Analyzer) -> Column:
    return tx.equiv(text, term, an) if isinstance(term, (list, tuple)) else tx.contains(text, term, an)


def bm25(
    docs: DataFrame,
    text: Column | str,
    terms: Sequence,
    name: str = "bm25",
    an: Analyzer = DEFAULT,
    where: Column | None = None,
    filter_terms: Sequence[str] = (),
    length: Column | None = None,
    stats: DataFrame | None = None,
    matched_only: bool = True,
) -> DataFrame:
    """Adds the BM25 score of the query terms (a list entry that is a list is one synonym).

    ``filter_terms`` must match but add nothing to the score.  The corpus statistics are a
    scalar subquery: one partial aggregate per task and one row to the plan - no join and
    no shuffle of documents.  Only rows that hold a term are tokenised a second time.
    ``where`` restricts the hits, not the statistics.
    """
    terms = list(terms)
    base = stats if stats is not None else corpus_stats(docs, text, terms, an, length)
    packed = base.select(F.struct(*base.columns).alias("s"))
    out = docs if where is None else docs.where(where)
    for t in filter_terms:
        out = out.where(tx.contains(text, t, an))
    if matched_only and terms:
        flat = [w if isinstance(w, str) else list(w) for w in terms]
        hit = None
        for t in flat:
            h = _has(text, t, an)
            hit = h if hit is None else hit | h
        out = out.where(hit)
    s = packed.scalar()
    out = out.withColumn("_s", s).withColumn("_len", tx.token_count(text, an) if length is None else length)
    score = _bm25_sum([tx.term_count(text, t, an) for t in terms], F.col("_len"), F.col("_s"))
    return out.withColumn(name, score).drop("_s", "_len")


def text_features(
    docs: DataFrame, key: str, text: Column | str, terms: Sequence, an: Analyzer = DEFAULT, where: Column | None = None,
    length: Column | None = None,
) -> DataFrame:
    """Per document the token count and each term's count: all that BM25 needs of a text.

    ``_in`` marks the rows that may be hits.
    """
    return docs.select(
        key,
        (F.lit(True) if where is None else F.coalesce(where, F.lit(False))).alias("_in"),
        (tx.token_count(text, an) if length is None else length).alias("_len"),
        *[tx.term_count(text, t, an).alias(f"_tf{i}") for i, t in enumerate(terms)],
    )


def score_features(features: DataFrame, n_terms: int, all_terms: bool = False, name: str = "relevance") -> DataFrame:
    """BM25 from a feature table: statistics over all its rows, scores for the hits."""
    tfs = [F.col(f"_tf{i}") for i in range(n_terms)]
    stats = features.agg(
        F.struct(
            F.count(F.lit(1)).alias("n"), F.avg("_len").alias("avg_len"),
            *[F.count_if(tf > 0).alias(f"df{i}") for i, tf in enumerate(tfs)],
        ).alias("s")
    )
    held = [(tf > 0).cast("int") for tf in tfs]
    matched = sum(held[1:], held[0]) >= (n_terms if all_terms else 1)
    hits = features.where(F.col("_in") & matched).withColumn("_s", stats.scalar())
    return hits.withColumn(name, _bm25_sum(tfs, F.col("_len"), F.col("_s"))).drop("_s")


def _bm25_sum(tfs: Sequence[Column], length: Column, s: Column) -> Column:
    score = F.lit(0.0)
    for i, tf in enumerate(tfs):
        df, tf = s[f"df{i}"], tf.cast("double")
        idf = F.ln(1 + (s["n"] - df + 0.5) / (df + 0.5))
        score = score + idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / s["avg_len"]))
    return score


def bm25_scores(
    docs: DataFrame, key: str, text: Column | str, terms: Sequence, name: str = "bm25", an: Analyzer = DEFAULT,
    where: Column | None = None, filter_terms: Sequence[str] = (), length: Column | None = None,
) -> DataFrame:
    """Key and score of the hits, as :func:`bm25` scores them, from one read of the texts.

    Counts of all documents are kept in a narrow table; statistics and scores are both taken from it.
    """
    for t in filter_terms:
        held = tx.contains(text, t, an)
        where = held if where is None else where & held
    features = cut(text_features(docs, key, text, terms, an, where, length))
    return score_features(features, len(terms), name=name).select(key, name)


def weak_and(
    docs: DataFrame, key: str, text: Column | str, terms: Sequence, target_hits: int = 100, replace_by_and: bool = False,
    where: Column | None = None, an: Analyzer = DEFAULT, length: Column | None = None,
) -> DataFrame:
    """Any operand matches, best ``target_hits`` by BM25; the switch demands all operands.

    The texts are read once: statistics and scores both come from the small feature table,
    which is cut to reliable storage.  The winners fetch their other columns in a second
    scan that reads the text only if the caller selects it.
    """
    features = cut(text_features(docs, key, text, terms, an, where, length))
    scored = score_features(features, len(terms), replace_by_and).select(key, "relevance")
    best = top(scored, [F.col("relevance").desc(), F.col(key).asc()], target_hits)
    return docs.join(_bounded(best, target_hits), key)


def freshness(ts: Column | str, now: str) -> Column:
    """Age in seconds at a pinned time."""
    seconds = lambda c: F.unix_timestamp(c.cast("timestamp"))
    return seconds(F.lit(now)) - seconds(as_col(ts))


# -- phases --------------------------------------------------------------------------------------


def first_phase(df: DataFrame, score: Column, drop_below: float | None = None) -> DataFrame:
    """Score every match; optionally drop scores below a limit."""
    out = df.withColumn("relevance", score.cast("double"))
    return out if drop_below is None else out.where(F.col("relevance") >= drop_below)


def _bounded(best: DataFrame, count: int) -> DataFrame:
    """``best`` has at most ``count`` rows; only a small count is worth a broadcast."""
    return F.broadcast(best) if count <= BROADCAST_ROWS else best


def rerank(df: DataFrame, key: str, score: Column, count: int, phase: int = 2) -> DataFrame:
    """Re-score the best ``count`` rows; they come first, the rest keep their order.

    ``phase`` holds the last phase that scored a row.  Several phases in a row belong in one :func:`phases`.
    """
    return phases(df, key, [(score, count)], start=phase)


def phases(df: DataFrame, key: str, steps: Sequence[tuple[Column, int]], keep: int | None = None, start: int = 2) -> DataFrame:
    """Score in steps: each re-scores the best ``count`` rows of the order that the step before left.

    A row beyond the largest count of the first order can enter no step, so the best rows are found once, with the columns that the
    scores read, and all steps run on them alone.  All rows then stream once past that bounded table: two scans at any number
    of steps.  A score over long texts belongs on :func:`text_features`, or the heaps of the first scan hold the texts.
    ``keep`` leaves a score to so many rows of the first order only; where a step takes more rows than that, unscored ones follow by
    key, for which the kept rows are found in a scan before.  ``key`` is unique.
    """
    if "phase" not in df.columns:
        df = df.withColumn("phase", F.lit(1))
    most = max([n for _, n in steps], default=0)
    if keep is not None and (keep < most or not steps):
        df, keep = keep_rank(df, key, keep), None
    if not steps:
        return df
    most = max(most, keep or 0)
    by = phase_order(key)
    head = top(df, by, most)
    if keep is not None:
        head = _placed(head, by, most)
        head = head.withColumn("relevance", F.when(F.col("_at") < keep, F.col("relevance"))).drop("_at")
    for i, (score, count) in enumerate(steps):
        if count < most:
            head = _placed(head, by, most)
            chosen = F.col("_at") < count
        else:
            chosen = F.lit(True)
        head = head.withColumns({
            "relevance": F.when(chosen, score.cast("double")).otherwise(F.col("relevance")),
            "phase": F.when(chosen, F.lit(start + i)).otherwise(F.col("phase")),
        }).drop("_at")
    head = head.select(key, F.col("relevance").alias("_relevance"), F.col("phase").alias("_phase"))
    out = df.join(_bounded(head, most), key, "left")
    rest = F.lit(None).cast("double") if keep is not None else F.col("relevance")
    inside = F.col("_phase").isNotNull()
    return out.withColumns({
        "relevance": F.when(inside, F.col("_relevance")).otherwise(rest),
        "phase": F.when(inside, F.col("_phase")).otherwise(F.col("phase")),
    }).drop("_relevance", "_phase")


def _placed(head: DataFrame, by: Sequence[Column], most: int) -> DataFrame:
    """``_at`` is a row's place from 0; a table that one task should not hold is numbered in ranges."""
    return with_position(head, by, "_at", 0) if most <= ONE_TASK_ROWS else number_rows(head, by, "_at")


def phase_order(key: str) -> list[Column]:
    """Rows of a later phase first, then score, then id."""
    return [F.col("phase").desc(), F.col("relevance").desc_nulls_last(), F.col(key).asc()]


def keep_rank(df: DataFrame, key: str, count: int) -> DataFrame:
    """Only the best ``count`` rows keep their score; the others stay, unscored.

    The score and key of the last row that keeps its score are a scalar subquery over a bounded top-k: no join, and nothing is
    sent to every task but that pair.
    """
    best = top(df, [F.col("relevance").desc(), F.col(key).asc()], count).where(F.col("relevance").isNotNull())
    # the worst score's largest key; Spark orders NaN above all numbers, as the order here does
    worst = best.groupBy("relevance").agg(F.max(key).alias("k")).agg(F.min(F.struct("relevance", "k")).alias("last"))
    out = df.withColumn("_last", worst.scalar())
    score, last = F.col("relevance"), F.col("_last")
    kept = (score > last["relevance"]) | ((score == last["relevance"]) & (F.col(key) <= last["k"]))
    return out.withColumn("relevance", F.when(kept, score)).drop("_last")


def match_phase(df: DataFrame, key: str, attribute: str, max_hits: int, ascending: bool = False) -> DataFrame:
    """The best ``max_hits`` by an attribute go on to scoring."""
    first = F.col(attribute).asc() if ascending else F.col(attribute).desc()
    return top(df, [first, F.col(key).asc()], max_hits)


def match_phase_diverse(
    df: DataFrame, key: str, attribute: str, max_hits: int, group: str, min_groups: int, ascending: bool = False
) -> DataFrame:
    """As :func:`match_phase` with at most ``ceil(max_hits / min_groups)`` hits per group."""
    first = F.col(attribute).asc() if ascending else F.col(attribute).desc()
    per_group = -(-max_hits // min_groups)
    w = Window.partitionBy(group).orderBy(first, F.col(key).asc())
    diverse = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= per_group).drop("_rn")
    return match_phase(diverse, key, attribute, max_hits, ascending)


def match_features(**features: Column) -> Column:
    """Named feature values of a hit as one map."""
    return F.create_map(*[x for n, c in features.items() for x in (F.lit(n), c.cast("double"))])


@dataclass(frozen=True)
class RankProfile:
    """Named phases and functions; ``inherits`` fills what is not set here.

    A function or phase is called with a mapping of query-time inputs and the functions
    resolved so far, and returns a Column.
    """

    name: str
    first: Callable[[Mapping], Column] | None = None
    second: Callable[[Mapping], Column] | None = None
    second_count: int | None = None
    global_: Callable[[Mapping], Column] | None = None
    global_count: int | None = None
    drop_below: float | None = None
    keep_count: int | None = None
    functions: Mapping[str, Callable] = field(default_factory=dict)
    inputs: Mapping[str, object] = field(default_factory=dict)
    features: Sequence[str] = ()
    inherits: "RankProfile | None" = None

    def resolved(self) -> "RankProfile":
        if self.inherits is None:
            return self
        p = self.inherits.resolved()
        pick = lambda mine, theirs: theirs if mine is None else mine
        return RankProfile(
            self.name, pick(self.first, p.first), pick(self.second, p.second), pick(self.second_count, p.second_count),
            pick(self.global_, p.global_), pick(self.global_count, p.global_count), pick(self.drop_below, p.drop_below),
            pick(self.keep_count, p.keep_count), {**p.functions, **self.functions}, {**p.inputs, **self.inputs},
            tuple(self.features) or tuple(p.features),
        )


def rank(df: DataFrame, key: str, profile: RankProfile, inputs: Mapping[str, object] | None = None) -> DataFrame:
    """Run a profile's phases; adds ``relevance``, ``phase`` and, if named, ``match_features``."""
    p = profile.resolved()
    env: dict = {k: F.lit(v) if not isinstance(v, (Column, list, tuple)) else v for k, v in {**p.inputs, **(inputs or {})}.items()}
    for name, fn in p.functions.items():
        env[name] = (lambda fn: lambda *a: fn(env, *a))(fn)
    out = first_phase(df, p.first(env) if p.first else F.lit(0.0), p.drop_below)
    if p.features:
        values = {f: env[f]() if callable(env.get(f)) else env.get(f, F.col(f)) for f in p.features}
        out = out.withColumn("match_features", match_features(**values))
    steps = []
    if p.second:
        steps.append((p.second(env), 100 if p.second_count is None else p.second_count))
    if p.global_:
        steps.append((p.global_(env), 100 if p.global_count is None else p.global_count))
    return phases(out, key, steps, p.keep_count, start=2 if p.second else 3)
