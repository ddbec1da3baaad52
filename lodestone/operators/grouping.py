"""Grouping: flat, bucketed, nested, with hits, paged, and as a tree."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions.aggregates import KLL_SIZE, _checked, merged_quantile_state, quantile_state, state_count, state_quantiles
from lodestone.functions.text import as_col
from lodestone.operators.order import number_rows, top
from lodestone.session import cut, range_count

DEFAULT_MAX_GROUPS = 10
DEFAULT_MAX_HITS = 10
# Sub-groups that stand in one array of a tree.
MOST_SUBGROUPS = 100_000


def group_by(
    df: DataFrame,
    keys: Mapping[str, Column | str],
    outputs: Mapping[str, Column],
    *,
    where: Column | None = None,
    order: Sequence[Column] = (),
    max_groups: int | None = None,
    having_key: bool = True,
) -> DataFrame:
    """Group rows by named expressions; null keys form no group.

    ``order`` uses output and key names; the key is the tie-break.  Bounded by
    ``max_groups`` the result is a top-k over partial aggregates.
    """
    if where is not None:
        df = df.where(where)
    df = df.withColumns({n: as_col(c) for n, c in keys.items()})
    if having_key:
        df = df.dropna(subset=list(keys))
    out = df.groupBy(*keys).agg(*[c.alias(n) for n, c in outputs.items()])
    if max_groups is not None:
        out = top(out, [*order, *[F.col(k).asc() for k in keys]], max_groups)
    return out


def each_hit(df: DataFrame, outputs: Mapping[str, Column | str]) -> DataFrame:
    """Outputs per hit, without a group."""
    return df.select(*[as_col(c).alias(n) for n, c in outputs.items()])


def check_group_cap(groups: DataFrame, cap: int) -> DataFrame:
    """Fail the job when there are more groups than the global cap; nothing is dropped."""
    n = groups.agg(F.count(F.lit(1)).alias("n")).scalar()
    return groups.where(F.when(n > cap, F.raise_error(F.lit(f"more than {cap} groups")).cast("boolean")).otherwise(True))


# -- buckets ---------------------------------------------------------------------------------


def fixed_width_bucket(value: Column | str, width: float) -> tuple[Column, Column]:
    """``[from, to)`` edges of a value's fixed-width bucket."""
    lo = F.floor(as_col(value) / F.lit(float(width))) * F.lit(float(width))
    return lo, lo + F.lit(float(width))


def bucket(value: Column | str, ranges: Sequence[tuple]) -> Column:
    """``struct(from, to, label)`` of the first ``[from, to)`` holding the value, else null."""
    v = as_col(value)
    out = None
    for lo, hi in ranges:
        made = F.struct(F.lit(lo).alias("from"), F.lit(hi).alias("to"), F.lit(f"{lo}:{hi}").alias("label"))
        cond = (v >= F.lit(lo)) & (v < F.lit(hi))
        out = F.when(cond, made) if out is None else out.when(cond, made)
    if out is None:
        raise ValueError("buckets need at least one range")
    return out


# -- nested groups ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Level:
    """One grouping level: key name and expression, outputs, order, most groups per parent."""

    name: str
    expr: Column | str
    outputs: Mapping[str, Column]
    order: Sequence[Column] = ()
    max_groups: int | None = None
    extra: dict = field(default_factory=dict)
    #: For trees: the best rows of every group of this level, by this order, so many, these columns.
    hits: tuple[Sequence[Column], int, Sequence[str]] | None = None


def group_states(df: DataFrame, levels: Sequence[Level]) -> DataFrame:
    """The groups of all levels from one scan: a rollup whose partial aggregates merge before the shuffle.

    Every level's outputs stand in columns of their own; ``_level`` counts from 0, and paths with a null belong to no level.
    """
    names = [lv.name for lv in levels]
    base = df.withColumns({lv.name: as_col(lv.expr) for lv in levels})
    outputs = [c.alias(f"_o{i}_{n}") for i, lv in enumerate(levels) for n, c in lv.outputs.items()]
    level = F.lit(len(names) - 1) - F.bit_count(F.grouping_id())
    states = base.rollup(*names).agg(*outputs, level.cast("int").alias("_level")).where("_level >= 0")
    whole = F.lit(True)
    for i, n in enumerate(names):
        whole = whole & ((F.col("_level") < i) | F.col(f"`{n}`").isNotNull())
    return states.where(whole)


def nested_groups(df: DataFrame, levels: Sequence[Level]) -> list[DataFrame]:
    """One DataFrame per level, keyed by the path of group values down to it.

    The rows are read once at any depth; what is kept and read by the levels are groups.  Where a level keeps only its best groups,
    deeper levels are semi-joined with the kept paths.
    """
    names = [lv.name for lv in levels]
    states = cut(group_states(df, levels))
    out: list[DataFrame] = []
    kept: DataFrame | None = None
    for i, lv in enumerate(levels):
        path = names[: i + 1]
        g = states.where(F.col("_level") == i).select(*path, *[F.col(f"_o{i}_{n}").alias(n) for n in lv.outputs])
        if kept is not None:
            g = g.join(kept, names[:i], "left_semi")
        if lv.max_groups is not None:
            g = top_groups(g, names[:i], lv.name, lv.order, lv.max_groups)
        if lv.max_groups is not None or kept is not None:
            kept = g.select(*path)
        out.append(g)
    return out


def top_groups(groups: DataFrame, parents: Sequence[str], key: str, order: Sequence[Column], n: int) -> DataFrame:
    """Best ``n`` groups per parent: order expression, then group value."""
    by = [*order, F.col(key).asc()]
    if not parents:
        return top(groups, by, n)
    w = Window.partitionBy(*parents).orderBy(*by)
    return groups.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def flat_levels(levels: Sequence[DataFrame]) -> DataFrame:
    """All levels as one table with a ``level`` column; deeper path columns are null above."""
    out = None
    for i, g in enumerate(levels, 1):
        g = g.withColumn("level", F.lit(i))
        out = g if out is None else out.unionByName(g, allowMissingColumns=True)
    return out


def rollup_levels(df: DataFrame, keys: Mapping[str, Column | str], outputs: Mapping[str, Column]) -> DataFrame:
    """Nested groups whose levels share their outputs: all levels in one scan and one shuffle."""
    base = df.withColumns({n: as_col(c) for n, c in keys.items()}).dropna(subset=list(keys))
    names = list(keys)
    # grouping_id has one set bit per rolled-up key
    level = F.lit(len(names)) - F.bit_count(F.grouping_id())
    out = base.rollup(*names).agg(*[c.alias(n) for n, c in outputs.items()], level.cast("int").alias("level"))
    return out.where(F.col("level") > 0)


# -- hits, pages, trees ----------------------------------------------------------------------


def group_hits(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], max_hits: int = DEFAULT_MAX_HITS,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Best ``max_hits`` rows of every group, as flat rows with their ``hit_rank``."""
    if columns is not None:
        df = df.select(*dict.fromkeys([*keys, *columns]))
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.dropna(subset=list(keys)).withColumn("hit_rank", F.row_number().over(w)).where(F.col("hit_rank") <= max_hits)


def group_pages(groups: DataFrame, order: Sequence[Column], page_size: int) -> DataFrame:
    """All groups with their page number: no group repeats, none is missing."""
    out = number_rows(cut(groups), order)
    return out.withColumn("page", F.floor(F.col("position") / page_size))


def group_page_after(groups: DataFrame, key: str, last, page_size: int) -> DataFrame:
    """Resume after the last group value seen."""
    rest = groups if last is None else groups.where(F.col(key) > F.lit(last))
    return top(rest, [F.col(key).asc()], page_size)


def groups_and_hits(
    matched: DataFrame, keys: Mapping[str, Column | str], outputs: Mapping[str, Column], order: Sequence[Column],
    hits: int = 10, *, narrow: Sequence[str] | None = None, where: Column | None = None, max_groups: int | None = None,
    group_order: Sequence[Column] = (),
) -> dict[str, DataFrame]:
    """Hits, groups and total of one request over the same matched rows.

    The match is evaluated once: ``narrow`` names the columns that keys, outputs, ``where`` and order read, and only these are
    kept.  Hits then hold them only, the caller's key among them, by which the few hits fetch the rest.  Without ``narrow`` hits hold
    all columns and the match is evaluated twice, for them and for groups and total together.  ``where`` restricts the groups alone.
    """
    if narrow is not None:
        matched = cut(matched.select(*dict.fromkeys(narrow)))
    inside = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    based = matched.withColumns({n: as_col(c) for n, c in keys.items()}).withColumn("_in", inside)
    # groups by key and by whether they count, so that the total of all rows comes from the same pass
    states = based.groupBy(*keys, "_in").agg(*[c.alias(n) for n, c in outputs.items()], F.count(F.lit(1)).alias("_rows"))
    states = states if narrow is not None else cut(states)
    groups = states.where("_in").dropna(subset=list(keys)).select(*keys, *outputs)
    if max_groups is not None:
        groups = top(groups, [*group_order, *[F.col(k).asc() for k in keys]], max_groups)
    return {
        "hits": top(matched, order, hits),
        "groups": groups,
        "total": states.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("total_count")),
    }


def _bounded(position: Column) -> Column:
    """Fail where a parent has more groups than an array should hold; nothing is dropped."""
    text = F.lit(f"more than {MOST_SUBGROUPS} groups in one parent: name max_groups, or take nested_groups")
    return F.when(position > MOST_SUBGROUPS, F.raise_error(text).cast("boolean")).otherwise(True)


def group_tree(df: DataFrame, levels: Sequence[Level]) -> DataFrame:
    """Nested result: label, value, outputs, the best hits where a level asks for them, and an ordered array of sub-groups.

    A level keeps all its groups unless it names ``max_groups``; a parent with more than ``MOST_SUBGROUPS`` of them is an error, for
    which ``nested_groups`` gives flat tables.  The outermost groups are rows, in order, as many as there are.
    """
    tables = nested_groups(df, levels)
    base = df.withColumns({lv.name: as_col(lv.expr) for lv in levels})
    below: DataFrame | None = None
    for i in range(len(levels) - 1, -1, -1):
        lv, g = levels[i], tables[i]
        parents = [x.name for x in levels[:i]]
        path = [*parents, lv.name]
        outs = F.struct(*[F.col(n) for n in lv.outputs])
        fields = [F.lit(lv.name).alias("label"), F.col(lv.name).cast("string").alias("value"), outs.alias("aggregations")]
        if lv.hits is not None:
            by, n, columns = lv.hits
            best = group_hits(base, path, by, n)
            row = F.struct("hit_rank", F.struct(*columns).alias("row"))
            packed = F.transform(F.array_sort(F.collect_list(row)), lambda e: e["row"]).alias("_hits")
            g = g.join(best.groupBy(*path).agg(packed), path, "left")
            fields.append(F.col("_hits").alias("hits"))
        if below is not None:
            g = g.join(below, path, "left")
            fields.append(F.col("_groups").alias("groups"))
        order = [*lv.order, F.col(lv.name).asc()]
        if i == 0:
            return g.orderBy(*order).select(*fields)
        g = g.withColumn("_pos", F.row_number().over(Window.partitionBy(*parents).orderBy(*order))).where(_bounded(F.col("_pos")))
        packed = F.array_sort(F.collect_list(F.struct(F.col("_pos"), F.struct(*fields).alias("g"))))
        below = g.groupBy(*parents).agg(F.transform(packed, lambda e: e["g"]).alias("_groups"))
    raise ValueError("a tree needs a level")


# -- exact quantiles -------------------------------------------------------------------------


def group_quantiles(df: DataFrame, keys: Sequence[str], value: str, qs: Sequence[float], prefix: str = "q") -> DataFrame:
    """Exact, linearly interpolated quantiles per group, one column per quantile.

    Equal values are counted map-side first.  The counts are range-partitioned by group and
    value, so a hot group is spread over many tasks; running counts plus the totals of
    earlier partitions give every value's rank, and only the two ranks around each quantile
    are picked.  No task holds a group.
    """
    qs = _checked(qs)
    keys = list(keys)
    # the counts are read to size the ranges, to draw their bounds and to fill them
    counts = cut(df.dropna(subset=[*keys, value]).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n")))
    ranged = counts.repartitionByRange(range_count(counts), *keys, value)
    ranged = cut(ranged.withColumn("_part", F.spark_partition_id()))
    running = Window.partitionBy("_part", *keys).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.withColumn("_upto", F.sum("_n").over(running))
    totals = ranged.groupBy("_part", *keys).agg(F.sum("_n").alias("_pn"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        "_part", *keys,
        F.coalesce(F.sum("_pn").over(earlier), F.lit(0)).alias("_start"),
        F.sum("_pn").over(Window.partitionBy(*keys)).alias("_total"),
    )
    placed = local.join(totals, ["_part", *keys])
    hi_rank = F.col("_start") + F.col("_upto") - 1
    lo_rank = hi_rank - F.col("_n") + 1
    aggs = [F.max("_total").alias("_total")]
    for i, q in enumerate(qs):
        for name, at in (("lo", F.floor), ("hi", F.ceil)):
            r = at((F.col("_total") - 1) * F.lit(q))
            aggs.append(F.max(F.when(r.between(lo_rank, hi_rank), F.col(value))).alias(f"_{name}{i}"))
    g = placed.groupBy(*keys).agg(*aggs)
    rank = lambda q: (F.col("_total") - 1) * F.lit(q)
    return g.select(
        *keys,
        *[
            (F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (rank(q) - F.floor(rank(q)))).alias(f"{prefix}{q:g}".replace(".", "_"))
            for i, q in enumerate(qs)
        ],
    )


# -- quantiles that add up ---------------------------------------------------------------------


def quantile_states(df: DataFrame, keys: Sequence[str], value: Column | str, size: int = KLL_SIZE) -> DataFrame:
    """One small mergeable state per group: partial sketches meet after the map side, whatever a group's size.

    The table can be kept and appended to batch by batch; :func:`merge_quantile_states` adds up batches, or levels of keys.
    """
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(quantile_state(value, size).alias("state"))


def merge_quantile_states(states: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """States of fewer keys (none: of everything) from states of more keys or of several batches; no row is read again."""
    return states.groupBy(*keys).agg(merged_quantile_state("state").alias("state"))


def quantiles_of_states(states: DataFrame, qs: Sequence[float], prefix: str = "q") -> DataFrame:
    """Keys, ``n`` and one column per quantile; :func:`quantile_error` states how far a rank can be off."""
    names = [f"{prefix}{q:g}".replace(".", "_") for q in _checked(qs)]
    found = states.withColumns({"n": state_count(), "_q": state_quantiles(qs)})
    return found.select(*[c for c in states.columns if c != "state"], "n", *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])
