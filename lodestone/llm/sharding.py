"""A uniform shuffle into shards of exact size: hypergeometric communication matrix, local permutation, exchange, permutation."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestone.llm.common import row_key, unit

ROWS_PER_PART = 50_000
MAX_LEVELS = 12


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Bind a value so that it is computed once."""
    return F.transform(F.array(value), use)[0]


def hypergeometric(u: Column, total: Column, marked: Column, drawn: Column) -> Column:
    """How many of ``drawn`` items out of ``total`` are among the ``marked`` ones, by inversion of the uniform ``u``.

    Weights are relative to the mode and follow the ratio of neighbours; terms beyond ten standard deviations and
    thirty places weigh less than a double can add.
    """
    one = F.lit(1.0)
    mode = F.floor((drawn + 1) * (marked + 1) / (total + 2)).cast("double")
    var = drawn * marked * (total - marked) * F.greatest(total - drawn, F.lit(0.0)) / F.greatest(total * total * F.greatest(total - 1, one), one)
    wide = F.ceil(F.sqrt(var) * 10).cast("double") + 30

    def weigh(b: Column) -> Column:
        m, lo, hi = b["m"], b["lo"], b["hi"]
        ups = F.sequence(m.cast("long"), hi.cast("long"))
        downs = F.when(m > lo, F.sequence((m - 1).cast("long"), lo.cast("long"), F.lit(-1).cast("long"))).otherwise(
            F.array().cast("array<bigint>")
        )

        def up(k: Column) -> Column:  # weight of k + 1 over that of k
            return (marked - k) * (drawn - k) / ((k + 1) * F.greatest(total - marked - drawn + k + 1, one))

        def down(k: Column) -> Column:  # weight of k - 1 over that of k
            return k * (total - marked - drawn + k) / ((marked - k + 1) * (drawn - k + 1))

        def walk(places: Column, first: Column, ratio, goal: Column) -> Column:
            """Sum of the weights, and the first place at which the sum passes the goal."""
            start = F.struct(first.alias("p"), F.lit(0.0).alias("s"), F.lit(-1.0).alias("at"))

            def step(a: Column, k: Column) -> Column:
                s = a["s"] + a["p"]
                at = F.when((a["at"] < 0) & (s > goal), k.cast("double")).otherwise(a["at"])
                return F.struct((a["p"] * ratio(k.cast("double"))).alias("p"), s.alias("s"), at.alias("at"))

            return F.aggregate(places, start, step)

        below = down(m)
        never = F.lit(float("inf"))
        sums = F.struct(walk(ups, one, up, never)["s"].alias("a"), walk(downs, below, down, never)["s"].alias("b"))

        def pick(t: Column) -> Column:
            goal = u * (t["a"] + t["b"])
            above = walk(ups, one, up, goal)["at"]
            under = walk(downs, below, down, goal - t["a"])["at"]
            return F.when(goal < t["a"], F.when(above < 0, m).otherwise(above)).otherwise(F.when(under < 0, m).otherwise(under))

        return _let(sums, pick)

    bounds = F.struct(
        mode.alias("m"),
        F.greatest(F.lit(0.0), drawn + marked - total, mode - wide).alias("lo"),
        F.least(drawn, marked, mode + wide).alias("hi"),
    )
    return _let(bounds, weigh)


def communication_matrix(parts: DataFrame, shards: Sequence[int], levels: int, seed: int) -> DataFrame:
    """Rows ``part, counts``: how many rows of each part go to each shard, drawn as a uniform shuffle would give them.

    ``parts`` has one row with an array ``sizes`` of ``2 ** levels`` part sizes. The matrix is drawn down a binary tree
    of the parts: each node splits its vector of shard counts between its halves, independently of the other nodes.
    """
    k = len(shards)
    tree = parts.select(F.lit(0).cast("long").alias("node"), "sizes", F.array(*[F.lit(float(s)) for s in shards]).alias("vec"))
    for level in range(levels):
        half = 2 ** (levels - level - 1)
        sized = tree.select(
            "node", "vec",
            F.slice("sizes", 1, half).alias("left"),
            F.slice("sizes", half + 1, half).alias("right"),
        )
        n_left = F.aggregate("left", F.lit(0.0), lambda a, x: a + x)
        pool = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x)
        start = F.struct(n_left.alias("n"), pool.alias("pool"), F.array().cast("array<double>").alias("out"))

        salt = F.lit(level)

        def draw(a: Column, j: Column) -> Column:
            u = unit(F.xxhash64(F.lit(seed), salt, F.col("node"), j))
            marked = F.element_at(F.col("vec"), j)
            return _let(
                hypergeometric(u, a["pool"], marked, a["n"]),
                lambda x: F.struct((a["n"] - x).alias("n"), (a["pool"] - marked).alias("pool"), F.concat(a["out"], F.array(x)).alias("out")),
            )

        drawn = sized.withColumn("got", F.aggregate(F.sequence(F.lit(1), F.lit(k)), start, draw)["out"])
        child = F.array(
            F.struct((F.col("node") * 2).alias("node"), F.col("left").alias("sizes"), F.col("got").alias("vec")),
            F.struct(
                (F.col("node") * 2 + 1).alias("node"),
                F.col("right").alias("sizes"),
                F.zip_with("vec", "got", lambda a, b: a - b).alias("vec"),
            ),
        )
        tree = drawn.select(F.inline(child))
        if level == 5 and levels > 8:
            tree = tree.repartition("node")
    return tree.select(F.col("node").alias("part"), F.transform("vec", lambda x: x.cast("long")).alias("counts"))


def uniform_shards(
    docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", seed: int = 20_26,
    keep: Sequence[str] = (), rows_per_part: int = ROWS_PER_PART,
) -> DataFrame:
    """Deal all rows into ``shards`` shards whose row counts differ by one at most; every assignment is equally likely.

    Returns ``doc_id, size, text_crc32, law, shard, slot, grown_shard`` and the columns named by ``keep`` (prefixed
    ``in_`` where they clash). ``slot`` numbers a shard's rows from 0 without gaps in a uniformly random order.

    The rows fall into ``2 ** levels`` parts by their hash (one per ``rows_per_part`` rows, at most 4,096). The exact
    part-to-shard counts are one draw of the hypergeometric matrix. Rows are permuted in their part, cut at the cumulated
    counts, exchanged, and permuted again in their shard, where ranges of the random key are numbered apart so that no
    task holds a shard.

    Null text: size 8, ``text_crc32`` null, dealt like any row. Null id: dealt like any row. Equal rows are dealt as
    separate rows. An empty table gives no rows. Very long texts are never shuffled unless ``keep`` names them.
    """
    text = F.col(text_col)
    k1, k2 = row_key(F.col(id_col), text)
    own = ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    kept = [(c, f"in_{c}" if c in own else c) for c in keep]
    n = docs.count()
    levels = min(MAX_LEVELS, max(2, math.ceil(math.log2(max(n, 1) / rows_per_part)) if n else 2))
    fine = max(1, n // shards // rows_per_part)  # ranges of the random key within a shard
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        k1.alias("__k1"), k2.alias("__k2"),
        *[F.col(c).alias(f"__in{i}") for i, (c, _) in enumerate(kept)],
    ).withColumn("__part", F.shiftrightunsigned(F.xxhash64(F.lit(seed), "__k1", "__k2"), 64 - levels))
    counts = rows.groupBy("__part").agg(F.count(F.lit(1)).alias("n"))
    found = F.map_from_entries(F.collect_list(F.struct("__part", "n")))
    sizes = counts.agg(found.alias("m")).select(
        F.transform(
            F.sequence(F.lit(0).cast("long"), F.lit(2**levels - 1).cast("long")),
            lambda i: F.coalesce(F.try_element_at(F.col("m"), i), F.lit(0)).cast("double"),
        ).alias("sizes")
    )
    goal = [n // shards + (j < n % shards) for j in range(shards)]
    matrix = communication_matrix(sizes, goal, levels, seed).select(
        F.col("part").alias("__part"),
        F.transform(
            F.sequence(F.lit(1), F.lit(shards)), lambda j: F.aggregate(F.slice("counts", 1, j), F.lit(0).cast("long"), lambda a, x: a + x)
        ).alias("__to"),
    )
    first = F.row_number().over(Window.partitionBy("__part").orderBy("__k2", "__k1", "doc_id"))
    dealt = (
        rows.withColumn("__at", first)
        .join(matrix, "__part")
        .withColumn("shard", F.size(F.filter("__to", lambda x: x < F.col("__at"))))
        .withColumn("__key", F.xxhash64(F.lit(seed + 1), "__k1", "__k2", "__at"))
        .withColumn("__range", F.floor(unit(F.col("__key")) * fine).cast("int"))
        .drop("__to")
    )
    before = Window.partitionBy("shard").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = dealt.groupBy("shard", "__range").agg(F.count(F.lit(1)).alias("__n"))
    ranges = ranges.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    place = F.row_number().over(Window.partitionBy("shard", "__range").orderBy("__key", "__k1", "__k2"))
    return (
        dealt.withColumn("__place", place)
        .join(ranges, ["shard", "__range"])
        .select(
            "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
            (F.col("__before") + F.col("__place") - 1).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            *[F.col(f"__in{i}").alias(name) for i, (_, name) in enumerate(kept)],
        )
    )
