"""Grouping, order and paging on the small product tables."""

import statistics

import pytest
from pyspark.sql import functions as F

from lodestone.functions import aggregates as ag, predicates as pr, scalars as sc, text as tx
from lodestone.operators import grouping, order
from lodestone.plans import REGISTRY
from lodestone.plans.registry import Tables
from lodestone.session import is_small

PRODUCTS = [
    ("Oak Desk", 820.0, "tables", True, 4), ("Reading Lamp", 35.5, "lights", True, 61), ("Floor Lamp", 128.0, "lights", True, 17),
    ("Side Table", 260.0, "tables", False, 0), ("Night Light", 12.0, "lights", True, 140),
]
ITEMS = [
    ("Copper Kettle", 64.0, "gift", "kitchen", True), ("Wheelbarrow", 180.0, "daily", "garden", True), ("Bread Knife", 31.0, "daily", "kitchen", True),
    ("Garden Rake", 45.0, "gift", "garden", False), ("Salt Mill", 22.0, "sale", "kitchen", True), ("Watering Can", 27.0, "daily", "garden", True),
]


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame(PRODUCTS, "name string, price double, category string, in_stock boolean, quantity int")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "name string, price double, tag string, kind string, in_stock boolean")


def test_filters(products):
    n = lambda c: products.where(c).count()
    assert n(pr.compare("price", "<", 100)) == 2
    assert n(pr.in_range("price", 50, 500)) == 2
    assert n(pr.compare("in_stock", "=", False)) == 1
    assert n(tx.contains("name", "desk")) == 1
    with pytest.raises(TypeError):
        pr.compare("name", "=", "x")
    with pytest.raises(ValueError):
        pr.any_of()


def test_group_and_hits(products):
    hits = grouping.group_hits(products, ["category"], [F.col("price").desc()], 2)
    assert sorted(r["price"] for r in hits.where("category = 'tables'").collect()) == [260.0, 820.0]
    assert hits.groupBy("category").count().where("count > 2").count() == 0


def test_collapse(items):
    best = order.collapse(items, "kind", [F.col("price").desc()])
    assert {(r["kind"], r["price"]) for r in best.collect()} == {("kitchen", 64.0), ("garden", 180.0)}
    assert order.collapse(items, "kind", [F.col("price")], 2).count() == 4


def test_nested_groups(spark):
    rows = [("north", 3, 7.0), ("north", 3, 2.0), ("north", 5, 9.0), ("south", 3, 1.0), ("south", None, 4.0), (None, 3, 8.0), ("west", 4, 0.5)]
    df = spark.createDataFrame(rows, "area string, size int, v double")
    levels = [
        grouping.Level("area", "area", {"n": ag.count()}, [F.col("n").desc()], 2, hits=([F.col("v").desc()], 2, ["v"])),
        grouping.Level("size", "size", {"n": ag.count(), "most": ag.greatest("v")}, hits=([F.col("v")], 1, ["v", "area"])),
    ]
    top, sub = grouping.nested_groups(df, levels)
    assert {tuple(r) for r in top.collect()} == {("north", 3), ("south", 2)}
    assert {tuple(r) for r in sub.collect()} == {("north", 3, 2, 7.0), ("north", 5, 1, 9.0), ("south", 3, 1, 1.0)}
    tree = grouping.group_tree(df, levels)
    rows = tree.collect()
    assert [(r["value"], r["aggregations"]["n"], [h["v"] for h in r["hits"]]) for r in rows] == [("north", 3, [9.0, 7.0]), ("south", 2, [4.0, 1.0])]
    subs = [[(g["label"], g["value"], g["aggregations"]["most"], [tuple(h) for h in g["hits"]]) for g in r["groups"]] for r in rows]
    assert subs == [[("size", "3", 7.0, [(2.0, "north")]), ("size", "5", 9.0, [(9.0, "north")])], [("size", "3", 1.0, [(1.0, "south")])]]


def test_levels_share_one_scan(spark, tmp_path, monkeypatch):
    spark.range(300).select((F.col("id") % 3).alias("a"), (F.col("id") % 5).alias("b"), (F.col("id") % 7).alias("c")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    levels = [grouping.Level(x, x, {"n": ag.count()}) for x in "abc"]
    assert grouping.group_states(df, levels)._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    out = grouping.nested_groups(df, levels)
    assert [x.count() for x in out] == [3, 15, 105]
    assert "FileScan" not in "".join(x._jdf.queryExecution().executedPlan().toString() for x in out)
    tree = grouping.group_tree(df, levels)
    plan = tree._jdf.queryExecution().optimizedPlan().toString()
    assert all("windowspecdefinition(a" in x for x in plan.split("\n") if x.lstrip("+- :").startswith("Window"))  # no window over all root groups
    monkeypatch.setattr(grouping, "MOST_SUBGROUPS", 6)
    with pytest.raises(Exception, match="max_groups"):
        grouping.group_tree(df, levels).collect()


def test_buckets_drop_what_is_outside(spark):
    prices = [float(p) for p in [1, 50, 99] + [100 + 20 * i for i in range(19)] + [500, 900]] + [None]
    df = spark.createDataFrame([(p,) for p in prices], "price double")
    b = grouping.bucket("price", [(0, 100), (100, 500)])
    got = {(r["label"], r["n"]) for r in grouping.group_by(df, {"label": b["label"]}, {"n": ag.count()}).collect()}
    assert got == {("0:100", 3), ("100:500", 19)}


def test_group_pages_have_no_repeats_and_no_gaps(spark):
    df = spark.createDataFrame([(f"cat-{i:02d}", j) for i in range(30) for j in range(i % 3 + 1)], "cat string, j int")
    g = grouping.group_by(df, {"cat": "cat"}, {"n": ag.count()})
    paged = grouping.group_pages(g, [F.col("cat").asc()], 5).collect()
    assert sorted((r["page"], r["cat"]) for r in paged) == [(i // 5, f"cat-{i:02d}") for i in range(30)]
    seen, last = [], None
    while rows := grouping.group_page_after(g, "cat", last, 7).collect():
        seen += [r["cat"] for r in rows]
        last = seen[-1]
    assert seen == [f"cat-{i:02d}" for i in range(30)]


def test_numbering_with_one_hot_value(spark):
    """A third of the rows share the sort value; the key splits them over partitions."""
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 11).cast("int").alias("v"))
    got = order.number_rows(df, [F.col("v").desc(), F.col("id").asc()]).collect()
    want = sorted(((r["v"], r["id"]) for r in got), key=lambda t: (-t[0], t[1]))
    assert [(r["v"], r["id"]) for r in sorted(got, key=lambda r: r["position"])] == want
    assert sorted(r["position"] for r in got) == list(range(3000))


def test_large_top_k_stays_spread_out(spark, monkeypatch):
    df = spark.range(500).select("id", (F.col("id") % 7).alias("v"))
    by = [F.col("v").desc(), F.col("id").asc()]
    small = {r["id"] for r in order.top(df, by, 50, 20).collect()}
    monkeypatch.setattr(order, "ONE_TASK_ROWS", 30)
    assert {r["id"] for r in order.top(df, by, 50, 20).collect()} == small


def test_broadcast_needs_rows_and_bytes_in_bounds(spark):
    df = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("s"), F.array(F.lit(1.5)).alias("a"))
    assert is_small(df) and not is_small(df, rows=99) and not is_small(df, size=50_000)
    assert is_small(df.where("false"))


def test_quantiles_of_a_hot_group(spark):
    df = spark.range(4000).select(
        F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 50).cast("string"))).alias("g"),
        F.when(F.col("id") % 5 == 0, 1.5).otherwise(F.col("id") % 97).cast("double").alias("v"),
    )
    got = {r["g"]: r for r in grouping.group_quantiles(df, ["g"], "v", [0, 0.1, 0.5, 0.9, 1]).collect()}
    values = {}
    for g, v in df.collect():
        values.setdefault(g, []).append(v)
    assert set(got) == set(values)
    for g, vs in values.items():
        vs.sort()
        assert got[g]["q0"] == vs[0] and got[g]["q1"] == vs[-1]
        assert got[g]["q0_5"] == pytest.approx(statistics.median(vs))
        pos = 0.9 * (len(vs) - 1)
        lo = int(pos)
        hi = min(lo + 1, len(vs) - 1)
        assert got[g]["q0_9"] == pytest.approx(vs[lo] + (vs[hi] - vs[lo]) * (pos - lo))


def test_group_cap_fails_instead_of_dropping(spark, products):
    groups = grouping.group_by(products, {"name": "name"}, {"n": ag.count()})
    assert grouping.check_group_cap(groups, 5).count() == 5
    with pytest.raises(Exception, match="more than 4 groups"):
        grouping.check_group_cap(groups, 4).collect()


def test_scalars(spark):
    r = spark.range(1).select(
        sc.div(F.lit(1), F.lit(0)), sc.mod(F.lit(1), F.lit(0)), sc.cmp(F.lit(1), F.lit(2)), sc.neg(F.lit(3)),
        sc.md5_bits(F.lit("a"), 10, 32), sc.fixed_width(F.lit(-1.0), 10),
        sc.zcurve_x(sc.zcurve(F.lit(2**31 - 1), F.lit(5))), sc.zcurve_y(sc.zcurve(F.lit(12345), F.lit(2**30 + 7))),
    ).first()
    assert list(r) == [None, None, -1, -3, 1769416289, -10.0, 2**31 - 1, 2**30 + 7]
    with pytest.raises(ValueError):
        ag.quantiles([], "x")
    with pytest.raises(ValueError):
        ag.quantiles([1.1], "x")


@pytest.mark.parametrize("name, table, key", [("T01_order_by_whole", "orders", "o_orderkey"), ("T03_sort_spec_whole", "part", "p_partkey")])
def test_whole_orders_hold_every_row(spark, folder, name, table, key):
    rows = REGISTRY[name].build(Tables(spark, folder)).orderBy("position").collect()
    keys = [r[key] for r in spark.read.parquet(f"{folder}/{table}.parquet").select(key).collect()]
    assert [r.position for r in rows] == list(range(len(keys))) and sorted(r[key] for r in rows) == sorted(keys)
