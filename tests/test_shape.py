"""Plan shapes that have to hold at scale."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lodestone.operators import grouping, order, parents, ranking, writes
from lodestone.plans.request import Request, search
from lodestone.sources.tables import DocType


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def t(spark, folder):
    return lambda name: spark.read.parquet(f"{folder}/{name}.parquet")


def test_filter_and_columns_reach_the_scan(t):
    text = plan(t("orders").where("o_totalprice > 1000").select("o_orderkey"))
    assert "GreaterThan(o_totalprice,1000.0)" in text and "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in text


def test_top_k_is_bounded(t):
    assert "TakeOrderedAndProject" in plan(order.hits(t("orders"), [F.col("o_totalprice").desc()], 10))


def test_group_limit_before_the_shuffle(t):
    by = [F.col("p_retailprice").desc()]
    for df in (
        order.collapse(t("part"), "p_brand", by),
        grouping.group_hits(t("part"), ["p_brand"], by, 3),
        writes.last_wins(t("events").withColumnRenamed("event_id", "_seq"), "user_id"),
    ):
        assert plan(df).count("WindowGroupLimit") == 2


def test_put_does_not_shuffle_the_base(t):
    ch = t("part").where("p_size = 3").withColumn("_seq", F.lit(1))
    text = plan(writes.put(t("part"), ch, "p_partkey"))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_bm25_has_no_join(t):
    text = plan(ranking.bm25(t("documents"), "text", ["the"]))
    assert "Join" not in text and "Subquery" in text


def test_parent_import_pushes_columns(t):
    text = plan(parents.import_fields(t("orders"), "o_custkey", t("customer"), "c_custkey", {"n": "c_name"}).select("o_orderkey", "n"))
    assert "c_acctbal" not in text


def test_rules_join_on_equality(spark, folder):
    text = plan(entry.queries()["P33_predicate_many_queries"](spark, folder))
    assert "HashJoin" in text or "SortMergeJoin" in text


def test_request(t):
    profile = ranking.RankProfile(
        "p", first=lambda q: F.col("p_retailprice") * q["w"], second=lambda q: -F.col("p_size"), second_count=20, inputs={"w": 2.0},
        features=["p_size"],
    )
    part = t("part")
    r = search(
        part, DocType("part", "p_partkey"),
        Request(where=F.col("p_size") > 5, profile=profile, collapse_field="p_type", hits=4, bold={"p_name": ["red"]},
                levels=[grouping.Level("p_type", "p_type", {"n": F.count(F.lit(1))})]),
    )
    assert r.total.first()[0] == part.where("p_size > 5").count()
    hits = r.hits.collect()
    assert len(hits) == 4 and len({h["p_type"] for h in hits}) == 4
    best = part.where("p_size > 5").orderBy(F.col("p_retailprice").desc(), "p_partkey").limit(20)
    top = best.orderBy("p_size", "p_partkey").first()
    assert hits[0]["p_partkey"] == top["p_partkey"] and hits[0]["relevance"] == -top["p_size"]
    assert hits[0]["match_features"] == {"p_size": float(top["p_size"])}
    assert sum(g["n"] for g in r.groups[0].collect()) == r.total.first()[0]
