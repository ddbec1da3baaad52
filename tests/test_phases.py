"""Ranking phases, requests of hits and groups, and quantile states: results against plain Python, and how often the table is read."""

import random

import pytest
from pyspark.sql import functions as F

from lodestone.functions import aggregates as ag
from lodestone.operators import grouping, ranking


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df):
    return plan(df).count("FileScan parquet") or plan(df).count("Scan parquet")


@pytest.fixture
def part(spark, folder):
    return spark.read.parquet(f"{folder}/part.parquet")


def _plain(rows, steps, keep=None):
    """Rows are (key, first score, value); a step is (function of score and value, count)."""
    none_last = lambda s: (s is None, 0 if s is None else -s)
    table = {k: (s, 1) for k, s, _ in rows}
    value = {k: v for k, _, v in rows}
    if keep is not None:
        best = sorted(table, key=lambda k: (none_last(table[k][0]), k))[:keep]
        table = {k: (s if k in best else None, p) for k, (s, p) in table.items()}
    for phase, (score, count) in enumerate(steps, 2):
        best = sorted(table, key=lambda k: (-table[k][1], none_last(table[k][0]), k))[:count]
        for k in best:
            s = table[k][0]
            table[k] = (None if s is None else score(s, value[k]), phase)
    return table


@pytest.mark.parametrize("counts", [(30, 10, 4), (5, 20, 12), (7, 7, 50), (100, 3, 100)])
@pytest.mark.parametrize("keep", [None, 0, 9, 45])
def test_phases_as_plain_loops(spark, counts, keep):
    rng = random.Random(sum(counts))
    # few distinct scores, so that keys decide, and some rows without a score
    rows = [(k, None if rng.random() < 0.1 else float(rng.randrange(6)), rng.randrange(5)) for k in range(60)]
    df = spark.createDataFrame(rows, "k int, relevance double, v int").repartition(5)
    plain = [lambda s, v: s - 2 * v, lambda s, v: -s + v, lambda s, v: s * v]
    cols = [F.col("relevance") - 2 * F.col("v"), -F.col("relevance") + F.col("v"), F.col("relevance") * F.col("v")]
    got = ranking.phases(df, "k", list(zip(cols, counts)), keep)
    want = _plain(rows, list(zip(plain, counts)), keep)
    assert {r["k"]: (r["relevance"], r["phase"]) for r in got.collect()} == want
    assert got.columns == ["k", "relevance", "v", "phase"]


@pytest.mark.parametrize("count", [0, 1, 4, 6, 100])
def test_keep_rank_of_ties_nulls_and_nan(spark, count):
    nan = float("nan")
    rows = [(1, 2.0), (2, nan), (3, 2.0), (4, None), (5, 0.0), (6, nan), (7, -0.0), (8, None)]
    df = spark.createDataFrame(rows, "k int, relevance double").repartition(3)
    got = {r["k"]: r["relevance"] for r in ranking.keep_rank(df, "k", count).collect()}
    order = [2, 6, 1, 3, 5, 7, 4, 8][:count]
    assert {k for k, s in got.items() if s is not None} == {k for k in order if k not in (4, 8)} and len(got) == 8


def test_any_number_of_phases_reads_the_table_twice(part):
    scored = ranking.first_phase(part, F.col("p_retailprice"))
    steps = [(F.col("relevance") - F.col("p_size"), 50), (-F.col("p_size").cast("double"), 20), (F.col("relevance") * 2, 70)]
    for n in (1, 2, 3):
        out = ranking.phases(scored, "p_partkey", steps[:n], keep=80).select("p_partkey", "relevance", "phase")
        assert scans(out) == 2
        assert "p_name" not in plan(out)  # the best rows carry what the scores read, no more
    kept = plan(ranking.keep_rank(scored, "p_partkey", 40))
    assert "Join" not in kept and "Subquery" in kept


def test_no_phase_and_empty_table(part):
    scored = ranking.first_phase(part, F.col("p_retailprice"))
    assert ranking.phases(scored, "p_partkey", []).where("phase <> 1").count() == 0
    none = ranking.phases(scored.where("p_partkey < 0"), "p_partkey", [(F.lit(1.0), 5)], keep=3)
    assert none.count() == 0


def test_hits_groups_and_total_from_one_match(part):
    args = [{"p_brand": "p_brand"}, {"n": ag.count(), "most": ag.greatest("p_size")}, [F.col("p_retailprice").desc(), F.col("p_partkey").asc()], 5]
    options = dict(where=F.col("p_size") > 10, max_groups=3, group_order=[F.col("n").desc()])
    matched = part.where("p_retailprice > 905")
    once = grouping.groups_and_hits(matched, *args, narrow=["p_partkey", "p_brand", "p_size", "p_retailprice"], **options)
    twice = grouping.groups_and_hits(matched, *args, **options)
    rows = matched.collect()
    for r in (once, twice):
        assert r["total"].first()[0] == len(rows)
        want = sorted(rows, key=lambda x: (-x["p_retailprice"], x["p_partkey"]))[:5]
        assert [h["p_partkey"] for h in r["hits"].collect()] == [w["p_partkey"] for w in want]
        by = {}
        for x in rows:
            if x["p_size"] > 10:
                by.setdefault(x["p_brand"], []).append(x["p_size"])
        best = sorted(by, key=lambda b: (-len(by[b]), b))[:3]
        assert [(g["p_brand"], g["n"], g["most"]) for g in r["groups"].collect()] == [(b, len(by[b]), max(by[b])) for b in best]
    assert all(scans(t) == 0 for t in once.values())
    assert scans(twice["groups"]) == scans(twice["total"]) == 0 and scans(twice["hits"]) == 1


def test_empty_match_has_a_total(part):
    r = grouping.groups_and_hits(part.where("p_partkey < 0"), {"b": "p_brand"}, {"n": ag.count()}, [F.col("p_partkey").asc()])
    assert r["total"].first()[0] == 0 and r["hits"].count() == 0 and r["groups"].count() == 0


def test_quantile_states_add_up(spark):
    """States of batches, added up, are within the stated error of the whole, and the error does not grow with the batches."""
    size, qs = 200, [0.0, 0.1, 0.5, 0.9, 1.0]
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise("cold").alias("g"), ((F.col("id") * 7919) % 60_000).cast("double").alias("v"),
    )
    batches = [grouping.quantile_states(rows.where(F.abs(F.hash("v")) % 20 == i), ["g"], "v", size) for i in range(20)]
    states = batches[0]
    for b in batches[1:]:
        states = states.unionByName(b)
    by_group = grouping.quantiles_of_states(grouping.merge_quantile_states(states, ["g"]), qs)
    total = grouping.quantiles_of_states(grouping.merge_quantile_states(states), qs)
    values = {"hot": [], "cold": []}
    for r in rows.collect():
        values[r["g"]].append(r["v"])
    slack = 3 * ag.quantile_error(size)
    for row, held in [(r, values[r["g"]]) for r in by_group.collect()] + [(total.first(), values["hot"] + values["cold"])]:
        assert row["n"] == len(held)
        for q in qs:
            got = row[f"q{q:g}".replace(".", "_")]
            below, upto = sum(v < got for v in held) / len(held), sum(v <= got for v in held) / len(held)
            assert below - slack <= q <= upto + slack
    assert "SortAggregate" not in plan(batches[0]) or "partial" in plan(batches[0])


def test_quantile_states_of_odd_values(spark):
    nan = float("nan")
    rows = [("a", 1.0), ("a", None), ("a", nan), ("a", 3.0), ("b", None), (None, 5.0), ("c", float("inf")), ("c", 2.0), ("c", 2.0)]
    states = grouping.quantile_states(spark.createDataFrame(rows, "g string, v double"), ["g"], "v")
    got = {r["g"]: (r["n"], r["q0"], r["q1"]) for r in grouping.quantiles_of_states(states, [0, 1]).collect()}
    assert got == {"a": (2, 1.0, 3.0), "b": (0, None, None), "c": (3, 2.0, float("inf"))}
    empty = grouping.merge_quantile_states(states.where("g = 'x'"), ["g"])
    assert grouping.quantiles_of_states(empty, [0.5]).count() == 0
    with pytest.raises(ValueError):
        ag.state_quantiles([])


def test_bm25_scores_as_bm25_from_one_read(spark, folder):
    rows = [(1, "red lamp and red shade", "a"), (2, "lamp", "b"), (3, None, "a"), (4, "", "a"), (5, "green shade; RED door", "b"), (6, "redder lamps", "a")]
    df = spark.createDataFrame(rows, "id int, s string, kind string")
    for terms in (["red", "lamp"], [["red", "green"], "shade"], ["red shade"], ["absent"]):
        for options in ({}, {"where": F.col("kind") == "a"}, {"filter_terms": ["shade"]}):
            want = {r["id"]: round(r["bm25"], 9) for r in ranking.bm25(df, "s", terms, **options).collect()}
            got = ranking.bm25_scores(df, "id", "s", terms, **options).collect()
            assert {r["id"]: round(r["bm25"], 9) for r in got} == want and len(got) == len(want)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert scans(ranking.bm25_scores(docs, "doc_id", "text", ["the", "of"])) == 0  # only the kept counts are left to read


def test_ranges_follow_the_bytes(spark, monkeypatch):
    from lodestone import session

    monkeypatch.setattr(session, "RANGE_BYTES", 1 << 20)
    table = lambda n: spark.range(n).select("id", F.repeat(F.lit("x"), 92).alias("s"))
    small, large = session.range_count(table(100_000)), session.range_count(table(1_000_000))
    assert small == 10 and large == 96
    numbered = grouping.group_pages(table(100_000), [F.col("id").desc()], 1000)
    assert numbered.where("position <> 99999 - id").count() == 0
    assert session.range_count(table(0)) == 1
    monkeypatch.setattr(session, "RANGE_BYTES", 128 << 20)
    assert session.range_count(table(100_000)) == 5  # cores are used where rows are few
