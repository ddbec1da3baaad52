"""Rules carried by documents, against brute force."""

import json
import random

import pandas as pd
import pytest

from pyspark.sql import functions as F

from lodestone.functions import predicates as pr
from lodestone.operators import matching
from lodestone.streaming.standing import holders, standing_matches

BIG = 2**62


def rules(rng, n):
    out = []
    for i in range(n):
        conds = []
        for _ in range(rng.randint(0, 3)):
            if rng.random() < 0.5:
                conds.append(("a" + str(rng.randint(0, 1)), rng.random() < 0.3, rng.sample(["u", "v", "w"], rng.randint(1, 2)), None, None))
            else:
                lo = rng.choice([-BIG, -300, -5, 0, 7, 90000])
                hi = lo + rng.choice([-1, 0, 3, 40, 5000, 10**9, BIG])
                conds.append(("n" + str(rng.randint(0, 1)), False, None, lo, hi))
        out.append((i, conds))
    return out


def accepts(conds, attrs, ranges):
    for attr, negate, values, lo, hi in conds:
        if values is not None:
            if (attrs.get(attr) in values) == negate:
                return False
        elif attr not in ranges or not lo <= ranges[attr] <= hi:
            return False
    return True


@pytest.mark.parametrize("most_kinds", [10_000, 1])
def test_many_queries(spark, monkeypatch, most_kinds):
    monkeypatch.setattr(matching, "MOST_KINDS", most_kinds)
    rng = random.Random(11)
    rs = rules(rng, 120)
    qs = []
    for i in range(60):
        attrs = {k: rng.choice(["u", "v", "w", "z"]) for k in ("a0", "a1") if rng.random() < 0.7}
        nums = {k: rng.choice([-BIG, -299, -5, 3, 8, 95, 90010, 10**8, BIG]) for k in ("n0", "n1") if rng.random() < 0.7}
        qs.append((i, attrs, nums))
    rdf = spark.createDataFrame(rs, f"rid int, rules {pr.RULE_TYPE}")
    qdf = spark.createDataFrame(qs, "qid int, attrs map<string,string>, nums map<string,bigint>")
    pairs = [(r["qid"], r["rid"]) for r in matching.match_rules(rdf, "rules", qdf, "attrs", "nums", 3).collect()]
    want = {(q, r) for q, a, n in qs for r, c in rs if accepts(c, a, n)}
    assert want and len(pairs) == len(set(pairs)) and set(pairs) == want


@pytest.mark.parametrize("rule_copies,query_copies", [(30, 1), (1, 30), (12, 20)])
def test_equal_rules_and_queries_are_matched_once(spark, rule_copies, query_copies):
    rng = random.Random(5)
    rs, qs = rules(rng, 40), []
    for i in range(20):
        attrs = {k: rng.choice(["u", "v", "z"]) for k in ("a0", "a1") if rng.random() < 0.7}
        qs.append((i, attrs if i else None, {k: rng.choice([-299, -5, 3, 90010]) for k in ("n0", "n1") if rng.random() < 0.7}))
    rdf = spark.createDataFrame([(c * 1000 + i, r) for i, r in rs for c in range(rule_copies)], f"rid int, rules {pr.RULE_TYPE}")
    qdf = spark.createDataFrame([(c * 1000 + i, a, n) for i, a, n in qs for c in range(query_copies)], "qid int, attrs map<string,string>, nums map<string,bigint>")
    out = matching.match_rules(rdf, "rules", qdf, "attrs", "nums", 3)
    assert out.columns == ["qid", "attrs", "nums", "rid", "rules"]
    pairs = [(r["qid"], r["rid"]) for r in out.collect()]
    one = matching._match_rows(rdf.where("rid < 1000"), "rules", qdf.where("qid < 1000"), "attrs", "nums").collect()
    met = {(r["qid"], r["rid"]) for r in one}
    assert {(q, r) for q, r in met if q} == {(q, r) for q, a, n in qs if q for r, c in rs if accepts(c, a, n)}
    assert set(pairs) == {(x * 1000 + q, y * 1000 + r) for q, r in met for x in range(query_copies) for y in range(rule_copies)}
    assert len(pairs) == len(met) * rule_copies * query_copies
    # the rules are checked on classes, however many rows these have
    assert matching.match_classes(rdf, "rules", qdf, "attrs", "nums").count() <= len(met)


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("rule_copies,query_copies", [(90, 50), (40, 70)])
def test_pairs_of_classes_are_written_by_many_even_tasks(spark, monkeypatch, small, rule_copies, query_copies):
    monkeypatch.setattr(matching, "PACK_ROWS", 16)
    if not small:
        monkeypatch.setattr(matching, "is_small", lambda df: False)
    rs = [(1, [("a0", False, ["u"], None, None)]), (2, [("a0", False, ["u", "v"], None, None), ("n0", False, None, 0, 9)])]
    qs = [(1, {"a0": "u"}, {"n0": 5}), (2, {"a0": "v"}, {"n0": 5}), (3, {"a0": "u"}, {"n0": 50})]
    rdf = spark.createDataFrame([(c * 10 + i, r) for i, r in rs for c in range(rule_copies)], f"id int, rules {pr.RULE_TYPE}")
    qdf = spark.createDataFrame([(c * 10 + i, a, n) for i, a, n in qs for c in range(query_copies)], "id int, attrs map<string,string>, nums map<string,bigint>")
    out = matching.match_rules(rdf, "rules", qdf, "attrs", "nums", 3)
    # columns of one name on both sides stay apart
    assert out.columns == ["id", "attrs", "nums", "id", "rules"]
    out = out.toDF("qid", "attrs", "nums", "rid", "rules")
    want = {(c * 10 + q, d * 10 + r) for q, a, n in qs for r, k in rs if accepts(k, a, n) for c in range(query_copies) for d in range(rule_copies)}
    rows = out.collect()
    assert len(rows) == len(want) and {(x.qid, x.rid) for x in rows} == want
    assert all(accepts([tuple(k) for k in x.rules], x.attrs, x.nums) for x in rows)
    tasks = [x["count"] for x in out.groupBy(F.spark_partition_id()).count().collect()]
    assert len(tasks) >= 6 and max(tasks) <= len(rows) / 3


def test_holders_are_written_by_many_even_tasks(spark, tmp_path):
    rdf = spark.createDataFrame([(c * 10 + i, [("a0", False, [v], None, None)]) for i, v in enumerate("uv") for c in range(30)], f"rid int, rules {pr.RULE_TYPE}")
    classes = matching.with_class(rdf, "rules").select("rules", "_class").dropDuplicates(["_class"]).select("_class")
    hits = spark.range(2000).withColumnRenamed("id", "doc").crossJoin(classes)
    hits.coalesce(1).write.parquet(f"{tmp_path}/hits")
    out = holders(spark.read.parquet(f"{tmp_path}/hits"), rdf, "rules")
    assert out.columns == ["doc", "rid", "rules"]
    assert out.count() == out.select("doc", "rid").distinct().count() == 2000 * 60
    tasks = [x["count"] for x in out.groupBy(F.spark_partition_id()).count().collect()]
    assert len(tasks) > 2 * spark.sparkContext.defaultParallelism and max(tasks) <= 2000 * 60 / len(tasks) * 3


def test_event_stream_has_several_files_a_batch(spark, monkeypatch):
    from lodestone.plans import streams
    from lodestone.plans.registry import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    few = streams.event_stream(t)
    monkeypatch.setattr(streams, "range_count", lambda df: 4)
    many = streams.event_stream(t)
    for stream, files in ((few, 1), (many, 4)):
        seen = []
        run = stream.writeStream.foreachBatch(lambda b, i: seen.append((b.select(F.input_file_name()).distinct().count(), b.count()))).trigger(availableNow=True).start()
        run.awaitTermination()
        assert len(seen) == 3 and sum(n for _, n in seen) == t.events.count()
        assert [f for f, _ in seen] == [files] * 3


def test_one_query(spark):
    rs = rules(random.Random(3), 80)
    rdf = spark.createDataFrame(rs, f"rid int, rules {pr.RULE_TYPE}")
    got = rdf.where(pr.predicate_matches("rules", {"a0": "u"}, {"n0": 8}))
    assert {r["rid"] for r in got.collect()} == {i for i, c in rs if accepts(c, {"a0": "u"}, {"n0": 8})}
    assert rdf.where(pr.predicate_matches("rules", {})).count() == sum(accepts(c, {}, {}) for _, c in rs)


def test_geo_box_agrees_with_the_distance(spark):
    pts = [(i, float(lat), float(lng)) for i, (lat, lng) in enumerate((a, b) for a in range(-90, 91, 6) for b in range(-180, 180, 7))]
    df = spark.createDataFrame(pts, "id int, lat double, lng double")
    for lat, lng, km in [(0, 0, 800), (50, 179, 1500), (-50, -179.5, 3000), (88, 10, 900), (-89, 0, 2500), (60, 20, 9000), (10, 10, 19000)]:
        plain = df.where(pr.haversine_km("lat", "lng", lat, lng) <= km).count()
        assert df.where(pr.within_radius("lat", "lng", lat, lng, km)).count() == plain > 0


def test_a_stream_meets_rules_of_a_kind_added_later(spark, tmp_path):
    stored = tmp_path / "rules.json"

    def read(frames):  # the rule table as it is when a batch runs
        for f in frames:
            found = json.loads(stored.read_text())
            yield pd.DataFrame({"rid": [r for r, _, _ in found], "attr": [a for _, a, _ in found], "v": [v for _, _, v in found]})

    rows = spark.range(1).mapInPandas(read, "rid int, attr string, v string")
    rules = rows.select("rid", F.array(pr.rule_values(F.col("attr"), F.array("v"))).cast(pr.RULE_TYPE).alias("rules"))
    stored.write_text(json.dumps([(1, "a0", "u")]))
    schema = "qid int, attrs map<string,string>, nums map<string,bigint>"
    asked = lambda i: spark.createDataFrame([(i, {"a0": "u", "a1": "v"}, {})], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    asked(1)
    stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
    hits = standing_matches(stream, "attrs", "nums", rules, "rules").select("qid", "rid")
    run = hits.writeStream.format("memory").queryName("later_rules").start()
    try:
        run.processAllAvailable()
        stored.write_text(json.dumps([(1, "a0", "u"), (2, "a1", "v")]))
        asked(2)
        run.processAllAvailable()
        assert {(r.qid, r.rid) for r in spark.table("later_rules").collect()} == {(1, 1), (2, 1), (2, 2)}
    finally:
        run.stop()


def test_standing_queries_store_a_hit_a_class(spark, tmp_path, monkeypatch):
    import duckdb

    from lodestone.plans import REGISTRY, streams
    from lodestone.plans.registry import Tables

    folder = "/root/testdata/sf0.001"
    few = Tables(spark, folder)
    suppliers = few.supplier.count()
    few.supplier.crossJoin(spark.range(20).withColumnRenamed("id", "copy")).withColumn("s_suppkey", F.col("s_suppkey") + F.col("copy") * 1000).drop("copy").write.parquet(f"{tmp_path}/supplier.parquet")
    few.events.write.parquet(f"{tmp_path}/events.parquet")
    paths = []
    real = streams.scratch_path
    monkeypatch.setattr(streams, "scratch_path", lambda s, name: paths.append(real(s, name)) or paths[-1])
    found = REGISTRY["W03_standing_queries"].build(Tables(spark, str(tmp_path)))
    want = duckdb.connect()
    for name in ("supplier", "events"):
        want.execute(f"CREATE VIEW {name} AS FROM '{tmp_path}/{name}.parquet/*.parquet'")
    pairs = sorted(want.execute(REGISTRY["W03_standing_queries"].sql).fetchall())
    assert suppliers and sorted(map(tuple, found.collect())) == pairs
    stored = spark.read.parquet(next(p for p in paths if "/standing-" in p)).count()
    assert stored <= len(pairs) / 20
