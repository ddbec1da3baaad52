"""Keyed writes, the store, chunked selections and streams."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from lodestone.functions import updates as up
from lodestone.operators import bulk, writes
from lodestone.session import scratch_path
from lodestone.sources.store import ChunkedSelection, ConcurrentWrite, Folder, Store, _only_missing
from lodestone.streaming import feed as fd

SCHEMA = "id string, price double, quantity int"


def rows(df):
    return {tuple(r) for r in df.collect()}


@pytest.fixture
def base(spark):
    return spark.createDataFrame([("a", 100.0, 10), ("b", 5.0, 1), ("c", 200.0, None)], SCHEMA)


def changes(spark, data):
    return spark.createDataFrame(data, SCHEMA + ", _seq bigint")


def test_put_takes_the_highest_sequence(spark, base):
    ch = changes(spark, [("a", 1.0, 1, 1), ("a", 3.0, 3, 3), ("a", 2.0, 2, 2), ("z", 9.0, 9, 1)])
    assert rows(writes.put(base, ch, "id")) == {("a", 3.0, 3), ("b", 5.0, 1), ("c", 200.0, None), ("z", 9.0, 9)}


def test_condition(spark, base):
    ch = changes(spark, [("b", 7.0, 7, 1), ("c", 8.0, 8, 1), ("z", 9.0, 9, 1)])
    out = writes.conditional_put(base, ch, "id", F.col("price") > 100)
    assert rows(out.state) == {("a", 100.0, 10), ("b", 5.0, 1), ("c", 8.0, 8)}
    assert rows(out.errors) == {("b", "condition not met", 412), ("z", "document does not exist", 412)}
    made = writes.conditional_put(base, ch, "id", F.col("price") > 100, create_if_missing=True)
    assert ("z", 9.0, 9) in rows(made.state) and rows(made.errors) == {("b", "condition not met", 412)}


def test_update_operations(spark, base):
    ch = spark.createDataFrame([("a", 50.0), ("c", 1.0), ("n", 2.0), ("b", 1.0), ("b", 2.0)], "id string, by double")
    ops = {"price": up.increment(F.col("new_by")), "quantity": up.decrement(3)}
    out = writes.update_fields(base, ch, "id", ops)
    assert rows(out.state) == {("a", 150.0, 7), ("b", 5.0, 1), ("c", 201.0, None)}
    assert rows(out.errors) == {("b", "2 updates of one document in a batch", 400), ("n", "document does not exist", 412)}
    made = writes.update_fields(base, ch, "id", {"price": up.assign(F.col("new_by"))}, create_if_missing=True)
    assert ("n", 2.0, None) in rows(made.state)


def test_a_hot_key_in_a_batch(spark, base):
    """Half of a batch is one key."""
    hot = spark.range(20000).select(
        F.when(F.col("id") % 2 == 0, "a").otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string"))).alias("id"),
        F.col("id").cast("double").alias("price"), F.lit(1).alias("quantity"), F.col("id").alias("_seq"),
    )
    out = writes.put(base, hot, "id")
    assert out.where("id = 'a'").first()["price"] == 19998.0
    assert out.count() == 3 + 250


def test_bulk_update_as_data(spark, base):
    ups = spark.createDataFrame(
        [("a", "price", "multiply", "2"), ("a", "quantity", "clear", None), ("b", "price", "assign", "1"), ("b", "price", "assign", "2"),
         ("c", "nothing", "assign", "1"), ("q", "price", "assign", "4")],
        "id string, field string, op string, value string",
    )
    out = bulk.bulk_update(base, ups, "id", ["price", "quantity"])
    assert rows(out.state) == {("a", 200.0, None), ("b", 5.0, 1), ("c", 200.0, None)}
    assert {r["id"]: r["status"] for r in out.errors.collect()} == {"b": 400, "c": 400, "q": 412}
    made = bulk.bulk_update(base, ups, "id", ["price", "quantity"], create_if_missing=True)
    assert ("q", 4.0, None) in rows(made.state)


def test_selection(spark, base):
    sel = F.col("quantity") > 5
    assert rows(writes.delete_by_selection(base, sel)) == {("b", 5.0, 1), ("c", 200.0, None)}
    assert ("a", 0.0, 10) in rows(writes.update_by_selection(base, sel, {"price": up.assign(0)}))


def test_store_versions_replay_and_dry_run(spark, base):
    st = Store(spark, scratch_path(spark, "t"), "id")
    st.commit(base)
    ch = changes(spark, [("a", 1.0, 1, 1)])
    assert st.put(ch, "b1") == 1 and st.put(ch, "b1") is None and st.version() == 1
    s = st.dry_run(changes(spark, [("x", -1.0, 1, 1), ("y", 2.0, 1, 1)]), valid=F.col("price") > 0).first()
    assert (s["total"], s["success"], s["failure"], s["success_rate"]) == (2, 1, 1, 0.5)
    assert st.version() == 1
    assert st.by_selection(F.col("price") > 100, {"price": up.assign(0)}) == 1
    assert rows(st.read()) == {("a", 1.0, 1), ("b", 5.0, 1), ("c", 0.0, None)}
    other = Store(spark, scratch_path(spark, "t"), "id")
    other.commit(base)
    assert st.by_selection(F.col("id") == "a", copy_to=other) == 1 and ("a", 1.0, 1) in rows(other.read())
    assert st.by_selection(F.col("id") == "a") == 1 and st.read().count() == 2


def test_feed_is_independent_of_batch_order(spark):
    data = [("a", float(i), i, i) for i in range(6)] + [("b", 1.0, 1, 9)]
    results = []
    for cut in ([data[:3], data[3:]], [data[3:], data[:3]], [data]):
        st = Store(spark, scratch_path(spark, "t"), "id")
        for i, part in enumerate(cut):
            st.feed(changes(spark, part), str(i))
        st.feed(changes(spark, cut[0]), "0")
        before = rows(st.read())
        st.compact()
        assert rows(st.read()) == before
        results.append(before)
    assert results[0] == results[1] == results[2] == {("a", 5.0, 5, 5), ("b", 1.0, 1, 9)}


def folders(st):
    return {n: sorted(map(int, (x.partition("=")[2] for x in Folder(st.spark, f"{st.path}/data/{n}").names() if x.startswith("_bucket")))) for n in st._data.names()}


def test_a_write_touches_the_buckets_of_its_keys(spark):
    st = Store(spark, scratch_path(spark, "t"), "id", buckets=8)
    st.commit(spark.range(400).select("id", F.lit("P").alias("s")))
    before = set(folders(st))
    st.put(spark.createDataFrame([(7, "Q", 1)], "id long, s string, _seq int"))
    (new,) = set(folders(st)) - before
    assert len(folders(st)[new]) == 1
    assert st.read().count() == 400 and st.read().where("s = 'Q'").count() == 1
    assert st.by_selection(F.col("id") == 9, {"s": up.assign("R")}) == 1
    assert [len(x) for n, x in folders(st).items() if n not in before | {new}] == [1]
    assert st.by_selection(F.col("id") == 11) == 1 and st.by_selection(F.col("id") == -1) == 0
    assert st.read().count() == 399 and st.read().where("id = 11").isEmpty()
    # folders of versions that are gone go too, the state stays
    assert st.vacuum(older_than=3600) == 0 and st.vacuum(older_than=0) >= 1
    assert rows(st.read().where("s <> 'P'")) == {(7, "Q"), (9, "R")} and st.read().count() == 399


def test_of_two_writers_one_fails(spark):
    path = scratch_path(spark, "t")
    one, two = Store(spark, path, "id"), Store(spark, path, "id")
    one.commit(spark.range(20).select("id", F.lit("P").alias("s")))
    at = two._latest()
    one.put(spark.createDataFrame([(1, "Q", 1)], "id long, s string, _seq int"))
    with pytest.raises(ConcurrentWrite):
        two._replace(at, [0], two._state(at, [0]))
    assert two.version() == 1 and two.read().where("s = 'Q'").count() == 1
    assert not [n for n in one._commits.names() if n.startswith(".")]


def test_feed_is_folded_beside_the_stream(spark):
    st = Store(spark, scratch_path(spark, "t"), "id", buckets=4)
    for i in range(5):
        st.feed(changes(spark, [("a", float(i), i, i), (f"k{i}", 0.0, 0, i)]), str(i), failed=i)
    assert st.commits().where("kind = 'base'").count() == 0 and len(st._latest()["deltas"]) == 5
    assert tuple(st.totals().first()) == (5, 20, 10, 10)
    # a batch that comes while the others are folded stays open
    append = st._append
    st._append = lambda *a, **k: (setattr(st, "_append", append), st.feed(changes(spark, [("z", 9.0, 9, 9)]), "late"), append(*a, **k))[2]
    st.compact()
    assert len(st._latest()["deltas"]) == 1
    assert st.read().count() == 7 and ("a", 4.0, 4, 4) in rows(st.read()) and ("z", 9.0, 9, 9) in rows(st.read())


def test_chunks_copy_into_a_store(spark):
    df = spark.range(300).select("id", F.lit("P").alias("s"))
    work, to = ChunkedSelection(spark, scratch_path(spark, "c"), "id", 4), Store(spark, scratch_path(spark, "t"), "id")
    to.commit(df.where("id < 10").withColumn("s", F.lit("old")))
    work.prepare(df)
    n, _ = work.step(0, F.col("id") % 3 == 0, copy_to=to)
    work.step(0, F.col("id") % 3 == 0, copy_to=to)  # repeated after a crash: put once
    assert to.version() == 1 and n > 0
    assert work.run(F.col("id") % 3 == 0, copy_to=to) == 100
    assert to.read().where("s = 'P'").count() == 100 and to.read().where("s = 'old'").count() == 6


def test_chunks_resume_and_repeat(spark):
    df = spark.range(1000).select("id", F.lit("P").alias("s"))
    work = ChunkedSelection(spark, scratch_path(spark, "c"), "id", 5)
    work.prepare(df)
    sel, ops = F.col("id") < 500, {"s": up.assign("Q")}
    n0, nxt = work.step(work.token(), sel, ops)
    assert nxt == work.token() == 1
    with pytest.raises(ValueError):
        work.result()  # four chunks are missing
    work.step(0, sel, ops)  # the same chunk again: its folder is overwritten, its row counted once
    assert work.run(sel, ops) == 500 and work.token() is None
    out = work.result()
    assert out.count() == 1000 and out.where("s = 'Q'").count() == 500


def test_chunks_without_rows(spark):
    work = ChunkedSelection(spark, scratch_path(spark, "c"), "id", 9)
    work.prepare(spark.range(3).select("id", F.lit("P").alias("s")))
    assert work.run(F.col("id") < 2) == 2
    assert [r["id"] for r in work.result().collect()] == [2]


def test_feed_wants_a_sequence_in_the_store(spark, base):
    st = Store(spark, scratch_path(spark, "t"), "id")
    st.commit(base)
    with pytest.raises(ValueError):
        st.feed(changes(spark, [("a", 1.0, 1, 1)]), "0")


def test_put_in_location(spark):
    rows_ = [(1, 7, "a"), (2, 7, "b"), (1, 8, "c")]
    base = spark.createDataFrame(rows_, "id int, loc int, v string")
    ch = spark.createDataFrame([(1, 7, "x", 1), (1, 7, "y", 2), (1, 8, "z", 1), (9, 7, "n", 1)], "id int, loc int, v string, _seq int")
    assert rows(writes.put_in_location(base, ch, "id", "loc", 7)) == {(1, 7, "y"), (2, 7, "b"), (1, 8, "c"), (9, 7, "n")}


def test_stream_replay_and_error_sink(spark):
    src = scratch_path(spark, "src")
    for i, part in enumerate([[("a", 1.0, 1, 1), ("b", -1.0, 1, 2)], [("a", 2.0, 2, 3)]]):
        changes(spark, part).coalesce(1).write.mode("append").parquet(src)
    base = scratch_path(spark, "feed")
    st = Store(spark, f"{base}/store", "id")

    def run(checkpoint):
        s = fd.file_stream(spark, src, changes(spark, []).schema, max_files=1)
        q = fd.feed(s, st, f"{base}/{checkpoint}", "log", valid=F.col("price") > 0, errors_path=f"{base}/errors", once=True)
        q.awaitTermination()
        return q

    q = run("cp1")
    assert sum(p["rows"] for p in fd.feed_progress(q)) == 3
    v = st.version()
    run("cp2")  # all batches again, as after a lost checkpoint
    assert st.version() == v
    assert rows(st.read()) == {("a", 2.0, 2, 3)}
    assert rows(spark.read.parquet(f"{base}/errors").select("id", "status")) == {("b", 400)}


def test_two_streams_feed_one_store(spark):
    base = scratch_path(spark, "feeds")
    st = Store(spark, f"{base}/store", "id")
    for name in ("first", "second"):
        changes(spark, [(name, 1.0, 1, 1)]).coalesce(1).write.parquet(f"{base}/{name}")
        s = fd.file_stream(spark, f"{base}/{name}", changes(spark, []).schema)
        fd.feed(s, st, f"{base}/cp-{name}", name, once=True).awaitTermination()
    assert rows(st.read()) == {("first", 1.0, 1, 1), ("second", 1.0, 1, 1)}


def test_an_unreadable_commit_table_is_no_empty_store(spark):
    st = Store(spark, scratch_path(spark, "t"), "id")
    assert st.version() == -1
    with pytest.raises(AnalysisException):
        _only_missing(AnalysisException("no right to read"))


def test_field_operations(spark):
    df = spark.createDataFrame([(["x", "y", "x"], {"k": 1, "j": 2}, None)], "a array<string>, m map<string,int>, e map<string,int>")
    new = F.create_map(F.lit("k"), F.lit(9), F.lit("n"), F.lit(4))
    r = df.select(
        up.add_elements(F.array(F.lit("x")))(F.col("a")).alias("added"), up.remove_elements(F.array(F.lit("x")))(F.col("a")).alias("removed"),
        up.add_weights(new)(F.col("m")).alias("w"), up.add_weights(new)(F.col("e")).alias("e"), up.remove_keys(F.array(F.lit("k")))(F.col("m")).alias("rm"),
        up.match_key("j", up.multiply(10))(F.col("m")).alias("mk"), up.match_index(1, up.assign("Z"))(F.col("a")).alias("mi"),
    ).first()
    assert r["added"] == ["x", "y", "x", "x"] and r["removed"] == ["y"]
    assert r["w"] == {"k": 9, "j": 2, "n": 4} and r["e"] == {"k": 9, "n": 4} and r["rm"] == {"j": 2}
    assert r["mk"] == {"k": 1, "j": 20} and r["mi"] == ["x", "Z", "x"]
    dense = spark.createDataFrame([([1.0, 2.0],)], "v array<double>")
    cells = F.create_map(F.lit(1), F.lit(5.0), F.lit(8), F.lit(1.0))
    assert dense.select(up.modify_dense("add", cells)(F.col("v"))).first()[0] == [1.0, 7.0]


def test_conditions_read_the_stored_rows_once(spark, base, tmp_path):
    base.write.parquet(str(tmp_path / "t"))
    stored, ch = spark.read.parquet(str(tmp_path / "t")), changes(spark, [("a", 1.0, 1, 1), ("a", 2.0, 2, 2), ("new", 3.0, 3, 1)])
    out = writes.conditional_put(stored, ch, "id", F.col("new_price") > 0)
    for df in (out.state, out.errors, writes.conditional_delete(stored, ch, "id", F.col("price") > 0).state):
        assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert ("a", 2.0, 2) in rows(out.state) and rows(out.errors) == {("new", "document does not exist", 412)}
