"""Queries on scans, exports, keyed writes, parents and formats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.functions import ids, updates as up, vectors as vx
from lodestone.operators import bulk, parents, writes
from lodestone.plans.registry import Tables, query
from lodestone.session import scratch_path
from lodestone.sources import extra, jsonl, tables
from lodestone.sources.store import ChunkedSelection, Store

CUSTOMER = tables.DocType(
    "customer",
    "c_custkey",
    summaries={
        "short": tables.Summary(["c_custkey", "c_name"]),
        "money": tables.Summary(["c_acctbal"], inherits="short"),
    },
)

# -- scans -------------------------------------------------------------------------------------


@query("S01_scan_type", "SELECT * FROM orders")
def _(t: Tables):
    return tables.scan(t.spark, f"{t.folder}/orders.parquet")


@query(
    "S02_scan_all_types",
    """SELECT 'customer' AS _type, c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
              NULL::BIGINT AS s_suppkey, NULL::VARCHAR AS s_name, NULL::INTEGER AS s_nationkey, NULL::DOUBLE AS s_acctbal
       FROM customer
       UNION ALL
       SELECT 'supplier', NULL, NULL, NULL, NULL, NULL, s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier""",
)
def _(t):
    return tables.scan_types(
        {"customer": t.customer, "supplier": t.supplier, "part": t.part}, restrict=["customer", "supplier"]
    )


@query(
    "S03_visit_selection",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 200000 AND o_orderstatus = 'F'",
)
def _(t):
    return tables.visit(t.orders, "o_totalprice > 200000 AND o_orderstatus = 'F'", ["o_orderkey", "o_totalprice"])


@query("S04_visit_slices_cover", "SELECT o_orderkey, o_totalprice FROM orders")
def _(t):
    """All slices together are the whole table: no row twice, none missing."""
    parts = [tables.visit(t.orders, columns=["o_orderkey", "o_totalprice"], key="o_orderkey", slices=4, slice_id=i) for i in range(4)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query(
    "S05_visit_time_range",
    "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-12 06:00:00'",
)
def _(t):
    return tables.visit(
        t.events, columns=["event_id", "ts"], time_column="ts", from_time="2024-01-05 00:00:00", to_time="2024-01-12 06:00:00"
    )


@query("S06_column_subset", "SELECT c_custkey, c_mktsegment FROM customer")
def _(t):
    df = t.customer
    return df.select(*tables.columns_of(CUSTOMER, "customer:c_custkey,c_mktsegment", df.columns))


@query("S06_summary_class", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def _(t):
    df = t.customer
    return df.select(*tables.columns_of(CUSTOMER, "money", df.columns))


def event_log(t: Tables) -> DataFrame:
    """A change log of customers: every event puts its user's row, errors remove it, sign-ups are new keys."""
    new_key = F.when(F.col("event_type") == "signup", F.col("user_id") + 10_000_000).otherwise(F.col("user_id"))
    return t.events.select(
        new_key.alias("c_custkey"),
        F.concat(F.lit("User#"), "user_id").alias("c_name"),
        (F.col("user_id") % 25).cast("int").alias("c_nationkey"),
        F.col("value").alias("c_acctbal"),
        F.col("event_type").alias("c_mktsegment"),
        F.col("event_id").alias("_seq"),
        F.when(F.col("event_type") == "error", "remove").otherwise("put").alias("_op"),
    )


SQL_LOG = """log AS (
  SELECT CASE WHEN event_type = 'signup' THEN user_id + 10000000 ELSE user_id END AS c_custkey,
         'User#' || user_id AS c_name, (user_id % 25)::INTEGER AS c_nationkey, value AS c_acctbal,
         event_type AS c_mktsegment, event_id AS _seq,
         CASE WHEN event_type = 'error' THEN 'remove' ELSE 'put' END AS _op
  FROM events),
last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY _seq DESC) rn FROM log) WHERE rn = 1)"""
CUST = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"


@query("S07_visit_with_removes", f"WITH {SQL_LOG} SELECT c_custkey, _op, _seq FROM log")
def _(t):
    return tables.visit(event_log(t), columns=["c_custkey", "_op", "_seq"], include_removes=True)


@query("S07_visit_without_removes", f"WITH {SQL_LOG} SELECT c_custkey, _seq FROM log WHERE _op <> 'remove'")
def _(t):
    return tables.visit(event_log(t), columns=["c_custkey", "_seq"])


PART_FIELDS = (
    T.StructType().add("p_partkey", "long").add("p_name", "string").add("p_brand", "string").add("p_type", "string")
    .add("p_size", "integer").add("p_retailprice", "double")
)


@query(
    "S08_read_jsonl",
    """SELECT 'id:shop:part::' || p_partkey AS id, p_partkey::VARCHAR AS key,
              CASE WHEN p_size > 40 THEN 'remove' ELSE 'put' END AS _op,
              CASE WHEN p_size <= 40 THEN p_partkey END AS p_partkey,
              CASE WHEN p_size <= 40 THEN p_name END AS p_name,
              CASE WHEN p_size <= 40 THEN p_brand END AS p_brand,
              CASE WHEN p_size <= 40 THEN p_type END AS p_type,
              CASE WHEN p_size <= 40 THEN p_size END AS p_size,
              CASE WHEN p_size <= 40 THEN p_retailprice END AS p_retailprice
       FROM part""",
)
def _(t):
    """Round trip of an export with tombstones, continuation lines and broken lines."""
    path = scratch_path(t.spark, "jsonl")
    log = t.part.withColumn("_op", F.when(F.col("p_size") > 40, "remove").otherwise("put"))
    lines = jsonl.feed_lines(log, "shop", "part", "p_partkey")
    noise = t.nation.select(F.concat(F.lit('{"continuation":"'), "n_name", F.lit('"}')).alias("value")).unionByName(
        t.region.select(F.concat(F.lit('{"put": broken '), "r_name").alias("value"))
    )
    lines.unionByName(noise).write.text(path, compression="gzip")
    return jsonl.read_jsonl(t.spark, path, PART_FIELDS)


@query(
    "S09_write_jsonl",
    """SELECT '{"put":"id:shop:part:n=' || p_size || ':' || p_partkey || '","fields":{"p_partkey":' || p_partkey
              || ',"p_name":"' || p_name || '","p_size":' || p_size || '}}' AS value FROM part""",
)
def _(t):
    path = scratch_path(t.spark, "feed")
    df = t.part.select("p_partkey", "p_name", "p_size")
    loc = F.concat(F.lit("n="), F.col("p_size").cast("string"))
    jsonl.feed_lines(df, "shop", "part", "p_partkey", loc).write.text(path)
    return t.spark.read.text(path)


BUILT_ID = """CASE WHEN p_size > 40 THEN p_name
      ELSE 'id:shop:part:' || CASE WHEN p_size > 20 THEN 'n=' || p_size ELSE '' END || ':' || p_partkey
           || CASE WHEN p_size <= 10 THEN ':' || p_type ELSE '' END END"""


def built_ids(t: Tables) -> DataFrame:
    """Full ids, some with a location, some with a colon in the user part, and bare ids."""
    user = F.concat(
        F.col("p_partkey").cast("string"), F.when(F.col("p_size") <= 10, F.concat(F.lit(":"), "p_type")).otherwise("")
    )
    loc = F.when(F.col("p_size") > 20, F.concat(F.lit("n="), F.col("p_size").cast("string"))).otherwise("")
    full = ids.full_id("shop", "part", user, loc)
    return t.part.select(F.when(F.col("p_size") > 40, F.col("p_name")).otherwise(full).alias("doc_id"), "p_partkey")


@query(
    "S10_split_document_id",
    f"""SELECT p_partkey, CASE WHEN f THEN split_part(doc_id, ':', 2) END AS namespace,
               CASE WHEN f THEN split_part(doc_id, ':', 3) END AS doc_type,
               CASE WHEN f THEN split_part(doc_id, ':', 4) END AS location,
               CASE WHEN f THEN regexp_extract(doc_id, '^id:[^:]*:[^:]*:[^:]*:(.*)$', 1) ELSE doc_id END AS user_part
        FROM (SELECT p_partkey, {BUILT_ID} AS doc_id, p_size <= 40 AS f FROM part)""",
)
def _(t):
    return built_ids(t).select("p_partkey", *[c.alias(n) for n, c in ids.id_parts("doc_id").items()])


@query("S11_get", "SELECT * FROM orders WHERE o_orderkey = 7")
def _(t):
    return tables.get(t.orders, "o_orderkey", 7)


@query(
    "S12_get_many",
    """SELECT o.* FROM orders o WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 49)""",
)
def _(t):
    heavy = t.lineitem.where("l_quantity >= 49").select("l_orderkey")
    missing = t.supplier.select((-F.col("s_suppkey") - 1).alias("l_orderkey"))
    return tables.get_many(t.orders, "o_orderkey", heavy.unionByName(missing).distinct())


# -- keyed writes ---------------------------------------------------------------------------------


@query(
    "S13_put",
    f"""WITH {SQL_LOG} SELECT {CUST} FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM last)
        UNION ALL SELECT {CUST} FROM last""",
)
def _(t):
    return writes.put(t.customer, event_log(t), "c_custkey")


@query(
    "S13_put_and_remove",
    f"""WITH {SQL_LOG} SELECT {CUST} FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM last)
        UNION ALL SELECT {CUST} FROM last WHERE _op = 'put'""",
)
def _(t):
    return writes.put_delete(t.customer, event_log(t), "c_custkey")


@query("S14_delete", "SELECT * FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 48)")
def _(t):
    gone = t.lineitem.where("l_quantity >= 48").select(F.col("l_partkey").alias("p_partkey"))
    return writes.delete(t.part, gone, "p_partkey")


SQL_JUDGED = f"""WITH {SQL_LOG}, judged AS (
  SELECT l.*, c.c_custkey IS NOT NULL AS stored, coalesce(c.c_acctbal < l.c_acctbal * 100, false) AS holds
  FROM last l LEFT JOIN customer c USING (c_custkey))"""


def _conditional(t: Tables, create: bool = False) -> writes.Applied:
    return writes.conditional_put(
        t.customer, event_log(t), "c_custkey", F.col("c_acctbal") < F.col("new_c_acctbal") * 100, create_if_missing=create
    )


@query(
    "S15_conditional_put",
    f"""{SQL_JUDGED} SELECT {CUST} FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM judged WHERE holds)
        UNION ALL SELECT {CUST} FROM judged WHERE holds""",
)
def _(t):
    return _conditional(t).state


@query(
    "S15_conditional_put_failures",
    f"""{SQL_JUDGED} SELECT c_custkey::VARCHAR AS id,
               CASE WHEN stored THEN 'condition not met' ELSE 'document does not exist' END AS message, 412 AS status
        FROM judged WHERE NOT holds""",
)
def _(t):
    return _conditional(t).errors


@query(
    "S15_conditional_create",
    f"""{SQL_JUDGED} SELECT {CUST} FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM judged WHERE holds)
        UNION ALL SELECT {CUST} FROM judged WHERE holds OR NOT stored""",
)
def _(t):
    return _conditional(t, create=True).state


@query(
    "S15_conditional_delete",
    f"""{SQL_JUDGED} SELECT {CUST} FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM judged WHERE holds)""",
)
def _(t):
    return writes.conditional_delete(
        t.customer, event_log(t), "c_custkey", F.col("c_acctbal") < F.col("new_c_acctbal") * 100
    ).state


def order_totals(t: Tables) -> DataFrame:
    """Per customer key the order count and top price; keys shifted so that some customers are missing."""
    return t.orders.groupBy((F.col("o_custkey") + 50).alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("top")
    )


SQL_TOTALS = """ch AS (SELECT o_custkey + 50 AS c_custkey, count(*) AS n, max(o_totalprice) AS top FROM orders GROUP BY 1)"""


def order_ops():
    return {
        "c_acctbal": up.increment(F.col("new_top")),
        "c_mktsegment": up.assign(F.concat(F.lit("seg"), F.col("new_n").cast("string"))),
    }


@query(
    "S16_update_fields",
    f"""WITH {SQL_TOTALS} SELECT c.c_custkey, c_name, c_nationkey,
            CASE WHEN n IS NULL THEN c_acctbal ELSE c_acctbal + top END AS c_acctbal,
            CASE WHEN n IS NULL THEN c_mktsegment ELSE 'seg' || n END AS c_mktsegment
        FROM customer c LEFT JOIN ch USING (c_custkey)""",
)
def _(t):
    return writes.update_fields(t.customer, order_totals(t), "c_custkey", order_ops()).state


@query(
    "S16_update_create_if_missing",
    f"""WITH {SQL_TOTALS} SELECT coalesce(c.c_custkey, ch.c_custkey) AS c_custkey, c_name, c_nationkey,
            CASE WHEN n IS NULL THEN c_acctbal ELSE c_acctbal + top END AS c_acctbal,
            CASE WHEN n IS NULL THEN c_mktsegment ELSE 'seg' || n END AS c_mktsegment
        FROM customer c FULL JOIN ch ON c.c_custkey = ch.c_custkey""",
)
def _(t):
    return writes.update_fields(t.customer, order_totals(t), "c_custkey", order_ops(), create_if_missing=True).state


@query(
    "S16_update_condition_failures",
    f"""WITH {SQL_TOTALS} SELECT ch.c_custkey::VARCHAR AS id,
            CASE WHEN c.c_custkey IS NULL THEN 'document does not exist' ELSE 'condition not met' END AS message, 412 AS status
        FROM ch LEFT JOIN customer c USING (c_custkey) WHERE c.c_custkey IS NULL OR NOT c_acctbal > 1000""",
)
def _(t):
    return writes.update_fields(
        t.customer, order_totals(t), "c_custkey", order_ops(), condition=F.col("c_acctbal") > 1000
    ).errors


@query("S17_location_get", "SELECT * FROM orders WHERE o_custkey = 7")
def _(t):
    path = scratch_path(t.spark, "located")
    tables.write_located(t.orders, path, "o_custkey", "o_orderkey", buckets=16)
    return tables.read_located(t.spark, path, 7)


@query(
    "S17_location_put",
    """WITH ch AS (SELECT o_orderkey, o_custkey, 'R' AS o_orderstatus, max(l_extendedprice) AS o_totalprice, o_orderdate, o_orderpriority
                   FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_custkey = 7 GROUP BY ALL)
       SELECT * FROM orders WHERE o_custkey <> 7 OR o_orderkey NOT IN (SELECT o_orderkey FROM ch) UNION ALL SELECT * FROM ch""",
)
def _(t):
    """Changes for every location arrive, one location takes its own."""
    top = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_extendedprice").alias("top"))
    ch = t.orders.join(top, "o_orderkey").withColumns(
        {"o_orderstatus": F.lit("R"), "o_totalprice": F.col("top"), "_seq": F.lit(0)}
    )
    return writes.put_in_location(t.orders, ch, "o_orderkey", "o_custkey", 7)


@query(
    "S17_location_update",
    """SELECT o_orderkey, o_custkey, CASE WHEN o_custkey = 7 AND o_orderstatus = 'F' THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
              o_totalprice, o_orderdate, o_orderpriority FROM orders""",
)
def _(t):
    sel = (F.col("o_custkey") == 7) & (F.col("o_orderstatus") == "F")
    return writes.update_by_selection(t.orders, sel, {"o_orderstatus": up.assign("X")})


@query("S17_location_delete", "SELECT * FROM orders WHERE o_custkey <> 7 OR o_totalprice <= 100000")
def _(t):
    return writes.delete_by_selection(t.orders, (F.col("o_custkey") == 7) & (F.col("o_totalprice") > 100000))


@query(
    "S18_user_search",
    "SELECT event_id, event_type, value FROM events WHERE user_id = 42 AND value > 5 AND lower(event_type) = 'click'",
)
def _(t):
    own = tables.in_location(t.events, "user_id", 42, "value > 5")
    return own.where(F.lower("event_type") == "click").select("event_id", "event_type", "value")


STATUS_OPS = {"o_orderstatus": up.assign("C"), "o_totalprice": up.multiply(0.5)}


@query(
    "S19_update_by_selection",
    """SELECT o_orderkey, o_custkey, CASE WHEN o_totalprice > 400000 THEN 'C' ELSE o_orderstatus END AS o_orderstatus,
              CASE WHEN o_totalprice > 400000 THEN o_totalprice * 0.5 ELSE o_totalprice END AS o_totalprice,
              o_orderdate, o_orderpriority FROM orders""",
)
def _(t):
    return writes.update_by_selection(t.orders, F.col("o_totalprice") > 400000, STATUS_OPS)


@query("S19_affected_count", "SELECT count(*) AS affected FROM orders WHERE o_totalprice > 400000")
def _(t):
    """The count the commit of a selection-wide update reports."""
    store = Store(t.spark, scratch_path(t.spark, "store"), "o_orderkey")
    store.commit(t.orders)
    store.by_selection(F.col("o_totalprice") > 400000, STATUS_OPS)
    return store.commits().where("affected IS NOT NULL").select("affected")


@query("S20_delete_by_selection", "SELECT * FROM orders WHERE NOT (o_orderpriority = '5-LOW' AND o_totalprice < 100000)")
def _(t):
    return writes.delete_by_selection(t.orders, (F.col("o_orderpriority") == "5-LOW") & (F.col("o_totalprice") < 100000))


@query(
    "S21_copy_by_selection",
    """SELECT * FROM orders WHERE o_totalprice > 300000
       UNION ALL SELECT o_orderkey, o_custkey, 'old', 0.0::DOUBLE, o_orderdate, o_orderpriority FROM orders
       WHERE o_orderstatus = 'F' AND NOT o_totalprice > 300000""",
)
def _(t):
    destination = t.orders.where("o_orderstatus = 'F'").withColumns({"o_orderstatus": F.lit("old"), "o_totalprice": F.lit(0.0)})
    return writes.copy_by_selection(t.orders, F.col("o_totalprice") > 300000, destination, "o_orderkey")


@query(
    "S22_chunked_update",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'Q' ELSE o_orderstatus END AS o_orderstatus FROM orders""",
)
def _(t):
    work = ChunkedSelection(t.spark, scratch_path(t.spark, "chunks"), "o_orderkey", 4)
    work.prepare(t.orders.select("o_orderkey", "o_orderstatus"))
    # stop after one chunk, then resume from the progress table
    work.step(work.token(), F.col("o_orderstatus") == "P", {"o_orderstatus": up.assign("Q")})
    work.run(F.col("o_orderstatus") == "P", {"o_orderstatus": up.assign("Q")})
    return work.result()


@query("S22_chunked_delete", "SELECT o_orderkey, o_totalprice FROM orders WHERE NOT o_totalprice < 150000")
def _(t):
    work = ChunkedSelection(t.spark, scratch_path(t.spark, "chunks"), "o_orderkey", 3)
    work.prepare(t.orders.select("o_orderkey", "o_totalprice"))
    work.run(F.col("o_totalprice") < 150000)
    return work.result()


@query("S22_chunked_copy", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 350000")
def _(t):
    work = ChunkedSelection(t.spark, scratch_path(t.spark, "chunks"), "o_orderkey", 3)
    work.prepare(t.orders.select("o_orderkey", "o_totalprice"))
    work.run(F.col("o_totalprice") > 350000, copy=True)
    return work.result()


SQL_FED = f"""WITH {SQL_LOG}, bad AS (SELECT * FROM log WHERE NOT c_acctbal >= 1)"""


def _fed(t: Tables) -> writes.Applied:
    return writes.bulk_put(t.customer, event_log(t), "c_custkey", valid=F.col("c_acctbal") >= 1)


@query(
    "S23_bulk_put_summary",
    f"""{SQL_FED} SELECT total, total - failure AS success, failure, (total - failure) / total::DOUBLE AS success_rate
        FROM (SELECT count(*) AS total FROM log), (SELECT count(*) AS failure FROM bad)""",
)
def _(t):
    return writes.feed_summary(event_log(t), _fed(t).errors)


@query("S23_bulk_put_errors", f"{SQL_FED} SELECT c_custkey::VARCHAR AS id, 'invalid document' AS message, 400 AS status FROM bad")
def _(t):
    return _fed(t).errors


@query(
    "S23_bulk_put_dry_run",
    f"""{SQL_FED} SELECT total, total - failure AS success, failure, (total - failure) / total::DOUBLE AS success_rate
        FROM (SELECT count(*) AS total FROM log), (SELECT count(*) AS failure FROM bad)""",
)
def _(t):
    store = Store(t.spark, scratch_path(t.spark, "store"), "c_custkey")
    store.commit(t.customer)
    return store.dry_run(event_log(t), valid=F.col("c_acctbal") >= 1)


def bulk_ops(t: Tables) -> DataFrame:
    """Operations as rows; supplier keys repeat a field of customers that have orders."""
    per = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"), F.max("o_orderpriority").alias("p"))
    return (
        per.select("c_custkey", F.lit("c_acctbal").alias("field"), F.lit("increment").alias("op"), F.col("n").cast("string").alias("value"))
        .unionByName(per.select("c_custkey", F.lit("c_mktsegment").alias("field"), F.lit("assign").alias("op"), F.col("p").alias("value")))
        .unionByName(
            t.supplier.select(
                (F.col("s_suppkey") * 20).alias("c_custkey"), F.lit("c_acctbal").alias("field"), F.lit("multiply").alias("op"),
                F.lit("2").alias("value"),
            )
        )
    )


SQL_OPS = """per AS (SELECT o_custkey AS c_custkey, count(*) AS n, max(o_orderpriority) AS p FROM orders GROUP BY 1),
mul AS (SELECT s_suppkey * 20 AS c_custkey FROM supplier),
dup AS (SELECT c_custkey FROM per INTERSECT SELECT c_custkey FROM mul)"""


@query(
    "S24_bulk_update",
    f"""WITH {SQL_OPS} SELECT c.c_custkey, c_name, c_nationkey,
            CASE WHEN dup.c_custkey IS NOT NULL THEN c_acctbal WHEN per.c_custkey IS NOT NULL THEN c_acctbal + n
                 WHEN mul.c_custkey IS NOT NULL THEN c_acctbal * 2 ELSE c_acctbal END AS c_acctbal,
            CASE WHEN dup.c_custkey IS NULL AND per.c_custkey IS NOT NULL THEN p ELSE c_mktsegment END AS c_mktsegment
        FROM customer c LEFT JOIN per ON per.c_custkey = c.c_custkey LEFT JOIN mul ON mul.c_custkey = c.c_custkey
        LEFT JOIN dup ON dup.c_custkey = c.c_custkey""",
)
def _(t):
    return bulk.bulk_update(t.customer, bulk_ops(t), "c_custkey", ["c_acctbal", "c_mktsegment"]).state


@query(
    "S24_bulk_update_errors",
    f"""WITH {SQL_OPS} SELECT c_custkey::VARCHAR AS id, 'one field updated twice in a batch' AS message, 400 AS status FROM dup
        UNION ALL SELECT c_custkey::VARCHAR, 'document does not exist', 412 FROM
          (SELECT c_custkey FROM per UNION SELECT c_custkey FROM mul)
        WHERE c_custkey NOT IN (SELECT c_custkey FROM customer) AND c_custkey NOT IN (SELECT c_custkey FROM dup)""",
)
def _(t):
    return bulk.bulk_update(t.customer, bulk_ops(t), "c_custkey", ["c_acctbal", "c_mktsegment"]).errors


def tagged(t: Tables) -> DataFrame:
    """Customers with the priorities of their orders and a count by status."""
    of = t.orders.groupBy("o_custkey").agg(
        F.sort_array(F.collect_set("o_orderpriority")).alias("tags"),
        F.map_from_arrays(F.array(F.lit("F"), F.lit("O")), F.array(F.count_if(F.col("o_orderstatus") == "F"), F.count_if(F.col("o_orderstatus") == "O"))).alias("counts"),
    )
    return t.customer.join(of, F.col("c_custkey") == F.col("o_custkey")).select("c_custkey", "c_acctbal", "tags", "counts")


def typed_ops(t: Tables) -> DataFrame:
    """An operation chosen by key for every customer, some under a condition, some that cannot be applied."""
    k = F.col("c_custkey")
    kinds = [
        ("tags", "add", '["NEW"]', None, "rich"), ("tags", "remove", '["1-URGENT", "5-LOW"]', None, None), ("tags", "assign", "FIRST", "0", None),
        ("counts", "increment", "9007199254740993", "F", None), ("counts", "remove", '["O"]', None, "rich"), ("counts", "add", '{"P": 7}', None, None),
        ("c_acctbal", "multiply", "abc", None, None), ("c_acctbal", "twice", "1", None, None), ("c_acctbal", "decrement", "10.5", None, "poor"),
    ]
    picked = [F.struct(*[F.lit(v).cast("string").alias(n) for n, v in zip(("field", "op", "value", "at", "condition"), x)]) for x in kinds]
    return t.customer.select("c_custkey", F.inline(F.array(F.element_at(F.array(*picked), (k % len(kinds) + 1).cast("int")))))


def conditions() -> dict[str, Column]:
    return {"rich": F.col("c_acctbal") > 5000, "poor": F.col("c_acctbal") < 5000}


def _typed(t: Tables) -> writes.Applied:
    return bulk.bulk_update(tagged(t), typed_ops(t), "c_custkey", ["c_acctbal", "tags", "counts"], conditions=conditions())


SQL_TAGGED = """tagged AS (SELECT c_custkey, c_acctbal, list_sort(list(DISTINCT o_orderpriority)) AS tags,
    count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'O') AS o
    FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY ALL)"""


@query(
    "S24_bulk_update_typed",
    f"""WITH {SQL_TAGGED}, g AS (SELECT *, c_custkey % 9 AS k FROM tagged)
        SELECT c_custkey, CASE WHEN k = 8 AND c_acctbal < 5000 THEN c_acctbal - 10.5 ELSE c_acctbal END AS c_acctbal,
            array_to_string(CASE WHEN k = 0 AND c_acctbal > 5000 THEN list_append(tags, 'NEW')
                WHEN k = 1 THEN list_filter(tags, lambda x: x NOT IN ('1-URGENT', '5-LOW'))
                WHEN k = 2 THEN list_concat(['FIRST'], tags[2:]) ELSE tags END, ',') AS tags,
            CASE WHEN k = 3 THEN f + 9007199254740993 ELSE f END AS f, CASE WHEN k = 4 AND c_acctbal > 5000 THEN NULL ELSE o END AS o,
            CASE WHEN k = 5 THEN 7::BIGINT END AS p
        FROM g""",
)
def _(t):
    out = _typed(t).state
    return out.select("c_custkey", "c_acctbal", F.array_join("tags", ",").alias("tags"), *[F.try_element_at("counts", F.lit(x)).alias(x.lower()) for x in "FOP"])


@query(
    "S24_bulk_update_typed_errors",
    f"""WITH {SQL_TAGGED}, g AS (SELECT c.c_custkey, c.c_custkey % 9 AS k, t.c_acctbal AS held FROM customer c LEFT JOIN tagged t USING (c_custkey))
        SELECT c_custkey::VARCHAR AS id, CASE WHEN k = 6 THEN 'operand of multiply does not fit' WHEN k = 7 THEN 'unknown operation twice'
            WHEN held IS NULL THEN 'document does not exist' ELSE 'condition not met' END AS message, CASE WHEN k IN (6, 7) THEN 400 ELSE 412 END AS status
        FROM g WHERE k IN (6, 7) OR held IS NULL OR k IN (0, 4) AND NOT held > 5000 OR k = 8 AND NOT held < 5000""",
)
def _(t):
    return _typed(t).errors


@query(
    "S23_bulk_put_conditions",
    f"""WITH {SQL_LOG}, named AS (SELECT log.*, log.c_custkey % 3 AS k, c.c_acctbal AS held FROM log LEFT JOIN customer c ON c.c_custkey = log.c_custkey)
        SELECT c_custkey::VARCHAR AS id, 'condition not met' AS message, 412 AS status, count(*) AS changes
        FROM named WHERE k = 1 AND held IS NOT NULL AND NOT held > 5000 GROUP BY ALL""",
)
def _(t):
    """Every change of a document whose stored row misses the condition that the change names."""
    log = event_log(t).drop("_op").withColumn("condition", F.when(F.col("c_custkey") % 3 == 1, "rich"))
    out = writes.bulk_put(t.customer, log, "c_custkey", conditions=conditions())
    return out.errors.groupBy("id", "message", "status").agg(F.count(F.lit(1)).alias("changes"))


@query(
    "S13_store_put",
    f"""WITH {SQL_LOG} SELECT {CUST} FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM last) UNION ALL SELECT {CUST} FROM last WHERE _op = 'put'""",
)
def _(t):
    """The same upsert into a stored table: only the buckets of changed keys are written anew."""
    store = Store(t.spark, scratch_path(t.spark, "store"), "c_custkey")
    store.commit(t.customer)
    store.put(event_log(t))
    return store.read()


@query(
    "S22_chunked_copy_into_store",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 350000 OR o_orderkey % 50 = 0",
)
def _(t):
    """Chunk by chunk into a store that holds other documents and some of the same."""
    rows = t.orders.select("o_orderkey", "o_totalprice")
    to = Store(t.spark, scratch_path(t.spark, "store"), "o_orderkey")
    to.commit(rows.where("o_orderkey % 50 = 0"))
    work = ChunkedSelection(t.spark, scratch_path(t.spark, "chunks"), "o_orderkey", 3)
    work.prepare(rows)
    work.run(F.col("o_totalprice") > 350000, copy_to=to)
    return to.read()


@query("S25_bulk_delete", "SELECT * FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 40)")
def _(t):
    gone = t.lineitem.where("l_returnflag = 'R' AND l_quantity > 40").select(F.col("l_partkey").alias("p_partkey"))
    return writes.bulk_delete(t.part, gone, "p_partkey")


@query("S27_expire", "SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 10 DAY")
def _(t):
    now = F.lit("2024-01-30 12:00:00").cast("timestamp_ntz")
    return writes.expire(t.events, F.col("ts") > now - F.expr("INTERVAL 10 DAYS"))


@query(
    "S28_import_parent_field",
    """SELECT o_orderkey, o_custkey, c_name AS customer_name, c_mktsegment AS segment
       FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey""",
)
def _(t):
    known = t.customer.where("c_acctbal > 0")
    out = parents.import_fields(t.orders, "o_custkey", known, "c_custkey", {"customer_name": "c_name", "segment": "c_mktsegment"})
    return out.select("o_orderkey", "o_custkey", "customer_name", "segment")


@query(
    "S28_import_global_parent",
    "SELECT c_custkey, n_name AS nation_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey",
)
def _(t):
    out = parents.import_fields(t.customer, "c_nationkey", t.nation, "n_nationkey", {"nation_name": "n_name"}, global_parent=True)
    return out.select("c_custkey", "nation_name")


def with_json(t: Tables) -> DataFrame:
    """Event documents with two declared fields among undeclared ones."""
    return t.events.select(
        "event_id",
        F.concat(
            F.lit('{"kind":"'), "event_type", F.lit('","user":'), F.col("user_id").cast("string"), F.lit(",\"tag\":\"t"),
            (F.col("event_id") % 7).cast("string"), F.lit('",'), F.substring("props", 2, 1000),
        ).alias("doc"),
    )


@query(
    "S29_extra_fields",
    """SELECT event_id, event_type AS kind, user_id AS user, json_extract_string(props, '$.k') AS extra_k,
              '"t' || (event_id % 7) || '"' AS extra_tag, 2 AS n_extra,
              '{"kind":"' || event_type || '","user":' || user_id || ',"k":' || json_extract_string(props, '$.k')
                || ',"tag":"t' || (event_id % 7) || '"}' AS flat
       FROM events""",
)
def _(t):
    df = extra.capture_extra(with_json(t), "doc", {"kind": "string", "user": "bigint"})
    # map order follows the document; sort the entries so the flat text is comparable
    ordered = F.map_from_entries(F.array_sort(F.map_entries("extra")))
    return df.select(
        "event_id", "kind", "user",
        F.element_at("extra", "k").alias("extra_k"),
        F.element_at("extra", "tag").alias("extra_tag"),
        F.size("extra").alias("n_extra"),
        extra.flat_json({"kind": F.col("kind"), "user": F.col("user")}, ordered).alias("flat"),
    )


def tensor_json(t: Tables) -> DataFrame:
    """Every vector in one of the five layouts, chosen by its label."""
    e = F.col("embedding").cast("array<double>")
    dense = F.to_json(e)
    wrapped = F.concat(F.lit('{"values":'), F.to_json(F.array(F.slice(e, 1, 32), F.slice(e, 33, 32))), F.lit("}"))
    mapped = F.to_json(vx.mapped_from_dense(e))
    cells = F.concat(F.lit('{"cells":'), mapped, F.lit("}"))
    blocks = F.concat(F.lit('{"blocks":'), F.to_json(vx.blocks_from_dense(e, 16)), F.lit("}"))
    verbose = F.to_json(
        F.transform(e, lambda v, i: F.struct(F.create_map(F.lit("x"), i.cast("string")).alias("address"), v.alias("value")))
    )
    layout = F.col("label") % 5
    return t.embeddings.select(
        "vec_id", "label",
        F.when(layout == 0, dense).when(layout == 1, wrapped).when(layout == 2, cells).when(layout == 3, blocks)
        .otherwise(verbose).alias("json"),
    )


@query(
    "S30_tensor_json",
    """SELECT vec_id, 64 AS n_values,
              CASE label % 5 WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 2 THEN 64 WHEN 3 THEN 4 ELSE 64 END AS n_blocks,
              round(list_sum(list_transform(embedding, lambda v, i: v::DOUBLE * i)), 6) AS weighted
       FROM embeddings""",
)
def _(t):
    df = tensor_json(t).select("vec_id", vx.tensor_cells("json").alias("cells"))
    # cells keep their document order, so position weights check the order of all values
    flat = F.flatten(F.transform("cells", lambda c: c["values"]))
    df = df.select("vec_id", F.size("cells").alias("n_blocks"), flat.alias("v"))
    weighted = F.aggregate(F.transform("v", lambda v, i: v * (i + 1)), F.lit(0.0), lambda a, x: a + x)
    return df.select("vec_id", F.size("v").alias("n_values"), "n_blocks", F.round(weighted, 6).alias("weighted"))


# -- projection --------------------------------------------------------------------------------------


@query("J01_select_all", "SELECT * FROM part")
def _(t):
    return t.part


@query("J01_select_fields", "SELECT p_partkey, p_name, p_retailprice FROM part")
def _(t):
    return t.part.select("p_partkey", "p_name", "p_retailprice")


@query("J02_nested_path", "SELECT p_partkey, p_brand AS brand, p_size AS size, p_type AS type_name, NULL::VARCHAR AS missing FROM part")
def _(t):
    nested = t.part.select(
        "p_partkey",
        F.struct(F.struct(F.col("p_brand").alias("name")).alias("brand"), F.col("p_size").alias("size")).alias("info"),
        F.create_map(F.lit("type"), "p_type").alias("attrs"),
    )
    return nested.select(
        "p_partkey", F.col("info.brand.name").alias("brand"), F.col("info.size").alias("size"),
        F.element_at("attrs", "type").alias("type_name"), F.try_element_at("attrs", F.lit("none")).alias("missing"),
    )


# -- field updates -------------------------------------------------------------------------------------

WORDS = "string_split(p_name, ' ')"


def big():
    return F.col("p_size") > 25


def _numeric(name: str, field: str, op, sql: str) -> None:
    @query(name, f"SELECT p_partkey, {sql} AS {field} FROM part")
    def _(t, field=field, op=op):
        return writes.update_by_selection(t.part, big(), {field: op}).select("p_partkey", field)


_numeric("U01_assign", "p_brand", up.assign("Brand#new"), "CASE WHEN p_size > 25 THEN 'Brand#new' ELSE p_brand END")
_numeric("U02_increment", "p_size", up.increment(5), "CASE WHEN p_size > 25 THEN p_size + 5 ELSE p_size END")
_numeric("U03_decrement", "p_size", up.decrement(), "CASE WHEN p_size > 25 THEN p_size - 1 ELSE p_size END")
_numeric(
    "U04_multiply", "p_retailprice", up.in_order(up.multiply(1.5), lambda c: F.round(c, 4)),
    "CASE WHEN p_size > 25 THEN round(p_retailprice * 1.5, 4) ELSE p_retailprice END",
)
_numeric(
    "U05_divide", "p_retailprice", up.in_order(up.divide(4.0), lambda c: F.round(c, 4)),
    "CASE WHEN p_size > 25 THEN round(p_retailprice / 4.0, 4) ELSE p_retailprice END",
)


def _words(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", "p_size", F.split("p_name", " ").alias("w"), F.create_map(
        F.split_part("p_name", F.lit(" "), F.lit(1)), "p_size", F.lit("base"), F.lit(1)).alias("m"))


def _joined(c):
    return F.array_join(c, ",")


@query("U06_add_elements", f"SELECT p_partkey, array_to_string(list_concat({WORDS}, ['new', p_brand]), ',') AS w FROM part")
def _(t):
    df = t.part.select("p_partkey", "p_brand", F.split("p_name", " ").alias("w"))
    out = up.add_elements(F.array(F.lit("new"), F.col("p_brand")))(F.col("w"))
    return df.select("p_partkey", _joined(out).alias("w"))


@query(
    "U06_add_weights",
    """SELECT p_partkey, 99 AS w_red, 1 AS w_base, CASE WHEN split_part(p_name, ' ', 1) = 'red' THEN 2 ELSE 3 END AS n FROM part""",
)
def _(t):
    m = up.add_weights(F.create_map(F.lit("red"), F.lit(99)))(F.col("m"))
    return _words(t).select("p_partkey", m.alias("m")).select(
        "p_partkey", F.element_at("m", "red").alias("w_red"), F.element_at("m", "base").alias("w_base"), F.size("m").alias("n")
    )


@query(
    "U07_remove_elements",
    f"SELECT p_partkey, array_to_string(list_filter({WORDS}, lambda x: x NOT IN ('red', 'bolt')), ',') AS w FROM part",
)
def _(t):
    out = up.remove_elements(F.array(F.lit("red"), F.lit("bolt")))(F.col("w"))
    return _words(t).select("p_partkey", _joined(out).alias("w"))


@query(
    "U07_remove_keys",
    "SELECT p_partkey, CASE WHEN split_part(p_name, ' ', 1) = 'red' THEN 1 ELSE 2 END AS n FROM part",
)
def _(t):
    m = up.remove_keys(F.array(F.lit("red")))(F.col("m"))
    return _words(t).select("p_partkey", F.size(m).alias("n"))


@query(
    "U08_match",
    f"""SELECT p_partkey, CASE WHEN split_part(p_name, ' ', 1) = 'red' THEN p_size + 7 END AS w_red, 1 AS w_base,
              split_part(p_name, ' ', 1) || ',X' AS w FROM part""",
)
def _(t):
    m = up.match_key("red", up.increment(7))(F.col("m"))
    w = up.match_index(1, up.assign("X"))(F.col("w"))
    return _words(t).select(
        "p_partkey", F.try_element_at(m, F.lit("red")).alias("w_red"), F.element_at(m, "base").alias("w_base"), _joined(w).alias("w")
    )


@query("U09_clear", "SELECT p_partkey, CASE WHEN p_size > 25 THEN NULL ELSE p_type END AS p_type FROM part")
def _(t):
    return writes.update_by_selection(t.part, big(), {"p_type": up.clear()}).select("p_partkey", "p_type")


@query(
    "U10_modify_cells",
    """SELECT vec_id, round(list_sum(list_transform(embedding, lambda v, i:
          CASE i WHEN 1 THEN 1.0 WHEN 4 THEN 2.0 ELSE v::DOUBLE END * i)), 6) AS replaced,
          round(list_sum(list_transform(embedding, lambda v, i: (v::DOUBLE + CASE WHEN i IN (1, 4) THEN label ELSE 0 END) * i)), 6) AS added,
          round(list_sum(list_transform(embedding, lambda v, i: v::DOUBLE * CASE i WHEN 2 THEN 3.0 ELSE 1.0 END * i)), 6) AS multiplied
       FROM embeddings""",
)
def _(t):
    cells = lambda kv: F.create_map(*[x for k, v in kv.items() for x in (F.lit(str(k)), v)]).cast("map<string,double>")
    m = vx.mapped_from_dense("embedding")

    def weighted(c):
        parts = F.transform(F.map_entries(c), lambda e: e["value"] * (e["key"].cast("int") + 1))
        return F.round(F.aggregate(parts, F.lit(0.0), lambda a, x: a + x), 6)

    label = F.col("label")
    return t.embeddings.select("vec_id", "label", m.alias("m")).select(
        "vec_id",
        weighted(up.modify_cells("replace", cells({0: F.lit(1.0), 3: F.lit(2.0), 900: F.lit(5.0)}))(F.col("m"))).alias("replaced"),
        weighted(up.modify_cells("add", cells({0: label, 3: label}))(F.col("m"))).alias("added"),
        weighted(up.modify_cells("multiply", cells({1: F.lit(3.0)}))(F.col("m"))).alias("multiplied"),
    )


@query(
    "U11_field_paths",
    """SELECT p_partkey, p_size + 1 AS size, upper(p_brand) AS brand_name, p_type AS kind,
              CASE WHEN p_size > 25 THEN 'big' ELSE 'small' END AS tag_size, 'first' AS tag_0 FROM part""",
)
def _(t):
    tags = F.create_map(F.lit("size"), F.array(F.lit("none"), F.lit("z"))).alias("tags")
    df = t.part.select("p_partkey", "p_size", F.struct(
        F.col("p_size").alias("size"), F.struct(F.col("p_brand").alias("name")).alias("brand"), F.col("p_type").alias("kind"), tags
    ).alias("info"))
    info = up.in_order(
        up.at_path("size", op=up.increment(1)),
        up.at_path("brand.name", op=lambda c: F.upper(c)),
        up.at_path("tags", {"key": "size"}, 0, op=up.assign(F.when(F.col("p_size") > 25, "big").otherwise("small"))),
        up.at_path("tags", {"key": "size"}, 1, op=up.assign("first")),
    )(F.col("info"))
    return df.select("p_partkey", info.alias("i")).select(
        "p_partkey", F.col("i.size").alias("size"), F.col("i.brand.name").alias("brand_name"), F.col("i.kind").alias("kind"),
        F.element_at("i.tags", "size")[0].alias("tag_size"), F.element_at("i.tags", "size")[1].alias("tag_0"),
    )


@query(
    "U12_several_operations",
    """SELECT p_partkey, CASE WHEN p_size > 25 THEN 'renamed' ELSE p_name END AS p_name, p_brand, NULL::VARCHAR AS p_type,
              CASE WHEN p_size > 25 THEN p_size - 3 ELSE p_size END AS p_size,
              CASE WHEN p_size > 25 THEN round(p_retailprice + 50, 4) ELSE p_retailprice END AS p_retailprice
       FROM part WHERE p_size > 25
       UNION ALL SELECT * FROM part WHERE NOT p_size > 25""",
)
def _(t):
    ops = {
        "p_name": up.assign("renamed"), "p_size": up.decrement(3), "p_type": up.clear(),
        "p_retailprice": up.in_order(up.increment(50), lambda c: F.round(c, 4)),
    }
    return writes.update_by_selection(t.part, big(), ops)
