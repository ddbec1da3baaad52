"""Queries on order, paging, grouping, aggregates and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.functions import aggregates as ag, scalars as sc, text as tx
from lodestone.operators import grouping, order, ranking
from lodestone.plans.documents import BUILT_ID, built_ids
from lodestone.plans.registry import Tables, query, simple
from lodestone.plans.scores import sql_bm25

# -- order and paging ---------------------------------------------------------------------------


def _page(t_df: DataFrame, by, columns, hits=10, offset=0) -> DataFrame:
    page = order.hits(t_df, by(), hits, offset)
    return order.with_position(page, by(), start=offset + 1).select(*columns, "hit_rank")


def sql_page(columns: str, table: str, by: str, hits: int = 10, offset: int = 0, where: str = "true") -> str:
    return f"""SELECT {columns}, (row_number() OVER (ORDER BY {by}))::INTEGER AS hit_rank FROM {table} WHERE {where}
               QUALIFY hit_rank > {offset} AND hit_rank <= {offset + hits}"""


@query("T01_order_by", sql_page("o_orderkey, o_totalprice", "orders", "o_orderpriority ASC, o_totalprice DESC, o_orderkey", 50))
def _(t):
    by = lambda: [F.col("o_orderpriority").asc(), F.col("o_totalprice").desc(), F.col("o_orderkey").asc()]
    return _page(t.orders, by, ["o_orderkey", "o_totalprice"], 50)


@query(
    "T02_locale_order",
    """WITH w AS (SELECT DISTINCT unnest(list_filter(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')) AS w FROM documents)
       SELECT w, (row_number() OVER (ORDER BY w COLLATE sv, w))::INTEGER AS hit_rank FROM w QUALIFY hit_rank <= 2000""",
)
def _(t):
    words = t.documents.select(F.explode(F.array_distinct(tx.tokens("text"))).alias("w")).distinct()
    by = lambda: [order.locale_order("w", "sv"), F.col("w").asc()]
    return _page(words, by, ["w"], 2000)


@query("T03_sort_spec", sql_page("p_partkey", "part", "p_size ASC, p_retailprice DESC, p_partkey ASC", 30))
def _(t):
    return _page(t.part, lambda: order.sort_spec("+p_size -p_retailprice p_partkey"), ["p_partkey"], 30)


def sql_order(columns: str, table: str, by: str) -> str:
    return f"SELECT {columns}, row_number() OVER (ORDER BY {by}) - 1 AS position FROM {table}"


@query("T01_order_by_whole", sql_order("o_orderkey, o_totalprice", "orders", "o_orderpriority ASC, o_totalprice DESC, o_orderkey"))
def _(t):
    """Every row with its place in the order."""
    by = [F.col("o_orderpriority").asc(), F.col("o_totalprice").desc(), F.col("o_orderkey").asc()]
    return order.number_rows(t.orders.select("o_orderkey", "o_totalprice", "o_orderpriority"), by).drop("o_orderpriority")


@query(
    "T02_locale_order_whole",
    """WITH w AS (SELECT DISTINCT unnest(list_filter(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')) AS w FROM documents)
       SELECT w, row_number() OVER (ORDER BY w COLLATE sv, w) - 1 AS position FROM w""",
)
def _(t):
    words = t.documents.select(F.explode(F.array_distinct(tx.tokens("text"))).alias("w")).distinct()
    return order.number_rows(words, [order.locale_order("w", "sv"), F.col("w").asc()])


@query("T03_sort_spec_whole", sql_order("p_partkey", "part", "p_size ASC, p_retailprice DESC, p_partkey ASC"))
def _(t):
    ranked = order.number_rows(t.part.select("p_partkey", "p_size", "p_retailprice"), order.sort_spec("+p_size -p_retailprice p_partkey"))
    return ranked.select("p_partkey", "position")


@query("T04_limit_and_offset", sql_page("o_orderkey", "orders", "o_totalprice DESC, o_orderkey", 25, 40))
def _(t):
    return _page(t.orders, lambda: [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], ["o_orderkey"], 25, 40)


@query("T04_default_hits", sql_page("o_orderkey", "orders", "o_totalprice DESC, o_orderkey"))
def _(t):
    return _page(t.orders, lambda: [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], ["o_orderkey"])


@query(
    "T06_paged_search",
    """SELECT o_orderkey, o_totalprice, p AS position, p // 100 AS page FROM (
         SELECT *, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS p FROM orders WHERE o_orderstatus <> 'P')""",
)
def _(t):
    found = t.orders.where("o_orderstatus <> 'P'").select("o_orderkey", "o_totalprice")
    return order.pages(found, [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], 100)


@query("T06_next_page", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey > 777 ORDER BY o_orderkey LIMIT 100")
def _(t):
    return order.page_after(t.orders, "o_orderkey", 777).select("o_orderkey", "o_totalprice")


@query(
    "T07_hit_stream",
    """SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS position FROM orders WHERE o_orderpriority = '1-URGENT'""",
)
def _(t):
    found = t.orders.where("o_orderpriority = '1-URGENT'").select("o_orderkey", "o_totalprice")
    return order.number_rows(found, [F.col("o_totalprice").asc(), F.col("o_orderkey").asc()]).drop("o_totalprice")


@query("T08_match_count", "SELECT count(*) AS total_count FROM orders WHERE o_totalprice > 150000")
def _(t):
    return order.match_count(t.orders.where("o_totalprice > 150000"))


def sql_collapse(size: int) -> str:
    return f"""SELECT p_partkey, p_brand FROM part QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) <= {size}"""


@query("T09_collapse", sql_collapse(1))
def _(t):
    by = [F.col("p_retailprice").desc(), F.col("p_partkey").asc()]
    return order.collapse(t.part, "p_brand", by).select("p_partkey", "p_brand")


@query("T09_collapse_size", sql_collapse(3))
def _(t):
    by = [F.col("p_retailprice").desc(), F.col("p_partkey").asc()]
    return order.collapse(t.part, "p_brand", by, 3).select("p_partkey", "p_brand")


# -- grouping ------------------------------------------------------------------------------------


@query("G01_group_by_field", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def _(t):
    return grouping.group_by(t.orders, {"o_orderpriority": "o_orderpriority"}, {"n": ag.count()})


@query("G01_group_matching_by_expression", "SELECT year(o_orderdate)::INTEGER AS y, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1")
def _(t):
    return grouping.group_by(t.orders, {"y": sc.time_year("o_orderdate")}, {"n": ag.count()}, where=F.col("o_orderstatus") == "F")


@query("G02_each_hit", "SELECT o_orderkey, round(o_totalprice * 2, 4) AS doubled, o_orderstatus || o_orderpriority AS label FROM orders")
def _(t):
    return grouping.each_hit(
        t.orders,
        {"o_orderkey": "o_orderkey", "doubled": F.round(sc.mul("o_totalprice", F.lit(2)), 4), "label": sc.cat("o_orderstatus", "o_orderpriority")},
    )


@query(
    "G03_fixed_width",
    """SELECT floor(o_totalprice / 50000) * 50000.0::DOUBLE AS bucket_from, floor(o_totalprice / 50000) * 50000.0::DOUBLE + 50000 AS bucket_to,
              count(*) AS n FROM orders GROUP BY 1, 2""",
)
def _(t):
    lo, hi = grouping.fixed_width_bucket("o_totalprice", 50000)
    return grouping.group_by(t.orders, {"bucket_from": lo, "bucket_to": hi}, {"n": ag.count()})


@query(
    "G03_fixed_width_negative",
    "SELECT floor(c_acctbal / 700) * 700.0::DOUBLE AS bucket_from, count(*) AS n FROM customer GROUP BY 1",
)
def _(t):
    return grouping.group_by(t.customer, {"bucket_from": sc.fixed_width("c_acctbal", 700)}, {"n": ag.count()})


@query(
    "G04_numeric_buckets",
    """SELECT CASE WHEN p_retailprice < 910 THEN '900.0:910.0' WHEN p_retailprice < 950 THEN '910.0:950.0' ELSE '950.0:990.0' END AS label,
              count(*) AS n, max(p_retailprice) AS top FROM part WHERE p_retailprice >= 900 AND p_retailprice < 990 GROUP BY 1""",
)
def _(t):
    b = grouping.bucket("p_retailprice", [(900.0, 910.0), (910.0, 950.0), (950.0, 990.0)])
    return grouping.group_by(t.part, {"label": b["label"]}, {"n": ag.count(), "top": ag.greatest("p_retailprice")})


@query(
    "G05_string_buckets",
    """SELECT CASE WHEN p_name < 'h' THEN 'a:h' WHEN p_name < 'o' THEN 'h:o' ELSE 'o:s' END AS label, count(*) AS n
       FROM part WHERE p_name >= 'a' AND p_name < 's' GROUP BY 1""",
)
def _(t):
    b = grouping.bucket("p_name", [("a", "h"), ("h", "o"), ("o", "s")])
    return grouping.group_by(t.part, {"label": b["label"]}, {"n": ag.count()})


@query("G06_max_groups", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 ORDER BY o_custkey LIMIT 10")
def _(t):
    return grouping.group_by(t.orders, {"o_custkey": "o_custkey"}, {"n": ag.count()}, max_groups=grouping.DEFAULT_MAX_GROUPS)


@query("G06_global_cap", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def _(t):
    groups = grouping.group_by(t.orders, {"o_orderpriority": "o_orderpriority"}, {"n": ag.count()})
    return grouping.check_group_cap(groups, 100)


@query("G07_order_groups", "SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1 ORDER BY sum(o_totalprice) DESC, o_custkey LIMIT 15")
def _(t):
    g = grouping.group_by(
        t.orders, {"o_custkey": "o_custkey"}, {"n": ag.count(), "total": ag.total("o_totalprice")},
        order=[F.col("total").desc()], max_groups=15,
    )
    return g.withColumn("total", F.round("total", 2))


@query(
    "G08_outputs_and_alias",
    """SELECT o_orderstatus, count(*) AS n, round(avg(o_totalprice), 4) AS mean, min(o_totalprice) AS lo, max(o_totalprice) AS hi,
              round(max(o_totalprice) - min(o_totalprice), 4) AS spread, round((max(o_totalprice) - min(o_totalprice)) * 2, 4) AS spread2
       FROM orders GROUP BY 1""",
)
def _(t):
    spread = ag.greatest("o_totalprice") - ag.least("o_totalprice")
    return grouping.group_by(
        t.orders, {"o_orderstatus": "o_orderstatus"},
        {
            "n": ag.count(), "mean": F.round(ag.mean("o_totalprice"), 4), "lo": ag.least("o_totalprice"), "hi": ag.greatest("o_totalprice"),
            "spread": F.round(spread, 4), "spread2": F.round(spread * 2, 4),
        },
    )


def nested(t: Tables) -> list[DataFrame]:
    """Years by count, in each the two best priorities by total, in each all statuses."""
    return grouping.nested_groups(
        t.orders,
        [
            grouping.Level("y", sc.time_year("o_orderdate"), {"n": ag.count()}, [F.col("n").desc()], 3),
            grouping.Level("priority", "o_orderpriority", {"n": ag.count(), "top": ag.greatest("o_totalprice")}, [F.col("top").desc()], 2),
            grouping.Level("status", "o_orderstatus", {"n": ag.count(), "lo": ag.least("o_totalprice")}),
        ],
    )


@query(
    "G09_nested_groups",
    """WITH o AS (SELECT year(o_orderdate)::INTEGER AS y, o_orderpriority AS priority, o_orderstatus AS status, o_totalprice AS v FROM orders),
       a AS (SELECT y, count(*) AS n FROM o GROUP BY 1 ORDER BY n DESC, y LIMIT 3),
       b AS (SELECT y, priority, count(*) AS n, max(v) AS top FROM o WHERE y IN (SELECT y FROM a) GROUP BY 1, 2
             QUALIFY row_number() OVER (PARTITION BY y ORDER BY max(v) DESC, priority) <= 2),
       c AS (SELECT y, priority, status, count(*) AS n, min(v) AS lo FROM o SEMI JOIN b USING (y, priority) GROUP BY 1, 2, 3)
       SELECT 1 AS level, y, NULL AS priority, NULL AS status, n, NULL::DOUBLE AS top, NULL::DOUBLE AS lo FROM a
       UNION ALL SELECT 2, y, priority, NULL, n, top, NULL FROM b
       UNION ALL SELECT 3, y, priority, status, n, NULL, lo FROM c""",
)
def _(t):
    return grouping.flat_levels(nested(t))


@query(
    "G09_nested_groups_same_outputs",
    """SELECT o_orderstatus, o_orderpriority, count(*) AS n, max(o_totalprice) AS top,
              CASE WHEN o_orderpriority IS NULL THEN 1 ELSE 2 END AS level
       FROM orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderstatus, o_orderpriority))""",
)
def _(t):
    return grouping.rollup_levels(
        t.orders, {"o_orderstatus": "o_orderstatus", "o_orderpriority": "o_orderpriority"},
        {"n": ag.count(), "top": ag.greatest("o_totalprice")},
    )


@query(
    "G10_hits_per_group",
    """SELECT p_type, p_partkey, p_name, (row_number() OVER (PARTITION BY p_type ORDER BY p_retailprice DESC, p_partkey))::INTEGER AS hit_rank
       FROM part QUALIFY hit_rank <= 4""",
)
def _(t):
    out = grouping.group_hits(
        t.part, ["p_type"], [F.col("p_retailprice").desc(), F.col("p_partkey").asc()], 4, ["p_partkey", "p_name", "p_retailprice"]
    )
    return out.select("p_type", "p_partkey", "p_name", "hit_rank")


@query(
    "G11_group_pages",
    """SELECT o_custkey, n, p AS position, p // 20 AS page FROM (
         SELECT o_custkey, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, o_custkey) - 1 AS p FROM orders GROUP BY 1)""",
)
def _(t):
    g = grouping.group_by(t.orders, {"o_custkey": "o_custkey"}, {"n": ag.count()})
    return grouping.group_pages(g, [F.col("n").desc(), F.col("o_custkey").asc()], 20)


@query("G11_group_page_after", "SELECT o_custkey, count(*) AS n FROM orders WHERE o_custkey > 40 GROUP BY 1 ORDER BY 1 LIMIT 20")
def _(t):
    g = grouping.group_by(t.orders, {"o_custkey": "o_custkey"}, {"n": ag.count()})
    return grouping.group_page_after(g, "o_custkey", 40, 20)


@query(
    "G12_hits_and_groups",
    """WITH m AS (SELECT * FROM orders WHERE o_totalprice > 100000)
       SELECT 'hit' AS kind, o_orderkey::VARCHAR AS name, NULL::BIGINT AS n FROM (SELECT * FROM m ORDER BY o_totalprice DESC, o_orderkey LIMIT 10)
       UNION ALL SELECT 'group', o_orderstatus, count(*) FROM m GROUP BY o_orderstatus
       UNION ALL SELECT 'total', NULL, count(*) FROM m""",
)
def _(t):
    r = grouping.groups_and_hits(
        t.orders.where("o_totalprice > 100000"), {"o_orderstatus": "o_orderstatus"}, {"n": ag.count()},
        [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], narrow=["o_orderkey", "o_orderstatus", "o_totalprice"],
    )
    none = F.lit(None).cast("bigint")
    return (
        r["hits"].select(F.lit("hit").alias("kind"), F.col("o_orderkey").cast("string").alias("name"), none.alias("n"))
        .unionByName(r["groups"].select(F.lit("group").alias("kind"), F.col("o_orderstatus").alias("name"), "n"))
        .unionByName(r["total"].select(F.lit("total").alias("kind"), F.lit(None).cast("string").alias("name"), F.col("total_count").alias("n")))
    )


@query(
    "G13_group_tree",
    """WITH o AS (SELECT o_orderstatus AS status, o_orderpriority AS priority FROM orders),
       c AS (SELECT status, priority, count(*) AS n FROM o GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY status ORDER BY n DESC, priority) <= 3)
       SELECT s.status AS value, 'status' AS label, s.n, string_agg(c.priority || '=' || c.n, ',' ORDER BY c.n DESC, c.priority) AS sub
       FROM (SELECT status, count(*) AS n FROM o GROUP BY 1) s JOIN c USING (status) GROUP BY ALL""",
)
def _(t):
    tree = grouping.group_tree(
        t.orders,
        [
            grouping.Level("status", "o_orderstatus", {"n": ag.count()}),
            grouping.Level("priority", "o_orderpriority", {"n": ag.count()}, [F.col("n").desc()], 3),
        ],
    )
    sub = F.transform("groups", lambda g: F.concat(g["value"], F.lit("="), g["aggregations"]["n"].cast("string")))
    return tree.select("value", "label", F.col("aggregations.n").alias("n"), F.array_join(sub, ",").alias("sub"))


@query(
    "G13_group_tree_hits",
    """WITH h AS (SELECT o_orderpriority AS p, o_orderkey AS k, o_totalprice AS v FROM orders
           QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) <= 3),
       s AS (SELECT o_orderpriority AS p, o_orderstatus AS st, o_orderkey AS k FROM orders
           QUALIFY row_number() OVER (PARTITION BY o_orderpriority, o_orderstatus ORDER BY o_orderkey) = 1)
       SELECT p AS value, n, (SELECT string_agg(k, ',' ORDER BY v DESC, k) FROM h WHERE h.p = g.p) AS hits,
           (SELECT string_agg(st || ':' || k, ',' ORDER BY st) FROM s WHERE s.p = g.p) AS sub
       FROM (SELECT o_orderpriority AS p, count(*) AS n FROM orders GROUP BY 1) g""",
)
def _(t):
    """Hits in the groups of both levels."""
    best = [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()]
    tree = grouping.group_tree(
        t.orders,
        [
            grouping.Level("p", "o_orderpriority", {"n": ag.count()}, hits=(best, 3, ["o_orderkey"])),
            grouping.Level("st", "o_orderstatus", {"n": ag.count()}, hits=([F.col("o_orderkey").asc()], 1, ["o_orderkey"])),
        ],
    )
    first = F.transform("groups", lambda g: F.concat_ws(":", g["value"], g["hits"][0]["o_orderkey"].cast("string")))
    return tree.select(
        "value", F.col("aggregations.n").alias("n"), F.array_join(F.transform("hits", lambda h: h["o_orderkey"].cast("string")), ",").alias("hits"),
        F.array_join(first, ",").alias("sub"),
    )


# -- aggregates ------------------------------------------------------------------------------------


def _aggregate(name: str, out: str, col, sql: str) -> None:
    @query(name, f"SELECT o_orderpriority, {sql} AS {out} FROM orders GROUP BY 1")
    def _(t):
        return grouping.group_by(t.orders, {"o_orderpriority": "o_orderpriority"}, {out: col()})


_aggregate("N01_count", "n", ag.count, "count(*)")
_aggregate("N02_sum", "total", lambda: F.round(ag.total("o_totalprice"), 2), "round(sum(o_totalprice), 2)")
_aggregate("N03_avg", "mean", lambda: F.round(ag.mean("o_totalprice"), 4), "round(avg(o_totalprice), 4)")
_aggregate("N04_min", "lo", lambda: ag.least("o_totalprice"), "min(o_totalprice)")
_aggregate("N05_max", "hi", lambda: ag.greatest("o_totalprice"), "max(o_totalprice)")
_aggregate("N06_stddev", "sd", lambda: F.round(ag.stddev("o_totalprice"), 4), "round(stddev_pop(o_totalprice), 4)")
_aggregate("N06_stddev_sample", "sd", lambda: F.round(ag.stddev("o_totalprice", sample=True), 4), "round(stddev_samp(o_totalprice), 4)")
_aggregate("N07_xor", "x", lambda: ag.xor("o_custkey"), "bit_xor(o_custkey)")

SQL_QUANTILES = """round(quantile_cont(o_totalprice, 0.25), 4) AS q0_25, round(quantile_cont(o_totalprice, 0.5), 4) AS q0_5,
     round(quantile_cont(o_totalprice, 0.95), 4) AS q0_95"""


@query("N08_quantiles", f"SELECT o_orderpriority, {SQL_QUANTILES} FROM orders GROUP BY 1")
def _(t):
    """Exact with no group held by one task."""
    q = grouping.group_quantiles(t.orders, ["o_orderpriority"], "o_totalprice", [0.25, 0.5, 0.95])
    return q.select("o_orderpriority", *[F.round(c, 4).alias(c) for c in q.columns[1:]])


@query("N08_quantiles_of_small_groups", f"SELECT o_custkey, {SQL_QUANTILES} FROM orders GROUP BY 1")
def _(t):
    g = grouping.group_by(t.orders, {"o_custkey": "o_custkey"}, {"q": ag.quantiles([0.25, 0.5, 0.95], "o_totalprice")})
    return g.select("o_custkey", *[F.round(F.col("q")[i], 4).alias(n) for i, n in enumerate(["q0_25", "q0_5", "q0_95"])])


# Four times the 99 % error: a sketch draws at random, and the twin has to hold at every run.
STATE_SIZE, STATE_SLACK = 400, 4


@query(
    "N08_quantile_states",
    """SELECT event_type, count(value) AS n, true AS q0_25, true AS q0_5, true AS q0_95 FROM events WHERE event_type IS NOT NULL GROUP BY 1
       UNION ALL SELECT 'all', count(value), true, true, true FROM events WHERE event_type IS NOT NULL""",
)
def _(t):
    """States per day and type, added up to types and to all: the rows at each quantile's rank are within the stated error."""
    qs, names = [0.25, 0.5, 0.95], ["q0_25", "q0_5", "q0_95"]
    events = t.events.where("event_type IS NOT NULL")
    daily = grouping.quantile_states(events.withColumn("day", F.to_date("ts")), ["event_type", "day"], "value", STATE_SIZE)
    types = grouping.merge_quantile_states(daily, ["event_type"])
    every = grouping.merge_quantile_states(types).withColumn("event_type", F.lit("all"))
    found = grouping.quantiles_of_states(types.unionByName(every), qs)
    rows = events.select(F.explode(F.array("event_type", F.lit("all"))).alias("event_type"), "value")
    error = F.lit(STATE_SLACK * ag.quantile_error(STATE_SIZE))
    at_rank = lambda q, c: (F.count_if(F.col("value") < F.col(c)) <= (q + error) * F.first("n")) & (
        F.count_if(F.col("value") <= F.col(c)) >= (q - error) * F.first("n")
    )
    checked = rows.join(found, "event_type").groupBy("event_type")
    return checked.agg(F.first("n").alias("n"), *[at_rank(q, c).alias(c) for q, c in zip(qs, names)])


@query(
    "N09_group_relevance",
    f"WITH {sql_bm25(['from', 'with'])} SELECT lang, round(avg(d.relevance), 4) AS relevance, count(*) AS n FROM d JOIN documents USING (doc_id) GROUP BY lang",
)
def _(t):
    scored = ranking.bm25(t.documents, "text", ["from", "with"], name="relevance")
    return grouping.group_by(scored, {"lang": "lang"}, {"relevance": F.round(ag.relevance(), 4), "n": ag.count()})


# -- scalar functions --------------------------------------------------------------------------------


def _function(name: str, table: str, key: str, col, sql: str) -> None:
    simple(
        name, lambda t: getattr(t, table).select(key, col().alias("v")),
        f"SELECT {key}, {sql} AS v FROM {table}",
    )


_function("F01_date", "events", "event_id", lambda: sc.time_date("ts"), "strftime(ts, '%Y%m%d')::INTEGER")
_function("F02_year", "orders", "o_orderkey", lambda: sc.time_year("o_orderdate"), "year(o_orderdate)::INTEGER")
_function("F03_month", "orders", "o_orderkey", lambda: sc.time_month_of_year("o_orderdate"), "month(o_orderdate)::INTEGER")
_function("F04_day", "orders", "o_orderkey", lambda: sc.time_day_of_month("o_orderdate"), "day(o_orderdate)::INTEGER")
_function("F05_hour", "events", "event_id", lambda: sc.time_hour_of_day("ts"), "hour(ts)::INTEGER")
_function("F06_minute", "events", "event_id", lambda: sc.time_minute_of_hour("ts"), "minute(ts)::INTEGER")
_function("F07_second", "events", "event_id", lambda: sc.time_second_of_minute("ts"), "second(ts)::INTEGER")
_function("F08_floor", "part", "p_partkey", lambda: sc.math_floor("p_retailprice"), "floor(p_retailprice)::BIGINT")
_function("F09_log", "part", "p_partkey", lambda: F.round(sc.math_log("p_retailprice"), 6), "round(ln(p_retailprice), 6)")
_function("F10_sqrt", "part", "p_partkey", lambda: F.round(sc.math_sqrt("p_retailprice"), 6), "round(sqrt(p_retailprice), 6)")
_function("F11_abs", "customer", "c_custkey", lambda: sc.math_abs("c_acctbal"), "abs(c_acctbal)")
_function("F12_pow", "part", "p_partkey", lambda: F.round(sc.math_pow("p_size", 2.5), 4), "round(pow(p_size, 2.5), 4)")
_function("F13_cat", "part", "p_partkey", lambda: sc.cat("p_brand", "p_size"), "p_brand || p_size")
_function("F14_md5", "part", "p_partkey", lambda: sc.md5_bits("p_name", 6, 30), "('0x' || right(md5(left(p_name, 6)), 8))::BIGINT & 1073741823")


@query("F15_uca", "SELECT p_type COLLATE sv AS t, count(*) AS n FROM part GROUP BY 1")
def _(t):
    g = grouping.group_by(t.part, {"k": sc.uca("p_type", "sv")}, {"n": ag.count(), "t": F.min(F.col("p_type"))})
    return g.select("t", "n")


@query(
    "F15_uca_primary",
    """SELECT min(w) AS first_form, count(*) AS n, strip_accents(replace(lower(w), 'ß', 'ss')) AS folded FROM (
         SELECT DISTINCT unnest(list_filter(string_split_regex(text, '[^\\p{L}\\p{N}]+'), lambda x: x <> '')) AS w FROM documents) GROUP BY folded""",
)
def _(t):
    """Primary strength groups words that differ in case, accents and sharp s only."""
    words = t.documents.select(F.explode(F.array_distinct(tx.tokens("text", tx.CASED))).alias("w")).distinct()
    folded = F.replace(tx.Analyzer(fold_accents=True).text("w"), F.lit("ß"), F.lit("ss"))
    g = words.groupBy(sc.uca("w", "fr", "PRIMARY").alias("k")).agg(
        F.min("w").alias("first_form"), F.count(F.lit(1)).alias("n"), F.min(folded).alias("folded")
    )
    return g.select("first_form", "n", "folded")


def _bits(v: str) -> str:
    return " | ".join(f"((({v} >> {i}) & 1) << {2 * i})" for i in range(12))


@query(
    "F16_zcurve",
    f"""SELECT c_custkey, (({_bits('x')}) | (({_bits('y')}) << 1))::BIGINT AS z, x AS back_x, y AS back_y
        FROM (SELECT c_custkey, (c_custkey * 7) % 3600 AS x, (c_custkey % 180) * 10 AS y FROM customer)""",
)
def _(t):
    p = t.customer.select("c_custkey", ((F.col("c_custkey") * 7) % 3600).alias("x"), (F.col("c_custkey") % 180 * 10).alias("y"))
    p = p.select("c_custkey", sc.zcurve("x", "y").alias("z"))
    return p.select("c_custkey", "z", sc.zcurve_x("z").alias("back_x"), sc.zcurve_y("z").alias("back_y"))


@query(
    "F17_doc_id_specific",
    f"""SELECT p_partkey, CASE WHEN f THEN regexp_extract(doc_id, '^id:[^:]*:[^:]*:[^:]*:(.*)$', 1) ELSE doc_id END AS v
        FROM (SELECT p_partkey, {BUILT_ID} AS doc_id, p_size <= 40 AS f FROM part)""",
)
def _(t):
    return built_ids(t).select("p_partkey", sc.doc_id_specific("doc_id").alias("v"))


_function("F18_add", "orders", "o_orderkey", lambda: F.round(sc.add("o_totalprice", "o_custkey"), 4), "round(o_totalprice + o_custkey, 4)")
_function("F19_mul", "orders", "o_orderkey", lambda: F.round(sc.mul("o_totalprice", "o_custkey"), 2), "round(o_totalprice * o_custkey, 2)")
_function("F20_div", "orders", "o_orderkey", lambda: sc.div("o_totalprice", "o_custkey"), "CASE WHEN o_custkey <> 0 THEN o_totalprice / o_custkey END")
_function("F21_mod", "orders", "o_orderkey", lambda: sc.mod("o_orderkey", "o_custkey"), "CASE WHEN o_custkey <> 0 THEN o_orderkey % o_custkey END")
_function("F22_neg", "orders", "o_orderkey", lambda: sc.neg("o_totalprice"), "-o_totalprice")
_function("F23_cmp", "customer", "c_custkey", lambda: sc.cmp(F.length("c_mktsegment"), "c_nationkey"), "sign(length(c_mktsegment) - c_nationkey)::INTEGER")
