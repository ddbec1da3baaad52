"""Queries on vectors, scores and ranking phases."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.functions import text as tx, vectors as vx
from lodestone.operators import neighbours, order, ranking
from lodestone.plans.registry import TOK, Tables, query, sql_tokens
from lodestone.plans.texts import SQL_PLACES, SQL_STEM, places
from lodestone.session import scratch_path

DIMS = 64
# A query vector by rule, of unit length, and the same in SQL.
QUERY = [math.sin(i + 1) for i in range(DIMS)]
_LENGTH = math.sqrt(sum(x * x for x in QUERY))
QUERY = [x / _LENGTH for x in QUERY]
SQL_QUERY = "[" + ", ".join(repr(x) for x in QUERY) + "]::DOUBLE[]"
E64 = "embedding::DOUBLE[]"
SQL_DISTANCE = {
    "euclidean": "list_distance({a}, {b})",
    "angular": "1 - list_cosine_similarity({a}, {b})",
    "prenormalized": "1 - list_inner_product({a}, {b})",
    "dotproduct": "list_inner_product({a}, {b})",
}


def sql_distance(metric: str, a: str = E64, b: str = SQL_QUERY) -> str:
    return SQL_DISTANCE[metric].format(a=a, b=b)


def _distance(name: str, metric: str) -> None:
    @query(name, f"SELECT vec_id, round({sql_distance(metric)}, 6) AS distance FROM embeddings")
    def _(t):
        return t.embeddings.select("vec_id", F.round(vx.METRICS[metric]("embedding", QUERY), 6).alias("distance"))


_distance("V01_euclidean", "euclidean")
_distance("V02_angular", "angular")
_distance("V03_prenormalized_angular", "prenormalized")
_distance("V04_dot_product", "dotproduct")

SQL_HAMMING = " + ".join(f"(CASE WHEN (embedding[{i + 1}] > 0) <> {str(x > 0).lower()} THEN 1 ELSE 0 END)" for i, x in enumerate(QUERY))


@query("V05_hamming", f"SELECT vec_id, {SQL_HAMMING} AS bits FROM embeddings")
def _(t):
    return t.embeddings.select("vec_id", vx.hamming(vx.sign_bits("embedding", DIMS), vx.pack_signs(QUERY)).alias("bits"))


@query(
    "V06_geodesic",
    f"""SELECT c_custkey, round(2 * 6371.0 * asin(sqrt(least(1.0, pow(sin((radians(40.7) - radians(lat)) / 2), 2)
        + cos(radians(lat)) * cos(radians(40.7)) * pow(sin((radians(-74.0) - radians(lng)) / 2), 2)))), 6) AS km FROM ({SQL_PLACES})""",
)
def _(t):
    return places(t).select("c_custkey", F.round(vx.geodesic("lat", "lng", 40.7, -74.0), 6).alias("km"))


def sql_nearest(k: int, where: str = "true", metric: str = "euclidean", name: str = "distance", extra: str = "true") -> str:
    way = "DESC" if metric == "dotproduct" else "ASC"
    return f"""SELECT vec_id, round(d, 6) AS {name} FROM (SELECT *, {sql_distance(metric)} AS d FROM embeddings)
               WHERE {where} AND {extra} ORDER BY d {way}, vec_id LIMIT {k}"""


def _rounded(df: DataFrame, name: str = "distance") -> DataFrame:
    return df.select("vec_id", F.round(name, 6).alias(name))


@query("V07_exact_neighbours", sql_nearest(10))
def _(t):
    return _rounded(neighbours.nearest(t.embeddings, "vec_id", "embedding", QUERY, 10))


@query("V07_filtered_neighbours", sql_nearest(20, "label IN (2, 3, 5)"))
def _(t):
    return _rounded(neighbours.nearest(t.embeddings, "vec_id", "embedding", QUERY, 20, where=F.col("label").isin(2, 3, 5)))


@query("V07_neighbours_dot_product", sql_nearest(15, metric="dotproduct"))
def _(t):
    return _rounded(neighbours.nearest(t.embeddings, "vec_id", "embedding", QUERY, 15, "dotproduct"))


@query("V08_neighbours_threshold", sql_nearest(100, name="near_query", extra="d <= 1.3"))
def _(t):
    out = neighbours.nearest(t.embeddings, "vec_id", "embedding", QUERY, 100, threshold=1.3, label="near_query")
    return _rounded(out, "near_query")


# The random planes of the stored buckets, drawn by their seed.
PLANES = neighbours.hyperplanes(DIMS, bits=4, tables=6)
FLIPS = 2


def sql_probed() -> str:
    """Rows whose code is among the probed ones of a table; the codes are bits of inner products with the same planes."""
    any_table = []
    for planes, codes in zip(PLANES.tolist(), neighbours.probes(QUERY, PLANES, FLIPS)):
        bits = [f"(CASE WHEN list_inner_product({E64}, {p!r}::DOUBLE[]) > 0 THEN {1 << i} ELSE 0 END)" for i, p in enumerate(planes)]
        any_table.append(f"{' + '.join(bits)} IN ({', '.join(map(str, codes))})")
    return " OR ".join(any_table)


@query("V09_approximate_neighbours", sql_nearest(10, f"({sql_probed()})"))
def _(t):
    """Stored buckets: codes are computed by the write, and the search reads the probed folders."""
    path = scratch_path(t.spark, "buckets")
    neighbours.write_buckets(t.embeddings, "embedding", PLANES, path)
    return _rounded(neighbours.nearest_in_buckets(t.spark.read.parquet(path), "vec_id", "embedding", QUERY, PLANES, 10, flips=FLIPS))


def sql_all_nearest(distance: str, table: str = "embeddings", key: str = "vec_id", way: str = "", digits: int = 6) -> str:
    return f"""SELECT query_id, neighbour_id, round(d, {digits}) AS distance, rn::INTEGER AS hit_rank FROM (
    SELECT q.{key} AS query_id, b.{key} AS neighbour_id, d, row_number() OVER (PARTITION BY q.{key} ORDER BY d {way}, b.{key}) AS rn
    FROM {table} q, {table} b, LATERAL (SELECT {distance} AS d)) WHERE rn <= 5"""


def _all_nearest(df: DataFrame, key: str = "vec_id", vector: str = "embedding", digits: int = 6, **options) -> DataFrame:
    out = neighbours.nearest_join(df, key, vector, df, key, vector, 5, **options)
    return out.withColumn("distance", F.round("distance", digits))


SQL_ALL_NEAREST = sql_all_nearest(f"list_distance(q.{E64}, b.{E64})")


@query("V10_neighbour_join", SQL_ALL_NEAREST)
def _(t):
    return _all_nearest(t.embeddings)


@query("V10_neighbour_join_blocks", SQL_ALL_NEAREST)
def _(t):
    """The path for a query side too large to ship."""
    return _all_nearest(t.embeddings, broadcast_rows=0, cell_rows=500)


def _all_by_metric(metric: str) -> None:
    way = "DESC" if metric == "dotproduct" else ""

    @query(f"V10_neighbour_join_{metric}", sql_all_nearest(sql_distance(metric, f"q.{E64}", f"b.{E64}"), way=way))
    def _(t):
        return _all_nearest(t.embeddings, metric=metric, broadcast_rows=0, cell_rows=500)


for _metric in ("angular", "prenormalized", "dotproduct"):
    _all_by_metric(_metric)


@query("V10_neighbour_join_hamming", sql_all_nearest("list_sum(list_transform(list_zip(q.embedding, b.embedding), lambda x: (x[1] > 0) <> (x[2] > 0)))::DOUBLE"))
def _(t):
    signs = t.embeddings.select("vec_id", vx.sign_bits("embedding", DIMS).alias("signs"))
    return _all_nearest(signs, vector="signs", metric="hamming", broadcast_rows=0, cell_rows=500)


SQL_KM = """2 * 6371.0 * asin(sqrt(least(1.0, pow(sin((radians(b.lat) - radians(q.lat)) / 2), 2)
    + cos(radians(q.lat)) * cos(radians(b.lat)) * pow(sin((radians(b.lng) - radians(q.lng)) / 2), 2))))"""


@query("V10_neighbour_join_geodesic", sql_all_nearest(SQL_KM, f"(SELECT * FROM ({SQL_PLACES}) WHERE abs(lat) < 80 AND c_custkey <= 720)", "c_custkey", digits=3))
def _(t):
    """One customer at each place: the rule for places repeats after 360 keys."""
    near = places(t).where((F.abs("lat") < 80) & (F.col("c_custkey") <= 720)).select("c_custkey", F.array("lat", "lng").alias("place"))
    return _all_nearest(near, "c_custkey", "place", 3, metric="geodesic", broadcast_rows=0, cell_rows=500)


# -- BM25 --------------------------------------------------------------------------------------------


def sql_bm25(terms: list[str], tok: str = TOK, table: str = "documents", id: str = "doc_id") -> str:
    """``d`` (id, relevance) of every row that holds a term; a term may be ``a|b`` for synonyms."""
    tf = lambda t: "len(list_filter(w, lambda x: x IN (" + ", ".join(f"'{s}'" for s in t.split("|")) + ")))"
    cols = ", ".join(f"{tf(t)} AS tf{i}" for i, t in enumerate(terms))
    dfs = ", ".join(f"count(*) FILTER (tf{i} > 0) AS df{i}" for i, _ in enumerate(terms))
    score = " + ".join(
        f"ln(1 + (n - df{i} + 0.5) / (df{i} + 0.5)) * tf{i} * 2.2 / (tf{i} + 1.2 * (0.25 + 0.75 * l / al))" for i, _ in enumerate(terms)
    )
    any_hit = " OR ".join(f"tf{i} > 0" for i, _ in enumerate(terms))
    return f"""t AS (SELECT {id}, len(w) AS l, {cols} FROM (SELECT *, {tok} AS w FROM {table})),
               s AS (SELECT count(*) AS n, avg(l) AS al, {dfs} FROM t),
               d AS (SELECT {id}, {score} AS relevance FROM t, s WHERE {any_hit})"""


RARE = ["hehely", "rewh", "thatin"]


@query("R01_bm25", f"WITH {sql_bm25(RARE)} SELECT doc_id, round(relevance, 4) AS bm25 FROM d")
def _(t):
    return ranking.bm25_scores(t.documents, "doc_id", "text", RARE).withColumn("bm25", F.round("bm25", 4))


@query("R01_bm25_synonyms", f"WITH {sql_bm25(['que|und', 'from'])} SELECT doc_id, round(relevance, 4) AS bm25 FROM d")
def _(t):
    return ranking.bm25_scores(t.documents, "doc_id", "text", [["que", "und"], "from"]).withColumn("bm25", F.round("bm25", 4))


def sql_top(k: int, where: str = "true") -> str:
    return f"SELECT doc_id, round(relevance, 4) AS relevance FROM d WHERE {where} ORDER BY d.relevance DESC, doc_id LIMIT {k}"


def _scored(df: DataFrame) -> DataFrame:
    return df.select("doc_id", F.round("relevance", 4).alias("relevance"))


@query("P31_weak_and", f"WITH {sql_bm25(['this', 'from', 'rewh'])} {sql_top(100)}")
def _(t):
    return _scored(ranking.weak_and(t.documents, "doc_id", "text", ["this", "from", "rewh"]))


@query(
    "P31_weak_and_as_and",
    f"""WITH {sql_bm25(['this', 'from', 'that'])} {sql_top(50, "doc_id IN (SELECT doc_id FROM t WHERE tf0 > 0 AND tf1 > 0 AND tf2 > 0)")}""",
)
def _(t):
    return _scored(ranking.weak_and(t.documents, "doc_id", "text", ["this", "from", "that"], 50, replace_by_and=True))


@query(
    "R15_filter_term",
    f"""WITH {sql_bm25(['from', 'with'])} SELECT doc_id, round(relevance, 4) AS bm25 FROM d
        WHERE doc_id IN (SELECT doc_id FROM documents WHERE list_contains({TOK}, 'this'))""",
)
def _(t):
    out = ranking.bm25(t.documents, "text", ["from", "with"], filter_terms=["this"])
    return out.select("doc_id", F.round("bm25", 4).alias("bm25"))


@query(
    "T05_rank_order",
    f"WITH {sql_bm25(['from', 'with'])} SELECT doc_id, round(relevance, 4) AS relevance, (row_number() OVER (ORDER BY d.relevance DESC, doc_id))::INTEGER AS hit_rank FROM d QUALIFY hit_rank <= 20",
)
def _(t):
    scored = ranking.bm25(t.documents, "text", ["from", "with"], name="relevance")
    by = order.by_relevance(scored, "doc_id")
    page = order.with_position(order.hits(scored, by, 20), by)
    return page.select("doc_id", F.round("relevance", 4).alias("relevance"), "hit_rank")


# -- vectors and text ----------------------------------------------------------------------------------


@query(
    "V11_hybrid",
    f"""WITH {sql_bm25(['this', 'from'])},
        h AS (SELECT doc_id, 1 / (1 + dist) AS c FROM (SELECT doc_id, {sql_distance('euclidean')} AS dist
              FROM documents JOIN embeddings ON doc_id = vec_id WHERE lang = 'en') ORDER BY dist, doc_id LIMIT 100)
        SELECT doc_id, round(c + 0.5 * coalesce(d.relevance, 0), 4) AS relevance FROM h LEFT JOIN d USING (doc_id)""",
)
def _(t):
    docs = t.documents
    vectors = t.embeddings.withColumnRenamed("vec_id", "doc_id")
    stats = ranking.corpus_stats(docs, "text", ["this", "from"])
    out = neighbours.hybrid(
        docs, "doc_id", "text", "embedding", QUERY, ["this", "from"], 100, 0.5, where=F.col("lang") == "en", stats=stats, vectors=vectors
    )
    return _scored(out)


@query("V12_constant_tensor", f"SELECT vec_id, round(list_inner_product({E64}, {SQL_QUERY}) * 10 + label, 4) AS score FROM embeddings")
def _(t):
    weights = vx.literal_vector(QUERY)
    return t.embeddings.select("vec_id", F.round(vx.dot("embedding", weights) * 10 + F.col("label"), 4).alias("score"))


@query("V13_cells_long_form", f"SELECT vec_id, (i - 1)::INTEGER AS cell, round(embedding[i]::DOUBLE, 6) AS value FROM embeddings, LATERAL (SELECT unnest(range(1, 65)) AS i)")
def _(t):
    return t.embeddings.select("vec_id", F.posexplode("embedding").alias("cell", "value")).select(
        "vec_id", "cell", F.round(F.col("value").cast("double"), 6).alias("value")
    )


@query(
    "V13_cells_round_trip",
    "SELECT vec_id, true AS dense_back, true AS blocks_back, 64 AS n_cells, 4 AS n_blocks, round(embedding[18]::DOUBLE, 6) AS cell_17 FROM embeddings",
)
def _(t):
    e = F.col("embedding").cast("array<double>")
    df = t.embeddings.select("vec_id", e.alias("e"), vx.mapped_from_dense("embedding").alias("m"), vx.blocks_from_dense("embedding", 16).alias("b"))
    by_index = F.map_from_entries(F.transform(F.map_entries("m"), lambda x: F.struct(x["key"].cast("int"), x["value"])))
    return df.select(
        "vec_id",
        (vx.dense_from_cells(by_index, DIMS) == F.col("e")).alias("dense_back"),
        (vx.dense_from_blocks("b") == F.col("e")).alias("blocks_back"),
        F.size("m").alias("n_cells"), F.size("b").alias("n_blocks"),
        F.round(F.element_at("m", "17"), 6).alias("cell_17"),
    )


@query(
    "V14_shape_check",
    """SELECT vec_id, true AS float_ok, label < 3 AS short_ok,
              list_bool_and(list_transform(embedding, lambda v: CASE WHEN label >= 5 THEN floor(v * 400) ELSE v * 400 END BETWEEN -128 AND 127 AND (label >= 5 OR floor(v * 400) = v * 400))) AS int8_ok
       FROM embeddings""",
)
def _(t):
    e = F.col("embedding")
    scaled = F.transform(e, lambda v: v * F.lit(400.0).cast("float"))
    # labels from 5 on are made whole, the others stay fractional and fail
    cells = F.when(F.col("label") >= 5, F.transform(scaled, lambda v: F.floor(v)).cast("array<double>")).otherwise(scaled.cast("array<double>"))
    cut = F.when(F.col("label") < 3, F.slice(e, 1, 16)).otherwise(e)
    return t.embeddings.select(
        "vec_id", vx.shape_ok(e, "tensor<float>(x[64])").alias("float_ok"),
        vx.shape_ok(cut, "tensor<float>(x[4],y[4])").alias("short_ok"),
        vx.shape_ok(cells, "tensor<int8>(x[64])").alias("int8_ok"),
    )


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(
    "V15_feature_vector",
    """SELECT o_orderkey, (split_part(o_orderpriority, '-', 1)::INTEGER - 1)::INTEGER AS hot, 1.0::DOUBLE AS hot_sum,
              least(a / 500, 1.0) AS clipped, round(log10(a + 1) / 3, 6) AS logged,
              CASE WHEN a < 50 THEN 0.2 WHEN a < 150 THEN 0.5 ELSE 0.8 END::DOUBLE AS level
       FROM (SELECT *, o_totalprice / 1000 AS a FROM orders)""",
)
def _(t):
    v = vx.amount_category_vector(F.col("o_totalprice") / 1000, "o_orderpriority", PRIORITIES)
    df = t.orders.select("o_orderkey", v.alias("v"))
    hot = F.slice("v", 1, 5)
    return df.select(
        "o_orderkey", (F.array_position(hot, 1.0) - 1).cast("int").alias("hot"),
        F.aggregate(hot, F.lit(0.0), lambda a, x: a + x).alias("hot_sum"),
        F.col("v")[5].alias("clipped"), F.round(F.col("v")[6], 6).alias("logged"), F.col("v")[7].alias("level"),
    )


# -- ranking phases ---------------------------------------------------------------------------------------


@query("R02_closeness", f"SELECT vec_id, round(1 / (1 + {sql_distance('euclidean')}), 6) AS closeness FROM embeddings")
def _(t):
    return t.embeddings.select("vec_id", F.round(vx.closeness(vx.euclidean("embedding", QUERY)), 6).alias("closeness"))


@query("R03_freshness", "SELECT event_id, (epoch(TIMESTAMP '2024-02-01') - floor(epoch(ts)))::BIGINT AS age FROM events")
def _(t):
    return t.events.select("event_id", ranking.freshness("ts", "2024-02-01 00:00:00").alias("age"))


SQL_FIRST = "p_retailprice / 10 + p_size"


def first(df: DataFrame, **options) -> DataFrame:
    return ranking.first_phase(df, F.col("p_retailprice") / 10 + F.col("p_size"), **options)


def _part_scores(df: DataFrame, *more: str) -> DataFrame:
    return df.select("p_partkey", F.round("relevance", 4).alias("relevance"), *more)


@query("R04_first_phase", f"SELECT p_partkey, round({SQL_FIRST}, 4) AS relevance FROM part")
def _(t):
    return _part_scores(first(t.part))


SQL_TWO_PHASES = f"""WITH f AS (SELECT *, {SQL_FIRST} AS s1 FROM part),
   r AS (SELECT *, row_number() OVER (ORDER BY s1 DESC, p_partkey) AS rn FROM f),
   p2 AS (SELECT *, CASE WHEN rn <= 50 THEN s1 * 2 - p_size * 3 ELSE s1 END AS s2, CASE WHEN rn <= 50 THEN 2 ELSE 1 END AS ph FROM r)"""


def second(t: Tables) -> DataFrame:
    return ranking.rerank(first(t.part), "p_partkey", F.col("relevance") * 2 - F.col("p_size") * 3, 50)


@query("R05_second_phase", f"{SQL_TWO_PHASES} SELECT p_partkey, round(s2, 4) AS relevance, ph AS phase FROM p2")
def _(t):
    return _part_scores(second(t), "phase")


@query(
    "R06_global_phase",
    f"""{SQL_TWO_PHASES}, g AS (SELECT *, row_number() OVER (ORDER BY ph DESC, s2 DESC, p_partkey) AS gn FROM p2)
        SELECT p_partkey, round(CASE WHEN gn <= 10 THEN -p_size ELSE s2 END, 4) AS relevance, CASE WHEN gn <= 10 THEN 3 ELSE ph END AS phase FROM g""",
)
def _(t):
    steps = [(F.col("relevance") * 2 - F.col("p_size") * 3, 50), (-F.col("p_size"), 10)]
    return _part_scores(ranking.phases(first(t.part), "p_partkey", steps), "phase")


@query(
    "R06_global_phase_of_kept_ranks",
    f"""WITH f AS (SELECT *, {SQL_FIRST} AS s1, row_number() OVER (ORDER BY {SQL_FIRST} DESC, p_partkey) AS rn FROM part),
        k AS (SELECT *, CASE WHEN rn <= 30 THEN s1 END AS s, CASE WHEN rn <= 20 THEN 2 ELSE 1 END AS ph2 FROM f),
        p2 AS (SELECT *, CASE WHEN ph2 = 2 THEN s1 - p_size * 3 ELSE s END AS s2 FROM k),
        g AS (SELECT *, row_number() OVER (ORDER BY ph2 DESC, s2 DESC NULLS LAST, p_partkey) AS gn FROM p2)
        SELECT p_partkey, round(CASE WHEN gn <= 40 THEN 1000 - p_size ELSE s2 END, 4) AS relevance, CASE WHEN gn <= 40 THEN 3 ELSE ph2 END AS phase FROM g""",
)
def _(t):
    """The last phase reaches beyond the rows that keep a score."""
    p = ranking.RankProfile(
        "kept", first=lambda q: F.col("p_retailprice") / 10 + F.col("p_size"), keep_count=30,
        second=lambda q: F.col("relevance") - F.col("p_size") * 3, second_count=20, global_=lambda q: 1000 - F.col("p_size"), global_count=40,
    )
    return _part_scores(ranking.rank(t.part, "p_partkey", p), "phase")


@query("R07_drop_limit", f"SELECT p_partkey, round({SQL_FIRST}, 4) AS relevance FROM part WHERE {SQL_FIRST} >= 120")
def _(t):
    return _part_scores(first(t.part, drop_below=120.0))


@query(
    "R08_keep_rank_count",
    f"SELECT p_partkey, CASE WHEN row_number() OVER (ORDER BY {SQL_FIRST} DESC, p_partkey) <= 40 THEN round({SQL_FIRST}, 4) END AS relevance FROM part",
)
def _(t):
    return _part_scores(ranking.keep_rank(first(t.part), "p_partkey", 40))


@query("R09_match_phase", f"SELECT p_partkey, round({SQL_FIRST}, 4) AS relevance FROM (SELECT * FROM part ORDER BY p_size DESC, p_partkey LIMIT 60)")
def _(t):
    return _part_scores(first(ranking.match_phase(t.part, "p_partkey", "p_size", 60)))


@query(
    "R10_match_phase_diversity",
    """SELECT p_partkey, p_brand FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_partkey) AS rn FROM part)
       WHERE rn <= 3 ORDER BY p_size DESC, p_partkey LIMIT 60""",
)
def _(t):
    return ranking.match_phase_diverse(t.part, "p_partkey", "p_size", 60, "p_brand", 20).select("p_partkey", "p_brand")


@query("R11_query_inputs", "SELECT p_partkey, round(0.25 * p_size + 3 * p_retailprice / 900, 4) AS relevance FROM part")
def _(t):
    p = ranking.RankProfile("weighted", first=lambda q: q["w_size"] * F.col("p_size") + q["w_price"] * F.col("p_retailprice") / 900,
                            inputs={"w_size": 1.0, "w_price": 3.0})
    return _part_scores(ranking.rank(t.part, "p_partkey", p, {"w_size": 0.25}))


def base_profile() -> ranking.RankProfile:
    return ranking.RankProfile(
        "base",
        first=lambda q: q["scaled"](F.col("p_size"), 2),
        functions={"scaled": lambda q, c, by: c * by + q["offset"], "price": lambda q: F.col("p_retailprice") / 100},
        inputs={"offset": 1.0},
    )


@query("R12_rank_functions_and_inheritance", "SELECT p_partkey, round((p_size * 2 + 5) * (p_retailprice / 100), 4) AS relevance FROM part")
def _(t):
    child = ranking.RankProfile("child", first=lambda q: q["scaled"](F.col("p_size"), 2) * q["price"](), inputs={"offset": 5.0}, inherits=base_profile())
    return _part_scores(ranking.rank(t.part, "p_partkey", child))


@query(
    "R13_match_features",
    f"""WITH {sql_bm25(['from', 'with'])} SELECT doc_id, round(d.relevance, 4) AS f_bm25, n_chars::DOUBLE AS f_length, 2 AS n_features
        FROM d JOIN documents USING (doc_id)""",
)
def _(t):
    scored = ranking.bm25(t.documents, "text", ["from", "with"])
    m = ranking.match_features(bm25=F.col("bm25"), length=F.col("n_chars"))
    return scored.select("doc_id", m.alias("m")).select(
        "doc_id", F.round(F.element_at("m", "bm25"), 4).alias("f_bm25"), F.element_at("m", "length").alias("f_length"),
        F.size("m").alias("n_features"),
    )


@query(
    "R14_highlight",
    r"""SELECT doc_id, replace(replace(regexp_replace(
          regexp_replace(text, '([\p{L}\p{N}]+)', chr(1) || '\1' || chr(2), 'g'),
          chr(1) || '((?i:the|und|qué|hehely))' || chr(2), '<b>\1</b>', 'g'), chr(1), ''), chr(2), '') AS bold FROM documents""",
)
def _(t):
    return t.documents.select("doc_id", tx.highlight("text", ["the", "und", "qué", "hehely"]).alias("bold"))
