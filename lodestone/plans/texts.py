"""Queries on text analysis and predicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.functions import predicates as pr, text as tx
from lodestone.operators import fuzzy, matching
from lodestone.plans.registry import TOK, Tables, query, sql_tokens

# -- analysis ------------------------------------------------------------------------------------


@query(
    "A01_tokenise",
    f"SELECT doc_id, array_to_string(w, ' ') AS tokens, len(w) AS n_tokens, len(list_distinct(w)) AS n_distinct FROM (SELECT doc_id, {TOK} AS w FROM documents)",
)
def _(t):
    df = t.documents.select("doc_id", tx.tokens("text").alias("w"))
    return df.select(
        "doc_id", F.array_join("w", " ").alias("tokens"), F.size("w").cast("bigint").alias("n_tokens"),
        F.size(F.array_distinct("w")).cast("bigint").alias("n_distinct"),
    )


@query("A02_keep_case", f"SELECT doc_id, array_to_string({sql_tokens('text')}, ' ') AS tokens FROM documents")
def _(t):
    return t.documents.select("doc_id", F.array_join(tx.tokens("text", tx.CASED), " ").alias("tokens"))


@query("A03_drop_accents", f"SELECT doc_id, array_to_string({sql_tokens('strip_accents(lower(text))')}, ' ') AS tokens FROM documents")
def _(t):
    an = tx.Analyzer(fold_accents=True)
    return t.documents.select("doc_id", F.array_join(tx.tokens("text", an), " ").alias("tokens"))


SQL_STEM = """CASE WHEN length(x) >= 5 AND x LIKE '%ies' AND substr(x, -4, 1) NOT IN ('e', 'a') THEN left(x, length(x) - 3) || 'y'
     WHEN length(x) >= 4 AND x LIKE '%es' AND substr(x, -3, 1) NOT IN ('a', 'e', 'o') THEN left(x, length(x) - 2) || 'e'
     WHEN length(x) >= 3 AND x LIKE '%s' AND substr(x, -2, 1) NOT IN ('u', 's') THEN left(x, length(x) - 1)
     ELSE x END"""


@query(
    "A04_stem_plurals",
    f"""SELECT doc_id, array_to_string(CASE WHEN lang = 'en' THEN list_transform({TOK}, lambda x: {SQL_STEM}) ELSE {TOK} END, ' ') AS tokens
        FROM documents""",
)
def _(t):
    an = tx.Analyzer(stem=True, stem_when=F.col("lang") == "en")
    return t.documents.select("doc_id", F.array_join(tx.tokens("text", an), " ").alias("tokens"))


@query(
    "A05_grams",
    "SELECT p_partkey, array_to_string(list_transform(range(1, length(p_name) - 1), lambda i: substr(lower(p_name), i, 3)), ',') AS grams FROM part",
)
def _(t):
    return t.part.select("p_partkey", F.array_join(tx.grams("p_name", 3), ",").alias("grams"))


@query(
    "A06_token_positions",
    f"""SELECT token, count(*) AS n, count(DISTINCT doc_id) AS docs, min(pos) AS first_pos, max(pos) AS last_pos,
               sum(pos)::BIGINT AS sum_pos
        FROM (SELECT doc_id, w[i + 1] AS token, i AS pos FROM (SELECT doc_id, {TOK} AS w FROM documents), LATERAL (SELECT unnest(range(len(w))) AS i))
        GROUP BY token""",
)
def _(t):
    """Postings of the whole corpus, summed up per token; counted per document before the shuffle on tokens."""
    pos = t.documents.select("doc_id", F.posexplode(tx.tokens("text")).alias("pos", "token"))
    pos = pos.withColumn("pos", F.col("pos").cast("bigint"))
    per_doc = pos.groupBy("token", "doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("pos").alias("lo"), F.max("pos").alias("hi"), F.sum("pos").alias("s")
    )
    return per_doc.groupBy("token").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("docs"), F.min("lo").alias("first_pos"), F.max("hi").alias("last_pos"),
        F.sum("s").alias("sum_pos"),
    )


# -- predicates on scalars -----------------------------------------------------------------------


def _where(name: str, table: str, columns: str, cond, sql: str) -> None:
    """Rows of one table under a predicate, as the given columns."""

    @query(name, f"SELECT {columns} FROM {table} WHERE {sql}")
    def _(t, table=table, columns=columns, cond=cond):
        return getattr(t, table).where(cond()).select(*[c.strip() for c in columns.split(",")])


PART = "p_partkey, p_name, p_size, p_retailprice"
ORD = "o_orderkey, o_totalprice"
DOC = "doc_id, lang"

_where(
    "P01_compare", "orders", ORD,
    lambda: pr.all_of(
        pr.compare("o_totalprice", ">", 100000), pr.compare("o_totalprice", "<=", 250000.5),
        pr.compare("o_custkey", ">=", 10), pr.compare("o_orderkey", "<", 100000),
    ),
    "o_totalprice > 100000 AND o_totalprice <= 250000.5 AND o_custkey >= 10 AND o_orderkey < 100000",
)
_where("P01_equal_number", "part", PART, lambda: pr.compare("p_size", "=", 17), "p_size = 17")


def _has(*words: str, tok: str = TOK) -> str:
    return " AND ".join(f"list_contains({tok}, '{w}')" for w in words)


_where("P02_contains_token", "documents", DOC, lambda: tx.contains("text", "This"), _has("this"))
_where("P02_contains_token_name", "part", PART, lambda: tx.contains("p_name", "Widget"), "list_contains(string_split(p_name, ' '), 'widget')")
_where("P03_equals_value", "orders", ORD, lambda: tx.equals_value("o_orderpriority", "2-high"), "lower(o_orderpriority) = '2-high'")
_where("P04_exact", "part", PART, lambda: tx.exact("p_brand", "Brand#12"), "p_brand = 'Brand#12'")
_where("P05_word", "part", PART, lambda: tx.word("p_name", "gear"), "list_contains(string_split(p_name, ' '), 'gear')")
_where("P06_prefix", "part", PART, lambda: tx.prefix("p_name", "blue"), "starts_with(p_name, 'blue')")
_where("P07_substring", "part", PART, lambda: tx.substring("p_name", "d gi"), "contains(p_name, 'd gi')")
_where("P08_suffix", "part", PART, lambda: tx.suffix("p_name", "bolt"), "suffix(p_name, 'bolt')")
_where("P09_cased", "documents", DOC, lambda: tx.cased("text", "The"), f"list_contains({sql_tokens('text')}, 'The')")
_where("P09_uncased", "part", PART, lambda: tx.uncased("p_type", "promo"), "lower(p_type) = 'promo'")
_where(
    "P10_gram_match", "part", PART, lambda: tx.gram_match("p_name", "Widget", 3),
    "contains(p_name, 'wid') AND contains(p_name, 'idg') AND contains(p_name, 'dge') AND contains(p_name, 'get')",
)
_where(
    "P11_annotated_contains", "documents", DOC,
    lambda: tx.contains("text", "Things", tx.Analyzer(stem=True)) | tx.contains("text", "ETE", tx.Analyzer(fold_accents=True)),
    f"list_contains(list_transform({TOK}, lambda x: {SQL_STEM}), 'thing') OR list_contains({sql_tokens('strip_accents(lower(text))')}, 'ete')",
)
_where(
    "P11_annotated_case", "documents", DOC, lambda: tx.contains("text", "La", tx.CASED), f"list_contains({sql_tokens('text')}, 'La')"
)
_where("P12_text", "documents", DOC, lambda: tx.text_match("text", "From, THIS with that!"), _has("from", "this", "with", "that"))
_where("P13_regex", "pages", "page_id, url", lambda: tx.matches("url", r"^https://[a-z.]+\.net/(de|fr)/"), r"regexp_matches(url, '^https://[a-z.]+\.net/(de|fr)/')")


def _slice_match(i: str, words) -> str:
    return " AND ".join(f"w[{i} + {k}] = '{x}'" for k, x in enumerate(words))


def _positions(cond: str) -> str:
    """Documents with a token position ``i`` that satisfies a condition on the token list ``w``."""
    return f"""SELECT DISTINCT doc_id, lang FROM (SELECT doc_id, lang, {TOK} AS w FROM documents),
               LATERAL (SELECT unnest(range(1, len(w) + 1)) AS i) WHERE {cond}"""


@query("P14_phrase", _positions(_slice_match("i", ["the", "of"])))
def _(t):
    return t.documents.where(tx.phrase("text", ["The", "of"])).select("doc_id", "lang")


@query("P14_phrase_of_three", _positions(_slice_match("i", ["the", "the", "of"])))
def _(t):
    return t.documents.where(tx.phrase("text", ["the", "the", "of"])).select("doc_id", "lang")


@query("P15_near", _positions("w[i] IN ('was', 'from') AND list_contains(w[i : i + 3], 'was') AND list_contains(w[i : i + 3], 'from')"))
def _(t):
    return t.documents.where(tx.near("text", ["was", "from"], 3)).select("doc_id", "lang")


@query(
    "P15_near_three",
    _positions(
        "w[i] IN ('this', 'and', 'in') AND list_contains(w[i : i + 6], 'this') AND list_contains(w[i : i + 6], 'and') AND list_contains(w[i : i + 6], 'in')"
    ),
)
def _(t):
    return t.documents.where(tx.near("text", ["this", "and", "in"], 6)).select("doc_id", "lang")


@query("P16_onear", _positions("w[i] = 'was' AND list_contains(w[i + 1 : i + 4], 'from')"))
def _(t):
    return t.documents.where(tx.onear("text", ["was", "from"], 4)).select("doc_id", "lang")


@query(
    "P16_onear_three",
    _positions(
        """w[i] = 'the' AND (SELECT count(*) FROM (SELECT unnest(range(1, 6)) AS j) WHERE w[i + j] = 'of'
             AND list_contains(w[i + j + 1 : i + 5], 'in')) > 0"""
    ),
)
def _(t):
    return t.documents.where(tx.onear("text", ["the", "of", "in"], 5)).select("doc_id", "lang")


SIX = ["the", "of", "and", "in", "the", "of"]


def _chain(words: list[str], distance: int) -> str:
    """Documents where some first word starts a chain of earliest next words that ends within the distance."""
    places = ", ".join(f"list_filter(range(1, len(w) + 1), lambda i: w[i] = '{x}') AS p{k}" for k, x in enumerate(words))
    steps, last = "", "s0"
    for k in range(1, len(words)):
        lists = "".join(f", p{j}" for j in range(k + 1, len(words)))
        steps += f", c{k} AS (SELECT doc_id, lang, s, list_min(list_filter(p{k}, lambda x: x > e)) AS e{lists} FROM {last})"
        last = f"c{k}"
    rest = "".join(f", p{j}" for j in range(1, len(words)))
    return f"""WITH w AS (SELECT doc_id, lang, {TOK} AS w FROM documents), p AS (SELECT doc_id, lang, {places} FROM w),
               f AS (SELECT doc_id, lang, unnest(p0) AS s{rest} FROM p), s0 AS (SELECT *, s AS e FROM f){steps}
               SELECT DISTINCT doc_id, lang FROM {last} WHERE e - s <= {distance}"""


@query("P16_onear_six_far", _chain(SIX, 20))
def _(t):
    return t.documents.where(tx.onear("text", SIX, 20)).select("doc_id", "lang")


_where(
    "P17_equiv", "documents", DOC, lambda: tx.equiv("text", ["que", "des", "und"]), f"list_has_any({TOK}, ['que', 'des', 'und'])"
)
_where(
    "P18_fuzzy_value", "part", PART, lambda: tx.fuzzy_value("p_type", "standart", 2, 3),
    "levenshtein(lower(p_type), 'standart') <= 2 AND left(lower(p_type), 3) = 'sta'",
)
_where(
    "P18_fuzzy_token", "part", PART, lambda: tx.fuzzy("p_name", "widgte", 2, 1),
    "len(list_filter(string_split(p_name, ' '), lambda x: levenshtein(x, 'widgte') <= 2 AND left(x, 1) = 'w')) > 0",
)


@query(
    "P18_fuzzy_text",
    f"SELECT {DOC} FROM documents WHERE len(list_filter({TOK}, lambda x: levenshtein(x, 'hehelyx') <= 1 AND left(x, 2) = 'he')) > 0",
)
def _(t):
    return fuzzy.fuzzy_match(t.documents, "doc_id", "text", ["hehelyx"], 1, 2).select(*DOC.split(", "))


@query(
    "P18_fuzzy_many_terms",
    f"""WITH v AS (SELECT * FROM (SELECT DISTINCT doc_id, unnest({TOK}) AS token FROM documents WHERE lang = 'en') WHERE regexp_full_match(token, '[a-z0-9]+')),
        near AS (SELECT term, token FROM (SELECT DISTINCT token FROM v),
                 (SELECT DISTINCT unnest({TOK}) AS term FROM benchmark) WHERE length(term) BETWEEN 9 AND 10 AND regexp_full_match(term, '[a-z0-9]+')
                 AND abs(length(term) - length(token)) <= 2 AND left(term, 1) = left(token, 1) AND levenshtein(term, token) <= 2)
        SELECT term, count(DISTINCT token) AS n_tokens, count(DISTINCT doc_id) AS n_docs FROM near JOIN v USING (token) GROUP BY term""",
)
def _(t):
    """All words of nine and ten letters of the benchmark, each against the words of all English texts; ASCII, as the twin counts bytes."""
    plain = F.col("token").rlike("^[a-z0-9]+$")
    terms = fuzzy.vocabulary(t.benchmark, "text").where(F.length("token").between(9, 10) & plain).withColumnRenamed("token", "term")
    hits = fuzzy.fuzzy_hits(t.documents.where("lang = 'en'"), "doc_id", "text", terms, 2, 1).where(plain)
    return hits.groupBy("term").agg(F.countDistinct("token").alias("n_tokens"), F.countDistinct("doc_id").alias("n_docs"))


_where("P19_in", "orders", ORD, lambda: pr.is_in("o_orderpriority", ["1-URGENT", "5-LOW"]), "o_orderpriority IN ('1-URGENT', '5-LOW')")


@query(
    "P19_in_table",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')",
)
def _(t):
    wanted = t.customer.where("c_mktsegment = 'BUILDING'").select("c_custkey")
    return matching.in_table(t.orders, "o_custkey", wanted).select("o_orderkey", "o_totalprice")


_where("P20_range", "orders", ORD, lambda: pr.in_range("o_totalprice", 100000, 200000), "o_totalprice BETWEEN 100000 AND 200000")
_where("P20_range_open", "part", PART, lambda: pr.in_range("p_size", 10, 20, "open"), "p_size > 10 AND p_size < 20")
_where("P20_range_left_open", "part", PART, lambda: pr.in_range("p_size", 10, 20, "leftOpen"), "p_size > 10 AND p_size <= 20")
_where("P20_range_right_open", "part", PART, lambda: pr.in_range("p_size", 10, 20, "rightOpen"), "p_size >= 10 AND p_size < 20")


@query(
    "P21_range_hit_limit",
    f"SELECT {ORD} FROM orders WHERE o_totalprice BETWEEN 100000 AND 400000 ORDER BY o_totalprice, o_orderkey LIMIT 25",
)
def _(t):
    return matching.range_hit_limit(t.orders, "o_orderkey", "o_totalprice", 100000, 400000, 25).select("o_orderkey", "o_totalprice")


@query(
    "P21_range_hit_limit_descending",
    f"SELECT {ORD} FROM orders WHERE o_totalprice BETWEEN 100000 AND 400000 ORDER BY o_totalprice DESC, o_orderkey LIMIT 25",
)
def _(t):
    return matching.range_hit_limit(t.orders, "o_orderkey", "o_totalprice", 100000, 400000, -25).select("o_orderkey", "o_totalprice")


_where(
    "P22_and", "part", PART, lambda: pr.all_of(pr.compare("p_size", ">", 30), tx.prefix("p_name", "red"), tx.exact("p_type", "PROMO")),
    "p_size > 30 AND p_name LIKE 'red%' AND p_type = 'PROMO'",
)
_where(
    "P23_or", "part", PART, lambda: pr.any_of(pr.compare("p_size", "<", 3), tx.exact("p_brand", "Brand#3"), tx.suffix("p_name", "rod")),
    "p_size < 3 OR p_brand = 'Brand#3' OR p_name LIKE '%rod'",
)
_where(
    "P24_any_of", "part", PART,
    lambda: pr.any_of(pr.all_of(tx.exact("p_type", "SMALL"), pr.compare("p_size", ">", 40)), pr.any_of(pr.compare("p_size", "=", 1))),
    "(p_type = 'SMALL' AND p_size > 40) OR p_size = 1",
)
_where("P25_true", "region", "r_regionkey, r_name", lambda: pr.true(), "true")
_where("P25_false", "region", "r_regionkey, r_name", lambda: pr.false(), "false")


def turn_queries(t: Tables) -> DataFrame:
    """Conversation turns as queries; the first sentence break decides the query text."""
    return t.conversations.select(
        "conv_id", "turn", F.regexp_extract("text", r"^[^.!?]*[.!?]+([^.!?]*)", 1).alias("q")
    )


SQL_TURNS = r"SELECT conv_id, turn, regexp_extract(text, '^[^.!?]*[.!?]+([^.!?]*)', 1) AS q FROM conversations"


@query("P26_non_empty", rf"SELECT conv_id, turn, q FROM ({SQL_TURNS}) WHERE regexp_matches(q, '[\p{{L}}\p{{N}}]')")
def _(t):
    return matching.non_empty(turn_queries(t), "q")[0]


@query(
    "P26_empty_queries",
    rf"SELECT conv_id, turn, q, 'the query has no terms' AS error FROM ({SQL_TURNS}) WHERE NOT regexp_matches(q, '[\p{{L}}\p{{N}}]')",
)
def _(t):
    return matching.non_empty(turn_queries(t), "q")[1]


@query("P26_non_empty_whole", r"SELECT conv_id, turn, text AS q FROM conversations WHERE coalesce(regexp_matches(text, '[\p{L}\p{N}]'), false)")
def _(t):
    """Whole turns as queries."""
    return matching.non_empty(t.conversations.select("conv_id", "turn", F.col("text").alias("q")), "q")[0]


@query(
    "P26_empty_queries_whole",
    r"""SELECT conv_id, turn, text AS q, 'the query has no terms' AS error FROM conversations
        WHERE NOT coalesce(regexp_matches(text, '[\p{L}\p{N}]'), false)""",
)
def _(t):
    return matching.non_empty(t.conversations.select("conv_id", "turn", F.col("text").alias("q")), "q")[1]


@query(
    "P27_same_element",
    f"""SELECT doc_id, lang FROM documents WHERE len(list_filter(string_split(text, chr(10)),
          lambda x: length(x) < 120 AND list_contains({sql_tokens('lower(x)')}, 'with') AND list_contains({sql_tokens('lower(x)')}, 'and'))) > 0""",
)
def _(t):
    """A line (one element of the text's lines) holds both words and is short."""
    lines = F.transform(F.split("text", "\n"), lambda x: F.struct(x.alias("line"), F.length(x).alias("size")))
    cond = lambda e: (e["size"] < 120) & tx.contains(e["line"], "with") & tx.contains(e["line"], "and")
    # both words somewhere in the text first: lines are split for those texts only
    return t.documents.where(tx.text_match("text", "with and") & pr.same_element(lines, cond)).select("doc_id", "lang")


BRANDS = {"Brand#2": 10, "Brand#7": 30, "Brand#12": 20}
SQL_BRANDS = "CASE p_brand WHEN 'Brand#2' THEN 10 WHEN 'Brand#7' THEN 30 WHEN 'Brand#12' THEN 20 END"


@query("P28_weighted_set", f"SELECT p_partkey, {SQL_BRANDS} AS relevance FROM part WHERE p_brand IN ('Brand#2', 'Brand#7', 'Brand#12')")
def _(t):
    return t.part.select("p_partkey", matching.weighted_set("p_brand", BRANDS).alias("relevance")).where("relevance IS NOT NULL")


@query(
    "P28_weighted_set_table",
    """SELECT p_partkey, max(weight) AS relevance FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS token FROM part)
       JOIN (SELECT split_part(p_name, ' ', 2) AS token, max(p_size) AS weight FROM part WHERE p_type = 'PROMO' AND p_brand = 'Brand#4'
             GROUP BY 1) USING (token) GROUP BY p_partkey""",
)
def _(t):
    promo = t.part.where("p_type = 'PROMO' AND p_brand = 'Brand#4'")
    weights = promo.groupBy(F.split_part("p_name", F.lit(" "), F.lit(2)).alias("token")).agg(F.max("p_size").alias("weight"))
    words = t.part.select("p_partkey", F.split("p_name", " ").alias("w"))
    return matching.weighted_set_join(words, "p_partkey", "w", weights).select("p_partkey", "relevance")


def user_weights(t: Tables) -> DataFrame:
    """Per user the number of events of each type as a weighted set: one entry per event type."""
    kinds = ["click", "error", "purchase", "signup", "view"]
    counts = [F.count_if(F.col("event_type") == k).cast("int").alias(k) for k in kinds]
    per = t.events.groupBy("user_id").agg(*counts)
    filled = F.map_filter(F.create_map(*[x for k in kinds for x in (F.lit(k), F.col(k))]), lambda _, v: v > 0)
    return per.select("user_id", filled.alias("kinds"))


@query(
    "P29_dot_product",
    """SELECT user_id, sum(CASE event_type WHEN 'purchase' THEN 10 WHEN 'click' THEN 2 ELSE 0 END)::BIGINT AS relevance
       FROM events GROUP BY user_id HAVING count(*) FILTER (event_type IN ('purchase', 'click')) > 0""",
)
def _(t):
    terms = {"purchase": 10, "click": 2}
    df = user_weights(t).where(matching.shares_key("kinds", terms))
    return df.select("user_id", matching.dot_product("kinds", terms).alias("relevance"))


WAND = {"this": 3, "from": 5, "hehely": 1}
SQL_WAND = " + ".join(f"len(list_filter(w, lambda x: x = '{k}')) * {v}" for k, v in WAND.items())


@query(
    "P30_wand",
    f"""SELECT doc_id, s AS relevance FROM (SELECT doc_id, ({SQL_WAND})::BIGINT AS s FROM (SELECT doc_id, {TOK} AS w FROM documents))
        WHERE s > 0 ORDER BY s DESC, doc_id LIMIT 100""",
)
def _(t):
    weights = matching.term_weights("text", list(WAND))
    return matching.wand(t.documents, "doc_id", matching.dot_product(weights, WAND)).select("doc_id", "relevance")


@query(
    "P30_wand_threshold",
    f"""SELECT doc_id, s AS relevance FROM (SELECT doc_id, ({SQL_WAND})::BIGINT AS s FROM (SELECT doc_id, {TOK} AS w FROM documents))
        WHERE s > 20 ORDER BY s DESC, doc_id LIMIT 30""",
)
def _(t):
    weights = matching.term_weights("text", list(WAND))
    return matching.wand(t.documents, "doc_id", matching.dot_product(weights, WAND), 30, 20).select("doc_id", "relevance")


@query(
    "P32_rank",
    f"""SELECT doc_id, list_contains(w, 'from')::INTEGER AS has_from, len(list_filter(w, lambda x: x = 'that'))::INTEGER AS n_that
        FROM (SELECT doc_id, {TOK} AS w FROM documents) WHERE list_contains(w, 'this')""",
)
def _(t):
    hits = matching.rank_of(
        t.documents, tx.contains("text", "this"), has_from=tx.contains("text", "from"), n_that=tx.term_count("text", "that")
    )
    return hits.select("doc_id", "has_from", "n_that")


# -- rules --------------------------------------------------------------------------------------------


def part_rules(t: Tables) -> DataFrame:
    """A rule per part: its brand (large parts: any but), and a size range."""
    brand = F.when(
        F.col("p_size") > 40, pr.rule_values("brand", F.array("p_brand"), negate=True)
    ).otherwise(pr.rule_values("brand", F.array(F.col("p_brand"), F.lit("Brand#1"))))
    size = pr.rule_range("size", F.col("p_size") - 5, F.col("p_size") + 5)
    return t.part.select("p_partkey", F.array(brand, size).alias("rules"))


@query(
    "P33_predicate",
    """SELECT p_partkey FROM part WHERE 20 BETWEEN p_size - 5 AND p_size + 5
         AND CASE WHEN p_size > 40 THEN p_brand <> 'Brand#7' ELSE p_brand = 'Brand#7' OR 'Brand#7' = 'Brand#1' END""",
)
def _(t):
    return part_rules(t).where(pr.predicate_matches("rules", {"brand": "Brand#7"}, {"size": 20})).select("p_partkey")


@query(
    "P33_predicate_many_queries",
    """SELECT c_custkey, p_partkey FROM (SELECT c_custkey, 'Brand#' || (c_nationkey + 1) AS brand, floor(abs(c_acctbal) / 200)::BIGINT AS size FROM customer), part
       WHERE size BETWEEN p_size - 5 AND p_size + 5
         AND CASE WHEN p_size > 40 THEN p_brand <> brand ELSE brand IN (p_brand, 'Brand#1') END""",
)
def _(t):
    asked = t.customer.select(
        "c_custkey",
        F.create_map(F.lit("brand"), F.concat(F.lit("Brand#"), (F.col("c_nationkey") + 1).cast("string"))).alias("attrs"),
        F.create_map(F.lit("size"), F.floor(F.abs("c_acctbal") / 200).cast("bigint")).alias("ranges"),
    )
    out = matching.match_rules(part_rules(t), "rules", asked, "attrs", "ranges", t.spark.sparkContext.defaultParallelism)
    return out.select("c_custkey", "p_partkey")


# -- URLs, fieldsets, user queries ---------------------------------------------------------------------

URLTOK = sql_tokens("lower(url)")
SQL_HOST = rf"""SELECT page_id, url, {URLTOK} AS w,
   len({sql_tokens("regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?)', 1)")}) AS b,
   len({sql_tokens("regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?)([^/:?#]*)', 2)")}) AS h FROM pages"""


@query(
    "P34_uri",
    f"SELECT DISTINCT page_id, url FROM (SELECT page_id, url, {URLTOK} AS w FROM pages), LATERAL (SELECT unnest(range(1, len(w) + 1)) AS i) WHERE {_slice_match('i', ['example', 'com', 'en'])}",
)
def _(t):
    return t.pages.where(tx.uri("url", "example.com/en")).select("page_id", "url")


@query("P34_uri_start_anchor", f"SELECT page_id, url FROM ({SQL_HOST}) WHERE w[b + 1] = 'blog'")
def _(t):
    return t.pages.where(tx.uri("url", "blog", start_anchor=True)).select("page_id", "url")


@query("P34_uri_end_anchor", f"SELECT page_id, url FROM ({SQL_HOST}) WHERE w[b + h] = 'net' AND w[b + h - 1] = 'example'")
def _(t):
    return t.pages.where(tx.uri("url", "example.net", end_anchor=True)).select("page_id", "url")


@query(
    "P35_fieldset",
    f"SELECT doc_id, lang FROM documents WHERE list_contains({TOK}, 'src7') OR source = 'src7' OR list_contains({TOK}, 'hehely')",
)
def _(t):
    hit = tx.any_field(lambda c: tx.contains(c, "src7") | tx.contains(c, "hehely"), "text", "source")
    return t.documents.where(hit).select("doc_id", "lang")


for _kind, _cond in {
    "and": _has("this", "with", "that"),
    "or": f"list_has_any({TOK}, ['this', 'with', 'that'])",
    "weakAnd": f"list_has_any({TOK}, ['this', 'with', 'that'])",
}.items():
    _where(
        f"P36_user_query_{_kind.lower()}", "documents", DOC,
        lambda kind=_kind: matching.user_query("text", "this with that", kind), _cond,
    )


@query("P36_user_query_phrase", _positions(_slice_match("i", ["and", "the"])))
def _(t):
    return t.documents.where(matching.user_query("text", "and the", "phrase")).select("doc_id", "lang")


_where(
    "P37_user_input", "documents", DOC,
    lambda: matching.user_input("que la", "text", grammar="all", language="fr", language_column="lang"),
    f"lang = 'fr' AND {_has('que', 'la')}",
)
_where("P37_user_input_empty_allowed", "documents", DOC, lambda: matching.user_input("", "text", allow_empty=True), "true")


@query(
    "P37_user_input_many_queries",
    f"""WITH q AS (SELECT item_id, list_distinct({sql_tokens("lower(regexp_extract(text, '^[^.!?]*'))")}) AS terms FROM benchmark),
        d AS (SELECT doc_id, list_distinct({TOK}) AS w FROM documents)
        SELECT item_id, doc_id, len(terms)::INTEGER AS terms FROM q, d WHERE len(terms) > 0 AND list_has_all(w, terms)""",
)
def _(t):
    """The first sentence of each benchmark item as an all-terms query."""
    asked = t.benchmark.select("item_id", F.regexp_extract("text", r"^[^.!?]*", 0).alias("q"))
    return matching.match_queries(t.documents, "doc_id", "text", asked, "item_id", "q")


@query(
    "P37_user_input_many_whole",
    f"""WITH q AS (SELECT item_id, list_distinct({TOK}) AS terms FROM benchmark),
        d AS (SELECT doc_id, list_distinct({TOK}) AS w FROM documents)
        SELECT item_id, doc_id, len(terms)::INTEGER AS terms FROM q, d WHERE len(terms) > 0 AND list_has_all(w, terms)""",
)
def _(t):
    """The whole text of each benchmark item as an all-terms query."""
    return matching.match_queries(t.documents, "doc_id", "text", t.benchmark, "item_id", "text")


_where(
    "P38_recall_filter", "documents", DOC, lambda: pr.all_of(F.col("source").isin("src1", "src2", "src3"), tx.contains("text", "this")),
    f"source IN ('src1', 'src2', 'src3') AND {_has('this')}",
)

# -- geography ---------------------------------------------------------------------------------------


def places(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey",
        ((F.col("c_custkey") % 180) - 90).cast("double").alias("lat"),
        ((F.col("c_custkey") * 7) % 360 - 180).cast("double").alias("lng"),
    )


SQL_PLACES = "SELECT c_custkey, ((c_custkey % 180) - 90)::DOUBLE AS lat, ((c_custkey * 7) % 360 - 180)::DOUBLE AS lng FROM customer"


def sql_km(lat: float, lng: float) -> str:
    return f"""2 * 6371.0 * asin(sqrt(least(1.0, pow(sin((radians({lat}) - radians(lat)) / 2), 2)
        + cos(radians(lat)) * cos(radians({lat})) * pow(sin((radians({lng}) - radians(lng)) / 2), 2))))"""


def _radius(name: str, lat: float, lng: float, km: float) -> None:
    @query(name, f"SELECT c_custkey, round({sql_km(lat, lng)}, 6) AS km FROM ({SQL_PLACES}) WHERE {sql_km(lat, lng)} <= {km}")
    def _(t):
        hits = places(t).where(pr.within_radius("lat", "lng", lat, lng, km))
        return hits.select("c_custkey", F.round(pr.haversine_km("lat", "lng", lat, lng), 6).alias("km"))


_radius("P39_geo_radius", 48.2, 16.4, 2500.0)
_radius("P39_geo_radius_date_line", -12.0, 178.5, 3000.0)
_radius("P39_geo_radius_pole", 86.0, 20.0, 2000.0)


@query("P40_geo_box", f"SELECT * FROM ({SQL_PLACES}) WHERE lat BETWEEN -20 AND 45.5 AND lng BETWEEN -10 AND 60")
def _(t):
    return places(t).where(pr.within_box("lat", "lng", -20, -10, 45.5, 60))


@query("P40_geo_box_date_line", f"SELECT * FROM ({SQL_PLACES}) WHERE lat BETWEEN -20 AND 45.5 AND (lng >= 150 OR lng <= -150)")
def _(t):
    return places(t).where(pr.within_box("lat", "lng", -20, 150, 45.5, -150))
