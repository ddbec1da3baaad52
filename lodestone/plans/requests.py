"""Whole requests: match, rank, collapse, page and group in one plan each."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestone.functions import aggregates as ag, predicates as pr, text as tx
from lodestone.operators import grouping, ranking
from lodestone.plans.registry import query
from lodestone.plans.request import Request, search
from lodestone.sources.tables import DocType, Summary

PART = DocType("part", "p_partkey", summaries={"card": Summary(["p_partkey", "p_name", "p_brand"])})


def request() -> Request:
    profile = ranking.RankProfile(
        "by_size", first=lambda q: F.col("p_retailprice") + q["boost"] * F.col("p_size"),
        second=lambda q: F.col("relevance") - 2 * F.col("p_size"), second_count=100, inputs={"boost": 1.0},
    )
    return Request(
        where=pr.any_of(tx.contains("p_name", "bolt"), tx.contains("p_name", "red")),
        filter=F.col("p_size") > 3, profile=profile, inputs={"boost": 0.5}, collapse_field="p_brand", hits=15, offset=2,
        summary="card", bold={"p_name": ["bolt"]},
        levels=[grouping.Level("p_type", "p_type", {"n": ag.count()}, [F.col("n").desc()], 4)],
    )


SQL_MATCHED = """m AS (SELECT *, p_retailprice + 0.5 * p_size AS s1 FROM part
      WHERE p_size > 3 AND list_has_any(string_split(p_name, ' '), ['bolt', 'red'])),
   r AS (SELECT *, row_number() OVER (ORDER BY s1 DESC, p_partkey) <= 100 AS best FROM m),
   s AS (SELECT *, CASE WHEN best THEN s1 - 2 * p_size ELSE s1 END AS relevance FROM r)"""


@query(
    "Q01_request_hits",
    f"""WITH {SQL_MATCHED},
        c AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY best DESC, relevance DESC, p_partkey) = 1)
        SELECT p_partkey, regexp_replace(p_name, '\\bbolt\\b', '<b>bolt</b>') AS p_name, p_brand, round(relevance, 4) AS relevance
        FROM c ORDER BY best DESC, c.relevance DESC, p_partkey LIMIT 15 OFFSET 2""",
)
def _(t):
    return search(t.part, PART, request()).hits.withColumn("relevance", F.round("relevance", 4))


@query("Q02_request_total", f"WITH {SQL_MATCHED} SELECT count(*) AS total_count FROM m")
def _(t):
    return search(t.part, PART, request()).total


@query("Q03_request_groups", f"WITH {SQL_MATCHED} SELECT p_type, count(*) AS n FROM m GROUP BY 1 ORDER BY n DESC, p_type LIMIT 4")
def _(t):
    return search(t.part, PART, request()).groups[0]
