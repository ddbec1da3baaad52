"""Fuzzy terms against the vocabulary of a text column.

Edit distances are only measured between a term and tokens of the distinct vocabulary that share a deletion key with it; the texts
themselves are met by equality.  A token within ``k`` edits of a term has, like the term, some string left after at most ``k`` deletions from
its first letters: a common subsequence of the two heads of ``HEAD`` letters is at most ``k`` letters shorter than either.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions import text as tx
from lodestone.session import cut, small_side

# Letters of a token that deletion keys are made of: 92 keys at two edits at most, however long the token.
HEAD = 13


def deletion_keys(token: Column | str, max_edits: int = 2) -> Column:
    """Distinct strings left of the token's head after up to ``max_edits`` deletions."""
    level = F.array(F.substring(tx.as_col(token), 1, HEAD))
    found = level
    for _ in range(max_edits):
        level = F.array_distinct(F.flatten(F.transform(F.filter(level, lambda x: F.length(x) > 0), _one_less)))
        found = F.concat(found, level)
    return F.array_distinct(found)


def _one_less(x: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(x)), lambda i: F.concat(F.substring(x, F.lit(1), i - 1), F.substring(x, i + 1, F.length(x))))


def vocabulary(df: DataFrame, text: str, an: tx.Analyzer = tx.DEFAULT) -> DataFrame:
    """The distinct tokens of a column; duplicates go map-side before the shuffle."""
    return df.select(F.explode(tx.tokens(text, an)).alias("token")).distinct()


def plausible(tokens: DataFrame, terms: DataFrame, max_edits: int, prefix_length: int) -> DataFrame:
    """Rows whose ``token`` has a length and first letters that some term allows."""
    letters = min(prefix_length, terms.agg(F.min(F.length("term"))).first()[0] or 0) if prefix_length else 0
    head = lambda c: F.substring(F.col(c), 1, letters)
    lengths = F.explode(F.sequence(F.length("term") - max_edits, F.length("term") + max_edits))
    allowed = terms.select(lengths.alias("n"), head("term").alias("h")).distinct()
    return tokens.join(small_side(allowed), (F.length("token") == F.col("n")) & (head("token") == F.col("h")), "left_semi")


def near_tokens(words: DataFrame, terms: DataFrame, max_edits: int = 2, prefix_length: int = 0) -> DataFrame:
    """``(term, token, edits)`` of all tokens of a vocabulary within ``max_edits`` of a term, their first letters exact.

    Both sides meet on deletion keys; a token without a key of any term goes no further than its task while the terms are few enough
    to be sent there.  Null terms match nothing.
    """
    terms = terms.select("term").where("term IS NOT NULL").distinct()
    words = plausible(words.select("token"), terms, max_edits, prefix_length)
    asked = small_side(terms.select("term", F.explode(deletion_keys("term", max_edits)).alias("key")))
    keys = words.select("token", F.explode(deletion_keys("token", max_edits)).alias("key"))
    near = F.abs(F.length("term") - F.length("token")) <= max_edits
    if prefix_length:
        near = near & F.col("token").startswith(F.substring("term", 1, prefix_length))
    pairs = keys.join(asked, "key").where(near).select("term", "token").distinct()
    return pairs.withColumn("edits", F.levenshtein("term", "token", max_edits)).where("edits >= 0")


def _heads(terms: Sequence[str], max_edits: int, prefix_length: int) -> str:
    """Pattern of the whole tokens that begin as a term does and have a length that it allows; the search skips ahead by the letters."""
    lengths: dict[str, list[int]] = {}
    for t in terms:
        lengths.setdefault(t[:prefix_length], []).append(len(t))
    each = []
    for head, n in lengths.items():
        least, most = max(0, min(n) - max_edits - len(head)), max(n) + max_edits - len(head)
        each.append(f"{tx._start(head)}{tx.WORD}{{{least},{most}}}+")
    return f"(?:{'|'.join(each)}){tx.RIGHT}"


def fuzzy_hits(
    df: DataFrame, key: str, text: str, terms: Sequence[str] | DataFrame, max_edits: int = 2, prefix_length: int = 0,
    an: tx.Analyzer = tx.DEFAULT, words: DataFrame | None = None,
) -> DataFrame:
    """``(key, term, token, edits)``, one row for each token of a row's text that lies near a term.

    ``terms`` are query terms (one token each) or a table with a column ``term``.  ``words`` may be a maintained vocabulary with a
    column ``token``.  Without one the texts are read twice, for their vocabulary and for the hits, unless exact first letters leave so few
    tokens that these are kept between the two.
    """
    found, extracted = tx.tokens(text, an), False
    if not isinstance(terms, DataFrame):
        asked = [t for term in terms for t in tx._query(term, an)]
        terms = df.sparkSession.createDataFrame([(t,) for t in asked], "term string")
        if prefix_length:
            found, extracted = F.regexp_extract_all(an.text(text), F.lit(_heads(asked, max_edits, prefix_length)), 0), True
    else:
        terms = cut(terms.select("term").where("term IS NOT NULL").distinct())
    tokens = df.select(F.col(key), F.explode(found).alias("token"))
    if prefix_length:
        tokens = cut((tokens if extracted else plausible(tokens, terms, max_edits, prefix_length)).distinct())
    if words is None:
        words = tokens.select("token").distinct() if prefix_length else vocabulary(df, text, an)
    near = cut(near_tokens(words, terms, max_edits, prefix_length))
    hits = tokens.join(small_side(near), "token").select(key, "term", "token", "edits")
    return hits if prefix_length else hits.distinct()


def fuzzy_match(
    df: DataFrame, key: str, text: str, terms: Sequence[str] | DataFrame, max_edits: int = 2, prefix_length: int = 0,
    an: tx.Analyzer = tx.DEFAULT, words: DataFrame | None = None,
) -> DataFrame:
    """Rows whose text holds a token near any of the terms; ``key`` names the rows."""
    hits = fuzzy_hits(df, key, text, terms, max_edits, prefix_length, an, words).select(key).distinct()
    return df.join(hits, key, "left_semi")
