"""Retrieval operators that need more than one column expression."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from lodestone.functions import text as tx
from lodestone.functions.predicates import rule_holds
from lodestone.functions.text import DEFAULT, Analyzer, as_col
from lodestone.operators.order import top
from lodestone.session import cut, is_small, small_side


def range_hit_limit(df: DataFrame, key: str, field: str, lo, hi, hit_limit: int) -> DataFrame:
    """Inclusive range cut to its ``|hit_limit|`` smallest (negative: largest) values."""
    inside = df.where(F.col(field).between(lo, hi))
    first = F.col(field).asc() if hit_limit > 0 else F.col(field).desc()
    return top(inside, [first, F.col(key).asc()], abs(hit_limit))


def in_table(df: DataFrame, field: str, values: DataFrame) -> DataFrame:
    """``in`` for a list too long for a literal: a semi join, broadcast only if checked small."""
    v = values.select(F.col(values.columns[0]).alias(field))
    return df.join(small_side(v), field, "left_semi")


def non_empty(queries: DataFrame, query: str, an: Analyzer = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """Split query rows into those with at least one term and those without."""
    has = F.coalesce(an.text(query).rlike(tx.WORD), F.lit(False))
    return queries.where(has), queries.where(~has).withColumn("error", F.lit("the query has no terms"))


# -- weights ---------------------------------------------------------------------------------


def weighted_set(value: Column | str, weights: Mapping, multi: bool = False) -> Column:
    """Largest weight among matched tokens, null where nothing matches."""
    table = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])
    if multi:
        return F.array_max(F.transform(as_col(value), lambda t: F.try_element_at(table, t)))
    return F.try_element_at(table, as_col(value))


def weighted_set_join(df: DataFrame, key: str, field: str, weights: DataFrame) -> DataFrame:
    """The same with weights as a table ``(token, weight)`` and an array field."""
    pairs = df.select(key, F.explode(F.array_distinct(field)).alias("token"))
    scored = pairs.join(small_side(weights), "token").groupBy(key).agg(F.max("weight").alias("relevance"))
    return df.join(scored, key)


def dot_product(field: Column | str, terms: Mapping[str, float]) -> Column:
    """Sum over shared keys of query weight x field weight (a map column)."""
    m = as_col(field)
    total = F.lit(0).cast("bigint")
    for t, w in terms.items():
        total = total + F.coalesce(F.try_element_at(m, F.lit(t)), F.lit(0)) * F.lit(w)
    return total


def shares_key(field: Column | str, terms: Mapping[str, float]) -> Column:
    """Whether the map column holds any of the query's keys."""
    m = as_col(field)
    return F.greatest(*[F.map_contains_key(m, t) for t in terms], F.lit(False))


def term_weights(text: Column | str, terms: Sequence[str], an: Analyzer = DEFAULT) -> Column:
    """``map<string,int>`` of the given terms' counts in a text."""
    return F.create_map(*[x for t in terms for x in (F.lit(t), tx.term_count(text, t, an))])


def wand(
    df: DataFrame, key: str, score: Column, target_hits: int = 100, score_threshold: float | None = None
) -> DataFrame:
    """Top ``target_hits`` by a dot product, above an optional threshold."""
    out = df.withColumn("relevance", score).where(F.col("relevance") > (score_threshold or 0))
    return top(out, [F.col("relevance").desc(), F.col(key).asc()], target_hits)


def rank_of(df: DataFrame, first: Column, **features: Column) -> DataFrame:
    """The first argument decides the match, the others become 0/1 or score columns."""
    hits = df.where(first)
    for name, c in features.items():
        is_bool = isinstance(df.select(c).schema[0].dataType, BooleanType)
        hits = hits.withColumn(name, c.cast("int") if is_bool else c)
    return hits



# -- rules carried by documents, many queries ---------------------------------------------------


# Fixed bounds of range routing: a cell level is 16 times as wide as the one below it, and the widest covers every bigint range.
CELL_BITS = 4
CELL_LEVELS = 16

# Most kinds of route key that are sent to all tasks; beyond them a query asks for every kind there could be.
MOST_KINDS = 10_000

# Rules with neither a value list nor a range meet every query; they are dealt out over so many routes.
SALTS = 8

# Rows a class of equal rules, or of queries that ask the same, must have on average to be matched once for all of them.
CLASS_ROWS = 8

# Rows of a class that are kept in one array, about.
PACK_ROWS = 1024

# Tasks a core into which rows are dealt before they are multiplied, so that the cores end at about the same time.
TASKS_A_CORE = 4


def _cell(value: Column, level: Column) -> Column:
    return F.concat_ws(":", level.cast("string"), F.call_function("shiftright", value, level * CELL_BITS).cast("string"))


def _route(*parts: Column) -> Column:
    return F.concat_ws("\u0001", *parts)


def _is_list(e: Column) -> Column:
    return e["values"].isNotNull() & ~e["negate"]


def _is_range(e: Column) -> Column:
    return e["values"].isNull()


def _range_level(ranged: Column) -> Column:
    """Finest level on which the range has at most 17 cells; null if even the coarsest has more."""
    span = ranged["hi"].cast("double") - ranged["lo"].cast("double")
    level = None
    for n in range(CELL_LEVELS):
        cond = span < float(1 << (CELL_BITS * (n + 1)))
        level = F.when(cond, n) if level is None else level.when(cond, n)
    return level


def _rule_routes(listed: Column, ranged: Column, level: Column, salt: Column) -> Column:
    """Route keys of one rule: its first value list x the cells of its first range; a salt where it has neither."""
    shift = lambda c: F.call_function("shiftright", c, level * CELL_BITS)
    none = F.array().cast("array<string>")
    cells = F.when(level.isNull() | (ranged["hi"] < ranged["lo"]), none).otherwise(
        F.transform(
            F.sequence(shift(ranged["lo"]), shift(ranged["hi"])),
            lambda c: _route(ranged["attr"], F.concat_ws(":", level.cast("string"), c.cast("string"))),
        ),
    )
    alone = F.when(listed.isNull(), F.array(_route(F.lit("-"), salt.cast("string")))).otherwise(F.array(F.lit("-")))
    range_part = F.when(ranged.isNotNull(), cells).otherwise(alone)
    list_part = F.when(
        listed.isNotNull(), F.transform(F.array_distinct(listed["values"]), lambda v: _route(listed["attr"], v))
    ).otherwise(F.array(F.lit("-")))
    return _product(list_part, range_part)


def _keyed(rules: DataFrame, rule_column: str) -> DataFrame:
    """Rules with the two conditions that make their route keys, and a salt."""
    r = F.col(rule_column)
    first = lambda pred: F.array_position(F.transform(r, pred), True).cast("int") - 1
    out = rules.withColumns(
        {
            "_listed": F.get(F.filter(r, _is_list), F.lit(0)), "_ranged": F.get(F.filter(r, _is_range), F.lit(0)),
            "_at_list": first(_is_list), "_at_range": first(_is_range),
        }
    )
    return out.withColumns({"_level": _range_level(F.col("_ranged")), "_salt": F.pmod(F.xxhash64(F.to_json(F.struct(*rules.columns))), F.lit(SALTS))})


def _routed(keyed: DataFrame, rule_column: str, columns: Sequence[str]) -> DataFrame:
    """Rules with ``_route`` and ``_rest``, the conditions an equal route key leaves to check.

    The key decides the value list, and on the finest level, whose cells are single
    values, the range too.
    """
    done = lambda i: (i == F.col("_at_list")) | ((i == F.col("_at_range")) & F.coalesce(F.col("_level") == 0, F.lit(False)))
    rest = F.filter(F.col(rule_column), lambda _, i: ~F.coalesce(done(i), F.lit(False)))
    return keyed.select(
        *columns, rest.alias("_rest"),
        F.explode(_rule_routes(F.col("_listed"), F.col("_ranged"), F.col("_level"), F.col("_salt"))).alias("_route"),
    )


def _kind(listed: Column, ranged: Column) -> Column:
    """Name of a kind of rule: the attributes of its list and of its range."""
    return F.concat_ws("\u0002", F.coalesce(listed, F.lit("-")), F.coalesce(ranged, F.lit("-")))


def _kinds(keyed: DataFrame) -> Column:
    """A map from each kind of rule to its cell levels, as a scalar subquery: every batch of a stream reads it anew.

    Its size goes with the attributes, not with the rules; with more than ``MOST_KINDS`` it is null.
    """
    found = keyed.select(_kind(F.col("_listed.attr"), F.col("_ranged.attr")).alias("kind"), F.coalesce("_level", F.lit(0)).alias("level"))
    some = found.groupBy("kind").agg(F.collect_set("level").alias("levels")).limit(MOST_KINDS + 1)
    whole = F.map_from_entries(F.collect_list(F.struct("kind", "levels")))
    return some.agg(F.when(F.count(F.lit(1)) <= MOST_KINDS, whole).alias("kinds")).scalar()


def _query_routes(queries: DataFrame, attrs: str, ranges: str, kinds: Column) -> DataFrame:
    """Queries with ``_route``: every key that a rule which accepts the query has, of the kinds there are (null: of any kind).

    Attributes, ranges and levels are exploded one after the other, which is compiled code; nested transforms of them are not.
    """
    none = F.struct(F.lit(None).cast("string").alias("key"), F.lit(None).cast("string").alias("value"))
    entries = lambda c: F.explode(F.concat(F.coalesce(F.map_entries(F.col(c).cast("map<string,string>")), F.array()), F.array(none)))
    any_level, ints = F.sequence(F.lit(0), F.lit(CELL_LEVELS - 1)), F.array().cast("array<int>")
    out = queries.withColumn("_kinds", kinds).withColumn("_e", entries(attrs)).withColumn("_r", entries(ranges))
    e, r, n, found = F.col("_e"), F.col("_r"), F.col("_n"), F.col("_kinds")
    levels = F.when(found.isNull(), any_level).otherwise(F.coalesce(F.try_element_at(found, _kind(e["key"], r["key"])), ints))
    free = F.when(e["key"].isNotNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    out = out.withColumn("_n", F.explode(F.when((F.size(levels) == 0) | r["key"].isNotNull(), levels).otherwise(free)))
    listed = F.when(e["key"].isNull(), F.lit("-")).otherwise(_route(e["key"], e["value"]))
    alone = F.when(e["key"].isNotNull(), F.lit("-")).otherwise(_route(F.lit("-"), n.cast("string")))
    right = F.when(r["key"].isNull(), alone).otherwise(_route(r["key"], _cell(r["value"].cast("bigint"), n)))
    return out.withColumn("_route", F.concat_ws("\u0002", listed, right)).drop("_kinds", "_e", "_r", "_n")


def _product(a: Column, b: Column) -> Column:
    return F.flatten(F.transform(a, lambda x: F.transform(b, lambda y: F.concat_ws("\u0002", x, y))))


def _digest(*values: Column) -> Column:
    """128 bits of a SHA-256: equal for equal values only, and short enough to be shuffled in their place."""
    return F.substring(F.unhex(F.sha2(F.to_json(F.struct(*values)), 256)), 1, 16)


def with_class(rules: DataFrame, rule_column: str) -> DataFrame:
    """Adds ``_class``, which equal rules share and no others."""
    return rules.withColumn("_class", _digest(F.col(rule_column).alias("rule")))


def rule_classes(rules: DataFrame, rule_column: str) -> DataFrame:
    """One row of each class of equal rules: ``_class`` and the rule."""
    return with_class(rules, rule_column).select("_class", rule_column).dropDuplicates(["_class"])


def _with_asked(queries: DataFrame, attrs: str, ranges: str) -> DataFrame:
    """Adds ``_asked``, which queries with equal maps share and no others."""
    return queries.withColumn("_asked", _digest(*[F.col(c).cast("map<string,string>").alias(f"m{i}") for i, c in enumerate((attrs, ranges))]))


def class_rows(df: DataFrame, name: str) -> float:
    """Rows of a class on average."""
    rows, classes = df.agg(F.count(F.lit(1)), F.approx_count_distinct(name)).first()
    return rows / max(1, classes)


def classes_of(rows: DataFrame, name: str, same: Sequence[str]) -> DataFrame:
    """One row of each class: ``name``, the columns ``same``, which are equal in it, and how many rows it has."""
    return cut(rows.groupBy(name).agg(*[F.first(c).alias(c) for c in same], F.count(F.lit(1)).alias("_count")))


def _row_hash(rows: DataFrame, columns: Sequence[str]) -> Column:
    """A hash of the columns without maps, which have no hash of their own; of their JSON text where all have maps."""
    plain = [c for c in columns if "map<" not in rows.schema[c].dataType.simpleString()]
    return F.xxhash64(*plain) if plain else F.xxhash64(F.to_json(F.struct(*columns)))


def _packed(rows: DataFrame, name: str, classes: DataFrame) -> DataFrame:
    """Rows of a class as arrays ``_rows`` of about ``PACK_ROWS`` each, without the columns that are equal in the class.

    A row's array goes by a hash of the row, so a task that runs again makes the same arrays.
    """
    own = [c for c in rows.columns if c not in classes.columns]
    one = F.struct(*own) if own else F.struct(F.lit(1).alias("_one"))
    packs = classes.select(name, F.ceil(F.col("_count") / PACK_ROWS).alias("_packs"))
    dealt = rows.join(small_side(packs), name).withColumn("_pack", F.pmod(_row_hash(rows, own or [name]), F.col("_packs")))
    return dealt.groupBy(name, "_pack").agg(F.collect_list(one).alias("_rows")).drop("_pack")


def _salted(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_salt", F.pmod(_row_hash(rows, rows.columns), F.lit(SALTS)).cast("int"))


def dealt_out(rows: DataFrame, parts: int) -> DataFrame:
    """Rows over ``parts`` tasks by their hash: evenly, and without the sort of a round robin."""
    return rows.withColumn("_deal", _row_hash(rows, rows.columns)).repartition(parts, "_deal").drop("_deal")


def _join_classes(rows: DataFrame, other: DataFrame, name: str, parts: int) -> DataFrame:
    """Salted rows with all of ``other`` of their class: a checked small side is broadcast, else each class is dealt over ``SALTS`` keys."""
    if is_small(other):
        return rows.join(F.broadcast(other), name)
    copies = other.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    key = [name, "_salt"]
    return rows.repartition(parts, *key).join(copies.repartition(parts, *key), key)


def join_members(rows: DataFrame, members: DataFrame, name: str, classes: DataFrame, parts: int, members_first: bool = False) -> DataFrame:
    """Rows of classes with each member of their class, without the class; members wait in arrays and are written out last.

    One row with one array is a unit of work, so a pair costs a step in a loop and no shuffle, sort or lookup of its own.
    """
    mine = [F.col(c) for c in rows.columns if c not in (name, "_salt")]
    same = {c: f"_same{i}" for i, c in enumerate(classes.columns) if c not in (name, "_count")}
    theirs = [(F.col(same[c]) if c in same else F.col("_row")[c]).alias(c) for c in members.columns if c != name]
    packed = cut(_packed(members, name, classes)).join(small_side(classes.select(name, *[F.col(c).alias(n) for c, n in same.items()])), name)
    met = _join_classes(rows if "_salt" in rows.columns else _salted(rows), packed, name, parts)
    return met.withColumn("_row", F.explode("_rows")).select(*(theirs + mine if members_first else mine + theirs))


def match_rules(
    rules: DataFrame, rule_column: str, queries: DataFrame, attrs: str, ranges: str, spread: int | None = None
) -> DataFrame:
    """All (query row, rule row) pairs where the rule accepts the query.

    One equality join on route keys finds the candidates and the whole rule is checked on
    them.  A key holds a value list and a range cell together, so the candidates are close
    to the result and a hot value is cut up by its ranges; what stays hot is split by the
    adaptive skew join.  ``queries`` may be a stream, ``rules`` a stored table: which kinds of
    key there are is part of the plan, so every batch asks for the kinds of that moment.

    Where many rules are equal, or many stored queries ask the same, classes of them are
    matched, and the pairs of classes are joined with their rows: first with the side of
    the smaller classes, last with the other, whose result nothing moves any more.

    Every query can meet many rules; ``spread`` deals rows that come in few partitions
    out over that many, or some times as many, before they are multiplied.
    """
    dealt = queries.repartition(spread) if spread else queries
    if queries.isStreaming:
        return _match_rows(rules, rule_column, dealt, attrs, ranges)
    ruled = rules.repartition(spread) if spread else rules
    held, asked = with_class(ruled, rule_column), _with_asked(dealt, attrs, ranges)
    held_rows, asked_rows = class_rows(held, "_class"), class_rows(asked, "_asked")
    if max(held_rows, asked_rows) < CLASS_ROWS:
        return _match_rows(rules, rule_column, dealt, attrs, ranges)
    rule_kinds, query_kinds = classes_of(held, "_class", [rule_column]), classes_of(asked, "_asked", [attrs, ranges])
    pairs = cut(match_classes(rule_kinds.select(rule_column), rule_column, query_kinds.select(attrs, ranges), attrs, ranges))
    parts = TASKS_A_CORE * (spread or queries.sparkSession.sparkContext.defaultParallelism)
    if held_rows < asked_rows:
        rows = _join_classes(_salted(with_class(rules.repartition(parts), rule_column)), pairs, "_class", parts).drop("_class")
    else:
        rows = _join_classes(_salted(_with_asked(queries.repartition(parts), attrs, ranges)), pairs, "_asked", parts).drop("_asked")
    # moves nothing, but ends a step: else a task holds all pairs of a row at a time, not those with one class
    rows = rows.coalesce(parts)
    if held_rows < asked_rows:
        return join_members(rows, asked, "_asked", query_kinds, parts, members_first=True)
    return join_members(rows, held, "_class", rule_kinds, parts)


def match_classes(rules: DataFrame, rule_column: str, queries: DataFrame, attrs: str, ranges: str) -> DataFrame:
    """``(_asked, _class)``: which class of queries is accepted by which class of rules."""
    asked = _with_asked(queries, attrs, ranges).select("_asked", F.col(attrs).alias("_attrs"), F.col(ranges).alias("_ranges")).dropDuplicates(["_asked"])
    return _match_rows(rule_classes(rules, rule_column), rule_column, asked, "_attrs", "_ranges").select("_asked", "_class")


def _match_rows(rules: DataFrame, rule_column: str, queries: DataFrame, attrs: str, ranges: str) -> DataFrame:
    keyed = _keyed(rules, rule_column)
    asked = _query_routes(queries, attrs, ranges, _kinds(keyed))
    # a rule's keys differ from each other and so do a query's: no pair meets twice
    pairs = asked.join(_routed(keyed, rule_column, rules.columns), "_route")
    holds = (F.size("_rest") == 0) | rule_holds("_rest", F.col(attrs), F.col(ranges))
    return pairs.where(holds).drop("_route", "_rest")


# -- user queries -------------------------------------------------------------------------------


def user_query(field: Column | str, query: str, kind: str = "weakAnd", an: Analyzer = DEFAULT) -> Column:
    """Match condition of a bag of plain words: ``and``/``all``, ``or``/``any``/``weakAnd`` or ``phrase``."""
    if kind in ("and", "all"):
        return tx.text_match(field, query, an)
    if kind in ("or", "any", "weakAnd"):
        return tx.equiv(field, an.terms(query), an)
    if kind == "phrase":
        return tx.phrase(field, query, an)
    raise ValueError(f"unknown query type {kind!r}")


def user_input(
    query: str | None,
    default_field: Column | str,
    grammar: str = "weakAnd",
    language: str | None = None,
    language_column: Column | str | None = None,
    allow_empty: bool = False,
    an: Analyzer = DEFAULT,
) -> Column:
    """A query parameter with its grammar, default field and language."""
    if not an.terms(query or ""):
        if not allow_empty:
            raise ValueError("empty user input")
        return F.lit(True)
    cond = user_query(default_field, query, grammar, an)
    if language and language_column is not None:
        cond = (as_col(language_column) == language) & cond
    return cond


def match_queries(
    docs: DataFrame, key: str, field: str, queries: DataFrame, query_key: str, query: str, an: Analyzer = DEFAULT
) -> DataFrame:
    """All-terms match of many query rows at once: ``(query_key, key, terms)``.

    Documents are cut to their distinct query-vocabulary tokens before anything is
    shuffled.  Each query is routed by its rarest term only, so a word found in a third
    of all texts makes no candidates unless a query has no rarer one; the remaining terms
    are checked on the candidate's own token set.
    """
    asked = queries.select(query_key, F.array_distinct(tx.tokens(query, an)).alias("_terms")).where(F.size("_terms") > 0)
    vocabulary = asked.select(F.explode("_terms").alias("_term")).distinct()
    pairs = docs.select(key, F.explode(F.array_distinct(tx.tokens(field, an))).alias("_term"))
    # used three times below, so the texts are tokenised once and the pairs kept
    known = cut(pairs.join(small_side(vocabulary), "_term", "left_semi"))
    df_count = known.groupBy("_term").agg(F.count(F.lit(1)).alias("_df"))
    # terms no document has stay with count 0 and make their query empty
    rarest = (
        asked.select(query_key, "_terms", F.explode("_terms").alias("_term"))
        .join(df_count, "_term", "left")
        .groupBy(query_key)
        .agg(F.min(F.struct(F.coalesce("_df", F.lit(0)).alias("n"), F.col("_term").alias("t"))).alias("_best"))
    )
    routed = asked.join(rarest, query_key).select(query_key, "_terms", F.col("_best")["t"].alias("_term"))
    token_sets = known.groupBy(key).agg(F.collect_set("_term").alias("_have"))
    return (
        known.join(routed, "_term")
        .join(token_sets, key)
        .where(F.size(F.array_except("_terms", "_have")) == 0)
        .select(query_key, key, F.size("_terms").alias("terms"))
    )
