"""Token predicates against plain Python on random texts, and hand-made cases."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lodestone.functions import text as tx
from lodestone.operators import matching, ranking
from lodestone.plans import REGISTRY
from lodestone.plans.registry import Tables

WORDS = ["ab", "abc", "b", "c", "ä1", "x"]
SEPARATORS = [" ", ", ", "\n", "--", " . "]


def toks(s):
    return [t for t in re.split(r"[\W_]+", s.lower()) if t]


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        n = rng.randint(0, 12)
        s = "".join(rng.choice([w, w.upper()]) + rng.choice(SEPARATORS) for w in rng.choices(WORDS, k=n))
        rows.append((i, rng.choice(["", "(", "a"]) + s))
    return rows, spark.createDataFrame(rows, "id int, s string").repartition(4).cache()


def found(df, cond):
    return {r[0] for r in df.where(cond).select("id").collect()}


def near(ts, q, d, ordered):
    def go(i, last, first):
        if i == len(q):
            return True
        return any(
            ts[p] == q[i] and (last < p or not ordered) and go(i + 1, p, p if first is None else first)
            for p in range(len(ts))
            if not ordered or first is None or p - first <= d
        )

    if ordered:
        return go(0, -1, None)
    return any(set(q) <= set(ts[p : p + d + 1]) for p in range(len(ts)))


@pytest.mark.parametrize("q", [["ab"], ["b", "c"], ["ab", "ab"], ["b", "b", "x"], ["ä1", "abc"]])
def test_phrase(texts, q):
    rows, df = texts
    want = {i for i, s in rows if any(toks(s)[p : p + len(q)] == q for p in range(len(toks(s))))}
    assert want and found(df, tx.phrase("s", q)) == want


@pytest.mark.parametrize("d", [0, 1, 2, 4])
@pytest.mark.parametrize("q", [["ab", "c"], ["x", "b", "ä1"], ["abc", "ab"]])
def test_near(texts, q, d):
    rows, df = texts
    assert found(df, tx.near("s", q, d)) == {i for i, s in rows if near(toks(s), q, d, False)}


@pytest.mark.parametrize("d", [1, 2, 3, 5])
@pytest.mark.parametrize("q", [["ab", "c"], ["x", "b", "ä1"], ["b", "b"], ["c", "ab", "x", "b"]])
def test_onear(texts, q, d):
    rows, df = texts
    assert found(df, tx.onear("s", q, d)) == {i for i, s in rows if near(toks(s), q, d, True)}


@pytest.mark.parametrize("d", [1, 3, 5, 9, 14])
@pytest.mark.parametrize("q", [["ab", "c"], ["b", "b"], ["x", "b", "ä1"], ["c", "ab", "x", "b"], ["b", "c", "b", "x", "ab"]])
def test_onear_by_windows(texts, q, d, monkeypatch):
    """The form of long chains, also where the other form would do."""
    monkeypatch.setattr(tx, "MOST_SPLITS", 0)
    rows, df = texts
    assert found(df, tx.onear("s", q, d)) == {i for i, s in rows if near(toks(s), q, d, True)}


def test_long_onear_stays_a_small_plan(texts):
    _, df = texts
    plan = df.where(tx.onear("s", ["b", "c", "ab", "x", "b", "c"], 40))._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 3_000


def test_onear_over_lines_and_nulls(spark):
    rows = [(1, "one\n\ntwo; three"), (2, "one x one two three"), (3, "three two one"), (4, None), (5, ""), (6, "one twos two\nthree" + " w" * 30_000)]
    df = spark.createDataFrame(rows, "id int, s string")
    want = {2: set(), 3: {1, 2, 6}, 10: {1, 2, 6}}
    for d, ids in want.items():
        for splits in (0, 100):
            old, tx.MOST_SPLITS = tx.MOST_SPLITS, splits
            try:
                assert found(df, tx.onear("s", ["one", "two", "three"], d)) == (ids or {1, 2})
            finally:
                tx.MOST_SPLITS = old


def test_bag_predicates(texts):
    rows, df = texts
    has = lambda *q: {i for i, s in rows if set(q) <= set(toks(s))}
    assert found(df, tx.text_match("s", "C, ab")) == has("ab", "c")
    assert found(df, tx.equiv("s", ["c", "ä1"])) == has("c") | has("ä1")
    assert found(df, tx.equiv("s", ["b c", "x"])) == found(df, tx.phrase("s", "b c")) | has("x")
    assert found(df, matching.user_query("s", "b x", "all")) == has("b", "x")
    counts = {r[0]: r[1] for r in df.select("id", tx.term_count("s", "ab")).collect()}
    assert counts == {i: toks(s).count("ab") for i, s in rows}
    lengths = {r[0]: r[1] for r in df.select("id", tx.token_count("s")).collect()}
    assert lengths == {i: len(toks(s)) for i, s in rows}


def one(spark, value, *cols):
    return spark.createDataFrame([(value,)], "s string").select(*cols).first()


def test_analyzer_agrees_with_columns(spark):
    an = tx.Analyzer(fold_accents=True, stem=True)
    s = "Les Éléves' boxes; flies dies buses glass ponies, is AEs aies goes"
    assert one(spark, s, tx.tokens("s", an))[0] == an.terms(s)
    assert an.terms("ponies boxes buses glass") == ["pony", "boxe", "buse", "glass"]


def test_hand_made(spark):
    r = one(
        spark, "The thE other, the-end",
        tx.highlight("s", ["the"]), F.array_join(tx.grams("s", 30), ","), tx.fuzzy("s", "othr", 1, 2), tx.fuzzy("s", "zthr", 2, 1),
    )
    assert r[0] == "<b>The</b> <b>thE</b> other, <b>the</b>-end"
    assert r[1] == "" and r[2] and not r[3]
    assert one(spark, "cardamom", tx.fuzzy_value("s", "cradamom", 2))[0]
    url = "https://user:pw@www.example.com:80/en/shop?x=1"
    got = one(
        spark, url, tx.uri("s", "www.example", start_anchor=True), tx.uri("s", "example.com", start_anchor=True),
        tx.uri("s", "example.com", end_anchor=True), tx.uri("s", "com/80", end_anchor=True), tx.uri("s", "en shop"),
        tx.uri("s", "www.example.com", True, True),
    )
    assert list(got) == [True, False, True, False, True, True]


def test_empty_query_is_an_error(spark):
    with pytest.raises(ValueError):
        tx.contains("s", " .. ")
    with pytest.raises(ValueError):
        matching.user_input("", "s")


def test_weak_and_and_its_replacement(spark):
    names = spark.createDataFrame([(1, "Wireless Mouse"), (2, "Wireless Keyboard"), (3, "Wired Mouse"), (4, "Hub")], "id int, name string")
    got = ranking.weak_and(names, "id", "name", ["wireless", "mouse"])
    assert {r["id"] for r in got.collect()} == {1, 2, 3}
    assert got.orderBy(F.col("relevance").desc()).first()["id"] == 1
    both = ranking.weak_and(names, "id", "name", ["wireless", "mouse"], replace_by_and=True)
    assert [r["id"] for r in both.collect()] == [1]


def test_match_queries_brute_force(spark, texts):
    rows, df = texts
    queries = [(0, "ab c"), (1, "x"), (2, ""), (3, "nowhere b"), (4, "B b ä1")]
    got = matching.match_queries(df, "id", "s", spark.createDataFrame(queries, "q int, t string"), "q", "t")
    want = {(q, i) for q, t in queries if toks(t) for i, s in rows if set(toks(t)) <= set(toks(s))}
    pairs = [(r["q"], r["id"]) for r in got.collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == want


def test_whole_turns_are_queries(spark, folder):
    t = Tables(spark, folder)
    asked = [r for n in ("P26_non_empty_whole", "P26_empty_queries_whole") for r in REGISTRY[n].build(t).collect()]
    assert sorted((r.conv_id, r.turn, r.q or "") for r in asked) == sorted((r.conv_id, r.turn, r.text or "") for r in t.conversations.collect())
