"""Fuzzy terms by deletion keys against plain edit distances."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from lodestone.operators import fuzzy


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def words(rng, n, longest):
    return ["".join(rng.choices("abé", k=rng.randrange(1, longest))) for _ in range(n)]


@pytest.mark.parametrize(("max_edits", "prefix"), [(0, 0), (1, 0), (2, 0), (2, 1), (1, 3), (3, 0)])
def test_near_tokens(spark, max_edits, prefix):
    rng = random.Random(max_edits * 10 + prefix)
    base = "".join(rng.choices("abcdefgh", k=40))  # longer than the head that keys are made of
    edited = [base[:i] + base[i + 1 :] for i in (0, 5, 20, 39)] + [base[:30] + "xy" + base[30:], "z" + base[1:], base[1:39]]
    tokens, terms = {*words(rng, 150, 8), *edited, "a" * 5000}, {*words(rng, 25, 8), base, "b" * 14}
    got = fuzzy.near_tokens(
        spark.createDataFrame([(t,) for t in tokens], "token string"), spark.createDataFrame([(t,) for t in [*terms, None]], "term string"), max_edits, prefix
    )
    near = {(a, b): edits(a, b) for a, b in itertools.product(terms, tokens) if abs(len(a) - len(b)) <= max_edits and b.startswith(a[:prefix])}
    assert {(r.term, r.token): r.edits for r in got.collect()} == {p: n for p, n in near.items() if n <= max_edits}


def test_rows_are_met_by_equal_tokens_only(spark):
    rows = [(1, "a wide gadget"), (2, "GADGTE, gadgets"), (3, None), (4, ""), (5, "budget"), (None, "gadge"), (2, "twice gadgte")]
    df = spark.createDataFrame(rows, "id long, text string").withColumn("n", F.lit(1))
    for prefix in (0, 1):
        hits = fuzzy.fuzzy_hits(df, "id", "text", ["gadget"], 2, prefix)
        want = [(1, "gadget", 0), (2, "gadgets", 1), (2, "gadgte", 2), (None, "gadge", 1), *([] if prefix else [(5, "budget", 2)])]
        assert sorted(((r.id, r.token, r.edits) for r in hits.collect()), key=str) == sorted(want, key=str)
    found = fuzzy.fuzzy_match(df, "id", "text", ["gadget"], 1, 1)
    assert found.columns == df.columns and sorted(r.id for r in found.collect()) == [1, 2, 2]
    plan = fuzzy.fuzzy_match(df, "id", "text", ["gadget"], 1, 1)._jdf.queryExecution().toString()
    assert "levenshtein" not in plan  # it is measured on the vocabulary before, not on the rows' tokens
    words = fuzzy.vocabulary(df, "text")
    assert fuzzy.fuzzy_match(df, "id", "text", ["gadget"], 1, words=words).count() == 3


def test_empty_inputs(spark):
    df = spark.createDataFrame([], "id long, text string")
    assert fuzzy.fuzzy_match(df, "id", "text", ["gadget"]).count() == 0
    with pytest.raises(ValueError):
        fuzzy.fuzzy_match(df, "id", "text", ["..."])
