"""Bulk updates and puts as data."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lodestone.operators import bulk, writes

BASE = "id string, n bigint, q tinyint, d decimal(10,2), x double, tags array<string>, w map<string,int>, t array<double>, s struct<a:int,b:struct<c:string>>, name string, day date"
ROWS = [
    ("a", 9007199254740993, 100, "1.25", 2.0, ["p", "q", "p"], {"k": 1, "j": 2}, [1.0, 2.0], (1, ("u",)), "N", None),
    ("b", None, None, None, None, None, None, None, None, None, None),
]
UPDATES = "id string, field string, op string, value string, at string, condition string"


@pytest.fixture(scope="module")
def base(spark):
    rows = [(i, n, q, d and Decimal(d), *rest) for i, n, q, d, *rest in ROWS]
    return spark.createDataFrame(rows, BASE)


def update(spark, base, *rows, **options):
    ups = spark.createDataFrame([(*r, *[None] * (6 - len(r))) for r in rows], UPDATES)
    known = sorted({r[1] for r in rows} & {*base.columns})
    out = bulk.bulk_update(base, ups, "id", known, **options)
    return {r.id: r.asDict(recursive=True) for r in out.state.collect()}, sorted((r.id, r.message, r.status) for r in out.errors.collect())


OPERATIONS = [
    ("n", "increment", "1", None, 9007199254740994), ("n", "multiply", "3", None, 27021597764222979), ("n", "divide", "1", None, 9007199254740993),
    ("n", "decrement", "-2", None, 9007199254740995), ("q", "divide", "3", None, 33), ("q", "multiply", "0.5", None, 50),
    ("d", "increment", "0.10", None, Decimal("1.35")), ("x", "divide", "8", None, 0.25), ("n", "assign", "7", None, 7),
    ("n", "clear", None, None, None), ("name", "assign", "plain text", None, "plain text"), ("day", "assign", "2024-02-03", None, datetime.date(2024, 2, 3)),
    ("tags", "add", '["p", "z"]', None, ["p", "q", "p", "p", "z"]), ("tags", "remove", '["p"]', None, ["q"]), ("tags", "assign", '["m"]', None, ["m"]),
    ("tags", "assign", "Q", "1", ["p", "Q", "p"]), ("tags", "clear", None, "0", [None, "q", "p"]),
    ("w", "add", '{"k": 9, "n": 4}', None, {"j": 2, "k": 9, "n": 4}), ("w", "remove", '["k"]', None, {"j": 2}), ("w", "increment", "5", "j", {"k": 1, "j": 7}),
    ("w", "assign", "8", "new", {"k": 1, "j": 2, "new": 8}), ("w", "remove", None, "j", {"k": 1}), ("w", "modify_add", '{"k": 1, "no": 3}', None, {"k": 2, "j": 2}),
    ("t", "modify_add", '{"1": 0.5, "9": 3}', None, [1.0, 2.5]), ("t", "modify_multiply", '{"0": 4}', None, [4.0, 2.0]), ("t", "modify_replace", '{"0": 7}', None, [7.0, 2.0]),
    ("t", "multiply", "3", "1", [1.0, 6.0]), ("s", "increment", "2", "a", {"a": 3, "b": {"c": "u"}}), ("s", "assign", "v", "b.c", {"a": 1, "b": {"c": "v"}}),
    ("s", "assign", '{"a": 5, "b": {"c": "w"}}', None, {"a": 5, "b": {"c": "w"}}),
]


def test_every_operation(spark, base):
    """Each on a copy of one document."""
    one = base.where("id = 'a'").drop("id").join(spark.range(len(OPERATIONS)).select(F.col("id").cast("string")), how="cross").select(*base.columns)
    state, errors = update(spark, one, *[(str(i), *x[:4]) for i, x in enumerate(OPERATIONS)])
    assert errors == []
    before = base.where("id = 'a'").first().asDict(recursive=True)
    for i, (field, op, _, _, want) in enumerate(OPERATIONS):
        assert state[str(i)] == {**before, "id": str(i), field: want}, (field, op)


def test_each_row_that_cannot_be_applied_is_an_error(spark, base):
    bad = [("n", "increment", "abc"), ("n", "bogus", "1"), ("nothing", "assign", "1"), ("tags", "add", "no json"), ("tags", "increment", "1"), ("w", "remove", "7"),
           ("t", "assign", "x", "0"), ("tags", "assign", "x", "first"), ("s", "assign", "1", "b.none"), ("q", "divide", "0"), (None, "assign", "1"), ("n", None, "1")]
    state, errors = update(spark, base, *[("a", *r) for r in bad], ("a", "name", "assign", "changed"))
    assert len(errors) == len(bad) and {e[2] for e in errors} == {400}
    assert ("a", "operand of increment does not fit", 400) in errors and ("a", "unknown operation bogus", 400) in errors
    assert state["a"]["name"] == "N"  # a document is changed by all of its rows or by none
    state, errors = update(spark, base, ("a", "q", "increment", "100"), ("b", "q", "assign", "4"), ("c", "q", "assign", "4"))
    assert errors == [("a", "result out of range", 400), ("c", "document does not exist", 412)] and (state["a"]["q"], state["b"]["q"]) == (100, 4)


def test_conditions_by_document(spark, base):
    conditions = {"large": F.col("n") > 5, "named": F.col("name") == "N"}
    rows = [("a", "q", "increment", "1", None, "large"), ("a", "x", "assign", "9", None, "named"), ("b", "q", "assign", "1", None, "large")]
    state, errors = update(spark, base, *rows, conditions=conditions)
    assert (state["a"]["q"], state["a"]["x"], state["b"]["q"]) == (101, 9.0, None) and errors == [("b", "condition not met", 412)]
    _, errors = update(spark, base, ("a", "q", "increment", "1", None, "other"), conditions=conditions)
    assert errors == [("a", "unknown condition", 400)]


def test_variant_operands_and_new_documents(spark, base):
    ups = spark.createDataFrame([("a", "n", "increment", "1"), ("a", "tags", "add", '["z"]'), ("z", "name", "assign", '"new"')], "id string, field string, op string, j string")
    out = bulk.bulk_update(base, ups.withColumn("value", F.parse_json("j")), "id", ["n", "tags", "name"], create_if_missing=True)
    got = {r.id: r for r in out.state.collect()}
    assert (got["a"].n, got["a"].tags, got["z"].name, got["z"].n) == (9007199254740994, ["p", "q", "p", "z"], "new", None) and out.errors.count() == 0


def test_puts_fail_change_by_change(spark):
    base = spark.createDataFrame([("a", 1.0), ("b", 500.0)], "id string, price double")
    ch = spark.createDataFrame(
        [("a", 2.0, 1, "dear"), ("a", 3.0, 2, "dear"), ("a", 4.0, 3, "dear"), ("b", 5.0, 1, "dear"), ("c", 6.0, 1, None), ("a", -1.0, 4, None), ("d", 1.0, 1, "what")],
        "id string, price double, _seq int, condition string",
    )
    out = writes.bulk_put(base, ch, "id", valid=F.col("price") > 0, conditions={"dear": F.col("price") > 100})
    assert {tuple(r) for r in out.state.collect()} == {("a", 1.0), ("b", 5.0), ("c", 6.0)}
    errors = sorted(tuple(r) for r in out.errors.collect())
    assert errors == [("a", "condition not met", 412)] * 3 + [("a", "invalid document", 400), ("d", "unknown condition", 400)]
    assert tuple(writes.feed_summary(ch, out.errors).first())[:3] == (7, 2, 5)
