"""Ids, JSONL, extra fields, tensors, column sets."""

import json
import re

import pytest
from pyspark.sql import functions as F

from lodestone.functions import ids, vectors as vx
from lodestone.session import scratch_path
from lodestone.sources import extra, jsonl, tables


def test_ids(spark):
    df = spark.createDataFrame([("id:ns:t::x",), ("id:ns:t:g=a:u:v:w",), ("plain",), ("id:too:short",)], "d string")
    got = [r[0] for r in df.select(ids.user_part("d")).collect()]
    assert got == ["x", "u:v:w", "plain", "id:too:short"]
    assert df.select(ids.id_parts("d")["location"]).collect()[1][0] == "g=a"


def test_tensor_layouts(spark):
    cases = {
        "[0.25, -6, 11]": [({}, [0.25, -6.0, 11.0])],
        "[[8,6],[4,2]]": [({}, [8.0, 6.0, 4.0, 2.0])],
        '{"values": [[0.5, 12.0], [13.0, 14.5]]}': [({}, [0.5, 12.0, 13.0, 14.5])],
        '{"fern": 31, "moss": -7}': [({"x": "fern"}, [31.0]), ({"x": "moss"}, [-7.0])],
        '{"cells": {"reed": 19}}': [({"x": "reed"}, [19.0])],
        '{"elm": [21, 22], "oak": [23, 24]}': [({"x": "elm"}, [21.0, 22.0]), ({"x": "oak"}, [23.0, 24.0])],
        '{"blocks": {"ivy": [-1, -3]}}': [({"x": "ivy"}, [-1.0, -3.0])],
        '{"blocks": [{"address": {"row": "r7", "col": "c9"}, "values": [0.75, 0]}]}': [({"row": "r7", "col": "c9"}, [0.75, 0.0])],
        '[{"address": {"row": "r2", "col": "5"}, "value": 66}]': [({"row": "r2", "col": "5"}, [66.0])],
        '{"cells": [{"address": {"tree": "yew"}, "value": 17}]}': [({"tree": "yew"}, [17.0])],
    }
    df = spark.createDataFrame([(k,) for k in cases], "j string")
    for r in df.select("j", vx.tensor_cells("j").alias("c")).collect():
        assert [(c["address"], c["values"]) for c in r["c"]] == cases[r["j"]], r["j"]
    assert df.limit(1).select(vx.tensor_dense("j")).first()[0] == [0.25, -6.0, 11.0]


def test_tensor_types():
    assert vx.tensor_type("tensor<float>(x{},y[2])") == ("float", {"x": None, "y": 2})
    assert vx.tensor_type("tensor(x[3])") == ("double", {"x": 3})
    assert vx.tensor_type_text(*vx.tensor_type("tensor<int8>(a[4])")) == "tensor<int8>(a[4])"
    for bad in ["tensor<long>(x[1])", "tensor(x[1],x[2])", "vector(x[1])", "tensor(x)"]:
        with pytest.raises(ValueError):
            vx.tensor_type(bad)


def test_shape_check(spark):
    df = spark.createDataFrame([([1.0, -128.0],), ([1.5, 2.0],), ([1.0, 128.0],), ([1.0],), (None,)], "v array<double>")
    assert [r[0] for r in df.select(vx.shape_ok("v", "tensor<int8>(x[2])")).collect()] == [True, False, False, False, False]


def test_jsonl_lines(spark):
    lines = [
        '{"put":"id:n:t::1","fields":{"a":1,"s":"x"}}', '{"id":"id:n:t::2","fields":{"a":2}}', '{"remove":"id:n:t::3"}',
        '{"continuation":{"token":"abc"}}', "{broken", "", "[1]",
    ]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    schema = spark.createDataFrame([], "a int, s string").schema
    got = [tuple(r) for r in jsonl.parse_lines(df, schema).collect()]
    assert got == [("id:n:t::1", "1", "put", 1, "x"), ("id:n:t::2", "2", "put", 2, None), ("id:n:t::3", "3", "remove", None, None)]


def test_extra_fields_round_trip(spark):
    docs = ['{"weight":0.75,"legs":4,"note":"a \\"b\\"","box":{"w":[3,9]},"odd \\"key\\"\\\\":1}', '{"legs":6}', "{broken"]
    declared = {"weight": "double", "legs": "int"}
    df = spark.createDataFrame([(d,) for d in docs], "doc string")
    got = extra.capture_extra(df, "doc", declared)
    flat = got.select("weight", "legs", "extra", extra.flat_json({"weight": F.col("weight"), "legs": F.col("legs")}, "extra").alias("flat")).collect()
    assert flat[0]["weight"] == 0.75 and flat[0]["legs"] == 4 and set(flat[0]["extra"]) == {"note", "box", 'odd "key"\\'}
    assert json.loads(flat[0]["flat"]) == json.loads(docs[0])
    again = extra.capture_extra(spark.createDataFrame([(flat[0]["flat"],)], "doc string"), "doc", declared).first()
    assert again["extra"] == flat[0]["extra"] and again["weight"] == 0.75
    assert flat[1]["flat"] == '{"legs":6}' and flat[2]["legs"] is None


def test_columns_and_types(spark):
    doc = tables.DocType("d", "id", {"s": tables.Summary(["a"]), "t": tables.Summary(["b", "a"], inherits="s")})
    assert tables.columns_of(doc, "t", []) == ["a", "b"]
    assert tables.columns_of(doc, "d:x, y", []) == ["x", "y"]
    with pytest.raises(ValueError):
        tables.columns_of(doc, "other:x", [])


def test_located_reads_one_folder(spark):
    path = scratch_path(spark, "loc")
    df = spark.range(2000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("user"))
    tables.write_located(df, path, "user", "id", 8)
    got = tables.read_located(spark, path, "hot")
    assert got.count() == 667 and tables.read_located(spark, path).count() == 2000
    plan = got._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^\n]*_loc#", plan)
    first = scratch_path(spark, "loc")  # the location is the first column: the key still cuts the hot one
    tables.write_located(df.select("user", "id"), first, "user", "id", 8)
    files = spark.read.parquet(first).where("user = 'hot'").select(F.input_file_name()).distinct().count()
    assert files > 1
