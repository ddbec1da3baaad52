"""Nearest neighbours against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.functions import vectors as vx
from lodestone.operators import neighbours

METRICS = ["euclidean", "angular", "prenormalized", "dotproduct"]


def score(metric, q, b):
    if metric == "euclidean":
        return np.sqrt(((b - q) ** 2).sum(1))
    if metric == "angular":
        return 1 - b @ q / np.linalg.norm(b, axis=1) / np.linalg.norm(q)
    return 1 - b @ q if metric == "prenormalized" else -(b @ q)


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(1)
    m = rng.standard_normal((300, 6)).round(1)
    m[200:] = m[:100]  # copies: ties must go by id
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "id bigint, v array<double>").repartition(5)
    return m, df.cache()


def test_ties_go_by_id(spark):
    df = spark.createDataFrame([(9, [0.5, 2.0]), (4, [3.0, 0.5]), (6, [0.5, 2.0]), (1, None)], "id int, v array<double>")
    assert [r["id"] for r in neighbours.nearest(df, "id", "v", [0.5, 1.0], 2).collect()] == [6, 9]


@pytest.mark.parametrize("metric", METRICS)
def test_exact(vectors, metric):
    m, df = vectors
    d = score(metric, m[7], m)
    want = list(np.lexsort((np.arange(len(m)), d.round(9)))[:12])
    assert [r["id"] for r in neighbours.nearest(df, "id", "v", list(m[7]), 12, metric).collect()] == want


def test_long_and_column_vectors(spark):
    v = [float(i % 7) for i in range(vx.UNROLL + 40)]
    df = spark.createDataFrame([(v, [x + 1 for x in v])], "a array<double>, b array<double>")
    r = df.select(vx.squared_euclidean("a", [x + 1 for x in v]), vx.euclidean("a", F.col("b")), vx.dot("a", F.col("b"))).first()
    assert r[0] == len(v) and r[1] == pytest.approx(len(v) ** 0.5) and r[2] == pytest.approx(sum(x * (x + 1) for x in v))
    bits = df.select(vx.hamming(vx.sign_bits("a", len(v)), vx.pack_signs([-1.0] * len(v))), vx.hamming(vx.sign_bits("a", len(v)), vx.sign_bits("b", len(v)))).first()
    assert bits[0] == sum(x > 0 for x in v) and bits[1] == sum(x == 0 for x in v)


def test_recall_and_folders_of_buckets(spark, folder, tmp_path):
    emb = spark.read.parquet(f"{folder}/embeddings.parquet").unionByName(spark.createDataFrame([(-1, None, 0)], "vec_id long, embedding array<float>, label int"))
    planes = neighbours.hyperplanes(64, bits=4, tables=6)
    path = str(tmp_path / "buckets")
    neighbours.write_buckets(emb, "embedding", planes, path)
    stored, columns = spark.read.parquet(path), neighbours.with_buckets(emb, "embedding", planes).cache()
    rows = emb.where("vec_id >= 0").limit(15).collect()
    hit = 0
    for r in rows:
        exact = {x["vec_id"] for x in neighbours.nearest(emb, "vec_id", "embedding", r["embedding"], 10).collect()}
        found = neighbours.nearest_in_buckets(stored, "vec_id", "embedding", r["embedding"], planes, 10)
        near = [x["vec_id"] for x in found.collect()]
        assert near == [x["vec_id"] for x in neighbours.nearest_approximate(columns, "vec_id", "embedding", r["embedding"], planes, 10).collect()]
        hit += len(exact & {*near})
    assert hit / (10 * len(rows)) >= 0.9
    plan = found._jdf.queryExecution().toString()
    assert "PartitionFilters: [((" in plan and "bucket_table" in plan.split("PartitionFilters")[1][:200] and "Python" not in plan
    # the codes are those of a plain matrix product
    m = {r["vec_id"]: np.array(r["embedding"], "f8") for r in emb.where("vec_id >= 0").collect()}
    for r in columns.where("vec_id >= 0").limit(50).collect():
        assert [r[f"bucket_{t}"] for t in range(6)] == [sum(1 << i for i, x in enumerate(p @ m[r["vec_id"]]) if x > 0) for p in planes]
