"""The many-query join against all pairs in memory."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.functions.predicates import EARTH_KM
from lodestone.operators import knn
from lodestone.operators.neighbours import nearest_join


def distance(metric, q, b):
    if metric == "euclidean":
        return np.linalg.norm(b - q, axis=1)
    if metric == "hamming":
        return np.array([sum(bin((int(x) ^ int(y)) & (1 << 64) - 1).count("1") for x, y in zip(q, r)) for r in b], "f8")
    if metric == "geodesic":
        (lat, lng), (lat2, lng2) = np.radians(q), np.radians(b).T
        a = np.sin((lat2 - lat) / 2) ** 2 + np.cos(lat) * np.cos(lat2) * np.sin((lng2 - lng) / 2) ** 2
        return 2 * EARTH_KM * np.arcsin(np.sqrt(np.minimum(a, 1)))
    if metric == "angular":
        with np.errstate(invalid="ignore", divide="ignore"):
            return 1 - b @ q / np.linalg.norm(b, axis=1) / np.linalg.norm(q)
    return -(b @ q) if metric == "dotproduct" else 1 - b @ q


def vectors(metric, n, seed):
    rng = np.random.default_rng(seed)
    if metric == "hamming":
        return rng.integers(-(1 << 62), 1 << 62, (n, 2))
    if metric == "geodesic":
        return np.column_stack([rng.uniform(-90, 90, n), rng.uniform(-180, 180, n)])
    centres = rng.standard_normal((9, 6)) * 8
    return centres[rng.integers(0, 9, n)] + rng.standard_normal((n, 6)).round(2)


def odd(metric):
    if metric == "hamming":
        return [None, [1], [None, 3]]
    long = 2 if metric == "geodesic" else 6
    return [None, [1.0] * (long - 1), [1.0, *[None] * (long - 1)], [float("nan")] * long, [float("inf")] * long]


@pytest.mark.parametrize("shipped", [True, False])
@pytest.mark.parametrize("metric", knn.METRICS)
def test_all_pairs(spark, metric, shipped, monkeypatch):
    base, asked = vectors(metric, 500, 1), vectors(metric, 120, 2)
    base[300:] = base[299]  # one vector holds two rows of five
    if metric not in ("hamming", "geodesic"):
        base[7] = asked[3] = 0
    kind = "bigint" if metric == "hamming" else "double"
    cast = int if metric == "hamming" else float
    rows = [(f"b{i:03}", [cast(x) for x in v]) for i, v in enumerate(base)]
    rows = rows[:1] + [(f"x{i}", v) for i, v in enumerate(odd(metric))] + [(None, rows[0][1])] + rows[1:]
    b = spark.createDataFrame(rows, f"id string, v array<{kind}>").withColumns({"cell": F.lit(1), "q_id": F.lit("x")}).coalesce(1)
    q = spark.createDataFrame([(i, [cast(x) for x in v]) for i, v in enumerate(asked)] + [(1000 + i, v) for i, v in enumerate(odd(metric))], f"id long, v array<{kind}>").repartition(3)
    monkeypatch.setattr(knn, "QUERY_ROWS", 50)
    got = {}
    for r in nearest_join(b, "id", "v", q, "id", "v", 7, metric, broadcast_rows=1000 if shipped else 0, cell_rows=60).collect():
        got.setdefault(r.query_id, []).append((r.hit_rank, r.neighbour_id, -r.distance if metric == "dotproduct" else r.distance))
    want = {}
    for i, v in enumerate(asked):
        d = distance(metric, v, base)
        keep = np.flatnonzero(~np.isnan(d))
        if len(keep):
            want[i] = sorted((float(d[j]), j) for j in keep)[:7]
    assert set(got) == set(want)
    for i, hits in got.items():
        hits.sort()
        assert [h[0] for h in hits] == list(range(1, 8))
        assert [h[2] for h in hits] == pytest.approx([d for d, _ in want[i]], abs=1e-9)
        ids = [h[1] for h in hits]
        # ids are told by distance, up to rounding
        assert len({*ids}) == 7 and [distance(metric, asked[i], base[[int(x[1:])]])[0] for x in ids] == pytest.approx([d for d, _ in want[i]], abs=1e-9)
        if metric in ("hamming", "euclidean"):
            assert ids == [f"b{j:03}" for _, j in want[i]]


def test_far_from_the_origin(spark):
    m = np.random.default_rng(5).uniform(0, 1, (400, 4)) + 1e6
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "id int, v array<double>")
    got = {}
    for r in nearest_join(df, "id", "v", df, "id", "v", 3, broadcast_rows=0, cell_rows=50).collect():
        got.setdefault(r.query_id, {})[r.hit_rank] = r.neighbour_id
    assert got == {i: dict(enumerate(np.lexsort((np.arange(400), np.linalg.norm(m - v, axis=1)))[:3].tolist(), 1)) for i, v in enumerate(m)}


def test_cells_are_ruled_out(spark):
    m = np.concatenate([np.random.default_rng(i).standard_normal((60, 3)) + 100 * i for i in range(10)])
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "id long, v array<double>")
    b, q = (df.select(F.col("id").alias(f"{c}_id"), F.col("v").alias(f"{c}_vec")) for c in "bq")
    join = knn.Join(b, q, 5, knn.Space("euclidean"), 3, 60, 600)
    homes = join._in_cells(q, "q_id", "q_vec", False)
    first = knn.best(join.asked(homes), 5)
    reach = first.groupBy("q_id").agg(F.max("gap").alias("reach"))
    assert join.others(homes, reach).count() < 600 * len(join.cells) / 4
    assert join.others(homes, reach.withColumn("reach", F.lit(None).cast("double"))).count() == 600 * (len(join.cells) - 1)


def test_few_or_no_rows(spark):
    one = spark.createDataFrame([(1, [1.0, 2.0])], "id long, v array<double>")
    for rows in (0, 1000):
        assert nearest_join(one, "id", "v", one, "id", "v", 5, broadcast_rows=rows).collect() == [(1, 1, 0.0, 1)]
        assert nearest_join(one.where("false"), "id", "v", one, "id", "v", 5, broadcast_rows=rows).collect() == []
        assert nearest_join(one, "id", "v", one.where("false"), "id", "v", 5, broadcast_rows=rows).collect() == []
    with pytest.raises(ValueError):
        nearest_join(one, "id", "v", one, "id", "v", 5, "taxicab")


def test_a_query_is_sent_once_to_a_region(spark):
    m = np.random.default_rng(3).standard_normal((1500, 24)).astype("f4")  # without structure: bounds rule out next to nothing
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "id long, v array<float>")
    b, q = (df.select(F.col("id").alias(f"{c}_id"), F.col("v").alias(f"{c}_vec")) for c in "bq")
    join = knn.Join(b, q, 5, knn.Space("euclidean"), 24, 10, 1500)
    assert len(join.cells) > 100 and len(join.regions) <= 2 * join.pieces
    homes = join._in_cells(q, "q_id", "q_vec", False)
    reach = knn.best(join.asked(homes), 5).groupBy("q_id").agg(F.max("gap").alias("reach"))
    rest = join.others(homes, reach, by_region=True)
    assert rest.count() <= 1500 * len(join.regions) < join.others(homes, reach).count() / 3
    hits = nearest_join(df, "id", "v", df, "id", "v", 5, broadcast_rows=0, cell_rows=10).collect()
    want = {i: np.lexsort((np.arange(1500), np.linalg.norm(m.astype("f8") - v.astype("f8"), axis=1)))[:5].tolist() for i, v in enumerate(m)}
    got = {i: [0] * 5 for i in want}
    for r in hits:
        got[r.query_id][r.hit_rank - 1] = r.neighbour_id
    assert got == want
