"""Exact nearest rows of every query row, for six metrics.

Each metric is a Euclidean distance in some space: angles between unit vectors, differing bits as cells of 0 and 1, places on the globe as
points in three dimensions, inner products with one more cell that gives all base rows the same length.  Base rows lie in cells around
pivots.  A query first asks its own cell; the distance of its k-th row there, with the triangle inequality, rules out every cell whose
rows are all farther, and only the others are asked.

Cells are what is measured, regions what is sent: neighbouring cells whose rows fill a task are a region, and a query goes there once with
one bit for each cell that it asks, however many they are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lodestone.functions.predicates import EARTH_KM
from lodestone.session import cut, is_small

METRICS = ("euclidean", "angular", "prenormalized", "dotproduct", "hamming", "geodesic")
# Base rows that are measured at a time; queries and bytes of embedded vectors that a task holds of a side; queries that are sent to all tasks.
CELL_ROWS = 20_000
QUERY_ROWS = 200_000
SIDE_BYTES = 64 << 20
SHIPPED_ROWS = 10_000
MOST_CELLS = 1024
# Queries and distances that are measured at a time.
STEP = 500
MEASURED = 1 << 22


class Space(NamedTuple):
    metric: str
    longest: float = 0.0  # squared, of the base rows; for inner products

    def embedded(self, m: np.ndarray, base: bool) -> np.ndarray:
        if self.metric == "angular":
            return m / np.linalg.norm(m, axis=1, keepdims=True)
        if self.metric in ("dotproduct", "prenormalized"):
            rest = np.sqrt(np.maximum(0.0, self.longest - (m * m).sum(1))) if base else np.zeros(len(m))
            return np.column_stack([m, rest])
        if self.metric == "hamming":
            return np.unpackbits(np.ascontiguousarray(m).view(np.uint8), axis=1).astype("f8")
        if self.metric == "geodesic":
            lat, lng = np.radians(m[:, 0]), np.radians(m[:, 1])
            return np.column_stack([np.cos(lat) * np.cos(lng), np.cos(lat) * np.sin(lng), np.sin(lat)])
        return m

    def measured(self, q: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The metric itself, row by row; smaller is nearer."""
        if self.metric == "euclidean":
            return np.sqrt(((q - b) ** 2).sum(1))
        if self.metric == "hamming":
            return np.bitwise_count((q ^ b).view(np.uint64)).sum(1).astype("f8")  # of signed numbers it would take the absolute value
        if self.metric == "geodesic":
            (lat, lng), (lat2, lng2) = np.radians(q).T, np.radians(b).T
            a = np.sin((lat2 - lat) / 2) ** 2 + np.cos(lat) * np.cos(lat2) * np.sin((lng2 - lng) / 2) ** 2
            return 2 * EARTH_KM * np.arcsin(np.sqrt(np.minimum(a, 1.0)))
        dot = np.einsum("ij,ij->i", q, b)
        if self.metric == "angular":
            return 1.0 - dot / np.sqrt((q * q).sum(1) * (b * b).sum(1))
        return -dot if self.metric == "dotproduct" else 1.0 - dot


def _gaps(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances, off by rounding."""
    return np.maximum(0.0, (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T))


def _slack(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """More than rounding adds to a gap: it goes with the lengths of the vectors, not with the gap."""
    longest = (b * b).sum(1).max() if len(b) else 0.0
    return 1e-14 * (a.shape[1] + 8) * ((a * a).sum(1) + longest)


def _places(groups: np.ndarray) -> np.ndarray:
    """Place of each row in its group; ``groups`` is sorted."""
    first = np.flatnonzero(np.append(True, groups[1:] != groups[:-1])) if len(groups) else groups
    return np.arange(len(groups)) - np.repeat(first, np.diff(np.append(first, len(groups))))


def _ranks(ids: np.ndarray) -> np.ndarray:
    return np.unique(ids, return_inverse=True)[1]


def block_top(space: Space, q: np.ndarray, b: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best of a block for every query: query and base places, distances and gaps, ties by id.

    A matrix product ranks the block; what is within rounding of the k-th is measured again.
    """
    rank = _ranks(ids)
    places = np.arange(len(b))
    # of equal vectors only the k first can be among the best
    same = np.unique(np.ascontiguousarray(b).view(np.dtype((np.void, b.itemsize * b.shape[1]))).ravel(), return_inverse=True)[1]
    if len(b) and same.max() + 1 < len(b):
        order = np.lexsort((rank, same))
        places = np.sort(order[_places(same[order]) < k])
    be = space.embedded(b[places], True)
    out: list[list[np.ndarray]] = [[], [], [], []]
    for lo in range(0, len(q) if len(b) else 0, STEP):
        part = q[lo : lo + STEP]
        qe = space.embedded(part, False)
        gap = _gaps(qe, be)
        kk = min(k, len(places)) - 1
        if space.metric == "hamming":  # whole numbers: exact, and ties by the thousand go by id at once
            r = np.repeat(np.arange(len(part)), kk + 1)
            c = np.argpartition(np.rint(gap) * len(b) + rank[places][None], kk, axis=1)[:, : kk + 1].ravel()
        else:
            limit = np.partition(gap, kk, axis=1)[:, kk] + _slack(qe, be)
            r, c = np.nonzero(gap <= limit[:, None])
        step = max(1, MEASURED // max(1, q.shape[1]))
        d = np.concatenate([space.measured(part[r[i : i + step]], b[places[c[i : i + step]]]) for i in range(0, len(r), step)])
        order = np.lexsort((rank[places[c]], d, r))
        order = order[_places(r[order]) < k]
        for x, v in zip(out, (r[order] + lo, places[c[order]], d[order], gap[r[order], c[order]])):
            x.append(v)
    return tuple(np.concatenate(x) if x else np.zeros(0, t) for x, t in zip(out, ("i8", "i8", "f8", "f8")))  # type: ignore[return-value]


def tile_top(
    space: Space, q: np.ndarray, asks: np.ndarray, b: np.ndarray, cell: np.ndarray, ids: np.ndarray, k: int, cell_rows: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``block_top`` over the cells of a region, for each cell with the queries that ask it (``asks``, query x cell)."""
    rank = _ranks(ids)
    by_cell = np.argsort(cell, kind="stable")
    # the k best so far: distances, ranks of ids, gaps and places
    d, n, gap, at = np.full((len(q), k), np.inf), np.full((len(q), k), len(b)), np.zeros((len(q), k)), np.full((len(q), k), -1)
    for c in np.unique(cell):
        who = np.flatnonzero(asks[:, c])
        rows = by_cell[np.searchsorted(cell[by_cell], c) : np.searchsorted(cell[by_cell], c, "right")]
        for lo in range(0, len(rows) if len(who) else 0, cell_rows):
            piece = rows[lo : lo + cell_rows]
            for i in range(0, len(who), CELL_ROWS):
                some = who[i : i + CELL_ROWS]
                r, x, dist, g = block_top(space, q[some], b[piece], rank[piece], k)
                new = [np.full((len(some), k), fill) for fill in (np.inf, len(b), 0.0, -1)]
                for into, values in zip(new, (dist, rank[piece[x]], g, piece[x])):
                    into[r, _places(r)] = values
                both = [np.concatenate([old[some], more], axis=1) for old, more in zip((d, n, gap, at), new)]
                first = np.lexsort((both[1], both[0]), axis=1)[:, :k]
                for old, values in zip((d, n, gap, at), both):
                    old[some] = np.take_along_axis(values, first, 1)
    r, c = np.nonzero(at >= 0)
    return r, at[r, c], d[r, c], gap[r, c]


# -- rows and tables ---------------------------------------------------------------------------------


def _matrix(column: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, dims) if flat.dtype == np.int64 else flat.astype("f8").reshape(-1, dims)


def _ids(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    values = column.to_pylist()
    return np.array(values) if values else np.zeros(0, "i8")


def _arrow_type(df: DataFrame, name: str) -> pa.DataType:
    return to_arrow_type(df.schema[name].dataType)


def _usable(df: DataFrame, key: str, vector: str, names: tuple[str, str], metric: str, dims: int | None) -> DataFrame:
    """Rows with a key and a vector of ``dims`` finite cells; for angles not the zero vector."""
    v = F.col(f"`{vector}`")
    # floats stay floats until they are measured: half the bytes to send
    kind = "bigint" if metric == "hamming" else "float" if dict(df.dtypes)[vector] == "array<float>" else "double"
    rows = df.select(F.col(f"`{key}`").alias(names[0]), v.cast(f"array<{kind}>").alias(names[1])).where(F.col(names[0]).isNotNull())
    rows = rows.where(F.size(names[1]) == dims) if dims is not None else rows
    fits = F.forall(names[1], lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    if metric == "angular":
        fits = fits & F.exists(names[1], lambda x: x != 0)
    return rows.where(fits)


def _batch(q_ids: np.ndarray, b_ids: np.ndarray, found: tuple, kinds: tuple[pa.DataType, pa.DataType]) -> pa.RecordBatch:
    r, c, d, gap = found
    pick = lambda ids, at, kind: pa.array(ids[at].tolist() if len(at) else [], kind)
    return pa.RecordBatch.from_arrays([pick(q_ids, r, kinds[0]), pick(b_ids, c, kinds[1]), pa.array(d), pa.array(gap)], ["q_id", "b_id", "distance", "gap"])


class Join:
    """One join: the cells of its base, and the rounds of queries that ask them."""

    def __init__(self, base: DataFrame, queries: DataFrame, k: int, space: Space, dims: int, cell_rows: int, rows: int):
        self.k, self.space, self.dims, self.cell_rows, self.queries = k, space, dims, cell_rows, queries
        types = dict(base.dtypes) | dict(queries.dtypes)
        self.schema = f"q_id {types['q_id']}, b_id {types['b_id']}, distance double, gap double"
        self.kinds = tuple(_arrow_type(x, c) for x, c in ((queries, "q_id"), (base, "b_id")))
        n = max(1, min(MOST_CELLS, -(-rows // cell_rows)))
        drawn = base.orderBy(F.xxhash64("b_id"), "b_id").limit(n).select("b_vec").toArrow()
        self.pivots = np.unique(space.embedded(_matrix(drawn["b_vec"], dims), True), axis=0)
        self.base = cut(self._in_cells(base, "b_id", "b_vec", True))
        # one row a cell
        self.cells = {r["cell"]: r for r in self.base.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("far").alias("lo"), F.max("far").alias("hi")).collect()}
        self._set_regions(rows)

    def _set_regions(self, rows: int) -> None:
        """Ranges of cells (pivots are in order, so neighbours in a coordinate) whose rows a task can hold; a larger cell is one alone, in parts."""
        side = max(self.cell_rows, SIDE_BYTES // (8 * max(1, self.pivots.shape[1])))
        self.query_rows = min(QUERY_ROWS, side)
        # as many regions as pieces of their queries: few copies of either side keep all cores busy
        self.pieces = math.ceil(math.sqrt(3 * self.base.sparkSession.sparkContext.defaultParallelism))
        most = min(side, -(-rows // self.pieces))
        self.regions: list[tuple[int, int, int]] = []  # first cell, the cell behind the last, parts
        start, held = 0, 0
        for c in range(len(self.pivots)):
            n = self.cells[c]["n"] if c in self.cells else 0
            if held and held + n > most:
                self.regions.append((start, c, -(-held // side)))
                start, held = c, 0
            held += n
        self.regions.append((start, len(self.pivots), max(1, -(-held // side))))
        self.region_of = np.repeat(np.arange(len(self.regions)), [stop - first for first, stop, _ in self.regions])

    def _in_cells(self, df: DataFrame, key: str, vector: str, base: bool) -> DataFrame:
        space, pivots, dims = self.space, self.pivots, self.dims

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                gap = _gaps(space.embedded(_matrix(b.column(vector), dims), base), pivots)
                cell = gap.argmin(1)
                far = np.sqrt(gap[np.arange(len(cell)), cell])
                yield pa.RecordBatch.from_arrays([b.column(key), b.column(vector), pa.array(cell.astype("i4")), pa.array(far)], [key, vector, "cell", "far"])

        types = dict(df.dtypes)
        return df.select(key, vector).mapInArrow(run, f"{key} {types[key]}, {vector} {types[vector]}, cell int, far double")

    def asked(self, routes: DataFrame) -> DataFrame:
        """The ``k`` best of its cell for each query of ``routes`` (``q_id, q_vec, cell``)."""
        regions, region_of = self.regions, self.region_of
        types = dict(routes.dtypes)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                cell = b.column("cell").to_numpy()
                bits = [np.packbits(np.arange(*regions[region_of[c]][:2]) == c).tobytes() for c in cell]
                yield pa.RecordBatch.from_arrays([b.column("q_id"), b.column("q_vec"), pa.array(region_of[cell].astype("i4")), pa.array(bits, pa.binary())], ["q_id", "q_vec", "region", "asks"])

        return self.met(routes.select("q_id", "q_vec", "cell").mapInArrow(run, f"q_id {types['q_id']}, q_vec {types['q_vec']}, region int, asks binary"))

    def met(self, routes: DataFrame) -> DataFrame:
        """The ``k`` best of each region for the queries of ``routes`` (``q_id, q_vec, region, asks``); both sides of a region in bounded pieces."""
        space, dims, k, regions, cell_rows = self.space, self.dims, self.k, self.regions, self.cell_rows
        spark = routes.sparkSession
        counts = {r["region"]: r["count"] for r in routes.groupBy("region").count().collect()}
        sizes = [(i, parts, max(min(n, self.pieces), -(-n // self.query_rows))) for i, (_, _, parts) in enumerate(regions) if (n := counts.get(i))]
        sized = F.broadcast(spark.createDataFrame(sizes, "region int, subs int, chunks int"))
        q = routes.join(sized, "region").withColumn("chunk", F.pmod(F.xxhash64("q_id"), "chunks").cast("int"))
        q = q.select("region", "chunk", F.explode(F.sequence(F.lit(0), F.col("subs") - 1)).alias("sub"), "q_id", "q_vec", "asks")
        placed = F.broadcast(spark.createDataFrame([(c, int(r)) for c, r in enumerate(self.region_of)], "cell int, region int"))
        b = self.base.join(placed, "cell").join(sized, "region").withColumn("sub", F.pmod(F.xxhash64("b_id"), "subs").cast("int"))
        b = b.select("region", "sub", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), "b_id", "b_vec", "cell")
        kinds = self.kinds

        def tile(qt: pa.Table, bt: pa.Table) -> pa.Table:
            b_ids, q_ids = _ids(bt["b_id"]), _ids(qt["q_id"])
            if not (len(b_ids) and len(q_ids)):
                return pa.Table.from_batches([_batch(q_ids, b_ids, block_top(space, np.zeros((0, dims)), np.zeros((0, dims)), b_ids[:0], k), kinds)])
            start, stop, _ = regions[qt["region"][0].as_py()]
            asks = np.frombuffer(b"".join(qt["asks"].to_pylist()), "u1").reshape(len(q_ids), -1)
            asks = np.unpackbits(asks, axis=1, count=stop - start).view(bool)
            found = tile_top(space, _matrix(qt["q_vec"], dims), asks, _matrix(bt["b_vec"], dims), bt["cell"].to_numpy() - start, b_ids, k, cell_rows)
            return pa.Table.from_batches([_batch(q_ids, b_ids, found, kinds)])

        keys = ["region", "sub", "chunk"]
        return q.groupBy(*keys).cogroup(b.groupBy(*keys)).applyInArrow(tile, self.schema)

    def others(self, homes: DataFrame, reach: DataFrame, by_region: bool = False) -> DataFrame:
        """The cells beside its own that a query must ask: their nearest possible row is within its reach, null for any.

        One row a cell; by region, one row a region that has such cells, with their bits.
        """
        space, pivots, dims, regions = self.space, self.pivots, self.dims, self.regions
        lo, hi = (np.array([self.cells[c][x] if c in self.cells else np.nan for c in range(len(pivots))]) for x in ("lo", "hi"))
        between = np.sqrt(_gaps(pivots, pivots))
        types = dict(homes.dtypes)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for all_rows in batches:
                for at in range(0, all_rows.num_rows, STEP):
                    b = all_rows.slice(at, STEP)
                    qe, home = space.embedded(_matrix(b.column("q_vec"), dims), False), b.column("home").to_numpy()
                    gap = _gaps(qe, pivots)
                    far, own = np.sqrt(gap), gap[np.arange(len(home)), home]
                    # rows lie between two spheres around their pivot, and on its side of the plane halfway to any other pivot
                    plane = (gap - own[:, None]) / np.maximum(2 * between[home], 1e-300)
                    least = np.maximum(np.maximum(far - hi[None], lo[None] - far), plane)
                    reach = b.column("reach").to_numpy(zero_copy_only=False).astype("f8")
                    limit = np.where(np.isnan(reach), np.inf, np.sqrt(reach + _slack(qe, pivots)) * (1 + 1e-9) + np.sqrt(_slack(qe, pivots)))
                    ask = (least <= limit[:, None]) & ~np.isnan(hi)[None]
                    ask[np.arange(len(home)), home] = False
                    if by_region:
                        for i, (start, stop, _) in enumerate(regions):
                            r = np.flatnonzero(ask[:, start:stop].any(1))
                            bits = [x.tobytes() for x in np.packbits(ask[r, start:stop], axis=1)]
                            yield pa.RecordBatch.from_arrays([b.column("q_id").take(pa.array(r)), b.column("q_vec").take(pa.array(r)), pa.array(np.full(len(r), i, "i4")), pa.array(bits, pa.binary())], ["q_id", "q_vec", "region", "asks"])
                        continue
                    r, c = np.nonzero(ask)
                    for i in range(0, len(r), 4096):
                        take = pa.array(r[i : i + 4096])
                        yield pa.RecordBatch.from_arrays([b.column("q_id").take(take), b.column("q_vec").take(take), pa.array(c[i : i + 4096].astype("i4"))], ["q_id", "q_vec", "cell"])

        asking = homes.join(reach, "q_id", "left").select("q_id", "q_vec", F.col("cell").alias("home"), "reach")
        return asking.mapInArrow(run, f"q_id {types['q_id']}, q_vec {types['q_vec']}, " + ("region int, asks binary" if by_region else "cell int"))

    def run(self) -> DataFrame:
        homes = cut(self._in_cells(self.queries, "q_id", "q_vec", False).drop("far"))
        # a query's nearest pivot may have no rows: its cell's rows are then none, and any other cell is asked
        first = cut(best(self.asked(homes), self.k))
        reach = first.groupBy("q_id").agg(F.when(F.count(F.lit(1)) >= self.k, F.max("gap")).alias("reach"))
        rest = cut(self.others(homes, reach, by_region=True))
        return best(first.drop("hit_rank").unionByName(self.met(rest)), self.k)


def best(found: DataFrame, k: int) -> DataFrame:
    """The group limit goes before the shuffle, so each task sends k rows a query at most."""
    w = Window.partitionBy("q_id").orderBy("distance", "b_id")
    return found.withColumn("hit_rank", F.row_number().over(w)).where(F.col("hit_rank") <= k)


def _shipped(base: DataFrame, queries: DataFrame, k: int, space: Space, dims: int, schema: str) -> DataFrame:
    """Few queries go to every task, and the base streams past them without a shuffle."""
    asked = queries.toArrow()
    b_type = _arrow_type(base, "b_id")
    sent = base.sparkSession.sparkContext.broadcast((asked["q_id"].combine_chunks(), _matrix(asked["q_vec"], dims)))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q_ids, q = sent.value
        kept_r, kept_ids, kept_d = np.zeros(0, "i8"), None, np.zeros(0)
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = _ids(batch.column("b_id"))
            r, c, d, _ = block_top(space, q, _matrix(batch.column("b_vec"), dims), ids, k)
            # a running top k of all queries at once, so memory does not grow with the partition
            new = ids[c]
            r, d, all_ids = np.append(kept_r, r), np.append(kept_d, d), new if kept_ids is None else np.append(kept_ids, new)
            order = np.lexsort((_ranks(all_ids), d, r))
            order = order[_places(r[order]) < k]
            kept_r, kept_ids, kept_d = r[order], all_ids[order], d[order]
        if kept_ids is not None:
            columns = [q_ids.take(pa.array(kept_r)), pa.array(kept_ids.tolist(), b_type), pa.array(kept_d)]
            yield pa.RecordBatch.from_arrays(columns, ["q_id", "b_id", "distance"])

    return base.mapInArrow(stream, schema)


def nearest_join(
    base: DataFrame, base_key: str, base_vector: str, queries: DataFrame, query_key: str, query_vector: str,
    k: int = 10, metric: str = "euclidean", broadcast_rows: int = SHIPPED_ROWS, cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Exact ``k`` nearest base rows of every query row: ``(query_id, neighbour_id, distance, hit_rank)``, ties by key.

    Vectors are arrays of numbers; packed sign bits (``bigint``) for ``hamming``, latitude and longitude in degrees for ``geodesic``.
    Rows without a key, with a null vector, null or non-finite cells or another length than the base's first, and zero vectors for
    ``angular``, take no part on either side.  Keys keep their types and are unique on the query side.  For ``dotproduct`` the best rows
    have the largest product.
    """
    if metric not in METRICS:
        raise ValueError(f"no metric {metric!r}")
    head = _usable(base, base_key, base_vector, ("b_id", "b_vec"), metric, None).select(F.size("b_vec").alias("n")).first()
    dims = head["n"] if head else 0
    b = _usable(base, base_key, base_vector, ("b_id", "b_vec"), metric, dims)
    q = _usable(queries, query_key, query_vector, ("q_id", "q_vec"), metric, dims)
    squares = F.aggregate("b_vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    rows, longest = b.agg(F.count(F.lit(1)), F.max(squares)).first()
    space = Space(metric, (longest or 0.0) if metric in ("dotproduct", "prenormalized") else 0.0)
    kinds = dict(q.dtypes)["q_id"], dict(b.dtypes)["b_id"]
    if not rows:
        return base.sparkSession.createDataFrame([], f"query_id {kinds[0]}, neighbour_id {kinds[1]}, distance double, hit_rank int")
    if is_small(q, broadcast_rows):
        out = best(_shipped(b, q, k, space, dims, f"q_id {kinds[0]}, b_id {kinds[1]}, distance double"), k)
    else:
        out = Join(b, q, k, space, dims, cell_rows, rows).run()
    sign = -F.col("distance") if metric == "dotproduct" else F.col("distance")
    return out.select(F.col("q_id").alias("query_id"), F.col("b_id").alias("neighbour_id"), sign.alias("distance"), "hit_rank")
