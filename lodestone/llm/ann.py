"""Approximate nearest neighbours by inner product: a robust-pruned directed graph per shard, searched with a beam."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestone.llm.common import store

SHARD_ROWS = 4_096
QUERY_BLOCK = 2_048
DEGREE, BEAM, RELAX = 32, 80, 1.2


class Graph:
    """Vectors with a bounded list of neighbours each; inner product is turned into distance by one more coordinate."""

    def __init__(self, vectors: np.ndarray, degree: int = DEGREE, beam: int = BEAM, relax: float = RELAX, seed: int = 4):
        norms = (vectors**2).sum(axis=1)
        lift = np.sqrt(np.maximum(norms.max() - norms, 0))
        self.x = np.hstack([vectors, lift[:, None]]).astype(np.float32)
        self.degree, self.beam = min(degree, max(1, len(vectors) - 1)), beam
        rng = np.random.default_rng(seed)
        n = len(vectors)
        self.square = (self.x**2).sum(axis=1)
        centre = self.x.mean(axis=0)
        self.starts = np.unique(np.append(rng.integers(0, n, 15), np.argmin(((self.x - centre) ** 2).sum(axis=1))))
        self.edges = rng.integers(0, n, (n, self.degree)).astype(np.int32)  # -1: no neighbour
        for slack in (1.0, relax) if n > 1 else ():
            for part in np.array_split(rng.permutation(n), -(-n // 512)):
                _, _, seen = self.search(self.x[part], self.beam, True)
                self._link(part, seen, slack)

    def search(self, queries: np.ndarray, beam: int, keep_seen: bool = False, wide: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        """Beam search of many queries in step: the ids and distances of the beam, and the nodes that were expanded."""
        m, n, beam = len(queries), len(self.x), min(beam, len(self.x))
        rows = np.arange(m)[:, None]
        known = np.zeros((m, n), bool)
        ids = np.full((m, beam), -1, np.int32)
        far = np.full((m, beam), np.inf, np.float32)
        done = np.zeros((m, beam), bool)
        new = np.repeat(self.starts[None, :].astype(np.int32), m, axis=0)
        expanded = []
        while True:
            fresh = (new >= 0) & ~known[rows, new]
            new_sorted = np.sort(np.where(fresh, new, -1), axis=1)  # a node that two neighbours name counts once
            fresh = (new_sorted >= 0) & np.hstack([np.ones((m, 1), bool), np.diff(new_sorted, axis=1) != 0])
            new = np.where(fresh, new_sorted, 0)
            known[np.broadcast_to(rows, new.shape)[fresh], new[fresh]] = True
            d = np.where(fresh, self.square[new] - 2 * np.einsum("mrd,md->mr", self.x[new], queries), np.inf)
            all_ids, all_far = np.hstack([ids, new]), np.hstack([far, d.astype(np.float32)])
            all_done = np.hstack([done, np.zeros(new.shape, bool)])
            best = np.argpartition(all_far, beam - 1, axis=1)[:, :beam]
            ids, far, done = (np.take_along_axis(a, best, axis=1) for a in (all_ids, all_far, all_done))
            waiting = np.where(done | np.isinf(far), np.inf, far)
            pick = np.argpartition(waiting, min(wide, beam) - 1, axis=1)[:, :wide]
            open_ = np.isfinite(np.take_along_axis(waiting, pick, axis=1))
            if not open_.any():
                break
            np.put_along_axis(done, pick, np.take_along_axis(done, pick, axis=1) | open_, axis=1)
            at = np.where(open_, np.take_along_axis(ids, pick, axis=1), -1)
            if keep_seen:
                expanded.append(at)
            new = np.where((at >= 0)[:, :, None], self.edges[at], -1).reshape(m, -1)
        order = np.argsort(far, axis=1, kind="stable")
        return np.take_along_axis(ids, order, axis=1), np.take_along_axis(far, order, axis=1), np.hstack(expanded) if keep_seen else None

    def _link(self, nodes: np.ndarray, seen: np.ndarray, slack: float) -> None:
        """New neighbours for ``nodes`` from what their searches expanded, and edges back, pruned where a list overflows."""
        self.edges[nodes] = self._prune(nodes, np.hstack([seen, self.edges[nodes]]), slack)
        to = self.edges[nodes].ravel()
        source = np.repeat(nodes, self.degree)[to >= 0]
        to = to[to >= 0]
        order = np.argsort(to, kind="stable")
        to, source = to[order], source[order]
        targets, first, count = np.unique(to, return_index=True, return_counts=True)
        back = np.full((len(targets), count.max()), -1, np.int64)
        back[np.repeat(np.arange(len(targets)), count), np.arange(len(to)) - np.repeat(first, count)] = source
        for some in np.array_split(np.arange(len(targets)), -(-len(targets) // 1024)):
            self.edges[targets[some]] = self._prune(targets[some], np.hstack([self.edges[targets[some]], back[some]]), slack)

    def _prune(self, nodes: np.ndarray, candidates: np.ndarray, slack: float, most: int = 160) -> np.ndarray:
        """The robust prune of many nodes at once: take the nearest candidate, drop those that are ``slack`` times nearer to it than
        to the node, and so on."""
        c = np.sort(candidates, axis=1)
        bad = (c < 0) | (c == nodes[:, None]) | np.hstack([np.zeros((len(c), 1), bool), np.diff(c, axis=1) == 0])
        c = np.where(bad, 0, c)
        own = self.x[nodes]
        d = self.square[c] - 2 * np.einsum("mrd,md->mr", self.x[c], own) + self.square[nodes][:, None]
        d = np.where(bad, np.inf, np.maximum(d, 0))
        near = np.argsort(d, axis=1, kind="stable")[:, : min(most, c.shape[1])]
        c, d = np.take_along_axis(c, near, axis=1), np.take_along_axis(d, near, axis=1)
        x, sq = self.x[c], self.square[c]
        between = np.maximum(sq[:, :, None] + sq[:, None, :] - 2 * np.matmul(x, x.transpose(0, 2, 1)), 0)
        out = np.full((len(nodes), self.degree), -1, np.int32)
        rows = np.arange(len(nodes))
        for k in range(self.degree):
            pick = d.argmin(axis=1)
            good = np.isfinite(d[rows, pick])
            if not good.any():
                break
            out[good, k] = c[rows, pick][good]
            covered = slack * slack * between[rows, pick] <= d
            covered[rows, pick] = True
            d = np.where(covered & good[:, None], np.inf, d)
        return out


def _usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Rows ``id, v, dim`` that take part: no null, zero or non-finite vectors, no null ids; an id with several vectors keeps all."""
    v = F.col(vec_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull())
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return rows.where(sound & F.exists("v", lambda x: x != 0)).withColumn("dim", F.size("v"))


def nearest(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", every: int = 20, k: int = 20,
    shard_rows: int = SHARD_ROWS, beam: int = BEAM,
) -> DataFrame:
    """Rows ``query_id, rank, vec_id, score``: for every vector whose id is divisible by ``every`` its ``k`` nearest others by
    inner product, nearest first, ties to the smaller id; fewer where there are fewer.

    Equal vectors are one node that carries its k + 1 smallest ids. Nodes fall into shards of about ``shard_rows`` by hash. Each
    shard builds its graph in one task and keeps it as one row of a table; each block of queries then searches each shard, and the
    scores, exact on the original vectors, are merged. Vectors that are null, zero or hold null or non-finite components, and null
    ids, take no part; vectors of another length are no neighbours. Repeated rows count as one. An empty table gives no rows.
    """
    rows = _usable(vectors, id_col, vec_col).distinct()
    rows = rows.withColumn("key", F.xxhash64("v"))
    small = F.row_number().over(Window.partitionBy("key", "v").orderBy("id"))
    nodes = rows.withColumn("r", small).where(F.col("r") <= k + 1).groupBy("key", "v", "dim").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    nodes = store(nodes, "vectors")
    shards = max(1, -(-nodes.count() // shard_rows))
    nodes = nodes.withColumn("shard", F.pmod(F.xxhash64(F.lit(9), "key"), F.lit(shards)).cast("int"))
    queries = rows.where(F.col("id") % every == 0)
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    id_type = "bigint"

    def build(part: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(part["v"].to_numpy()).astype(np.float64)
        g = Graph(x, beam=beam)
        ids = [np.asarray(i, np.int64) for i in part["ids"]]
        return pd.DataFrame({
            "shard": [part["shard"].iloc[0]], "dim": [part["dim"].iloc[0]], "x": [x.tobytes()], "edges": [g.edges.tobytes()],
            "starts": [g.starts.astype(np.int64).tobytes()], "ids": [np.concatenate(ids).tobytes()], "sizes": [np.array([len(i) for i in ids]).tobytes()],
        })

    kind = "shard int, dim int, x binary, edges binary, starts binary, ids binary, sizes binary"
    graphs = store(nodes.groupBy("shard", "dim").applyInPandas(build, kind), "graphs")

    def find(graph: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        if not len(graph) or not len(asked):
            return none
        row = graph.iloc[0]
        x = np.frombuffer(row["x"]).reshape(-1, row["dim"])
        g = Graph.__new__(Graph)
        norms = (x**2).sum(axis=1)
        g.x = np.hstack([x, np.sqrt(np.maximum(norms.max() - norms, 0))[:, None]]).astype(np.float32)
        g.square, g.starts = (g.x**2).sum(axis=1), np.frombuffer(row["starts"], np.int64)
        g.edges = np.frombuffer(row["edges"], np.int32).reshape(len(x), -1)
        ids, sizes = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["sizes"], np.int64)
        begin = np.cumsum(sizes) - sizes
        out = [none]
        for at in range(0, len(asked), 512):
            some = asked.iloc[at : at + 512]
            q = np.stack(some["v"].to_numpy()).astype(np.float64)
            qid = some["id"].to_numpy()
            found, far, _ = g.search(np.hstack([q, np.zeros((len(q), 1))]).astype(np.float32), max(beam, k + 1))
            found, far = found[:, : k + 9], far[:, : k + 9]
            who, place = np.nonzero(np.isfinite(far))
            node = found[who, place]
            score = np.einsum("nd,nd->n", q[who], x[node])
            times = sizes[node]
            take = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(begin[node], times)
            hit = pd.DataFrame({"query_id": np.repeat(qid[who], times), "vec_id": ids[take], "score": np.repeat(score, times)})
            hit = hit[hit["query_id"] != hit["vec_id"]].sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
            out.append(hit.groupby("query_id").head(k))
        return pd.concat(out)

    spread = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    each = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    left = graphs.withColumn("block", spread).groupBy("shard", "dim", "block")
    right = queries.select("id", "v", "dim", "block", each.alias("shard")).groupBy("shard", "dim", "block")
    hits = left.cogroup(right).applyInPandas(find, f"query_id {id_type}, vec_id {id_type}, score double").distinct()
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
