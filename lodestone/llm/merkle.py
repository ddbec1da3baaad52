"""Merkle manifest of a table: a tree per source, a tree over the sources, and for every row a proof up to the root.

The trees are worked by time-forward processing. A node's label is (level, index); a priority queue ordered by label delivers the
digests of children to their parents, and a sweep over the same labels in reverse delivers to every child the siblings that its proof
needs. Blocks of 4,096 neighbouring nodes are the unit of a task: a block is a whole subtree of three levels, so no node waits for
another task. What passes between blocks are tables: the blocks' tops are the nodes of the next round, and the proofs of the tops come
back with a join. A tree of n leaves takes log(n) / log(4096) rounds of a table that shrinks 4,096-fold each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import store
from lodestone.operators.order import number_rows
from lodestone.session import small_side

FAN = 16
LEVELS = 3  # of a block: 4,096 nodes
#: The columns that a leaf covers, in order.
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]

Siblings = tuple[int, list[bytes]]  # a node's place in its run and the digests of the others there

_BLOCKS = "tree bigint, block bigint, size bigint, top binary, nodes binary, changed binary, ids array<bigint>"
_HEADS = "tree bigint, known binary, root binary, subroot binary"


def _digest(parts: Iterable[bytes]) -> bytes:
    """SHA-256 of digests that are concatenated as hex text."""
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def leaf(values: list[Column]) -> Column:
    """Hex SHA-256 of the values, each ``-`` if null, else its UTF-8 byte count, ``:`` and itself."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


# -- the two sweeps over one block -----------------------------------------------------------------------


def sweep_up(nodes: list[bytes], levels: int) -> list[list[bytes]]:
    """The digests of each level from ``nodes`` up, so many levels, by a queue of (label of the parent, place, digest)."""
    tree = [nodes, *([] for _ in range(levels))]
    queue = [((1, i // FAN), i, d) for i, d in enumerate(nodes)] if levels else []  # in order, hence a heap
    while queue:
        label = level, index = queue[0][0]
        children = []
        while queue and queue[0][0] == label:
            children.append(heappop(queue)[2])
        made = _digest(children)
        tree[level].append(made)
        if level < levels:
            heappush(queue, ((level + 1, index // FAN), index, made))
    return tree


def sweep_down(tree: list[list[bytes]], above: list[Siblings]) -> Iterator[tuple[int, list[Siblings]]]:
    """For each node of the lowest level its siblings on every level, its own first; ``above`` are those of the top."""
    queue = [(1 - len(tree), 0, above)]
    while queue:
        level, index, known = heappop(queue)
        if level == 0:
            yield index, known
            continue
        start = index * FAN
        run = tree[-level - 1][start : start + FAN]
        for k in range(len(run)):
            heappush(queue, (level + 1, start + k, [(k, run[:k] + run[k + 1 :]), *known]))


def _levels(size: int, most: int) -> int:
    """Levels of a block in a tree of ``size`` nodes: a tree of one block ends at its top, a block among others is raised all levels."""
    if size > FAN**most:
        return most
    n = 0
    while size > 1:
        size, n = -(-size // FAN), n + 1
    return n


def proof(known: list[Siblings]) -> bytes:
    return _digest(b"".join(s) for _, s in known)


def fold(node: bytes, known: list[Siblings]) -> bytes:
    """The root that follows from a node and its siblings."""
    for k, others in known:
        node = _digest([*others[:k], node, *others[k:]])
    return node


def _packed(known: list[Siblings]) -> bytes:
    return b"".join(bytes([k, len(s)]) + bytes.fromhex(b"".join(s).decode()) for k, s in known)


def _unpacked(blob: bytes) -> list[Siblings]:
    out, at = [], 0
    while at < len(blob):
        k, n = blob[at], blob[at + 1]
        out.append((k, _hexes(blob[at + 2 : at + 2 + 32 * n])))
        at += 2 + 32 * n
    return out


def _hexes(blob: bytes) -> list[bytes]:
    text = blob.hex().encode()
    return [text[i : i + 64] for i in range(0, len(text), 64)]


# -- rounds over tables ----------------------------------------------------------------------------------


def _blocks(nodes: DataFrame, name: str, levels: int) -> DataFrame:
    """Nodes ``tree, idx, size, node, changed, id`` as one row a block with the digest of its top."""

    def up(table: pa.Table) -> pa.Table:
        table = table.sort_by("idx")
        size = table["size"][0].as_py()
        digests = [d.hex().encode() for d in table["node"].to_pylist()]
        top = sweep_up(digests, _levels(size, levels))[-1][0]
        row = {
            "tree": table["tree"][0].as_py(), "block": table["block"][0].as_py(), "size": size, "top": bytes.fromhex(top.decode()),
            "nodes": b"".join(table["node"].to_pylist()), "changed": b"".join(table["changed"].to_pylist()), "ids": table["id"].to_pylist(),
        }
        return pa.Table.from_pylist([row], schema=schema)

    schema = pa.schema([
        ("tree", pa.int64()), ("block", pa.int64()), ("size", pa.int64()), ("top", pa.binary()), ("nodes", pa.binary()),
        ("changed", pa.binary()), ("ids", pa.list_(pa.int64())),
    ])
    nodes = nodes.select("tree", F.expr(f"idx div {FAN**levels}").alias("block"), "idx", "size", "node", "changed", "id")
    return store(nodes.groupBy("tree", "block").applyInArrow(up, _BLOCKS), name)


def _up(nodes: DataFrame, name: str, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of each round, and ``tree, node`` for the top of each tree."""
    rounds: list[DataFrame] = []
    most = FAN**levels
    tops = None
    while True:
        blocks = _blocks(nodes, f"{name}-{len(rounds)}", levels)
        rounds.append(blocks)
        done = blocks.where(F.col("size") <= most).select("tree", F.col("top").alias("node"))
        tops = done if tops is None else tops.unionByName(done)
        rest = blocks.where(F.col("size") > most)
        if rest.isEmpty():
            return rounds, tops
        nodes = rest.select(
            "tree", F.col("block").alias("idx"), F.expr(f"(size + {most - 1}) div {most}").alias("size"), F.col("top").alias("node"),
            F.lit(b"").alias("changed"), F.lit(None).cast("bigint").alias("id"),
        )


def _down(rounds: list[DataFrame], heads: DataFrame, emit, schema: str, name: str, levels: int) -> DataFrame:
    """From ``heads`` (``tree, known, root, subroot`` of each top) down the rounds; ``emit`` makes the rows of the lowest."""
    heads = heads.withColumn("block", F.lit(0).cast("bigint"))
    below, most = None, FAN**levels
    for i in range(len(rounds) - 1, -1, -1):
        # trees of one block start from their top, the others go on with what the round above has given their blocks
        joined = rounds[i].where(F.col("size") <= most).join(heads, ["tree", "block"])
        if below is not None:
            joined = joined.unionByName(rounds[i].where(F.col("size") > most).join(below, ["tree", "block"]))
        if i == 0:
            return joined.mapInArrow(_each(emit, _schema(schema), levels), schema)
        below = store(joined.mapInArrow(_each(_to_blocks, _schema(_HEADS + ", block bigint"), levels), _HEADS + ", block bigint"), f"{name}-down-{i}")
    raise AssertionError("no rounds")


def _schema(text: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "binary": pa.binary(), "string": pa.string(), "boolean": pa.bool_()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in text.split(",")])


def _each(emit, schema: pa.Schema, levels: int):
    """A block's rows at a time; blocks are large, so a batch is never unpacked whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                nodes = _hexes(row["nodes"])
                tree = sweep_up(nodes, _levels(row["size"], levels))
                yield pa.RecordBatch.from_pylist(list(emit(row, nodes, levels, sweep_down(tree, _unpacked(row["known"])))), schema=schema)

    return run


def _to_blocks(row: dict, nodes: list[bytes], levels: int, found: Iterator[tuple[int, list[Siblings]]]) -> Iterator[dict]:
    for i, known in found:
        yield {"tree": row["tree"], "block": row["block"] * FAN**levels + i, "known": _packed(known), "root": row["root"], "subroot": row["subroot"]}


def _to_sources(row: dict, nodes: list[bytes], levels: int, found: Iterator[tuple[int, list[Siblings]]]) -> Iterator[dict]:
    for i, known in found:
        yield {"tree": row["ids"][i], "known": _packed(known), "root": row["root"], "subroot": bytes.fromhex(nodes[i].decode())}


def _to_leaves(row: dict, nodes: list[bytes], levels: int, found: Iterator[tuple[int, list[Siblings]]]) -> Iterator[dict]:
    root, subroot, changed = row["root"].hex(), row["subroot"].hex(), _hexes(row["changed"])
    for i, known in found:
        yield {
            "doc_id": row["ids"][i], "leaf": nodes[i].decode(), "subroot": subroot, "root": root,
            "proof_sha256": proof(known).decode(), "folded_root": fold(changed[i], known).decode(),
        }


def manifest(docs: DataFrame, every: int = 5, levels: int = LEVELS) -> DataFrame:
    """Per row ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.

    A leaf is the digest of ``doc_id, source, lang, n_chars, text``. The leaves of a source ascend by ``doc_id``, the subroots by source;
    runs of 16 become a node until one is left. Where ``every`` divides the CRC of the id, the text's A-Z are lower-cased before the proof is
    folded: the row verifies only if that changes nothing. A null id counts as the smallest and is never changed; rows with equal ids
    stand by their leaf's digest. Repeated rows keep a place and a proof each. Null source is a source of its own and the first; null and
    empty texts differ. An empty table gives no rows. Other columns are not read.
    """
    changes = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0, F.lit(False))
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    intact = leaf([F.col(c) for c in COLUMNS])
    digests = docs.select(
        F.col("doc_id").cast("bigint").alias("id"), "source", F.unhex(intact).alias("node"),
        F.when(changes, F.unhex(leaf([F.col(c) if c != "text" else lower for c in COLUMNS]))).alias("changed"),
    )
    # the texts are read once; all that follows works on digests
    digests = store(digests, "leaves")
    order = [F.col("source").asc_nulls_first(), F.col("id").asc_nulls_first(), F.col("node").asc()]
    numbered = store(number_rows(digests, order, "n"), "numbered")
    sources = store(numbered.groupBy("source").agg(F.min("n").alias("tree"), F.count(F.lit(1)).alias("size")), "sources")
    own = sources.select(F.col("source").alias("s"), "tree", "size")
    nodes = numbered.join(small_side(own), F.col("source").eqNullSafe(F.col("s")))
    nodes = nodes.select("tree", (F.col("n") - F.col("tree")).alias("idx"), "size", "node", F.coalesce("changed", "node").alias("changed"), "id")

    rounds, tops = _up(nodes, "trees", levels)
    # a tree's number is the place of its first leaf in the whole order, so trees ascend as their sources do
    n_sources = sources.count()
    ranked = number_rows(tops, [F.col("tree").asc()], "idx").select(
        F.lit(-1).cast("bigint").alias("tree"), "idx", F.lit(n_sources).cast("bigint").alias("size"), "node", F.lit(b"").alias("changed"), F.col("tree").alias("id")
    )
    upper, top = _up(ranked, "root", levels)
    whole = top.select("tree", F.lit(b"").alias("known"), F.col("node").alias("root"), F.col("node").alias("subroot"))
    heads = store(_down(upper, whole, _to_sources, _HEADS, "root", levels), "subroots")
    out = _down(rounds, heads, _to_leaves, "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string", "trees", levels)
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
