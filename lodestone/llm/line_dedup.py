"""Removal of repeated lines: chunks of lines are found by hash and removed after byte comparison.

Chunks are either content-defined (``without_repeated_chunks``: few, but a passage's ends merge with the lines around it and stay) or
all pairs of neighbouring lines (``without_repeated_runs``: every run of two lines or more is covered by its pairs, so it goes whole).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import U, apart, given_back, hashes, mix, row_key, store
from lodestone.session import small_side

WINDOW = 2  # lines whose hashes are rolled together
EVERY = 3  # a line ends a chunk if the rolled hash is divisible by this


def chunk_ends(lines: list[bytes]) -> np.ndarray:
    """Numbers one behind each chunk's last line. A boundary depends on the last lines only, so text inserted elsewhere in a
    document moves no boundary."""
    h = hashes(lines)
    rolled = np.zeros(len(h), U)
    for k in range(WINDOW):
        rolled[k:] = mix(rolled[k:] * U(31) + h[: len(h) - k]) if k else mix(h)
    ends = np.flatnonzero(rolled % U(EVERY) == 0) + 1
    return ends if len(ends) and ends[-1] == len(h) else np.append(ends, len(h))


def chunks(text: bytes | None) -> list[tuple[int, int, bytes]]:
    """First line, number of lines and bytes of every chunk of two lines or more."""
    if not text:
        return []
    lines = text.split(b"\n")
    out, start = [], 0
    for end in chunk_ends(lines).tolist():
        if end - start > 1:
            out.append((start, end - start, b"\n".join(lines[start:end])))
        start = end
    return out


def line_pairs(text: bytes | None) -> list[tuple[int, int, bytes]]:
    """First line, number of lines (2) and bytes of every two neighbouring lines."""
    lines = text.split(b"\n") if text else []
    return [(i, 2, a + b"\n" + b) for i, (a, b) in enumerate(zip(lines, lines[1:]))]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    k1, k2 = row_key(F.col(id_col), F.col(text_col))
    return docs.select(F.col(id_col).alias("id"), k1.alias("k1"), k2.alias("k2"), F.col(text_col).cast("binary").alias("text"))


def _chunk_hashes(rows: DataFrame, pieces: Callable[[bytes | None], list[tuple[int, int, bytes]]]) -> DataFrame:
    id_type = dict(rows.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                b = batch.slice(at, 512)
                row, pos, n, size, c1, c2 = [], [], [], [], [], []
                for i, t in enumerate(b.column("text").to_pylist()):
                    for p, k, body in pieces(t):
                        h = xxhash.xxh3_128_intdigest(body)
                        row.append(i)
                        pos.append(p)
                        n.append(k)
                        size.append(len(body))
                        c1.append(h >> 64)
                        c2.append(h & (1 << 64) - 1)
                take = pa.array(row, pa.int32())
                i64 = lambda x: pa.array(np.array(x, U).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [b.column(c).take(take) for c in ("id", "k1", "k2")]
                    + [pa.array(pos, pa.int32()), pa.array(n, pa.int32()), pa.array(size, pa.int64()), i64(c1), i64(c2)],
                    ["id", "k1", "k2", "pos", "n", "size", "c1", "c2"],
                )

    return rows.mapInArrow(run, f"id {id_type}, k1 bigint, k2 bigint, pos int, n int, size bigint, c1 bigint, c2 bigint")


def repeated_chunks(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", pieces: Callable[[bytes | None], list[tuple[int, int, bytes]]] = chunks
) -> DataFrame:
    """Rows ``k1, k2, pos, n`` (row key, first line, lines) of every chunk that stands byte for byte elsewhere before.

    ``pieces`` gives the chunks of a text.

    The first of equal chunks is that of the smallest id (null ids last), then row key, then line. Hashes find the candidates; each is
    then compared with the first one byte for byte, and stays where they differ.
    """
    rows = _keyed(docs, id_col, text_col)
    found = store(_chunk_hashes(rows, pieces), "line-chunks")
    place = F.struct(F.col("id").isNull().alias("no_id"), F.col("id"), F.col("k1"), F.col("k2"), F.col("pos"))
    groups = found.groupBy("c1", "c2", "size").agg(F.min(place).alias("lo"), F.max(place).alias("hi")).where("lo <> hi")
    groups = groups.select("c1", "c2", "size", F.col("lo.k1").alias("f1"), F.col("lo.k2").alias("f2"), F.col("lo.pos").alias("fp"))
    seen = found.join(groups, ["c1", "c2", "size"])
    seen = store(
        seen.select("k1", "k2", "pos", "n", "c1", "c2", "size", ((F.col("k1") == F.col("f1")) & (F.col("k2") == F.col("f2")) & (F.col("pos") == F.col("fp"))).alias("is_first")).distinct(),
        "repeated",
    )
    wanted = seen.groupBy("k1", "k2").agg(F.collect_list(F.struct("pos", "n", "c1", "c2", "size", "is_first")).alias("at"))
    texts = rows.drop("id").join(small_side(store(wanted, "wanted")), ["k1", "k2"]).select("k1", "k2", "text", "at")

    def bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                out = []
                for r in batch.slice(at, 256).to_pylist():
                    lines = r["text"].split(b"\n")
                    for c in r["at"]:
                        out.append({"k1": r["k1"], "k2": r["k2"], **c, "body": b"\n".join(lines[c["pos"] : c["pos"] + c["n"]])})
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    schema = pa.schema([
        ("k1", pa.int64()), ("k2", pa.int64()), ("pos", pa.int32()), ("n", pa.int32()), ("c1", pa.int64()), ("c2", pa.int64()),
        ("size", pa.int64()), ("is_first", pa.bool_()), ("body", pa.binary()),
    ])
    cut = texts.mapInArrow(bodies, "k1 bigint, k2 bigint, pos int, n int, c1 bigint, c2 bigint, size bigint, is_first boolean, body binary")
    cut = store(cut, "chunk-bodies")
    first = cut.where("is_first").select("c1", "c2", "size", F.col("body").alias("first")).dropDuplicates(["c1", "c2", "size"])
    same = cut.where("not is_first").join(first, ["c1", "c2", "size"]).where(F.col("body") == F.col("first"))
    return same.select("k1", "k2", "pos", "n").distinct()


def without_repeated_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with repeated chunks of lines cut from the text, and behind their own columns ``__lines`` and ``__removed``,
    the numbers of lines before and cut. Where the caller has a column of such a name, it keeps it and ours gets an underscore behind.

    Lines end at line feeds. A null text stays null and has no lines; an empty text has one. Single lines are never cut. Rows that
    are equal throughout are one document and are cut alike, so a repeated row loses nothing to its own copy. A chunk that is
    repeated within one document stays at its first place. Very long texts are chunked whole. An empty table gives no rows.
    """
    docs, names = apart(docs)
    id_col, text_col = names[id_col], names[text_col]
    k1, k2 = row_key(F.col(id_col), F.col(text_col))
    gone = repeated_chunks(docs, id_col, text_col).groupBy("k1", "k2").agg(
        F.flatten(F.collect_list(F.sequence(F.col("pos"), F.col("pos") + F.col("n") - 1))).alias("__gone")
    )
    gone = small_side(store(gone, "gone").withColumnsRenamed({"k1": "__g1", "k2": "__g2"}))
    keyed = docs.withColumns({"__k1": k1, "__k2": k2})
    out = keyed.join(gone, (keyed["__k1"] == gone["__g1"]) & (keyed["__k2"] == gone["__g2"]), "left")
    text = F.col(text_col)
    left = F.array_join(F.filter(F.split(text, "\n", -1), lambda _, i: ~F.array_contains("__gone", i)), "\n")
    out = out.withColumns({
        "__lines": F.when(text.isNull(), 0).otherwise(F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1),
        "__removed": F.coalesce(F.size("__gone"), F.lit(0)),
        text_col: F.when(F.col("__gone").isNull(), text).otherwise(left),
    })
    return given_back(out, names, ["__lines", "__removed"])


def _without_lines(text: Column, gone: Column) -> Column:
    """``text`` without the lines numbered in ``gone``, in time linear in both; null where either is null."""

    @F.pandas_udf("binary")
    def run(texts: pd.Series, numbers: pd.Series) -> pd.Series:
        out = []
        for t, g in zip(texts, numbers):
            if t is None or g is None:
                out.append(None)
                continue
            lines = bytes(t).split(b"\n")
            keep = np.ones(len(lines), bool)
            keep[np.asarray(g, np.int64)] = False
            out.append(b"\n".join(lines[i] for i in np.flatnonzero(keep).tolist()))
        return pd.Series(out, dtype=object)

    return run(F.when(gone.isNotNull(), text.cast("binary")), gone).cast("string")


def without_repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without every line that lies in a repeated pair of neighbouring lines, and behind their own columns
    ``__lines`` and ``__removed``, the numbers of lines before and cut.

    A pair is repeated if it stands byte for byte at an earlier place, by id (null ids last), row key and line. A run of two lines or
    more that stands earlier is made of such pairs, so it goes whole, wherever it begins and ends. A cut line has an equal one at an
    earlier place, so the first of equal lines always stays. A line repeated without a neighbour stays.
    Otherwise as ``without_repeated_chunks``.
    """
    docs, names = apart(docs)
    id_col, text_col = names[id_col], names[text_col]
    k1, k2 = row_key(F.col(id_col), F.col(text_col))
    at = repeated_chunks(docs, id_col, text_col, line_pairs)
    gone = at.groupBy("k1", "k2").agg(F.collect_list("pos").alias("__at"))
    gone = gone.select("k1", "k2", F.array_distinct(F.flatten(F.transform("__at", lambda i: F.array(i, i + 1)))).alias("__gone"))
    gone = small_side(store(gone, "gone").withColumnsRenamed({"k1": "__g1", "k2": "__g2"}))
    keyed = docs.withColumns({"__k1": k1, "__k2": k2})
    out = keyed.join(gone, (keyed["__k1"] == gone["__g1"]) & (keyed["__k2"] == gone["__g2"]), "left")
    text = F.col(text_col)
    out = out.withColumn("__left", _without_lines(text, F.col("__gone"))).withColumns({
        "__lines": F.when(text.isNull(), 0).otherwise(F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1),
        "__removed": F.coalesce(F.size("__gone"), F.lit(0)),
        text_col: F.when(F.col("__gone").isNull(), text).otherwise(F.col("__left")),
    })
    return given_back(out, names, ["__lines", "__removed"])
