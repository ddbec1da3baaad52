"""Helpers the operators of this package share: intermediate tables, row keys, word hashes, packed arrays."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.session import scratch_path, shared_dir

U = np.uint64
word_hash = xxhash.xxh3_64_intdigest


def store(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back: lost executors recompute nothing behind it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def row_key(*columns: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes that stand for the row's id and text; equal rows have equal keys, a null differs from an empty text."""
    parts = [x for c in columns for x in (c.isNull(), c)]
    return F.xxhash64(F.lit(1), *parts), F.xxhash64(F.lit(2), *parts)


def free_name(name: str, taken: Iterable[str]) -> str:
    """``name`` with as many underscores behind it as make it differ from the taken ones in any case."""
    taken = {t.lower() for t in taken}
    while name.lower() in taken:
        name += "_"
    return name


def apart(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The table with every column that begins with two underscores, as this package's own working columns do, under another name,
    and the name of each column there."""
    names: dict[str, str] = {}
    for c in docs.columns:
        names[c] = free_name(f"kept{c}", [*docs.columns, *names.values()]) if c.startswith("__") else c
    moved = {c: n for c, n in names.items() if c != n}
    return (docs.withColumnsRenamed(moved) if moved else docs), names


def given_back(out: DataFrame, names: dict[str, str], own: Iterable[str] = ()) -> DataFrame:
    """The caller's columns under their names, then the operator's ``own``, with underscores behind a name that the caller has."""
    quoted = lambda c: F.col("`" + c.replace("`", "``") + "`")
    return out.select(*[quoted(n).alias(c) for c, n in names.items()], *[F.col(c).alias(free_name(c, names)) for c in own])


def unit(h: Column) -> Column:
    """A 64-bit hash as a number in [0, 1)."""
    return F.shiftrightunsigned(h, 11).cast("double") * F.lit(2.0**-53)


def texts(column: pa.Array | pa.ChunkedArray, step: int = 256) -> Iterator[bytes | None]:
    """The values of a binary column, some hundred at a time, so a batch is not held twice."""
    for at in range(0, len(column), step):
        yield from column.slice(at, step).to_pylist()


def hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(word_hash, words), U, len(words))


def words(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case; bytes methods treat ASCII only."""
    return text.lower().split()


#: Every ASCII character that is neither letter nor digit as a space; other bytes stay.
_PLAIN = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def plain_words(text: bytes) -> list[bytes]:
    """Lower-case words without ASCII punctuation."""
    return text.lower().translate(_PLAIN).split()


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 (the finalizer of a public 64-bit hash)."""
    h = (h ^ (h >> U(33))) * U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U(33))


def ngrams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n consecutive words at each place."""
    size = len(h) - n + 1
    if size <= 0:
        return h[:0]
    out = mix(h[:size] + U(n))
    for k in range(1, n):
        out = mix(out * U(0x9E3779B97F4A7C15) + h[k : k + size])
    return out


def pack(values: np.ndarray) -> bytes:
    """A numeric array as compressed bytes, same-rank bytes together."""
    import zstandard

    raw = np.ascontiguousarray(values)
    planes = raw.view(np.uint8).reshape(len(raw), raw.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(blob: bytes, dtype) -> np.ndarray:
    import zstandard

    kind = np.dtype(dtype)
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.ascontiguousarray(flat.reshape(kind.itemsize, -1).T).view(kind).ravel()
