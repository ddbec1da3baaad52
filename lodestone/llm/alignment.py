"""Links between the tokens that two tokenizers cut a text into, by products of incidence matrices.

A token-byte incidence matrix has a row a token and a column a byte. In compressed rows (CSR), Gustavson's row products of one tokenizer's
matrix with the other's transpose give the links: over all bytes of a token those that overlap, over its last byte alone those that end
together. Products of token-group incidences link the tokens of a group.

Both tokenizers cut before a single space that a plain letter or sign follows, so a text is a chain of chunks whose products do not
touch: the matrix of a block of texts is block-diagonal, and each distinct chunk's products are made once. Counts of linked id pairs are
summed over the corpus from the blocks' distinct pairs, and come back to the blocks with one join on the pair.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import pack, store, unpack

#: UTF-8 bytes of the texts of a block, about.
BLOCK_BYTES = 8 << 20
#: Distinct chunks whose products a worker keeps, and the longest that it keeps.
KEPT, KEPT_CHARS = 200_000, 64

#: A single space before a graphic ASCII character or a Latin letter with a mark: a pre-token and a piece begin here.
_CUT = re.compile("(?<! ) (?=[!-~À-ɏ])")


class Csr(NamedTuple):
    """Rows ``indices[indptr[i]:indptr[i + 1]]`` with ``data`` beside them."""

    indptr: np.ndarray
    indices: np.ndarray
    data: np.ndarray
    width: int

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.indptr) - 1), np.diff(self.indptr))


def csr(indptr: np.ndarray, indices: np.ndarray, width: int) -> Csr:
    return Csr(np.asarray(indptr, np.int64), np.asarray(indices, np.int64), np.ones(len(indices), np.int64), width)


def pointers(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def transposed(m: Csr) -> Csr:
    """Entries counted and dealt out by column."""
    order = np.argsort(m.indices, kind="stable")
    return Csr(pointers(np.bincount(m.indices, minlength=m.width)), m.rows()[order], m.data[order], len(m.indptr) - 1)


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of several slices, one after another."""
    at = pointers(sizes)
    return np.arange(at[-1]) - np.repeat(at[:-1] - starts, sizes)


def product(a: Csr, b: Csr) -> Csr:
    """Gustavson: row i is the sum of the rows of ``b`` that the entries of row i of ``a`` name, each times its entry."""
    sizes = np.diff(b.indptr)[a.indices]
    places = ragged(b.indptr[a.indices], sizes)
    key = np.repeat(a.rows(), sizes) * max(b.width, 1) + b.indices[places]
    terms = np.repeat(a.data, sizes) * b.data[places]
    if len(key) and (np.diff(key) < 0).any():
        order = np.argsort(key, kind="stable")
        key, terms = key[order], terms[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    key, sums = key[first], np.add.reduceat(terms, first) if len(first) else terms
    return Csr(pointers(np.bincount(key // max(b.width, 1), minlength=len(a.indptr) - 1)), key % max(b.width, 1), sums, b.width)


class Alignment(NamedTuple):
    """Of token sequences that cover the same bytes: common ends, each token's group, and the matrices of links."""

    ends: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    ending: Csr
    overlap: Csr | None = None
    shared: Csr | None = None


def align(ends_a: np.ndarray, ends_b: np.ndarray, links: str = "end") -> Alignment:
    """Tokens are given by the offsets of their ends. ``links``: ``end`` only, or ``all``: overlaps (entry: bytes) and shared groups too."""
    n = int(ends_a[-1]) if len(ends_a) else 0
    last = lambda ends: csr(np.arange(len(ends) + 1), ends - 1, n)
    ending = product(last(ends_a), transposed(last(ends_b)))
    common = ends_a[np.diff(ending.indptr) > 0]
    group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
    if links == "end":
        return Alignment(common, group_a, group_b, ending)
    spans = lambda ends: csr(np.concatenate([[0], ends]), np.arange(n), n)
    within = lambda group: csr(np.arange(len(group) + 1), group, len(common))
    return Alignment(
        common, group_a, group_b, ending, product(spans(ends_a), transposed(spans(ends_b))), product(within(group_a), transposed(within(group_b)))
    )


# -- the two tokenizers ------------------------------------------------------------------------------


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 for itself, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Pair:
    """Tokenizer A (byte-level BPE, ``.json``) and B (pieces with byte fallback, ``.model``), and the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a worker for each core
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        before = spec.get("pre_tokenizer") or {}
        if before.get("type") != "ByteLevel" or before.get("add_prefix_space") or spec.get("normalizer") or spec["model"]["type"] != "BPE":
            raise ValueError(f"{path_a}: not a byte-level BPE without normalizer")
        letters = byte_letters()
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        vocabulary = spec["model"]["vocab"]
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(map(letters.get, token)) if letters.keys() >= set(token) else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError(f"{path_b}: a piece spans a space, so chunks are not cut there")
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.lengths_a, self.lengths_b = (np.array([len(t) for t in table], np.int64) for table in (self.bytes_a, self.bytes_b))
        self.width = len(pieces)
        self.names = np.array([str(i) for i in range(max(len(self.bytes_a), self.width))], object)
        self.kept: dict[str, tuple] = {}

    def encoded(self, chunks: list[str]) -> list[tuple[list[int], list[int]] | None]:
        """Ids of each chunk behind its space; None where the tokens' bytes are not the chunk's."""
        whole = [" " + c for c in chunks]
        raw = [w.encode() for w in whole]
        all_a = [x.ids for x in self.a.encode_batch_fast(whole, add_special_tokens=False)]
        all_b = self.b.encode(chunks, num_threads=1)
        fits = [all(b"".join([t[i] for i in ids]) == r for t, ids in ((self.bytes_a, a), (self.bytes_b, b))) for a, b, r in zip(all_a, all_b, raw)]
        return [(a, b) if fit else None for a, b, fit in zip(all_a, all_b, fits)]

    def products(self, chunks: list[str]) -> list[tuple]:
        """For each chunk ``(fits, n_a, n_b, n_groups, groups, linked pairs a * width + b)``."""
        out = []
        for start in range(0, len(chunks), 8192):
            found = self.encoded(chunks[start : start + 8192])
            fit = [x for x in found if x]
            n_a, n_b = (np.array([len(x[k]) for x in fit], np.int64) for k in (0, 1))
            ids_a, ids_b = (np.fromiter(chain.from_iterable(x[k] for x in fit), np.int64) for k in (0, 1))
            ends_a, ends_b = np.cumsum(self.lengths_a[ids_a]), np.cumsum(self.lengths_b[ids_b])
            at = align(ends_a, ends_b)
            pairs = ids_a[at.ending.rows()] * self.width + ids_b[at.ending.indices]
            # chunks end together, so groups and links never reach over from one to the next
            at_a, at_b = pointers(n_a), pointers(n_b)
            links = at.ending.indptr[at_a]
            groups = np.append(at.group_a, len(at.ends))[at_a]
            text = self._signs(ids_a, ids_b, at)
            signs = at_a + at_b
            made = zip(*(x.tolist() for x in (n_a, n_b, np.diff(groups), signs[:-1], signs[1:], links[:-1], links[1:])))
            made = iter([(True, a, b, g, "".join(text[r:s])[:-1], pairs[p:q]) for a, b, g, r, s, p, q in made])
            out += [next(made) if x else (False, 0, 0, 0, "", pairs[:0]) for x in found]
        return out

    def _signs(self, ids_a: np.ndarray, ids_b: np.ndarray, at: Alignment) -> list[str]:
        """Each token's number and the sign behind it, group by group, A before B."""
        n = len(at.ends)
        before_a, before_b = (pointers(np.bincount(g, minlength=n)) for g in (at.group_a, at.group_b))
        out = np.empty(len(ids_a) + len(ids_b), object)
        for ids, group, others, last in ((ids_a, at.group_a, before_b[:-1], "|"), (ids_b, at.group_b, before_a[1:], ";")):
            names = self.names[ids] + ","
            ends = np.append(group[1:] != group[:-1], True) if len(group) else np.zeros(0, bool)
            names[ends] = self.names[ids[ends]] + last
            out[np.arange(len(ids)) + others[group]] = names
        return out.tolist()

    def __call__(self, chunks: list[str], times: list[int]) -> list[tuple]:
        if len(self.kept) > KEPT:
            self.kept.clear()
        new = [c for c in chunks if c not in self.kept]
        made = dict(zip(new, self.products(new)))
        # chunks that come up once in a block seldom come up in the next
        self.kept.update((c, made[c]) for c, n in zip(chunks, times) if n > 1 and c in made and len(c) <= KEPT_CHARS)
        return [made[c] if c in made else self.kept[c] for c in chunks]


_PAIRS: dict[tuple[str, str], Pair] = {}  # one per worker process and files


def chunks(text: str) -> list[str]:
    """The chunks of a text, each without the space before it."""
    first, *rest = _CUT.split(" " + text)
    return [first[1:], *rest] if first else rest


class _Numbers(dict):
    def __missing__(self, key: str) -> int:
        n = self[key] = len(self)
        return n


def block(pair: Pair, rows: list[tuple[int | None, str | None]]) -> dict:
    """Per-text results of a block of rows, and what its scores need: distinct pairs, pairs of chunks, chunks of texts."""
    numbers = _Numbers()
    texts = [np.fromiter(map(numbers.__getitem__, chunks(t)), np.int64) if t else np.zeros(0, np.int64) for _, t in rows]
    times = np.bincount(np.concatenate([*texts, np.zeros(0, np.int64)]), minlength=len(numbers))
    found = pair(list(numbers), times.tolist())
    fits, n_a, n_b, n_groups = (np.array([x[k] for x in found], np.int64) for k in range(4))
    texts = [t if fits[t].all() else t[:0] for t in texts]
    strings = [x[4] for x in found]
    n_links = np.array([len(x[5]) for x in found], np.int64)
    all_texts = np.concatenate([*texts, np.zeros(0, np.int64)])
    times = np.bincount(all_texts, minlength=len(found))
    pairs = np.concatenate([x[5] for x in found] or [np.zeros(0, np.int64)])
    codes, at = np.unique(pairs, return_inverse=True)
    weights = np.zeros(len(codes), np.int64)
    np.add.at(weights, at, np.repeat(times, n_links))
    return {
        "doc_id": [k for k, _ in rows],
        **{name: [int(of[t].sum()) for t in texts] for name, of in (("n_a", n_a), ("n_b", n_b), ("n_groups", n_groups), ("n_links", n_links))},
        "groups_sha256": [hashlib.sha256(";".join([strings[i] for i in t.tolist()]).encode()).hexdigest() if len(t) else "" for t in texts],
        "codes": codes, "times": weights,
        "links": pack(at.astype(np.uint32)), "chunk_links": pack(n_links.astype(np.uint32)),
        "texts": pack(all_texts.astype(np.uint32)), "text_chunks": pack(np.array([len(t) for t in texts], np.uint32)),
    }


_SCHEMA = pa.schema([
    ("block", pa.string()), ("doc_id", pa.list_(pa.int64())), *((c, pa.list_(pa.int64())) for c in ("n_a", "n_b", "n_groups", "n_links")),
    ("groups_sha256", pa.list_(pa.string())), ("codes", pa.list_(pa.int64())), ("times", pa.list_(pa.int64())),
    *((c, pa.binary()) for c in ("links", "chunk_links", "texts", "text_chunks")),
])
_BLOCK = (
    "block string, doc_id array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, n_links array<bigint>, "
    "groups_sha256 array<string>, codes array<bigint>, times array<bigint>, links binary, chunk_links binary, texts binary, text_chunks binary"
)
_OUT = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def _blocks(docs: DataFrame, path_a: str, path_b: str, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = path_a, path_b
        pair = _PAIRS.get(files) or _PAIRS.setdefault(files, Pair(*files))
        made = 0

        def out(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"block": f"{TaskContext.get().partitionId()}-{made}", **block(pair, rows)}], schema=_SCHEMA)

        held, held_bytes = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                raw = batch.column("text")[i].as_py() or b""
                try:
                    text = raw.decode()
                except UnicodeDecodeError:  # no tokens have these bytes
                    text = None
                held.append((batch.column("doc_id")[i].as_py(), text))
                held_bytes += len(raw) + 64
                if held_bytes >= size:
                    yield out(held)
                    made, held, held_bytes = made + 1, [], 0
        if held:
            yield out(held)

    return docs.mapInArrow(run, _BLOCK)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive slices, in integers."""
    total, at = np.concatenate([[0], np.cumsum(values, dtype=np.int64)]), pointers(sizes)
    return total[at[1:]] - total[at[:-1]]


def _scored(blocks: pa.Table, answers: pa.Table) -> pa.Table:
    """One block's texts with the sums over their links, from the counts of its pairs."""
    order = np.argsort(answers["code"].to_numpy())
    row = blocks.to_pylist()[0]
    links, chunk_links, texts, text_chunks = (unpack(row[c], np.uint32).astype(np.int64) for c in ("links", "chunk_links", "texts", "text_chunks"))
    out = {c: row[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
    for name, column in (("n_best", "best"), ("count_sum", "n")):
        values = answers[column].to_numpy()[order].astype(np.int64)
        out[name] = _sums(_sums(values[links] if len(links) else links, chunk_links)[texts] if len(texts) else texts, text_chunks)
    out["groups_sha256"] = row["groups_sha256"]
    return pa.table(out, schema=_OUT_SCHEMA)


_OUT_SCHEMA = pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in _OUT.split(", ")])


def aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", size: int = BLOCK_BYTES) -> DataFrame:
    """Per row ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    A encodes a space and the text, B the text, special strings as plain text. Links join tokens that end together; a pair's count is
    the number of links in the whole corpus that hold it. ``n_best`` are the links whose count is the highest of their B token. Null and
    empty texts, and texts that either tokenizer does not give back byte for byte, have no tokens: zeros and ''. Null ids and repeated
    rows stay, one row each; repeated texts count each time. A very long text is a block of its own. An empty table gives no rows. Other
    columns are not read. Both files must exist on every executor.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    blocks = store(_blocks(rows, path_a, path_b, size), "aligned-blocks")
    pairs = blocks.select(F.col("block").alias("asker"), F.explode(F.arrays_zip("codes", "times")).alias("p"))
    pairs = pairs.select("asker", F.col("p.codes").alias("code"), F.col("p.times").alias("times"))
    counts = store(pairs.groupBy("code").agg(F.sum("times").alias("n")), "pair-counts")
    # the B tokens are a vocabulary, so what is broadcast has that many rows at most
    b_id = F.pmod(F.col("code"), F.lit(_width(path_b))).alias("b")
    highest = counts.groupBy(b_id).agg(F.max("n").alias("highest"))
    judged = counts.withColumn("b", b_id).join(F.broadcast(highest), "b").select("code", "n", (F.col("n") == F.col("highest")).cast("bigint").alias("best"))
    answers = pairs.select("asker", "code").join(judged, "code")
    return blocks.groupBy("block").cogroup(answers.groupBy("asker")).applyInArrow(_scored, _OUT)


def _width(path_b: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
