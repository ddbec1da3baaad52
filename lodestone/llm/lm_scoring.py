"""Stupid-backoff scores: n-gram count tables partitioned by hash, joined to exploded n-grams, summed per document.

The n-grams of a task are kept as packed arrays, one row per block of texts and hash partition, so that a shuffle moves about
seven bytes an n-gram instead of a row.

``ngram_scores`` scores texts by all their counts, to any order. ``lm_scores`` is of order 2, pairs of words backed off to words, with
pruned tables:

    score(w | v) = c(v w) / c(v)     if the pair is in the table
                   0.4 c(w) / N      otherwise

Counts are those of all documents. The tables keep what was seen twice or more; a pair seen once counts as unseen, a word
seen once has count 1. The first word of a text is scored as c(w) / N.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import U, hashes, ngrams, pack, row_key, store, unpack, words

BACKOFF = 0.4
BLOCK_WORDS = 500_000
BYTES_PER_PART = 32 << 20  # bytes of text for each hash partition of the pairs, some four million pairs
HOT_GRAMS = 1 << 14  # n-grams of each length whose counts are sent to every task
HOT_SAMPLE, HOT_LEAST = 64 << 20, 8  # bytes of text in which they are looked for, and how often a block must have them
HOT_PAIRS, HOT_WORDS = 1 << 20, 1 << 22  # bounds of what is sent to every task: 12 MB and 48 MB


class Block(NamedTuple):
    """Texts of a task, up to a number of words or one long text."""

    ids: list
    keys: list[int]
    sizes: np.ndarray
    words: np.ndarray

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.sizes)), self.sizes)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of n words and each one's place; none crosses two texts."""
        if len(self.words) < n:
            return np.zeros(0, U), np.zeros(0, np.int64)
        owner = self.owner
        at = np.flatnonzero(owner[: len(owner) - n + 1] == owner[n - 1 :])
        return ngrams(self.words, n)[at], at

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Pair hashes and the place of each pair's first word; no pair crosses two texts."""
        if len(self.words) < 2:
            return np.zeros(0, U), np.zeros(0, np.int64)
        at = np.flatnonzero(np.diff(self.owner) == 0)
        return ngrams(self.words, 2)[at], at


def _blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[Block]:
    ids, keys, found, size = [], [], [], 0

    def flush() -> Block:
        return Block(ids, keys, np.array([len(f) for f in found], np.int64), np.concatenate(found) if found else np.zeros(0, U))

    for b in batches:
        for at in range(0, b.num_rows, 256):
            part = b.slice(at, 256)
            for i, k, t in zip(part.column("id").to_pylist(), part.column("k1").to_pylist(), part.column("text").to_pylist()):
                ids.append(i)
                keys.append(k)
                found.append(hashes(words(t or b"")))
                size += len(found[-1])
                if size >= most:
                    yield flush()
                    ids, keys, found, size = [], [], [], 0
    if ids:
        yield flush()


def _cut(h: np.ndarray, bits: int) -> np.ndarray:
    """Where each hash partition begins in sorted hashes."""
    edges = (np.arange(1, 1 << bits, dtype=np.uint64) << U(64 - bits)) if bits else np.zeros(0, U)
    return np.concatenate([[0], np.searchsorted(h, edges), [len(h)]])


def _deltas(h: np.ndarray) -> bytes:
    return pack(np.diff(h, prepend=U(0)))


def _sums(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob, U), dtype=U)


def count_tables(rows: DataFrame, bits: dict[int, int], block_words: int) -> DataFrame:
    """Rows ``kind, part, n, h, c``: for words (1) and pairs (2) the hashes seen at least twice, with counts, by hash partition;
    ``n`` is the number of occurrences in the partition."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, block_words):
            for kind, grams in ((1, block.words), (2, block.pairs()[0])):
                h, c = np.unique(grams, return_counts=True)
                edge = _cut(h, bits[kind])
                parts = [p for p in range(1 << bits[kind]) if edge[p] < edge[p + 1]]
                yield pa.RecordBatch.from_pydict({
                    "kind": pa.array([kind] * len(parts), pa.int32()),
                    "part": pa.array(parts, pa.int32()),
                    "h": pa.array([_deltas(h[edge[p] : edge[p + 1]]) for p in parts], pa.binary()),
                    "c": pa.array([pack(c[edge[p] : edge[p + 1]].astype(np.uint32)) for p in parts], pa.binary()),
                })

    def add(group: pd.DataFrame) -> pd.DataFrame:
        h = np.concatenate([_sums(x) for x in group["h"]])
        c = np.concatenate([unpack(x, np.uint32) for x in group["c"]]).astype(np.int64)
        order = np.argsort(h)
        h, c = h[order], c[order]
        first = np.flatnonzero(np.diff(h, prepend=~h[:1]) != 0)
        total = np.add.reduceat(c, first)
        keep = total > 1
        return pd.DataFrame({
            "kind": [group["kind"].iloc[0]], "part": [group["part"].iloc[0]], "n": [int(c.sum())],
            "h": [_deltas(h[first][keep])], "c": [pack(total[keep])],
        })

    exploded = rows.mapInArrow(explode, "kind int, part int, h binary, c binary")
    return exploded.groupBy("kind", "part").applyInPandas(add, "kind int, part int, n bigint, h binary, c binary")


def _hot(counts: DataFrame, kind: int, bound: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The most frequent entries, at most ``bound``, by a threshold of the count: sorted hashes, counts, the threshold."""
    table = counts.where(F.col("kind") == kind)

    def histogram(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for blob in f["c"]:
                c, k = np.unique(unpack(blob, np.int64), return_counts=True)
                yield pd.DataFrame({"c": c, "k": k})

    seen = table.select("c").mapInPandas(histogram, "c bigint, k bigint").groupBy("c").agg(F.sum("k").alias("k"))
    total, least = 0, None
    for row in seen.orderBy(F.desc("c")).toLocalIterator():
        total += row["k"]
        if total > bound:
            break
        least = row["c"]
    if least is None:
        return np.zeros(0, U), np.zeros(0, np.int64), 1 << 62 if total else 2

    def pick(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for hb, cb in zip(f["h"], f["c"]):
                c = unpack(cb, np.int64)
                keep = c >= least
                yield pd.DataFrame({"h": [_sums(hb)[keep].tobytes()], "c": [c[keep].tobytes()]})

    found = table.select("h", "c").mapInPandas(pick, "h binary, c binary").toArrow().to_pydict()
    h = np.frombuffer(b"".join(found["h"]), U)
    c = np.frombuffer(b"".join(found["c"]), np.int64)
    order = np.argsort(h)
    return h[order], c[order], int(least)


def _look(table: tuple[np.ndarray, np.ndarray], h: np.ndarray, absent: int) -> np.ndarray:
    keys, counts = table
    if not len(keys):
        return np.full(len(h), absent, np.int64)
    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
    return np.where(keys[at] == h, counts[at], absent)


def lm_scores(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot_pairs: int = HOT_PAIRS, hot_words: int = HOT_WORDS,
    block_words: int = BLOCK_WORDS, bytes_per_part: int = BYTES_PER_PART,
) -> DataFrame:
    """Per row ``doc_id, n_words, log_score, per_word``: the sum of natural logarithms of the scores, and its mean.

    Words as ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case. A null, empty or blank text has 0 words, score 0 and no mean. Null
    ids stay. Repeated rows count each time and get equal scores. A very long text is one block. An empty table gives no rows.

    The most frequent pairs and words are looked up in broadcast tables of bounded size, which also takes hot keys out of the
    shuffle. All other pairs go to their hash partition of the count table, where whole documents are summed before
    the sums go back to the documents. Pairs with a word outside the broadcast table (where the vocabulary seen twice is larger
    than ``hot_words``) are joined as plain rows to the exploded tables.
    """
    spark = docs.sparkSession
    k1, _ = row_key(F.col(id_col), F.col(text_col))
    rows = docs.select(F.col(id_col).alias("id"), k1.alias("k1"), F.col(text_col).cast("binary").alias("text"))
    id_type = dict(rows.dtypes)["id"]
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    two = max(0, math.ceil(math.log2(max(1, size / bytes_per_part))))
    bits = {1: max(0, two - 3), 2: two}
    counts = store(count_tables(rows, bits, block_words), "ngram-counts")
    total = counts.where("kind = 1").agg(F.sum("n")).first()[0] or 1
    words_h, words_c, least = _hot(counts, 1, hot_words)
    pairs_h, pairs_c, _ = _hot(counts, 2, hot_pairs)
    all_known = least <= 2  # then a word that is not in the table was seen once
    hot = spark.sparkContext.broadcast(((words_h, words_c), (pairs_h, pairs_c)))
    log_n, log_backoff = math.log(total), math.log(BACKOFF)

    def judge(block: Block):
        """Sums that are known at once, the pairs to be looked up, and those with an unknown word."""
        known_words, known_pairs = hot.value
        owner, n = block.owner, len(block.sizes)
        vocabulary, code = np.unique(block.words, return_inverse=True)
        c = _look(known_words, vocabulary, 1 if all_known else 0)
        log_c = np.log(np.maximum(c, 1))
        base = np.zeros(n)
        starts = (np.cumsum(block.sizes) - block.sizes)[block.sizes > 0]
        first_known = c[code[starts]] > 0
        base[owner[starts][first_known]] += log_c[code[starts][first_known]] - log_n
        grams, at = block.pairs()
        h, first, code_h = np.unique(grams, return_index=True, return_inverse=True)
        key, times = np.unique(code_h.astype(np.int64) * max(n, 1) + owner[at], return_counts=True)
        gram, doc = np.divmod(key, max(n, 1))
        v, w = code[at[first]], code[at[first] + 1]
        sure = (c[v] > 0) & (c[w] > 0)
        c_pair = _look(known_pairs, h, 0)
        settled = np.where(c_pair > 0, np.log(np.maximum(c_pair, 1)) - log_c[v], -log_c[v])
        mine = sure[gram]
        base += np.bincount(doc[mine], weights=(settled[gram] * times)[mine], minlength=n)
        unseen = log_backoff + log_c[w] - log_n + log_c[v]
        cold = mine & (c_pair[gram] == 0)
        rare = ~mine
        rest = (vocabulary[v[gram[rare]]], vocabulary[w[gram[rare]]], h[gram[rare]], doc[rare], times[rare])
        lone = (vocabulary[code[starts][~first_known]], owner[starts][~first_known])
        return base, (h[gram[cold]], doc[cold], times[cold], unseen[gram[cold]]), rest, lone

    kind = f"part int, block bigint, ids array<{id_type}>, ks array<bigint>, n array<bigint>, base array<double>, h binary, doc binary, times binary, d binary"

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_list = None
        for block in _blocks(batches, block_words):
            base, (h, doc, times, d), _, _ = judge(block)
            name = int(hashes([np.array(block.keys, np.int64).tobytes()]).view(np.int64)[0])
            edge = _cut(h, two)
            parts = [p for p in range(1 << two) if edge[p] < edge[p + 1]]
            cut = [slice(edge[p], edge[p + 1]) for p in parts]
            id_list = pa.list_(arrow_id)
            none = [None] * len(parts)
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([name % (1 << two), *parts], pa.int32()),
                "block": pa.array([name] * (1 + len(parts)), pa.int64()),
                "ids": pa.array([block.ids, *none], id_list),
                "ks": pa.array([block.keys, *none], pa.list_(pa.int64())),
                "n": pa.array([block.sizes, *none], pa.list_(pa.int64())),
                "base": pa.array([base, *none], pa.list_(pa.float64())),
                "h": pa.array([None, *(_deltas(h[s]) for s in cut)], pa.binary()),
                "doc": pa.array([None, *(pack(doc[s].astype(np.uint32)) for s in cut)], pa.binary()),
                "times": pa.array([None, *(pack(times[s].astype(np.uint32)) for s in cut)], pa.binary()),
                "d": pa.array([None, *(pack(d[s].astype(np.float32)) for s in cut)], pa.binary()),
            })

    from pyspark.sql.pandas.types import to_arrow_type

    arrow_id = to_arrow_type(rows.schema["id"].dataType)
    back = f"block bigint, ids array<{id_type}>, ks array<bigint>, n array<bigint>, base array<double>, doc binary, s binary"

    def look_up(asked: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
        known = (_sums(table["h"].iloc[0]), unpack(table["c"].iloc[0], np.int64)) if len(table) else (np.zeros(0, U), np.zeros(0, np.int64))
        doc, s = [], []
        for hb, db, tb, ub in zip(asked["h"], asked["doc"], asked["times"], asked["d"]):
            if hb is None:
                doc.append(None)
                s.append(None)
                continue
            c = _look(known, _sums(hb), 0)
            value = np.where(c > 0, np.log(np.maximum(c, 1)), unpack(ub, np.float32)) * unpack(tb, np.uint32)
            at, code = np.unique(unpack(db, np.uint32), return_inverse=True)
            doc.append(pack(at))
            s.append(pack(np.bincount(code, weights=value)))
        return asked[["block", "ids", "ks", "n", "base"]].assign(doc=doc, s=s)

    def add(group: pd.DataFrame) -> pd.DataFrame:
        heads = group[group["ids"].notna()]
        copies = len(heads)  # blocks of equal rows throughout have one name; their parts are equal too
        head = heads.iloc[0]
        value = np.array(head["base"])
        for at, s in zip(group["doc"], group["s"]):
            if at is not None:
                value[unpack(at, np.uint32)] += unpack(s, np.float64) / copies
        one = pd.DataFrame({"id": list(head["ids"]), "k1": list(head["ks"]), "n_words": list(head["n"]), "log_score": value})
        return pd.concat([one] * copies)

    asked = rows.mapInArrow(ask, kind)
    pairs = counts.where("kind = 2").select("part", "h", "c")
    summed = asked.groupBy("part").cogroup(pairs.groupBy("part")).applyInPandas(look_up, back)
    out = summed.groupBy("block").applyInPandas(add, f"id {id_type}, k1 bigint, n_words bigint, log_score double")
    if not all_known:
        out = _with_rare(out, rows, judge, counts, (words_h, words_c), log_n, log_backoff, block_words)
    return out.select(
        F.col("id").alias("doc_id"), "n_words", "log_score", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")).alias("per_word")
    )


def _with_rare(out: DataFrame, rows: DataFrame, judge, counts: DataFrame, hot_words, log_n: float, log_backoff: float, block_words: int) -> DataFrame:
    """Add what pairs and first words outside the broadcast words contribute: one row each, joined to the exploded tables."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, block_words):
            _, _, (v, w, h, doc, times), (first, owner) = judge(block)
            keys = np.array(block.keys, np.int64)
            none = pa.nulls(len(first), pa.int64())
            i64 = lambda x: pa.array(x.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[doc]), i64(v), i64(w), i64(h), pa.array(times.astype(np.int64))], ["k1", "v", "w", "h", "times"]
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[owner]), none, i64(first), none, pa.array(np.ones(len(first), np.int64))], ["k1", "v", "w", "h", "times"]
            )

    def entries(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for hb, cb in zip(f["h"], f["c"]):
                yield pd.DataFrame({"g": _sums(hb).view(np.int64), "c": unpack(cb, np.int64)})

    rare = rows.mapInArrow(explode, "k1 bigint, v bigint, w bigint, h bigint, times bigint")
    table = lambda kind, g, c: counts.where(F.col("kind") == kind).select("h", "c").mapInPandas(entries, "g bigint, c bigint").toDF(g, c)
    seen = lambda c: F.log(F.coalesce(c, F.lit(1)).cast("double"))
    rare = rare.join(table(1, "v", "cv"), "v", "left").join(table(1, "w", "cw"), "w", "left").join(table(2, "h", "cp"), "h", "left")
    value = (
        F.when(F.col("v").isNull(), seen(F.col("cw")) - log_n)
        .when(F.col("cp").isNotNull(), seen(F.col("cp")) - seen(F.col("cv")))
        .otherwise(log_backoff + seen(F.col("cw")) - log_n)
    )
    extra = rare.groupBy("k1").agg(F.sum(value * F.col("times")).alias("extra"))
    copies = out.groupBy("k1").agg(F.count(F.lit(1)).alias("copies"))  # equal rows have one key
    extra = extra.join(copies, "k1").select("k1", (F.col("extra") / F.col("copies")).alias("extra"))
    return out.join(extra, "k1", "left").withColumn("log_score", F.col("log_score") + F.coalesce("extra", F.lit(0.0)))


def _weights(block: Block, n: int, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text and weight of every n-gram of a block: how often the logarithm of its count enters the text's score.

    In a product of c(n-gram) / c(its first n - 1 words) the counts up to ``order`` - 2 cancel out: each is once above and once below
    the line. Left are the counts of the longest n-grams above, and below those of the n-grams one shorter that are followed by a word
    and do not begin the text. A text of fewer words than ``order`` has the count of its words together above.
    """
    h, at = block.grams(n)
    owner = block.owner[at]
    size, j = block.sizes[owner], at - (np.cumsum(block.sizes) - block.sizes)[owner]
    if n == order:
        return h, owner, np.ones(len(h), np.int64)
    inner = (j >= 1) & (j <= size - order) if n == order - 1 else np.zeros(len(h), bool)
    return h, owner, (size == n).astype(np.int64) - inner


def _gathered(h: np.ndarray, owner: np.ndarray, weight: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One entry per n-gram and text, sorted by hash, with occurrences and summed weight. What has no weight is only counted, under text 0."""
    names, code = np.unique(h, return_inverse=True)
    key, code = np.unique(code.astype(np.int64) * max(texts, 1) + np.where(weight == 0, 0, owner), return_inverse=True)
    gram, doc = np.divmod(key, max(texts, 1))
    times, sums = np.bincount(code, minlength=len(key)), np.bincount(code, weights=weight, minlength=len(key))
    return names[gram], doc.astype(np.uint32), times.astype(np.uint32), sums.astype(np.int32)


def _hot_grams(rows: DataFrame, size: int, order: int, bound: int, block_words: int) -> tuple[dict[int, tuple[np.ndarray, np.ndarray]], int]:
    """The n-grams of each length that are most frequent in some of the texts, with their counts in all texts, and the number of all words.

    Which n-grams these are decides only where they are looked up, never a score.
    """

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, block_words):
            for n in range(1, order + 1):
                h, c = np.unique(block.grams(n)[0], return_counts=True)
                keep = c >= HOT_LEAST
                yield pa.RecordBatch.from_pydict({
                    "n": pa.array(np.full(keep.sum(), n, np.int32)), "h": pa.array(h[keep].view(np.int64)), "c": pa.array(c[keep].astype(np.int64)),
                })

    some = rows.where(F.pmod("k1", F.lit(max(1, size // HOT_SAMPLE))) == 0)
    seen = some.mapInArrow(frequent, "n int, h bigint, c bigint").groupBy("n", "h").agg(F.sum("c").alias("c"))
    seen = store(seen, "frequent-grams")
    pick = lambda n: seen.where(F.col("n") == n).orderBy(F.desc("c"), "h").limit(bound).select("h").toArrow().column("h").to_numpy()
    names = {n: np.sort(pick(n).astype(np.int64).view(U)) for n in range(1, order + 1)}
    asked = rows.sparkSession.sparkContext.broadcast(names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, sums = 0, {n: np.zeros(len(x), np.int64) for n, x in asked.value.items()}
        for block in _blocks(batches, block_words):
            words += len(block.words)
            for n, known in asked.value.items():
                if len(known):
                    h = block.grams(n)[0]
                    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                    sums[n] += np.bincount(at[known[at] == h], minlength=len(known))
        for n, c in [(0, np.array([words])), *sums.items()]:
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_pydict({"n": pa.array(np.full(len(at), n, np.int32)), "at": pa.array(at.astype(np.int32)), "c": pa.array(c[at].astype(np.int64))})

    found = rows.mapInArrow(count, "n int, at int, c bigint").groupBy("n", "at").agg(F.sum("c").alias("c")).toArrow()
    n, at, c = (found.column(x).to_numpy() for x in ("n", "at", "c"))
    hot = {}
    for k, known in names.items():
        totals = np.zeros(len(known), np.int64)
        totals[at[n == k]] = c[n == k]
        hot[k] = (known, totals)
    return hot, int(c[n == 0].sum())


def ngram_scores(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = 3, hot_grams: int = HOT_GRAMS,
    block_words: int = BLOCK_WORDS, bytes_per_part: int = BYTES_PER_PART,
) -> DataFrame:
    """Per row ``doc_id, n_words, log_score, per_word`` as ``lm_scores``, by n-grams up to ``order`` words (2 or more) and all their
    counts, those of n-grams seen once too.

        score(w | u v) = c(u v w) / c(u v)

    and likewise with the words there are at a text's start, whose first word is scored as c(w) / N. The texts are those that are
    counted, so each of their n-grams has a count and no place backs off.

    The most frequent n-grams are counted first and sent to every task, which takes hot keys out of the shuffle. All others meet
    once in their hash partition, where they are counted and each text's share is summed; the sums go back to the texts.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    if order < 2:
        raise ValueError("the order must be 2 or more")
    k1, _ = row_key(F.col(id_col), F.col(text_col))
    rows = docs.select(F.col(id_col).alias("id"), k1.alias("k1"), F.col(text_col).cast("binary").alias("text"))
    id_type, arrow_id = dict(rows.dtypes)["id"], to_arrow_type(rows.schema["id"].dataType)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(0, math.ceil(math.log2(max(1, size / bytes_per_part))))
    found, total = _hot_grams(rows, size, order, hot_grams, block_words)
    hot, log_n = docs.sparkSession.sparkContext.broadcast(found), math.log(max(1, total))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, block_words):
            base = np.where(block.sizes > 0, -log_n, 0.0)
            name = int(hashes([np.array(block.keys, np.int64).tobytes()]).view(np.int64)[0])
            kind, part, packed = [order], [name % (1 << bits)], [(None,) * 4]
            for n in range(1, order + 1):
                h, doc, times, weight = _gathered(*_weights(block, n, order), len(block.sizes))
                count = _look(hot.value[n], h, 0)
                base += np.bincount(doc, weights=np.log(np.maximum(count, 1)) * weight, minlength=len(base))
                h, doc, times, weight = (x[count == 0] for x in (h, doc, times, weight))
                edge = _cut(h, bits)
                for p in range(1 << bits):
                    if edge[p] < edge[p + 1]:
                        s = slice(edge[p], edge[p + 1])
                        kind.append(n)
                        part.append(p)
                        packed.append((_deltas(h[s]), pack(doc[s]), pack(times[s]), pack(weight[s])))
            none = [None] * (len(part) - 1)
            yield pa.RecordBatch.from_pydict({
                "kind": pa.array(kind, pa.int32()), "part": pa.array(part, pa.int32()), "block": pa.array([name] * len(part), pa.int64()),
                "ids": pa.array([block.ids, *none], pa.list_(arrow_id)), "ks": pa.array([block.keys, *none], pa.list_(pa.int64())),
                "n": pa.array([block.sizes, *none], pa.list_(pa.int64())), "base": pa.array([base, *none], pa.list_(pa.float64())),
                **{c: pa.array([x[i] for x in packed], pa.binary()) for i, c in enumerate(("h", "doc", "times", "w"))},
            })

    def count(asked: pd.DataFrame) -> pd.DataFrame:
        doc, s = [None] * len(asked), [None] * len(asked)
        at = [i for i, x in enumerate(asked["h"]) if x is not None]
        if at:
            parts = [_sums(asked["h"].iloc[i]) for i in at]
            h = np.concatenate(parts)
            by = np.argsort(h, kind="stable")
            h = h[by]
            first = np.diff(h, prepend=~h[:1]) != 0
            times = np.concatenate([unpack(asked["times"].iloc[i], np.uint32) for i in at]).astype(np.int64)[by]
            totals = np.add.reduceat(times, np.flatnonzero(first))
            log_c = np.empty(len(h))
            log_c[by] = np.log(totals)[np.cumsum(first) - 1]
            end = 0
            for i, p in zip(at, parts):
                value = log_c[end : end + len(p)] * unpack(asked["w"].iloc[i], np.int32)
                end += len(p)
                keep = value != 0
                names, code = np.unique(unpack(asked["doc"].iloc[i], np.uint32)[keep], return_inverse=True)
                if len(names):
                    doc[i], s[i] = pack(names), pack(np.bincount(code, weights=value[keep]))
        out = asked[["block", "ids", "ks", "n", "base"]].assign(doc=doc, s=s)
        return out[out["ids"].notna() | out["doc"].notna()]

    def add(group: pd.DataFrame) -> pd.DataFrame:
        heads = group[group["ids"].notna()]
        copies = len(heads)  # blocks of equal rows throughout have one name; their parts are equal too
        head = heads.iloc[0]
        value = np.array(head["base"])
        for at, s in zip(group["doc"], group["s"]):
            if at is not None:
                value[unpack(at, np.uint32)] += unpack(s, np.float64) / copies
        one = pd.DataFrame({"id": list(head["ids"]), "k1": list(head["ks"]), "n_words": list(head["n"]), "log_score": value})
        return pd.concat([one] * copies)

    head = f"block bigint, ids array<{id_type}>, ks array<bigint>, n array<bigint>, base array<double>"
    asked = rows.mapInArrow(ask, f"kind int, part int, {head}, h binary, doc binary, times binary, w binary")
    summed = asked.groupBy("kind", "part").applyInPandas(count, f"{head}, doc binary, s binary")
    out = summed.groupBy("block").applyInPandas(add, f"id {id_type}, k1 bigint, n_words bigint, log_score double")
    return out.select(
        F.col("id").alias("doc_id"), "n_words", "log_score", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")).alias("per_word")
    )
