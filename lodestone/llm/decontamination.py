"""Benchmark decontamination: a BM25 index of the test items, asked by every passage through block-max WAND, then an overlap check."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import plain_words

ITEMS_PER_INDEX = 20_000  # a larger benchmark is asked in several indexes of at most about this many items each
SUPERBLOCKS = 128
BLOCK = 8


class Index(NamedTuple):
    """Items in order; per term the items that have it and their share of the item's own BM25 score."""

    ids: list
    vocabulary: dict[bytes, int]
    postings: list[tuple[list[int], list[float]]]
    block_max: list[list[float]]  # per term and block of items
    bounds: np.ndarray  # per term and superblock, for the first test of a passage
    parts: list[tuple[set, set, int]]  # question n-grams, answer n-grams, n
    step: int  # words between passages: the longest item's


def question_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """The last sentence is the answer; of a single sentence, the last third of its words."""
    sentences = [s for s in re.split(r"(?<=[.!?])\s+", text.strip()) if plain_words(s.encode())]
    if len(sentences) > 1:
        return plain_words(" ".join(sentences[:-1]).encode()), plain_words(sentences[-1].encode())
    w = plain_words(text.encode())
    k = max(1, len(w) * 2 // 3)
    return w[:k], w[k:] or w


def _grams(w: list[bytes], n: int) -> set:
    k = min(n, len(w))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if k else set()


def _terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per item its distinct words and their counts; items without words drop out."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(lambda t: plain_words(t or b""))

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    words = F.pandas_udf(run, "array<binary>")(F.col(text_col).cast("binary"))
    return items.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), words.alias("w")).where(F.size("w") > 0)


def build_indexes(items: DataFrame, id_col: str = "item_id", text_col: str = "text", k1: float = 1.2, b: float = 0.75, per_index: int = ITEMS_PER_INDEX) -> list[Index]:
    """Indexes of bounded size over all items. Document frequencies and the mean length are those of the whole benchmark.

    Items are ordered by length, so that a block's items have like weights.
    """
    rows = _terms(items, id_col, text_col)
    n, mean, longest = rows.agg(F.count(F.lit(1)), F.avg(F.size("w")), F.max(F.size("w"))).first()
    if not n:
        return []
    shards = -(-n // per_index)
    keyed = rows.withColumn("shard", F.pmod(F.xxhash64("text"), F.lit(shards)))
    flat = keyed.select("shard", "id", F.explode(F.array_distinct("w")).alias("word"))
    seen = flat.groupBy("word").agg(F.countDistinct("id").alias("df"))
    out = []
    for s in range(shards):
        own = flat.where(F.col("shard") == s).select("word").distinct()
        df = {bytes(r["word"]): r["df"] for r in seen.join(own, "word").toLocalIterator()}
        found = sorted(keyed.where(F.col("shard") == s).select("id", "text", "w").toLocalIterator(), key=lambda r: (len(r["w"]), str(r["id"])))
        vocabulary: dict[bytes, int] = {}
        postings: list[tuple[list[int], list[float]]] = []
        parts = []
        for i, r in enumerate(found):
            words = [bytes(w) for w in r["w"]]
            weight = {}
            for w in dict.fromkeys(words):
                tf, idf = words.count(w), np.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5))
                weight[w] = idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(words) / mean))
            own_score = sum(weight.values())
            for w, x in weight.items():
                t = vocabulary.setdefault(w, len(vocabulary))
                if t == len(postings):
                    postings.append(([], []))
                postings[t][0].append(i)
                postings[t][1].append(float(x / own_score))
            q, a = question_answer(r["text"])
            parts.append((_grams(q, 5), _grams(a, 5), (min(5, len(q)), min(5, len(a)))))
        blocks = -(-len(found) // BLOCK)
        per = max(1, -(-len(found) // SUPERBLOCKS))
        bounds = np.zeros((len(postings) + 1, SUPERBLOCKS))
        block_max = [[0.0] * blocks for _ in postings]
        for t, (at, xs) in enumerate(postings):
            for i, x in zip(at, xs):
                block_max[t][i // BLOCK] = max(block_max[t][i // BLOCK], x)
                bounds[t, i // per] = max(bounds[t, i // per], x)
        out.append(Index([r["id"] for r in found], vocabulary, postings, block_max, bounds, parts, max(32, longest)))
    return out


def block_max_wand(index: Index, terms: list[int], least: float) -> list[tuple[int, float]]:
    """All items whose weights over ``terms`` add up to ``least`` or more, with their scores."""
    n = len(index.ids)
    cursors = [[0, t, index.postings[t][0], index.postings[t][1], max(index.postings[t][1])] for t in terms]
    found, slack = [], least - 1e-9

    def at(c: list) -> int:
        return c[2][c[0]] if c[0] < len(c[2]) else n

    def seek(c: list, item: int) -> None:
        c[0] = bisect_left(c[2], item, c[0])

    while True:
        cursors = sorted((c for c in cursors if at(c) < n), key=at)
        total, pivot = 0.0, -1
        for k, c in enumerate(cursors):
            total += c[4]
            if total >= slack:
                pivot = k
                break
        if pivot < 0:
            return found
        item = at(cursors[pivot])
        while pivot + 1 < len(cursors) and at(cursors[pivot + 1]) == item:
            pivot += 1
        block = item // BLOCK
        if sum(index.block_max[c[1]][block] for c in cursors[: pivot + 1]) < slack:
            after = min([(block + 1) * BLOCK] + [at(c) for c in cursors[pivot + 1 : pivot + 2]])
            for c in cursors[: pivot + 1]:
                seek(c, max(after, item + 1))
        elif at(cursors[0]) == item:
            score = sum(c[3][c[0]] for c in cursors[: pivot + 1])
            if score >= slack:
                found.append((item, score))
            for c in cursors[: pivot + 1]:
                c[0] += 1
        else:
            for c in cursors[:pivot]:
                seek(c, item)


def passages(index: Index, ids: np.ndarray, least: float, span: int = 256) -> Iterator[tuple[int, list[int]]]:
    """First words, and distinct terms, of the passages that may reach the threshold.

    Passages are two steps long, one step apart, so that any stretch as long as the longest item lies in one. Term maxima of a
    superblock, summed over a passage's distinct terms, bound the score of the superblock's items.
    """
    step, size = index.step, len(index.postings) + 1
    last = max(1, -(-(len(ids) - step) // step))  # number of passages
    place = np.flatnonzero(ids >= 0)
    terms = ids[place]
    cell = place // step  # a word belongs to the passage that begins in its step and to the one before
    for at in range(0, last, span):
        lo, hi = np.searchsorted(cell, (at, at + span + 1))
        both = np.concatenate([cell[lo:hi], cell[lo:hi] - 1])
        inside = (both >= at) & (both < min(at + span, last))
        keys = np.unique(both[inside] * size + np.concatenate([terms[lo:hi]] * 2)[inside])
        if not len(keys):
            continue
        owner, term = np.divmod(keys, size)
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        sums = np.add.reduceat(index.bounds[term], first, axis=0)
        ends = np.append(first[1:], len(keys))
        for k in np.flatnonzero(sums.max(axis=1) >= least - 1e-6):
            yield int(owner[first[k]]) * step, term[first[k] : ends[k]].tolist()


def search(index: Index, text: bytes, least: float, question: float, answer: float) -> list[tuple[int, float, float, float]]:
    """Verified matches of a whole text: item number, best score, overlap of question and of answer."""
    words = plain_words(text)
    ids = np.fromiter(map(index.vocabulary.get, words, repeat(-1)), np.int64, len(words))
    best: dict[int, tuple[float, float, float]] = {}
    for s, terms in passages(index, ids, least):
        hits = block_max_wand(index, terms, least)
        w = words[s : s + 2 * index.step]
        for item, score in hits:
            qs, as_, (nq, na) = index.parts[item]
            q = len(qs & _grams(w, nq)) / len(qs) if qs else 1.0
            a = len(as_ & _grams(w, na)) / len(as_) if as_ else 1.0
            if q >= question and a >= answer and (score, q, a) > best.get(item, (0.0, 0.0, 0.0)):
                best[item] = (score, q, a)
    return [(i, *v) for i, v in sorted(best.items())]


def matches(
    spark, text: Column, indexes: list[Index], id_type: str, least: float = 0.6, question: float = 0.5, answer: float = 0.5
) -> Column:
    """A column with the verified items of each text as an array of structs."""
    kind = f"array<struct<item_id:{id_type},score:double,question_overlap:double,answer_overlap:double>>"
    if not indexes:
        return F.array().cast(kind)

    def ask(index: Index) -> Column:
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            ix = shared.value
            for texts in batches:
                yield pd.Series(
                    [
                        [
                            {"item_id": ix.ids[i], "score": s, "question_overlap": q, "answer_overlap": a}
                            for i, s, q, a in search(ix, t or b"", least, question, answer)
                        ]
                        for t in texts
                    ],
                    dtype=object,
                )

        run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
        return F.pandas_udf(run, kind)(text.cast("binary"))

    return F.flatten(F.array(*[ask(ix) for ix in indexes]))


def contaminated(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", **how
) -> DataFrame:
    """Rows ``doc_id, item_id, score, question_overlap, answer_overlap`` of every document that holds a test item.

    ``score`` is the share of the item's own BM25 score that the best passage reaches; ``least``, ``question`` and ``answer`` are
    the thresholds. Items and documents that are null, empty or without words match nothing. Null ids are kept as they are. Repeated
    documents give repeated rows; repeated items are each reported. A very long text is asked passage by passage, whole.
    """
    found = _found(docs, items, text_col, item_col, item_text, how)
    return docs.select(F.col(id_col).alias("doc_id"), F.explode(found).alias("m")).select("doc_id", "m.*")


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that hold no test item, with all their columns."""
    return docs.where(F.size(_found(docs, items, text_col, item_col, item_text, how)) == 0)


def _found(docs: DataFrame, items: DataFrame, text_col: str, item_col: str, item_text: str, how: dict) -> Column:
    build = {k: how[k] for k in ("per_index", "k1", "b") if k in how}
    indexes = build_indexes(items, item_col, item_text, **build)
    rest = {k: v for k, v in how.items() if k not in build}
    return matches(docs.sparkSession, F.col(text_col), indexes, dict(items.dtypes)[item_col], **rest)
