"""Jaccard self-join of word n-gram sets by a grouped prefix join, and the groups of near copies it gives.

A text is its set of n-gram hashes (64 bits), ordered by hash. Two sets with Jaccard similarity t or more share a token among the first
``p = n - ceil(t n) + 1`` tokens of each. Equal sets are one set; sets with equal size and equal prefix window are one group, which is posted
once. Tokens that many groups have in their windows ("common") are moved behind all others, so that passages shared by many texts make
no pairs. Sets whose windows are mostly common are joined with each other by whole sets, ordered by how many of them have a token.

The pairs of a posting list are found in two steps, so that a list of k near copies makes about k pairs and not k squared: first
every group meets its list's anchor and every set its group's leader; verified pairs give components. Then pairs are made
only between different components of one list. No link between different components is lost, so the components are exact.

In the second step a pair is made only if the parity bits of both allow a link: bit i of a set says whether an odd number of its
tokens has hash i, so two sets differ in at least as many tokens as bits. A group keeps which bits are set in all of its sets and
which in any. The test is part of the join's condition; it is exact, and most variants of one text that do not link fail it.

A pair that shares many tokens is made at few of them. Each posting names the tokens that its group posts just before it; where both
sides name one and the same, the pair is left to that earlier list. At the first token that two groups share none is named by both.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.llm.common import U, apart, given_back, hashes, mix, ngrams, row_key, store, words
from lodestone.llm.components import components
from lodestone.session import small_side

COMMON = 20  # a token that more groups have in their window than this is common
PARITY_WORDS = 4  # parity bits of a set, in words of 64
BITS = [f"bits{i}" for i in range(PARITY_WORDS)]
EARLIER = 4  # tokens before it that a posting names, so that a pair is made once and not at each shared token
COMMON_TOKENS = 1 << 20  # of those the most frequent are sent to every task: 8 MB; the order is only a matter of speed


def token_set(text: bytes | None, n: int) -> np.ndarray:
    """Distinct n-gram hashes of a whole text in ascending (signed) order; with fewer words, the whole sequence as one."""
    w = words(text or b"")
    if not w:
        return np.zeros(0, np.int64)
    h = hashes(w)
    return np.unique(ngrams(h, min(n, len(h))).view(np.int64))


def parity_bits(tokens: np.ndarray) -> np.ndarray:
    """Bit i is the parity of the number of tokens with hash i; 64 bits in each of the words."""
    counts = np.bincount(tokens & (64 * PARITY_WORDS - 1), minlength=64 * PARITY_WORDS)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").view(np.int64)


def prefix_sizes(size: int, percent: int) -> tuple[int, int, int]:
    """Prefix length, window length, and how many common tokens a set may pass over."""
    p = size - -(-percent * size // 100) + 1
    return p, min(size, p + p // 2 + 2), percent * (p // 2) // 100


def sketches(docs: DataFrame, n: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """Per row: id, row key, set size, set id, parity bits and the window of its first tokens."""
    k1, k2 = row_key(F.col(id_col), F.col(text_col))
    rows = docs.select(F.col(id_col).alias("id"), k1.alias("k1"), k2.alias("k2"), F.col(text_col).cast("binary").alias("text"))
    id_type = dict(rows.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, sid, bits, window = [], [], [], []
            for at in range(0, b.num_rows, 512):
                for t in b.column("text").slice(at, 512).to_pylist():
                    s = token_set(t, n)
                    size.append(len(s))
                    with np.errstate(over="ignore"):
                        sid.append(int(mix(s.view(U)).sum().astype(np.int64)))
                    bits.append(parity_bits(s))
                    window.append(s[: prefix_sizes(len(s), percent)[1]] if len(s) else s)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("k1"), b.column("k2"), pa.array(size, pa.int64()), pa.array(sid, pa.int64()), pa.array(window, pa.list_(pa.int64()))]
                + [pa.array([x[i] for x in bits], pa.int64()) for i in range(PARITY_WORDS)],
                ["id", "k1", "k2", "n", "sid", "win", *BITS],
            )

    kinds = "".join(f", {c} bigint" for c in BITS)
    return rows.mapInArrow(run, f"id {id_type}, k1 bigint, k2 bigint, n bigint, sid bigint, win array<bigint>{kinds}")


def _common_tokens(tokens: DataFrame, common: int, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens that occur more than ``common`` times, in ascending order, and how often; of more than ``bound``, the most frequent."""
    counts = tokens.groupBy("token").count().where(F.col("count") > common)
    counts = store(counts, "common-tokens")
    seen, least = 0, common
    for row in counts.groupBy("count").agg(F.count(F.lit(1)).alias("k")).orderBy(F.desc("count")).toLocalIterator():
        seen += row["k"]
        if seen > bound:
            least = row["count"]
            break
    found = counts.where(F.col("count") > least).select("token", "count").toArrow()
    at = np.argsort(found["token"].to_numpy())
    return found["token"].to_numpy()[at], found["count"].to_numpy()[at]


def _occurrences(values: np.ndarray, tokens: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """How often each value occurs, by the table of common tokens; 0 for others."""
    if not len(tokens):
        return np.zeros(len(values), np.int64)
    at = np.minimum(np.searchsorted(tokens, values), len(tokens) - 1)
    return np.where(tokens[at] == values, counts[at], 0)


def _postings(groups: DataFrame, percent: int, common: tuple[np.ndarray, np.ndarray]) -> tuple[DataFrame, DataFrame]:
    """Rows ``token, gid, n``, and the ``gid`` of mostly common groups. A set with enough other tokens in its window posts p of
    them; one that is mostly common posts all others. Two sets that link share a posted token unless both are mostly common."""
    shared = groups.sparkSession.sparkContext.broadcast(common)

    def windows(b: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, bool]]:
        flat = b.column("win").flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(b.column("win").value_lengths().to_numpy())
        is_free, start = _occurrences(flat, *shared.value) == 0, 0
        for gid, n, end in zip(b.column("gid").to_pylist(), b.column("n").to_pylist(), ends):
            p, _, slack = prefix_sizes(n, percent)
            free = np.flatnonzero(is_free[start:end])
            enough = len(free) >= p and free[p - 1] + 1 - p <= slack
            yield gid, n, flat[start:end][free[:p] if enough else free], enough
            start = end

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            gid, n, tokens, _ = zip(*windows(b)) if b.num_rows else ([], [], [], [])
            sizes = [len(t) for t in tokens]
            yield pa.RecordBatch.from_pydict({
                "token": np.concatenate([*tokens, np.zeros(0, np.int64)]),
                "gid": np.repeat(np.array(gid, np.int64), sizes), "n": np.repeat(np.array(n, np.int64), sizes),
            })

    def mostly_common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_pydict({"gid": pa.array([g for g, _, _, enough in windows(b) if not enough], pa.int64())})

    rows = groups.select("gid", "n", "win")
    return rows.mapInArrow(post, "token bigint, gid bigint, n bigint"), rows.mapInArrow(mostly_common, "gid bigint")


def _fetched(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, name: str) -> DataFrame:
    """The rows of ``wanted`` with the compressed text of their key ``k1``, stored. Rows that are equal throughout may stand
    there twice."""
    kinds = {c: t for c, t in wanted.dtypes if c != "k1"}
    k1, _ = row_key(F.col(id_col), F.col(text_col))
    texts = docs.select(k1.alias("k1"), F.col(text_col).cast("binary").alias("text")).join(small_side(wanted), "k1")

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        z = zstandard.ZstdCompressor(level=3)
        for b in batches:
            blobs = pa.array([z.compress(t or b"") for t in b.column("text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kinds), blobs], [*kinds, "blob"])

    return store(texts.select(*kinds, "text").mapInArrow(squeeze, ", ".join([*(f"{c} {t}" for c, t in kinds.items()), "blob binary"])), name)


def _whole_postings(rows: DataFrame, n: int, percent: int, common: int, bound: int) -> DataFrame:
    """Rows ``token, gid, n`` by which mostly common sets meet each other: the prefixes of the whole sets, rarest tokens
    first. The tokens are hashed anew, so that they do not meet those of windows."""

    def sets(b: pa.RecordBatch) -> Iterator[np.ndarray]:
        import zstandard

        z = zstandard.ZstdDecompressor()
        for at in range(0, b.num_rows, 64):
            for blob in b.column("blob").slice(at, 64).to_pylist():
                yield token_set(z.decompress(blob), n)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in sets(b):
                yield pa.RecordBatch.from_pydict({"token": s})

    shared = rows.sparkSession.sparkContext.broadcast(_common_tokens(rows.mapInArrow(count, "token bigint"), common, bound))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for gid, s in zip(b.column("gid").to_pylist(), sets(b)):
                p = prefix_sizes(len(s), percent)[0]
                first = s[np.argsort(_occurrences(s, *shared.value), kind="stable")[:p]]
                again = mix(first.view(U) + U(1)).view(np.int64)
                yield pa.RecordBatch.from_pydict({"token": again, "gid": np.full(len(again), gid), "n": np.full(len(again), len(s))})

    return rows.mapInArrow(post, "token bigint, gid bigint, n bigint").distinct()


def _near_sizes(a: Column, b: Column, percent: int) -> Column:
    return (a * 100 >= b * percent) & (b * 100 >= a * percent)


def _bits(kind: str, side: str) -> list[Column]:
    return [F.col(f"{kind}{c}_{side}") for c in BITS]


def _parity_allows(sizes: Column, all_a: list[Column], any_a: list[Column], all_b: list[Column], any_b: list[Column], percent: int) -> Column:
    """Whether so few bits are surely different that a pair with this sum of sizes can be linked."""
    most = sizes - 2 * F.ceil(sizes * percent / (100 + percent) - 1e-9)
    differ = [
        F.bit_count(p.bitwiseAND(F.bitwise_not(q)).bitwiseOR(r.bitwiseAND(F.bitwise_not(o))))
        for p, o, r, q in zip(all_a, any_a, all_b, any_b)
    ]
    return reduce(Column.__add__, differ) <= most


def _possible(pairs: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Pairs of groups whose windows do not rule a link out: differences in the hash range that both windows cover are
    differences of the sets, and a linked pair has at most ``na + nb - 2 overlap`` of them."""
    side = lambda s: groups.select(F.col("gid").alias(f"g{s}"), F.col("n").alias(f"n{s}"), F.col("win").alias(f"w{s}"))
    both = pairs.join(side("a"), "ga").join(side("b"), "gb")
    total = F.col("na") + F.col("nb")
    overlap = F.ceil(total * percent / (100 + percent) - 1e-9)
    inside = lambda w, top: F.size(F.filter(w, lambda x: x <= top))
    # the bound is an array's element, so that it is computed once a pair and not once an element
    top = F.array(F.least(F.array_max("wa"), F.array_max("wb")))
    covered = F.transform(top, lambda t: inside("wa", t) + inside("wb", t))[0]
    apart = covered - 2 * F.size(F.array_intersect("wa", "wb"))
    return both.where(_near_sizes(F.col("na"), F.col("nb"), percent) & (apart <= total - 2 * overlap)).select("ga", "gb")


def _verified(pairs: DataFrame, docs: DataFrame, sets: DataFrame, n: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """The pairs ``a, b`` of set ids whose whole sets reach the similarity; texts are fetched for sets in pairs only."""
    pairs = store(pairs.distinct(), "pairs")
    wanted = pairs.select(F.col("a").alias("sid")).union(pairs.select(F.col("b").alias("sid"))).distinct()
    wanted = store(sets.select("sid", "k1").join(wanted, "sid"), "wanted")
    blobs = _fetched(docs, wanted, id_col, text_col, "texts")  # pairs of repeated rows are judged twice
    both = pairs.join(blobs.select(F.col("sid").alias("b"), F.col("blob").alias("tb")), "b")
    both = both.join(blobs.select(F.col("sid").alias("a"), F.col("blob").alias("ta")), "a")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        z, kept = zstandard.ZstdDecompressor(), {}

        def of(sid: int, blob: bytes) -> np.ndarray:
            if sid not in kept:
                if len(kept) > 200:
                    kept.clear()
                kept[sid] = token_set(z.decompress(blob), n)
            return kept[sid]

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                b = batch.slice(at, 256)
                good = []
                for i, (x, y, tx, ty) in enumerate(zip(*(b.column(c).to_pylist() for c in ("a", "b", "ta", "tb")))):
                    sx, sy = of(x, tx), of(y, ty)
                    common = len(np.intersect1d(sx, sy, assume_unique=True))
                    if 100 * common >= percent * (len(sx) + len(sy) - common):
                        good.append(i)
                yield b.select(["a", "b"]).take(pa.array(good, pa.int32()))

    return both.select("a", "b", "ta", "tb").mapInArrow(judge, "a bigint, b bigint")


def _lists(postings: DataFrame) -> DataFrame:
    """The postings of tokens that two groups or more have, each with its list's anchor ``ag, an``. The rows are shuffled once."""
    of_token = Window.partitionBy("token")
    anchor = F.min(F.struct(F.xxhash64("gid").alias("h"), F.col("gid"), F.col("n"))).over(of_token)
    rows = postings.select("token", "gid", "n", F.count(F.lit(1)).over(of_token).alias("df"), anchor.alias("anchor"))
    return rows.where("df > 1").select("token", "gid", "n", F.col("anchor.gid").alias("ag"), F.col("anchor.n").alias("an"))


def _with_earlier(entry: DataFrame, earlier: int) -> DataFrame:
    """``entry(token, gid, label, ..)`` with the tokens of the same group and component just before, in the order of tokens."""
    before = Window.partitionBy("gid", "label").orderBy("token").rowsBetween(-earlier, -1)
    return entry.withColumn("earlier", F.collect_list("token").over(before))


def _across(entry: DataFrame, percent: int) -> DataFrame:
    """Pairs ``ga, gb`` of groups that share a token in different components and may link, by ``_with_earlier`` rows with the
    parity bits of their part. A pair has a row at the first token that it shares and at later ones only where none is named twice."""
    end = lambda s: entry.select("token", *[F.col(c).alias(f"{c}_{s}") for c in entry.columns if c != "token"])
    fits = _parity_allows(F.col("n_x") + F.col("n_y"), *[_bits(kind, s) for s in "xy" for kind in ("all_", "any_")], percent)
    pairs = end("x").join(end("y"), "token").where(
        (F.col("label_x") < F.col("label_y")) & (F.col("gid_x") != F.col("gid_y")) & _near_sizes(F.col("n_x"), F.col("n_y"), percent) & fits
        & ~F.arrays_overlap("earlier_x", "earlier_y")
    )
    return pairs.select(F.least("gid_x", "gid_y").alias("ga"), F.greatest("gid_x", "gid_y").alias("gb"))


def links(
    docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
    common: int = COMMON, common_tokens: int = COMMON_TOKENS,
) -> tuple[DataFrame, DataFrame]:
    """The sketch of every row (``id, k1, k2, n, sid``) and the component of every set (``sid, label, first``).

    ``first`` is the smallest id of the component's rows. Sets without any link are their own component. Rows without words
    have n = 0 and no set.
    """
    sketch = sketches(docs, n, percent, id_col, text_col).withColumn("gid", F.xxhash64("n", "win"))
    sketch = store(sketch, "sketch")
    filled = sketch.where("n > 0")
    # windows go to the groups only
    sets = store(filled.groupBy("sid").agg(
        F.min("id").alias("id"), F.min("k1").alias("k1"), F.first("n").alias("n"), F.first("gid").alias("gid"),
        *[F.first(c).alias(c) for c in BITS],
    ), "sets")
    groups = store(filled.groupBy("gid").agg(F.min("sid").alias("leader"), F.first("n").alias("n"), F.first("win").alias("win")), "groups")
    in_windows = _common_tokens(groups.select(F.explode("win").alias("token")), common, common_tokens)
    postings, mostly_common = _postings(groups, percent, in_windows)
    whole = store(sets.select("gid", "k1").join(mostly_common, "gid"), "mostly-common")
    whole = _fetched(docs, whole, id_col, text_col, "mostly-common-texts")
    postings = postings.unionByName(store(_whole_postings(whole, n, percent, common, common_tokens), "whole-postings"))
    lists = store(_lists(postings), "lists")

    # every group with its list's anchor, every set with its group's leader
    stars = lists.where((F.col("gid") != F.col("ag")) & _near_sizes(F.col("n"), F.col("an"), percent))
    stars = stars.select(F.least("gid", "ag").alias("ga"), F.greatest("gid", "ag").alias("gb")).distinct()
    heads = groups.select("gid", "leader")
    met = (
        _possible(stars, groups, percent)
        .join(heads.select(F.col("gid").alias("ga"), F.col("leader").alias("a")), "ga")
        .join(heads.select(F.col("gid").alias("gb"), F.col("leader").alias("b")), "gb")
        .select("a", "b")
    )
    inside = sets.select("gid", "sid").join(heads, "gid").where("sid <> leader").select(F.col("leader").alias("a"), F.col("sid").alias("b"))
    near = store(_verified(met.unionByName(inside), docs, sets, n, percent, id_col, text_col), "near")
    first = components(near)

    # what may link different components of one list or group
    member = sets.select("gid", "sid", "n", *BITS).join(first.select(F.col("node").alias("sid"), "label"), "sid", "left")
    member = store(member.withColumn("label", F.coalesce("label", "sid")), "members")
    parts = member.groupBy("gid", "label").agg(
        *[F.bit_and(c).alias(f"all_{c}") for c in BITS], *[F.bit_or(c).alias(f"any_{c}") for c in BITS]
    )
    entry = lists.select("token", "gid", "n").join(parts.select("gid", "label"), "gid")
    mixed = entry.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("token")
    entry = _with_earlier(entry.join(mixed, "token"), EARLIER).join(parts, ["gid", "label"])
    across = _across(store(entry, "mixed-lists"), percent).distinct()
    split = parts.groupBy("gid").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi")
    own = split.select(F.col("gid").alias("ga"), F.col("gid").alias("gb"))
    side = lambda s: member.select(F.col("gid").alias(f"g{s}"), F.col("sid").alias(s), F.col("label").alias(f"l{s}"), F.col("n").alias(f"n{s}"), *[F.col(c).alias(f"{c}_{s}") for c in BITS])
    may = _parity_allows(F.col("na") + F.col("nb"), *[_bits("", s) for s in "aabb"], percent)
    rest = (
        _possible(across, groups, percent).unionByName(own)
        .join(side("a"), "ga").join(side("b"), "gb")
        .where((F.col("la") != F.col("lb")) & ((F.col("ga") != F.col("gb")) | (F.col("a") < F.col("b"))) & may)
        .select("a", "b")
    )
    more = _verified(rest, docs, sets, n, percent, id_col, text_col)
    label = components(near.unionByName(more), "components-all")
    named = sets.select("sid", "id").join(label.select(F.col("node").alias("sid"), "label"), "sid", "left")
    named = named.withColumn("label", F.coalesce("label", "sid"))
    smallest = named.groupBy("label").agg(F.min("id").alias("first"))
    return sketch.drop("gid", "win", *BITS), store(named.select("sid", "label").join(smallest, "label"), "labels")


def near_copies(
    docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", **how
) -> DataFrame:
    """Per row ``doc_id, n_shingles, component_id``: the set size and the smallest id reachable by links, its own included.

    Rows with a null, empty or blank text have no shingles and are linked with nothing. A null id is never the smallest one:
    it gets the component's smallest other id, or null. Repeated rows and rows with equal texts are in one component. Very
    long texts are read whole. An empty table gives no rows. Other columns are not read.
    """
    sketch, labels = links(docs, n, percent, id_col, text_col, **how)
    out = sketch.join(labels.select("sid", "first"), "sid", "left")
    return out.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("first")).otherwise(F.col("id")).alias("component_id"),
    )


def drop_near_copies(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One row of each component, the one with the smallest id (nulls last); rows without words all stay. All columns are kept,
    whatever their names."""
    docs, names = apart(docs)
    id_col, text_col = names[id_col], names[text_col]
    sketch, labels = links(docs, n, percent, id_col, text_col, **how)
    rows = sketch.where("n > 0").join(labels.select("sid", "label"), "sid")
    order = F.struct(F.col("id").isNull().alias("no_id"), F.col("id"), F.col("k1"), F.col("k2"))
    best = rows.groupBy("label").agg(F.min(order).alias("best"))
    keys = rows.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("copies"), F.first("label").alias("label")).join(best, "label")
    keys = keys.withColumn("stays", (F.col("best.k1") == F.col("k1")) & (F.col("best.k2") == F.col("k2")))
    keys = store(keys.where("not stays or copies > 1").select("k1", "k2", "stays"), "dropped")
    k1, k2 = row_key(F.col(id_col), F.col(text_col))
    keyed = docs.withColumns({"__k1": k1, "__k2": k2})
    on = lambda k: (F.col("__k1") == k["k1"]) & (F.col("__k2") == k["k2"])
    gone, twice = small_side(keys.select("k1", "k2")), small_side(keys.where("stays").select("k1", "k2"))
    once = keyed.join(twice, on(twice), "left_semi").dropDuplicates(["__k1", "__k2"])
    return given_back(keyed.join(gone, on(gone), "left_anti").unionByName(once), names)
