"""Each operator against a brute-force version, and on nulls, empty texts, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.llm import ann, decontamination, line_dedup, lm_scoring, mixing, ngram_join, quality, queries, sharding, token_counts, toxicity
from lodestone.llm.common import hashes, ngrams, pack, unpack, words
from lodestone.llm.components import components

SF = "/root/testdata/sf0.001"
ODD = [
    (None, "a b c d e f g", "en", "s", 1), (9_001, None, None, None, None), (9_002, "", "en", None, 0), (9_003, " \n\t ", None, "s", 4),
    (9_004, "word " * 30_000, "en", "s", 1), (9_005, "one two", "en", "s", 7), (9_005, "one two", "en", "s", 7), (9_006, "x" * 100_000, "en", "s", 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    base = spark.read.parquet(f"{SF}/documents.parquet")
    return base.unionByName(spark.createDataFrame(ODD, base.schema)).withColumns({"__k1": F.lit(1), "shard": F.lit("x"), "text_": F.lit(2)}).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))


def test_packed_arrays_come_back():
    for a in (np.zeros(0, np.uint64), np.arange(1000, dtype=np.uint64) << np.uint64(50), np.array([1.5, -2], np.float32)):
        assert (unpack(pack(a), a.dtype) == a).all()


def test_components_of_chains_stars_and_pairs(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 140)] + [(201, 200), (200, 201), (300, 300)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {k: 100 for k in range(101, 140)} | {201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- 1 ----------------------------------------------------------------------------------------------


def brute_lines(rows):
    seen, out = {}, []
    for r in sorted({(r.doc_id is None, r.doc_id or 0, r.text or "") for r in rows}):
        text = r[2]
        gone = set()
        for pos, n, body in line_dedup.chunks(text.encode()):
            if seen.setdefault(body, (r, pos)) != (r, pos):
                gone |= set(range(pos, pos + n))
        out.append("\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone))
    return out


def test_line_chunks(docs, none, spark):
    got = line_dedup.without_repeated_chunks(docs)
    rows = got.collect()
    assert len(rows) == docs.count() and set(got.columns) == {*docs.columns, "__lines", "__removed"}
    assert Counter(r.text or "" for r in got.dropDuplicates(["doc_id", "__lines", "text"]).collect())[""] >= 1
    assert sum(r["__removed"] for r in rows) > 0
    want = Counter(brute_lines(docs.collect()))
    assert set(want) == {r.text or "" for r in rows}
    assert line_dedup.without_repeated_chunks(none).count() == 0


def test_chunks_resist_shifts():
    lines = [f"line {i}".encode() for i in range(200)]
    a, b = set(x[2] for x in line_dedup.chunks(b"\n".join(lines))), set(x[2] for x in line_dedup.chunks(b"\n".join([b"new", *lines])))
    assert len(a - b) <= 1


def test_repeated_runs_go_whole(docs, none, spark):
    rows = sorted({(r.doc_id is None, r.doc_id or 0, r.text or "") for r in docs.collect()})
    first, runs = {}, [f"run line {i} of a passage" for i in range(9)]
    base = 20_000
    planted = [(base, "\n".join(["head", *runs, "tail"]))]
    planted += [(base + 1 + k, "\n".join([f"before {k}", *runs[a : a + n], f"behind {k}"])) for k, (a, n) in enumerate((a, n) for n in (1, 2, 3, 5, 9) for a in range(10 - n))]
    planted += [(base + 99, "same\nsame\nsame\nother"), (base + 98, "")]
    rows += [(False, i, t) for i, t in planted]
    want = {}
    for no_id, i, t in sorted(rows, key=lambda r: r[:2]):
        lines, gone = t.split("\n"), set()
        for k, pair in enumerate(zip(lines, lines[1:])):
            if first.setdefault(pair, (no_id, i, k)) != (no_id, i, k):
                gone |= {k, k + 1}
        want[no_id, i] = ("\n".join(x for k, x in enumerate(lines) if k not in gone), len(gone))
    table = docs.select("doc_id", "text").unionByName(spark.createDataFrame(planted, "doc_id long, text string").select(F.col("doc_id").cast(dict(docs.dtypes)["doc_id"]), "text"))
    got = line_dedup.without_repeated_runs(table).collect()
    assert len(got) == docs.count() + len(planted)
    assert {(r.doc_id is None, r.doc_id or 0): (r.text or "", r["__removed"]) for r in got} == want
    assert {r.text for r in got if r.doc_id and base < r.doc_id < base + 98 and r["__lines"] > 3} == {f"before {k}\nbehind {k}" for k in range(9, 9 + 8 + 7 + 5 + 1)}
    assert line_dedup.without_repeated_runs(none).count() == 0


# -- 2 ----------------------------------------------------------------------------------------------


@pytest.mark.parametrize("how", [{}, {"hot_pairs": 50, "hot_words": 40, "block_words": 2_000, "bytes_per_part": 50_000}])
def test_lm_scores(docs, none, how):
    rows = docs.collect()
    texts = [(r.text or "").encode().lower().split() for r in rows]
    one, two = Counter(w for x in texts for w in x), Counter(p for x in texts for p in zip(x, x[1:]))
    n = sum(one.values())

    def score(x):
        s = math.log(one[x[0]] / n) if x else 0.0
        return s + sum(math.log(two[p] / one[p[0]]) if two[p] > 1 else math.log(0.4 * one[p[1]] / n) for p in zip(x, x[1:]))

    want = by_id((r.doc_id, len(x), score(x)) for r, x in zip(rows, texts))
    got = by_id((r.doc_id, r.n_words, r.log_score) for r in lm_scoring.lm_scores(docs, **how).collect())
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert np.allclose([g[2] for g in got], [w[2] for w in want], rtol=1e-6)
    assert lm_scoring.lm_scores(none, **how).count() == 0


def brute_scores(texts, order):
    count = Counter(tuple(x[i : i + n]) for x in texts for n in range(1, order + 1) for i in range(len(x) - n + 1))
    total = sum(map(len, texts))

    def score(x):
        grams = [tuple(x[max(0, i - order + 1) : i + 1]) for i in range(len(x))]
        return sum(math.log(count[g] / (count[g[:-1]] if len(g) > 1 else total)) for g in grams)

    return [score(x) for x in texts]


@pytest.mark.parametrize("order", [2, 3, 4])
@pytest.mark.parametrize("how", [{}, {"hot_grams": 0, "bytes_per_part": 50_000}, {"hot_grams": 40, "block_words": 2_000, "bytes_per_part": 50_000}])
def test_ngram_scores(docs, none, how, order):
    rows = docs.collect()
    texts = [(r.text or "").encode().lower().split() for r in rows]
    want = by_id((r.doc_id, len(x), y) for r, x, y in zip(rows, texts, brute_scores(texts, order)))
    got = by_id((r.doc_id, r.n_words, r.log_score) for r in lm_scoring.ngram_scores(docs, order=order, **how).collect())
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert np.allclose([g[2] for g in got], [w[2] for w in want], rtol=1e-9, atol=1e-7)
    assert lm_scoring.ngram_scores(none, order=order, **how).count() == 0


def test_registered_scores_keep_every_count(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = dict(zip((r.doc_id for r in rows), brute_scores([(r.text or "").encode().lower().split() for r in rows], 3)))
    got = {r.doc_id: r.log_score for r in queries.op2_lm_scores(spark, SF).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) <= 1e-7 * max(1, abs(want[k])) for k in want)


# -- 3 ----------------------------------------------------------------------------------------------


def brute_join(rows, n, percent):
    sets = [frozenset(ngram_join.token_set(t.encode() if t else None, n).tolist()) for _, t in rows]
    top = list(range(len(rows)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and len(a) * 100 >= len(b) * percent and len(b) * 100 >= len(a) * percent:
                both = len(a & b)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    top[find(i)] = find(j)
    groups = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        groups[find(i)].append(d)
    least = {k: min((d for d in v if d is not None), default=None) for k, v in groups.items()}
    return [(d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows)]


def test_parity_bits_never_exceed_the_difference():
    rng = np.random.default_rng(3)
    for size in (0, 1, 40, 3_000):
        a = np.unique(rng.integers(-(2**63), 2**63 - 1, size))
        b = np.union1d(a[len(a) // 9 :], rng.integers(-(2**63), 2**63 - 1, size // 9))
        x, y = ngram_join.parity_bits(a), ngram_join.parity_bits(b)
        assert len(x) == ngram_join.PARITY_WORDS
        differ = sum(int(v).bit_count() for v in (x ^ y).view(np.uint64))
        assert differ <= len(np.setxor1d(a, b)) and (size > 40 or differ > 0 or size < 9)


@pytest.mark.parametrize(("n", "percent", "common"), [(3, 90, 20), (5, 80, 2)])
def test_jaccard_components(spark, docs, none, n, percent, common):
    rng = random.Random(n)
    passage = [f"p{i}" for i in range(60)]
    made = []
    for g in range(6):
        base = [f"g{g}w{rng.randrange(500)}" for _ in range(rng.randrange(20, 200))]
        for _ in range(12):
            w = list(base)
            for _ in range(rng.randrange(0, 4)):
                w[rng.randrange(len(w))] = f"new{rng.random()}"
            made.append(" ".join(w))
    made += [" ".join([*passage, *(f"own{rng.random()}" for _ in range(rng.randrange(3, 40)))]) for _ in range(40)]
    more = spark.createDataFrame([(20_000 + i, t) for i, t in enumerate(made)], "doc_id long, text string")
    both = docs.select("doc_id", "text").union(more).repartition(4)
    rows = [(r.doc_id, r.text) for r in both.collect()]
    got = ngram_join.near_copies(both, n, percent, common=common)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(brute_join(rows, n, percent), key=key)
    kept = ngram_join.drop_near_copies(both, n, percent, common=common)
    groups = {(c if c is not None else d) for d, k, c in brute_join(rows, n, percent) if k}
    blank = sum(1 for _, k, _ in brute_join(rows, n, percent) if not k)
    assert kept.count() >= len(groups) + blank and kept.columns == both.columns
    assert ngram_join.near_copies(none, n, percent).count() == 0


def test_a_pair_is_not_made_at_each_shared_token(spark, monkeypatch):
    rng = random.Random(17)
    base = [f"w{i}" for i in range(240)]
    rows = []
    for i in range(70):  # every two share many tokens of their prefixes, few of them link
        w = list(base)
        for at in rng.sample(range(240), rng.choice([2, 9, 10, 11])):
            w[at] = f"v{i}x{at}"
        rows.append((i, " ".join(w)))
    kept, keep = {}, ngram_join.store

    def store(df, name):
        kept[name] = keep(df, name)
        return kept[name]

    monkeypatch.setattr(ngram_join, "store", store)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = ngram_join.near_copies(docs, 3, 80)
    assert sorted(tuple(r) for r in got.collect()) == sorted(brute_join(rows, 3, 80))
    entry = kept["mixed-lists"]
    made = ngram_join._across(entry, 80)
    pairs = made.distinct()
    assert pairs.count() > 300 and made.count() < 2 * pairs.count()
    at_each = ngram_join._across(entry.withColumn("earlier", F.array().cast("array<bigint>")), 80)
    assert at_each.count() > 5 * pairs.count() and at_each.distinct().exceptAll(pairs).count() == 0


# -- 4 ----------------------------------------------------------------------------------------------


def test_neighbours(spark):
    base = [(r.vec_id, [float(x) for x in r.embedding]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    base += [(50_000 + i, base[0][1]) for i in range(30)] + [base[0]]
    odd = [(60_000, None), (60_020, [0.0] * 64), (60_040, [float("nan")] * 64), (60_060, [1.0, None] * 32), (None, [1.0] * 64), (60_080, [1.0, 2.0])]
    df = spark.createDataFrame(base + odd, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in ann.nearest(df, shard_rows=200).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    real = dict(base)
    ids = np.array(sorted(real))
    x = np.array([real[i] for i in ids])
    hit = total = 0
    for q in (int(i) for i in ids if i % 20 == 0):
        s = x @ np.array(real[q])
        order = [int(i) for i in ids[np.lexsort((ids, -np.round(s, 12)))] if i != q][:20]
        mine = sorted(got[q])
        assert [r for r, _, _ in mine] == list(range(1, 21))
        assert all(abs(sc - np.dot(real[q], real[i])) < 1e-12 for _, i, sc in mine)
        hit, total = hit + len({i for _, i, _ in mine} & set(order)), total + 20
    assert hit / total >= 0.9
    assert [i for _, i, _ in sorted(got[base[0][0]])][:20] == list(range(50_000, 50_020)) or base[0][0] % 20
    assert 60_080 in {q for q in [*got, 60_080]} and 60_020 not in got and 60_040 not in got
    assert ann.nearest(df.where("false")).count() == 0


# -- 5 ----------------------------------------------------------------------------------------------


def test_raked_weights_meet_the_targets(spark):
    rng = random.Random(1)
    cells = [(s, g, rng.randrange(100, 1000)) for s in "abc" for g in ("x", "y", None)]
    df = spark.createDataFrame(cells, "b0 string, b1 string, tokens long")
    share = {"b0": [("a", 0.3), ("b", 0.3), ("c", 0.4)], "b1": [("x", 0.3), ("y", 0.4), (None, 0.3)]}
    targets = {c: spark.createDataFrame(v, f"{c} string, share double") for c, v in share.items()}
    got = mixing.rake(df, targets, 0.3, sweeps=20).toPandas()
    budget = 0.3 * sum(c[2] for c in cells)
    assert (got["w"] <= got["tokens"] + 1e-9).all()
    w = np.array([c[2] * 0.3 for c in cells])
    for _ in range(200):
        for c, at in (("b0", 0), ("b1", 1)):
            for v, s in share[c]:
                m = np.array([x[at] == v for x in cells])
                w[m] *= s * budget / w[m].sum()
    mine = {(r.b0, r.b1 if isinstance(r.b1, str) else None): r.w for r in got.itertuples()}
    assert np.allclose([mine[c[0], c[1]] for c in cells], w, rtol=0.02)


def test_sample_is_calibrated(docs, none):
    rows = mixing.calibrated(docs).collect()
    assert len(rows) == docs.count() and all(0 <= r["__probability"] <= 1 for r in rows)
    assert all(r["__probability"] == 1 and r["__sampled"] for r in rows if not r["__tokens"])
    assert mixing.sample(docs).columns == docs.columns and mixing.sample(none).count() == 0


# -- 6 ----------------------------------------------------------------------------------------------


def test_wand_gives_all_above_the_threshold(spark):
    items = spark.createDataFrame([(i, r.text) for i, r in enumerate(spark.read.parquet(f"{SF}/benchmark.parquet").collect())], "item_id long, text string")
    index = decontamination.build_indexes(items)[0]
    rng = random.Random(2)
    for _ in range(200):
        terms = rng.sample(range(len(index.postings)), 30)
        for least in (0.05, 0.2, 0.4):
            score = defaultdict(float)
            for t in terms:
                for i, x in zip(*index.postings[t]):
                    score[i] += x
            want = {i: s for i, s in score.items() if s >= least}
            got = dict(decontamination.block_max_wand(index, terms, least))
            assert got.keys() == want.keys() and np.allclose([got[i] for i in want], list(want.values()))


def test_planted_items_are_found(spark, docs, none):
    items = spark.read.parquet(f"{SF}/benchmark.parquet").limit(10).union(spark.createDataFrame([(500, None), (501, "")], "item_id long, text string"))
    texts = [(r.item_id, r.text) for r in items.collect() if r.text]
    planted = [(30_000 + i, "w " * 97 * i + t.encode().upper().decode() + " tail" * i) for i, t in texts]
    both = docs.select("doc_id", "text").union(spark.createDataFrame(planted, "doc_id long, text string"))
    for per in (20_000, 4):
        got = {(r.doc_id, r.item_id) for r in decontamination.contaminated(both, items, per_index=per).collect()}
        assert {(30_000 + i, i) for i, _ in texts} <= got
    grams = {i: set(zip(*(words(t.encode())[k:] for k in range(8)))) for i, t in texts}
    clean = {r.doc_id for r in docs.collect() if not any(g & set(zip(*(words((r.text or "").encode())[k:] for k in range(8)))) for g in grams.values())}
    assert not clean & {d for d, _ in got}
    assert decontamination.drop_contaminated(docs, items).columns == docs.columns
    assert decontamination.contaminated(none, items).count() == 0 == decontamination.contaminated(docs, items.where("false")).count()


# -- 7 and 9 ----------------------------------------------------------------------------------------


def test_toxicity_on_held_out_rows(spark):
    d, y = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.toxicity(d, y).join(y, "doc_id").where("held_out").select("predicted", "toxic").collect()
    told = [r for r in rows if r.predicted]
    assert len(told) > 50 and sum(r.toxic for r in told) / len(told) > 0.9


def test_classifiers_on_odd_rows(spark, docs, none):
    y = spark.read.parquet(f"{SF}/labels.parquet").union(spark.createDataFrame([(None, 1, 1), (9_001, None, None), (9_002, 1, 0)], "doc_id long, quality int, toxic int"))
    for op in (toxicity.toxicity, quality.quality):
        rows = op(docs, y).collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
        assert op(none, y).count() == 0
        assert {round(r.score, 6) for r in op(docs.limit(5), y.where("false")).collect()} == {0.5}
    assert toxicity.reject_toxic(docs, y).columns == docs.columns


# -- 8 ----------------------------------------------------------------------------------------------


def test_token_counts(spark, docs, none):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = str(public.path("byte_bpe_50k.json"))
    library = Tokenizer.from_file(path)
    rng = random.Random(8)
    signs = [*" \n\t'strevmdl01!.é中 ²😀Z", "'re", "'ll", "  ", "<|endoftext|>", " the "]
    made = [(i, "".join(rng.choice(signs) for _ in range(rng.randrange(60)))) for i in range(400)]
    both = docs.select("doc_id", "text").union(spark.createDataFrame(made, "doc_id long, text string"))
    want = by_id((r.doc_id, len((r.text or "").encode()), len(library.encode(r.text or "", add_special_tokens=False).ids)) for r in both.collect())
    got = by_id((r.doc_id, r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(both, path).collect())
    assert sorted(got, key=str) == sorted(want, key=str)
    assert token_counts.count_tokens(none, path).count() == 0


def test_lanes_do_not_matter():
    classes = np.random.default_rng(0).integers(0, token_counts.END + 1, 5_000).astype(np.uint8)
    one = token_counts.boundaries(classes, 5_000)
    assert all((token_counts.boundaries(classes, k) == one).all() for k in (1, 7, 64, 1024))


# -- 10 ---------------------------------------------------------------------------------------------


def test_shards(docs, none):
    out = sharding.uniform_shards(docs, keep=["text", "shard"], rows_per_part=20)
    rows = out.collect()
    assert "in_shard" in out.columns and len(rows) == docs.count()
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.size == len((r.text or "").encode()) + 8
    assert set(slots) == set(range(24)) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert "Python" not in out._jdf.queryExecution().toString()
    assert sharding.uniform_shards(none).count() == 0


def test_hypergeometric_draws(spark):
    total, marked, drawn = 60, 25, 18
    u = (F.col("id") + 0.5) / 4000
    got = spark.range(4000).select(sharding.hypergeometric(u, *(F.lit(float(x)) for x in (total, marked, drawn))).alias("k")).groupBy("k").count().collect()
    for r in got:
        k = int(r["k"])
        p = math.comb(marked, k) * math.comb(total - marked, drawn - k) / math.comb(total, drawn)
        assert abs(r["count"] / 4000 - p) < 0.002
    ends = spark.range(1).select(*[sharding.hypergeometric(F.lit(0.7), *(F.lit(float(x)) for x in c)) for c in ((5, 5, 3), (5, 0, 3), (0, 0, 0), (9, 4, 9))]).first()
    assert list(ends) == [3, 0, 0, 4]


def test_ngrams_follow_order():
    h = hashes([b"a", b"b", b"c", b"a", b"b"])
    g = ngrams(h, 2)
    assert len(g) == 4 and g[0] == g[3] and len(set(g.tolist())) == 3
