"""Callers' columns keep their names and values, whatever the operators call their working columns; which copy stays."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lodestone.llm import line_dedup, mixing, ngram_join
from lodestone.llm.common import apart, free_name, given_back

WORKING = ["__k1", "__K2", "__g1", "__g2", "__gone", "__left", "__lines", "__removed", "__at", "__m", "__p", "__t", "__b0", "__b1",
           "__tokens", "__topic", "__probability", "__sampled", "kept__k1", "k1", "sid", "n", "label", "a.b"]
LINES = "first of all lines\nsecond of all lines\nthird of all lines"
ROWS = [
    (1, LINES, "en", "s"), (2, "own start\n" + LINES + "\nown end", "en", "t"), (3, None, None, None), (4, "", "de", "s"),
    (5, "a text of its own with quite a few words in it", "en", None), (5, "a text of its own with quite a few words in it", "en", None),
    (None, "another text that stands without an id here", "fr", "t"), (6, "another text that stands without an id here", "fr", "t"),
]


@pytest.fixture(scope="module")
def plain(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string").repartition(3)


@pytest.fixture(scope="module")
def crowded(plain):
    """Each added column holds its own name and a hash of the row, so that a mix-up shows."""
    row = F.xxhash64("doc_id", "text").cast("string")
    return plain.select("*", *[F.concat(F.lit(c), F.lit("/"), row).alias(c) for c in WORKING])


def quoted(c):
    return F.col(f"`{c}`")


def rows_of(df, columns):
    return sorted(df.select(*[quoted(c) for c in columns]).collect(), key=repr)


def agree(got, want, docs, own):
    """``got`` has all columns of ``docs`` with their values, and otherwise what the table without them gives."""
    assert got.columns[: len(docs.columns)] == docs.columns
    assert rows_of(got, ["doc_id", *WORKING]) == rows_of(docs.join(want.select("doc_id").distinct(), docs["doc_id"].eqNullSafe(want["doc_id"]), "left_semi"), ["doc_id", *WORKING])
    mine = [tuple(r) for r in rows_of(got.select("doc_id", "text", *[quoted(c) for c in got.columns[len(docs.columns):]]), ["doc_id", "text", *got.columns[len(docs.columns):]])]
    assert mine == [tuple(r) for r in rows_of(want, ["doc_id", "text", *own])]


@pytest.mark.parametrize("operator", [line_dedup.without_repeated_runs, line_dedup.without_repeated_chunks])
def test_line_dedup_keeps_columns(plain, crowded, operator):
    got, want = operator(crowded), operator(plain)
    assert got.columns == [*crowded.columns, "__lines_", "__removed_"] and want.columns == [*plain.columns, "__lines", "__removed"]
    assert rows_of(got, ["doc_id", "__lines_", "__removed_", "text"]) == rows_of(want, ["doc_id", "__lines", "__removed", "text"])
    # the added columns hold the row they came with, by its text before the cut
    assert rows_of(got, WORKING) == rows_of(crowded, WORKING)


def test_calibrated_keeps_columns(plain, crowded):
    own = ["__tokens", "__topic", "__probability", "__sampled"]
    got, want = mixing.calibrated(crowded), mixing.calibrated(plain)
    agree(got, want, crowded, own)
    assert got.columns == [*crowded.columns, *[f"{c}_" for c in own]]
    assert rows_of(mixing.sample(crowded), crowded.columns) == rows_of(got.where("__sampled_"), crowded.columns)
    assert rows_of(mixing.mixed(crowded), ["doc_id", "tokens", "sampled"]) == rows_of(mixing.mixed(plain), ["doc_id", "tokens", "sampled"])


def test_columns_of_any_name_as_keys(plain):
    moved = plain.withColumnsRenamed({"doc_id": "__k1", "text": "__gone", "lang": "__b1", "source": "__p"})
    got = line_dedup.without_repeated_runs(moved, "__k1", "__gone")
    want = line_dedup.without_repeated_runs(plain)
    assert [tuple(r) for r in rows_of(got, got.columns)] == [tuple(r) for r in rows_of(want, want.columns)]
    got = mixing.calibrated(moved, "__k1", "__gone", by=["__p", "__b1"])
    want = mixing.calibrated(plain)
    assert [tuple(r) for r in rows_of(got, got.columns)] == [tuple(r) for r in rows_of(want, want.columns)]
    got, want = ngram_join.drop_near_copies(moved, id_col="__k1", text_col="__gone"), ngram_join.drop_near_copies(plain)
    assert [tuple(r) for r in rows_of(got, got.columns)] == [tuple(r) for r in rows_of(want, want.columns)]


def _shingles(text, n):
    words = (text or "").lower().split()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def _staying(rows, n, percent):
    """By plain loops: the smallest id of each component (nulls last), one of equal rows, and every row without words."""
    sets = [_shingles(r[1], n) for r in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]) and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    out = [rows[i] for i in range(len(rows)) if not sets[i]]
    for g in {group[i] for i in range(len(rows)) if sets[i]}:
        members = [rows[i] for i in range(len(rows)) if group[i] == g and sets[i]]
        out.append(min(members, key=lambda r: (r[0] is None, r[0] or 0)))
    return out


def test_the_first_copy_stays(spark, plain):
    long = [f"w{i}" for i in range(60)]
    more = [(100 - k, " ".join([*long[:k], *long[k + 1 :]]), "en", "s") for k in (0, 1, 58, 59)]
    more += [(k, f"only {k} stands here with some words", "en", "s") for k in range(200, 230)]
    docs = plain.unionByName(spark.createDataFrame(more, plain.schema)).repartition(4)
    rows = [tuple(r) for r in docs.collect()]
    got = sorted((tuple(r) for r in ngram_join.drop_near_copies(docs).collect()), key=repr)
    assert got == sorted(_staying(rows, 5, 80), key=repr)


def test_dropped_copies_keep_columns(crowded, plain):
    got, want = ngram_join.drop_near_copies(crowded), ngram_join.drop_near_copies(plain)
    assert got.columns == crowded.columns
    assert rows_of(got, plain.columns) == rows_of(want, plain.columns)
    assert {tuple(r) for r in got.select(*[quoted(c) for c in crowded.columns]).collect()} <= {tuple(r) for r in crowded.collect()}


def test_free_names():
    assert free_name("__x", ["__X", "__x_"]) == "__x__" and free_name("__x", []) == "__x"


def test_a_table_without_such_names_is_left_alone(plain):
    same, names = apart(plain)
    assert same is plain and list(names) == list(names.values()) == plain.columns
    assert given_back(plain, names).columns == plain.columns
