"""The manifest against plain trees in memory, and its SQL twin."""

from __future__ import annotations

import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from lodestone.llm import merkle, sql

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    (None, None, None, None, None), (None, None, None, None, None), (5, "", "", None, 0), (5, "A", None, "", 3), (9, "Aé\n" * 20_000, "de", "s", 1),
    *[(k, f"Text {k}", "en", "s" if k % 3 else "t", k) for k in range(600)], *[(k, "one", None, f"alone-{k}", 1) for k in range(40)],
]


def h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r, text):
    return h(["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r.doc_id, r.source, r.lang, r.n_chars, text)])


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        run = level[i // 16 * 16 : i // 16 * 16 + 16]
        out.append((i % 16, run[: i % 16] + run[i % 16 + 1 :]))
        i //= 16
    return out


def brute(rows):
    rows = sorted(rows, key=lambda r: (r.source is not None, (r.source or "").encode(), r.doc_id is not None, r.doc_id or 0, leaf(r, r.text)))
    groups = {}
    for r in rows:
        groups.setdefault(r.source, []).append(r)
    trees = [tree([leaf(r, r.text) for r in g]) for g in groups.values()]
    top = tree([t[-1][0] for t in trees])
    out = []
    for g, (members, t) in enumerate(zip(groups.values(), trees)):
        for i, r in enumerate(members):
            known, d = siblings(t, i) + siblings(top, g), t[0][i]
            if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and r.text is not None:
                d = leaf(r, "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text))
            for p, others in known:
                d = h(others[:p] + [d] + others[p:])
            out.append((r.doc_id, t[0][i], t[-1][0], top[-1][0], h(x for _, o in known for x in o), d, d == top[-1][0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("levels", [1, 3])
def test_manifest_equals_trees_in_memory(spark, levels):
    docs = spark.createDataFrame(ODD, SCHEMA).repartition(5).withColumns({c: F.lit("x") for c in ("node", "tree", "size", "idx", "n", "id")})
    got = sorted((tuple(r) for r in merkle.manifest(docs, levels=levels).collect()), key=str)
    assert got == brute(docs.collect())
    # rows change only where the CRC says so and the text has capitals
    assert {r[-1] for r in got} == {True, False}
    assert all(r[-1] for r in got if r[0] is None or zlib.crc32(str(r[0]).encode()) % 5)


def test_manifest_of_nothing(spark):
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_one_row_is_its_own_root(spark):
    (r,) = merkle.manifest(spark.createDataFrame([(1, "Abc", "en", "s", 3)], SCHEMA)).collect()
    assert r.leaf == r.subroot == r.root and r.proof_sha256 == h([])


def test_sql_twin(spark):
    got = {tuple(r) for r in merkle.manifest(spark.read.parquet(f"{SF}/documents.parquet")).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert got == set(con.execute(sql.OP13).fetchall())


def test_sweeps_are_inverse():
    nodes = [h([str(i)]).encode() for i in range(300)]
    levels = merkle.sweep_up(nodes, 3)
    assert len(levels[-1]) == 1
    for i, known in merkle.sweep_down(levels, []):
        assert merkle.fold(nodes[i], known) == levels[-1][0]
        assert merkle._unpacked(merkle._packed(known)) == known
