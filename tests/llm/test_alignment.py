"""Alignment of whole texts against plain loops over both libraries' tokens."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lodestone.llm import alignment, queries

SF = "/root/testdata/sf0.001"
A, B = (str(public_tokenizers.path(name)) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
ODD = [
    None, "", " ", "  ", "a ", " a", "a  b", "\n\n x", "x\n x\n\n  y\t z", "a\t\tb\n  c <s> </s>", "▁x holds the space sign", "é ﬁ", "a　b 漢字 かな",
    "<|endoftext|> hi <|endoftext|>", "\x00a b\x1c c\x85 d", "'s 's don't  'll", "😀 😀😀 ok", "word " * 20_000, "x" * 50_000, "one two", "one two",
]


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    letters = alignment.byte_letters()
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    piece = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()

    def tokens(text):
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        return [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in ids_a], [(i, piece(i)) for i in ids_b]

    return tokens


def ends(tokens):
    return np.cumsum([len(x) for _, x in tokens]).tolist()


def brute(rows, tokens):
    docs, count = [], Counter()
    for k, text in rows:
        a, b = tokens(text) if text else ([], [])
        if not text or b"".join(x for _, x in a) != (" " + text).encode() or b"".join(x for _, x in b) != (" " + text).encode():
            a, b = [], []
        ea, eb = ends(a), ends(b)
        common = sorted({*ea} & {*eb})
        at_a, at_b = dict(zip(ea, (i for i, _ in a))), dict(zip(eb, (i for i, _ in b)))
        links = [(at_a[e], at_b[e]) for e in common]
        text, start = [], 0
        for e in common:
            text.append(",".join(str(i) for x, (i, _) in zip(ea, a) if start < x <= e) + "|" + ",".join(str(i) for x, (i, _) in zip(eb, b) if start < x <= e))
            start = e
        docs.append((k, len(a), len(b), len(common), links, hashlib.sha256(";".join(text).encode()).hexdigest() if common else ""))
        count.update(links)
    highest = {}
    for (_, j), n in count.items():
        highest[j] = max(highest.get(j, 0), n)
    return sorted(
        ((k, a, b, g, len(x), sum(count[p] == highest[p[1]] for p in x), sum(count[p] for p in x), h) for k, a, b, g, x, h in docs), key=str
    )


def short(rows):
    """Texts that the quadratic loop of the brute force can do."""
    return [(k, t if t is None or len(t) < 3000 else t[:3000]) for k, t in rows]


@pytest.mark.parametrize("size", [1, 4000, alignment.BLOCK_BYTES])
def test_texts_against_loops(spark, tokenizers, size):
    signs, rng = "ab \n\t ' s é漢 1.,<>▁ \x1c 😀", random.Random(size)
    rows = short([(i if i else None, t) for i, t in enumerate(ODD)] + [(7, "".join(rng.choices(signs, k=rng.randrange(40)))) for _ in range(150)])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).withColumns({c: F.lit("x") for c in ("block", "codes", "n", "best")})
    got = sorted((tuple(r) for r in alignment.aligned(docs, A, B, size=size).collect()), key=str)
    assert got == brute(rows, tokenizers)


def test_query_against_loops(spark, tokenizers):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 3000").collect()]
    got = sorted((tuple(r) for r in alignment.aligned(spark.createDataFrame(rows, "doc_id long, text string"), A, B).collect()), key=str)
    assert got == brute(rows, tokenizers)
    assert queries.op12_alignment(spark, SF).count() == 200


def test_chunks_are_cut_where_both_tokenizers_cut(tokenizers):
    pair = alignment.Pair(A, B)
    for text in [t for t in ODD if t]:
        pieces = alignment.chunks(text)
        assert "".join(" " + c for c in pieces) == " " + text
        found = pair.encoded(pieces)
        if all(found):
            assert tuple([i for x in found for i in x[k]] for k in (0, 1)) == tuple([i for i, _ in t] for t in tokenizers(text))


def test_no_texts(spark):
    assert alignment.aligned(spark.createDataFrame([], "doc_id long, text string"), A, B).collect() == []


def dense(m):
    out = np.zeros((len(m.indptr) - 1, m.width), np.int64)
    np.add.at(out, (m.rows(), m.indices), m.data)
    return out


def random_csr(rng, height, width):
    sizes = rng.integers(0, 4, height)
    return alignment.Csr(alignment.pointers(sizes), rng.integers(0, width, sizes.sum()), rng.integers(1, 5, sizes.sum()), width)


def test_products_equal_dense_ones():
    rng = np.random.default_rng(3)
    for _ in range(50):
        n, m, k = rng.integers(1, 12, 3)
        a, b = random_csr(rng, n, m), random_csr(rng, m, k)
        assert (dense(alignment.product(a, b)) == dense(a) @ dense(b)).all()
        assert (dense(alignment.transposed(a)) == dense(a).T).all()


def test_links_of_every_kind():
    rng = random.Random(2)
    for _ in range(100):
        n = rng.randrange(1, 30)
        ea, eb = (np.array(sorted({n, *rng.sample(range(1, n + 1), rng.randrange(n))})) for _ in "ab")
        got = alignment.align(ea, eb, "all")
        sa, sb = ([0, *e[:-1]] for e in (ea, eb))
        over = np.array([[max(0, min(x, y) - max(u, v)) for v, y in zip(sb, eb)] for u, x in zip(sa, ea)])
        assert (dense(got.overlap) == over).all() and got.ends.tolist() == sorted({*ea} & {*eb})
        assert (dense(got.ending) == (ea[:, None] == eb[None])).all()
        group = lambda e: np.array([sum(c < x for c in got.ends) for x in e])
        assert (dense(got.shared) == (group(ea)[:, None] == group(eb)[None])).all()
