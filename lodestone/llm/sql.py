"""SQL twins of the queries that SQL can express, for DuckDB."""

from __future__ import annotations


def _value(c: str) -> str:
    return f"coalesce(octet_length(encode(CAST({c} AS VARCHAR)))::VARCHAR || ':' || CAST({c} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_value(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _crc32(c: str) -> str:
    """Bit by bit, as DuckDB has no CRC."""
    byte = "list_reduce(list_prepend(xor(a, c), [1::BIGINT, 2, 3, 4, 5, 6, 7, 8]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384::BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({c}, ''), lambda d: ord(d)::BIGINT)), lambda a, c: {byte}), 4294967295)"


def _tree(name: str, base: str) -> str:
    return f"""
{name}(level, tree, idx, size, digest) AS (
    {base}
    UNION ALL
    SELECT level + 1, tree, idx // 16, (size + 15) // 16, sha256(string_agg(digest, '' ORDER BY idx))
    FROM {name} WHERE size > 1 GROUP BY level, tree, size, idx // 16
),
{name}_runs AS (
    SELECT level, tree, idx // 16 AS run, size, list(digest ORDER BY idx) AS kids FROM {name} WHERE size > 1 GROUP BY level, tree, size, idx // 16
)"""


def _climb(name: str, runs: str, base: str) -> str:
    p = "(w.idx % 16)"
    return f"""
{name}(doc_id, tree, level, idx, proof, folded) AS (
    {base}
    UNION ALL
    SELECT w.doc_id, w.tree, w.level + 1, w.idx // 16, w.proof || array_to_string(list_concat(kids[1:{p}], kids[{p} + 2:]), ''),
        sha256(array_to_string(list_concat(list_append(kids[1:{p}], w.folded), kids[{p} + 2:]), ''))
    FROM {name} w JOIN {runs} r ON r.tree = w.tree AND r.level = w.level AND r.run = w.idx // 16
)"""


OP13 = f"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, source, {_leaf("text")} AS leaf,
        CASE WHEN {_crc32("doc_id::VARCHAR")} % 5 = 0
            THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} ELSE {_leaf("text")} END AS changed,
        row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS idx, count(*) OVER (PARTITION BY source) AS size,
        dense_rank() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS tree
    FROM documents
),
{_tree("up", "SELECT 0::BIGINT, tree, idx, size, leaf FROM leaves")},
subroots AS (SELECT tree, digest FROM up WHERE size = 1),
{_tree("upper_tree", "SELECT 0::BIGINT, 0::BIGINT, tree, count(*) OVER (), digest FROM subroots")},
{_climb("way", "up_runs", "SELECT doc_id, tree, 0::BIGINT, idx, '', changed FROM leaves")},
arrived AS (SELECT doc_id, tree, proof, folded FROM way QUALIFY level = max(level) OVER (PARTITION BY doc_id)),
{_climb("way2", "upper_tree_runs", "SELECT doc_id, 0::BIGINT, 0::BIGINT, tree, proof, folded FROM arrived")},
ended AS (SELECT doc_id, proof, folded FROM way2 QUALIFY level = max(level) OVER (PARTITION BY doc_id)),
root AS (SELECT digest AS root FROM upper_tree WHERE size = 1)
SELECT l.doc_id, l.leaf, s.digest AS subroot, root, sha256(e.proof) AS proof_sha256, e.folded AS folded_root, e.folded = root AS verified
FROM leaves l JOIN subroots s USING (tree) JOIN ended e USING (doc_id), root
"""

_KEY = """CASE WHEN contains(url, '://')
    THEN array_to_string(list_reverse(string_split(lower(regexp_extract(url, '://([^/?#]*)', 1)), '.')), ',') || ')' || regexp_replace(url, '^.*?://[^/?#]*', '')
    ELSE coalesce(url, '') END"""

OP11 = f"""
WITH p AS (
    SELECT page_id, {_KEY} AS url_key, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
),
f AS (SELECT *, payload_bytes >= 100 AND page_id <> min(page_id) OVER (PARTITION BY payload_digest) AS again, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN again THEN first END AS refers_to, url_key, row_number() OVER (ORDER BY url_key, page_id) - 1 AS position
FROM f
"""
