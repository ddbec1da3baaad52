"""Compare a Spark result with its SQL twin: columns, types, rows in any order."""

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(folder):
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(0.0 if v == 0 else v)
    return repr(v)


def _rows(table, names):
    cols = [table.column(n).to_pylist() for n in names]
    return sorted(tuple(_norm(v) for v in r) for r in zip(*cols)) if cols else []


def difference(spark_df, con, sql):
    """None when equal, else a short description."""
    got = spark_df.toArrow()
    want = con.execute(sql).to_arrow_table()
    names = sorted(got.column_names)
    if names != sorted(want.column_names):
        return f"columns {names} != {sorted(want.column_names)}"
    types = {n: (str(got.schema.field(n).type), str(want.schema.field(n).type)) for n in names}
    odd = {n: p for n, p in types.items() if p[0].replace("large_", "") != p[1].replace("large_", "")}
    a, b = _rows(got, names), _rows(want, names)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}; types {odd}; spark-only {list(set(a) - set(b))[:3]} sql-only {list(set(b) - set(a))[:3]}"
    if a != b:
        sa, sb = set(a), set(b)
        return f"values differ ({len(sa - sb)} of {len(a)}): spark {sorted(sa - sb)[:3]} sql {sorted(sb - sa)[:3]}; types {odd}"
    if odd:
        return f"types {odd}"
    if not a:
        return "EMPTY"
    return None
