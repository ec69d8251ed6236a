"""Side-by-side check of a registered query against its DuckDB twin.

Mirrors the driver's gate: same column names, same row count and the
same multiset of rows (order-insensitive), with floating values compared
after the rounding both sides already apply.
"""

from __future__ import annotations

import math

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duckdb_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def compare(spark, con, query, sf_dir: str) -> dict:
    sdf = query.run(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(_norm(r[c]) for c in sorted(s_cols)) for r in sdf.collect()]
    res = {"name": query.name, "spark_rows": len(s_rows)}
    sql = query.oracle()
    if sql is None:
        res["status"] = "rows-only"
        return res
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_all = rel.fetchall()
    idx = {c: i for i, c in enumerate(d_cols)}
    res["duck_rows"] = len(d_all)
    if sorted(d_cols) != sorted(s_cols):
        res["status"] = f"columns differ: spark={sorted(s_cols)} duck={sorted(d_cols)}"
        return res
    tmap = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
            "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT"}
    s_types = {f.name: tmap.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in sdf.schema.fields}
    d_types = {d[0]: str(d[1]) for d in rel.description}
    mism = {c: (s_types[c], d_types[c]) for c in s_cols if s_types[c] != d_types[c]}
    if mism:
        res["type_mismatch"] = mism
    d_rows = [tuple(_norm(r[idx[c]]) for c in sorted(s_cols)) for r in d_all]
    key = lambda t: tuple((x is None, str(type(x)), str(x)) for x in t)
    s_sorted, d_sorted = sorted(s_rows, key=key), sorted(d_rows, key=key)
    if s_sorted == d_sorted:
        res["status"] = "match"
    else:
        diff = [(a, b) for a, b in zip(s_sorted, d_sorted) if a != b][:3]
        res["status"] = f"values differ ({len(s_rows)} vs {len(d_rows)} rows); first: {diff}"
    return res
