"""Compare a Spark result with a DuckDB oracle: rows, column names, values.

Column order is ignored (columns sorted by name) and row order is ignored
(rows sorted); doubles are compared exactly after the same rounding both
engines apply in the query.
"""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "")
        return (1, repr(float(v)))
    if isinstance(v, bool):
        return (1, repr(int(v)))
    if isinstance(v, int):
        return (1, repr(float(v)) if abs(v) < 2**53 else repr(v))
    return (1, str(v))


def canon(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    data = sorted(tuple(_norm(r[i]) for i in order) for r in rows)
    return names, data


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    s_rows = [tuple(r) for r in spark_df.collect()]
    s_cols = spark_df.columns
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    sc, sd = canon(s_cols, s_rows)
    dc, dd = canon(d_cols, d_rows)
    if sc != dc:
        return False, f"columns differ: spark={sc} duck={dc}"
    if len(sd) != len(dd):
        return False, f"row count spark={len(sd)} duck={len(dd)}"
    if sd != dd:
        bad = next(i for i in range(len(sd)) if sd[i] != dd[i])
        return False, f"values differ at sorted row {bad}: spark={sd[bad]} duck={dd[bad]}"
    return True, f"{len(sd)} rows"
