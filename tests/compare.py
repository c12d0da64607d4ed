"""Order-insensitive comparison of a Spark result with a DuckDB result."""

import glob
import math
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        value = int(value)
    if isinstance(value, float) and math.isnan(value):
        return (0, "")
    if isinstance(value, (int, float)) or type(value).__name__ == "Decimal":
        return (1, repr(float(value) + 0.0))
    return (2, str(value))


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql):
    """Empty string when equal, otherwise what differs."""
    mine_names, mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    their_names, theirs = rows_of([c[0] for c in result.description], result.fetchall())
    if mine_names != their_names:
        return f"columns {set(mine_names) ^ set(their_names)}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} vs {len(theirs)}"
    for a, b in zip(mine, theirs):
        if a != b:
            cells = [(n, x[1], y[1]) for n, x, y in zip(mine_names, a, b) if x != y]
            return f"values {cells[:4]}"
    return ""
