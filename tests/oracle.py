"""Compare a registered query with its SQL, order-insensitive."""

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_cell(row[i]) for i in order) for row in rows]
    return sorted(out, key=lambda row: tuple((v is None, str(v)) for v in row))


def compare(df, con, sql):
    """Problems found, as text; empty when rows and columns agree."""
    mine = rows_of(df.columns, df.collect())
    theirs_rel = con.sql(sql)
    theirs = rows_of(theirs_rel.columns, theirs_rel.fetchall())
    if sorted(df.columns) != sorted(theirs_rel.columns):
        return f"columns {sorted(df.columns)} and {sorted(theirs_rel.columns)}", len(mine)
    if mine != theirs:
        first = next((p for p in zip(mine, theirs) if p[0] != p[1]), None)
        return f"{len(mine)} rows and {len(theirs)} rows; first difference {first}", len(mine)
    return "", len(mine)
