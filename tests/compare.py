"""Spark results against DuckDB results, exactly and regardless of row order."""

import glob
import os

import duckdb
import pandas as pd

DATA = "/root/testdata"


def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _text(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
        return "NULL"
    if isinstance(v, pd.Timestamp):
        return str(v.date())
    return str(v)


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_text(row[i]) for i in order) for row in rows)


def differences(df, con, sql, shown=5):
    """Empty if the Spark DataFrame and the SQL give the same columns and rows."""
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    kinds = {c[0]: str(c[1]) for c in result.description}
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    families = {
        "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
        "boolean": "BOOLEAN", "tinyint": "TINYINT",
    }
    problems = [
        f"type of {c}: {t} != {kinds[c]}" for c, t in df.dtypes if families.get(t, t) != kinds[c]
    ]
    ours = canonical([tuple(r) for r in df.collect()], df.columns)
    theirs = canonical(result.fetchall(), names)
    if len(ours) != len(theirs):
        problems.append(f"rows {len(ours)} != {len(theirs)}")
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if wrong:
        problems.append(f"{len(wrong)} of {len(ours)} rows differ")
        problems += [f"{a} != {b}" for a, b in wrong[:shown]]
    return problems
