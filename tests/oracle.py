"""Compare a Spark query with its SQL on the same files."""

import datetime as dt
import decimal
import math

import duckdb

from tidemark.queries.registry import TABLES


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v else "0"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((str(k), plain(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return plain(v.asDict())
    return v


SAME = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP", "boolean": "BOOLEAN", "float": "FLOAT",
    "smallint": "SMALLINT", "tinyint": "TINYINT",
}


def compare(spark_df, con, sql):
    """None when equal, else a short description of the difference."""
    names = sorted(spark_df.columns)
    got = [tuple(plain(r[n]) for n in names) for r in spark_df.collect()]
    cur = con.execute(sql)
    heads = [(d[0], str(d[1])) for d in cur.description]
    if sorted(h for h, _ in heads) != names:
        return f"columns {names} vs {sorted(h for h, _ in heads)}"
    types = dict(spark_df.dtypes)
    odd = [
        f"{h}: {types[h]} vs {k}" for h, k in heads
        if not types[h].startswith(("decimal", "array", "struct", "map")) and SAME.get(types[h]) != k.upper()
    ]
    at = {h: i for i, (h, _) in enumerate(heads)}
    want = [tuple(plain(r[at[n]]) for n in names) for r in cur.fetchall()]
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}; types {odd}"
    key = lambda row: tuple(str(x) for x in row)
    for a, b in zip(sorted(got, key=key), sorted(want, key=key)):
        if a != b:
            return f"{dict(zip(names, a))} vs {dict(zip(names, b))}; types {odd}"
    return f"types {odd}" if odd else None
