"""Side-by-side comparison of a Spark result with its SQL counterpart."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return int(value) if value == int(value) and abs(value) < 1e15 else value
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    return value


def differences(spark_df, con, sql: str, limit: int = 4) -> list[str]:
    """Empty when columns and the bag of rows agree."""
    names = sorted(spark_df.columns)
    got = Counter(
        tuple(_plain(r[n]) for n in names) for r in spark_df.select(*names).collect()
    )
    cursor = con.execute(sql)
    theirs = [d[0] for d in cursor.description]
    if sorted(theirs) != names:
        return [f"columns {names} != {sorted(theirs)}"]
    place = [theirs.index(n) for n in names]
    want = Counter(tuple(_plain(row[i]) for i in place) for row in cursor.fetchall())
    if got == want:
        return []
    out = [f"rows {sum(got.values())} vs {sum(want.values())}; columns {names}"]
    out += [f"only spark: {r}" for r in sorted(got - want, key=str)[:limit]]
    out += [f"only sql:   {r}" for r in sorted(want - got, key=str)[:limit]]
    return out
