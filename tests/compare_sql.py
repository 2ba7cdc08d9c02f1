"""Run registered queries on Spark and their SQL on DuckDB and compare the rows."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


SQL_TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def duck(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def plain(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if type(value).__name__ == "Decimal":
        return round(float(value), 6)
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def difference(spark, folder, name, job, sql, con) -> str | None:
    """None when the rows agree, else what differs."""
    df = job(spark, folder)
    got = table(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want = table([d[0] for d in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} and {want[0]}"
    types = {r[0]: str(r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    for f in df.schema:
        if SQL_TYPES[f.dataType.simpleString()] != types[f.name]:
            return f"type of {f.name} {f.dataType.simpleString()} and {types[f.name]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows and {len(want[1])} rows"
    for a, b in zip(got[1], want[1]):
        if a != b:
            return f"row {str(a)[:400]} and {str(b)[:400]}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from lorebase.session import get_session

    folder = sys.argv[1]
    names = sys.argv[2:] or list(entry.queries())
    spark = get_session("compare", "local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    for name in names:
        start = time.time()
        try:
            sql = entry.oracle_sql().get(name)
            if sql is None:
                rows = entry.queries()[name](spark, folder).count()
                says = f"rows only, {rows}"
            else:
                says = difference(spark, folder, name, entry.queries()[name], sql, con) or "same"
        except Exception as e:
            says = f"ERROR {type(e).__name__}: {str(e)[:900]}"
        print(f"{name}: {says} ({time.time() - start:.1f} s)", flush=True)
