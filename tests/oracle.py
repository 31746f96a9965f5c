"""Run registered queries in Spark and DuckDB and compare the rows."""
from __future__ import annotations

import datetime
import math
import pathlib
import sys
import time
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return str(v)


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
          "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


def compare(spark, con, name, build, text, folder) -> list[str]:
    """Problems found, none if both engines agree."""
    df = build(spark, folder)
    got = rows_of(df.columns, df.collect())
    rel = con.sql(text)
    want = rows_of(rel.columns, rel.fetchall())
    problems = []
    if sorted(df.columns) != sorted(rel.columns):
        problems.append(f"columns {sorted(df.columns)} != {sorted(rel.columns)}")
    types = {c: _TYPES.get(t, t) for c, t in df.dtypes}
    other = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    if types != other:
        problems.append(f"types {types} != {other}")
    if got != want:
        extra, lacking = list((got - want).items())[:3], list((want - got).items())[:3]
        problems.append(f"rows {got.total()} vs {want.total()}, differing {(got - want).total()}; spark {extra} duck {lacking}")
    if not got:
        problems.append("no rows")
    return problems


if __name__ == "__main__":
    sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))
    from tests.session import make_session
    import __spark_entry__ as entry
    folder = sys.argv[1] if "/" in sys.argv[1] else f"/root/testdata/{sys.argv[1]}"
    wanted = sys.argv[2:]
    spark, con = make_session(), duck(folder)
    bad = 0
    for name, build in entry.queries().items():
        if wanted and name not in wanted:
            continue
        begun = time.time()
        try:
            if name in entry.oracle_sql():
                problems = compare(spark, con, name, build, entry.oracle_sql()[name], folder)
            else:
                problems = [] if build(spark, folder).count() else ["no rows"]
        except Exception as e:  # report and go on
            problems = [f"{type(e).__name__}: {str(e)[:600]}"]
        bad += bool(problems)
        print(f"{'ok  ' if not problems else 'FAIL'} {name} {time.time() - begun:.1f}s", *problems, sep="\n     " if problems else " ")
    print("failed", bad)
