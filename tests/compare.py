"""Run every registered query next to its SQL twin: ``python tests/compare.py [sf folder] [query ...]``."""

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import __spark_entry__ as registered  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(r[i]) for i in order) for r in records)


def difference(spark, con, folder: str, name: str, look=None) -> str | None:
    """None when Spark and SQL agree, else what differs.  look: is shown the DataFrame first."""
    df = registered.queries()[name](spark, folder)
    if look:
        look(df)
    ours = rows(df.columns, df.collect())
    result = con.execute(registered.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    theirs = rows(columns, result.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} / {sorted(columns)}"
    if ours != theirs:
        only_ours, only_theirs = sorted(set(ours) - set(theirs)), sorted(set(theirs) - set(ours))
        return f"rows {len(ours)} / {len(theirs)}, e.g. {only_ours[:2]} / {only_theirs[:2]}"
    if not ours:
        return "no rows on either side"
    return None


if __name__ == "__main__":
    from session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(registered.queries())
    spark, con = local_session(), database(folder)
    for name in names:
        start = time.time()
        found = difference(spark, con, folder, name)
        print(f"{'ok  ' if found is None else 'DIFF'} {time.time() - start:6.2f}s {name} {found or ''}", flush=True)
