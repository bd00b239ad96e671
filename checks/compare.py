"""Compare every query with its SQL: ``python -m checks.compare FOLDER [QUERY ...]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

from checks.oracle import ORACLE
from checks.queries import QUERIES, runnable
from custarc.session import session


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    return con


def _cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def _bag(rows, order) -> Counter:
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


# Spark type -> the DuckDB type that counts as equal.
TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "float": "FLOAT",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when names, types and the bag of rows agree, else what differs."""
    result = con.execute(sql)
    theirs = {d[0]: str(d[1]) for d in result.description}
    ours = dict(df.dtypes)
    if sorted(ours) != sorted(theirs):
        return f"columns {sorted(ours)} != {sorted(theirs)}"
    names = sorted(ours)
    typed = [(n, ours[n], theirs[n]) for n in names if TYPES.get(ours[n]) != theirs[n]]
    if typed:
        return f"types {typed}"
    left = _bag(df.collect(), [df.columns.index(n) for n in names])
    columns = list(theirs)
    right = _bag(result.fetchall(), [columns.index(n) for n in names])
    if left == right:
        return None
    only_left, only_right = left - right, right - left
    return (
        f"{sum(left.values())} rows, {sum(right.values())} expected; {names}\n"
        f"  only ours: {list(only_left.items())[:3]}\n  only expected: {list(only_right.items())[:3]}"
    )


def main(folder: str, names: list[str]) -> int:
    spark = session("compare", "local[8]", {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    bad = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            found = difference(runnable(name)(spark, folder), con, ORACLE[name])
        except Exception as e:
            found = f"{type(e).__name__}: {str(e)[:600]}"
        bad += found is not None
        print(f"{'ok  ' if found is None else 'FAIL'} {name} {time.time() - start:.1f}s {found or ''}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
