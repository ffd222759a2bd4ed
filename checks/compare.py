"""Run registered queries and their SQL side by side: python -m checks.compare [sf dir] [names]."""

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks.oracles import oracle_sql
from checks.queries import QUERIES


def connect(sf: str):
    con = duckdb.connect()
    for file in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _plain(value):
    if isinstance(value, float) and not math.isnan(value):
        return repr(value)
    return value


def _bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark: SparkSession, con, sf: str, name: str, sql: str) -> str:
    """Empty if both sides agree in columns and rows, else what differs."""
    result = QUERIES[name](spark, sf)
    ours = _bag(result.columns, [tuple(row) for row in result.collect()])
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    theirs = _bag(columns, cursor.fetchall())
    if sorted(columns) != sorted(result.columns):
        return f"columns {sorted(result.columns)} / {sorted(columns)}"
    if ours == theirs:
        return ""
    show = lambda bag: [str(row)[:300] for row in list(bag)[:2]]
    return (f"rows {sum(ours.values())} / {sum(theirs.values())}; only Spark "
            f"{show(ours - theirs)}; only SQL {show(theirs - ours)}")


def main() -> None:
    from voxlake.settings import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = connect(sf), oracle_sql(), 0
    for name in names:
        start = time.time()
        try:
            found = differences(spark, con, sf, name, oracles[name]) if name in oracles else \
                f"no SQL, {QUERIES[name](spark, sf).count()} rows"
        except Exception as failure:  # report and go on
            found = f"{type(failure).__name__}: {str(failure)[:1500]}"
        bad += bool(found)
        print(f"{name:26} {time.time() - start:6.2f}s {found or 'ok'}", flush=True)
    print(f"{len(names)} queries, {bad} not equal")


if __name__ == "__main__":
    main()
