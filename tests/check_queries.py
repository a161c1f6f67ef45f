"""Compare every query with its SQL: ``python tests/check_queries.py [sf_dir] [names…]``."""

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as driver  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def sql_session(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    key = lambda row: tuple((v is not None, str(type(v)), str(v)) for v in row)
    return sorted(columns), sorted((tuple(row[i] for i in order) for row in rows), key=key)


def compare(spark, con, name, sf_dir):
    """``None`` if the query and its SQL agree, else what differs; and the row count."""
    df = driver.queries()[name](spark, sf_dir)
    got = _canonical(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(driver.oracle_sql()[name])
    want = _canonical([d[0] for d in cursor.description], cursor.fetchall())
    if got == want:
        return None, len(got[1])
    if got[0] != want[0]:
        return f"columns {got[0]} / {want[0]}", len(got[1])
    only = [set(a) - set(b) for a, b in ((got[1], want[1]), (want[1], got[1]))]
    samples = [sorted(o, key=str)[:3] for o in only]
    return f"{len(got[1])} / {len(want[1])} rows; only ours {samples[0]}; only SQL {samples[1]}", len(got[1])


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = sql_session(sf_dir), 0
    for name in sys.argv[2:] or driver.queries():
        start = time.time()
        try:
            problem, rows = compare(spark, con, name, sf_dir)
        except Exception as e:
            problem, rows = f"{type(e).__name__}: {str(e)[:1500]}", 0
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {rows} rows {time.time() - start:.1f}s {problem or ''}")
    sys.exit(bad > 0)
