"""Run every registered query next to its SQL on DuckDB: python tests/oracle.py SF_DIR [key ...]."""

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import __spark_entry__ as registered


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(
        (tuple(normal(row[i]) for i in order) for row in rows),
        key=lambda row: tuple((value is None, str(value)) for value in row),
    )


def duck(sf_dir):
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(spark, con, key, sf_dir):
    """None when both sides agree, else what differs."""
    df = registered.queries()[key](spark, sf_dir)
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(registered.oracle_sql()[key])
    names = [d[0] for d in cursor.description]
    theirs = rows_of(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {df.columns} != {names}"
    if ours != theirs:
        extra = [r for r in ours if r not in set(theirs)][:2]
        missing = [r for r in theirs if r not in set(ours)][:2]
        return f"{len(ours)} rows != {len(theirs)} rows; only ours {extra}, only SQL {missing}"
    return None


if __name__ == "__main__":
    sf_dir = sys.argv[1]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    failed = 0
    for key in sys.argv[2:] or registered.queries():
        began = time.time()
        try:
            problem = compare(spark, con, key, sf_dir)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{time.time() - began:6.2f}s {key}: {problem or 'equal'}", flush=True)
    sys.exit(failed > 0)
