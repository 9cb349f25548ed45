"""Run named queries on Spark and their SQL on DuckDB and compare the rows.

    python tests/oracle_check.py [--sf DIR] [--only PREFIX,...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def session(cores: int = 8):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("wearcurve-check")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _key(row):
    return tuple((v is None, str(type(v)) if isinstance(v, (list, dict)) else "", v if v is not None else 0) for v in row)


def _number(v):
    return float(v) if hasattr(v, "as_tuple") else v


def compare(spark_rows, columns, duck_rows, duck_columns):
    """Differences as text, or None. Columns are compared in name order, rows in value order."""
    if sorted(columns) != sorted(duck_columns):
        return f"columns {sorted(columns)} vs {sorted(duck_columns)}"
    names = sorted(columns)
    left = sorted((tuple(_number(r[columns.index(c)]) for c in names) for r in spark_rows), key=_key)
    right = sorted((tuple(_number(r[duck_columns.index(c)]) for c in names) for r in duck_rows), key=_key)
    if len(left) != len(right):
        return f"{len(left)} vs {len(right)} rows"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        close = all(
            x == y or (isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, rel_tol=1e-6, abs_tol=2e-6))
            for a, b in wrong
            for x, y in zip(a, b)
        )
        return f"{len(wrong)} of {len(left)} rows differ{' (last digit)' if close else ''}: {names} {wrong[0]}"
    return None


FAMILY = {"HUGEINT": "BIGINT"}
SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--only", default="")
    args = parser.parse_args()
    from wearcurve.plans import registry

    spark, con = session(), database(args.sf)
    wanted = [w for w in args.only.split(",") if w]
    bad = 0
    for name, q in registry.load_all().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        begin = time.time()
        try:
            df = registry.runnable(q)(spark, args.sf)
            rows = [tuple(r) for r in df.collect()]
            took = time.time() - begin
            if q.sql is None:
                print(f"rows  {name:38s} {took:6.2f}s {len(rows)} rows", flush=True)
                continue
            begin = time.time()
            result = con.execute(q.sql)
            duck_columns = [d[0] for d in result.description]
            kinds = {d[0]: str(d[1]) for d in result.description}
            duck_rows = result.fetchall()
            duck = time.time() - begin
            problem = compare(rows, df.columns, duck_rows, duck_columns)
            types = {
                f.name: (f.dataType.simpleString(), kinds.get(f.name))
                for f in df.schema.fields
                if SPARK_TO_DUCK.get(f.dataType.simpleString()) != kinds.get(f.name)
            }
        except Exception as e:  # noqa: BLE001
            problem, took, duck, rows, types = f"{type(e).__name__}: {str(e)[:600]}", time.time() - begin, 0.0, [], {}
        bad += problem is not None
        note = f" types {types}" if types else ""
        print(f"{'OK   ' if problem is None else 'WRONG'} {name:38s} {took:6.2f}s duck {duck:5.2f}s {len(rows)} rows{note}", flush=True)
        if problem:
            print("      ", problem, flush=True)
    print("wrong:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
