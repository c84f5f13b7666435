"""Run named queries against their SQL twins: python tests/oracle.py [sf_dir] [name ...]."""

import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Spark type -> DuckDB type.
SQL_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


def oracle_rows(sf_dir, sql):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    rows = cursor.fetchall()
    types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return names, rows, types


def canonical(names, rows):
    """Rows with columns in name order, sorted by their text."""
    at = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(r[i]) for i in at) for r in rows)


def compare(spark, sf_dir, fn, sql):
    """None if both sides agree, else what differs."""
    df = fn(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    names, want, types = oracle_rows(sf_dir, sql)
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    ours = {f.name: f.dataType.simpleString() for f in df.schema}
    clash = {n: (ours[n], types[n]) for n in names if SQL_TYPES.get(ours[n]) != types[n]}
    if clash:
        return f"types {clash}"
    if len(got) != len(want):
        return f"{len(got)} rows, SQL has {len(want)}"
    pairs = zip(canonical(df.columns, got), canonical(names, want))
    bad = [(a, b) for a, b in pairs if a != b]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None


def main():
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", os.environ.get("ORACLE_TZ", "UTC"))
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    failed = 0
    sqls = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if args and name not in args:
            continue
        start = time.time()
        try:
            verdict = compare(spark, sf_dir, fn, sqls[name]) if name in sqls else f"rows only: {fn(spark, sf_dir).count()}"
        except Exception as error:
            verdict = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += verdict is not None and not verdict.startswith("rows only")
        print(f"{name:32s} {time.time() - start:6.1f}s  {verdict or 'ok'}", flush=True)
    sys.exit(1 if failed else 0)


if __name__ == "__main__":
    main()
