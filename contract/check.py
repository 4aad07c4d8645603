"""Run registered queries against their SQL: ``python -m contract.check [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import tempfile
import time
import traceback

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if hasattr(value, "as_integer_ratio"):
        return float(value) if not isinstance(value, (int, bool)) else value
    return value


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(spark, connection, query, sql, directory) -> str:
    frame = query(spark, directory)
    got = sorted_rows(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    want = sorted_rows(names, cursor.fetchall())
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} / {sorted(names)}"
    if len(got) != len(want):
        extra = [r for r in got if r not in set(want)][:3]
        missing = [r for r in want if r not in set(got)][:3]
        return f"rows {len(got)} / {len(want)}; extra {extra}; missing {missing}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    return f"values {len(wrong)}: {wrong[:3]}" if wrong else ""


def connect(directory):
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{directory}/{name}.parquet')"
        )
    return connection


def main() -> int:
    from pyspark.sql import SparkSession

    from .oracle import ORACLE_SQL
    from .queries import QUERIES

    directory = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="columnlens-"))  # one machine
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(directory)
    failed = 0
    for name in wanted:
        start = time.time()
        try:
            problem = (
                compare(spark, connection, QUERIES[name], ORACLE_SQL[name], directory)
                if name in ORACLE_SQL
                else f"no SQL; {QUERIES[name](spark, directory).count()} rows"
            )
        except Exception:
            problem = traceback.format_exc(limit=-3)[-1500:]
        failed += bool(problem)
        print(f"{name:24} {time.time() - start:6.2f}s  {problem or 'ok'}", flush=True)
    print(f"{len(wanted) - failed} of {len(wanted)} match")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
