"""Comparing queries with their SQL."""

import duckdb

SF = "/root/testdata/sf0.001"
TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def rows(names, found):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in found), key=lambda r: tuple((v is None, str(v)) for v in r))


def against_sql(spark, name, queries, sqls, sf=SF):
    frame = queries[name](spark, sf)
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    cursor = connection.execute(sqls[name])
    names = [d[0] for d in cursor.description]
    assert sorted(frame.columns) == sorted(names)
    assert rows(frame.columns, frame.collect()) == rows(names, cursor.fetchall())
