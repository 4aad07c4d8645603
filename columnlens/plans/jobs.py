"""From files to files: the four analyses of a corpus, start to end.

Each job reads lists and tables, writes JSON lines under ``out`` (a new folder)
and sets failures aside in ``out/quarantine``.  Tables are taken in batches; a
batch is one Spark job.  Batches run side by side, so each writes a folder of
its own.  Names of datasets and columns pass through the driver, cells never do.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..operators.counts import corpus_counts
from ..operators.keys import key_candidates
from ..operators.resolve import resolve_columns, unresolved
from ..operators.tally import (
    empty_labels,
    filled_values,
    pattern_mentions,
    term_mentions,
    top_values,
    value_tally,
    without_numbers,
)
from ..sources.documents import (
    read_profiles,
    write_keys,
    write_labels,
    write_metrics,
    write_profiles,
    write_semantic,
)
from ..sources.lists import read_truth, read_worklist
from ..sources.split import read_split_table
from ..sources.tables import TABLE_SUFFIX, read_catalog, read_table, table_headers
from .batches import QUARANTINE_SCHEMA, run_each
from .evaluate import (
    column_precision,
    correct_counts,
    distinct_worklist,
    label_counts,
    label_lines,
    precision_recall,
    predicted_counts,
    predicted_types,
    unmatched_labels,
)
from .profile import profile_corpus
from .semantic import RuleSet, semantic_profile, semantic_types

SEMANTIC_SCHEMA = "dataset string, column string, label string, cnt bigint, rank int"

Reader = Callable[[SparkSession, str], DataFrame]

# Bytes of a file that one task may read alone.
ONE_TASK = 128 * 1024 * 1024
# A compressed file is read by one task; the jobs deal the rows of a large one out before they
# count them.
READ_PARTITIONS = 64
_COMPRESSED = (".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate", ".xz")


def read_dealt(spark: SparkSession, path: str) -> DataFrame:
    """``read_table``; a large plain file is read by many tasks, and the rows of a large
    compressed one are dealt over ``READ_PARTITIONS``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)  # sizes only
    plain = ~F.lower("path").rlike("(" + "|".join(e.replace(".", r"\.") for e in _COMPRESSED) + ")$")
    found = files.agg(F.sum("length").alias("bytes"), F.every(plain).alias("plain")).first()
    if (found["bytes"] or 0) <= ONE_TASK:
        return read_table(spark, path)
    return read_split_table(spark, path) if found["plain"] else read_table(spark, path, partitions=READ_PARTITIONS)


def profile_datasets(
    spark: SparkSession,
    catalog: str,
    out: str,
    directory: str | None = None,
    reader: Reader = read_dealt,
    batch: int = 32,
) -> DataFrame:
    """Profile documents of all datasets of a catalog; returns what failed."""
    paths = _paths(spark, catalog, directory)
    target = f"{out}/profiles"

    def work(opened: dict[tuple, DataFrame]) -> None:
        tables = {dataset: table for (dataset,), table in opened.items()}
        write_profiles(profile_corpus(tables), _part(target))

    _new(spark, target)
    items = [(d,) for d in paths]
    failed = run_each(spark, items, work, lambda item: reader(spark, paths[item[0]]), batch)
    return _set_aside(failed, out)


def find_keys(
    spark: SparkSession,
    catalog: str,
    out: str,
    directory: str | None = None,
    reader: Reader = read_dealt,
    max_width: int | None = None,
    all_superkeys: bool = False,
) -> DataFrame:
    """Key candidates of all datasets of a catalog; returns what failed."""
    paths = _paths(spark, catalog, directory)
    target = f"{out}/keys"

    def work(opened: dict[tuple, DataFrame]) -> None:
        for (dataset,), table in opened.items():
            found = key_candidates(table, None, max_width, all_superkeys)
            write_keys(found.withColumn("dataset", F.lit(dataset)), _part(target))

    _new(spark, target)
    items = [(d,) for d in paths]
    # one dataset at a time: a failure must not repeat the keys already written
    failed = run_each(spark, items, work, lambda item: reader(spark, paths[item[0]]), batch=1)
    return _set_aside(failed, out)


def label_columns(
    spark: SparkSession,
    worklist: str,
    truth: str,
    directory: str,
    out: str,
    rules: RuleSet | None = None,
    dictionary: DataFrame | None = None,
    aliases: Mapping[str, str] | None = None,
    reader: Reader = read_dealt,
    suffix: str = TABLE_SUFFIX,
    batch: int = 32,
) -> DataFrame:
    """Semantic documents of listed columns, and how right they are; returns what failed.

    Every dataset is read once, however many of its columns are listed.
    """
    entries, labels = read_worklist(spark, worklist), read_truth(spark, truth)
    labelled = distinct_worklist(entries, labels)
    counted, missing = f"{out}/types", f"{out}/unresolved"
    done: list[tuple[str, str]] = []  # parts of batches that were written whole

    def work(opened: dict[tuple, DataFrame]) -> None:
        tables = {dataset: table for (dataset,), table in opened.items()}
        wanted = labelled.select("idx", "dataset", "column").filter(
            F.col("dataset").isin(*tables)
        )
        resolved = resolve_columns(wanted, table_headers(spark, tables), aliases)
        listed = resolved.collect()  # one row per listed column
        plan = spark.createDataFrame(listed, resolved.schema)
        columns: dict[str, list[str]] = {}
        for row in listed:
            known = columns.setdefault(row["dataset"], [])
            if row["resolved"] is not None and row["resolved"] not in known:
                known.append(row["resolved"])
        own = _part(counted), _part(missing)
        unresolved(plan).write.json(own[1])
        if any(columns.values()):
            counts = corpus_counts(tables, columns).select("dataset", "column", "value", "cnt")
            names = plan.filter("resolved IS NOT NULL").select(
                "dataset", F.col("resolved").alias("header"), "column"
            )
            counts = (
                counts.withColumnRenamed("column", "header")
                .join(names, ["dataset", "header"])
                .drop("header")
            )
            semantic_types(counts, rules, dictionary).write.json(own[0])
        else:
            spark.createDataFrame([], SEMANTIC_SCHEMA).write.json(own[0])
        done.append(own)

    _new(spark, counted)
    _new(spark, missing)
    datasets = [(r["dataset"],) for r in labelled.select("dataset").distinct().orderBy("dataset").collect()]
    failed = run_each(
        spark, datasets, work, lambda item: reader(spark, f"{directory}/{item[0]}{suffix}"), batch
    )
    # a batch that failed halfway was repeated in halves: its parts are not read
    failed = failed.unionByName(_read(spark, QUARANTINE_SCHEMA, [m for _, m in done]))

    semantic = _read(spark, SEMANTIC_SCHEMA, [c for c, _ in done])
    predicted = predicted_types(semantic, labelled)
    write_semantic(semantic_profile(semantic, labelled), f"{out}/documents")
    write_labels(label_lines(entries, labels), f"{out}/manual_labels")
    write_metrics(unmatched_labels(entries, labels), f"{out}/unmatched_labels")
    write_metrics(label_counts(labelled), f"{out}/actual_labels")
    write_metrics(predicted_counts(predicted), f"{out}/predicted_labels")
    write_metrics(correct_counts(predicted), f"{out}/correct_labels")
    write_metrics(precision_recall(predicted, labelled), f"{out}/precision_recall")
    write_metrics(column_precision(semantic, labelled), f"{out}/column_precision")
    return _set_aside(failed, out)


def report(spark: SparkSession, profiles: str, out: str) -> None:
    """What a profiled corpus mentions: top values, empties, boroughs, schools, streets."""
    tally = value_tally(read_profiles(spark, profiles))
    words = without_numbers(tally)
    cells = filled_values(words)

    def terms(names: tuple[str, ...]) -> DataFrame:
        return spark.createDataFrame([(n,) for n in names], "term string")

    parts = {
        "top_values": top_values(tally),
        "top_words": top_values(words),
        "top_cells": top_values(cells),
        "empty_labels": empty_labels(words),
        "boroughs": term_mentions(cells, terms(fixed.BOROUGH_NAMES)),
        "school_levels": term_mentions(cells, terms(fixed.SCHOOL_LEVEL_TERMS)),
        "streets": pattern_mentions(cells),
    }
    for name, part in parts.items():
        part.write.json(f"{out}/{name}")


def _paths(spark: SparkSession, catalog: str, directory: str | None) -> dict[str, str]:
    rows = read_catalog(spark, catalog, directory).toLocalIterator()
    return {r["dataset"]: r["path"] for r in rows}


def _new(spark: SparkSession, target: str) -> None:
    """An empty folder of JSON lines, so that nothing is added to an older run."""
    spark.createDataFrame([], "value string").write.text(target)


def _part(target: str) -> str:
    return f"{target}/{uuid.uuid4().hex}"


def _read(spark: SparkSession, schema: str, parts: list[str]) -> DataFrame:
    """The given parts of a folder."""
    if not parts:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(parts)


def _set_aside(failed: DataFrame, out: str) -> DataFrame:
    failed.write.json(f"{out}/quarantine")
    return failed
