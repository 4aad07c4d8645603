"""The catalog of datasets and the tables in it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_SUFFIX = ".tsv.gz"


def read_catalog(
    spark: SparkSession, path: str, directory: str | None = None, suffix: str = TABLE_SUFFIX
) -> DataFrame:
    """Datasets of a tab-separated list: ``dataset, path``.

    The id is the first field.  Files are looked for in ``directory``, by
    default where the list is.
    """
    where = directory if directory is not None else path.rsplit("/", 1)[0]
    return parse_catalog(spark.read.text(path), where, suffix)


def parse_catalog(lines: DataFrame, directory: str, suffix: str = TABLE_SUFFIX) -> DataFrame:
    """``read_catalog`` for lines that are already a frame with ``value``."""
    dataset = F.split_part(F.col("value"), F.lit("\t"), F.lit(1))
    return lines.select(dataset.alias("dataset")).select(
        "dataset", dataset_path("dataset", directory, suffix).alias("path")
    )


def dataset_path(dataset: str | Column, directory: str, suffix: str = TABLE_SUFFIX) -> Column:
    name = F.col(dataset) if isinstance(dataset, str) else dataset
    return F.concat(F.lit(directory + "/"), name, F.lit(suffix))


def read_table(
    spark: SparkSession,
    path: str,
    infer_schema: bool = False,
    sep: str = "\t",
    multi_line: bool = True,
    partitions: int | None = None,
) -> DataFrame:
    """A delimited file with a header.

    All columns are text by default: inference costs a second pass and drops the
    zero of ``01234``.  A gzipped file, or one with line ends inside cells, is
    read by one task; ``partitions`` spreads its rows over that many before the
    work begins.  Leave ``multi_line`` off where cells hold no line ends, then a
    plain file is split.
    """
    table = (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("multiLine", multi_line)
        .option("inferSchema", infer_schema)
        .option("encoding", "UTF-8")
        .csv(path)
    )
    return table.repartition(partitions) if partitions else table


def table_headers(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Headers of several tables, from their schemas: ``dataset, pos, header``."""
    rows = [
        (dataset, pos, name)
        for dataset, table in tables.items()
        for pos, name in enumerate(table.columns)
    ]
    return spark.createDataFrame(rows, "dataset string, pos int, header string")
