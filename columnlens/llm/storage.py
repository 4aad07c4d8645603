"""Shared scratch folders, and row ranges that hold their order over tasks."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Where the cluster names none (tests on one machine), a folder below the warehouse is
    taken. Checkpoints of the session go there as well, if it has no other place for them.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def saved(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read again: its lineage ends there."""
    path = new_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def range_bounds(df: DataFrame, key: str, count: int) -> list[int]:
    """Up to ``count - 1`` values of an integer column that cut it into ranges of like size.

    One pass over that column; the driver gets only the bounds.
    """
    if count < 2:
        return []
    shares = [i / count for i in range(1, count)]
    found = df.agg(F.percentile_approx(key, shares, 20 * count).alias("at")).first()
    return sorted(set(found["at"] or []))


def range_of(key: str, bounds: list[int]) -> Column:
    """Number of bounds at or below the key; 0 for null. A pure function of the key.

    Every k-th bound is looked at first, then the k after the last that is not above.
    """
    if not bounds:
        return F.lit(0)
    k = math.isqrt(len(bounds)) + 1
    below = lambda b: b <= F.col(key)
    cuts = F.array(*[F.lit(b).cast("long") for b in bounds])
    coarse = F.array(*[F.lit(b).cast("long") for b in bounds[k - 1 :: k]])
    first = F.size(F.filter(coarse, below)) * k
    at = first + F.size(F.filter(F.slice(cuts, first + 1, F.lit(k)), below))
    return F.coalesce(F.when(F.col(key).isNotNull(), at), F.lit(0)).cast("int")


#: Rows of a few numbers that are sent to every executor at most: about 64 MB.
SENT_ROWS = 1_000_000


def sent_if_small(df: DataFrame, rows: int = SENT_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it was counted and has up to ``rows`` rows of ids; beyond
    that as it is, for a join by shuffle. ``df`` should be saved, as it is read twice."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


#: Rows of an Arrow batch of whole texts. A text can be long; work goes by lots of texts anyway.
BATCH_ROWS = 256


def text_batches(df: DataFrame) -> DataFrame:
    """``df``, with its session's Arrow batches kept to ``BATCH_ROWS`` rows."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))
    return df
