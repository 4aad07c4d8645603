"""Running one analysis over many datasets, keeping the failures apart."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark.sql import DataFrame, SparkSession

QUARANTINE_SCHEMA = "idx bigint, dataset string, column string, error string"


def run_each(
    spark: SparkSession,
    items: Iterable[tuple],
    work: Callable[[dict[tuple, Any]], None],
    prepare: Callable[[tuple], Any] = lambda item: None,
    batch: int = 32,
    parallel: int = 4,
) -> DataFrame:
    """Do ``work`` for all items; return the ones that failed as a quarantine table.

    An item is ``(dataset,)`` or ``(dataset, column)``.  ``prepare`` opens one
    item, and one that cannot be opened is set aside at once.  ``work`` gets the
    opened items of a batch, plans them as one job and writes its result.  A
    batch that fails is halved until the bad item is alone, so one broken file
    stops nothing else and a good batch costs a single job.  ``parallel``
    batches run at the same time.  Only names pass through the driver.
    """
    numbered = list(enumerate(items))
    batches = [numbered[i : i + batch] for i in range(0, len(numbered), batch)]

    def one(numbers: list[tuple[int, tuple]]) -> list[tuple]:
        opened, failed = {}, []
        for idx, item in numbers:
            try:
                opened[(idx, item)] = prepare(item)
            except Exception as error:
                failed.append(_set_aside(idx, item, error))
        return failed + _attempt(work, opened)

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        failed = [row for rows in pool.map(one, batches) for row in rows]
    return spark.createDataFrame(failed, QUARANTINE_SCHEMA)


def _attempt(work: Callable, opened: dict) -> list[tuple]:
    if not opened:
        return []
    try:
        work({item: value for (_, item), value in opened.items()})
        return []
    except Exception as error:  # whatever an item fails with is the item's
        if len(opened) == 1:
            return [_set_aside(*next(iter(opened)), error)]
        pairs = list(opened.items())
        half = len(pairs) // 2
        return _attempt(work, dict(pairs[:half])) + _attempt(work, dict(pairs[half:]))


def _set_aside(idx: int, item: tuple, error: Exception) -> tuple:
    column = item[1] if len(item) > 1 else None
    return idx, item[0], column, f"{type(error).__name__}: {error}"
