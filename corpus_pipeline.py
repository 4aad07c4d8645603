"""From raw documents to token ids: five stages, each written before the next reads it.

Toxicity and language ID reject documents, near duplicates leave one document of each
group, decontamination rejects what holds benchmark passages, and SentencePiece makes
ids of what is left. A stage sees all that the one before kept, and whole texts.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from columnlens.llm import decontaminate, forest, language, pieces, toxicity
from columnlens.llm.queries import table, tokenizer_path
from columnlens.llm.storage import saved


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_OWN = ("doc_id", "text", "lang", "source")


def keeping_columns(stage: Stage) -> Stage:
    """A filter whose rows come out with the columns they had. Columns that the operators
    don't read are out of the way meanwhile, whatever their names."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = docs.columns
        plain = docs.toDF(*[n if n in _OWN else f"_other_{i}" for i, n in enumerate(names)])
        return stage(spark, plain, sf_dir).select(*plain.columns).toDF(*names)

    return run


@keeping_columns
def clean_of_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labelled ones, does not call toxic."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model).where("predicted = 0")


@keeping_columns
def of_a_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages; those without any letter go."""
    model = language.fit(docs)
    found = language.identified(docs, model)
    return found.where(F.col("lang_pred") != language.UNKNOWN)


@keeping_columns
def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at 0.8 or more, the smallest id."""
    return forest.one_of_each_group(docs)


@keeping_columns
def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words less than a twentieth lie in benchmark windows."""
    judged = decontaminate.marked(docs, table(spark, sf_dir, "benchmark"))
    return judged.where(~F.col("contaminated"))


def as_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every remaining document."""
    rows = pieces.encoded(docs, tokenizer_path("piece_bpe_32k.model"))
    return rows.select(
        "doc_id", "lang", "source", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", clean_of_toxicity),
    ("language", of_a_language),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("sentencepiece", as_pieces),
]

#: classifiers and pieces have no SQL; tests compare the stages with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
