"""Registered queries: one per operator, each over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import columnlens as cl
from columnlens import fixed_values as fixed
from columnlens.plans.semantic import CONTAINS, Rule, RuleSet

from . import fixtures as fx
from .fixtures import corpus_cells, dictionary, labelled, messy, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
#: Queries without SQL (DuckDB's edit distance is over bytes); tests check them by brute force.
WITHOUT_SQL: dict[str, Query] = {}


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def rounded(name: str, digits: int = 4) -> Column:
    return F.round(F.col(name), digits).alias(name)


def big(name: str) -> Column:
    return F.col(name).cast("bigint").alias(name)


# --- counts ------------------------------------------------------------------


@register
def value_counts(spark, sf):
    return cl.value_counts(table(spark, sf, "part"), ["p_name", "p_brand", "p_type", "p_size"])


@register
def distinct_counts(spark, sf):
    messy_counts = cl.value_counts(messy(spark, sf))
    customers = table(spark, sf, "customer")
    return cl.distinct_counts(messy_counts).unionByName(
        cl.distinct_counts(cl.value_counts(customers))
    )


@register
def empty_cells(spark, sf):
    counts = cl.value_counts(messy(spark, sf))
    plain = cl.empty_cells(counts, "profile").withColumn("rule", F.lit("normalized"))
    strict = cl.empty_cells(counts, "profile", normalize=False).withColumn("rule", F.lit("as is"))
    insight = cl.empty_cells(counts, "insight").withColumn("rule", F.lit("insight"))
    return plain.unionByName(strict).unionByName(insight)


@register
def frequent_values(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderstatus", "o_orderpriority", F.expr(fx.MESSY).alias("cell")
    )
    parts = table(spark, sf, "part").select("p_name", "p_brand", "p_type")
    top = cl.frequent_values(cl.value_counts(orders)).unionByName(
        cl.frequent_values(cl.value_counts(parts))
    )
    return top.withColumn("rank", big("rank"))


# --- cell types and statistics -----------------------------------------------


@register
def cell_type_counts(spark, sf):
    return cl.type_counts(cl.typed_counts(messy(spark, sf)))


def _numeric(spark, sf, kind, low, high):
    lines = table(spark, sf, "lineitem").select(
        "l_linenumber", "l_quantity", "l_extendedprice", "l_discount"
    )
    parts = table(spark, sf, "part").select("p_size", "p_retailprice")
    frames = [lines, parts, messy(spark, sf)]
    stats = None
    for frame in frames:
        counts = cl.typed_counts(frame, types=[kind])
        one = cl.numeric_stats(counts, column_bound=len(frame.columns))
        stats = one if stats is None else stats.unionByName(one)
    return stats.filter(F.col("value_type") == kind).select(
        "column", "cells", F.col(low).alias("min_value"), F.col(high).alias("max_value"),
        rounded("mean"), rounded("stddev"),
    )


@register
def integer_stats(spark, sf):
    return _numeric(spark, sf, fixed.INTEGER, "min_long", "max_long")


@register
def real_stats(spark, sf):
    return _numeric(spark, sf, fixed.REAL, "min_double", "max_double")


@register
def date_stats(spark, sf):
    written = table(spark, sf, "lineitem").select(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("ymd"),
        F.date_format("l_shipdate", "dd-MM-yyyy").alias("dmy"),
        F.date_format("l_shipdate", "yyyy/M/d").alias("ymd_slash"),
        F.date_format("l_shipdate", "M/d/yyyy").alias("mdy_slash"),
    )
    typed = table(spark, sf, "orders").select("o_orderdate", F.expr(fx.MESSY).alias("cell"))
    stats = cl.date_stats(cl.typed_counts(written)).unionByName(
        cl.date_stats(cl.typed_counts(typed))
    )
    return stats.select(
        "column", "cells",
        F.col("min_date").cast("string").alias("min_date"),
        F.col("max_date").cast("string").alias("max_date"),
    )


def _texts(spark, sf):
    parts = cl.typed_counts(table(spark, sf, "part"), ["p_name", "p_type"])
    documents = cl.typed_counts(table(spark, sf, "documents"), ["text", "source"])
    return parts.unionByName(documents).unionByName(cl.typed_counts(messy(spark, sf)))


def _extremes(spark, sf, longest):
    cells = cl.text_extremes(_texts(spark, sf), longest)
    return cells.select("column", F.posexplode("cells").alias("rank", "value")).withColumn(
        "rank", (F.col("rank") + 1).cast("bigint")
    )


@register
def text_shortest(spark, sf):
    return _extremes(spark, sf, False)


@register
def text_longest(spark, sf):
    return _extremes(spark, sf, True)


@register
def text_avg_length(spark, sf):
    return cl.text_lengths(_texts(spark, sf)).select(
        "column", "cells", rounded("average_length")
    )


# --- profile documents -------------------------------------------------------

PROFILED = ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "cell"]


def _profiled(spark, sf):
    return table(spark, sf, "customer").withColumn("cell", F.expr(fx.REPORTED)).select(*PROFILED)


def _profile_types(documents: DataFrame) -> DataFrame:
    columns = documents.select("dataset_name", F.explode("columns").alias("c"))
    types = columns.select("dataset_name", "c.*").withColumn("t", F.explode("data_types"))
    return types.select(
        "dataset_name", "column_name", "number_distinct_values", "number_empty_cells",
        "number_non_empty_cells", F.col("t.type").alias("type"), F.col("t.count").alias("cells"),
        F.col("t.min_long").alias("min_long"), F.col("t.max_long").alias("max_long"),
        F.round("t.min_double", 4).alias("min_double"), F.round("t.max_double", 4).alias("max_double"),
        F.round("t.mean", 4).alias("mean"), F.round("t.stddev", 4).alias("stddev"),
        F.round("t.average_length", 4).alias("average_length"),
        F.col("t.min_date").cast("string").alias("min_date"),
        F.col("t.max_date").cast("string").alias("max_date"),
    )


@register
def profile(spark, sf):
    return _profile_types(cl.profile(_profiled(spark, sf), "customer"))


@register
def profile_lists(spark, sf):
    documents = cl.profile(_profiled(spark, sf), "customer")
    c = documents.select(F.explode("columns").alias("c")).select("c.*")
    top = c.select(
        "column_name", F.lit("frequent").alias("list"),
        F.posexplode("frequent_values").alias("rank", "value"),
    )
    texts = c.select("column_name", F.explode("data_types").alias("t")).filter(
        F.col("t.type") == fixed.TEXT
    )
    lists = top
    for name in ("shortest", "longest"):
        lists = lists.unionByName(
            texts.select(
                "column_name", F.lit(name).alias("list"),
                F.posexplode(f"t.{name}_values").alias("rank", "value"),
            )
        )
    return lists.withColumn("rank", (F.col("rank") + 1).cast("bigint"))


@register
def profile_corpus(spark, sf):
    tables = {n: table(spark, sf, n) for n in ("nation", "supplier", "part")}
    tables["orders"] = table(spark, sf, "orders").select("o_orderdate", "o_orderpriority")
    return _profile_types(cl.profile_corpus(tables))


# --- keys --------------------------------------------------------------------


def _keys(found: DataFrame, name: str) -> DataFrame:
    return found.select(
        F.lit(name).alias("dataset"), F.array_join("key", ",").alias("key"),
        big("width"), "minimal",
    )


@register
def key_candidates(spark, sf):
    """All minimal keys of three tables, over all their columns."""
    found = [_keys(cl.key_candidates(table(spark, sf, n)), n) for n in ("lineitem", "orders", "nation")]
    return reduce(DataFrame.unionByName, found)


@register
def key_columns(spark, sf):
    """Minimal keys among named columns."""
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    lines = table(spark, sf, "lineitem")
    nation = table(spark, sf, "nation")
    return _keys(cl.key_candidates(lines, columns), "lineitem").unionByName(
        _keys(cl.key_candidates(nation), "nation")
    )


@register
def key_candidates_probed(spark, sf):
    """Sets looked at through slices of their hash before they are counted."""
    return _keys(cl.key_candidates(table(spark, sf, "orders"), probe_rows=100), "orders")


def _typed(spark, sf):
    """Columns whose values only their own type tells apart."""
    return table(spark, sf, "orders").select(
        (F.lit("12345678901234567890123456").cast("decimal(38,0)") + F.col("o_orderkey")).alias("wide"),
        F.expr("timestamp_micros(o_custkey * 1000 + o_orderkey % 7)").alias("instant"),
        F.when(F.col("o_orderkey") % 2 == 0, F.array(F.concat("o_orderstatus", F.lit(", "), "o_orderpriority")))
        .otherwise(F.array("o_orderstatus", "o_orderpriority")).alias("list"),
        F.struct(F.col("o_orderstatus").alias("a"), F.col("o_custkey").alias("b")).alias("pair"),
    )


@register
def typed_distinct(spark, sf):
    orders = cl.distinct_counts(cl.typed_counts(_typed(spark, sf)))
    vectors = cl.distinct_counts(cl.typed_counts(table(spark, sf, "embeddings")))
    return orders.unionByName(vectors)


@register
def typed_extremes(spark, sf):
    """Whole tables, and digits and microseconds that a double or a date would lose."""
    orders = table(spark, sf, "orders").withColumns({
        "wide": F.lit("12345678901234567890123456").cast("decimal(38,0)") + F.col("o_orderkey"),
        "part": (F.col("o_orderkey") / F.lit("1000000").cast("decimal(7,0)")).cast("decimal(38,6)"),
        "moment": F.expr("timestampadd(MICROSECOND, o_custkey, o_orderdate)"),
    })
    return cl.typed_extremes(orders).unionByName(cl.typed_extremes(table(spark, sf, "customer"))).select(
        "column", "min_value", "max_value")


@register
def typed_keys(spark, sf):
    vectors = table(spark, sf, "embeddings")
    return _keys(cl.key_candidates(_typed(spark, sf)), "orders").unionByName(
        _keys(cl.key_candidates(vectors), "embeddings")
    )


@register
def job_keys(spark, sf):
    """Key files of three datasets, written by the job and read back."""
    root, out = _scratch(spark, "key-tables"), _scratch(spark, "key-job")
    names = ("nation", "region", "supplier")
    for name in names:
        table(spark, sf, name).write.option("header", True).option("sep", "\t").option(
            "compression", "gzip"
        ).csv(f"{root}/{name}.tsv.gz")
    rows = [(f"{n}\tabout {n}",) for n in names]
    spark.createDataFrame(rows, "value string").coalesce(1).write.text(f"{root}/catalog")
    cl.find_keys(spark, f"{root}/catalog", f"{out}/found", directory=root)
    keys = spark.read.schema(
        "dataset string, key array<string>, width int, minimal boolean"
    ).option("recursiveFileLookup", True).json(f"{out}/found/keys")
    return keys.select(
        "dataset", F.array_join("key", ",").alias("key"), big("width"), "minimal"
    )


@register
def superkeys(spark, sf):
    """Every key of any width."""
    orders = table(spark, sf, "orders").withColumn("cell", F.expr(fx.MESSY))
    found = {"lineitem": table(spark, sf, "lineitem"), "orders": orders}
    return reduce(DataFrame.unionByName, [
        _keys(cl.key_candidates(df, all_superkeys=True), name) for name, df in found.items()])


# --- dictionaries and patterns -----------------------------------------------


def _lower_cells(spark, sf):
    return cl.count_cells(
        labelled(spark, sf).select(F.lit("cell").alias("column"), F.lower("cell").alias("value"))
    ).select("value", "cnt")


@register
def dict_exact(spark, sf):
    return cl.exact_match(_lower_cells(spark, sf), dictionary(spark))


def _tokens(frame: DataFrame) -> DataFrame:
    """All words of whole texts, of any letters and length."""
    words = F.explode(F.split(F.lower("text"), "[ \n]+")).alias("word")
    return frame.select(words).filter(F.col("word") != "").distinct()


def _exact_large(spark, sf, **limits):
    terms = _tokens(table(spark, sf, "conversations")).select(
        F.lit("word").alias("label"), F.col("word").alias("term")
    )
    return cl.exact_match(_tokens(table(spark, sf, "documents")), terms, on="word", **limits)


@register
def dict_exact_large(spark, sf):
    return _exact_large(spark, sf)


@register
def dict_exact_shuffled(spark, sf):
    return _exact_large(spark, sf, broadcast_rows=0)


@register
def dict_terms(spark, sf):
    lines = table(spark, sf, "part").select(
        F.concat_ws("\t", F.upper("p_name"), "p_brand", "p_type").alias("value")
    )
    names = cl.parse_terms(lines, "name", field=0, sep="\t")
    whole = cl.parse_terms(
        table(spark, sf, "supplier").select(F.concat("s_name", F.lit(" \r")).alias("value")), "supplier"
    )
    return names.unionByName(whole)


@register
def dict_abbrev(spark, sf):
    lines = table(spark, sf, "supplier").select(
        F.when(F.col("s_suppkey") % 3 == 0, F.col("s_name"))
        .otherwise(F.concat("s_name", F.lit(" (S"), F.col("s_suppkey").cast("string"), F.lit(")")))
        .alias("value")
    )
    both = cl.parse_abbrev_terms(lines, "agency")
    bracketed = cl.parse_abbrev_terms(lines, "bracketed", keep_plain=False)
    return both.unionByName(bracketed)


@register
def dict_contains(spark, sf):
    terms = spark.createDataFrame(
        [("college_name", t) for t in fx.COLLEGE] + [("business_name", t) for t in fx.BUSINESS],
        "label string, term string",
    )
    texts = table(spark, sf, "documents").select("doc_id", F.lower("text").alias("value"))
    return cl.contains_match(texts, terms).drop("value")


def _contains_large(spark, sf, **limits):
    """Every pair of neighbouring words of the benchmark, in whole documents."""
    words = F.filter(F.split("text", "[ \n]+"), lambda w: w != "")
    pairs = F.zip_with(words, F.slice(words, 2, F.size(words)), lambda a, b: F.concat(a, F.lit(" "), b))
    terms = table(spark, sf, "benchmark").select(
        F.lit("pair").alias("label"), F.explode(pairs).alias("term")
    )
    texts = table(spark, sf, "documents").select("doc_id", F.col("text").alias("value"))
    return cl.contains_match(texts, terms, **limits).drop("value")


@register
def dict_contains_large(spark, sf):
    return _contains_large(spark, sf)


@register
def dict_contains_shuffled(spark, sf):
    return _contains_large(spark, sf, scan_terms=0, broadcast_rows=0)


@register
def dict_fuzzy(spark, sf):
    return cl.fuzzy_match(_lower_cells(spark, sf), dictionary(spark))


def _fuzzy_tokens(spark, sf):
    terms = _tokens(table(spark, sf, "conversations")).select(
        F.lit("word").alias("label"), F.col("word").alias("term")
    )
    return cl.fuzzy_match(_tokens(table(spark, sf, "benchmark")), terms, on="word")


@register
def dict_fuzzy_large(spark, sf):
    """All words of both sides, short ones and of any letters."""
    return _fuzzy_tokens(spark, sf)


def dict_fuzzy_tokens(spark, sf):
    """The same under the name its brute-force test has."""
    return _fuzzy_tokens(spark, sf)


WITHOUT_SQL["dict_fuzzy_tokens"] = dict_fuzzy_tokens


@register
def similarity(spark, sf):
    parts = table(spark, sf, "part")
    return parts.select("p_partkey", F.round(cl.similarity("p_name", "p_type"), 6).alias("sim"))


@register
def pattern_match(spark, sf):
    pages = table(spark, sf, "pages")
    site = cl.pattern_match(F.lower("url"), fixed.WEBSITE)
    host = F.split_part(F.split_part("url", F.lit("//"), F.lit(2)), F.lit("/"), F.lit(1))
    return pages.select(
        "page_id", site.alias("is_site"), cl.pattern_match(host, fixed.WEBSITE).alias("host_is_site")
    )


# --- semantic types ----------------------------------------------------------


def _rules() -> RuleSet:
    """The standard rules with the fixture's short contains-lists and terms."""
    short = {"college_name": fx.COLLEGE, "business_name": fx.BUSINESS}
    rules = tuple(
        Rule(r.label, r.kind, short[r.label]) if r.kind == CONTAINS else r
        for r in cl.default_rules().rules
    )
    return RuleSet(rules)


def _semantic_cells(spark, sf):
    cells = corpus_cells(spark, sf)
    for name, column in (
        ("pages", "url"), ("part", "p_name"), ("part", "p_brand"), ("nation", "n_name"),
        ("orders", "o_orderpriority"), ("customer", "c_name"), ("events", "event_type"),
    ):
        cells = cells.unionByName(
            table(spark, sf, name).select(
                F.lit(name).alias("dataset"), F.lit(column).alias("column"),
                F.col(column).alias("value"),
            )
        )
    messy_cells = messy(spark, sf).select(
        F.lit("orders").alias("dataset"), F.lit("cell").alias("column"), F.col("cell").alias("value")
    )
    return cells.unionByName(messy_cells)


def _semantic(spark, sf, **limits):
    return cl.semantic_types(
        cl.count_cells(_semantic_cells(spark, sf)), _rules(), dictionary(spark), **limits
    )


def _corpus_semantic(spark, sf):
    return cl.semantic_types(cl.count_cells(corpus_cells(spark, sf)), _rules(), dictionary(spark))


@register
def semantic_types(spark, sf):
    return _semantic(spark, sf).withColumn("rank", big("rank"))


@register
def semantic_types_shuffled(spark, sf):
    """Both lookups by shuffle: on the term, and on pieces of it."""
    found = _semantic(spark, sf, broadcast_rows=0, scan_terms=0)
    return found.withColumn("rank", big("rank"))


@register
def semantic_values(spark, sf):
    counts = cl.count_cells(corpus_cells(spark, sf).drop("dataset"))
    return cl.classify(counts, _rules(), dictionary(spark)).select("column", "value", "label", "cnt")


@register
def semantic_default_rules(spark, sf):
    """The standard rules with all their own terms, on all cells and on spoken words."""
    words = _tokens(table(spark, sf, "conversations")).select(
        F.lit("conversations").alias("dataset"), F.lit("word").alias("column"),
        F.col("word").alias("value"),
    )
    cells = _semantic_cells(spark, sf).unionByName(words)
    return cl.semantic_types(cl.count_cells(cells)).withColumn("rank", big("rank"))


@register
def semantic_profile(spark, sf):
    documents = cl.semantic_profile(_corpus_semantic(spark, sf), _labelled_columns(spark, sf))
    return documents.select(
        "dataset_name", "column_name", F.array_join("actual_types", ",").alias("actual_types"),
        F.posexplode("semantic_types").alias("pos", "t"),
    ).select(
        "dataset_name", "column_name", "actual_types", (F.col("pos") + 1).cast("bigint").alias("pos"),
        F.col("t.semantic_type").alias("semantic_type"), F.col("t.count").alias("cells"),
        F.array_join("t.label", ",").alias("label"),
    )


# --- work list and labels ----------------------------------------------------


def _work_lines(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", F.expr(fx.WORK_LINE).alias("value"))


def _truth(spark, sf):
    return cl.parse_truth(table(spark, sf, "customer").select(F.expr(fx.TRUTH_LINE).alias("value")))


def _entries(spark, sf):
    """Both entries of every line of the work list, numbered through."""
    entries = cl.parse_worklist(_work_lines(spark, sf), ["c_custkey"])
    return entries.select((2 * F.col("c_custkey") + F.col("idx")).cast("int").alias("idx"), "dataset", "column")


def _entry_labels(spark, sf):
    """A line of labels for every entry."""
    lines = table(spark, sf, "customer").withColumn("entry", F.explode(F.array(F.lit(0), F.lit(1))))
    return cl.parse_truth(lines.select(F.expr(fx.ENTRY_LINE).alias("value")))


@register
def worklist(spark, sf):
    return cl.parse_worklist(_work_lines(spark, sf), ["c_custkey"]).withColumn("idx", big("idx"))


@register
def truth_labels(spark, sf):
    return cl.label_counts(_truth(spark, sf))


@register
def manual_labels(spark, sf):
    """The label file, written and read back: the vocabulary, then every entry."""
    path = _scratch(spark, "labels")
    cl.write_labels(cl.label_lines(_entries(spark, sf), _entry_labels(spark, sf)), path)
    back = spark.read.schema(
        "actual_types array<string>, dataset_name string, column_name string, "
        "manual_labels array<struct<semantic_type: string>>"
    ).json(path)
    types = F.coalesce("actual_types", "manual_labels.semantic_type")
    return back.select("dataset_name", "column_name", F.explode(types).alias("semantic_type"))


@register
def unmatched_labels(spark, sf):
    some = _entries(spark, sf).filter(F.col("dataset") != "ds4")
    return cl.unmatched_labels(some, _entry_labels(spark, sf)).select(
        big("idx"), F.array_join("labels", ",").alias("labels")
    )


def _resolved(spark, sf):
    parts = table(spark, sf, "part")
    dataset = F.concat(F.lit("ds"), (F.col("p_partkey") % 5).cast("string")).alias("dataset")
    wanted = parts.select(
        F.col("p_partkey").alias("idx"), dataset, F.expr(fx.WANTED_NAME).alias("column")
    )
    headers = parts.select(
        dataset, F.col("p_partkey").alias("pos"), F.expr(fx.HEADER).alias("header")
    )
    return cl.resolve_columns(wanted, headers, {"CORE_SUBJECT": "CORE SUBJECT"})


@register
def resolve_columns(spark, sf):
    return _resolved(spark, sf).withColumn("tier", big("tier"))


@register
def unresolved_columns(spark, sf):
    return cl.unresolved(_resolved(spark, sf))


# --- evaluation --------------------------------------------------------------


def _labelled_columns(spark, sf):
    """Listed columns with labels; each is listed once per customer and counts once."""
    customers = table(spark, sf, "customer")
    worklist = customers.select(
        F.col("c_custkey").alias("idx"), F.expr(fx.CORPUS_DATASET).alias("dataset"),
        F.expr(fx.CORPUS_COLUMN).alias("column"),
    )
    truth = customers.select(
        F.col("c_custkey").alias("idx"), F.split(F.expr(fx.CORPUS_LABELS), ",").alias("labels")
    )
    return cl.distinct_worklist(worklist, truth)


def _predicted(spark, sf, k="truth"):
    return cl.predicted_types(_corpus_semantic(spark, sf), _labelled_columns(spark, sf), k)


@register
def predicted_types(spark, sf):
    first = _predicted(spark, sf, 1).withColumn("k", F.lit("one"))
    return (
        _predicted(spark, sf).withColumn("k", F.lit("truth")).unionByName(first)
        .withColumn("rank", big("rank"))
    )


@register
def predicted_counts(spark, sf):
    predicted = _predicted(spark, sf)
    return cl.predicted_counts(predicted).join(cl.correct_counts(predicted), "label", "left")


@register
def precision_recall(spark, sf):
    return cl.precision_recall(_predicted(spark, sf), _labelled_columns(spark, sf)).select(
        "label", "actual", "predicted", "correct", rounded("precision", 6), rounded("recall", 6)
    )


@register
def column_precision(spark, sf):
    return cl.column_precision(_corpus_semantic(spark, sf), _labelled_columns(spark, sf)).select(
        "idx", "dataset", "column", rounded("precision", 6)
    )


# --- corpus reports ----------------------------------------------------------


def _tally(spark, sf):
    counts = cl.count_cells(corpus_cells(spark, sf, fx.REPORTED))
    top = cl.frequent_values(counts)
    return cl.value_tally(top.withColumn("value", F.coalesce("value", F.lit(fixed.NULL_TEXT))))


def _names(spark, names):
    return spark.createDataFrame([(n,) for n in names], "term string")


@register
def value_tally(spark, sf):
    return _tally(spark, sf)


@register
def top_values(spark, sf):
    return cl.top_values(cl.without_numbers(_tally(spark, sf)), 20)


@register
def empty_labels(spark, sf):
    return cl.empty_labels(cl.without_numbers(_tally(spark, sf)))


@register
def filled_values(spark, sf):
    return cl.filled_values(cl.without_numbers(_tally(spark, sf)))


@register
def borough_mentions(spark, sf):
    return cl.term_mentions(_tally(spark, sf), _names(spark, fixed.BOROUGH_NAMES))


@register
def school_levels(spark, sf):
    return cl.term_mentions(_tally(spark, sf), _names(spark, fixed.SCHOOL_LEVEL_TERMS))


@register
def top_streets(spark, sf):
    return cl.pattern_mentions(_tally(spark, sf))


# --- files -------------------------------------------------------------------


def _scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the shared folder the cluster names."""
    root = spark.conf.get("spark.checkpoint.dir")
    return f"{root}/columnlens-{name}-{uuid.uuid4().hex}"


def _noted_orders(spark, sf):
    """Orders with line ends in the cells of a column."""
    return table(spark, sf, "orders").select(
        F.lpad(F.col("o_orderkey").cast("string"), 9, "0").alias("o_orderkey"),
        F.col("o_orderstatus").alias("order.status"),
        F.when(F.col("o_orderkey") % 4 != 0, F.concat(F.lit("two\nlines "), "o_orderpriority")).alias("note"),
    )


@register
def read_table(spark, sf):
    path = _scratch(spark, "table")
    rows = _noted_orders(spark, sf)
    rows.write.option("header", True).option("sep", "\t").option("compression", "gzip").csv(path)
    return cl.value_counts(cl.read_table(spark, path))


@register
def read_split_table(spark, sf):
    """The same from plain files, which several tasks read."""
    path = _scratch(spark, "table")
    _noted_orders(spark, sf).write.option("header", True).option("sep", "\t").csv(path)
    return cl.value_counts(cl.read_split_table(spark, path))


@register
def catalog(spark, sf):
    path = _scratch(spark, "catalog")
    table(spark, sf, "part").select(
        F.concat_ws("\t", F.concat(F.lit("p"), F.col("p_partkey").cast("string")), "p_name").alias("value")
    ).write.text(path)
    return cl.read_catalog(spark, path, "/data")


def _read_profiles(spark, sf):
    """Profile documents of three tables, written and read back: a row per column."""
    path = _scratch(spark, "profiles")
    tables = {n: table(spark, sf, n) for n in ("customer", "supplier", "orders")}
    cl.write_profiles(cl.profile_corpus(tables), path)
    columns = cl.read_profiles(spark, path).select("dataset_name", F.explode("columns").alias("c"))
    return columns.select("dataset_name", "c.*")


def _document_types(columns: DataFrame) -> DataFrame:
    """Every number and date of documents that were read."""
    types = columns.withColumn("t", F.explode("data_types"))

    def bound(name: str, kind: str, cast: str) -> Column:
        return F.when(F.col("t.type") == kind, F.col(f"t.{name}_value").try_cast(cast))

    return types.select(
        "dataset_name", "column_name", "number_distinct_values", "number_empty_cells",
        "number_non_empty_cells", F.col("t.type").alias("type"), F.col("t.count").alias("cells"),
        bound("min", fixed.INTEGER, "bigint").alias("min_long"),
        bound("max", fixed.INTEGER, "bigint").alias("max_long"),
        F.round(bound("min", fixed.REAL, "double"), 4).alias("min_double"),
        F.round(bound("max", fixed.REAL, "double"), 4).alias("max_double"),
        F.round("t.mean", 4).alias("mean"), F.round("t.stddev", 4).alias("stddev"),
        F.round("t.average_length", 4).alias("average_length"),
        bound("min", fixed.DATE, "string").alias("min_date"),
        bound("max", fixed.DATE, "string").alias("max_date"),
    )


@register
def profile_documents(spark, sf):
    return _document_types(_read_profiles(spark, sf))


JOB_TABLES = ("nation", "supplier", "customer")


def _profile_job(spark, sf) -> str:
    """The profile job from compressed text files and a catalog of them; its folder."""
    root, out = _scratch(spark, "tables"), _scratch(spark, "profile-job")
    for name in JOB_TABLES:
        table(spark, sf, name).write.option("header", True).option("sep", "\t").option(
            "compression", "gzip"
        ).csv(f"{root}/{name}.tsv.gz")
    spark.createDataFrame([(f"{n}\t{n}s",) for n in JOB_TABLES], "value string").write.text(f"{root}/catalog")
    cl.profile_datasets(spark, f"{root}/catalog", out, directory=root)
    return out


@register
def job_profile(spark, sf):
    """Documents of whole files, written by the job and read back."""
    documents = cl.read_profiles(spark, f"{_profile_job(spark, sf)}/profiles")
    return _document_types(documents.select("dataset_name", F.explode("columns").alias("c")).select("dataset_name", "c.*"))


@register
def job_report(spark, sf):
    """Every part of the report on the profile job's documents."""
    out = _scratch(spark, "report")
    cl.report(spark, f"{_profile_job(spark, sf)}/profiles", out)
    parts = ("top_values", "top_words", "top_cells", "empty_labels", "boroughs", "school_levels", "streets")
    return reduce(DataFrame.unionByName, [
        spark.read.schema("value string, n bigint").json(f"{out}/{part}").withColumn("part", F.lit(part)) for part in parts])


@register
def list_files(spark, sf):
    """Labels and dictionaries read from text files."""
    truth, terms, abbrev = (_scratch(spark, n) for n in ("truth", "terms", "abbrev"))
    table(spark, sf, "customer").select(F.expr(fx.TRUTH_LINE)).write.text(truth)
    table(spark, sf, "part").select(F.concat_ws("\t", F.upper("p_name"), "p_brand")).write.text(terms)
    table(spark, sf, "supplier").select(
        F.concat("s_name", F.lit(" (S"), F.col("s_suppkey").cast("string"), F.lit(")"))).write.text(abbrev)
    labels = cl.read_truth(spark, truth).select(
        F.explode("labels").alias("label"), F.col("idx").cast("string").alias("term"))
    names = cl.read_terms(spark, terms, "name", field=0, sep="\t").unionByName(
        cl.read_terms_with_abbrev(spark, abbrev, "agency"))
    return labels.withColumn("list", F.lit("truth")).unionByName(names.withColumn("list", F.lit("terms")))


@register
def profile_document_lists(spark, sf):
    """Every list of the documents: most frequent, shortest and longest values."""
    columns = _read_profiles(spark, sf)
    name = F.concat_ws(".", "dataset_name", "column_name").alias("column_name")
    texts = columns.select(name, F.explode("data_types").alias("t"))
    lists = [columns.select(name, F.lit("frequent").alias("list"), F.posexplode("frequent_values").alias("rank", "value"))] + [
        texts.select("column_name", F.lit(n).alias("list"), F.posexplode(f"t.{n}_values").alias("rank", "value"))
        for n in ("shortest", "longest")]
    return reduce(DataFrame.unionByName, lists).withColumn("rank", (F.col("rank") + 1).cast("bigint"))


@register
def combine_json(spark, sf):
    source, target = _scratch(spark, "parts"), _scratch(spark, "combined")
    cl.write_semantic(
        cl.semantic_profile(_corpus_semantic(spark, sf), _labelled_columns(spark, sf)), source
    )
    cl.combine_json(spark, source, target, whole_files=False)
    back = spark.read.schema(
        "dataset_name string, column_name string, actual_types array<string>, "
        "semantic_types array<struct<semantic_type: string, count: bigint, label: array<string>>>"
    ).json(target)
    return back.select(
        "dataset_name", "column_name", F.array_join("actual_types", ",").alias("actual_types"),
        F.explode("semantic_types").alias("t"),
    ).select(
        "dataset_name", "column_name", "actual_types", "t.semantic_type", F.col("t.count").alias("cells"),
        F.array_join("t.label", ",").alias("label"),
    )


@register
def metrics_file(spark, sf):
    path = _scratch(spark, "metrics")
    cl.write_metrics(
        cl.precision_recall(_predicted(spark, sf), _labelled_columns(spark, sf)), path
    )
    back = spark.read.schema(
        "label string, actual bigint, predicted bigint, correct bigint, precision double, recall double"
    ).json(path)
    return back.withColumns({c: F.round(c, 6) for c in ("precision", "recall")})


@register
def quarantine(spark, sf):
    """Value counts of one file per order status; a dataset without a file is set aside."""
    root, out = _scratch(spark, "corpus"), _scratch(spark, "counts")
    orders = table(spark, sf, "orders")
    orders.select("o_orderstatus", "o_orderpriority").withColumn(
        "dataset", F.lower("o_orderstatus")
    ).write.partitionBy("dataset").option("header", True).option("sep", "\t").csv(root)
    items = [("f",), ("missing",), ("o",), ("p",)]

    def work(opened):
        tables = {dataset: one for (dataset,), one in opened.items()}
        cl.corpus_counts(tables).select("dataset", "column", "value", "cnt").write.mode(
            "append"
        ).json(out)

    failed = cl.run_each(
        spark, items, work, lambda item: cl.read_table(spark, f"{root}/dataset={item[0]}")
    )
    good = spark.read.schema("dataset string, column string, value string, cnt bigint").json(out)
    return good.unionByName(
        failed.select("dataset", "column", F.lit("set aside").alias("value"), F.lit(None).cast("bigint").alias("cnt"))
    )
