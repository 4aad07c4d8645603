"""Data derived from the given tables, by one expression for both engines.

Every expression below is SQL that Spark and the checking engine read alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# M: messy cells from the order key
MESSY = """
    CASE o_orderkey % 20
        WHEN 0 THEN NULL
        WHEN 1 THEN ''
        WHEN 2 THEN '-'
        WHEN 3 THEN 'N/A'
        WHEN 4 THEN 'n/a'
        WHEN 5 THEN 'unspecified'
        WHEN 6 THEN '0'
        WHEN 7 THEN CAST(o_orderkey AS STRING)
        WHEN 8 THEN concat('-', CAST(o_orderkey AS STRING))
        WHEN 9 THEN ' 7 '
        WHEN 10 THEN concat(CAST(o_orderkey AS STRING), '.5')
        WHEN 11 THEN '1e5'
        WHEN 12 THEN concat(CAST(o_orderkey AS STRING), '.')
        WHEN 13 THEN concat('2019-1-', CAST(1 + o_orderkey % 28 AS STRING))
        WHEN 14 THEN '01/02/2019'
        WHEN 15 THEN '05-06-2019'
        WHEN 16 THEN '13-13-2019'
        WHEN 17 THEN '20190102'
        WHEN 18 THEN '1.5f'
        ELSE concat('text ', CAST(o_orderkey % 7 AS STRING))
    END
"""

# L: labelled cells from the customer key
LABELLED_CELLS = (
    "Brooklyn", "NEW YORK", "Fire Department", "FDNY", "Climate Office",
    "City College", "College", "Sedan", "K-5", "Joe Pizza", "Barbara", "Caroline",
    "engineering", "RED", "redd", "10001", "10001-1234", "01234", "A9-WALK-UP",
    "www.example.com", "http://example.com/a", "(40.7128, -74.0060)", "40.7128",
    "40.71", "0 elm", "180 east 5 street", "01/02/2019", "212-555-1234",
    "(212) 555-1234", "555-1234", "North Hill High School", "Academy of Arts",
    "North Academy of Arts", "Bryant Park", "West 45 Street",
    "120 West 45 Street", "120 Broadway Suite", "Manhatan", "K", "toyotaa",
    "chrysler", "mercur", "maths", "Flatbush", "flatbushh", "Smith", "John Smith",
    "500",
)
LABELLED = "CASE c_custkey % 48 {} END".format(
    " ".join(f"WHEN {i} THEN '{cell}'" for i, cell in enumerate(LABELLED_CELLS))
)
# the same with a few empties among them, for the corpus reports
REPORTED = f"CASE WHEN c_custkey % 11 = 3 THEN 'N/A' WHEN c_custkey % 13 = 5 THEN NULL ELSE {LABELLED} END"

DICTIONARY = {
    "city": ("brooklyn", "new york", "albany", "yonkers"),
    "city_agency": ("fire department", "fdny", "climate office"),
    "vehicle_type": ("sedan", "bus", "taxi"),
    "school_level": ("k-5", "high school", "college"),
    "area_of_study": ("engineering", "zoned"),
    "color": ("red", "blk"),
    "borough": ("manhattan", "queens", "bronx", "staten island", "k"),
    "car_make": ("toyota", "ford", "honda", "chrysler", "mercur"),
    "subject_in_school": ("english", "math", "science"),
    "neighborhood": ("flatbush", "harlem"),
    "person_name": ("james", "smith", "maria"),
}
COLLEGE = ("university", "college")
BUSINESS = ("pizza", "bar", "line", "pub")

# W: work list and labels.  Each customer is one listed column of one dataset;
# column and label forms follow from the key.
WORK_LINE = """
    concat('[''ds', CAST(c_custkey % 9 AS STRING), '.COL_', CAST(c_custkey AS STRING),
        '.txt.gz'', ''ds', CAST(c_nationkey AS STRING), '.', c_mktsegment, '.txt.gz'']')
"""
TRUTH_LABELS = """
    CASE c_custkey % 5
        WHEN 0 THEN 'city'
        WHEN 1 THEN 'phone_number,other'
        WHEN 2 THEN 'borough'
        WHEN 3 THEN 'neighborhood,borough'
        ELSE 'zip_code'
    END
"""
TRUTH_LINE = f"""
    concat(CAST(c_custkey AS STRING), ' ', {TRUTH_LABELS},
        CASE WHEN c_custkey % 3 = 0 THEN ' see note' ELSE '' END)
"""

# Labels of both entries of a line of the work list, which are numbered through.
ENTRY_LINE = f"""
    concat(CAST(2 * c_custkey + entry AS STRING), ' ', {TRUTH_LABELS},
        CASE WHEN c_custkey % 3 = 0 THEN ' see note' ELSE '' END)
"""

# The evaluated corpus: one dataset per nation, four columns each, and labels
# for a column from its dataset and number.
CORPUS_DATASET = "concat('ds', CAST(c_nationkey AS STRING))"
CORPUS_COLUMN = "concat('col', CAST(c_custkey % 4 AS STRING))"
CORPUS_LABELS = """
    CASE (c_nationkey + c_custkey % 4) % 4
        WHEN 0 THEN 'city'
        WHEN 1 THEN 'phone_number,other'
        WHEN 2 THEN 'borough,address,car_make'
        ELSE 'neighborhood,zip_code'
    END
"""

# Headers and the names a work list gives them, from parts and customers
WANTED_NAME = """
    CASE p_partkey % 6
        WHEN 0 THEN p_name
        WHEN 1 THEN replace(p_name, ' ', '_')
        WHEN 2 THEN concat(p_name, 'x')
        WHEN 3 THEN concat('A_', p_brand, '_CORE_SUBJECT')
        WHEN 4 THEN substring(p_name, 1, length(p_name) - 1)
        ELSE 'Missing'
    END
"""
HEADER = """
    CASE WHEN p_partkey % 50 = 7 THEN 'MY CORE SUBJECT' ELSE p_name END
"""


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def messy(spark: SparkSession, directory: str) -> DataFrame:
    return table(spark, directory, "orders").select(F.expr(MESSY).alias("cell"))


def labelled(spark: SparkSession, directory: str) -> DataFrame:
    return table(spark, directory, "customer").select(F.expr(LABELLED).alias("cell"))


def corpus_cells(spark: SparkSession, directory: str, cell: str = LABELLED) -> DataFrame:
    return table(spark, directory, "customer").select(
        F.expr(CORPUS_DATASET).alias("dataset"),
        F.expr(CORPUS_COLUMN).alias("column"),
        F.expr(cell).alias("value"),
    )


def dictionary(spark: SparkSession) -> DataFrame:
    rows = [(label, term) for label, terms in DICTIONARY.items() for term in terms]
    return spark.createDataFrame(rows, "label string, term string")


def sql_values(rows: list[tuple], alias: str) -> str:
    """Rows as a VALUES list."""
    def literal(v: object) -> str:
        return "NULL" if v is None else "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)

    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return f"(VALUES {body}) AS {alias}"
