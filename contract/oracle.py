"""The registered queries in SQL, written for DuckDB over the same tables."""

from __future__ import annotations

from itertools import combinations

from columnlens import fixed_values as fixed

from . import fixtures as fx

ORACLE_SQL: dict[str, str] = {}


def in_list(words) -> str:
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"


def long_cells(table: str, columns) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value FROM {table}" for c in columns
    )


MESSY = f"SELECT 'cell' AS \"column\", {fx.MESSY} AS value FROM orders"
COUNTED = 'SELECT "column", value, count(*) AS cnt FROM ({}) GROUP BY ALL'

# --- counts ------------------------------------------------------------------

ORACLE_SQL["value_counts"] = COUNTED.format(
    long_cells("part", ["p_name", "p_brand", "p_type", "p_size"])
)

ORACLE_SQL["distinct_counts"] = f"""
    SELECT "column", count(*) AS distinct_values FROM ({COUNTED.format(
        MESSY + " UNION ALL "
        + long_cells("customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]))})
    GROUP BY "column"
"""


def _empties(name: str, test: str) -> str:
    return f"""
        SELECT 'cell' AS "column", '{name}' AS rule,
            count(*) FILTER (value IS NULL OR {test}) AS empty_cells,
            count(*) FILTER (value IS NOT NULL AND NOT ({test})) AS non_empty_cells
        FROM ({MESSY})
    """


ORACLE_SQL["empty_cells"] = " UNION ALL ".join(
    [
        _empties("normalized", f"lower(trim(value)) IN {in_list(fixed.EMPTY_PROFILE)}"),
        _empties("as is", f"value IN {in_list(fixed.EMPTY_PROFILE)}"),
        _empties("insight", f"lower(trim(value)) IN {in_list(fixed.EMPTY_INSIGHT)}"),
    ]
)


def top_of(counted: str, k: int = 5) -> str:
    return f"""
        SELECT * FROM (
            SELECT "column", value, cnt, row_number() OVER (
                PARTITION BY "column" ORDER BY cnt DESC, value ASC NULLS FIRST) AS rank
            FROM ({counted}))
        WHERE rank <= {k}
    """


ORACLE_SQL["frequent_values"] = top_of(
    COUNTED.format(
        long_cells("orders", ["o_orderstatus", "o_orderpriority"]) + " UNION ALL " + MESSY
        + " UNION ALL " + long_cells("part", ["p_name", "p_brand", "p_type"])
    )
)

# --- cell types and statistics -----------------------------------------------

IS_LONG = r"regexp_matches(value, '^\s*[-+]?[0-9]+\s*$') AND try_cast(trim(value) AS BIGINT) IS NOT NULL"
IS_DOUBLE = r"regexp_matches(value, '^\s*[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?\s*$')"
AS_DATE = r"""
    CASE
        WHEN regexp_full_match(value, '[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}') THEN try_strptime(value, '%Y-%m-%d')
        WHEN regexp_full_match(value, '[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}') THEN try_strptime(value, '%d-%m-%Y')
        WHEN regexp_full_match(value, '[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}') THEN try_strptime(value, '%Y/%m/%d')
        WHEN regexp_full_match(value, '[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}') THEN try_strptime(value, '%m/%d/%Y')
    END
"""
TYPE_OF = f"""
    CASE WHEN value IS NULL THEN NULL WHEN {IS_LONG} THEN 'INTEGER (LONG)'
        WHEN {IS_DOUBLE} THEN 'REAL' WHEN {AS_DATE} IS NOT NULL THEN 'DATE/TIME' ELSE 'TEXT' END
"""


def typed(cells: str) -> str:
    return f'SELECT "column", value, {TYPE_OF} AS value_type FROM ({cells})'



ORACLE_SQL["cell_type_counts"] = f"""
    SELECT "column", value_type, count(*) AS cells FROM ({typed(MESSY)})
    WHERE value_type IS NOT NULL GROUP BY ALL
"""


def _numbers(columns: list[tuple[str, str]], kind: str, cast: str) -> str:
    cells = [f"SELECT '{c}' AS \"column\", CAST({c} AS {cast}) AS n FROM {t}" for t, c in columns]
    cells.append(
        f"SELECT \"column\", CAST(trim(value) AS {cast}) AS n FROM ({typed(MESSY)}) "
        f"WHERE value_type = '{kind}'"
    )
    return f"""
        SELECT "column", count(*) AS cells, min(n) AS min_value, max(n) AS max_value,
            round(avg(n), 4) AS mean, round(stddev_pop(n), 4) AS stddev
        FROM ({" UNION ALL ".join(cells)}) GROUP BY "column"
    """


ORACLE_SQL["integer_stats"] = _numbers(
    [("lineitem", "l_linenumber"), ("part", "p_size")], "INTEGER (LONG)", "BIGINT"
)
ORACLE_SQL["real_stats"] = _numbers(
    [
        ("lineitem", "l_quantity"), ("lineitem", "l_extendedprice"), ("lineitem", "l_discount"),
        ("part", "p_retailprice"),
    ],
    "REAL",
    "DOUBLE",
)

_SHIPPED = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", l_shipdate AS d FROM lineitem"
    for c in ("ymd", "dmy", "ymd_slash", "mdy_slash")
)
ORACLE_SQL["date_stats"] = f"""
    SELECT "column", count(*) AS cells, strftime(min(d), '%Y-%m-%d') AS min_date,
        strftime(max(d), '%Y-%m-%d') AS max_date
    FROM ({_SHIPPED} UNION ALL SELECT 'o_orderdate', o_orderdate FROM orders
        UNION ALL SELECT "column", {AS_DATE} FROM ({typed(MESSY)}) WHERE value_type = 'DATE/TIME')
    GROUP BY "column"
"""

TEXT_CELLS = f"""
    SELECT "column", value FROM ({typed(
        long_cells("part", ["p_name", "p_type"]) + " UNION ALL "
        + long_cells("documents", ["text", "source"]) + " UNION ALL " + MESSY)})
    WHERE value_type = 'TEXT'
"""


def _extremes(cells: str, direction: str, column: str = '"column"') -> str:
    return f"""
        SELECT * FROM (
            SELECT {column}, value, row_number() OVER (
                PARTITION BY {column} ORDER BY length(value) {direction}, value) AS rank
            FROM ({cells}))
        WHERE rank <= 5
    """


ORACLE_SQL["text_shortest"] = _extremes(TEXT_CELLS, "ASC")
ORACLE_SQL["text_longest"] = _extremes(TEXT_CELLS, "DESC")
ORACLE_SQL["text_avg_length"] = f"""
    SELECT "column", count(*) AS cells, round(avg(length(value)), 4) AS average_length
    FROM ({TEXT_CELLS}) GROUP BY "column"
"""

# --- profile documents -------------------------------------------------------


def _typed_column(dataset: str, source: str, column: str, kind: str) -> str:
    """Cells of one column: type by its physical type, or by what is written."""
    typed = {"long": "'INTEGER (LONG)'", "double": "'REAL'", "date": "'DATE/TIME'", "text": TYPE_OF}[kind]
    return f"""
        SELECT '{dataset}' AS dataset_name, '{column}' AS column_name, value,
            CASE WHEN value IS NULL THEN NULL ELSE {typed} END AS type
        FROM (SELECT CAST({column} AS VARCHAR) AS value FROM {source})
    """


def _profile(columns: list[tuple[str, str, str, str]]) -> str:
    cells = " UNION ALL ".join(_typed_column(*c) for c in columns)
    empty = f"(value IS NULL OR lower(trim(value)) IN {in_list(fixed.EMPTY_PROFILE)})"
    return f"""
        WITH cells AS ({cells}),
        totals AS (
            SELECT dataset_name, column_name,
                count(DISTINCT value) + CAST(bool_or(value IS NULL) AS BIGINT) AS number_distinct_values,
                count(*) FILTER ({empty}) AS number_empty_cells,
                count(*) FILTER (NOT {empty}) AS number_non_empty_cells
            FROM cells GROUP BY ALL),
        types AS (
            SELECT dataset_name, column_name, type, count(*) AS cells,
                min(l) AS min_long, max(l) AS max_long,
                round(min(d), 4) AS min_double, round(max(d), 4) AS max_double,
                round(avg(coalesce(l, d)), 4) AS mean, round(stddev_pop(coalesce(l, d)), 4) AS stddev,
                round(avg(length(t)), 4) AS average_length,
                strftime(min(day), '%Y-%m-%d') AS min_date, strftime(max(day), '%Y-%m-%d') AS max_date
            FROM (SELECT *,
                    CASE WHEN type = 'INTEGER (LONG)' THEN try_cast(trim(value) AS BIGINT) END AS l,
                    CASE WHEN type = 'REAL' THEN try_cast(trim(value) AS DOUBLE) END AS d,
                    CASE WHEN type = 'TEXT' THEN value END AS t,
                    CASE WHEN type = 'DATE/TIME' THEN coalesce({AS_DATE}, try_cast(value AS TIMESTAMP)) END AS day
                FROM cells WHERE type IS NOT NULL)
            GROUP BY ALL)
        SELECT * FROM totals JOIN types USING (dataset_name, column_name)
    """


_CUSTOMER = f"(SELECT *, {fx.REPORTED} AS cell FROM customer)"
_CUSTOMER_COLUMNS = [
    ("customer", _CUSTOMER, "c_name", "text"), ("customer", _CUSTOMER, "c_nationkey", "long"),
    ("customer", _CUSTOMER, "c_acctbal", "double"), ("customer", _CUSTOMER, "c_mktsegment", "text"),
    ("customer", _CUSTOMER, "cell", "text"),
]
ORACLE_SQL["profile"] = _profile(_CUSTOMER_COLUMNS)

_LISTED = " UNION ALL ".join(_typed_column(*c) for c in _CUSTOMER_COLUMNS)


def _lists(cells: str) -> str:
    texts = f"SELECT column_name, value FROM ({cells}) WHERE type = 'TEXT'"
    counts = f'SELECT column_name AS "column", value, count(*) AS cnt FROM ({cells}) GROUP BY ALL'
    return f"""
        SELECT "column" AS column_name, 'frequent' AS list, rank, coalesce(value, 'None') AS value
        FROM ({top_of(counts)})
        UNION ALL SELECT column_name, 'shortest', rank, value
        FROM ({_extremes(texts, "ASC", "column_name")})
        UNION ALL SELECT column_name, 'longest', rank, value
        FROM ({_extremes(texts, "DESC", "column_name")})
    """


ORACLE_SQL["profile_lists"] = _lists(_LISTED)

_NATION = [
    ("nation", "nation", "n_nationkey", "long"), ("nation", "nation", "n_name", "text"),
    ("nation", "nation", "n_regionkey", "long"),
]
_SUPPLIER = [
    ("supplier", "supplier", "s_suppkey", "long"), ("supplier", "supplier", "s_name", "text"),
    ("supplier", "supplier", "s_nationkey", "long"), ("supplier", "supplier", "s_acctbal", "double"),
]
_PART = [
    ("part", "part", "p_partkey", "long"), ("part", "part", "p_name", "text"),
    ("part", "part", "p_brand", "text"), ("part", "part", "p_type", "text"),
    ("part", "part", "p_size", "long"), ("part", "part", "p_retailprice", "double"),
]
_ORDERED = [("orders", "orders", "o_orderdate", "date"), ("orders", "orders", "o_orderpriority", "text")]
ORACLE_SQL["profile_corpus"] = _profile(_NATION + _SUPPLIER + _PART + _ORDERED)

# --- keys --------------------------------------------------------------------


def _key_tests(dataset: str, source: str, columns, widest: int) -> str:
    """For every column set: is it a key?"""
    tests = [
        f"SELECT '{dataset}' AS dataset, '{','.join(s)}' AS key, {width} AS width, "
        f"(SELECT count(*) FROM (SELECT DISTINCT {', '.join(s)} FROM {source})) = "
        f"(SELECT count(*) FROM {source}) AS is_key"
        for width in range(1, widest + 1)
        for s in combinations(columns, width)
    ]
    return " UNION ALL ".join(tests)


def _superkeys(tests: str) -> str:
    """Keys, each with whether a smaller key lies inside."""
    return f"""
        WITH tests AS MATERIALIZED ({tests}), found AS (SELECT * FROM tests WHERE is_key)
        SELECT dataset, key, CAST(width AS BIGINT) AS width, NOT EXISTS (
            SELECT 1 FROM found i WHERE i.dataset = o.dataset AND i.width < o.width
                AND list_has_all(string_split(o.key, ','), string_split(i.key, ','))) AS minimal
        FROM found o
    """


def _minimal_keys(tests: str) -> str:
    return f"SELECT * FROM ({_superkeys(tests)}) WHERE minimal"


def _levels(dataset: str, source: str, columns: list[str]) -> str:
    """``{dataset}_keys``: masks of the minimal keys, width by width. A set that holds a key is
    none of them and is not counted. A set of columns is one exact number per row, made of
    the place of each value among those of its column."""
    n, name = len(columns), dataset
    ranks = ", ".join(f"dense_rank() OVER (ORDER BY {c}) - 1 AS r{i}" for i, c in enumerate(columns))
    products = ", ".join(
        "CAST(1 AS HUGEINT)" + "".join(f" * (max(r{j}) + 1)" for j in range(i)) + f" AS m{i}" for i in range(n))
    code = " + ".join(f"CASE WHEN mask & {1 << i} <> 0 THEN r{i} * m{i} ELSE 0 END" for i in range(n))
    parts = [
        f"{name}_rows AS MATERIALIZED (SELECT {ranks} FROM {source})",
        f"{name}_units AS MATERIALIZED (SELECT {products} FROM {name}_rows)",
        f"{name}_sets AS MATERIALIZED (SELECT s AS mask, bit_count(s) AS width FROM range(1, {1 << n}) t(s))",
    ]
    known = ""
    for width in range(1, n + 1):
        unknown = f"NOT EXISTS (SELECT 1 FROM ({known}) k WHERE k.mask & s.mask = k.mask)" if known else "true"
        parts.append(
            f"{name}_{width} AS MATERIALIZED (SELECT mask FROM (SELECT mask FROM {name}_sets s WHERE width = {width} AND {unknown}) "
            f"CROSS JOIN {name}_rows CROSS JOIN {name}_units GROUP BY mask "
            f"HAVING count(DISTINCT {code}) = (SELECT count(*) FROM {name}_rows))")
        known += (" UNION ALL " if known else "") + f"SELECT mask FROM {name}_{width}"
    return ", ".join([*parts, f"{name}_keys AS ({known})"])


def _named(dataset: str, columns: list[str], masks: str, minimal: str) -> str:
    """Sets of a table as rows, from their masks."""
    names = ", ".join(f"CASE WHEN s.mask & {1 << i} <> 0 THEN '{c}' END" for i, c in enumerate(columns))
    return (f"SELECT '{dataset}' AS dataset, concat_ws(',', {names}) AS key, CAST(bit_count(s.mask) AS BIGINT) AS width, "
            f"{minimal} AS minimal FROM {masks} s")


def _all_minimal(tables: dict[str, tuple[str, list[str]]]) -> str:
    found = [_named(d, columns, f"{d}_keys", "true") for d, (_, columns) in tables.items()]
    return "WITH " + ", ".join(_levels(d, *t) for d, t in tables.items()) + " " + " UNION ALL ".join(found)


def _all_superkeys(tables: dict[str, tuple[str, list[str]]]) -> str:
    found = [
        _named(d, columns, f"(SELECT mask FROM {d}_sets o WHERE EXISTS (SELECT 1 FROM {d}_keys k WHERE k.mask & o.mask = k.mask))",
               f"s.mask IN (SELECT mask FROM {d}_keys)")
        for d, (_, columns) in tables.items()]
    return "WITH " + ", ".join(_levels(d, *t) for d, t in tables.items()) + " " + " UNION ALL ".join(found)


_LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
_NATION_COLUMNS = ["n_nationkey", "n_name", "n_regionkey"]
_LINE_ALL = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
_ORDER_ALL = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
_ORDERS = f"(SELECT *, {fx.MESSY} AS cell FROM orders)"
ORACLE_SQL["key_candidates"] = _all_minimal({
    "lineitem": ("lineitem", _LINE_ALL), "orders": ("orders", _ORDER_ALL), "nation": ("nation", _NATION_COLUMNS)})
ORACLE_SQL["key_columns"] = _minimal_keys(
    _key_tests("lineitem", "lineitem", _LINE, 4) + " UNION ALL "
    + _key_tests("nation", "nation", _NATION_COLUMNS, 3))
ORACLE_SQL["superkeys"] = _all_superkeys({
    "lineitem": ("lineitem", _LINE_ALL), "orders": (_ORDERS, [*_ORDER_ALL, "cell"])})
ORACLE_SQL["key_candidates_probed"] = _minimal_keys(_key_tests("orders", "orders", _ORDER_ALL, 6))
_TYPED = """(SELECT CAST('12345678901234567890123456' AS DECIMAL(38,0)) + o_orderkey AS wide,
    make_timestamptz(o_custkey * 1000 + o_orderkey % 7) AS instant,
    CASE WHEN o_orderkey % 2 = 0 THEN [o_orderstatus || ', ' || o_orderpriority]
        ELSE [o_orderstatus, o_orderpriority] END AS list,
    {'a': o_orderstatus, 'b': o_custkey} AS pair FROM orders)"""
ORACLE_SQL["typed_distinct"] = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) AS distinct_values FROM (SELECT DISTINCT {c} FROM {source})"""
    for source, columns in (
        (_TYPED, ("wide", "instant", "list", "pair")), ("embeddings", ("vec_id", "embedding", "label")),
    )
    for c in columns
)
_EXTREME = """(SELECT *, CAST('12345678901234567890123456' AS DECIMAL(38,0)) + o_orderkey AS wide,
    CAST(CAST(o_orderkey AS DECIMAL(18,6)) / 1000000 AS DECIMAL(38,6)) AS part,
    o_orderdate + to_microseconds(o_custkey) AS moment FROM orders)"""
ORACLE_SQL["typed_extremes"] = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {text.format(f"min({c})")} AS min_value, {text.format(f"max({c})")} AS max_value FROM {source}"""
    for source, columns in (
        (_EXTREME, [*_ORDER_ALL, "wide", "part", "moment"]),
        ("customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]),
    )
    for c in columns
    for text in ["strftime({}, '%Y-%m-%d %H:%M:%S.%f')" if c in ("o_orderdate", "moment") else "CAST({} AS VARCHAR)"]
)
_TYPED_KEYS = (
    _key_tests("orders", _TYPED, ["wide", "instant", "list", "pair"], 4) + " UNION ALL "
    + _key_tests("embeddings", "embeddings", ["vec_id", "embedding", "label"], 3)
)
ORACLE_SQL["typed_keys"] = _minimal_keys(_TYPED_KEYS)
_JOB_KEYS = " UNION ALL ".join(
    [
        _key_tests("nation", "nation", ["n_nationkey", "n_name", "n_regionkey"], 3),
        _key_tests("region", "region", ["r_regionkey", "r_name"], 2),
        _key_tests("supplier", "supplier", ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"], 4),
    ]
)
ORACLE_SQL["job_keys"] = _minimal_keys(_JOB_KEYS)

# --- dictionaries and patterns -----------------------------------------------

TERMS = fx.sql_values(
    [(label, term) for label, terms in fx.DICTIONARY.items() for term in terms], "d(label, term)"
)
LOWER_CELLS = f"SELECT lower({fx.LABELLED}) AS value, count(*) AS cnt FROM customer GROUP BY ALL"
SIMILAR = "levenshtein({0}, {1}) * 5 <= greatest(length({0}), length({1}))"


ORACLE_SQL["dict_exact"] = (
    f"SELECT value, cnt, label, term FROM ({LOWER_CELLS}) JOIN {TERMS} ON value = term"
)
def tokens(table: str) -> str:
    return f"""
        SELECT DISTINCT word FROM (
            SELECT unnest(regexp_split_to_array(lower(text), '[ \\n]+')) AS word FROM {table})
        WHERE word <> ''
    """


ORACLE_SQL["dict_exact_large"] = f"""
    SELECT word, 'word' AS label, word AS term FROM ({tokens("documents")})
    WHERE word IN (SELECT word FROM ({tokens("conversations")}))
"""
ORACLE_SQL["dict_exact_shuffled"] = ORACLE_SQL["dict_exact_large"]
ORACLE_SQL["dict_terms"] = """
    SELECT DISTINCT 'name' AS label, lower(p_name) AS term FROM part
    UNION ALL SELECT DISTINCT 'supplier', lower(s_name) FROM supplier
"""
ORACLE_SQL["dict_abbrev"] = """
    SELECT DISTINCT 'agency' AS label, lower(s_name) AS term FROM supplier
    UNION ALL SELECT DISTINCT 'agency', 's' || s_suppkey FROM supplier WHERE s_suppkey % 3 <> 0
    UNION ALL SELECT DISTINCT 'bracketed', lower(s_name) FROM supplier WHERE s_suppkey % 3 <> 0
    UNION ALL SELECT DISTINCT 'bracketed', 's' || s_suppkey FROM supplier WHERE s_suppkey % 3 <> 0
"""
_INSIDE = fx.sql_values(
    [("college_name", t) for t in fx.COLLEGE] + [("business_name", t) for t in fx.BUSINESS],
    "d(label, term)",
)
ORACLE_SQL["dict_contains"] = (
    f"SELECT doc_id, label, term FROM documents JOIN {_INSIDE} ON contains(lower(text), term)"
)
ORACLE_SQL["dict_contains_large"] = """
    WITH w AS (SELECT list_filter(regexp_split_to_array(text, '[ \\n]+'), lambda x: x <> '') AS w FROM benchmark),
    pairs AS (SELECT DISTINCT w[i] || ' ' || w[i + 1] AS term FROM w, unnest(range(1, len(w))) t(i))
    SELECT doc_id, 'pair' AS label, term FROM documents JOIN pairs ON contains(text, term)
"""
ORACLE_SQL["dict_contains_shuffled"] = ORACLE_SQL["dict_contains_large"]
ORACLE_SQL["dict_fuzzy"] = f"""
    SELECT value, cnt, label, term FROM ({LOWER_CELLS}) JOIN {TERMS}
    ON {SIMILAR.format("value", "term")}
"""
# The edit distance here is over bytes: letters of two bytes are put in the place of capital
# letters and signs that lower-case words don't have, one for one.
_WIDE = "àáâãäåæçèéêëìíîïñòóôõöøœùúûüÿß¿¡«»"
_NARROW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ\x01\x02\x03\x04\x05\x06\x07\x08"


def _plain_tokens(table: str) -> str:
    return f"""
        SELECT DISTINCT word, translate(word, '{_WIDE}', '{_NARROW}') AS plain FROM (
            SELECT unnest(regexp_split_to_array(lower(text), '[ \n]+')) AS word FROM {table})
        WHERE word <> ''
    """


ORACLE_SQL["dict_fuzzy_large"] = f"""
    SELECT v.word, 'word' AS label, t.word AS term
    FROM ({_plain_tokens("benchmark")}) v JOIN ({_plain_tokens("conversations")}) t
    ON {SIMILAR.format("v.plain", "t.plain")}
"""
ORACLE_SQL["similarity"] = """
    SELECT p_partkey,
        round(1 - levenshtein(p_name, p_type) / greatest(length(p_name), length(p_type)), 6) AS sim
    FROM part
"""
SITE = (
    r"^(https?://(www\.)?)?[a-z0-9]+([-.][a-z0-9]+)*\.[a-z]{2,5}(:[0-9]{1,5})?(/.*)?$"
)
ORACLE_SQL["pattern_match"] = f"""
    SELECT page_id, regexp_matches(lower(url), '{SITE}') AS is_site,
        regexp_matches(split_part(split_part(url, '//', 2), '/', 1), '{SITE}') AS host_is_site
    FROM pages
"""

# --- semantic types ----------------------------------------------------------

_END = (
    "(place|avenue|ave|ave\\.|court|ct|street|st|drive|dr|lane|ln|road|rd|blvd|plaza|parkway|pkwy)"
)


def _cascade(terms: dict, college, business) -> str:
    """The ordered tests on ``v`` (lower case) as one CASE."""

    def known(label: str) -> str:
        return f"v IN {in_list(terms[label])}" if terms.get(label) else "false"

    def near(label: str) -> str:
        tests = [SIMILAR.format("v", "'" + t + "'") for t in terms.get(label, ())]
        return "(" + " OR ".join(tests) + ")" if tests else "false"

    def inside(words) -> str:
        return "(" + " OR ".join(f"contains(v, '{w}')" for w in words) + ")"

    bare = "replace(replace(replace(v, '(', ''), ')', ''), ' ', '')"
    unsigned = "replace(replace(v, '+', ''), '-', '')"
    rules = [
        (known("city"), "city"),
        (known("city_agency"), "city_agency"),
        (inside(college), "college_name"),
        (known("vehicle_type"), "vehicle_type"),
        (known("school_level"), "school_level"),
        (inside(business), "business_name"),
        (known("area_of_study"), "area_of_study"),
        (known("color"), "color"),
        (r"regexp_matches(v, '^[0-9]{5}(-[0-9]{4})?$')", "zip_code"),
        (r"regexp_matches(v, '^[a-z][0-9]{1,2}-(walk-up|elevator|condops)')", "building_classification"),
        (f"regexp_matches(v, '{SITE}')", "website"),
        (
            rf"regexp_matches({bare}, '^[-+]?([1-8]?\d(\.\d+)?|90(\.0+)?),\s*"
            rf"[-+]?(180(\.0+)?|((1[0-7]\d)|([1-9]?\d))(\.\d+)?)$')",
            "lat_lon_cord",
        ),
        (
            rf"regexp_full_match({unsigned}, '([1-9]\d?|1[0-7]\d)\.\d{{3,7}}|180|0(\.\d{{1,6}})?')",
            "lat_lon_cord",
        ),
        (
            r"(regexp_full_match(v, '[2-9]\d{2}-\d{3}-\d{4}') OR "
            r"regexp_matches(v, '^(\(\d{3}\) ?|\d{3}-)?\d{3}-\d{4}') OR "
            r"regexp_full_match(v, '(1?(-?\d{3})-?)?\d{3}-?\d{4}'))",
            "phone_number",
        ),
        (
            "regexp_full_match(v, '([a-z0-9]{1,10} ){1,5}(high school|middle school|studies|"
            "charter school|elementary school|(school|academy) (of|for) [a-z0-9]{1,50})')",
            "school_name",
        ),
        ("regexp_full_match(v, '([a-z0-9]{1,10} ){1,5}(park|playground)')", "park_playground"),
        (f"regexp_full_match(v, '([a-z0-9]{{1,10}} ){{1,2}}{_END}')", "street_name"),
        (r"regexp_matches(v, '^\d+?[a-z]*\s\w*\s?\w+?\s\w{2}\w*\s*\w*')", "address"),
        (near("borough"), "borough"),
        (near("car_make"), "car_make"),
        (near("subject_in_school"), "subject_in_school"),
        (known("neighborhood"), "neighborhood"),
        (near("neighborhood"), "neighborhood"),
        (known("person_name"), "person_name"),
    ]
    whens = " ".join(f"WHEN {test} THEN '{label}'" for test, label in rules)
    return f"CASE {whens} ELSE 'other' END"


SHORT_RULES = _cascade(fx.DICTIONARY, fx.COLLEGE, fx.BUSINESS)
STANDARD_RULES = _cascade(
    {
        "vehicle_type": fixed.VEHICLE_TERMS,
        "school_level": fixed.SCHOOL_LEVEL_TERMS,
        "area_of_study": fixed.AREA_OF_STUDY_TERMS,
        "color": fixed.COLOR_TERMS,
        "borough": fixed.BOROUGH_TERMS,
        "car_make": fixed.CAR_MAKE_TERMS,
        "subject_in_school": fixed.SUBJECT_TERMS,
    },
    fixed.COLLEGE_TERMS,
    fixed.BUSINESS_TERMS,
)


def corpus(cell: str = fx.LABELLED) -> str:
    return (
        f"SELECT {fx.CORPUS_DATASET} AS dataset, {fx.CORPUS_COLUMN} AS \"column\", "
        f"{cell} AS value FROM customer"
    )


TABLE_CELLS = " UNION ALL ".join(
    f"SELECT '{t}' AS dataset, '{c}' AS \"column\", {c} AS value FROM {t}"
    for t, c in (
        ("pages", "url"), ("part", "p_name"), ("part", "p_brand"), ("nation", "n_name"),
        ("orders", "o_orderpriority"), ("customer", "c_name"), ("events", "event_type"),
    )
) + f" UNION ALL SELECT 'orders', 'cell', {fx.MESSY} FROM orders"


def semantic(cells: str, cascade: str) -> str:
    return f"""
        SELECT dataset, "column", label, cnt, row_number() OVER (
            PARTITION BY dataset, "column" ORDER BY cnt DESC, label) AS rank
        FROM (
            SELECT dataset, "column", label, CAST(sum(n) AS BIGINT) AS cnt FROM (
                SELECT dataset, "column", {cascade} AS label, n FROM (
                    SELECT dataset, "column", lower(value) AS v, count(*) AS n FROM ({cells})
                    WHERE value IS NOT NULL AND lower(trim(value)) NOT IN {in_list(fixed.EMPTY_SEMANTIC)}
                    GROUP BY ALL))
            GROUP BY ALL)
    """


CORPUS_SEMANTIC = semantic(corpus(), SHORT_RULES)
ORACLE_SQL["semantic_types"] = semantic(f"{corpus()} UNION ALL {TABLE_CELLS}", SHORT_RULES)
ORACLE_SQL["semantic_types_shuffled"] = ORACLE_SQL["semantic_types"]
_SPOKEN = f"""SELECT 'conversations' AS dataset, 'word' AS "column", word AS value FROM ({tokens("conversations")})"""
ORACLE_SQL["semantic_default_rules"] = semantic(
    f"{corpus()} UNION ALL {TABLE_CELLS} UNION ALL {_SPOKEN}", STANDARD_RULES
)
ORACLE_SQL["semantic_values"] = f"""
    SELECT "column", value, {SHORT_RULES} AS label, cnt FROM (
        SELECT "column", value, lower(value) AS v, count(*) AS cnt FROM ({corpus()}) GROUP BY ALL)
"""

# columns of the corpus with their labels, each once under its first index
LABELLED_COLUMNS = f"""
    SELECT min(c_custkey) AS idx, {fx.CORPUS_DATASET} AS dataset, {fx.CORPUS_COLUMN} AS "column",
        arg_min({fx.CORPUS_LABELS}, c_custkey) AS labels
    FROM customer GROUP BY ALL
"""
HAS = "list_contains(string_split(labels, ','), label)"
ORACLE_SQL["semantic_profile"] = f"""
    SELECT dataset AS dataset_name, "column" AS column_name, labels AS actual_types, rank AS pos,
        label AS semantic_type, cnt AS cells, CASE WHEN label = 'other' THEN labels END AS label
    FROM ({CORPUS_SEMANTIC}) JOIN ({LABELLED_COLUMNS}) USING (dataset, "column")
"""

# --- work list and labels ----------------------------------------------------

ORACLE_SQL["worklist"] = """
    SELECT c_custkey, CAST(0 AS BIGINT) AS idx, 'ds' || (c_custkey % 9) AS dataset,
        'COL_' || c_custkey AS "column" FROM customer
    UNION ALL SELECT c_custkey, 1, 'ds' || c_nationkey, c_mktsegment FROM customer
"""
_TRUTH = f"SELECT c_custkey AS idx, {fx.TRUTH_LABELS} AS labels FROM customer"
ORACLE_SQL["truth_labels"] = f"""
    SELECT label, count(*) AS actual
    FROM (SELECT unnest(string_split(labels, ',')) AS label FROM ({_TRUTH})) GROUP BY label
"""
_ENTRIES = f"""
    SELECT 2 * c_custkey + e AS idx, {fx.TRUTH_LABELS} AS labels,
        CASE e WHEN 0 THEN 'ds' || (c_custkey % 9) ELSE 'ds' || c_nationkey END AS dataset,
        CASE e WHEN 0 THEN 'COL_' || c_custkey ELSE c_mktsegment END AS name
    FROM customer, (VALUES (0), (1)) t(e)
"""
ORACLE_SQL["manual_labels"] = f"""
    SELECT dataset AS dataset_name, name AS column_name, unnest(string_split(labels, ',')) AS semantic_type
    FROM ({_ENTRIES})
    UNION ALL SELECT NULL, NULL, unnest([{", ".join(f"'{t}'" for t in fixed.SEMANTIC_TYPES)}])
"""
ORACLE_SQL["unmatched_labels"] = f"SELECT idx, labels FROM ({_ENTRIES}) WHERE dataset = 'ds4'"

RESOLVED = f"""
    WITH wanted AS (
        SELECT p_partkey AS idx, 'ds' || (p_partkey % 5) AS dataset, {fx.WANTED_NAME} AS name FROM part),
    heads AS (
        SELECT 'ds' || (p_partkey % 5) AS dataset, p_partkey AS pos, {fx.HEADER} AS header FROM part),
    firsts AS (SELECT dataset, header, min(pos) AS pos FROM heads GROUP BY ALL),
    names AS (
        SELECT *, contains(name, 'CORE_SUBJECT') AS aliased, replace(name, '_', ' ') AS spaced FROM wanted),
    hits AS (
        SELECT idx, header, pos, CASE
            WHEN header = name THEN 0
            WHEN aliased AND header = 'CORE SUBJECT' THEN 1
            WHEN aliased AND contains(header, 'CORE SUBJECT') THEN 2
            WHEN NOT aliased AND header = spaced THEN 3
            WHEN NOT aliased AND {SIMILAR.format("spaced", "header")} THEN 4 END AS tier
        FROM names JOIN firsts USING (dataset)),
    best AS (
        SELECT idx, min(tier) AS tier, arg_min(header, tier * 10000000000 + pos) AS header
        FROM hits WHERE tier IS NOT NULL GROUP BY idx)
    SELECT w.idx, w.dataset, w.name AS "column", b.header AS resolved, CAST(b.tier AS BIGINT) AS tier
    FROM wanted w LEFT JOIN best b ON w.idx = b.idx
"""
ORACLE_SQL["resolve_columns"] = RESOLVED
ORACLE_SQL["unresolved_columns"] = f"""
    SELECT idx, dataset, "column", 'no such column' AS error FROM ({RESOLVED}) WHERE resolved IS NULL
"""

# --- evaluation --------------------------------------------------------------


def predicted(limit: str = "len(string_split(labels, ','))") -> str:
    return f"""
        SELECT idx, label, rank, {HAS} AS correct
        FROM ({CORPUS_SEMANTIC}) JOIN ({LABELLED_COLUMNS}) USING (dataset, "column")
        WHERE rank <= {limit}
    """


ORACLE_SQL["predicted_types"] = (
    f"SELECT *, 'truth' AS k FROM ({predicted()}) UNION ALL SELECT *, 'one' FROM ({predicted('1')})"
)
ORACLE_SQL["predicted_counts"] = f"""
    SELECT label, count(*) AS predicted, nullif(count(*) FILTER (correct), 0) AS correct
    FROM ({predicted()}) GROUP BY label
"""
PRECISION_RECALL = f"""
    SELECT label, actual, coalesce(predicted, 0) AS predicted, coalesce(correct, 0) AS correct,
        round(coalesce(correct / predicted, 0), 6) AS precision,
        round(coalesce(correct, 0) / actual, 6) AS recall
    FROM (
        SELECT label, count(*) AS actual
        FROM (SELECT unnest(string_split(labels, ',')) AS label FROM ({LABELLED_COLUMNS})) GROUP BY label)
    LEFT JOIN (
        SELECT label, count(*) AS predicted, count(*) FILTER (correct) AS correct
        FROM ({predicted()}) GROUP BY label) USING (label)
"""
ORACLE_SQL["precision_recall"] = PRECISION_RECALL
ORACLE_SQL["column_precision"] = f"""
    SELECT idx, dataset, "column",
        round(sum(CASE WHEN {HAS} THEN cnt ELSE 0 END) / sum(cnt), 6) AS precision
    FROM ({LABELLED_COLUMNS}) LEFT JOIN ({CORPUS_SEMANTIC}) USING (dataset, "column")
    GROUP BY ALL
"""

# --- corpus reports ----------------------------------------------------------

TALLY = f"""
    SELECT value, count(*) AS n FROM (
        SELECT lower(trim(coalesce(value, 'None'))) AS value FROM (
            SELECT value, row_number() OVER (
                PARTITION BY dataset, "column" ORDER BY cnt DESC, value ASC NULLS FIRST) AS rank
            FROM (SELECT dataset, "column", value, count(*) AS cnt FROM ({corpus(fx.REPORTED)}) GROUP BY ALL))
        WHERE rank <= 5)
    GROUP BY value
"""
WORDS_ONLY = f"SELECT * FROM ({TALLY}) WHERE NOT regexp_matches(value, '^[0-9]') AND length(value) <> 1"
ORACLE_SQL["value_tally"] = TALLY
ORACLE_SQL["top_values"] = f"SELECT * FROM ({WORDS_ONLY}) ORDER BY n DESC, value LIMIT 20"
ORACLE_SQL["empty_labels"] = f"SELECT * FROM ({WORDS_ONLY}) WHERE value IN {in_list(fixed.EMPTY_INSIGHT)}"
ORACLE_SQL["filled_values"] = (
    f"SELECT * FROM ({WORDS_ONLY}) WHERE value NOT IN {in_list(fixed.EMPTY_INSIGHT)}"
)
ORACLE_SQL["borough_mentions"] = f"SELECT * FROM ({TALLY}) WHERE value IN {in_list(fixed.BOROUGH_NAMES)}"
ORACLE_SQL["school_levels"] = (
    f"SELECT * FROM ({TALLY}) WHERE value IN {in_list(fixed.SCHOOL_LEVEL_TERMS)}"
)
ORACLE_SQL["top_streets"] = f"""
    SELECT * FROM ({TALLY}) WHERE regexp_full_match(value, '([a-zA-Z0-9]{{1,10}} ){{1,5}}{_END}')
    ORDER BY n DESC, value LIMIT 10
"""

# --- files: what was written must come back ----------------------------------

ORACLE_SQL["read_table"] = COUNTED.format("""
    SELECT 'o_orderkey' AS "column", lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS value FROM orders
    UNION ALL SELECT 'order.status', o_orderstatus FROM orders
    UNION ALL SELECT 'note', CASE WHEN o_orderkey % 4 <> 0
        THEN 'two' || chr(10) || 'lines ' || o_orderpriority END FROM orders
""")
ORACLE_SQL["read_split_table"] = ORACLE_SQL["read_table"]
ORACLE_SQL["catalog"] = """
    SELECT 'p' || p_partkey AS dataset, '/data/p' || p_partkey || '.tsv.gz' AS path FROM part
"""
_READ_BACK = [
    ("customer", "customer", "c_custkey", "long"), ("customer", "customer", "c_name", "text"),
    ("customer", "customer", "c_nationkey", "long"), ("customer", "customer", "c_acctbal", "double"),
    ("customer", "customer", "c_mktsegment", "text"), *_SUPPLIER,
    ("orders", "orders", "o_orderkey", "long"), ("orders", "orders", "o_custkey", "long"),
    ("orders", "orders", "o_orderstatus", "text"), ("orders", "orders", "o_totalprice", "double"),
    ("orders", "orders", "o_orderdate", "date"), ("orders", "orders", "o_orderpriority", "text"),
]
ORACLE_SQL["profile_documents"] = _profile(_READ_BACK)
_BACK_CELLS = " UNION ALL ".join(_typed_column(*c) for c in _READ_BACK)
_BACK_CELLS = f"SELECT dataset_name || '.' || column_name AS column_name, value, type FROM ({_BACK_CELLS})"
ORACLE_SQL["profile_document_lists"] = _lists(_BACK_CELLS)
_JOB_COLUMNS = [
    (d, d, c, "text")
    for d, names in {
        "nation": ["n_nationkey", "n_name", "n_regionkey"],
        "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
        "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    }.items()
    for c in names
]
ORACLE_SQL["job_profile"] = _profile(_JOB_COLUMNS)
_JOB_CELLS = " UNION ALL ".join(_typed_column(*c) for c in _JOB_COLUMNS)
_JOB_COUNTS = f"""
    SELECT dataset_name || '.' || column_name AS "column", value, count(*) AS cnt FROM ({_JOB_CELLS}) GROUP BY ALL
"""
ORACLE_SQL["job_report"] = f"""
    WITH tally AS (
        SELECT value, count(*) AS n
        FROM (SELECT lower(trim(coalesce(value, 'None'))) AS value FROM ({top_of(_JOB_COUNTS)})) GROUP BY value),
    words AS (SELECT * FROM tally WHERE NOT regexp_matches(value, '^[0-9]') AND length(value) <> 1),
    cells AS (SELECT * FROM words WHERE value NOT IN {in_list(fixed.EMPTY_INSIGHT)})
    SELECT 'top_values' AS part, * FROM (SELECT * FROM tally ORDER BY n DESC, value LIMIT 100)
    UNION ALL SELECT 'top_words', * FROM (SELECT * FROM words ORDER BY n DESC, value LIMIT 100)
    UNION ALL SELECT 'top_cells', * FROM (SELECT * FROM cells ORDER BY n DESC, value LIMIT 100)
    UNION ALL SELECT 'empty_labels', * FROM words WHERE value IN {in_list(fixed.EMPTY_INSIGHT)}
    UNION ALL SELECT 'boroughs', * FROM cells WHERE value IN {in_list(fixed.BOROUGH_NAMES)}
    UNION ALL SELECT 'school_levels', * FROM cells WHERE value IN {in_list(fixed.SCHOOL_LEVEL_TERMS)}
    UNION ALL SELECT 'streets', * FROM (
        SELECT * FROM cells WHERE regexp_full_match(value, '([a-zA-Z0-9]{{1,10}} ){{1,5}}{_END}') ORDER BY n DESC, value LIMIT 10)
"""
ORACLE_SQL["list_files"] = f"""
    SELECT 'truth' AS list, unnest(string_split(labels, ',')) AS label, CAST(idx AS VARCHAR) AS term FROM ({_TRUTH})
    UNION ALL SELECT DISTINCT 'terms', 'name', lower(p_name) FROM part
    UNION ALL SELECT DISTINCT 'terms', 'agency', lower(s_name) FROM supplier
    UNION ALL SELECT DISTINCT 'terms', 'agency', 's' || s_suppkey FROM supplier
"""
ORACLE_SQL["combine_json"] = f"""
    SELECT dataset AS dataset_name, "column" AS column_name, labels AS actual_types,
        label AS semantic_type, cnt AS cells, CASE WHEN label = 'other' THEN labels END AS label
    FROM ({CORPUS_SEMANTIC}) JOIN ({LABELLED_COLUMNS}) USING (dataset, "column")
"""
ORACLE_SQL["metrics_file"] = PRECISION_RECALL
ORACLE_SQL["quarantine"] = """
    SELECT lower(o_orderstatus) AS dataset, 'o_orderstatus' AS "column", o_orderstatus AS value,
        count(*) AS cnt FROM orders GROUP BY ALL
    UNION ALL SELECT lower(o_orderstatus), 'o_orderpriority', o_orderpriority, count(*)
    FROM orders GROUP BY ALL
    UNION ALL SELECT 'missing', NULL, 'set aside', NULL
"""
