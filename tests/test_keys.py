"""Key search against trying every column set."""

import random
from itertools import combinations

import pytest

import columnlens as cl
from columnlens.operators import keys as keys_module


def brute_force(rows, names, widest):
    found = [
        s
        for width in range(1, widest + 1)
        for s in combinations(range(len(names)), width)
        if len({tuple(row[i] for i in s) for row in rows}) == len(rows)
    ]
    return {
        tuple(names[i] for i in s): not any(set(o) < set(s) for o in found) for s in found
    }


def as_dict(found):
    return {tuple(r["key"]): r["minimal"] for r in found.collect()}


@pytest.mark.parametrize("probed", [False, True])
@pytest.mark.parametrize("seed", range(3))
def test_random_tables(spark, seed, probed):
    limit = {"probe_rows": 1} if probed else {}  # as for a large table
    rng = random.Random(seed)
    names = ["a", "b.c", "d e", "f"]
    choices = [2, 3, 5, 8]
    rows = list(
        {tuple(rng.choice([None, *range(n)]) for n in choices) for _ in range(12 + 6 * seed)}
    )
    frame = spark.createDataFrame(
        [tuple(None if v is None else str(v) for v in r) for r in rows],
        ", ".join(f"`{n}` string" for n in names),
    )
    want = brute_force(rows, names, 4)
    assert as_dict(cl.key_candidates(frame, all_superkeys=True, **limit)) == want
    assert as_dict(cl.key_candidates(frame, **limit)) == {k: m for k, m in want.items() if m}


def test_missing_cells_are_values(spark):
    frame = spark.createDataFrame([(None, 1), (None, 2), (1, 1)], "a int, b int")
    assert as_dict(cl.key_candidates(frame)) == {("a", "b"): True}
    twice = spark.createDataFrame([(None, 1), (None, 1)], "a int, b int")
    assert as_dict(cl.key_candidates(twice)) == {}


def test_hopeless_sets_are_not_counted(spark, monkeypatch):
    # a third of the rows share one value of a, and b has too few values for them
    rows = [(0 if i % 3 == 0 else i, i % 20, i) for i in range(300)]
    frame = spark.createDataFrame(rows, "a int, b int, c int")
    counted = []
    original = keys_module._distinct
    monkeypatch.setattr(
        keys_module, "_distinct", lambda df, sets: counted.extend(sets) or original(df, sets)
    )
    assert as_dict(cl.key_candidates(frame, max_width=None)) == {("c",): True}
    assert counted == []


def test_width_bound_and_empty_table(spark):
    frame = spark.createDataFrame([(0, 0), (0, 1), (1, 0)], "a int, b int")
    assert as_dict(cl.key_candidates(frame, max_width=1)) == {}
    assert as_dict(cl.key_candidates(frame.limit(0))) == {("a",): True, ("b",): True}


def test_typed_values_stay_apart(spark):
    """Long decimals, the repeated hour of autumn, and nested values."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    frame = spark.range(100).selectExpr(
        "CAST('123456789012345678901234567000' AS decimal(30,0)) + id AS wide",
        "timestamp_seconds(1698537600 + 3600 * (id % 2)) AS hour",
        "CASE WHEN id % 2 = 0 THEN array('a, b') ELSE array('a', 'b') END AS list",
        "map('k', id) AS entries",
    )
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        counts = {r["column"]: r["distinct_values"] for r in cl.distinct_counts(cl.typed_counts(frame)).collect()}
        assert counts == {"wide": 100, "hour": 2, "list": 2, "entries": 100}
        assert as_dict(cl.key_candidates(frame)) == {("wide",): True, ("entries",): True}
        two = frame.limit(2)
        assert as_dict(cl.key_candidates(two.select("hour", "list"))) == {("hour",): True, ("list",): True}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_wide_table(spark):
    """Sixty columns: no key among those that repeat a row, so nothing more is listed."""
    frame = spark.range(60).selectExpr("id", *[f"id % {2 + i % 2} AS c{i}" for i in range(59)])
    assert as_dict(cl.key_candidates(frame)) == {("id",): True}
    supersets = cl.key_candidates(frame, max_width=2, all_superkeys=True)
    assert supersets.count() == 60 and supersets.where("minimal").count() == 1


def test_wide_keys_by_default(spark):
    rows = [tuple((i >> k) & 1 for k in range(5)) for i in range(32)]
    frame = spark.createDataFrame(rows, "a int, b int, c int, d int, e int")
    assert as_dict(cl.key_candidates(frame)) == {("a", "b", "c", "d", "e"): True}


def test_wide_keys_in_few_scans(spark, monkeypatch):
    """Sixty columns and a key of six: digits of the row number, and columns made of two each.
    (Wider keys are too many to list.)"""
    scans = []
    for name in ("_near_pairs", "_repeats", "_agreeing_pairs"):
        scan = getattr(keys_module, name)
        monkeypatch.setattr(
            keys_module, name, lambda *a, scan=scan: (scans.append(1) if a[1] else None) or scan(*a)
        )
    rng = random.Random(1)
    digit = "int(id / {}) % 4".format
    made = []
    for i in range(54):
        a, b = rng.sample(range(6), 2)
        made.append(f"({digit(4**a)} * {rng.randint(1, 3)} + {digit(4**b)}) % {rng.choice([2, 3])} AS x{i}")
    frame = spark.range(4096).selectExpr(*[f"{digit(4**k)} AS d{k}" for k in range(6)], *made)
    assert as_dict(cl.key_candidates(frame, max_width=6)) == {tuple(f"d{k}" for k in range(6)): True}
    assert len(scans) < 20


@pytest.mark.parametrize("seed", range(2))
def test_unproven_repeats_are_recounted(spark, monkeypatch, seed):
    """A hash that repeats without two rows that agree changes no result: the set is counted exactly."""
    rng = random.Random(seed)
    rows = list({(rng.randint(0, 2), rng.randint(0, 3), rng.randint(0, 4)) for _ in range(15)})
    frame = spark.createDataFrame(rows, "a int, b int, c int")
    want = brute_force(rows, ["a", "b", "c"], 3)
    monkeypatch.setattr(keys_module, "_repeats", lambda table, sets, slices: {s: [(1, 1)] for s in sets})
    monkeypatch.setattr(keys_module, "_near_pairs", lambda table, total: [])
    assert as_dict(cl.key_candidates(frame)) == {k: True for k, minimal in want.items() if minimal}


def test_zeros_and_nested_numbers(spark):
    """-0.0 is 0.0, also inside of arrays; NaN is NaN."""
    rows = [(0.0, [0.0], 1), (-0.0, [-0.0], 2), (float("nan"), [float("nan")], 3), (float("nan"), [1.0], 3)]
    frame = spark.createDataFrame(rows, "x double, list array<double>, n int")
    assert as_dict(cl.key_candidates(frame)) == {("list", "n"): True}
    assert as_dict(cl.key_candidates(frame.select("x", "n").limit(3))) == {("n",): True}


def test_hitting_sets_and_supersets(spark, monkeypatch):
    rng = random.Random(3)
    for _ in range(300):
        edges = [rng.randint(1, 63) for _ in range(rng.randint(1, 8))]
        meeting = [s for s in range(64) if all(s & e for e in edges)]
        want = {s for s in meeting if not any(o != s and o & s == o for o in meeting)}
        found = list(keys_module.minimal_hitting_sets(edges))
        assert len(found) == len(set(found)) and set(found) == want
        assert set(keys_module.minimal_hitting_sets(edges, 2)) == {s for s in want if s.bit_count() <= 2}
    assert list(keys_module.minimal_hitting_sets([3, 0])) == []
    rows = [(i % 2, i % 3, i % 5, i) for i in range(30)]
    frame = spark.createDataFrame(rows, "a int, b int, c int, d int")
    listed = as_dict(cl.key_candidates(frame, max_width=3, all_superkeys=True))
    monkeypatch.setattr(keys_module, "LISTED_COLUMNS", 0)
    assert as_dict(cl.key_candidates(frame, max_width=3, all_superkeys=True)) == listed
    assert len(listed) == 8  # d with up to two others, and a, b, c


@pytest.mark.parametrize("limits", [
    {}, {"PIVOT_MASKS": 2, "CANDIDATE_MASKS": 1}, {"PAIRS_PER_ROW": -1}, {"PAIRS_PER_ROW": 0}, {"SAMPLE_ROWS": 5}, {"MASK_BITS": 2}])
def test_pivots(spark, monkeypatch, limits):
    """The same keys whatever is estimated, listed or settled at once."""
    for name, value in limits.items():
        monkeypatch.setattr(keys_module, name, value)
    rng = random.Random(5)
    texts = [None, "", "a", "b", "c"]
    rows = list({(rng.choice(texts), rng.choice([None, 0.0, 1.5, 2.5]), rng.randrange(3), rng.randrange(4), rng.randrange(30)) for _ in range(40)})
    frame = spark.createDataFrame([(a, None if b is None else -b if i % 2 and b == 0 else b, c, d, e)
                                   for i, (a, b, c, d, e) in enumerate(rows)], "a string, b double, c int, d int, e int")
    want = brute_force(rows, ["a", "b", "c", "d", "e"], 5)
    assert as_dict(cl.key_candidates(frame)) == {k: True for k, minimal in want.items() if minimal}
    assert as_dict(cl.key_candidates(frame.unionAll(frame.limit(1)))) == {}


def test_one_shuffle_for_many_keys(spark, monkeypatch):
    """Forty-two keys around two columns: rows are not hashed once per key."""
    hashed, compared = [], []
    repeats, differences = keys_module._repeats, keys_module._differences
    monkeypatch.setattr(keys_module, "_repeats", lambda table, sets, slices: hashed.extend(sets) or repeats(table, sets, slices))
    monkeypatch.setattr(keys_module, "_differences", lambda *a: compared.append(a[1]) or differences(*a))
    frame = spark.range(600).selectExpr("int(id / 3) AS a", "int(id / 3) + 900 AS b", *[f"id % 3 + {k} AS c{k}" for k in range(21)])
    assert len(as_dict(cl.key_candidates(frame))) == 42
    assert hashed == [] and len(compared) == 2


def test_more_columns_than_bits(spark):
    frame = spark.range(90).selectExpr(
        "int(id / 9) AS a", *["1 AS s%d" % k for k in range(70)], "id % 9 AS z", "array(double(id % 9)) AS list")
    assert as_dict(cl.key_candidates(frame)) == {("a", "z"): True, ("a", "list"): True}


def test_superkeys_by_pivots(spark, monkeypatch):
    """Every key of any width, with no set counted over the rows."""
    hashed = []
    repeats = keys_module._repeats
    monkeypatch.setattr(keys_module, "_repeats", lambda table, sets, slices: hashed.extend(sets) or repeats(table, sets, slices))
    rng = random.Random(8)
    rows = list({tuple(rng.randrange(n) for n in (2, 3, 4, 9, 30, 40)) for _ in range(150)})
    frame = spark.createDataFrame(rows, "a int, b int, c int, d int, e int, f int")
    assert as_dict(cl.key_candidates(frame, all_superkeys=True)) == brute_force(rows, list("abcdef"), 6)
    assert hashed == []
