"""Column sets that identify a row.

Two rows differ in a set of columns, their difference set. A column set is a key exactly if it
has a column in common with the difference set of every pair of rows, so the minimal keys are
the minimal hitting sets of all difference sets. The search never looks at all pairs:

* pairs of nearly equal rows, found by sorting small slices of the table, give first
  difference sets. Small ones rule out most column sets;
* the minimal hitting sets of what is known are the only candidates. Rows that agree on a
  candidate also agree on each part of it, so one part that few rows have in common, a pivot,
  settles all candidates around it: one shuffle brings together the rows that agree on the
  pivot, all of their pairs are compared, and their difference sets refute or prove every set
  that holds the pivot;
* this goes on until every minimal hitting set holds a pivot or is proved. No other minimal
  key can be left.

A pivot is a set on which a row agrees with at most ``PAIRS_PER_ROW`` others on average, as
counted in a sample of the rows; among these the one with most candidates for its work is
taken. So a shuffle moves every row once, not once per candidate, and the number of shuffles
follows that of the pivots, not of the keys, candidates or columns. Rows of a group may be
many more than estimated: they are streamed by a sort-merge join, never collected.

A candidate whose parts and which itself are common to many more rows is no key: neighbors in
the sample that agree on it refute it. What is left after that (sets of columns that cannot be
hashed) is counted: every row as one (set number, 128-bit hash) per candidate, combined before
the shuffle; sets whose hashes are all different have no equal rows, which is exact; where
hashes repeat, rows that agree are looked up and compared in every column. Large tables first
count only the hashes of one slice, which holds all rows that are equal on the set.

The driver sees difference sets, up to a fixed number a round, never a row of the table. The
number of minimal keys itself can grow as 2^n with the columns; they are listed one after the
other.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import quoted

SETS_PER_SCAN = 64
SETS_PER_JOB = 8
PROBE_ROWS = 100_000
# rows in which pairs are looked for, per column; only evidence, no result depends on it
EVIDENCE_ROWS = 20_000
EVIDENCE_CELLS = 2_000_000
# up to this many columns, all sets are listed and those that hold a key stay
LISTED_COLUMNS = 22
# repeated values of a set that are looked up
REPEATS = 8
# rows of one value that are sorted for neighbors
EVIDENCE_GROUP = 64
# rows in which agreeing pairs are counted to choose a pivot; only work depends on it
SAMPLE_ROWS = 50_000
# most pairs a row may be in on average, and how many pairs take the time of moving a row
PAIRS_PER_ROW = 32
PAIRS_PER_MOVE = 16
# difference sets brought back per pivot and per candidate; one with fewer is known in full
PIVOT_MASKS = 4096
CANDIDATE_MASKS = 64
# columns in one number
MASK_BITS = 60


def key_candidates(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    max_width: int | None = None,
    all_superkeys: bool = False,
    probe_rows: int = PROBE_ROWS,
) -> DataFrame:
    """Column sets without a duplicate row: ``key, width, minimal``.

    All minimal keys, or those of up to ``max_width`` columns; ``all_superkeys``
    adds every wider set that holds one.  Where sets must be counted, a table of more
    than four times ``probe_rows`` rows is probed for repeats before that.
    """
    names = list(columns) if columns is not None else df.columns
    widest = len(names) if max_width is None else min(max_width, len(names))
    found = _search(df, names, widest, probe_rows)
    keys = df.sparkSession.createDataFrame(
        [(list(s), len(s), True) for s in found], "key array<string>, width int, minimal boolean"
    )
    return _with_supersets(keys, found, names, widest) if all_superkeys and found else keys


def minimal_hitting_sets(edges: Iterable[int], width: int | None = None) -> Iterator[int]:
    """Minimal sets that meet every edge, one after the other; sets are bit masks.

    Depth first (after Murakami and Uno, 2014): a column is added only while each one chosen
    before still meets an edge alone, so nothing that is not minimal is ever extended.
    """
    edges = _minimal(edges)
    if 0 in edges:
        return
    everything = reduce(int.__or__, edges, 0)

    def search(chosen: int, allowed: int, open_edges: list[int], alone: dict[int, list[int]]) -> Iterator[int]:
        if not open_edges:
            yield chosen
            return
        if width is not None and len(alone) >= width:
            return
        branch = min((e & allowed for e in open_edges), key=int.bit_count)
        allowed &= ~branch
        while branch:
            column = branch & -branch
            branch ^= column
            left = {c: [e for e in own if not e & column] for c, own in alone.items()}
            if all(left.values()):
                left[column] = [e for e in open_edges if e & column]
                yield from search(chosen | column, allowed, [e for e in open_edges if not e & column], left)
            allowed |= column

    yield from search(0, everything, edges, {})


def _minimal(edges: Iterable[int]) -> list[int]:
    """The edges that hold no other one, the smallest first."""
    kept: list[int] = []
    for e in sorted(set(edges), key=lambda e: (e.bit_count(), e)):
        if not any(k & e == k for k in kept):
            kept.append(e)
    return kept


def _with_supersets(keys: DataFrame, found: list[tuple[str, ...]], names: list[str], widest: int) -> DataFrame:
    """Every set of up to ``widest`` columns that holds one of the keys ``found``."""
    if len(names) > LISTED_COLUMNS:
        return _widened(keys, names, widest)
    masks = [sum(1 << names.index(c) for c in key) for key in found]
    whole = F.array(*[F.lit(c) for c in names])
    known = F.array(*[F.lit(m).cast("long") for m in masks])
    sets = keys.sparkSession.range(1, 1 << len(names)).where(F.bit_count("id") <= widest)
    return sets.where(F.exists(known, lambda m: F.col("id").bitwiseAND(m) == m)).select(
        F.filter(whole, lambda _, i: F.getbit(F.col("id"), i) == 1).alias("key"),
        F.bit_count("id").alias("width"), F.array_contains(known, F.col("id")).alias("minimal"))


def _widened(keys: DataFrame, names: list[str], widest: int) -> DataFrame:
    """The same for more columns than all sets can be listed of, when ``widest`` is small.

    Each round adds one column to all sets of the round before; sets are in the
    order of ``names``, so a set reached by several ways is one row.
    """
    whole = F.array(*[F.lit(c) for c in names])
    level, found = keys, keys
    for width in range(1, widest):
        more = (
            level.filter(F.col("width") == width)
            .withColumn("added", F.explode(F.array_except(whole, F.col("key"))))
            .select(
                F.filter(whole, lambda c: F.array_contains("key", c) | (c == F.col("added"))).alias("key"),
                F.lit(width + 1).alias("width"),
                F.lit(False).alias("minimal"),
            )
            .distinct()
        )
        level = more.unionByName(keys.filter(F.col("width") == width + 1))
        found = found.unionByName(more)
    return found


def _search(df: DataFrame, names: list[str], widest: int, probe_rows: int) -> list[tuple[str, ...]]:
    table = df.select(*[_exact(df, c).alias(f"c{i}") for i, c in enumerate(names)])
    total = table.count()
    if total < 2:  # no two rows: every column is a key
        return [(c,) for c in names]
    whole = (1 << len(names)) - 1
    edges = _minimal([whole, *_near_pairs(table, total)])
    slices = total // probe_rows if total > 4 * probe_rows else 1
    part = max(1, total // SAMPLE_ROWS)
    sample = _hashed(table.where(F.pmod(F.xxhash64(*table.columns), F.lit(part)) == 0), whole).persist()
    safe = sum(1 << i for i, f in enumerate(table.schema) if _hashes_safely(f.dataType))
    agreeing: dict[int, float] = {}  # pairs per row that agree on a set, as estimated
    settled: list[int] = []
    keys: set[int] = set()
    try:
        while 0 not in edges:  # equal rows: no keys
            found, candidates = [], []
            for s in minimal_hitting_sets(edges, widest):
                found.append(s)
                if s not in keys and not any(t & s == t for t in settled):
                    candidates.append(s)
                    if len(candidates) == SETS_PER_SCAN:
                        break
            if not candidates:
                return sorted((tuple(names[i] for i in _columns(s)) for s in found), key=lambda k: (len(k), [names.index(c) for c in k]))
            pivot, common = _pivot(sample, candidates, safe, agreeing, part * part / total)
            if pivot:
                held = [s for s in candidates if s & pivot == pivot]
                masks, whole_list = _differences(table, pivot, held, total)
                if whole_list:
                    settled.append(pivot)
                keys.update(s for s in held if all(s & e for e in masks))
                edges = _minimal([*edges, *masks])
                continue
            refuted = _sample_pairs(sample, [s for s in common if not s & ~safe])
            rest = [s for s in common if s not in refuted]
            counted = _refuted(table, rest, total, slices) if rest else {}
            keys.update(s for s in rest if s not in counted)
            refuted.update(counted)
            # rows that agree on a refuted set differ only in other columns
            edges = _minimal([*edges, *(whole & ~s for s in refuted), *(e for found in refuted.values() for e in found)])
    finally:
        sample.unpersist()
    return []


def _pivot(
    sample: DataFrame, candidates: list[int], safe: int, agreeing: dict[int, float], weight: float
) -> tuple[int, list[int]]:
    """The part of candidates to compare rows by, 0 if there is none; and the candidates that
    have no such part. ``agreeing`` keeps what was estimated, ``weight`` is that of a pair of
    the sample."""
    def rare(s: int) -> bool:
        return any(t & s == t and n <= PAIRS_PER_ROW for t, n in agreeing.items())

    for width in range(1, max(map(int.bit_count, candidates)) + 1):
        wanted: dict[int, None] = {}
        for s in candidates:
            if len(wanted) < SETS_PER_SCAN and not rare(s):
                parts = (sum(1 << i for i in c) for c in combinations(_columns(s & safe), width))
                wanted.update((t, None) for t in parts if t not in agreeing)
        sets = list(wanted)
        for i in range(0, len(sets), SETS_PER_SCAN):
            lot = sets[i : i + SETS_PER_SCAN]
            groups = _set_hashes(sample, lot).groupBy("k", "x", "y").agg(F.count(F.lit(1)).alias("n"))
            pairs = groups.groupBy("k").agg(F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("pairs"))
            agreeing.update(dict.fromkeys(lot, 0.0))
            agreeing.update((lot[r["k"]], r["pairs"] * weight) for r in pairs.collect())  # a row per set

    def worth(t: int) -> float:
        return sum(t & s == t for s in candidates) / (PAIRS_PER_MOVE + agreeing[t])

    best = max((t for t, n in agreeing.items() if n <= PAIRS_PER_ROW), key=worth, default=0)
    if best and worth(best) > 0:
        return best, []
    return 0, [s for s in candidates if not s & safe or s & safe in agreeing][:SETS_PER_JOB]


def _differences(table: DataFrame, pivot: int, candidates: list[int], total: int) -> tuple[list[int], bool]:
    """Difference sets of all pairs of rows that agree on ``pivot``, and whether these are all:
    else the smallest of all and of those that refute a candidate. One shuffle of the rows.

    Rows meet by a hash of the pivot. Pairs that meet by chance are pairs as well, and columns are
    compared by their values (by 128 bits, if they are texts), so nothing depends on it. Every
    row meets itself once; more pairs without a difference are equal rows.
    """
    n = len(table.columns)
    hashed = _hashed(table, (1 << n) - 1, keep=True)
    x = reduce(Column.bitwiseXOR, [F.col(f"a{i}") for i in _columns(pivot)])
    order = reduce(Column.bitwiseXOR, [F.col(f"b{i}") for i in range(n)])
    by_hash = [_hashes_safely(f.dataType) and not _is_small(f.dataType) for f in table.schema]
    compared = [[f"a{i}", f"b{i}"] if by_hash[i] else [f.name] for i, f in enumerate(table.schema)]
    rows = hashed.select(x.alias("x"), order.alias("o"), *[c for own in compared for c in own])
    left, right = rows.alias("l"), rows.alias("r")
    pairs = left.join(right.hint("merge"), F.expr("l.x = r.x AND l.o <= r.o"))

    def bit(i: int) -> Column:
        same = reduce(Column.__and__, [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in compared[i]])
        return F.when(same, F.lit(0)).otherwise(F.lit(1 << i % MASK_BITS)).cast("long")

    words = [f"m{w}" for w in range(-(-n // MASK_BITS))]
    masks = [
        reduce(Column.__add__, [bit(i) for i in range(w * MASK_BITS, min(n, (w + 1) * MASK_BITS))]).alias(m)
        for w, m in enumerate(words)]
    counted = pairs.select(*masks).groupBy(*words).agg(F.count(F.lit(1)).alias("n"))

    def misses(s: int) -> Column:
        own = [s >> w * MASK_BITS & (1 << MASK_BITS) - 1 for w in range(len(words))]
        return reduce(Column.__and__, [F.col(m).bitwiseAND(F.lit(o).cast("long")) == 0 for m, o in zip(words, own)])

    lists = [F.lit(0), *[F.when(misses(s), F.lit(k)) for k, s in enumerate(candidates, 1)]]
    size = reduce(Column.__add__, [F.bit_count(m) for m in words])
    few = (
        counted.withColumn("size", size).where((F.col("size") > 0) | (F.col("n") > total))
        .withColumn("k", F.explode(F.array_compact(F.array(*lists))))
        .withColumn("at", F.row_number().over(Window.partitionBy("k").orderBy("size", *words)))
        .where(F.col("at") <= F.when(F.col("k") == 0, PIVOT_MASKS).otherwise(CANDIDATE_MASKS))
    )
    found = few.select("k", *words).collect()  # bounded by the limits
    sets = {sum(r[m] << w * MASK_BITS for w, m in enumerate(words)) for r in found}
    return sorted(sets), sum(r["k"] == 0 for r in found) < PIVOT_MASKS


def _is_small(kind: T.DataType) -> bool:
    return isinstance(kind, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType))


def _sample_pairs(sample: DataFrame, sets: list[int]) -> dict[int, list[int]]:
    """Of ``sets``, those on which rows of the sample agree, with difference sets of such rows."""
    found: dict[int, list[int]] = {}
    if sets:
        hashed = _with_arrays(sample, len(sample.columns) // 2)
        for r in _neighbors(_set_hashes(hashed, sets, "a", "b"), ["k", "x", "y"], F.col("a"), ["k"]):
            mask = int(r["mask"][::-1], 2)
            if not mask & sets[r["k"]]:
                found.setdefault(sets[r["k"]], []).append(mask)
    return found


def _columns(mask: int) -> list[int]:
    return [i for i in range(mask.bit_length()) if mask >> i & 1]


def _refuted(table: DataFrame, sets: list[int], total: int, slices: int) -> dict[int, list[int]]:
    """The sets that repeat a row, each with difference sets of rows that agree on it."""
    # arrays and structs of floating numbers are grouped by Spark itself, which evens out -0.0
    unsafe = sum(1 << i for i, f in enumerate(table.schema) if not _hashes_safely(f.dataType))
    plain = [s for s in sets if not s & unsafe]
    repeats: dict[int, list[tuple]] = {}
    for part in [slices, 1] if slices > 1 else [1]:
        left = [s for s in plain if s not in repeats]
        repeats.update(_repeats(table, left, part))
    found: dict[int, list[int]] = {s: [] for s in repeats}
    for s, mask in _agreeing_pairs(table, repeats):
        if not mask & s:
            found[s].append(mask)
    # equal hashes of different rows, if that ever happens, and sets that cannot be hashed
    doubtful = [s for s in repeats if not found[s]] + [s for s in sets if s & unsafe]
    for batch in _batches(doubtful):
        for s, distinct in zip(batch, _distinct(table, [tuple(f"c{i}" for i in _columns(s)) for s in batch])):
            found.pop(s, None)
            if distinct < total:
                found[s] = []
    return found


def _hashed(table: DataFrame, used: int, keep: bool = False) -> DataFrame:
    """Two 64-bit hashes of every column of ``used``: ``a0, a1... b0, b1...``, after all columns
    if they are to be kept. They differ for equal values of different columns, and a missing cell
    has its own."""
    made = list(table.columns) if keep else []
    for i, f in enumerate(table.schema):
        value, missing = F.col(f.name), F.col(f.name).isNull()
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):  # -0.0 is 0.0
            value = F.when(value == 0, F.lit(0.0).cast(f.dataType)).otherwise(value)
        if used >> i & 1:
            made += [F.xxhash64(F.lit(i), value, missing).alias(f"a{i}"), F.xxhash64(F.lit(~i), value, missing).alias(f"b{i}")]
    return table.select(*made)


def _set_hashes(hashed: DataFrame, sets: list[int], *kept: str) -> DataFrame:
    """``kept..., k, x, y`` per row and set: number of the set, and its two hashes.

    The hash of a set is the exclusive or of those of its columns: rows that differ in it have
    another one but for a chance of one in 2^64, for each of the two.
    """
    def of(name: str, s: int) -> Column:
        return reduce(Column.bitwiseXOR, [F.col(f"{name}{i}") for i in _columns(s)])

    each = [F.struct(F.lit(k).alias("k"), of("a", s).alias("x"), of("b", s).alias("y")) for k, s in enumerate(sets)]
    names = [f"set{k}" for k in range(len(sets))]
    wide = hashed.select(*kept, *[e.alias(n) for e, n in zip(each, names)])
    return wide.unpivot([F.col(c) for c in kept], [F.col(n) for n in names], "name", "set").select(*kept, "set.*")


def _repeats(table: DataFrame, sets: list[int], slices: int) -> dict[int, list[tuple[int, int]]]:
    """The sets with a hash that occurs twice, in one of ``slices`` slices: a few such hashes.

    One scan, whatever the number of sets.
    """
    if not sets:
        return {}
    rows = _set_hashes(_hashed(table, reduce(int.__or__, sets)), sets)
    if slices > 1:
        rows = rows.where(F.pmod("x", F.lit(slices)) == 0)
    counted = rows.groupBy("k", "x", "y").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    few = counted.withColumn("at", F.row_number().over(Window.partitionBy("k").orderBy("x", "y")))
    found: dict[int, list[tuple[int, int]]] = {}
    for r in few.where(F.col("at") <= REPEATS).collect():  # a few rows per set
        found.setdefault(sets[r["k"]], []).append((r["x"], r["y"]))
    return found


def _agreeing_pairs(table: DataFrame, repeats: dict[int, list[tuple]]) -> Iterator[tuple[int, int]]:
    """``set, difference set`` of neighbors among the rows with the given hashes. One scan."""
    sets = sorted(repeats)
    if not sets:
        return
    wanted = table.sparkSession.createDataFrame(
        [(k, x, y) for k, s in enumerate(sets) for x, y in repeats[s]], "k int, x long, y long")
    n = len(table.columns)
    hashed = _with_arrays(_hashed(table, (1 << n) - 1), n)
    hits = _set_hashes(hashed, sets, "a", "b").join(F.broadcast(wanted), ["k", "x", "y"])  # REPEATS rows per set
    for r in _neighbors(hits, ["k", "x", "y"], F.col("a"), ["k"]):
        yield sets[r["k"]], int(r["mask"][::-1], 2)


def _with_arrays(hashed: DataFrame, n: int) -> DataFrame:
    arrays = [F.array(*[F.col(f"{name}{i}") for i in range(n)]).alias(name) for name in "ab"]
    return hashed.select("*", *arrays)


def _near_pairs(table: DataFrame, total: int) -> list[int]:
    """Difference sets of rows that have a value in common and are neighbors in some order.

    Of every column a slice of its values, and a slice of all rows, are put in groups of equal
    values, and each group in the order of the other columns, beginning with the next. One scan.
    """
    n = len(table.columns)
    slices = F.lit(max(1, total // min(EVIDENCE_ROWS, max(500, EVIDENCE_CELLS // n**2))))
    every = F.sequence(F.lit(0), F.lit(n - 1))
    own_value = F.filter(every, lambda i: F.pmod(F.get("a", i), slices) == 0)
    rows = (
        _with_arrays(_hashed(table, (1 << n) - 1), n)
        .select("a", "b")
        .withColumn("c", F.explode(F.when(F.pmod(F.xxhash64("a"), slices) == 0, every).otherwise(own_value)))
        .withColumn("own", F.get("a", F.col("c")))
    )
    near = F.concat(F.slice("a", F.col("c") + 1, F.lit(n)), F.slice("a", F.lit(1), F.col("c")))
    return [int(r["mask"][::-1], 2) for r in _neighbors(rows, ["c", "own"], near, [])]


def _neighbors(rows: DataFrame, group: list[str], near: Column, kept: list[str]) -> list:
    """Distinct ``kept..., mask`` of neighboring rows in the first ``EVIDENCE_GROUP`` of every
    group; the mask has a 1 for each column in which they differ, by both hashes of its values.

    The limit lets tasks drop rows of a common value before the shuffle.
    """
    order = Window.partitionBy(*group).orderBy("near")
    few = rows.withColumn("near", near).withColumn("at", F.row_number().over(order)).where(F.col("at") <= EVIDENCE_GROUP)
    pairs = few.select(
        *kept, "a", "b", F.lag("a").over(order).alias("a0"), F.lag("b").over(order).alias("b0")).where("a0 is not null")
    same = lambda x, y: F.zip_with(x, y, lambda u, v: u == v)
    mask = F.zip_with(same("a", "a0"), same("b", "b0"), lambda u, v: F.when(u & v, "0").otherwise("1"))
    return pairs.select(*kept, F.array_join(mask, "").alias("mask")).distinct().collect()  # bounded by the limits


def _exact(df: DataFrame, name: str) -> Column:
    """The column as a value that can be grouped: maps cannot, their entries can."""
    column = F.col(quoted(name))
    if isinstance(df.schema[name].dataType, T.MapType):
        return F.array_sort(F.map_entries(column)).alias(name)
    return column


def _hashes_safely(kind: T.DataType) -> bool:
    """Whether equal values always have equal hashes."""
    if isinstance(kind, T.ArrayType):
        inner = [kind.elementType]
    elif isinstance(kind, T.StructType):
        inner = [f.dataType for f in kind.fields]
    else:
        return True
    return all(_hashes_safely(k) and not isinstance(k, (T.FloatType, T.DoubleType)) for k in inner)


def _batches(sets: list) -> list[list]:
    return [sets[i : i + SETS_PER_JOB] for i in range(0, len(sets), SETS_PER_JOB)]


def _distinct(df: DataFrame, sets: Sequence[tuple]) -> list[int]:
    """Exact distinct rows per column set, a missing cell being a value like any other."""
    counts = [
        df.select(*s)
        .distinct()
        .agg(F.count(F.lit(1)).alias("distinct"))
        .withColumn("number", F.lit(i))
        for i, s in enumerate(sets)
    ]
    rows = reduce(DataFrame.unionByName, counts).collect()  # one row per set
    found = {r["number"]: r["distinct"] for r in rows}
    return [found[i] for i in range(len(sets))]
