"""Clusters and whitening against plain loops, SQL and numpy."""

import hashlib
import math

import numpy as np
import pytest

from columnlens.llm import centroids, charpoly, whitening
from columnlens.llm.oracle import ORACLE_SQL
from columnlens.llm.queries import QUERIES

from .common import SF, against_sql

NAN, INF = float("nan"), float("inf")


def frame(spark, rows, extra=False):
    if extra:
        return spark.createDataFrame([(*r, "x", 5) for r in rows], "vec_id long, embedding array<float>, cluster string, n int")
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def plain_clusters(rows, size, k, rounds):
    kept = [(i, v) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    ints = [[math.floor(256 * x) for x in v] for _, v in kept]
    name = lambda i: (i is None, "" if i is None else hashlib.sha256(f"2:{i}".encode()).hexdigest())
    order = sorted(range(len(kept)), key=lambda j: (name(kept[j][0]), kept[j][1]))
    centers = [list(ints[j]) for j in order[:k]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))

    def assigned():
        return [min((far(v, c), n) for n, c in enumerate(centers)) for v in ints]

    for _ in range(rounds):
        of = assigned()
        for n in range(len(centers)):
            own = [v for v, (_, m) in zip(ints, of) if m == n]
            if own:
                centers[n] = [sum(column) // len(own) for column in zip(*own)]
    of = assigned()
    return sorted(
        ((i is None, i, n, d, sum(e for e, m in of if m == n), sum(e for e, _ in of), tuple(centers[n]))
         for (i, _), (d, n) in zip(kept, of)), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_clusters_equal_plain_loops(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(i, np.round(rng.normal(0, 0.1, 3), 2).tolist()) for i in range(120)]
    rows += [(5, rows[5][1]), (5, [0.5, 0.5, 0.5]), (None, [0.1, 0.1, 0.1]), (200, None), (201, []), (202, [0.1, None, 0.2]),
             (203, [0.1, NAN, 0.2]), (204, [INF, 0.0, 0.0]), (205, [0.1, 0.2]), (206, [-0.001, 0.0, -1.0])]
    rows += [(300 + i, [0.2, 0.2, 0.2]) for i in range(60)]  # one vector in a third of the rows
    found = centroids.clustered(frame(spark, rows).repartition(7), size=3, clusters=6, rounds=4).collect()
    assert sorted(((r[0] is None, r[0], r[1], r[2], r[3], r[4], tuple(r[5])) for r in found), key=str) == plain_clusters(rows, 3, 6, 4)


def test_clusters_of_odd_tables(spark):
    assert centroids.clustered(frame(spark, [])).count() == 0
    assert centroids.clustered(frame(spark, [(1, None), (2, [1.0])])).count() == 0
    few = [(i, [float(i), 0.0]) for i in range(3)]  # fewer vectors than centroids
    assert sorted(r["distance"] for r in centroids.clustered(frame(spark, few), size=2).collect()) == [0, 0, 0]
    # whole numbers, and columns whose names the operator uses
    clash = centroids.clustered(frame(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])], extra=True), size=2)
    assert clash.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]
    assert [tuple(r)[1:5] for r in clash.collect()] == [(0, 0, 0, 0)] * 2  # ties: the smaller number
    with pytest.raises(Exception, match="no exact 64-bit result"):
        centroids.clustered(frame(spark, [(1, [1e12, 0.0])]), size=2).collect()


def test_tables_start_over_with_the_same_distances():
    rng = np.random.default_rng(3)
    centers = rng.integers(-999, 999, (5, 4))
    tables = centroids.Tables(centers, entries=10)
    for _ in range(6):
        x = rng.integers(-999, 999, (50, 4))
        assert (tables.distances(x) == ((x[:, None] - centers[None]) ** 2).sum(2)).all()
        assert tables.held <= 10 + 200


def test_clusters_equal_sql(spark):
    against_sql(spark, "op11_centroids", QUERIES, ORACLE_SQL)


def test_polynomial_is_exact():
    # the Faddeev-LeVerrier recurrence over whole numbers
    rng = np.random.default_rng(4)
    for n in (1, 2, 3, 6, 9):
        y = rng.integers(-50, 50, (n + 2, n))
        a = (y.T @ y).astype(object)
        if n == 6:
            a[:, 2] = a[2, :] = 0  # zero pivots, rank below n
        m, c = np.zeros((n, n), object), [1]
        for k in range(1, n + 1):
            m = a @ m + c[-1] * np.eye(n, dtype=int).astype(object)
            c.append(-sum((a @ m)[i, i] for i in range(n)) // k)
        primes = charpoly.primes_over(2 * charpoly.coefficient_bound(a.tolist()))
        found = charpoly.hessenberg_polynomials(a.tolist(), primes).tolist()
        assert charpoly.remaindered(list(zip(primes, found))) == c[::-1]


def test_roots_close_equal_and_zero():
    def product(roots):
        c = [1]
        for r in roots:
            c = [a - r * b for a, b in zip([0, *c], [*c, 0])]
        return c

    close = 10**40
    roots = charpoly.largest_roots(product([0, 0, 3, 3, 3, close, close + 1, 7]), 6)
    assert [m for _, m in roots] == [1, 1, 1, 3]
    assert [round(r) for r, _ in roots] == [close + 1, close, 7, 3]
    assert charpoly.largest_roots([0, 0, 1], 4) == []
    assert [round(r) for r, _ in charpoly.largest_roots(product([1, 2, 3, 4]), 2)] == [4, 3]


def test_close_eigenvalues_have_their_own_vectors():
    # a rotation of two values that double precision cannot tell apart
    a = [[10**20 + 1, 1, 0], [1, 10**20 + 1, 0], [0, 0, 5]]
    primes = charpoly.primes_over(2 * charpoly.coefficient_bound(a))
    c = charpoly.remaindered(list(zip(primes, charpoly.hessenberg_polynomials(a, primes).tolist())))
    roots = charpoly.largest_roots(c, 2)
    assert [(int(r), m) for r, m in roots] == [(10**20 + 2, 1), (10**20, 1)] or [round(r) for r, _ in roots] == [10**20 + 2, 10**20]
    top, next_ = (charpoly.null_vectors(a, r, m)[0] for r, m in roots)
    h = 0.5**0.5
    assert np.allclose(top, [h, h, 0], atol=1e-15) and np.allclose(np.abs(next_), [h, h, 0], atol=1e-15)


def whitened_by_numpy(rows, k):
    kept = [(i, v) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in kept])
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    centred = fit - s / n
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1], v[:, ::-1]
    deviation = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s)) for row in x]
    return [i for i, _ in kept], n, deviation, ((x - s / n) @ v / np.sqrt(np.maximum(e, 1e-300)))[:, :k], e[:k] / e.sum()


def test_whitening_equals_numpy(spark):
    rng = np.random.default_rng(5)
    turn = np.linalg.qr(rng.normal(size=(6, 6)))[0]
    points = rng.normal(size=(200, 6)) * [9, 7, 5, 3, 2, 1] @ turn
    rows = [(i, v.tolist()) for i, v in enumerate(points)]
    rows += [(300 + i, rows[0][1]) for i in range(90)] + [(None, rows[3][1]), (5, rows[9][1])]
    odd = [(400, None), (401, []), (402, [1.0, None, 2.0, 3.0, 4.0, 5.0]), (403, [NAN] * 6), (404, [INF] + [0.0] * 5)]
    ids, n, deviation, expected, explained = whitened_by_numpy(rows, 4)
    found = whitening.components(whitening.whitened(frame(spark, rows + odd + [(405, [1.0])]).repartition(5), components=4)).collect()
    assert len(found) == 4 * len(rows) and {r["n"] for r in found} == {n}
    assert max(r["identity_error"] for r in found) < 1e-9
    by_id = {}
    for r in found:
        by_id.setdefault((r["vec_id"] is None, r["vec_id"], r["deviation"]), {})[r["component"]] = r
    signs = None
    for i, d, w in zip(ids, deviation, expected):
        own = by_id[(i is None, i, d)]
        got = np.array([own[c]["whitened"] for c in (1, 2, 3, 4)])
        signs = np.sign(got * w) if signs is None else signs
        assert np.allclose(got, signs * w, atol=1e-9)
        assert np.allclose([own[c]["explained"] for c in (1, 2, 3, 4)], explained, rtol=1e-9)


def test_whitening_of_odd_tables(spark):
    count = lambda rows: whitening.components(whitening.whitened(frame(spark, rows))).count()
    assert count([]) == 0
    assert count([(1, None), (2, [])]) == 0
    assert count([(1, [0.5, 0.5]), (2, [0.5, 0.5])]) == 0  # one distinct vector has no component
    assert count([(1, [0.0, 0.0, 0.0]), (2, [1.0, 1.0, 0.0])]) == 2  # rank 1
    # equal eigenvalues
    found = whitening.components(whitening.whitened(frame(spark, [(1, [1.0, 0.0]), (2, [-1.0, 0.0]), (3, [0.0, 1.0]), (4, [0.0, -1.0])], extra=False)))
    assert found.count() == 8 and {round(r["explained"], 12) for r in found.collect()} == {0.5}
    # deviations beyond 64 bits stay exact
    wide = whitening.whitened(frame(spark, [(i, [1e10 * i, 0.0]) for i in range(4)])).collect()
    assert {int(r["deviations"]) for r in wide} == {(4 * 64 * 10**10 * i - 6 * 64 * 10**10) ** 2 for i in range(4)}
    assert whitening.components(whitening.whitened(frame(spark, [(i, [1e10 * i, 0.0]) for i in range(4)]))).where("deviation is null").count() == 4


def test_whitening_query(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    ids, n, deviation, expected, explained = whitened_by_numpy(rows, 16)
    found = QUERIES["op13_whitening"](spark, SF).orderBy("vec_id", "component").collect()
    assert len(found) == 16 * len(rows) and {r["n"] for r in found} == {n}
    got = np.array([r["whitened"] for r in found]).reshape(-1, 16)
    order = np.argsort(ids)
    signs = np.sign(got[0] * expected[order][0])
    assert np.allclose(got, expected[order] * signs, atol=1e-8)
    assert [r["deviation"] for r in found[::16]] == [deviation[i] for i in order]
    assert np.allclose([r["explained"] for r in found[:16]], explained, rtol=1e-9)
    assert found[0]["identity_error"] < 1e-9
