"""The Jaccard join against all pairs."""

import random

import pytest

from columnlens.llm import components, forest
from columnlens.llm.oracle import ORACLE_SQL
from columnlens.llm.queries import QUERIES

from .common import against_sql
from .test_decontaminate import words


def shingle_set(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    """id -> (class, group, links)."""
    sets = {i: shingle_set(t) for i, t in rows}
    ids = sorted(sets)
    near = {i: {j for j in ids if j != i and sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])} for i in ids}
    out = {}
    for i in ids:
        seen, front = {i}, [i]
        while front:
            fresh = near[front.pop()] - seen
            seen |= fresh
            front += fresh
        same = [j for j in ids if sets[j] == sets[i] and sets[i]] or [i]
        out[i] = (same[0], min(seen), len(near[i]))
    return out


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(3)
    word = lambda: f"w{rnd.randrange(4000)}"
    base = [word() for _ in range(150)]
    out = []
    for _ in range(320):  # one large group of near copies: several blocks
        t = list(base)
        for _ in range(rnd.randrange(4)):
            t[rnd.randrange(150)] = word()
        out.append(" ".join(t))
    for _ in range(15):
        t = [word() for _ in range(rnd.choice([3, 8, 60]))]
        out += [" ".join(t), " ".join(t).upper() + "!", " ".join(t[:-1] + [word()])]
    out += ["common line of seven words here now " + " ".join(word() for _ in range(40)) for _ in range(40)]
    return list(enumerate(out + [None, "", "?!", "one", "One."], 7))


def test_all_pairs(spark, texts, monkeypatch):
    monkeypatch.setattr(forest, "BLOCK", 64)
    df = spark.createDataFrame([(i, t, "x", i) for i, t in texts], "doc_id long, text string, digest string, class long")
    got = {r["doc_id"]: (r["class_id"], r["group_id"], r["n_links"]) for r in forest.joined(df).collect()}
    assert got == brute(texts)
    kept = {r["doc_id"] for r in forest.one_of_each_group(df).collect()}
    assert kept == {group for _, group, _ in got.values()}


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(40_000))
    rows = [(1, long), (2, long + " z"), (3, "a b c d e f"), (3, "a b c d e f"), (4, "a b c d e f"), (None, "a b c d e f"), (5, None), (6, None), (7, "u v w x y"), (7, "other words are in this text")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["group_id"], r["n_links"], r["n_rows"]) for r in forest.joined(df).collect()}
    assert got == {1: (1, 1, 1), 2: (1, 1, 1), 3: (3, 1, 2), 4: (3, 1, 1), 5: (5, 0, 1), 6: (6, 0, 1), 7: (7, 0, 2)}
    kept = sorted((str(r["doc_id"]) for r in forest.one_of_each_group(df).collect()))
    assert kept == ["1", "3", "5", "6", "7", "None"]
    assert forest.joined(df.limit(0)).count() == 0 and forest.one_of_each_group(df.limit(0)).count() == 0


def test_prefix_length():
    for k in (forest.prefix_length(0.8), forest.prefix_length(0.5), forest.prefix_length(0.99)):
        assert 1 <= k <= forest.DEPTH
    k = forest.prefix_length(0.8)
    assert 1 - (1 - 0.8**k) ** forest.TREES >= forest.RECALL


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3)] + [(200, x) for x in range(201, 260)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, **{i: 200 for i in range(200, 260)}}


def test_query(spark):
    against_sql(spark, "op2_jaccard_join", QUERIES, ORACLE_SQL)
