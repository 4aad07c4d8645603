"""Fingerprints against exact sets and a plain walk over the ordered documents."""

import hashlib
import random

import pytest

from columnlens.llm import fingerprints
from columnlens.llm.queries import QUERIES

from .common import SF
from .test_forest import brute, shingle_set


def jaccard(a, b):
    a, b = shingle_set(a), shingle_set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(9)
    text = lambda n: " ".join(rnd.choice(["ab", "Cé", "dd", "e1", "日本", "𝔘x"]) + str(rnd.randrange(50)) for _ in range(n))
    out = [(i * 3, text(rnd.choice([0, 3, 40, 300]))) for i in range(60)]
    return out + [(500, None), (501, ""), (-7, text(20_000)), (None, "no id " * 30), (502, out[1][1])]


def test_against_walk(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, n_chars string, carry string")
    got = {r["doc_id"]: r for r in fingerprints.edited_likeness(df).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    assert len(got) == len(rows)
    for i, (key, text) in enumerate(order):
        own, nxt = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(own) // 2
        new = own[: len(own) - half] + nxt[:half]
        r = got[key]
        assert r["n_chars"] == len(own) and r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        assert abs(r["near_edited"] - jaccard(own, new)) < 0.2 and abs(r["near_next"] - jaccard(own, nxt)) < 0.2
    assert got[500]["fingerprint"] == got[501]["fingerprint"] and got[502]["fingerprint"] == got[3]["fingerprint"]


@pytest.mark.parametrize("ids", [[None, None], [5], [4, 4, 4], []])
def test_few_rows(spark, ids):
    df = spark.createDataFrame([(i, f"text {k} of some words") for k, i in enumerate(ids)], "doc_id long, text string")
    got = fingerprints.edited_likeness(df).collect()
    texts = [f"text {k} of some words" for k in range(len(ids))]
    want = [fingerprints.edited(t, texts[(i + 1) % len(texts)]) for i, t in enumerate(texts)]
    assert sorted(r["edited_sha256"] for r in got) == sorted(hashlib.sha256(t.encode()).hexdigest() for t in want)


def test_near_copies(spark, rows):
    rnd = random.Random(1)
    words = [f"w{rnd.randrange(999)}" for _ in range(120)]
    copies = [(1000 + i, " ".join(words[:i] + ["zz"] + words[i + 1 :])) for i in range(30)]
    df = spark.createDataFrame(rows + copies, "doc_id long, text string")
    got = {(r["doc_id"], r["near"]): r["jaccard"] for r in fingerprints.near_copies(df).collect()}
    texts = dict(rows + copies)
    assert all(abs(jaccard(texts[a], texts[b]) - v) < 1e-9 and v >= 0.8 for (a, b), v in got.items())
    assert {a for a, _ in got} >= {1000 + i for i in range(1, 30)} and (502, 3) in got


def test_links_beside_smaller_documents(spark):
    """Smaller documents at about 0.7 of two others, which are linked at about 0.9, are first in
    their bands; the link between the two must be found all the same."""
    rnd = random.Random(5)
    word = lambda: f"w{rnd.randrange(10**6)}"
    base = [word() for _ in range(300)]
    other = lambda n: " ".join(base[: 300 - n] + [word() for _ in range(n)])
    made = [(i, other(52)) for i in range(400)] + [(900, " ".join(base)), (901, other(15)), (902, other(15)), (903, " ".join(base))]
    made += [(950, None), (951, "?!"), (952, "one two")]
    df = spark.createDataFrame(made, "doc_id long, text string")
    want = brute(made)
    assert want[901][1] == 900 and all(want[i][1] == i for i in range(400))
    got = {r["doc_id"]: (r["class_id"], r["group_id"], r["n_links"]) for r in fingerprints.near_groups(df).collect()}
    assert got == want
    texts, links = dict(made), fingerprints.near_copies(df).collect()
    assert {x for r in links for x in (r["doc_id"], r["near"])} == {i for i in want if want[i][2]}
    assert all(r["near"] < r["doc_id"] and abs(jaccard(texts[r["doc_id"]], texts[r["near"]]) - r["jaccard"]) < 1e-9 for r in links)


def test_query_links(spark):
    """The registered query gives the classes, groups and links of all pairs."""
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    sets = {i: shingle_set(t) for i, t in rows}
    owners = {}
    for i, s in sets.items():
        for g in s:
            owners.setdefault(g, []).append(i)
    links = {i: 0 for i in sets}
    for i, s in sets.items():
        near = {j for g in s for j in owners[g]} - {i}
        links[i] = sum(5 * len(s & sets[j]) >= 4 * len(s | sets[j]) for j in near)
    got = {r["doc_id"]: r["n_links"] for r in QUERIES["op1_fingerprints"](spark, SF).collect()}
    assert got == links and any(links.values())


def test_query(spark):
    got = QUERIES["op1_fingerprints"](spark, SF)
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
