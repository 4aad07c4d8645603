"""Decontamination against a search for every window."""

import random
import re

import pytest

from columnlens.llm import decontaminate
from columnlens.llm.oracle import ORACLE_SQL
from columnlens.llm.queries import QUERIES

from .common import against_sql

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(low)


def brute(text, items):
    own, hit, found = words(text), set(), set()
    for item, other in items:
        w = words(other)
        n = min(13, len(w))
        windows = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
        for i in range(len(own) - n + 1):
            if n and tuple(own[i : i + n]) in windows:
                hit.update(range(i, i + n))
                found.add(str(item))
    return len(own), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(own)


@pytest.fixture
def tables(spark):
    rnd = random.Random(4)
    text = lambda n, k=40: " ".join(f"w{rnd.randrange(k)}é" for _ in range(n))
    items = [(i, text(rnd.choice([13, 14, 30, 60]), 500)) for i in range(12)]
    items += [(None, "an item that has no id"), (20, "Short ONE"), (21, "one"), (22, ""), (23, None), (24, "ha " * 40), (25, items[0][1]), (26, "a b c d e f g"), (None, text(15, 500))]
    docs = [text(300, 500) for _ in range(10)] + [None, "", "...", "ha " * 3000, "a b c d e f g h", "x short, one. y", "say AN ITEM that has no id", "A-B c\nd E f g"]
    for _, item in items[:12]:
        cut = item.split(" ")
        docs += [text(200, 500) + " " + item.upper() + " " + text(9), " ".join(cut[:12]) + " zz " + " ".join(cut[12:]), item + " " + item]
    docs.append(docs[-1])
    rows = [(i, d, "x", "clash") for i, d in enumerate(docs)] + [(None, docs[0], None, None)]
    return rows, items, spark.createDataFrame(rows, "doc_id long, text string, n_hit string, other string"), \
        spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("sent", [1 << 20, 0])
def test_both_ways(tables, sent):
    rows, items, docs, bench = tables
    got = decontaminate.marked(docs, bench, sent_bytes=sent)
    assert got.columns == ["doc_id", "text", "other", "n_words", "n_hit", "items", "contaminated"]
    want = sorted(((r[0], brute(r[1], items)) for r in rows), key=str)
    have = sorted(((r["doc_id"], (r["n_words"], r["n_hit"], [x for x in r["items"] if x is not None], r["contaminated"])) for r in got.collect()), key=str)
    fixed = sorted(((d, (n, h, [x for x in f if x != "None"], c)) for d, (n, h, f, c) in want), key=str)
    assert have == fixed


def test_empty_sides(tables):
    _, _, docs, bench = tables
    assert decontaminate.marked(docs.limit(0), bench).count() == 0
    for sent in (1, 0):
        assert decontaminate.marked(docs, bench.limit(0), sent_bytes=sent).where("contaminated or n_hit > 0").count() == 0


def test_winnowing_guarantee():
    import numpy as np

    rnd = np.random.default_rng(1)
    for _ in range(50):
        h = rnd.integers(0, 5, 40).astype(np.uint64)
        keep = set(decontaminate.winnow(h, np.zeros(40), 9).tolist())
        assert all(keep & set(range(i, i + 9)) for i in range(32))


def test_query(spark):
    against_sql(spark, "op5_decontaminate", QUERIES, ORACLE_SQL)
