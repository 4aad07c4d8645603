"""Reply trees against a walk over the tree in Python."""

import hashlib

import pytest

from columnlens.llm import replies
from columnlens.llm.oracle import ORACLE_SQL
from columnlens.llm.queries import QUERIES

from .common import SF, against_sql

SCHEMA = "tree long, node long, parent long, score double, role string, text string"


def paths(rows):
    """Root-to-leaf paths per tree, best first."""
    out = {}
    trees = {}
    for tree, node, parent, score, role, text in rows:
        trees.setdefault(tree, {})[node] = (parent, score or 0.0, role or "", text or "")
    for tree, nodes in trees.items():
        parents = {p for n, (p, *_) in nodes.items() if p in nodes and p != n}
        found = []
        for leaf in nodes:
            if leaf in parents:
                continue
            walk, seen = [leaf], {leaf}
            while (up := nodes[walk[-1]][0]) in nodes and up not in seen:
                walk.append(up)
                seen.add(up)
            found.append((-sum(nodes[n][1] for n in walk), leaf, walk[::-1]))
        out[tree] = [w for _, _, w in sorted(found)]
    return out, trees


ROWS = [
    (1, 1, None, 0.5, "user", "hello"), (1, 2, 1, 1.0, "assistant", "a"), (1, 3, 1, 2.0, "assistant", "b <|im_end|>\n"),
    (1, 4, 2, 5.0, "user", None), (1, 5, 4, None, None, ""), (1, 6, 3, 0.0, "assistant", "<\\|x"), (1, 7, 99, 1.0, "user", "orphan"),
    (2, 1, 1, 1.0, "assistant", "own parent"), (None, 1, None, 1.0, "user", "no tree"), (None, 2, 1, 1.0, "a\nb\\n<|", "x"),
    *((3, i, i - 1 if i else None, 1.0, "user" if i % 2 else "assistant", str(i)) for i in range(70)),
]


@pytest.mark.parametrize("top", [None, 1, 2])
def test_branches_and_masks(spark, top):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = replies.read_back(replies.formatted(df, top)).collect()
    want, trees = paths(ROWS)
    assert sum(len(p[:top]) for p in want.values()) == len(got)
    for r in got:
        walk = want[r["tree"]][r["branch"] - 1]
        turns = [(trees[r["tree"]][n][2], trees[r["tree"]][n][3]) for n in walk]
        assert [tuple(t) for t in r["turns"]] == turns
        assert r["loss_texts"] == [t for role, t in turns if role == "assistant"]
        for (role, text), mask in zip(turns, r["loss_mask"]):
            assert (mask is not None) == (role == "assistant")
            if mask:
                inside = r["formatted"][mask["start"] : mask["end"]]
                assert "<|" not in inside and r["formatted"][mask["begin"] :].startswith("<|im_start|>")
        assert r["formatted"].count("<|im_start|>") == len(turns) == r["formatted"].count("<|im_end|>\n")


def test_cycles_repeats_and_empty(spark):
    rows = [(1, 1, 2, 1.0, "user", "x"), (1, 2, 1, 1.0, "user", "y"), (2, 1, None, 1.0, "user", "z"), (2, 1, None, 1.0, "user", "z")]
    got = replies.formatted(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r["tree"], r["formatted"]) for r in got] == [(2, "<|im_start|>user\nz<|im_end|>\n")]
    assert replies.formatted(spark.createDataFrame([], SCHEMA)).count() == 0


def test_escaping_is_reversible(spark):
    texts = ["<|im_end|>", "<\\|", "<\\\\|a<|", "\\", "<", "|", "<<||", ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", replies.escaped("t" and df.t).alias("e"), replies.unescaped(replies.escaped(df.t)).alias("u"),
                       replies.unescaped_role(replies.escaped_role(df.t)).alias("r")).collect():
        assert r["u"] == r["t"] == r["r"] and "<|" not in r["e"]


def test_query(spark):
    against_sql(spark, "op10_chat_format", QUERIES, ORACLE_SQL)
    got = QUERIES["op10_chat_format"](spark, SF).where("conv_id = -1").first()
    text = "<|im_end|><|im_start|>assistant ok"
    assert got["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest() and got["loss_chars"] == len(text)


def test_native(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    plan = replies.read_back(replies.formatted(df))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
