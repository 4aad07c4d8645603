"""Each lookup against comparing everything with everything."""

import random
import re

import pytest
from pyspark.sql import functions as F

import columnlens as cl
from columnlens.operators import common, matching


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def similar(a, b, parts=(4, 5)):
    """1 - distance / longer >= parts, in whole numbers."""
    longer = max(len(a), len(b))
    return parts[1] * (longer - edit_distance(a, b)) >= parts[0] * longer


def random_words(rng, n, longest=14):
    stems = ["".join(rng.choice("ab") for _ in range(rng.randrange(1, longest))) for _ in range(n // 3)]
    words = set(stems)
    while len(words) < n:
        word = list(rng.choice(stems))
        for _ in range(rng.randrange(1, 4)):
            at = rng.randrange(len(word) + 1)
            word[at : at + rng.randrange(2)] = rng.choice(["", "a", "b", "c"])
        words.add("".join(word))
    return sorted(words - {""})


def dictionary(spark, terms):
    return spark.createDataFrame([("t", t) for t in terms], "label string, term string")


def pairs(frame):
    rows = [(r["value"], r["term"]) for r in frame.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("threshold,parts", [(0.8, (4, 5)), (0.6, (3, 5)), (1.0, (1, 1))])
@pytest.mark.parametrize("large", [False, True])
def test_fuzzy(spark, strings, monkeypatch, large, threshold, parts):
    rng = random.Random(11)
    values, terms = random_words(rng, 90), random_words(rng, 90)
    if large:
        monkeypatch.setattr(matching, "FUZZY_SCAN_TERMS", 0)
    got = pairs(cl.fuzzy_match(strings(values), dictionary(spark, terms), threshold))
    assert got == {(v, t) for v in values for t in terms if similar(v, t, parts)}
    assert got


@pytest.mark.parametrize("large", [False, True])
@pytest.mark.parametrize("broadcast", [False, True])
def test_contains(spark, strings, monkeypatch, large, broadcast):
    rng = random.Random(5)
    values = ["".join(rng.choice("ab ñ") for _ in range(rng.randrange(60))) for _ in range(80)]
    values = sorted(set(values)) + ["x" * 5_000 + "ab" * 20]
    terms = sorted({"".join(rng.choice("ab ñ") for _ in range(rng.randrange(1, 40))) for _ in range(60)})
    terms += ["ab" * 20, "zz"]
    if large:
        monkeypatch.setattr(matching, "CONTAINS_SCAN_TERMS", 0)
    if not broadcast:
        monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    got = pairs(cl.contains_match(strings(values), dictionary(spark, terms)))
    assert got == {(v, t) for v in values for t in terms if t in v}


def test_contains_keeps_repeated_rows(spark, strings, monkeypatch):
    monkeypatch.setattr(matching, "CONTAINS_SCAN_TERMS", 0)
    got = cl.contains_match(strings(["a pub", "a pub", "bar"]), dictionary(spark, ["pub", "bar"]))
    assert sorted((r["value"], r["term"]) for r in got.collect()) == [
        ("a pub", "pub"), ("a pub", "pub"), ("bar", "bar")
    ]


@pytest.mark.parametrize("broadcast", [False, True])
def test_exact(spark, strings, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    values = ["a", "b", "a", None, "c"]
    terms = spark.createDataFrame([("l1", "a"), ("l2", "a"), ("l1", "a"), ("l1", "c")], "label string, term string")
    got = cl.exact_match(strings(values), terms)
    assert sorted((r["value"], r["label"]) for r in got.collect()) == [
        ("a", "l1"), ("a", "l1"), ("a", "l2"), ("a", "l2"), ("c", "l1")
    ]


def test_empty_dictionary(spark, strings):
    none = dictionary(spark, [])
    for match in (cl.exact_match, cl.contains_match, cl.fuzzy_match):
        assert match(strings(["a"]), none).count() == 0


@pytest.mark.parametrize("large", [False, True])
def test_no_lookup_compares_all_pairs(spark, strings, monkeypatch, large):
    if large:
        monkeypatch.setattr(matching, "FUZZY_SCAN_TERMS", 0)
        monkeypatch.setattr(matching, "CONTAINS_SCAN_TERMS", 0)
    values, terms = strings(["a", "b"]), dictionary(spark, ["a", "bb"])
    for match in (cl.exact_match, cl.contains_match, cl.fuzzy_match):
        plan = match(values, terms)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_fuzzy_tokens_of_any_letters(spark, tmp_path):
    """All words count: of one letter, with accents and digits, or in other scripts."""
    from __spark_entry__ import queries

    rng = random.Random(11)
    word = lambda: "".join(rng.choice("aé1ñд日-") for _ in range(rng.randrange(1, 12)))
    stems = [word() for _ in range(60)]
    near = [w[:-1] + rng.choice("aé1") for w in stems] + [w + "x" for w in stems]
    left = stems + ["a", "I", "über", "naïveté", "日本語の文", "r2d2c3"]
    right = near + ["i", "ÜBER", "naivete", "naïvete", "日本語の分", "r2d2c4"]
    for name, words in (("benchmark", left), ("conversations", right)):
        lines = [(" \n".join(words[i : i + 7]) + " ",) for i in range(0, len(words), 7)] + [(None,)]
        spark.createDataFrame(lines, "text string").write.parquet(f"{tmp_path}/{name}.parquet")
    got = {(r["word"], r["label"], r["term"]) for r in queries()["dict_fuzzy_tokens"](spark, str(tmp_path)).collect()}
    a, b = ({w.lower() for w in words} for words in (left, right))
    assert got == {(x, "word", y) for x in a for y in b if similar(x, y)}
    assert {("i", "word", "i"), ("über", "word", "über"), ("日本語の文", "word", "日本語の分")} <= got


@pytest.mark.parametrize("sent", [True, False])
@pytest.mark.parametrize("chunk", [7, 64])
def test_contains_over_chunks(spark, strings, monkeypatch, sent, chunk):
    """Terms of all lengths, across the edges of chunks and blocks, sent along or shuffled."""
    monkeypatch.setattr(matching, "CHUNK", chunk)
    monkeypatch.setattr(matching, "CHUNKS_PER_BLOCK", 3)
    rng = random.Random(8)
    values = ["".join(rng.choice("ab ñ𝄞") for _ in range(rng.randrange(400))) for _ in range(30)] + [None, "", "a"]
    terms = sorted({"".join(rng.choice("ab ñ𝄞") for _ in range(rng.choice([1, 2, 3, 5, 9, 20]))) for _ in range(60)})
    terms += [values[0][5:300], "zz"]
    limits = {"scan_terms": 0} if sent else {"scan_terms": 0, "broadcast_rows": 0}
    got = cl.contains_match(strings(values), dictionary(spark, terms), **limits).collect()
    assert sorted((r["value"], r["term"]) for r in got) == sorted((v, t) for v in values if v for t in terms if t in v)


def test_contains_in_a_long_text(spark, strings):
    text = "".join(f"word{i % 977} " for i in range(600_000)) + "needle in here"
    terms = ["needle in", "word976 word0", "word3 word5", "word12 word13 "]
    got = cl.contains_match(strings([text, "a needle"]), dictionary(spark, terms), scan_terms=0)
    assert sorted(r["term"] for r in got.select("term").collect()) == ["needle in", "word12 word13 ", "word976 word0"]


def test_terms_go_by_their_rarest_gram(spark, strings, monkeypatch):
    monkeypatch.setattr(matching, "SAMPLED_CHUNKS", 1)
    chunks = strings(["common words all over"] * 20 + ["common zebra"], "chunk")
    found = matching._by_rarest_gram(dictionary(spark, ["common zebra"]), chunks).collect()
    gram = found[0]["gram"]
    hashes = {g: spark.range(1).selectExpr(f"xxhash64('{g}')").first()[0] for g in ("common w", "common z")}
    assert len(found) == 1 and gram != hashes["common w"]
    assert gram in {spark.range(1).selectExpr(f"xxhash64('{'common zebra'[i:i + 8]}')").first()[0] for i in range(5)}


def test_exact_with_a_common_value(spark, strings):
    """A value in a third of the rows: no task gets it all, and no row is lost."""
    values = ["hot" if i % 3 == 0 else f"v{i}" for i in range(6_000)] + [None, "", "a"]
    rows = [("l", f"v{i}") for i in range(0, 9_000, 2)] + [("l", "hot"), ("m", "hot"), ("l", ""), ("l", "other")]
    terms = spark.createDataFrame(rows, "label string, term string")
    frame = strings(values).repartition(8)
    assert matching._hot_values(frame, "value") == ["hot"]
    assert matching._hot_values(strings(["a b", "c"] * 3), "value") == ["a b", "c"]
    assert matching._hot_values(strings([None, None]), "value") == []
    found = cl.exact_match(frame, terms, broadcast_rows=0)
    got = sorted((r["value"], r["label"]) for r in found.collect())
    assert got == sorted((v, l) for v in values if v is not None for l, t in rows if t == v)
    name = "spark.sql.adaptive.enabled"
    try:
        spark.conf.set(name, "false")
        spread = cl.exact_match(frame, terms, broadcast_rows=0).groupBy(F.spark_partition_id()).count()
        sizes = sorted(r["count"] for r in spread.collect())
    finally:
        spark.conf.unset(name)
    assert sizes[-1] < 2.5 * sizes[len(sizes) // 2]


def test_only_grams_of_terms_become_values(spark, strings):
    """What passes holds every wanted gram of every text, and hardly any other."""
    from columnlens.operators import grams

    rng = random.Random(4)
    texts = ["".join(rng.choice("abcdefgh ñ𝄞") for _ in range(rng.randrange(300))) for _ in range(60)] + ["", None, "a"]
    wanted = {t[i : i + w] for t in texts[:9] if t for w in (1, 2, 4, 8) for i in [rng.randrange(max(1, len(t) - 8))] if len(t) > 16}
    bits = grams.filter_of(strings(sorted(wanted), "run"), "run", (1, 2, 4, 8))
    listed = grams.possible(strings(texts, "chunk"), "chunk", (1, 2, 4, 8), bits).collect()
    want = {(t, t[i : i + w]) for t in texts if t for w in (1, 2, 4, 8) for i in range(len(t) - w + 1) if t[i : i + w] in wanted}
    got = [(r["chunk"], g) for r in listed for g in r["grams"]]
    assert len(got) == len(set(got)) and want <= set(got) and len(got) < len(want) + 20
    plan = cl.contains_match(strings(["a", "b"]), dictionary(spark, ["a", "bb"]), scan_terms=0)._jdf.queryExecution().toString()
    assert "regexp_extract_all" not in plan and "MapInArrow" in plan


def test_terms_are_grams_themselves(spark, strings):
    """Numbers and filter of grams of any width; a common part of a term brings no other text to it."""
    from columnlens.operators import grams

    rng = random.Random(6)
    text = "".join(rng.choice("ab ñ𝄞") for _ in range(400))
    for widths in (range(1, 17), (3, 7, 16), (5,)):
        for width, found in grams.numbers(text, widths):
            places = {}
            for i, n in enumerate(found.tolist()):
                places.setdefault(text[i : i + width], set()).add(n)
            assert len(found) == len(text) - width + 1 and width in widths
            assert all(len(own) == 1 for own in places.values()) and len(set.union(*places.values())) == len(places)
    assert [w for w, _ in grams.numbers("abc", (2, 3, 4, 9))] == [2, 3]
    # eight characters of every term are in every text, the terms in none
    texts = ["the house of this and that, in the end, is " + str(i) for i in range(40)]
    terms = ["house of thin", "this and those", "in the en,"]
    width = [len(t) for t in terms]
    bits = grams.filter_of(strings(terms, "run"), "run", width)
    assert grams.possible(strings(texts, "chunk"), "chunk", width, bits).count() == 0
    found = cl.contains_match(strings(texts), dictionary(spark, terms), scan_terms=0, broadcast_rows=0)
    plan = found._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
    assert found.count() == 0 and dealt and not any("digest#" in d and "label#" in d for d in dealt)


def test_filter_lets_few_others_pass(spark, strings):
    from columnlens.operators import grams

    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(8))
    bits = grams.filter_of(strings([word() for _ in range(20_000)], "run"), "run", (8,))
    listed = grams.possible(strings([word() * 2 for _ in range(2_000)], "chunk"), "chunk", (8,), bits)
    assert sum(len(r["grams"]) for r in listed.collect()) < 60  # of 16,000; one in 50 by a single filter
