"""Looking values up in a dictionary of ``label, term``: whole, inside, or nearly.

All three return one row per hit: the value's columns plus ``label, term``.
Values and terms are compared as given; lower-case both for a lookup that
ignores case.  Small dictionaries travel to the values, large ones meet them in
a shuffle on a key that any hit must share.  No way compares everything with
everything.
"""

from __future__ import annotations

import json
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions import similarity_reach
from . import grams as runs
from .common import BROADCAST_BYTES, BROADCAST_ROWS, broadcast_if_small, measured, quoted

# Up to this many terms a value is compared with all terms of similar length;
# beyond, only with those that share a piece with it.
FUZZY_SCAN_TERMS = 2_000
# Up to this many terms each is looked for in every text.
CONTAINS_SCAN_TERMS = 1_000
CONTAINS_SCAN_BYTES = 64 * 1024
# Characters of a text in a row while terms are looked for, and such chunks in a wider cut.
CHUNK = 256
CHUNKS_PER_BLOCK = 32
# One in so many blocks is looked at to see which grams are rare.
SAMPLED_CHUNKS = 64
# Widths of the grams by which a longer term is found: the widest that it has.
_GRAM_WIDTHS = (1, 2, 4, 8)
# Up to this many characters a term is a gram itself.
WHOLE_GRAM = 16
# A value in one of so many rows is common enough to be looked up apart.
HOT_SHARE = 200
# Places of the filter that drops values of no term, where the terms are too many to be sent.
TERM_SLOTS = 1 << 20


def exact_match(
    values: DataFrame,
    dictionary: DataFrame,
    on: str = "value",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Values that are a term.  Over ``broadcast_rows`` terms both sides are shuffled.

    Before that, a filter of bounded size drops most values that are no term, and values that
    fill many rows are looked up apart: their few terms travel to them.
    """
    terms = dictionary.select("label", "term").distinct()
    size = measured(terms)
    if size[0] <= broadcast_rows and size[1] <= BROADCAST_BYTES:
        return values.join(F.broadcast(terms), F.col(on) == F.col("term"))
    hot = _hot_values(values, on)
    value = F.col(quoted(on))
    slot = F.pmod(F.xxhash64("term"), F.lit(TERM_SLOTS)).cast("int")
    slots = terms.select(slot.alias("_slot")).distinct()  # TERM_SLOTS rows at most
    own = F.pmod(F.xxhash64(value), F.lit(TERM_SLOTS)).cast("int")
    few = values.join(F.broadcast(slots), own == F.col("_slot"), "left_semi")
    common = value.isin(hot) if hot else F.lit(False)
    rest = few.filter(~common).join(terms.filter(~F.col("term").isin(hot)) if hot else terms, value == F.col("term"))
    if not hot:
        return rest
    sent = broadcast_if_small(terms.filter(F.col("term").isin(hot)), limit=HOT_SHARE * HOT_SHARE)
    return rest.unionByName(few.filter(common).join(sent, value == F.col("term")))


def _hot_values(values: DataFrame, on: str) -> list[str]:
    """Values in at least one of ``HOT_SHARE`` rows, by a summary of frequent items that tasks
    make and merge. There are no more than ``HOT_SHARE`` of them; which they are decides where
    rows meet, not what is found."""
    top = f"approx_top_k({quoted(on)}, {HOT_SHARE}, {32 * HOT_SHARE})"
    seen = values.agg(F.expr(top).alias("top"), F.count(quoted(on)).alias("rows")).first()
    return sorted(r["item"] for r in seen["top"] if r["item"] is not None and r["count"] * HOT_SHARE >= seen["rows"])


def contains_match(
    values: DataFrame,
    dictionary: DataFrame,
    on: str = "value",
    scan_terms: int = CONTAINS_SCAN_TERMS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Values with a term anywhere inside, each (value, term) once.

    A dictionary of up to ``scan_terms`` is tested in place, term by term. For a longer one,
    texts are cut into overlapping chunks, which list the runs of characters (grams) that begin
    at each of their places. A term of up to ``WHOLE_GRAM`` characters is a gram itself; a longer
    one goes by its rarest gram of eight. A filter of bounded size drops the grams that no term
    goes by before they become values. Where the terms can be sent, they are then looked for in
    the chunk; beyond, the grams travel with a 64-bit hash of their text. The last test is on the
    whole text itself, so equal hashes of two texts change nothing.
    """
    terms = dictionary.select("label", "term").filter(F.length("term") > 0).distinct()
    bounds = terms.agg(
        F.min(F.length("term")).alias("shortest"),
        F.max(F.length("term")).alias("longest"),
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.octet_length("term")), F.lit(0)).alias("octets"),
    ).first()
    text = F.col(on)
    if bounds["rows"] <= scan_terms and bounds["octets"] <= CONTAINS_SCAN_BYTES:
        listed = [r.asDict() for r in terms.collect()]  # bounded above
        entries = F.from_json(
            F.lit(json.dumps(listed)), "array<struct<label: string, term: string>>"
        )
        hits = F.filter(entries, lambda t: F.contains(text, t["term"]))
        return values.withColumn("hit", F.explode(hits)).select(
            *values.columns, "hit.label", "hit.term"
        )

    whole = F.length("term") <= WHOLE_GRAM
    width = F.when(whole, F.length("term")).otherwise(_gram_width(F.length("term")))
    widths = [r["width"] for r in terms.select(width.alias("width")).distinct().collect()]  # WHOLE_GRAM at most
    small = bounds["rows"] <= broadcast_rows and bounds["octets"] <= BROADCAST_BYTES
    texts, block = values.select(text.alias("text")), CHUNK * CHUNKS_PER_BLOCK
    rare = terms.filter(whole).select(F.xxhash64("term").alias("gram"), "label", "term")
    if (bounds["longest"] or 0) > WHOLE_GRAM:
        some = _chunks(texts, block, WHOLE_GRAM, SAMPLED_CHUNKS)
        rare = rare.unionByName(_by_rarest_gram(terms.filter(~whole), some))
    run = F.when(whole, F.col("term")).otherwise(_own_gram())
    wanted = runs.filter_of(rare.select(run.alias("run")), "run", widths)
    # terms are only looked for in a chunk if they are sent; else it need not hold a whole one
    pieces = _chunks(texts, max(CHUNK, bounds["longest"] or 0), bounds["longest"] or 0) if small else _chunks(texts, block, WHOLE_GRAM)
    listed = runs.possible(pieces, "chunk", widths, wanted)
    grams = listed.select("digest", "chunk", F.explode("grams").alias("gram")).select("digest", "chunk", F.xxhash64("gram").alias("gram"))
    if small:
        found = grams.join(F.broadcast(rare), "gram").filter(F.contains("chunk", F.col("term")))
        hits = found.select("digest", "label", "term").distinct()
    else:  # a term has one gram, so these are distinct
        hits = grams.select("digest", "gram").distinct().join(rare.hint("merge"), "gram").select("digest", "label", "term")
    return (
        values.withColumn("digest", F.xxhash64(text))
        .join(hits, "digest")
        .filter(F.contains(text, F.col("term")))
        .select(*values.columns, "label", "term")
    )


def _gram_width(length: Column) -> Column:
    """Width of the grams by which a longer term is found."""
    width = F.lit(_GRAM_WIDTHS[0])
    for w in _GRAM_WIDTHS[1:]:
        width = F.when(length >= w, w).otherwise(width)
    return width


def _term_grams() -> Column:
    """All grams of a term, of the width it goes by."""
    width = _gram_width(F.length("term"))
    return F.transform(F.sequence(F.lit(1), F.length("term") - width + 1), lambda at: F.substring("term", at, width))


def _own_gram() -> Column:
    """The text of the gram that a term goes by."""
    return F.get(F.filter(_term_grams(), lambda g: F.xxhash64(g) == F.col("gram")), F.lit(0))


def _chunks(texts: DataFrame, size: int, longest: int, one_in: int = 1) -> DataFrame:
    """``digest, chunk``: texts in pieces, so that a row is small however long its text is.

    Pieces overlap by one character less than ``longest``, so whatever is no longer lies whole
    in one of them. Long texts are cut in steps, as finding a place takes time by its distance.
    Of ``one_in`` pieces one is taken, by a hash of its text's and its place in the last cut.
    """

    def cut(name: str, size: int, one_in: int = 1) -> Column:
        whole = F.col(name)
        starts = F.sequence(F.lit(1), F.greatest(F.length(whole), F.lit(1)), F.lit(size))
        if one_in > 1:
            starts = F.filter(starts, lambda at: F.pmod(F.xxhash64("digest", F.length(whole), at), F.lit(one_in)) == 0)
        parts = F.transform(starts, lambda at: F.substring(whole, at, F.lit(size + longest - 1)))
        return F.explode(parts if one_in > 1 else F.when(F.length(whole) <= size, F.array(whole)).otherwise(parts))

    pieces = texts.select(F.xxhash64("text").alias("digest"), F.col("text").alias("chunk"))
    for times in (CHUNKS_PER_BLOCK**2, CHUNKS_PER_BLOCK):
        pieces = pieces.select("digest", cut("chunk", times * size).alias("chunk"))
    return pieces.select("digest", cut("chunk", size, one_in).alias("chunk"))


def _by_rarest_gram(terms: DataFrame, chunks: DataFrame) -> DataFrame:
    """``gram, label, term``: each term under the hash of the gram of it that fewest chunks have.

    How many have it is counted in a sample of the chunks. This decides how much work there is,
    not what is found: any gram of a term is in every text that holds the term.
    """
    own = terms.select("label", "term", F.explode(F.array_distinct(_term_grams())).alias("run")).withColumn("gram", F.xxhash64("run"))
    wanted = runs.filter_of(own, "run", _GRAM_WIDTHS)
    listed = runs.possible(chunks.select("chunk"), "chunk", _GRAM_WIDTHS, wanted)
    common = (
        listed.select(F.explode("grams").alias("gram"))
        .groupBy(F.xxhash64("gram").alias("gram")).agg(F.count(F.lit(1)).alias("chunks"))
    )
    rated = own.join(common, "gram", "left").select("label", "term", F.struct(F.coalesce("chunks", F.lit(0)).alias("chunks"), "gram").alias("rated"))
    return rated.groupBy("label", "term").agg(F.min("rated").alias("rated")).select("rated.gram", "label", "term")


def fuzzy_match(
    values: DataFrame,
    dictionary: DataFrame,
    threshold: float = fixed.SIMILARITY,
    on: str = "value",
    scan_terms: int | None = None,
) -> DataFrame:
    """Values whose edit similarity to a term is at least ``threshold``.

    Up to ``scan_terms`` terms travel to the values; beyond, both sides meet on pieces.
    """
    terms = dictionary.select("label", "term").filter(F.length("term") > 0).distinct()
    size = terms.agg(*fuzzy_size(threshold)).first()
    if scan_fuzzy(size["rows"], size["octets"], scan_terms):
        table = terms_by_length(terms, threshold, ["label"])
        joined = values.join(
            F.broadcast(table), F.length(on) == F.col("value_length")
        )
        return (
            joined.withColumn("hit", F.explode(near_terms(F.col(on), F.col("terms"))))
            .select(*values.columns, "hit.label", "hit.term")
        )
    found = share_a_piece(values.select(on).distinct(), terms, on, "term", [], threshold)
    return values.join(found, on).select(*values.columns, "label", "term")


def fuzzy_size(threshold: float) -> list[Column]:
    """Aggregates: ``rows`` of a dictionary, and ``octets`` once listed by length."""
    shortest, longest = _lengths_near(F.length("term"), threshold)
    listed = (longest - shortest + 1).cast("bigint") * F.octet_length("term")
    return [
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(listed), F.lit(0)).alias("octets"),
    ]


def scan_fuzzy(rows: int, octets: int, limit: int | None = None) -> bool:
    """Whether a dictionary is small enough to travel to the values by length."""
    return rows <= (FUZZY_SCAN_TERMS if limit is None else limit) and octets <= BROADCAST_BYTES


def terms_by_length(terms: DataFrame, threshold: float, carried: list[str]) -> DataFrame:
    """For each length of a value, the terms it may be similar to and how far off.

    One row per length, so looking it up adds no rows.  ``carried`` columns come
    first in each entry and set the order.
    """
    length = F.length("term")
    shortest, longest = _lengths_near(length, threshold)
    reach = similarity_reach(F.greatest(length, F.col("value_length")), threshold)
    return (
        terms.withColumn("value_length", F.explode(F.sequence(shortest, longest)))
        .withColumn("reach", reach)
        .groupBy("value_length")
        .agg(F.array_sort(F.collect_list(F.struct(*carried, "term", "reach"))).alias("terms"))
    )


def near_terms(value: Column, terms: Column) -> Column:
    """The entries of ``terms_by_length`` that are similar to ``value``."""
    return F.filter(
        terms, lambda t: F.call_function("levenshtein", value, t["term"], t["reach"]) >= 0
    )


def share_a_piece(
    left: DataFrame,
    right: DataFrame,
    left_on: str,
    right_on: str,
    keys: list[str],
    threshold: float,
) -> DataFrame:
    """Similar pairs of two large sides, by an equality join.

    With at most ``d`` edits, a term cut into ``d + 1`` pieces has one piece
    that is unchanged in the value.  Piece ``i`` can be taken to have at most
    ``i`` edits before it and ``d - i`` after it (the multi-match-aware window
    of Pass-Join, VLDB 2012), which leaves it few places.  Both sides list the
    pieces they could share, with the two lengths and the place; a join on these
    finds every similar pair, and the edit distance decides.
    """
    lengths = right.agg(
        F.min(F.length(right_on)).alias("least"), F.max(F.length(right_on)).alias("most")
    ).first()
    value, term = F.col(left_on), F.col(right_on)
    term_length, value_length = F.col("term_length"), F.col("value_length")
    edits = similarity_reach(F.greatest(term_length, value_length), threshold)
    part = F.col("part")
    # part i of n begins after i*len/n characters; the last ones take the rest
    begins = F.floor(term_length * part / (F.col("edits") + 1)).cast("int")
    ends = F.floor(term_length * (part + 1) / (F.col("edits") + 1)).cast("int")

    def with_parts(side: DataFrame, text: Column, own: str, other: str) -> DataFrame:
        shortest, longest = _lengths_near(F.length(text), threshold)
        if own == "value_length":  # only lengths that terms have
            shortest = F.greatest(shortest, F.lit(lengths["least"] or 0))
            longest = F.least(longest, F.lit(lengths["most"] or 0))
        return (
            side.filter((F.length(text) > 0) & (shortest <= longest))
            .withColumn(own, F.length(text))
            .withColumn(other, F.explode(F.sequence(shortest, longest)))
            .withColumn("edits", edits)
            .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("edits"))))
            .withColumn("begin", begins)
            .withColumn("size", ends - begins)
        )

    shared = [*keys, "term_length", "value_length", "part", "piece"]
    term_pieces = (
        with_parts(right, term, "term_length", "value_length")
        .withColumn("piece", F.substring(term, F.col("begin") + 1, F.col("size")))
        .drop("edits", "begin", "size")
    )
    begin, after = F.col("begin"), F.col("edits") - part
    moved = begin + value_length - term_length  # place if all edits come before
    first = F.greatest(F.lit(0), begin - part, moved - after)
    last = F.least(value_length - F.col("size"), begin + part, moved + after)
    value_pieces = (
        with_parts(left, value, "value_length", "term_length")
        .filter(first <= last)
        .withColumn(
            "piece",
            F.explode(
                F.array_distinct(
                    F.transform(
                        F.sequence(first, last),
                        lambda i: F.substring(value, i + 1, F.col("size")),
                    )
                )
            ),
        )
        .drop("begin", "size")
    )
    near = F.call_function("levenshtein", value, term, F.col("edits")) >= 0
    found = value_pieces.join(term_pieces, shared).filter(near)
    kept = [*left.columns, *[c for c in right.columns if c not in keys]]
    return found.select(*kept).distinct()


def _lengths_near(length: Column, threshold: float) -> tuple[Column, Column]:
    """Shortest and longest text that can be similar to one of this length."""
    share = Fraction(str(threshold))
    n, d = share.numerator, share.denominator
    shortest = F.floor((length * n + (d - 1)) / d).cast("int")
    longest = F.floor(length * d / n).cast("int")
    return shortest, longest
