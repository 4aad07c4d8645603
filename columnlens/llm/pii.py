"""Personal data by weak supervision: labelers vote, their reliability is estimated, a classifier decides.

Spans are of four kinds. *Base* spans follow fixed rules (``base_spans``) and are always kept.
Besides, a text has looser *candidates*: numbers inside longer ones that the rules gave up,
telephone numbers without a plus sign, addresses with a written-out "at", and the like. Every
candidate, base ones included, is voted on (yes, no or abstain) by labelers of three sorts:

* regex: whether the span alone follows its rule, its check digits, and how it is grouped;
* gazetteer: known top-level domains, card issuers, calling codes, reserved address blocks;
* context: words before it, and what it touches on both sides.

The votes of all documents are counted per pattern. Expectation-maximisation over these counts
estimates, per kind, how often each labeler votes which way on true and on false spans, and
with that how likely each pattern is true. A logistic regression on features of the span and its
surroundings (not the votes) learns these likelihoods as soft labels, weighted by how often their
pattern occurs. It decides on the candidates: the likeliest is taken first, and none may touch
a base span or one taken before.

Everything but the sample the regression learns from is over all documents. The sample has up
to ``SAMPLE`` different candidates, spread over the patterns, of which there are at most
``4 * 3 ** len(LABELERS)``.

Defined results. Null text: as an empty one, no spans. Repeated rows: each has its spans. Equal
likelihoods: the earlier span, then the longer. No candidate in any text: no model, base spans
only. All patterns take time in proportion to the text. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import bisect
import itertools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from .storage import saved, text_batches

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 8_000
THRESHOLD = 0.9
FEATURES = 2_048
RIDGE = 1.0
ROUNDS = 60

# --- fixed values: gazetteers of public registries, and words that announce a kind --------------
DOMAINS = frozenset(
    "com org net edu gov mil int info biz io co ai app dev me tv eu uk us ca au nz ie de at ch fr be nl lu es pt it "
    "gr se no dk fi is pl cz sk hu ro bg ru ua tr il in pk cn jp kr tw hk sg my th vn id ph br mx ar cl pe za ng ke eg".split())
CALLING_CODES = frozenset(
    "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 "
    "86 90 91 92 93 94 95 98 212 213 216 218 234 254 351 352 353 354 358 359 370 371 372 380 385 386 420 421 852 886 "
    "961 962 965 966 971 972 974".split())
#: lowest and highest first four digits
ISSUERS = ((2221, 2720), (3000, 3059), (3400, 3499), (3528, 3589), (3600, 3699), (3700, 3799), (3800, 3999),
           (4000, 4999), (5100, 5599), (6011, 6011), (6440, 6599))
CARD_GROUPS = frozenset({(16,), (4, 4, 4, 4), (15,), (4, 6, 5), (14,), (4, 6, 4), (19,), (4, 4, 4, 4, 3)})
WORDS = {
    "email": frozenset("email mail e-mail address contact write courriel correo adresse".split()),
    "ip": frozenset("ip ipv4 ipv6 address host server client login addr adresse".split()),
    "card": frozenset("card visa mastercard amex credit debit pan carte karte tarjeta payment".split()),
    "phone": frozenset("phone tel telephone call mobile fax cell whatsapp telefon téléphone teléfono".split()),
}
AGAINST = frozenset("version v ver release isbn issn order invoice sku serial build section chapter doi uuid ref".split())
# ------------------------------------------------------------------------------------------------

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# a number in groups, with up to three signs between groups
_RUN = re.compile(r"(?<![0-9])[0-9]+(?:[  ().\-/]{1,3}[0-9]+)*")
_GROUP = re.compile(r"[0-9]+")
_AT = re.compile(r"(?i)(?:\s?[\[({]\s?at\s?[\])}]\s?|\sat\s|＠)(?=([A-Za-z0-9-]+(?:(?:\s?[\[({]\s?dot\s?[\])}]\s?|\sdot\s|\.)[A-Za-z0-9-]+)+))")
_DOT = re.compile(r"(?i)\s?[\[({]\s?dot\s?[\])}]\s?|\sdot\s|\.")
_DEFANGED = re.compile(r"(?<![0-9])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|\s\.\s|\[dot\])[0-9]{1,3}){3}(?![0-9])")
_HEX = re.compile(r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{1,4}(?:::?[0-9A-Fa-f]{1,4}){2,7}(?![0-9A-Za-z:])")
_WORD = re.compile(r"[^\W_]+(?:-[^\W_]+)*")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = (ord(c) - 48) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _small(part: str) -> bool:
    """Whether a decimal number is at most 255, however many zeros it begins with."""
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``start, kind, end`` of the spans that the rules find, in that order.

    Each kind leftmost and non-overlapping: email ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``;
    ip, four numbers with dots, each at most 255; card, 14 to 19 digits with single blanks or
    dashes that pass Luhn; phone, 10 to 15 digits after a plus. What fails is dropped as a whole.
    """
    found = []
    at, done = text.find("@"), 0
    while at >= 0:
        begin = done + len(text[done:at].rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            found.append((begin, 0, domain.end()))
            done = domain.end()
        else:
            done = at + 1
        at = text.find("@", done)
    for m in _IP.finditer(text):
        if all(_small(p) for p in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _digits(m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_digits(m.group())) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def _numbers(text: str, run: re.Match) -> Iterator[tuple[int, int, int]]:
    """Cards and telephone numbers that may lie within a run of number groups."""
    groups = [(run.start() + m.start(), run.start() + m.end()) for m in _GROUP.finditer(run.group())]
    for i, (start, _) in enumerate(groups):
        total, sizes = 0, []
        for begin, end in groups[i : i + 7]:
            total += end - begin
            sizes.append(end - begin)
            if total > 19:
                break
            if total >= 14 and (tuple(sizes) in CARD_GROUPS or luhn(_digits(text[start:end]))):
                yield start, 2, end
            if 10 <= total <= 15:
                first = start - (text[start - 1 : start] == "(")
                plus = text[first - 1 : first] == "+"
                if plus or sizes[-2:] == [3, 4] or first < start or len(sizes) > 3 and set(sizes) == {2} or \
                        text[start : start + 2] == "00" and len(sizes) > 1:
                    yield first - plus, 3, end


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """``start, kind, end`` of looser spans that touch no base span."""
    found = set()
    for m in _AT.finditer(text):
        first = max(0, m.start() - 64)
        begin = first + len(text[first : m.start()].rstrip(_LOCAL))
        if begin < m.start():
            found.add((begin, 0, m.end(1)))
    for m in _DEFANGED.finditer(text):
        found.add((m.start(), 1, m.end()))
    if ":" in text:
        for m in _HEX.finditer(text):  # a time of day has fewer groups and no "::"
            if "::" in m.group() or m.group().count(":") == 7:
                found.add((m.start(), 1, m.end()))
    for m in _RUN.finditer(text):
        if m.end() - m.start() < 7:
            continue
        found.update(_numbers(text, m))
        dotted = m.group().split(".")
        if len(dotted) > 4 and all("0" <= c <= "9" or c == "." for c in m.group()):
            at = m.start()
            for k in range(len(dotted) - 3):
                four = dotted[k : k + 4]
                if all(p and _small(p) for p in four):
                    found.add((at, 1, at + sum(map(len, four)) + 3))
                at += len(dotted[k]) + 1
    if not found:
        return []
    covered: list[tuple[int, int]] = []
    for s, _, e in base:
        if covered and s < covered[-1][1]:
            covered[-1] = (covered[-1][0], max(e, covered[-1][1]))
        else:
            covered.append((s, e))
    return sorted(c for c in found if not _touches(c[0], c[2], covered))


def _touches(start: int, end: int, covered: list[tuple[int, int]]) -> bool:
    """Whether a span meets one of some sorted, separate intervals."""
    at = bisect.bisect_left(covered, (end,))
    return at > 0 and covered[at - 1][1] > start


# --- labelers: 1 yes, -1 no, 0 abstain ------------------------------------------------------------


def _by_rule(text: str, start: int, kind: int, end: int) -> int:
    """Whether the span alone is one base span of its kind."""
    return int((0, kind, end - start) in base_spans(text[start:end]))


def _by_check(text: str, start: int, kind: int, end: int) -> int:
    own = text[start:end]
    if kind == 2:
        return 1 if luhn(_digits(own)) else -1
    if kind == 1 and ":" not in own:
        return 1 if all(_small(p) for p in _GROUP.findall(own)) else -1
    return 0


def _by_grouping(text: str, start: int, kind: int, end: int) -> int:
    own = text[start:end]
    sizes = tuple(len(p) for p in _GROUP.findall(own))
    if kind == 2:
        return 1 if sizes in CARD_GROUPS and len({c for c in own if not "0" <= c <= "9"}) < 2 else -1
    if kind == 3:
        if own[0] == "+" or own[:2] == "00":
            return 1 if sizes[0] <= 4 and max(sizes) <= 10 else -1
        return 1 if sizes in ((3, 3, 4), (1, 3, 3, 4)) or set(sizes) == {2} else -1
    if kind == 1:
        return 1 if sizes and max(sizes) <= 3 else -1
    return 1 if len(own) <= 254 else -1


def _by_gazetteer(text: str, start: int, kind: int, end: int) -> int:
    own = text[start:end]
    if kind == 0:
        return 1 if _DOT.split(own)[-1].lower() in DOMAINS else -1
    if kind == 1:
        if ":" in own:
            return 1 if own[:1] in "23fF" else -1
        first = _GROUP.search(own).group().lstrip("0")
        return -1 if first in ("", "255") else 1
    digits = _digits(own)
    if kind == 2:
        first = int(digits[:4])
        return 1 if any(a <= first <= b for a, b in ISSUERS) else -1
    international = digits[2:] if digits.startswith("00") else digits if own[0] == "+" else None
    if international is not None:
        return 1 if any(international[:k] in CALLING_CODES for k in (1, 2, 3)) else -1
    national = digits[1:] if len(digits) == 11 and digits[0] == "1" else digits
    return 1 if len(national) == 10 and (national[0] == "0" or national[0] > "1" and national[3] > "1") else -1


def _words_before(text: str, start: int) -> list[str]:
    return [w.lower() for w in _WORD.findall(text[max(0, start - 48) : start])][-4:]


def _by_words(text: str, start: int, kind: int, end: int) -> int:
    near = _words_before(text, start)
    if any(w in WORDS[KINDS[kind]] for w in near):
        return 1
    return -1 if any(w in AGAINST for w in near[-2:]) else 0


def _by_sides(text: str, start: int, kind: int, end: int) -> int:
    """What touches the span: nothing, or a letter, digit or sign that carries on."""
    before, after = text[max(0, start - 2) : start], text[end : end + 2]
    if before[-1:].isalnum() or after[:1].isalnum() or before[-1:] in tuple("_=#/\\@+"):
        return -1
    joins = tuple("-./")
    joined = before[-1:] in joins and before[:-1].isdigit() or after[:1] in joins and after[1:].isdigit()
    return -1 if joined else 1


LABELERS = (_by_rule, _by_check, _by_grouping, _by_gazetteer, _by_words, _by_sides)


def votes(text: str, start: int, kind: int, end: int) -> int:
    """The votes of all labelers as one number, three values a digit."""
    code = 0
    for labeler in LABELERS:
        code = 3 * code + 1 + labeler(text, start, kind, end)
    return code


def _split(code: int) -> list[int]:
    out = []
    for _ in LABELERS:
        code, v = divmod(code, 3)
        out.append(v)
    return out[::-1]


def reliabilities(counts: dict[tuple[int, int], int], rounds: int = ROUNDS) -> dict[tuple[int, int], float]:
    """Likelihood that a span of ``(kind, votes)`` is true, by expectation-maximisation.

    Labelers are taken to vote independently, given whether a span is true. It begins from the
    share of yes among the votes cast. Every rate starts from one imagined vote each way.
    """
    out = {}
    for kind in range(len(KINDS)):
        patterns = sorted(v for k, v in counts if k == kind)
        if not patterns:
            continue
        weight = np.array([counts[kind, v] for v in patterns], float)
        cast = np.eye(3)[np.array([_split(v) for v in patterns])]  # pattern, labeler, vote
        yes, no = cast[:, :, 2].sum(1), cast[:, :, 0].sum(1)
        true = (yes + 0.5) / (yes + no + 1)
        for _ in range(rounds):
            rate = []
            for side in (true, 1 - true):
                seen = np.einsum("p,plv->lv", weight * side, cast) + 1
                rate.append(seen / seen.sum(1, keepdims=True))
            share = np.array([(weight * true).sum() + 1, (weight * (1 - true)).sum() + 1])
            share = np.log(share / share.sum())
            log = [np.einsum("plv,lv->p", cast, np.log(r)) + s for r, s in zip(rate, share)]
            true = 1 / (1 + np.exp(np.clip(log[1] - log[0], -50, 50)))
        out.update(((kind, v), float(t)) for v, t in zip(patterns, true))
    return out


# --- the classifier -----------------------------------------------------------------------------


def _side(c: str) -> str:
    return "edge" if not c else "blank" if c.isspace() else "digit" if c.isdigit() else "letter" if c.isalpha() else c


def features(text: str, start: int, kind: int, end: int) -> list[int]:
    """Hashed features: n-grams of the shape, group sizes, check digits, beginning and ending of
    the span, what stands on both sides, and the words around it."""
    own = text[start:end]
    # digits keep their number, letters of a word do not
    shape = "^" + re.sub(r"a+", "a", "".join("9" if c.isdigit() else "a" if c.isalpha() else c for c in own)) + "$"
    sizes = [len(p) for p in _GROUP.findall(own)]
    digits = _digits(own)
    named = {shape[i : i + n] for n in (1, 2, 3) for i in range(len(shape) - n + 1)}
    named |= {f"groups {sizes[:8]}", f"digits {min(len(digits), 24)}", f"first {own[:1] if kind else ''}",
              f"before {_side(text[start - 1 : start] if start else '')}", f"after {_side(text[end : end + 1])}"}
    if kind == 0:
        named.add("domain " + _DOT.split(own)[-1].lower())
    if kind == 1:
        named |= {f"small {all(_small(p) for p in _GROUP.findall(own))}", f"zero {digits[:1] == '0'}"}
    if kind == 2:
        named |= {f"luhn {luhn(digits)}", f"issuer {digits[:1]}", f"issuer {digits[:2]}"}
    if kind == 3:
        named |= {f"code {digits[:2]}", f"area {digits[-10:-9]}", f"exchange {digits[-7:-6]}"}
    named |= {f"word {w}" for w in _words_before(text, start)[-2:]}
    return sorted({zlib.crc32(f"{kind} {n}".encode("utf-8", "surrogatepass")) % FEATURES for n in named})


def _dense(rows: list[list[int]]) -> np.ndarray:
    out = np.zeros((len(rows), FEATURES + 1))
    out[:, FEATURES] = 1
    for i, r in enumerate(rows):
        out[i, r] = 1
    return out


def regression(x: np.ndarray, likely: np.ndarray, weight: np.ndarray, ridge: float = RIDGE, steps: int = 25) -> np.ndarray:
    """Weights of a logistic regression on soft labels, by Newton's method."""
    used = np.flatnonzero(x.any(0))
    x = x[:, used]
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - likely)) + ridge * w
        bend = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w -= step * min(1.0, 4 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    out = np.zeros(FEATURES + 1)
    out[used] = w
    return out


def _voted(batches: Iterator[pa.RecordBatch]):
    """Kind, votes and features of every candidate and base span."""
    for batch in batches:
        kinds, codes, held = [], [], []
        for text in batch.column(0).to_pylist():
            if not text:
                continue
            base = base_spans(text)
            for start, kind, end in itertools.chain(base, candidates(text, base)):
                kinds.append(kind)
                codes.append(votes(text, start, kind, end))
                held.append(features(text, start, kind, end))
        yield pa.RecordBatch.from_arrays(
            [pa.array(kinds, pa.int32()), pa.array(codes, pa.int32()), pa.array(held, pa.list_(pa.int32()))],
            names=["kind", "votes", "features"])


def fit(documents: DataFrame, text: str = "text", sample: int = SAMPLE) -> np.ndarray | None:
    """The classifier's weights, learned from the votes over all documents; None without candidates.

    The driver gets one count per pattern of votes, and the sample.
    """
    texts = documents.select(F.col(f"`{text}`").alias("text"))
    seen = saved(text_batches(texts).mapInArrow(_voted, "kind int, votes int, features array<int>"), "votes")
    counts = {(r["kind"], r["votes"]): r["n"] for r in seen.groupBy("kind", "votes").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    likely = reliabilities(counts)
    each = max(1, sample // len(counts))
    order = Window.partitionBy("kind", "votes").orderBy(F.xxhash64("features"), "features")
    chosen = seen.distinct().withColumn("at", F.row_number().over(order)).where(F.col("at") <= each).drop("at").collect()
    chosen.sort(key=lambda r: (r["kind"], r["votes"], r["features"]))
    taken = {}
    for r in chosen:
        taken[r["kind"], r["votes"]] = taken.get((r["kind"], r["votes"]), 0) + 1
    key = [(r["kind"], r["votes"]) for r in chosen]
    # a pattern weighs by the root of its count, so that common ones don't drown the others
    weight = np.array([counts[k] ** 0.5 / taken[k] for k in key])
    weight *= len(chosen) / weight.sum()
    return regression(_dense([r["features"] for r in chosen]), np.array([likely[k] for k in key]), weight)


def decided(text: str, weights: np.ndarray | None, threshold: float = THRESHOLD) -> list[tuple[int, int, int, bool, float]]:
    """``start, kind, end, base, likelihood`` of all spans of a text, in that order."""
    base = base_spans(text)
    found = [(*b, True, 1.0) for b in base]
    if weights is None:
        return found
    scored = []
    for start, kind, end in candidates(text, base):
        z = weights[features(text, start, kind, end)].sum() + weights[FEATURES]
        p = float(1 / (1 + np.exp(-np.clip(z, -30, 30))))
        if p >= threshold:
            scored.append((-p, start, -end, kind))
    taken: list[tuple[int, int]] = []
    for p, start, end, kind in sorted(scored):
        if not _touches(start, -end, taken):
            bisect.insort(taken, (start, -end))
            found.append((start, kind, -end, False, -p))
    return sorted(found)


def with_spans(documents: DataFrame, weights: np.ndarray | None, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """All columns and ``spans``: an array of ``kind, start, end, base, likelihood`` by start."""
    documents = documents.drop("spans")
    entry = "struct<kind: string, start: int, end: int, base: boolean, likelihood: double>"
    out = StructType([*documents.schema.fields, *StructType.fromDDL(f"spans array<{entry}>").fields])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                               ("base", pa.bool_()), ("likelihood", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            rows = [
                [{"kind": KINDS[k], "start": s, "end": e, "base": b, "likelihood": p} for s, k, e, b, p in decided(t or "", weights, threshold)]
                for t in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, kind)], names=[*batch.schema.names, "spans"])

    return text_batches(documents).mapInArrow(run, out)


def found(documents: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``with_spans`` by a classifier learned from the same documents."""
    return with_spans(documents, fit(documents, text), text, threshold)
