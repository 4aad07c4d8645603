"""SentencePiece encoding by a streaming Viterbi search, and decoding.

The best segmentation is that with the highest sum of piece scores. Characters come one
after another; the search keeps scores for as many places as the longest piece has
characters, and back pointers only from the last boundary that all surviving paths share:
as soon as they meet at one, the pieces before it are final and given out.

White space and line feeds give such boundaries at once: no piece of the table goes over
them (this is checked when the table is read), so every path has a boundary there. Each
run between two of them is therefore searched once per worker and kept. New runs are searched
together, cut wherever no piece has two characters side by side: numpy takes the same step of
all of them at once.

Characters without a piece of their own score ``UNKNOWN`` below the lowest piece and are
written as bytes, as is U+2581 in a text, which would decode as a space. So decoding gives
back every text exactly.

The table may come from a model made for merging; its scores are then ranks, and the best
sum is not always what merging gives.

Defined results. Null text: null ids, and null again. Empty text: no ids. Equal sums: the
longer last piece. Repeated rows are encoded alike.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from .storage import BATCH_ROWS, text_batches
from .wordids import WordIds, lots, spread

SPACE = "▁"
#: stands for U+2581 of a text; no valid text has a lone surrogate
LITERAL = "\udfff"
UNKNOWN = 10.0
#: bytes of text that are encoded at once; four processes of an executor keep runs
LOT_BYTES = 2 << 20
#: begins the key of a run that no space begins
BARE = "\x01"
_RUNS = re.compile(" *[^ \n]+| +|\n")
_tables: dict = {}


class Table:
    """Pieces with their scores, read from a model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces: dict[str, tuple[int, float]] = {}
        self.bytes_of: list[bytes] = []
        self.byte_id = [0] * 256
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_id[int(piece[3:-1], 16)] = i
                self.bytes_of.append(bytes([int(piece[3:-1], 16)]))
            elif model.is_control(i) or model.is_unknown(i):
                self.bytes_of.append(b"")
            else:
                self.pieces[piece] = (i, model.get_score(i))
                self.bytes_of.append(piece.replace(SPACE, " ").encode())
        self.longest = max(map(len, self.pieces))
        self.unknown = min(score for _, score in self.pieces.values()) - UNKNOWN
        self.begins = {p[:n] for p in self.pieces for n in range(1, len(p) + 1)}
        #: no piece goes on after a line feed or from a letter to white space
        self.parted = not any("\n" in p or SPACE in p.lstrip(SPACE) for p in self.pieces)

    def unknown_ids(self, char: str) -> list[int]:
        return [self.byte_id[b] for b in (SPACE if char == LITERAL else char).encode()]


class Search:
    """One text, character by character: ``push`` and ``finish`` give out final ids."""

    def __init__(self, table: Table):
        self.table = table
        self.base = 0  # place of the last shared boundary
        self.text = ""  # characters from there on
        self.best = [0.0]  # score of the best path to each place from there on
        self.back: list[tuple[int, int]] = [(0, -1)]  # where its last piece begins; its id
        self.check = 0

    def push(self, char: str) -> list[int]:
        table, pieces = self.table, self.table.pieces
        self.text += char
        end = len(self.text)
        score, begin, piece = None, end - 1, -1
        for start in range(max(0, end - table.longest), end):
            found = pieces.get(self.text[start:end])
            if found is not None:
                total = self.best[start] + found[1]
            elif start == end - 1:
                found, total = (-1, 0.0), self.best[start] + table.unknown
            else:
                continue
            if score is None or total > score:
                score, begin, piece = total, start, found[0]
        self.best.append(score)
        self.back.append((begin, piece))
        self.check += 1
        if self.check < table.longest:
            return []
        self.check = 0
        return self._commit(self._shared())

    def _shared(self) -> int:
        """The last boundary of all paths that a later character can go on from."""
        ends = set(range(max(0, len(self.text) - self.table.longest + 1), len(self.text) + 1))
        while len(ends) > 1:
            last = max(ends)
            ends.discard(last)
            ends.add(self.back[last][0])
        return ends.pop()

    def _commit(self, end: int) -> list[int]:
        out: list[list[int]] = []
        at = end
        while at > 0:
            begin, piece = self.back[at]
            out.append([piece] if piece >= 0 else self.table.unknown_ids(self.text[begin:at]))
            at = begin
        if end:
            self.text = self.text[end:]
            self.best = self.best[end:]
            self.back = [(0, -1)] + [(b - end, p) for b, p in self.back[end + 1 :]]
            self.base += end
        return [i for ids in reversed(out) for i in ids]

    def finish(self) -> list[int]:
        return self._commit(len(self.text))


def streamed(table: Table, chars: Iterable[str]) -> Iterator[int]:
    """Ids of a stream of characters (white space already as U+2581)."""
    search = Search(table)
    for c in chars:
        yield from search.push(c)
    yield from search.finish()


def _short(table: Table, run: str) -> list[int]:
    """As ``streamed`` for a run that fits into memory: forward over known beginnings."""
    pieces, begins, n = table.pieces, table.begins, len(run)
    best: list = [None] * (n + 1)
    best[0] = 0.0
    back = [(0, -1)] * (n + 1)
    for start in range(n):
        base, own = best[start], run[start]
        found = pieces.get(own)
        total = base + (found[1] if found else table.unknown)
        if best[start + 1] is None or total > best[start + 1]:
            best[start + 1], back[start + 1] = total, (start, found[0] if found else -1)
        if own not in begins:
            continue
        for end in range(start + 2, min(start + table.longest, n) + 1):
            part = run[start:end]
            if part not in begins:
                break
            found = pieces.get(part)
            if found:
                total = base + found[1]
                if best[end] is None or total > best[end]:
                    best[end], back[end] = total, (start, found[0])
    out, at = [], n
    while at > 0:
        begin, piece = back[at]
        out.append([piece] if piece >= 0 else table.unknown_ids(run[begin:at]))
        at = begin
    return [i for ids in reversed(out) for i in ids]


#: parts of runs with more characters go through the search piecemeal
SHORT = 64
#: places of parts that are searched at the same time, for 13 bytes each
PLACES = 1_000_000


def _found(keys: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of numbers among sorted ones, and whether they are there."""
    place = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return place, keys[place] == asked


class Together:
    """The search for many runs at once, over the table as arrays.

    The beginnings of pieces are numbered (0 begins all); characters are numbered from 1 on,
    and 0 is one of no piece.
    """

    def __init__(self, table: Table):
        self.table = table
        chars = sorted({c for p in table.pieces for c in p})
        self.n = len(chars) + 1
        number = {c: i for i, c in enumerate(chars, 1)}
        self.char = np.zeros(ord(chars[-1]) + 2, np.int64)  # by code point; the last is for all beyond
        self.char[[ord(c) for c in chars]] = range(1, self.n)
        nodes = {"": 0} | {p: i for i, p in enumerate(sorted(table.begins), 1)}
        steps = sorted((nodes[p[:-1]] * self.n + number[p[-1]], i) for p, i in nodes.items() if p)
        self.steps, self.node = np.array(steps, np.int64).T.copy()
        found = [table.pieces.get(p, (-1, 0.0)) for p in nodes]
        self.piece, self.score = np.array([f[0] for f in found], np.int32), np.array([f[1] for f in found])
        pairs = {(a, b) for p in table.pieces for a, b in zip(p, p[1:])}
        self.pairs = np.sort(np.array([number[a] * self.n + number[b] for a, b in pairs] or [-1], np.int64))
        first, there = _found(self.steps, np.arange(self.n))
        self.first = np.where(there, self.node[first], 0)  # after one character
        self.own = np.where(there, self.piece[self.first], -1)  # pieces of one character

    def encode(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all runs one after another, and the number of each's."""
        text = "".join(runs)
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        chars = self.char[np.minimum(points, len(self.char) - 1)]
        begins = np.zeros(len(chars) + 1, bool)
        begins[1:-1] = ~_found(self.pairs, chars[:-1] * self.n + chars[1:])[1]
        ends = np.cumsum(np.fromiter(map(len, runs), np.int64, len(runs)))
        begins[0] = begins[ends] = True
        at = np.flatnonzero(begins)  # of the parts
        sizes = np.diff(at)
        odd = np.diff(np.concatenate([[0], np.cumsum(self.own[chars] < 0)])[at]) > 0
        alone = np.flatnonzero(odd | (sizes > SHORT))
        together = np.flatnonzero(~odd & (sizes <= SHORT))
        together = together[np.argsort(-sizes[together], kind="stable")]  # like lengths side by side
        begin, counts = np.zeros((2, len(sizes)), np.int64)
        lists, i = [np.zeros(0, np.uint32)], 0
        while i < len(together):
            lot = together[i : i + max(1, PLACES // int(sizes[together[i]] + 1))]
            found, counts[lot] = self._search(chars, at[lot], sizes[lot])
            lists.append(found)
            i += len(lot)
        flat = np.concatenate(lists)
        begin[together] = np.cumsum(counts[together]) - counts[together]
        if len(alone):
            kept: dict[str, list[int]] = {}
            lists = []
            for a, b in zip(at[alone].tolist(), at[alone + 1].tolist()):
                part = text[a:b]
                if part not in kept:
                    kept[part] = _short(self.table, part) if b - a <= SHORT else list(streamed(self.table, part))
                lists.append(kept[part])
            counts[alone] = [len(x) for x in lists]
            begin[alone] = len(flat) + np.cumsum(counts[alone]) - counts[alone]
            flat = np.concatenate([flat, np.array([i for x in lists for i in x], np.uint32)])
        ids, ended = spread(flat, begin, counts)
        return ids, np.diff(np.concatenate([[0], ended[np.searchsorted(at, ends)]]))

    def _search(self, chars: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts, the longest first and the characters of all pieces, and the number of each's."""
        m, longest = len(sizes), int(sizes[0])
        going = np.searchsorted(-sizes, -np.arange(longest + 1), "left").tolist()  # parts longer than that
        best = np.full((longest + 1, m), -np.inf)
        best[0] = 0.0
        piece, size = np.zeros((longest + 1, m), np.int32), np.zeros((longest + 1, m), np.int8)
        for start in range(longest):
            who = np.arange(going[start])
            base, node = best[start], self.first[chars[begin[who] + start]]
            for end in range(start + 1, min(start + self.table.longest, longest) + 1):
                if end > start + 1:
                    who = who[: np.searchsorted(who, going[end - 1])]
                    place, there = _found(self.steps, node[: len(who)] * self.n + chars[begin[who] + end - 1])
                    who, node = who[there], self.node[place[there]]
                if not len(who):
                    break
                total = base[who] + self.score[node]
                better = np.flatnonzero((total > best[end, who]) & (self.piece[node] >= 0))
                to = who[better]
                best[end, to], piece[end, to], size[end, to] = total[better], self.piece[node[better]], end - start
        at, who, found = sizes.copy(), np.arange(m), []
        while len(who):  # back from the ends
            place = at[who]
            found.append((who, piece[place, who]))
            at[who] -= size[place, who]
            who = who[at[who] > 0]
        counts = np.zeros(m, np.int64)
        for who, _ in found:
            counts[who] += 1
        last, ids = np.cumsum(counts) - 1, np.zeros(int(counts.sum()), np.uint32)
        for back, (who, own) in enumerate(found):
            ids[last[who] - back] = own
        return ids, counts


def _run(key: str) -> str:
    """The run of a key, its white space marked."""
    return (key[1:] if key.startswith(BARE) else " " + key).replace(" ", SPACE)


def _key(run: str) -> str:
    """What a run is kept by: most are a word after a space, which is left away."""
    run = run.replace(SPACE, " ")
    return run[1:] if run.startswith(" ") and len(run) > 1 and run[1] != BARE else BARE + run


class Encoder:
    def __init__(self, path: str, room: int = 300_000):
        self.table = table = Table(path)
        self.octets = np.array(table.bytes_of, object)
        together = Together(table)
        self.words = WordIds(lambda keys: together.encode(list(map(_run, keys))), room=room)

    def _runs(self, text: str | None) -> list[str]:
        """Keys of the text's runs, parted where every path has a boundary."""
        if not text:
            return []
        text = text.replace(SPACE, LITERAL)
        if not self.table.parted:
            return [_key(" " + text)]
        words = text.replace("\n", f" {BARE}\n {BARE}")
        if "  " in words or words[0] == " " or words[-1] == " " or BARE in text:
            return [_key(r) for r in _RUNS.findall(" " + text)]
        return words.split(" ")

    def encode(self, texts: list | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each begins (and the end)."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        texts = texts.cast(pa.large_string()).fill_null("")
        if not self.table.parted:
            return self.words.gather(map(self._runs, texts.to_pylist()))
        # most have a single space or a line feed between any two runs, and none of the signs for either
        odd = pc.match_substring_regex(texts, rf"\A[ \n]| [ \n]| \z|[{SPACE}{BARE}]")
        plain = pc.if_else(odd, "", texts)
        ids, at = self.words.gather_lists(pc.split_pattern(pc.replace_substring(plain, "\n", f" {BARE}\n {BARE}"), " "))
        rest = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        if not len(rest):
            return ids, at
        more, begins = self.words.gather(map(self._runs, texts.take(pa.array(rest)).to_pylist()))
        begin, sizes = at[:-1].copy(), np.diff(at)
        begin[rest], sizes[rest] = len(ids) + begins[:-1], np.diff(begins)
        return spread(np.concatenate([ids, more]), begin, sizes)

    def decode(self, ids: list[int] | np.ndarray) -> str:
        text = b"".join(self.octets[ids].tolist()).decode("utf-8", "replace") if len(ids) else ""
        return text[1:] if text.startswith(" ") else text


def _encoder(path: str) -> Encoder:
    """One per Python worker, so that its runs last over tasks."""
    if path not in _tables:
        _tables[path] = Encoder(path)
    return _tables[path]


def encoded(documents: DataFrame, model: str, text: str = "text") -> DataFrame:
    """All columns, and ``ids``: the pieces of the whole text. A column of that name is replaced."""
    documents = documents.drop("ids")
    out = StructType([*documents.schema.fields, *StructType.fromDDL("ids array<int>").fields])

    def run(batches):
        encoder = _encoder(model)
        for own in lots(batches, text, LOT_BYTES):
            texts = own.column(text)
            ids, at = encoder.encode(texts)
            lists = pa.ListArray.from_arrays(
                at.astype(np.int32), ids.view(np.int32), mask=texts.is_null() if texts.null_count else None)
            whole = pa.RecordBatch.from_arrays([*own.columns, lists], names=[*own.schema.names, "ids"])
            for i in range(0, whole.num_rows, BATCH_ROWS):
                yield whole.slice(i, BATCH_ROWS)

    return text_batches(documents).mapInArrow(run, out)


def decoded(rows: DataFrame, model: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """All columns, and the text of the ids. A column of that name is replaced."""
    rows = rows.drop(text)
    out = StructType([*rows.schema.fields, *StructType.fromDDL(f"`{text}` string").fields])

    def run(lots):
        encoder = _encoder(model)
        for batch in lots:
            for i in range(0, batch.num_rows, 512):
                own = batch.slice(i, 512)
                lists = own.column(ids)
                flat = np.asarray(lists.flatten())
                at = np.cumsum([0, *lists.value_lengths().fill_null(0).to_pylist()]).tolist()
                texts = [encoder.decode(flat[a:b]) if known else None
                         for a, b, known in zip(at, at[1:], lists.is_valid().to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, pa.array(texts, pa.string())], names=[*own.schema.names, text])

    return text_batches(rows).mapInArrow(run, out)
