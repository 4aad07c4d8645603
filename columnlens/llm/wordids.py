"""Ids of words, made once per word and gathered for many texts at once."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import chain, islice, repeat

import numpy as np
import pyarrow as pa

#: bytes of text that are encoded at once: the more, the fewer words are looked up in all
LOT_BYTES = 8 << 20


def lots(batches: Iterable[pa.RecordBatch], text: str, size: int = LOT_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of the batches, in batches of about ``size`` bytes of text."""
    held, n = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.column(text).nbytes
        if n >= size:
            yield pa.concat_batches(held)
            held, n = [], 0
    if held:
        yield pa.concat_batches(held)


def spread(flat: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of an array one after another, and where each begins then (and the end)."""
    at = np.concatenate([[0], np.cumsum(sizes)])
    return flat[np.arange(at[-1]) + np.repeat(begin - at[:-1], sizes)], at


class WordIds:
    """Keeps the ids of up to about ``room`` words; beyond that, of those met most often.

    ``split`` parts a word into one or more that are encoded apart, if given; ``encode`` gives
    the ids of each of a list of such parts, as lists or as arrays of all ids and of their
    counts. The empty word has none.
    """

    def __init__(self, encode: Callable[[list[str]], Iterable[list[int]] | tuple[np.ndarray, np.ndarray]],
                 split: Callable[[str], list[str]] | None = None, room: int = 1_000_000):
        self.encode, self.split, self.room = encode, split, room
        self.number = {"": 0}
        # ids of all words one after another, where those of each begin, and how often it was met
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.begin, self.met = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)

    def _forget(self) -> None:
        """Keeps up to half of the room: the words met more than once, the most frequent first."""
        met = self.met[: len(self.number)]
        kept = np.flatnonzero(met > 1)
        kept = kept[np.argsort(-met[kept], kind="stable")[: self.room // 2]]
        kept = np.unique(np.append(kept, 0))  # the empty word is the first
        names, met = list(self.number), met[kept] // 2
        ids, at = self._gathered(kept)
        self.number = {}  # not two of them at once
        self.number = {names[k]: i for i, k in enumerate(kept.tolist())}
        self.flat, self.used = ids, len(ids)
        self.begin, self.met = at, np.append(met, 0)

    def _keep(self, words: Sequence[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        k, n = len(self.number), len(words)
        while k + n >= len(self.begin):
            self.begin, self.met = (np.concatenate([x, np.zeros_like(x)]) for x in (self.begin, self.met))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(len(self.flat), 1 << 16), np.uint32)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.begin[k : k + n + 1] = self.used
        self.begin[k + 1 : k + n + 1] += np.cumsum(sizes)
        self.used += len(ids)
        self.number.update(zip(words, range(k, k + n)))

    def _encoded(self, words: Iterable[str]) -> None:
        fresh = iter(words)
        while lot := list(islice(fresh, 50_000)):
            found = self.encode(lot)
            if not isinstance(found, tuple):
                lists = list(found)
                sizes = np.fromiter(map(len, lists), np.int64, len(lists))
                found = np.fromiter(chain.from_iterable(lists), np.uint32, int(sizes.sum())), sizes
            self._keep(lot, *found)

    def _learn(self, words: list[str]) -> None:
        if self.split is None:
            return self._encoded(words)
        parted = list(map(self.split, words))
        self._encoded({x for x in chain.from_iterable(parted) if x not in self.number})
        rest = [(w, own) for w, own in zip(words, parted) if w not in self.number]
        ids, at = self._gathered(np.array([self.number[x] for _, own in rest for x in own], np.int64))
        ends = at[np.cumsum([0, *[len(own) for _, own in rest]])]
        self._keep([w for w, _ in rest], ids, np.diff(ends))

    def _gathered(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words by their numbers, and where each word begins (and the end)."""
        begin = self.begin[codes]
        return spread(self.flat, begin, self.begin[codes + 1] - begin)

    def _numbers(self, names: list[str], times: np.ndarray) -> np.ndarray:
        """Numbers of different words, met so many times."""
        if len(self.number) > self.room:
            self._forget()
        codes = np.fromiter(map(self.number.get, names, repeat(-1)), np.int64, len(names))
        unknown = np.flatnonzero(codes < 0)
        if len(unknown):
            fresh = [names[i] for i in unknown.tolist()]
            self._learn(fresh)
            codes[unknown] = [self.number[w] for w in fresh]
        self.met[codes] += times
        return codes

    def gather(self, texts: Iterable[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each given as its words, and where each text begins (and the end)."""
        words, counts = [], [0]
        for own in texts:
            words += own
            counts.append(len(own))
        place = dict(zip(dict.fromkeys(words), range(len(words))))
        index = np.fromiter(map(place.get, words), np.int64, len(words))
        codes = self._numbers(list(place), np.bincount(index, minlength=len(place)))
        ids, at = self._gathered(codes[index])
        return ids, at[np.cumsum(counts)]

    def gather_lists(self, texts: pa.Array, halves: Callable[[pa.Array], pa.Array] | None = None
                     ) -> tuple[np.ndarray, np.ndarray]:
        """As ``gather``, of an Arrow list of words per text. Arrow tells the different words of
        all texts, so that only these become Python's and are looked up. ``halves`` parts each
        of them into two that are encoded apart."""
        words = texts.flatten().dictionary_encode()
        index = words.indices.to_numpy()
        names, times = words.dictionary, np.bincount(index, minlength=len(words.dictionary))
        if halves is None:
            ids, at = self._gathered(self._numbers(names.to_pylist(), times)[index])
        else:
            parts = halves(names).dictionary_encode()
            place = parts.indices.to_numpy()
            met = np.bincount(place, np.repeat(times, 2), len(parts.dictionary)).astype(np.int64)
            ids, at = self._gathered(self._numbers(parts.dictionary.to_pylist(), met)[place])
            begin = at[::2]
            ids, at = spread(ids, begin[index], np.diff(begin)[index])
        return ids, at[np.cumsum([0, *texts.value_lengths().to_numpy()])]
