"""Token ids of a corpus in bit-packed files.

Every id takes the bits that the vocabulary needs. A file holds the documents of one range
of ids in ascending order, in blocks::

    block    n_docs u32, n_ids u32, doc ids i64 * n_docs, has-id flags u8 * n_docs,
             lengths u32 * n_docs, ids packed to ``bits`` each, most significant bit first
    footer   per block: offset u64, first document u64, first id u64
    tail     n_blocks u32, bits u32, magic

Offsets in the footer and lengths in the block give any document without unpacking
others; ``numpy`` unpacks whole blocks or any run of ids. The manifest lists the committed
files in order with their counts, so that a document's place among all ids is known
without a pass over the corpus.

Spark deals the documents into id ranges by measured bounds and sorts each. A task writes
its own new file and only committed ones are listed, so retried tasks do no harm.

Defined results. Null text: only the end id. Null document id: before all others. Equal
ids: by text. Repeated rows are all written. No rows: no files.
"""

from __future__ import annotations

import string
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage,
)

from . import files
from .storage import BATCH_ROWS, new_folder, parts, range_bounds, range_of, text_batches
from .wordids import WordIds, lots

MAGIC = b"PKID0001"
BLOCK_IDS = 1 << 17
SCHEMA = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, ids array<int>"


def bits_for(vocabulary: int) -> int:
    """Bits that the largest id takes."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    wide = np.ascontiguousarray(ids, ">u4").view(np.uint8).reshape(-1, 4)
    if bits % 8 == 0:  # whole bytes
        return wide[:, 4 - bits // 8 :].tobytes()
    return np.packbits(np.unpackbits(wide, axis=1)[:, 32 - bits :]).tobytes()


def unpack(data: bytes, bits: int, first: int, count: int) -> np.ndarray:
    """``count`` ids from number ``first`` on."""
    if not count:
        return np.zeros(0, np.uint32)
    a, b = first * bits, (first + count) * bits
    if bits % 8 == 0:
        wide = np.zeros((count, 4), np.uint8)
        wide[:, 4 - bits // 8 :] = np.frombuffer(data, np.uint8, count * bits // 8, a // 8).reshape(count, bits // 8)
        return wide.view(">u4").ravel().astype(np.uint32)
    raw = np.frombuffer(data, np.uint8, -(-b // 8) - a // 8, a // 8)
    flags = np.unpackbits(raw)[a % 8 : a % 8 + count * bits].reshape(count, bits)
    wide = np.zeros((count, 32), np.uint8)
    wide[:, 32 - bits :] = flags
    return np.packbits(wide, axis=1).view(">u4").ravel().astype(np.uint32)


class FileWriter:
    """Writes documents one after another to an open stream."""

    def __init__(self, out, bits: int):
        self.out, self.bits = out, bits
        self.docs: list[int | None] = []
        self.ids: list[np.ndarray] = []
        self.held = self.at = self.n_docs = self.n_ids = 0
        self.index: list[tuple[int, int, int]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.ids.append(ids)
        self.held += len(ids)
        if self.held >= BLOCK_IDS:
            self.flush()

    def flush(self) -> None:
        if not self.docs:
            return
        self.index.append((self.at, self.n_docs, self.n_ids))
        known = np.array([d is not None for d in self.docs], np.uint8)
        data = b"".join([
            np.array([len(self.docs), self.held], "<u4").tobytes(),
            np.array([d or 0 for d in self.docs], "<i8").tobytes(), known.tobytes(),
            np.array([len(x) for x in self.ids], "<u4").tobytes(),
            pack(np.concatenate(self.ids), self.bits)])
        self.out.write(data)
        self.at += len(data)
        self.n_docs += len(self.docs)
        self.n_ids += self.held
        self.docs, self.ids, self.held = [], [], 0

    def close(self) -> None:
        self.flush()
        self.out.write(np.array(self.index, "<u8").tobytes())
        self.out.write(np.array([len(self.index), self.bits], "<u4").tobytes() + MAGIC)
        self.out.close()


class FileReader:
    """Blocks and single documents of one file."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        file.seek(size - 16)
        tail = file.read(16)
        if tail[8:] != MAGIC:
            raise ValueError("not a file of packed ids")
        n, self.bits = np.frombuffer(tail[:8], "<u4").tolist()
        file.seek(size - 16 - 24 * n)
        self.index = np.frombuffer(file.read(24 * n), "<u8").reshape(n, 3).astype(np.int64)
        self.end = size - 16 - 24 * n

    def block(self, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
        """Document ids, known flags, lengths, packed ids."""
        at = int(self.index[i, 0])
        after = int(self.index[i + 1, 0]) if i + 1 < len(self.index) else self.end
        self.file.seek(at)
        data = self.file.read(after - at)
        n = int(np.frombuffer(data, "<u4", 1)[0])
        return (np.frombuffer(data, "<i8", n, 8), np.frombuffer(data, np.uint8, n, 8 + 8 * n),
                np.frombuffer(data, "<u4", n, 8 + 9 * n).astype(np.int64), data[8 + 13 * n :])

    def document(self, number: int) -> tuple[int | None, np.ndarray]:
        """Document by its number in the file; only its own ids are unpacked."""
        i = int(np.searchsorted(self.index[:, 1], number, "right")) - 1
        docs, known, lengths, packed = self.block(i)
        j = number - int(self.index[i, 1])
        first = int(lengths[:j].sum())
        return (int(docs[j]) if known[j] else None), unpack(packed, self.bits, first, int(lengths[j]))


class _Committed(WriterCommitMessage):
    def __init__(self, entry: dict | None):
        self.entry = entry


class PackedWriter(DataSourceArrowWriter):
    """Writes ``doc_id, ids``; with a ``tokenizer``, ``doc_id, text`` as the ids of the texts."""

    def __init__(self, path: str, bits: int, tokenizer: str | None = None, end: int | None = None):
        self.path, self.bits, self.tokenizer, self.end = path, bits, tokenizer, end
        files.make_folder(path)

    def _lists(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
        """Per lot: document ids, the ids of all one after another, where each begins."""
        if self.tokenizer:
            for own, ids, at in _encoded_lots(batches, self.tokenizer, self.end):
                yield own.column("doc_id").to_pylist(), ids, at
            return
        for batch in batches:
            lists = batch.column("ids")
            at = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0))])
            yield batch.column("doc_id").to_pylist(), np.asarray(lists.flatten()), at

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, folder = files.opened(self.path)
        writer, name, first = None, f"part-{uuid.uuid4().hex}.ids", None
        for docs, flat, at in self._lists(iterator):
            if not docs:
                continue
            if writer is None:
                first = docs[0]
                writer = FileWriter(fs.open_output_stream(f"{folder}/{name}", compression=None), self.bits)
            for i, doc in enumerate(docs):
                writer.add(doc, flat[at[i] : at[i + 1]])
        if writer is None:
            return _Committed(None)
        writer.close()
        return _Committed({"file": name, "first": first, "docs": writer.n_docs, "ids": writer.n_ids})

    def commit(self, messages: list) -> None:
        entries = [m.entry for m in messages if m is not None and m.entry]
        entries.sort(key=lambda e: (e["first"] is not None, e["first"]))
        start = 0
        for e in entries:
            e["start"] = start
            start += e["ids"]
        files.write_manifest(self.path, {"files": entries})

    def abort(self, messages: list) -> None:
        files.remove_files(self.path, [m.entry["file"] for m in messages if m is not None and m.entry])


class _File(InputPartition):
    def __init__(self, entry: dict):
        super().__init__(entry)


class PackedReader(DataSourceReader):
    def __init__(self, path: str, ids: bool):
        self.path, self.ids = path, ids

    def partitions(self):
        held = files.read_manifest(self.path)
        return [_File(e) for e in (held["files"] if held else [])]

    def read(self, partition):
        if partition is None:
            return
        fs, folder = files.opened(self.path)
        entry = partition.value
        with fs.open_input_file(f"{folder}/{entry['file']}") as file:
            reader = FileReader(file)
            for i in range(len(reader.index)):
                docs, known, lengths, packed = reader.block(i)
                ids = unpack(packed, reader.bits, 0, int(lengths.sum()))
                at = np.concatenate([[0], np.cumsum(lengths)])
                raw = ids.astype("<u4").tobytes()
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                lists = pa.ListArray.from_arrays(at.astype(np.int32), ids.view(np.int32)) if self.ids else pa.nulls(len(docs), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs, mask=known == 0), pa.array(at[:-1] + int(reader.index[i, 2]) + entry["start"]),
                     pa.array(lengths), pa.array(crc, pa.int64()), lists],
                    names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"])


class PackedSource(DataSource):
    """``spark.read.format("packed_ids").load(path)``; ``ids=false`` leaves the lists null."""

    @classmethod
    def name(cls) -> str:
        return "packed_ids"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema):
        return PackedReader(self.options["path"], self.options.get("ids", "true").lower() == "true")

    def writer(self, schema, overwrite: bool):
        end = self.options.get("end")
        return PackedWriter(self.options["path"], int(self.options["bits"]), self.options.get("tokenizer"),
                            None if end is None else int(end))


def find(path: str, doc_id: int) -> np.ndarray | None:
    """Ids of one document by its id, from one block of one file."""
    held = files.read_manifest(path)["files"]
    fs, folder = files.opened(path)
    for entry in reversed([e for e in held if e["first"] is None or e["first"] <= doc_id]):
        with fs.open_input_file(f"{folder}/{entry['file']}") as file:
            reader = FileReader(file)
            for i in range(len(reader.index)):
                docs, known, lengths, packed = reader.block(i)
                place = np.flatnonzero((docs == doc_id) & (known == 1))
                if len(place):
                    first = int(lengths[: place[0]].sum())
                    return unpack(packed, reader.bits, first, int(lengths[place[0]]))
        return None
    return None


#: byte-level vocabularies write printable Latin-1 bytes as they are and the others, in
#: order, as the code points from U+0100
_PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_CHARS = {b: chr(0x100 + i) for i, b in enumerate(sorted(set(range(256)) - set(_PLAIN)))}
#: signs that part from a letter before them; special tokens have the others
_PUNCTUATION = "".join(sorted(set(string.punctuation) - set("<|>")))
#: letters that composing or lower case turns into a letter and a mark, which goes on into the punctuation
_MARKED = ("[\u0130\u0958-\u095f\u09dc\u09dd\u09df\u0a33\u0a36\u0a59-\u0a5b\u0a5e\u0b5c\u0b5d\u0f43\u0f4d\u0f52\u0f57"
           "\u0f5c\u0f69\ufb1d-\ufb4e]")
#: Latin characters: all of them are composed; but for one, each has a single lower-case character
_LATIN = r"\A[\x00-\x{12F}\x{131}-\x{24F}]+\z"
_LOWER = r"\A[%s]+\z" % "".join(c for c in map(chr, range(0x250)) if c.isalpha() and c.lower() == c)
_encoders: dict = {}


#: words kept per Python worker: about 150 bytes each, in as many workers as an executor has cores
ROOM = 800_000


class Encoder:
    """Ids of texts with a tokenizer that drops white space and never joins words over it.

    Words are encoded once and kept, up to ``room`` of them, of which the frequent ones stay
    when it is full. Texts are parted only where
    the tokenizer parts them as well: at spaces and line feeds, and before a run of punctuation
    that follows a letter and ends the word. ASCII and Latin words are put into lower case first
    if the tokenizer does so anyway (``lower``) and no special token can be in them.
    """

    def __init__(self, path: str, lower: bool = True, room: int = ROOM):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.lower = lower
        probe = ["the", "étage", "straße", "zyxwvutsrq", "ñandúes", "a"]
        self.direct = [self._alone(w) for w in probe] == self._whole(probe)
        self.words = WordIds(self._encode, room=room)

    def _whole(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _alone(self, word: str) -> list[int]:
        """Ids from the merges alone, for words that all steps before leave as they are:
        Latin letters in lower case, composed."""
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(_BYTE_CHARS)
        return [t.id for t in self.tokenizer.model.tokenize(word)]

    def _encode(self, words: list[str]) -> list[list[int]]:
        """Most words need no normalizer and no pattern, which take most of the time."""
        if not self.direct:
            return self._whole(words)
        plain = pc.match_substring_regex(pa.array(words, pa.string()), _LOWER).to_pylist()
        rest = iter(self._whole([w for w, own in zip(words, plain) if not own]))
        return [self._alone(w) if own else next(rest) for w, own in zip(words, plain)]

    def _halves(self, words: pa.Array) -> pa.Array:
        """Each word, and the punctuation that ends it or an empty text."""
        if self.lower:
            latin = pc.and_not(pc.match_substring_regex(words, _LATIN), pc.match_substring(words, "<|"))
            words = pc.if_else(latin, pc.utf8_lower(words), words)
        own = pc.utf8_rtrim(words, _PUNCTUATION)
        last = pc.utf8_slice_codeunits(own, -1)
        letter = pc.and_not(pc.utf8_is_alpha(last), pc.match_substring_regex(last, _MARKED))
        own = pc.if_else(letter, own, words)
        # both lie side by side in the bytes of the words
        _, begin, data = words.buffers()
        begin = np.frombuffer(begin, np.int64, len(words) + 1, 8 * words.offset)
        cuts = np.empty(2 * len(words) + 1, np.int64)
        cuts[::2] = begin
        cuts[1::2] = begin[:-1] + pc.binary_length(own).to_numpy()
        return pa.LargeStringArray.from_buffers(2 * len(words), pa.py_buffer(cuts), data)

    def encode(self, texts: list | pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each begins (and the end)."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        texts = texts.cast(pa.large_string()).fill_null("")
        words = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        ids, bounds = self.words.gather_lists(words, self._halves)
        if end is not None:
            ids = np.insert(ids, bounds[1:], end)
            bounds = bounds + np.arange(len(bounds))
        return ids, bounds


def _encoder(path: str) -> Encoder:
    """One per Python worker, so that its words last over tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _encoded_lots(batches: Iterator[pa.RecordBatch], tokenizer: str, end: int | None):
    """Lots of the rows, each with its ids one after another and where those of each row begin."""
    encoder = _encoder(tokenizer)
    for own in lots(batches, "text"):
        yield own, *encoder.encode(own.column("text"), end)


def encoded(documents: DataFrame, tokenizer: str, end: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids`` of whole texts, in the order of the rows."""

    def run(batches):
        for own, ids, at in _encoded_lots(batches, tokenizer, end):
            whole = pa.RecordBatch.from_arrays(
                [own.column("doc_id"), pa.ListArray.from_arrays(at.astype(np.int32), ids.view(np.int32))],
                names=["doc_id", "ids"])
            for i in range(0, whole.num_rows, BATCH_ROWS):
                yield whole.slice(i, BATCH_ROWS)

    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return text_batches(rows).mapInArrow(run, "doc_id bigint, ids array<int>")


def write_ids(documents: DataFrame, tokenizer: str, vocabulary: int, end: int, path: str | None = None,
              doc_id: str = "doc_id", text: str = "text") -> str:
    """Encode whole texts, append ``end`` to each, write them in ascending order of their
    ids. Returns the folder. One shuffle of the texts; their ids are made after it, by the
    process that writes them, so that no second one keeps words too."""
    spark = documents.sparkSession
    spark.dataSource.register(PackedSource)
    path = path or new_folder(spark, "ids")
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    n = parts(spark)
    bounds = range_bounds(rows, "doc_id", n)
    dealt = (
        rows.withColumn("_range", range_of("doc_id", bounds)).repartitionById(n, F.col("_range"))
        .drop("_range").sortWithinPartitions(F.asc_nulls_first("doc_id"), "text")
    )
    text_batches(dealt).write.format("packed_ids").options(
        path=path, bits=bits_for(vocabulary), tokenizer=tokenizer, end=end).mode("append").save()
    return path


def read_ids(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    spark.dataSource.register(PackedSource)
    return spark.read.format("packed_ids").option("ids", str(ids).lower()).load(path)
