"""Packed ids and pieces: the libraries' ids, exact round trips, brute-force segmentation."""

import os
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from columnlens.llm import pieces, tokenids, wordids
from columnlens.llm.queries import QUERIES, tokenizer_path

from .common import SF

WORDS, MODEL = tokenizer_path("word_bpe_49k.json"), tokenizer_path("piece_bpe_32k.model")
ODD = ["", None, "It's. He'll!! don't... <|endoftext|> <|ENDOFTEXT|> a.b, É. İI ΣΑΣ. x́. é, 12.5, ... ,. a\tb\n\n c",
       "'s", "a '. b'", "word x.  y", "a  b ", " ", "x" * 3000, "日本語\0z ﬁ", "▁x ▁▁ \n", "\n\n", "é" * 300, "ab " * 5000]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORDS)


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def test_encoder(tokenizer):
    texts = ODD + pq.read_table(f"{SF}/documents.parquet").column("text").to_pylist()
    for room in (1_000_000, 50):
        encoder = tokenids.Encoder(WORDS, room=room)
        for i in range(0, len(texts), 40):
            ids, at = encoder.encode(texts[i : i + 40], 1)
            for k, t in enumerate(texts[i : i + 40]):
                assert ids[at[k] : at[k + 1]].tolist() == ids_of(tokenizer, t)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aB.,!?'s \né́ß1<|>endoftx Σ", max_size=40))
def test_encoder_any_text(text):
    from tokenizers import Tokenizer

    tokenizer = test_encoder_any_text.__dict__.setdefault("t", Tokenizer.from_file(WORDS))
    encoder = test_encoder_any_text.__dict__.setdefault("e", tokenids.Encoder(WORDS))
    assert encoder.encode([text], 1)[0].tolist() == ids_of(tokenizer, text)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 32), st.integers(0, 300), st.data())
def test_packing(bits, n, data):
    ids = np.random.default_rng(n).integers(0, 1 << bits, n).astype(np.uint32)
    packed = tokenids.pack(ids, bits)
    assert len(packed) == -(-n * bits // 8)
    first = data.draw(st.integers(0, n))
    count = data.draw(st.integers(0, n - first))
    assert (tokenids.unpack(packed, bits, first, count) == ids[first : first + count]).all()
    assert tokenids.bits_for(1 << bits) == bits


def test_files(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(tokenids, "BLOCK_IDS", 500)
    rows = [(i * 7 - 20, t, "x") for i, t in enumerate(ODD * 3)] + [(None, "no id", "y"), (8, "equal id", "z"), (8, "equal id", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    path = tokenids.write_ids(df, WORDS, 49_408, 1)
    got = tokenids.read_ids(spark, path).collect()
    want = sorted(((d, t, ids_of(tokenizer, t)) for d, t, _ in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    got.sort(key=lambda r: r["start"])
    start = 0
    for r, (d, t, ids) in zip(got, want, strict=True):
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids"]) == (d, start, len(ids), ids)
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    for d, t, ids in want[1:]:
        if d != 8:
            assert tokenids.find(path, d).tolist() == ids
    assert tokenids.find(path, 10**9) is None
    empty = tokenids.write_ids(df.limit(0), WORDS, 49_408, 1)
    assert tokenids.read_ids(spark, empty).count() == 0


def test_op3(spark, tokenizer):
    got = QUERIES["op3_token_ids"](spark, SF).orderBy("doc_id").collect()
    docs = sorted(pq.read_table(f"{SF}/documents.parquet").to_pylist(), key=lambda r: r["doc_id"])
    start = 0
    for r, d in zip(got, docs, strict=True):
        ids = np.array(ids_of(tokenizer, d["text"]), "<u4")
        assert tuple(r) == (d["doc_id"], start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


@pytest.fixture(scope="module")
def encoder():
    return pieces.Encoder(MODEL)


def best_sum(table, text):
    """The highest score of any segmentation."""
    best = [0.0] + [None] * len(text)
    for end in range(1, len(text) + 1):
        best[end] = best[end - 1] + table.pieces.get(text[end - 1], (0, table.unknown))[1]
        for start in range(max(0, end - table.longest), end - 1):
            if text[start:end] in table.pieces:
                best[end] = max(best[end], best[start] + table.pieces[text[start:end]][1])
    return best[-1]


def score(table, ids, text):
    names = {i: s for i, s in table.pieces.values()}
    total, place = 0.0, 0
    while place < len(ids):
        if ids[place] in names:
            total += names[ids[place]]
            place += 1
        else:  # the bytes of one character
            lead = table.bytes_of[ids[place]][0]
            place += 1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0)
            total += table.unknown
    return total


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="theinglyou \n▁é日0.\0x", max_size=90))
def test_viterbi(text):
    encoder = test_viterbi.__dict__.setdefault("e", pieces.Encoder(MODEL))
    table = encoder.table
    ids = encoder.encode([text])[0].tolist()
    assert encoder.decode(ids) == text
    marked = pieces.SPACE + text.replace("▁", pieces.LITERAL).replace(" ", "▁") if text else ""
    assert score(table, ids, marked) == best_sum(table, marked)
    assert list(pieces.streamed(table, marked)) == ids


def test_same_as_library_lattice(encoder):
    """The library's n-best search over the same table as a unigram model."""
    sentencepiece = pytest.importorskip("sentencepiece")
    proto = pytest.importorskip("sentencepiece.sentencepiece_model_pb2").ModelProto()
    with open(MODEL, "rb") as file:
        proto.ParseFromString(file.read())
    proto.trainer_spec.model_type = 1
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    words = sorted({w for t in pq.read_table(f"{SF}/documents.parquet").column("text").to_pylist() for w in t.split()})[::40]
    for w in words[:300]:
        best = library.nbest_encode_as_ids(w, 1)[0]
        mine = encoder.encode([w])[0].tolist()
        assert mine == best or sum(map(library.get_score, mine)) >= sum(map(library.get_score, best))


def test_search_window(encoder):
    search = pieces.Search(encoder.table)
    held = 0
    for c in "▁the" * 4000:
        search.push(c)
        held = max(held, len(search.text))
    assert held <= 4 * encoder.table.longest


def test_pieces_rows(spark, encoder):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(ODD)], "doc_id long, text string, ids string")
    back = pieces.decoded(pieces.encoded(df, MODEL), MODEL).collect()
    assert [(r["doc_id"], r["decoded"]) for r in back] == list(enumerate(ODD))
    assert [r["ids"] is None for r in back] == [t is None for t in ODD]
    assert pieces.encoded(df.limit(0), MODEL).count() == 0


def test_op9(spark):
    got = QUERIES["op9_sentencepiece"](spark, SF)
    assert got.where("not exact").count() == 0 and got.count() > 0
    assert os.path.exists(MODEL)


def test_keys_of_runs():
    """ASCII texts stay ASCII, and every run has a key of its own, also with the sign that marks keys."""
    encoder = pieces.Encoder(MODEL, room=50)
    assert all(key.isascii() for key in encoder._runs("two words\nand a line")) and "words" in encoder._runs("two words\nand")
    runs = [f"{a}{b}" for a in ("", "▁", "▁▁", "▁\x01", "\x01", "\x01▁") for b in ("", "a", "\n", "ab\x01")]
    assert [pieces._run(pieces._key(r)) for r in runs] == runs and "" not in map(pieces._key, runs)
    for text in ["\x01", "a\x01 \x01b", " \x01", "\n", "a\n", "\na", "a \nb", "a\n b", " ", "a ", "\x01\n\x01 c", "word " * 9]:
        marked = pieces.SPACE + text.replace(" ", "▁")
        ids = encoder.encode([text, text])[0].tolist()
        assert ids == 2 * list(pieces.streamed(encoder.table, marked))
        assert encoder.decode(ids[: len(ids) // 2]) == text


def test_frequent_words_stay_within_the_room(tokenizer):
    """What is kept is bounded, and words met again are not encoded again when it is full."""
    asked = []

    def encode(words):
        asked.extend(words)
        return [[len(w), *w.encode()] for w in words]

    words = wordids.WordIds(encode, lambda w: [w.lower(), "!"] if w.isupper() else [w], room=60)
    for i in range(200):
        lot = [["often", "", "ABC"], [f"rare{i}x{k}" for k in range(5)], ["often"] * 2, []]
        ids, at = words.gather(lot)
        parts = [[x for w in own if w for x in ([w.lower(), "!"] if w.isupper() else [w])] for own in lot]
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [[n for x in own for n in (len(x), *x.encode())] for own in parts]
        assert len(words.number) <= 60 + 10 and len(words.met) < 1 << 17
    assert asked.count("often") == 1 and asked.count("rare7x1") == 1
    assert tokenids.Encoder(WORDS).words.room < 1_000_000


def test_ids_are_made_where_they_are_written(spark, tokenizer, monkeypatch):
    """One Python process per task of the write; ids that come as lists are written all the same."""
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    monkeypatch.setattr(tokenids, "encoded", None)
    path = tokenids.write_ids(df, WORDS, 49_408, 1)
    monkeypatch.undo()
    got = tokenids.read_ids(spark, path).select("doc_id", "ids")
    assert sorted(map(tuple, got.collect())) == [(i, ids_of(tokenizer, t)) for i, t in enumerate(ODD)]
    again = f"{path}-lists"
    tokenids.encoded(df, WORDS, 1).write.format("packed_ids").options(path=again, bits=16).mode("append").save()
    assert sorted(map(tuple, tokenids.read_ids(spark, again).select("doc_id", "ids").collect())) == sorted(map(tuple, got.collect()))


def test_latin_words_and_their_punctuation_need_no_whole_tokenizer(tokenizer):
    """Only what the steps before the merges can change goes through all of them; ids are the tokenizer's."""
    encoder = tokenids.Encoder(WORDS)
    asked, whole = [], encoder._whole
    encoder._whole = lambda words: asked.extend(words) or whole(words)
    for text in ["Straße; Étage### (x) ÑANDÚES!?", "l'été, d'a's' ÀÉ...\n"]:
        assert encoder.encode([text], 1)[0].tolist() == ids_of(tokenizer, text)
    assert not {"Straße", "straße", "Étage", "étage", "étage###", "ñandúes"} & set(asked)
    words = [f"{a}{c}{b}" for c in map(chr, [*range(1, 0x260), 0x301, 0x3A3, 0x2581]) for a in ("", "a", "É") for b in ("", "a", ".", "x;'", "<|", "|>.")]
    words += ["<|endoftext|>.", "A<|endoftext|>b!", "<|ENDOFTEXT|>#", "É<|endoftext|>)", "a's'", "a'S.", "'s'", "don't''", "e\u0301.", "İ.", "İX###", "Σ.", "ΑΣ)", "x_", "x_.", "9.", "².", "\u0958.", "\ufb2a!"]
    for lot in (words, words[::-1]):
        ids, at = encoder.encode([*lot, " ".join(lot)], 1)
        for i, w in enumerate([*lot, " ".join(lot)]):
            assert ids[at[i] : at[i + 1]].tolist() == ids_of(tokenizer, w), repr(w)


def test_words_of_a_lot_are_looked_up_once(tokenizer):
    """Small batches are encoded together, and a word is looked up once for all of them."""
    import pyarrow as pa

    texts = pa.array([None, "", *["again and again, Again! "] * 3000])
    batches = [pa.record_batch({"doc_id": pa.array(range(i, i + len(x))), "text": x}) for i in range(0, len(texts), 40) for x in [texts.slice(i, 40)]]
    lots = list(wordids.lots(iter([batches[0].slice(0, 0), *batches]), "text", 20_000))
    assert 1 < len(lots) < 6 and pa.concat_batches(lots) == pa.concat_batches(batches)
    looked = []

    class Numbers(dict):
        def get(self, key, default=None):
            looked.append(key)
            return super().get(key, default)

    encoder = tokenids.Encoder(WORDS)
    encoder.words.number = Numbers(encoder.words.number)
    for lot in lots:
        ids, at = encoder.encode(lot.column("text"), 1)
        for i, t in enumerate(lot.column("text").to_pylist()):
            assert ids[at[i] : at[i + 1]].tolist() == ids_of(tokenizer, t)
    assert len(looked) <= 8 * len(lots)


def test_runs_are_searched_together(encoder, monkeypatch):
    """New runs of ordinary texts take no search of their own, in lots of any size; ids are the same."""
    texts = [" ".join(t.split()) for t in pq.read_table(f"{SF}/documents.parquet").column("text").to_pylist()[:60] if t]
    want = [list(pieces.streamed(encoder.table, pieces.SPACE + t.replace(" ", pieces.SPACE))) for t in texts]
    known = set(encoder.table.pieces)
    plain = [i for i, t in enumerate(texts) if set(t) - {" "} <= known and max(map(len, t.split())) <= pieces.SHORT]
    assert len(plain) > 20
    monkeypatch.setattr(pieces, "PLACES", 300)
    ids, at = pieces.Encoder(MODEL).encode([*texts, None, "", *texts[::-1]])
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [*want, [], [], *want[::-1]]
    monkeypatch.setattr(pieces, "_short", None)
    ids, at = pieces.Encoder(MODEL).encode([texts[i] for i in plain])
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [want[i] for i in plain]


def test_texts_with_other_white_space_stay_in_their_places(encoder):
    """Texts that Arrow parts and texts that it cannot part, side by side."""
    texts = ["a b\nc", "  a", "", "a  b", None, "a\n b", "a \nb", "▁", "x ▁\x01 y", "\n", "end\n", "end ", "plain words", "\x01", "\n\n", "a\n\nb", "ab" * 90]
    for own in (texts, texts[::-1], texts[:1], texts[1:2], [], [None]):
        ids, at = encoder.encode(own)
        assert len(at) == len(own) + 1
        for a, b, t in zip(at, at[1:], own):
            marked = pieces.SPACE + t.replace("▁", pieces.LITERAL).replace(" ", "▁") if t else ""
            assert ids[a:b].tolist() == list(pieces.streamed(encoder.table, marked)), repr(t)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="abcde▁\udfff日", max_size=12), max_size=12), st.integers(0, 5))
def test_any_table(runs, seed):
    """Tables in which characters of pieces are no pieces themselves, and scores are often equal."""
    rng = np.random.default_rng(seed)
    table = pieces.Table.__new__(pieces.Table)
    names = sorted({"".join(rng.choice(list("abcd▁"), rng.integers(1, 5))) for _ in range(20)})
    table.pieces = {n: (i + 300, -float(rng.integers(0, 4))) for i, n in enumerate(names)}
    table.byte_id = list(range(256))
    table.longest = max(map(len, names))
    table.unknown = min(s for _, s in table.pieces.values()) - pieces.UNKNOWN
    table.begins = {p[:n] for p in names for n in range(1, len(p) + 1)}
    ids, counts = pieces.Together(table).encode(runs)
    at = np.concatenate([[0], np.cumsum(counts)])
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [list(pieces.streamed(table, r)) for r in runs]
