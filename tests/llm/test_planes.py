"""Token shards: exact round trips of planes, files and whole corpora."""

import io
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_edges import EDGES
from loanlens.llm import planes
from loanlens.llm.encoding import ByteEncoder, Learned
from loanlens.llm.queries import QUERIES, tokenizer_path

FOLDER = "/root/testdata/sf0.001"
PATH = tokenizer_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


class Kept(io.BytesIO):
    def close(self):
        self.whole = self.getvalue()
        super().close()


class Held:
    def __init__(self, data):
        self.data, self.reads = data, 0

    def size(self):
        return len(self.data)

    def read_at(self, length, offset):
        self.reads += length
        return self.data[offset : offset + length]


@pytest.mark.parametrize("kind", planes.PLANES)
@pytest.mark.parametrize("count", [0, 1, 7, 8, 9, 4096])
def test_planes_turn_back(kind, count):
    ids = np.random.default_rng(count).integers(0, 1 << 32, count, dtype=np.uint32)
    turned = planes.planes_of(ids, kind)
    assert len(turned) == planes.PLANES[kind] and turned.nbytes == planes.PLANES[kind] * (-(-count // 8) if kind == "bit" else count)
    assert np.array_equal(planes.ids_of(turned, kind, count), ids)
    # by hand: plane b of the bits holds bit b of every id
    if kind == "bit" and count:
        assert [int(b) for b in np.unpackbits(turned[5], bitorder="little")[:count]] == [int(v) >> 5 & 1 for v in ids]


@pytest.mark.parametrize("kind", planes.PLANES)
@settings(max_examples=30, deadline=None)
@given(portions=st.lists(st.lists(st.integers(0, 50_256), max_size=40), max_size=12), block=st.sampled_from([1, 8, 13, 64]))
def test_any_stretch_is_read_back(kind, portions, block):
    out = Kept()
    writer = planes.ShardWriter(out, kind, block)
    for portion in portions:
        writer.append(np.array(portion, "<u4"))
    writer.close()
    every = np.array([i for p in portions for i in p], dtype=np.uint32)
    reader = planes.ShardReader(Held(out.whole))
    assert reader.ids == len(every) and [int(c) for c in reader.index["count"]] == [len(every[a : a + block]) for a in range(0, len(every), block)]
    for start in range(0, len(every) + 1, 5):
        got = list(reader.stretches(start, len(every) - start))
        assert np.array_equal(np.concatenate([np.empty(0, np.uint32), *got]), every[start:])
    with pytest.raises(ValueError):
        list(reader.stretches(0, len(every) + 1))


def test_a_reader_seeks_its_block():
    out = Kept()
    writer = planes.ShardWriter(out, block=1000)
    writer.append(np.random.default_rng(1).integers(0, 50_257, 200_000).astype("<u4"))
    writer.close()
    held = Held(out.whole)
    reader = planes.ShardReader(held)
    held.reads = 0
    list(reader.stretches(150_010, 20))
    assert held.reads < len(out.whole) / 100
    assert len(out.whole) < 200_000 * 2.2  # constant planes cost next to nothing


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*" \n\t\r\x1c \x85 aZé9,.'’!ßİ中́", "<|endoftext|>", "'ll", "word", "  "]), max_size=30).map("".join))
def test_any_text_is_encoded_as_a_whole(text):
    from tokenizers import Tokenizer

    tokenizer = _shared.setdefault("t", Tokenizer.from_file(PATH))
    encoder = _shared.setdefault("e", ByteEncoder(PATH))
    assert np.frombuffer(encoder.ids(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [0]


_shared: dict = {}


def test_many_words_are_learned_once(monkeypatch):
    encoder = ByteEncoder(PATH)
    learned = []
    learn = encoder._learn
    monkeypatch.setattr(encoder.known, "learn", lambda word: learned.append(word) or learn(word))
    letters = "abcdefghijklmnopqrstuvwxyz"
    text = " ".join(f"{a}{b}{c}{d}" for a in letters for b in letters for c in letters for d in letters[:16])
    first = encoder.ids(text)
    del learned[:]
    assert encoder.ids(text) == first
    assert not learned  # 281,216 words
    encoder.known.clear()
    encoder.known.before.clear()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.none() | st.lists(st.sampled_from([*" \n\t\x1c9,.'’!éªµ×ĠÂÃ \xa0中", "<|endoftext|>", "'ll", "word", "Straße", "  ", " a", " a,b", ".\nThe", " an"]), max_size=20).map("".join), max_size=8))
def test_texts_together_are_encoded_as_each(texts):
    from tokenizers import Tokenizer

    tokenizer = _shared.setdefault("t", Tokenizer.from_file(PATH))
    encoder = _shared.setdefault("e", ByteEncoder(PATH))
    wanted = [[*tokenizer.encode(text or "", add_special_tokens=False).ids, 0] for text in texts]
    for part in (texts, texts[1:]):  # the second time most words are remembered
        ids, counts = encoder.ids_of_all(pa.array([None, *part], pa.string()).slice(1))
        assert ids.tolist() == sum(wanted[len(texts) - len(part) :], []) and counts.tolist() == [len(w) for w in wanted[len(texts) - len(part) :]]


def test_new_words_are_cut_many_at_a_time_and_looked_up_once(monkeypatch):
    encoder, merge = ByteEncoder(PATH), []
    letters = "abcdefghij"
    words = [f"q{a}{b}{c}z" for a in letters for b in letters for c in letters]
    texts = pa.array(["the " + " ".join(words)] * 20)
    whole = np.frombuffer(b"".join(encoder.ids(text) for text in texts.to_pylist()), "<u4")
    encoder.known.clear()
    encoder.known.before.clear()
    cut, found = encoder.merge, encoder.known.all_of
    asked = []
    monkeypatch.setattr(encoder, "merge", lambda text: merge.append(text) or cut(text))
    monkeypatch.setattr(encoder.known, "all_of", lambda words, learn: asked.extend(words) or found(words, learn), raising=False)
    ids, counts = encoder.ids_of_all(texts)
    assert np.array_equal(ids, whole) and counts.tolist() == [len(whole) // 20] * 20
    assert sorted(asked) == sorted(words) and len(merge) < 100


def test_old_words_make_room_when_many_come_at_once(monkeypatch):
    encoder = ByteEncoder(PATH)
    encoder.known = Learned(encoder._learn, 40)
    for at in range(0, 100, 10):
        words = [chr(97 + n // 26) + chr(97 + n % 26) for n in range(at, at + 10)]
        ids, _ = encoder.ids_of_all(pa.array(["x " + " ".join(words), "x " + " ".join(reversed(words))]))
        assert ids.tobytes() == b"".join(encoder.ids(t) for t in ("x " + " ".join(words), "x " + " ".join(reversed(words))))
        assert len(encoder.known) + len(encoder.known.before) <= 40


@pytest.mark.parametrize("token", ["o,", "sĊ", "eĠ", ",Ã"])
def test_tokens_across_parts_of_words_are_noticed(monkeypatch, token):
    encoder = ByteEncoder(PATH)
    assert encoder.first is not None and encoder.first[encoder.merge("Ġthe")[0].id] and not encoder.first[encoder.merge("the")[0].id]

    class Other:
        def get_vocab(self, with_added_tokens):
            return {"Ġ": 0, "Ġthe": 1, "âĢ¦.": 2, token: 3}

    encoder.tokenizer = Other()
    assert encoder._first_tokens() is None
    encoder.first = None
    encoder.tokenizer = ByteEncoder(PATH).tokenizer
    assert encoder.ids_of_all(pa.array(["so, what's new"]))[0].tobytes() == encoder.ids("so, what's new")


def test_texts_are_taken_by_bytes():
    texts = ["a" * n if n is not None else None for n in (3, 0, 30, None, 4, 5, 1, 12)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(9)), pa.array(["left out", *texts])], ["doc_id", "text"]).slice(1)
    parts = [part.column(1).to_pylist() for part in planes.portions(batch, 10)]
    assert sum(parts, []) == texts and [len(part) for part in parts] == [2, 1, 4, 1]
    assert not list(planes.portions(batch.slice(0, 0), 10))


def wanted(tokenizer, rows):
    """doc_id to start, number and digest, by encoding one text after the other."""
    at, found = 0, {}
    for doc, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        found[doc] = (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    return found


def test_op11_all_documents(spark, tokenizer):
    rows = sorted(map(tuple, spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()))
    got = QUERIES["op11_bit_planes"](spark, FOLDER)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == wanted(tokenizer, rows)


@pytest.mark.parametrize("kind", planes.PLANES)
@pytest.mark.parametrize("clashing", [False, True])
def test_odd_rows(spark, documents, tokenizer, kind, clashing):
    folder = planes.new_folder(spark)
    docs = documents(EDGES, clashing).withColumnsRenamed({"size": "start", "slot": "file"} if clashing else {})
    index = planes.write_shards(docs.repartition(3), folder, PATH, kind, block=64)
    got = planes.read_documents(index, folder, with_ids=True).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == sorted((i for i, _, _ in EDGES), key=lambda i: (i is not None, i))
    at, every = 0, []
    for r in got:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"]) and r["ids"][-1] == 0
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        every += r["ids"]
        at += len(r["ids"])
    texts = lambda rows: sorted((i or 0, tuple(ids)) for i, ids in rows)
    assert texts((r["doc_id"], r["ids"]) for r in got) == texts((i, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]) for i, t, _ in EDGES)
    for start, count in ((0, at), (0, 0), (5, 100), (at - 3, 3)):
        assert planes.read_stretch(index, folder, start, count).tolist() == every[start : start + count]
    one = planes.read_documents(index, folder, index.where("doc_id = 7")).collect()
    assert [tuple(r)[:3] for r in one] == [(r["doc_id"], r["start"], r["n_tokens"]) for r in got if r["doc_id"] == 7]


def test_a_rerun_writes_the_same_order(spark, documents):
    def starts(parts):
        folder = planes.new_folder(spark)
        index = planes.write_shards(documents([(1, f"text {i}", "a") for i in range(50)]).repartition(parts), folder, PATH)
        return sorted(tuple(r) for r in planes.read_documents(index, folder).collect())

    assert starts(2) == starts(5)


def test_no_documents(spark, documents):
    folder = planes.new_folder(spark)
    index = planes.write_shards(documents([]), folder, PATH)
    assert planes.read_documents(index, folder).count() == 0
    assert planes.read_stretch(index, folder, 0, 0).tolist() == []
