import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from anemos.llm import bpe, packing
from anemos.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [None, "", " ", "aaaa aaaaaaa", "don't I'LL ''s !'s 12 ab's 'street", "<|endoftext|>x <|startoftext|><|endof",
       "ΣΑΣ İstanbul ǅ ß", "é ẛ̣", "\x1c\x1d a​b　c\x85d", "x" * 20_000, "a", "''''ve", "日本語 12٣", "aaaa aaaaaaa"]


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(PATH)


def random_texts(n):
    rng = random.Random(5)
    return ["".join(rng.choice("abcdefg'stmlvre ÉéßΣ123!?.\n") for _ in range(rng.randrange(300))) for _ in range(n)]


def test_round_trip(spark, reference):
    texts = ODD + random_texts(100)
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(texts)], "doc_id long, text string, ids int, _text int")
    coded = bpe.encode(df, PATH)
    got = {r["doc_id"]: r["ids"] for r in coded.collect()}
    want = [e.ids for e in reference.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert [got[i] for i in range(len(texts))] == want
    back = {r["doc_id"]: r["text"] for r in bpe.decode(coded, PATH).collect()}
    assert [back[i] for i in range(len(texts))] == [reference.decode(w, skip_special_tokens=False) for w in want]


def test_decode_of_odd_ids(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [320, -5, 10**6, 49407])], "doc_id long, ids array<int>")
    assert {r["doc_id"]: r["text"] for r in bpe.decode(df, PATH).collect()} == {1: "", 2: "", 3: "a</w> <|endoftext|>"}


def test_small_table_of_words():
    """A table of few slots, emptied again and again, gives the same ids."""
    import pyarrow as pa

    model, texts = bpe.Bpe(PATH), random_texts(60)
    full = [f[a:b].tolist() for f, bounds in bpe.Encoder(model).encode(pa.array(texts)) for a, b in zip(bounds, bounds[1:])]
    few = [f[a:b].tolist() for t in texts for f, bounds in bpe.Encoder(model, slots=4).encode(pa.array([t, t]))
           for a, b in zip(bounds, bounds[1:])]
    assert few[::2] == full == few[1::2]


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        bpe.Bpe(public_tokenizers.path("byte_bpe_50k.json"))


def test_queries_against_the_library(spark, reference):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    ids = {i: e.ids for i, e in zip(docs, reference.encode_batch(list(docs.values()), add_special_tokens=False))}
    rows = QUERIES["op1_bpe_roundtrip"](spark, SMALL).collect()
    assert len(rows) == len(docs)
    for r in rows:
        own = ids[r["doc_id"]]
        assert r["n_tokens"] == len(own)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, own)).encode()).hexdigest()
        text = reference.decode(own, skip_special_tokens=False)
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    check_packing(QUERIES["op9_packing"](spark, SMALL).collect(), {i: [*x, 1] for i, x in ids.items()}, 2048)


def check_packing(rows, ids, capacity):
    places, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        own = ids[r["doc_id"]]
        part = own[r["start"]:r["start"] + r["length"]]
        assert len(part) == r["length"] and r["doc_tokens"] == len(own)
        assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
        places[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append((r["start"], r["length"]))
    for spans, size in [*((s, None) for s in places.values()), *((s, len(ids[i])) for i, s in pieces.items())]:
        at = 0
        for start, length in sorted(spans):
            assert start == at
            at += length
        assert at == size if size else at <= capacity
    assert set(pieces) == set(ids) and sorted(places) == list(range(len(places)))


def test_packing_of_few_rows(spark):
    texts = {1: "word " * 50, 2: "word " * 21, 3: None, 4: "", 5: "word " * 7, 6: "word " * 7}
    df = spark.createDataFrame([(i, t, 0) for i, t in texts.items()], "doc_id long, text string, length int")
    pieces = packing.cut_documents(df, PATH, capacity=16, with_ids=True).cache()
    word = [r for r in pieces.collect() if r["doc_id"] == 5][0]["ids"][:1]
    ids = {i: word * (t or "").count("word") + [1] for i, t in texts.items()}
    packed = packing.pack(pieces, capacity=16).cache()
    check_packing(packed.collect(), ids, 16)
    made = packing.sequences(packed, 16).collect()
    assert sorted(t for r in made for t in r["ids"][:r["n_tokens"]]) == sorted(t for x in ids.values() for t in x)
    assert all(len(r["ids"]) == 16 or len(r["ids"]) == r["n_tokens"] in (1, 2, 4, 8) for r in made)
    assert all(x == 0 for r in made for x in r["ids"][r["n_tokens"]:])


def test_packing_ranks_in_parts(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANKED_TOGETHER", 3)
    rows = [(i, 0, 5 + i % 3, 0, 7) for i in range(40)] + [(None, 0, 5, 0, 7)] * 4
    df = spark.createDataFrame(rows, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")
    got = packing.pack(df, capacity=16).collect()
    spans = defaultdict(list)
    for r in got:
        spans[r["sequence_id"]].append((r["offset"], r["length"]))
    assert len(got) == len(rows)
    assert all(sum(n for _, n in s) == max(o + n for o, n in s) <= 16 for s in spans.values())


def test_packing_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode(empty, PATH).count() == 0
    assert packing.pack(packing.cut_documents(empty, PATH)).count() == 0


def test_shortest_pack_first():
    rng = np.random.default_rng(1)
    histogram = {int(k): int(n) for k, n in zip(rng.permutation(2048)[:300] + 1, rng.integers(1, 1000, 300))}
    patterns = packing.shortest_pack_first(histogram)
    placed = defaultdict(int)
    for count, lengths in patterns:
        assert sum(lengths) <= 2048
        for n in lengths:
            placed[n] += count
    assert placed == histogram
    with pytest.raises(ValueError):
        packing.shortest_pack_first({2049: 1})
