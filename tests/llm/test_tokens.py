"""Operators 3, 8 and 9: encoding, token files and counts, against the tokenizer libraries."""

from __future__ import annotations

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import tiktoken
from tokenizers import Tokenizer, models

from martweave.llm import _kept, _text, byte_bpe, token_counts, token_output
from martweave.llm.queries import QUERIES, shipped
from martweave.session import work_folder
from support import plan

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SPECIAL = [None, "", " ", "\n\n x", "don't 's'x 'll", "aaaa" * 3000, " " * 3000, "日本語のテキスト", "<|endoftext|>", "İ🙂é "]


@pytest.fixture(scope="module")
def tik():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def alike():
    """Two texts with equal hashes under any polynomial in one odd base modulo 2^64."""
    one = "a"
    for _ in range(10):
        one += one.translate({97: "b", 98: "a"})
    return [one, one.translate({97: "b", 98: "a"})]


def mixed(n, seed=5):
    rng = random.Random(seed)
    signs = "the and of er in 's é ß 日 \n\t 12 !? "
    return ["".join(rng.choice(signs) for _ in range(rng.choice([0, 1, 5, 40, 400]))) for _ in range(n)]


def test_encode_and_decode(documents, tik):
    texts = SPECIAL + mixed(60) + alike() + ["same", "same"]
    df = documents(texts, IDS=["kept"] * len(texts), Decoded=["old"] * len(texts))
    encoded = byte_bpe.encode(df, RANKS)
    assert encoded.columns == ["doc_id", "text", "Decoded", "ids"]
    got = {r["doc_id"]: r for r in byte_bpe.decode(encoded, RANKS).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        assert got[i]["ids"] == tik.encode_ordinary(text or "")
        assert bytes(got[i]["decoded"]) == (text or "").encode()


@pytest.mark.parametrize("room", [1 << 20, 20_000, 0])
def test_spans_of_equal_hashes_are_told_apart(monkeypatch, room):
    monkeypatch.setattr(_text, "hashes", lambda data, start, end: np.full(len(start), 5, np.uint64))
    kept, rng = _kept.Kept(3000, room), random.Random(1)
    for _ in range(4):
        words = ["".join(rng.choice("abé") for _ in range(rng.randint(1, 11))) for _ in range(900)]
        data, span = _text.words(next(_text.texts(pa.array([" ".join(words)]))))

        def make(new, data=data, span=span):
            own = [data[span.start[i] : span.end[i]] for i in new]
            return np.concatenate(own).astype(np.int32), np.array([len(x) for x in own])

        values, count = kept.get(data, span.start, span.end, make)
        assert bytes(values.astype(np.uint8)) == "".join(words).encode()
        assert count.tolist() == [len(w.encode()) for w in words]
        first, which = _kept.distinct(data, span.start, span.end)
        assert len(first) == len(set(words)) and [words[first[k]] for k in which] == words


def test_digests(documents, tik):
    row = byte_bpe.digests(byte_bpe.decode(byte_bpe.encode(documents(["Hello world", None]), RANKS), RANKS)).orderBy("doc_id").collect()
    ids = tik.encode_ordinary("Hello world")
    assert tuple(row[0]) == (
        0, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(b"Hello world").hexdigest(),
    )
    assert row[1]["n_tokens"] == 0 and row[1]["ids_sha256"] == hashlib.sha256(b"").hexdigest()


def test_long_pieces_merge_as_short_ones(monkeypatch, tik):
    text = "".join(random.Random(2).choice("ab") for _ in range(600))
    t = next(_text.texts(pa.array([text])))
    monkeypatch.setattr(byte_bpe, "LONG", 8)
    assert byte_bpe.encoded(byte_bpe.ranks(RANKS), t)[0].tolist() == tik.encode_ordinary(text)


def test_round_trip_is_encode_and_decode_in_one_worker(documents):
    texts = SPECIAL + mixed(30) + [None, "", None]
    df = documents(texts, IDS=["old"] * len(texts), Decoded=["old"] * len(texts), more=["kept"] * len(texts))
    both = byte_bpe.round_trip(df, RANKS)
    assert both.columns == ["doc_id", "more", "ids", "decoded"]
    assert plan(both).split("== Physical Plan ==")[1].count("MapInArrow") == 1
    apart = byte_bpe.decode(byte_bpe.encode(df, RANKS).drop("text"), RANKS)
    assert sorted(both.collect()) == sorted(apart.select(*both.columns).collect())
    assert byte_bpe.round_trip(documents([]), RANKS).count() == 0


def test_null_ids_and_no_rows(documents, spark):
    df = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [r["decoded"] for r in byte_bpe.decode(df, RANKS).orderBy("doc_id").collect()] == [None, b""]
    assert byte_bpe.decode(byte_bpe.encode(documents([]), RANKS), RANKS).count() == 0


def test_token_files(documents, spark, monkeypatch):
    texts = SPECIAL + mixed(80, 9) + alike()
    ids = list(range(len(texts)))
    random.Random(1).shuffle(ids)
    ids[3] = ids[4] = 7
    folder = work_folder(spark, "token-test")
    token_output.write(documents(texts, ids, extra=["x"] * len(texts)), folder, JSON)
    got = token_output.digests(token_output.read(spark, folder)).orderBy("start").collect()
    library = Tokenizer.from_file(JSON)
    start = 0
    for row, (i, text) in zip(got, sorted(zip(ids, texts), key=lambda x: (x[0], x[1] or "")), strict=True):
        want = library.encode(text or "", add_special_tokens=False).ids + [0]
        assert tuple(row) == (i, start, len(want), zlib.crc32(np.array(want, "<u4").tobytes()))
        start += len(want)


def test_query_recognises_special_tokens_like_the_library(spark, tmp_path):
    end = "<|endoftext|>"
    texts = [*SPECIAL, f"a{end}b", f"a {end} b", f"{end}{end}'s x", f"{end} ", "<|endof", "text|>", f"<{end[:-1]}{end}", *mixed(40, 3)]
    rows = list(enumerate(texts)) + [(100 + k, end.join(mixed(5, k))) for k in range(20)]
    shipped(spark).createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op8_token_output"](spark, str(tmp_path)).orderBy("start").collect()
    library, start = Tokenizer.from_file(JSON), 0
    for row, (i, text) in zip(got, sorted(rows), strict=True):
        want = library.encode(text or "", add_special_tokens=False).ids + [0]
        assert tuple(row) == (i, start, len(want), zlib.crc32(np.array(want, "<u4").tobytes()))
        start += len(want)


def test_token_files_of_nothing_and_of_a_null_id(documents, spark):
    for k, (texts, ids) in enumerate((([], []), (["a", "b"], [None, 1]))):
        folder = work_folder(spark, f"token-{k}")
        token_output.write(documents(texts, ids), folder, JSON)
        assert [r["doc_id"] for r in token_output.read(spark, folder).orderBy("start").collect()] == ids


def test_grammar():
    rng = np.random.default_rng(3)
    ids = np.concatenate([np.tile(rng.integers(0, 50, 30), 40), np.full(500, 7), rng.integers(0, 50257, 300)])
    ends = np.zeros(len(ids), bool)
    ends[[10, 11, 700, len(ids) - 1]] = True
    rules, symbols, last = token_output.compress(ids, ends, 50257)
    assert len(rules) and len(symbols) < len(ids) / 2
    pairs = [(a, b) for a, b, end in zip(symbols.tolist(), symbols[1:].tolist(), last.tolist()) if not end]
    places, before = {}, {}
    for i, pair in enumerate(pairs):
        if before.get(pair, -2) != i - 1:
            places[pair], before[pair] = places.get(pair, 0) + 1, i
    assert max(places.values()) < token_output.LEAST
    assert (token_output.expand(symbols, rules, 50257) == ids).all()
    sizes = token_output.lengths(rules, 50257)
    of = np.where(symbols < 50257, 1, sizes[np.maximum(symbols - 50257, 0)])
    assert (np.cumsum(of)[last] - 1 == np.flatnonzero(ends)).all()
    for a, b in ((0, 0), (0, 5), (37, 900), (len(ids) - 3, len(ids))):
        assert (token_output.stretch(symbols, rules, sizes, 50257, a, b) == ids[a:b]).all()


@pytest.mark.parametrize("byte_pieces", [True, False])
def test_counts_equal_the_unigram_library(byte_pieces):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    every = range(model.get_piece_size())
    plain = {
        model.id_to_piece(i): model.get_score(i)
        for i in every
        if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i))
    }
    some = [("<unk>", 0.0)] + [(f"<0x{i:02X}>", 0.0) for i in range(256)] * byte_pieces
    library = Tokenizer(models.Unigram(some + list(plain.items()), unk_id=0, byte_fallback=byte_pieces))
    own = token_counts.Unigram(plain, byte_pieces)
    texts = [t or "" for t in SPECIAL if not t or len(t) < 5000] + mixed(120, 4) + alike()
    got = np.concatenate([token_counts.count(own, t) for t in _text.texts(pa.array(texts), 500)])
    want = [len(library.encode("▁" + t.replace(" ", "▁"), add_special_tokens=False).ids) if t else 0 for t in texts]
    assert got.tolist() == want


def test_count_query(documents):
    df = token_counts.token_counts(documents([None, "", "the cat", "the cat"], N_pieces=["x"] * 4), PIECES)
    assert df.columns == ["doc_id", "text", "n_pieces"]
    rows = [r["n_pieces"] for r in df.orderBy("doc_id").collect()]
    assert rows[:2] == [0, 0] and rows[2] == rows[3] > 0
    assert token_counts.token_counts(documents([]), PIECES).count() == 0


def test_ties_go_to_the_longest_last_piece():
    own = token_counts.Unigram({"a": -1.0, "b": -1.0, "c": -1.0, "ab": -2.0, "bc": -2.0, "abc": -3.0}, False)
    assert own.counts(["abc", "ab", "zz", "za"]).tolist() == [1, 1, 1, 2]
    with pytest.raises(ValueError):
        token_counts.Unigram({"a▁b": -1.0}, False)
