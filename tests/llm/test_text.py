"""The byte-wise helpers against plain Python."""

from __future__ import annotations

import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from martweave.llm import _text

SIGNS = "abzAZ019 \t\n'’`-_.é日ßİſ  　²🙂stremlvd"
texts = st.lists(st.none() | st.text(SIGNS, max_size=60) | st.text(max_size=20), max_size=12)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def rows(values, limit=64):
    for t in _text.texts(pa.array(values, pa.string()), limit):
        yield t


@settings(max_examples=150, deadline=None)
@given(texts)
def test_words(values):
    got = []
    for t in rows(values):
        data, span = _text.words(t)
        for a, b in zip(span.row[:-1], span.row[1:]):
            got.append([data[span.start[i] : span.end[i]].tobytes().decode() for i in range(a, b)])
    assert got == [WORD.findall(low(v)) for v in values]


@settings(max_examples=150, deadline=None)
@given(texts)
def test_pieces(values):
    pattern, got = regex.compile(public_tokenizers.PATTERN), []
    for t in rows(values):
        span = _text.pieces(t)
        for a, b in zip(span.row[:-1], span.row[1:]):
            got.append([t.data[span.start[i] : span.end[i]].tobytes().decode() for i in range(a, b)])
    assert got == [pattern.findall(v or "") for v in values]


def test_hashes_tell_spans_apart_and_do_not_depend_on_place():
    t = next(_text.texts(pa.array(["ab ba ab a b abc", "ab abc"])))
    data, span = _text.words(t)
    key = _text.hashes(data, span.start, span.end)
    words = WORD.findall("ab ba ab a b abc ab abc")
    assert len(set(key.tolist())) == len(set(words))
    assert all((key[i] == key[j]) == (words[i] == words[j]) for i in range(8) for j in range(8))


def test_grams():
    for words in ([], ["a"], ["a", "b", "c"], ["a", "b", "c", "d", "e"]):
        key = np.array([hash(w) & 0xFFFF for w in words], np.uint64)
        gram, bound = _text.grams(key, np.array([0, len(words)]), 3)
        assert len(gram) == (max(len(words) - 2, 1) if words else 0) and bound.tolist() == [0, len(gram)]


def test_sliced_column_and_one_long_row():
    column = pa.array(["x", "abc" * 100, None, "", "é"]).slice(1)
    got = [(t.first, t.last, t.data.tobytes().decode()) for t in _text.texts(column, 10)]
    assert "".join(g[2] for g in got) == "abc" * 100 + "é" and got[0][:2] == (0, 1)
    assert list(_text.texts(pa.array([], pa.string()))) == []
