"""Texts of an Arrow column as numpy arrays: bytes, words and tokenizer pieces.

Everything works on the UTF-8 bytes of many rows at once, so that no Python object is
made per word. A slice holds whole rows and, but for a single longer row, at most
``SLICE`` bytes, which bounds the memory of a task whatever the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType

SLICE = 1_000_000
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


class Texts(NamedTuple):
    """``data`` holds the bytes of the rows ``first`` to ``last``; row i is at ``at[i]:at[i + 1]``."""

    first: int
    last: int
    data: np.ndarray
    at: np.ndarray


class Spans(NamedTuple):
    """Byte spans in ``Texts.data``; those of row i are ``row[i]:row[i + 1]``."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray


def place(df: DataFrame, text: str) -> int | None:
    """Which column of ``df`` is ``text``, if it is a string already and so need not go to Python a second time."""
    found = [k for k, f in enumerate(df.schema.fields) if f.name.lower() == text.lower() and f.dataType == StringType()]
    return found[0] if len(found) == 1 else None


def texts(column: pa.Array, limit: int = SLICE) -> Iterator[Texts]:
    """The rows in slices; a null is an empty text."""
    if len(column) == 0:
        return
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield Texts(first, last, whole[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


@lru_cache(None)
def _byte_classes(digits: bool) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased bytes (A-Z only), and which bytes belong to words."""
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    inside = np.zeros(256, bool)
    inside[48:58] = digits
    inside[97:123] = inside[65:91] = inside[128:] = True
    return lower, inside


def words(t: Texts, digits: bool = True) -> tuple[np.ndarray, Spans]:
    """The bytes with A-Z lower-cased, and the words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` in them.

    Without ``digits`` the terms ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+``.
    """
    lower, inside = _byte_classes(digits)
    flag = inside[t.data]
    edge = np.zeros(len(flag) + 1, bool)
    edge[t.at] = True
    before = np.zeros(len(flag), bool)
    before[1:] = flag[:-1]
    after = np.zeros(len(flag), bool)
    after[:-1] = flag[1:]
    start = np.flatnonzero(flag & (~before | edge[:-1]))
    end = np.flatnonzero(flag & (~after | edge[1:])) + 1
    return lower[t.data], Spans(start, end, np.searchsorted(start, t.at))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits over 64 bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@lru_cache(None)
def _byte_keys() -> np.ndarray:
    """A random number for each byte at each of 64 places."""
    return mix(np.arange(1, (64 << 8) + 1, dtype=np.uint64) * _GOLDEN)


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span; the spans are in order and do not overlap.

    A sum of what each byte means at its place, which no polynomial in one base is.
    Equal hashes still are no proof of equal bytes.
    """
    if len(start) == 0:
        return np.zeros(0, np.uint64)
    length = end - start
    if int(length.sum()) != len(data):
        keep = np.zeros(len(data) + 1, np.int8)
        np.add.at(keep, start, 1) if len(start) < 8 else keep.__setitem__(start, 1)
        closing = np.zeros(len(data) + 1, np.int8)
        closing[end] = 1
        data = data[np.cumsum(keep - closing, dtype=np.int8)[:-1].astype(bool)]
    first = np.cumsum(length) - length
    # A byte's place in its span; narrow integers, as there is one for each byte.
    within = np.arange(len(data), dtype=np.int32)
    within -= np.repeat(first.astype(np.int32), length)
    place = (within & 63).astype(np.uint16)
    place <<= np.uint16(8)
    place |= data
    value = _byte_keys()[place]
    far = np.flatnonzero(within > 63)
    value[far] = mix(value[far] ^ ((within[far] >> 6).astype(np.uint64) * _GOLDEN))
    return mix(np.add.reduceat(value, first) + length.astype(np.uint64) * _GOLDEN)


def grams(word: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``n`` consecutive words, and the rows' bounds in them.

    A row of fewer words, but not none, has one gram of all its words.
    """
    count = np.diff(row)
    made = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    bound = np.concatenate([[0], np.cumsum(made)])
    first = np.repeat(row[:-1], made) + np.arange(bound[-1]) - np.repeat(bound[:-1], made)
    size = np.minimum(np.repeat(count, made), n)
    out = size.astype(np.uint64)
    padded = np.concatenate([word, np.zeros(n, np.uint64)])
    factor = _powers(n + 1, 0xA0761D6478BD642F)
    for k in range(n):
        out = out + np.where(k < size, padded[first + k] * factor[k + 1], np.uint64(0))
    return mix(out), bound


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (length[0] of them), then those of start[1], and so on."""
    total = int(length.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    offset = np.cumsum(length) - length
    return np.arange(total) + np.repeat(start - offset, length)


# --- pieces of a byte-level tokenizer ----------------------------------------

LETTER, NUMBER, SPACE = 1, 2, 3


@lru_cache(None)
def _classes() -> np.ndarray:
    """The class of every code point: letter, number, white space or other (0)."""
    import regex

    out = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        found = "".join(regex.findall(pattern, every))
        out[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = kind
    return out


def pieces(t: Texts) -> Spans:
    """The matches of the public byte-level pattern: contractions, words, numbers, signs, white space.

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+
    """
    if len(t.data) == 0:
        return Spans(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(t.at), np.int64))
    code = np.frombuffer(t.data.tobytes().decode().encode("utf-32-le"), np.uint32)
    at = np.flatnonzero((t.data & 0xC0) != 0x80)
    n = len(code)
    kind = _classes()[code]
    edge = np.zeros(n + 1, bool)
    edge[np.searchsorted(at, t.at)] = True
    edge[n] = True
    cut = edge.copy()
    cut[1:n] |= kind[1:] != kind[:-1]
    # The last of several white space characters stands alone; a blank joins what follows it.
    last = np.flatnonzero((kind == SPACE) & cut[1:] & ~edge[1:])
    cut[last] = True
    cut[last[code[last] == 32] + 1] = False
    quote = np.flatnonzero((code == 39) & cut[:n] & ~edge[1:])
    if len(quote):
        more = np.concatenate([code, np.zeros(3, np.uint32)])
        one, two = more[quote + 1], more[quote + 2]
        single = np.isin(one, [ord(c) for c in "stmd"])
        double = np.zeros(len(quote), bool)
        for a, b in ("re", "ve", "ll"):
            double |= (one == ord(a)) & (two == ord(b))
        double &= ~edge[np.minimum(quote + 2, n)]
        size = np.where(single, 2, np.where(double, 3, 0))
        hit = size > 0
        cut[quote[hit] + 1] = False
        cut[quote[hit] + size[hit]] = True
    first = np.flatnonzero(cut[:n])
    start = at[first]
    return Spans(start, np.append(start[1:], len(t.data)), np.searchsorted(start, t.at))
