"""Operator 3: byte-level BPE encoding and decoding over padded numpy matrices.

``encode`` cuts every whole text by the public pattern, takes each distinct piece once
in a worker while there is room (``_kept``: equal bytes, not equal hashes), sorts the pieces into buckets of like length, and merges all rows of a
bucket together: each round every row merges its leftmost pair of least rank, pairs are
looked up in a hash table, and the matrix is compacted by the column that every row
loses. ``decode`` turns ids back into bytes.

Both are narrow: nothing is shuffled, a task holds one slice of texts, and a lost task
is simply run again. Ids are the ranks of the vocabulary file, so nothing is trained.

Defined cases: a null or empty text has no ids and decodes to no bytes; null ids decode
to null; rows are kept one to one, repeated ones too; all columns of the input are kept
and ``ids`` or ``decoded`` replaces a column of that name, whatever its case. A piece
longer than ``LONG`` bytes is merged with a heap over linked positions by the same
rule, as a matrix would grow with the square of its length.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from martweave.llm import _kept, _text

LONG = 4096
KEPT, ROOM = 400_000, 32 << 20  # pieces and bytes that a worker keeps
_NONE = np.int64(1) << 40
_PAD = (1 << 24) - 1


class Ranks(NamedTuple):
    """A rank file: ids of single bytes, hash tables of pairs and of whole tokens, the tokens' bytes, and pieces met before."""

    single: np.ndarray
    pair_key: np.ndarray
    pair_id: np.ndarray
    whole_hash: np.ndarray
    whole_id: np.ndarray
    token_bytes: np.ndarray
    token_at: np.ndarray
    kept: _kept.Kept


def _slots(key: np.ndarray, bits: int) -> np.ndarray:
    return (key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)


def _hash_table(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Open addressing with at least four slots a key; an empty slot holds 0, so keys are not 0."""
    bits = max(4, int(len(keys) * 4).bit_length())
    table, value = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int64)
    left, slot = np.arange(len(keys)), _slots(keys, bits).astype(np.int64)
    while len(left):
        free = table[slot] == 0
        table[slot[free]] = keys[left[free]]
        placed = table[slot] == keys[left]
        value[slot[placed]] = values[left[placed]]
        left, slot = left[~placed], (slot[~placed] + 1) & ((1 << bits) - 1)
    return table, value


@lru_cache(2)
def ranks(path: str) -> Ranks:
    """Read the rank file: a base64 token and its rank in each line."""
    token = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    single = np.array([token[bytes([b])] for b in range(256)], np.int64)
    keys, ids = [], []
    for text, rank in token.items():
        for cut in range(1, len(text)):
            left, right = token.get(text[:cut]), token.get(text[cut:])
            if left is not None and right is not None:
                keys.append((left << 24 | right) + 1)
                ids.append(rank)
    ordered = sorted((rank, text) for text, rank in token.items())
    lengths = np.zeros(ordered[-1][0] + 1, np.int64)
    lengths[[rank for rank, _ in ordered]] = [len(text) for _, text in ordered]
    joined = np.frombuffer(b"".join(text for _, text in ordered), np.uint8)
    at = np.concatenate([[0], np.cumsum(lengths)])
    whole = _text.hashes(joined, at[:-1][lengths > 0], at[1:][lengths > 0])
    order = np.argsort(whole)
    table, value = _hash_table(np.array(keys, np.uint64), np.array(ids, np.int64))
    return Ranks(single, table, value, whole[order], np.flatnonzero(lengths > 0)[order], joined, at, _kept.Kept(KEPT, ROOM))


def _rank(r: Ranks, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The rank that each pair merges to, or ``_NONE``."""
    key = ((left.astype(np.uint64) << np.uint64(24)) | right.astype(np.uint64)) + np.uint64(1)
    bits = len(r.pair_key).bit_length() - 1
    slot = _slots(key, bits).astype(np.int64)
    found = r.pair_key[slot]
    out = np.where(found == key, r.pair_id[slot], _NONE)
    left_over = np.flatnonzero((found != key) & (found != 0))
    slot, key = slot[left_over], key[left_over]
    while len(left_over):
        slot = (slot + 1) & (len(r.pair_key) - 1)
        found = r.pair_key[slot]
        hit = found == key
        out[left_over[hit]] = r.pair_id[slot[hit]]
        on = ~hit & (found != 0)
        left_over, slot, key = left_over[on], slot[on], key[on]
    return out


def _merge_matrix(r: Ranks, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of pieces of two bytes or more, row after row, and their number for each row."""
    width = int(length.max())
    column = np.arange(width)
    inside = column < length[:, None]
    ids = np.full(inside.shape, _PAD, np.int64)
    ids[inside] = r.single[data[_text.ranges(start, length)]]
    rank = np.full((len(start), width - 1), _NONE, np.int64)
    real = inside[:, 1:]
    rank[real] = _rank(r, ids[:, :-1][real], ids[:, 1:][real])
    row = np.arange(len(start))
    left = length.copy()
    done: list[tuple[np.ndarray, np.ndarray]] = []
    while len(row):
        at = rank.argmin(1) if rank.shape[1] else np.zeros(len(row), np.int64)
        least = rank[np.arange(len(row)), at] if rank.shape[1] else np.full(len(row), _NONE)
        ended = least == _NONE
        if ended.any():
            done.append((row[ended], ids[ended]))
            on = ~ended
            row, ids, rank, at, least = row[on], ids[on], rank[on], at[on], least[on]
            if not len(row):
                break
        each = np.arange(len(row))
        ids[each, at] = least
        keep = np.ones(ids.shape, bool)
        keep[each, at + 1] = False
        ids = ids[keep].reshape(len(row), -1)
        keep = np.ones(rank.shape, bool)
        keep[each, at] = False
        rank = rank[keep].reshape(len(row), -1)
        left[row] -= 1
        has = at > 0
        i, j = each[has], at[has]
        rank[i, j - 1] = _rank(r, ids[i, j - 1], ids[i, j])
        has = at + 1 < left[row]
        i, j = each[has], at[has]
        rank[i, j] = _rank(r, ids[i, j], ids[i, j + 1])
        width = int(left[row].max())
        ids, rank = ids[:, :width], rank[:, : max(width - 1, 0)]
    at = np.cumsum(left) - left
    out = np.zeros(int(left.sum()), np.int64)
    for rows, matrix in done:
        column = np.arange(matrix.shape[1])
        out[_text.ranges(at[rows], left[rows])] = matrix[column < left[rows][:, None]]
    return out, left


def _merge_long(r: Ranks, ids: np.ndarray) -> np.ndarray:
    """The same merges for one very long piece: a heap of (rank, position) over linked positions."""
    ids = ids.copy()
    n = len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    alive = np.ones(n, bool)
    first = _rank(r, ids[:-1], ids[1:])
    now = first.tolist() + [int(_NONE)]
    heap = [(k, i) for i, k in enumerate(now) if k != _NONE]
    heapq.heapify(heap)

    def renew(i: int) -> None:
        j = after[i]
        now[i] = int(_rank(r, ids[i : i + 1], ids[j : j + 1])[0]) if j < n else int(_NONE)
        if now[i] != _NONE:
            heapq.heappush(heap, (now[i], i))

    while heap:
        k, i = heapq.heappop(heap)
        if not alive[i] or now[i] != k:
            continue
        j = after[i]
        ids[i] = k
        alive[j] = False
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        renew(i)
        if before[i] >= 0:
            renew(before[i])
    return ids[alive]


def merge(r: Ranks, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pieces, piece after piece, and each piece's bound in them."""
    length = end - start
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(1, np.int64)
    count = np.ones(len(start), np.int64)
    key = _text.hashes(data[_text.ranges(start, length)], np.cumsum(length) - length, np.cumsum(length))
    near = np.minimum(np.searchsorted(r.whole_hash, key), len(r.whole_hash) - 1)
    whole = r.whole_hash[near] == key
    # A token is taken for a piece only if their bytes are equal.
    maybe = np.flatnonzero(whole)
    token = r.whole_id[near[maybe]]
    size = r.token_at[token + 1] - r.token_at[token]
    like = size == length[maybe]
    whole[maybe[~like]] = False
    maybe, token, size = maybe[like], token[like], size[like]
    other = data[_text.ranges(start[maybe], size)] != r.token_bytes[_text.ranges(r.token_at[token], size)]
    whole[maybe[np.searchsorted(np.cumsum(size), np.flatnonzero(other), "right")]] = False
    parts: list[tuple[np.ndarray, np.ndarray]] = [(np.flatnonzero(whole), r.whole_id[near[whole]])]
    rest = np.flatnonzero(~whole)
    bucket = np.ceil(np.log2(length[rest])).astype(int)
    for size in np.unique(bucket):
        rows = rest[bucket == size]
        if 1 << int(size) > LONG:
            for row in rows:
                ids = _merge_long(r, r.single[data[start[row] : end[row]]])
                count[row] = len(ids)
                parts.append((np.array([row]), ids))
            continue
        step = max(1, (1 << 19) >> int(size))
        for k in range(0, len(rows), step):
            some = rows[k : k + step]
            ids, count[some] = _merge_matrix(r, data, start[some], length[some])
            parts.append((some, ids))
    bound = np.concatenate([[0], np.cumsum(count)])
    out = np.zeros(bound[-1], np.int64)
    for rows, ids in parts:
        out[_text.ranges(bound[rows], count[rows])] = ids
    return out, bound


def encoded(r: Ranks, t: _text.Texts) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a slice of texts, and each row's bound in them."""
    span = _text.pieces(t)
    if not len(span.start):
        return np.zeros(0, np.int64), np.zeros(len(t.at), np.int64)

    def make(new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ids, bound = merge(r, t.data, span.start[new], span.end[new])
        return ids, np.diff(bound)

    ids, count = r.kept.get(t.data, span.start, span.end, make)
    total = np.concatenate([[0], np.cumsum(count)])
    return ids, total[span.row]


def decoded(r: Ranks, ids: np.ndarray) -> np.ndarray:
    """The bytes of ids, one after the other."""
    return r.token_bytes[_text.ranges(r.token_at[ids], r.token_at[ids + 1] - r.token_at[ids])]


def _others(df: DataFrame, *made: str) -> list[str]:
    return [c for c in df.columns if c.lower() not in made]


def encode(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``df`` with ``ids``: the token ids of its whole ``text``, as array<int>."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = ranks(path)
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            for t in _text.texts(column):
                ids, bound = encoded(r, t)
                made = pa.ListArray.from_arrays(pa.array(bound, pa.int32()), pa.array(ids, pa.int32()))
                rest = [c.slice(t.first, t.last - t.first) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays([*rest, made], names=[*batch.schema.names[:-1], "ids"])

    kept = df.select(*(f"`{c}`" for c in _others(df, "ids")))
    fields = [*kept.schema.fields, StructField("ids", ArrayType(IntegerType()))]
    return kept.withColumn("ids", df[text].cast("string")).mapInArrow(run, StructType(fields))


def _bytes_of(r: Ranks, column: pa.ListArray) -> pa.BinaryArray:
    """The bytes of each list of ids; null for a null list."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    count = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    size = r.token_at[flat + 1] - r.token_at[flat]
    at = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(count)])]
    data = decoded(r, flat)
    nulls = pa.array(column.is_valid()) if column.null_count else None
    return pa.BinaryArray.from_buffers(
        pa.binary(),
        len(column),
        [nulls.buffers()[1] if nulls is not None else None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data)],
    )


def decode(df: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``df`` with ``decoded``: the bytes that its ``ids`` stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = ranks(path)
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                some = batch.slice(first, 256)
                made = _bytes_of(r, some.column(some.num_columns - 1))
                yield pa.RecordBatch.from_arrays([*some.columns[:-1], made], names=[*some.schema.names[:-1], "decoded"])

    kept = df.select(*(f"`{c}`" for c in _others(df, "decoded")))
    fields = [*kept.schema.fields, StructField("decoded", BinaryType())]
    return kept.withColumn("decoded", F.col(ids)).mapInArrow(run, StructType(fields))


def round_trip(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``df`` without ``text``, with ``ids`` as of :func:`encode` and ``decoded`` as of :func:`decode` of them.

    One worker does both for a slice, so that a task holds the rank file once, each text
    goes to Python once and the ids do not go there again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = ranks(path)
        for batch in batches:
            for t in _text.texts(batch.column(batch.num_columns - 1)):
                ids, bound = encoded(r, t)
                made = pa.ListArray.from_arrays(pa.array(bound, pa.int32()), pa.array(ids, pa.int32()))
                rest = [c.slice(t.first, t.last - t.first) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [*rest, made, _bytes_of(r, made)], names=[*batch.schema.names[:-1], "ids", "decoded"]
                )

    kept = df.select(*(f"`{c}`" for c in _others(df, "ids", "decoded", text.lower())))
    fields = [*kept.schema.fields, StructField("ids", ArrayType(IntegerType())), StructField("decoded", BinaryType())]
    sent = df.select(*(df[f"`{c}`"] for c in kept.columns), df[text].cast("string").alias("_encoded"))
    return sent.mapInArrow(run, StructType(fields))


def digests(df: DataFrame) -> DataFrame:
    """Of rows with ``ids`` and ``decoded``: number and digest of the ids, digest of the bytes."""
    return df.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
