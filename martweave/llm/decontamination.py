"""Operator 7: find benchmark passages in documents with a prefix-filtered set join.

Words are runs of letters and digits, A-Z lower-cased. A window is ``window`` consecutive
words of an item (a shorter item is one window). It is found through shingles of
``shingle`` words: all shingles of a window must occur in the document one after the
other, so a document needs to be looked at only where the window's rarest shingle occurs.

1. The shingles of all items are counted in all documents (tasks add up first).
2. Each window keeps its rarest shingle, the necessary prefix of its shingles in order
   of rarity, and where in the window it stands. Neighbouring windows often share it.
3. Documents meet these prefixes by hash. The place in the window gives the only start
   that is possible; the window must end before the document does; then its words are
   compared one by one, as bytes.

The index of windows is broadcast in pieces of at most ``INDEX`` windows, each proven by
its count, and documents are read once for each piece, so a larger benchmark takes more
passes instead of more memory. Documents are never shuffled; what leaves a task in step
1 is one row for each shingle of the items that it has met, and in step 3 spans.

Defined cases: a null text has no words; an item without words, a null one, or one whose
id is null is left out; equal items under several ids count once for each id; an item id
that repeats joins its texts' windows; with no items all documents are clean; rows are
kept one to one, repeated ones too; all columns of the documents are kept, and columns
made here replace those of the same name, whatever its case.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from martweave.llm import _text

WINDOW, SHINGLE, INDEX = 10, 3, 50_000
MADE = ("n_words", "n_hit", "items", "spans")


def _joined(data: np.ndarray, span: _text.Spans, a: int, b: int) -> bytes:
    return b" ".join(data[span.start[i] : span.end[i]].tobytes() for i in range(a, b))


def windows(benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """Distinct windows of the items: item_id, words (one blank between two), n, grams (hashes of shingles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in _text.texts(batch.column(1)):
                data, span = _text.words(t)
                word = _text.hashes(data, span.start, span.end)
                ids = batch.column(0).slice(t.first, t.last - t.first).to_pylist()
                out: dict[tuple, list[int]] = {}
                for i, item in enumerate(ids):
                    a, b = int(span.row[i]), int(span.row[i + 1])
                    for k in range(a, max(b - window, a) + 1 if b > a else a):
                        end = min(k + window, b)
                        gram, _ = _text.grams(word[k:end], np.array([0, end - k]), min(shingle, end - k))
                        out[item, _joined(data, span, k, end), end - k] = gram.view(np.int64).tolist()
                yield pa.RecordBatch.from_pydict(
                    {
                        "item_id": pa.array([k[0] for k in out], pa.int64()),
                        "words": pa.array([k[1] for k in out], pa.binary()),
                        "n": pa.array([k[2] for k in out], pa.int32()),
                        "grams": pa.array(list(out.values()), pa.list_(pa.int64())),
                    }
                )

    kept = benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull())
    made = kept.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    return made.mapInArrow(run, "item_id long, words binary, n int, grams array<long>").distinct()


def frequencies(documents: DataFrame, index: list[tuple[np.ndarray, int]], text: str) -> DataFrame:
    """How often the shingles occur in all documents: gram, n."""
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(len(wanted), np.int64) for wanted, _ in shared.value]
        for batch in batches:
            for t in _text.texts(batch.column(0)):
                data, span = _text.words(t)
                word = _text.hashes(data, span.start, span.end)
                for (wanted, size), total in zip(shared.value, sums):
                    gram, _ = _exact_grams(word, span.row, size)
                    place, _ = _find(wanted, gram)
                    total += np.bincount(place, minlength=len(wanted))
        for (wanted, _), total in zip(shared.value, sums):
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict(
                {"gram": pa.array(wanted[some].view(np.int64)), "n": pa.array(total[some])}
            )

    made = documents.select(F.col(text).cast("string")).mapInArrow(run, "gram long, n long")
    return made.groupBy("gram").agg(F.sum("n").alias("n"))


def _exact_grams(word: np.ndarray, row: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of exactly ``size`` words, and each one's first word."""
    count = np.maximum(np.diff(row) - size + 1, 0)
    first = _text.ranges(row[:-1], count)
    factor = _text._powers(size + 1, 0xA0761D6478BD642F)
    out = np.full(len(first), size, np.uint64)
    for k in range(size):
        out = out + word[first + k] * factor[k + 1]
    return _text.mix(out), first


def _find(wanted: np.ndarray, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``wanted`` (sorted) of the grams that are in it, and which grams they are.

    A table of one bit for each of the top bits rules out most before the search.
    """
    if not len(wanted) or not len(gram):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    bits = min(24, max(8, len(wanted).bit_length() + 5))
    table = np.zeros(1 << bits, bool)
    table[wanted >> np.uint64(64 - bits)] = True
    maybe = np.flatnonzero(table[gram >> np.uint64(64 - bits)])
    place = np.minimum(np.searchsorted(wanted, gram[maybe]), len(wanted) - 1)
    hit = wanted[place] == gram[maybe]
    return place[hit], maybe[hit]


def _by_size(rows: list, shingle: int) -> list[tuple[np.ndarray, int]]:
    """The distinct shingles of the windows by number of words, sorted."""
    out: dict[int, set[int]] = {}
    for row in rows:
        out.setdefault(min(shingle, row["n"]), set()).update(row["grams"])
    return [(np.sort(np.array(list(g), np.int64).view(np.uint64)), n) for n, g in sorted(out.items())]


def _index(rows: list, often: dict[int, int], shingle: int) -> list[tuple]:
    """For each number of words a shingle has: prefixes (sorted), bounds of their windows, and the windows."""
    groups: dict[int, dict[int, list]] = {}
    for row in rows:
        at = min(range(len(row["grams"])), key=lambda i: (often.get(row["grams"][i], 0), i))
        if often.get(row["grams"][at], 0):  # a shingle that occurs nowhere rules its windows out
            found = groups.setdefault(min(shingle, row["n"]), {}).setdefault(row["grams"][at], [])
            found.append((at, row["n"], row["words"], row["items"]))
    out = []
    for size, prefixes in sorted(groups.items()):
        keys = np.sort(np.array(list(prefixes), np.int64).view(np.uint64))
        lists = [prefixes[int(k)] for k in keys.view(np.int64)]
        out.append((size, keys, lists))
    return out


def _matches(documents: DataFrame, index: list[tuple], text: str) -> DataFrame:
    """``documents`` with what the windows of ``index`` add to the items and spans found before."""
    shared = documents.sparkSession.sparkContext.broadcast(index)

    def found(data: np.ndarray, span: _text.Spans, word: np.ndarray) -> dict[int, list]:
        out: dict[int, list] = {}
        for size, prefixes, lists in shared.value:
            gram, first = _exact_grams(word, span.row, size)
            place, which = _find(prefixes, gram)
            rows = np.searchsorted(span.row, first[which], "right") - 1
            for p, w, row in zip(place.tolist(), first[which].tolist(), rows.tolist()):
                low, high = int(span.row[row]), int(span.row[row + 1])
                for at, n, words, items in lists[p]:
                    a = w - at
                    if a >= low and a + n <= high and _joined(data, span, a, a + n) == words:
                        out.setdefault(row, []).append((a - low, a - low + n, items))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: list[tuple] = []
            for t in _text.texts(batch.column(width + 2 if place is None else place)):
                data, span = _text.words(t)
                hits = found(data, span, _text.hashes(data, span.start, span.end))
                old_items, old_spans = (batch.column(width + k).slice(t.first, t.last - t.first) for k in (0, 1))
                for row, count in enumerate(np.diff(span.row).tolist()):
                    items, spans = old_items[row].as_py(), [tuple(s) for s in old_spans[row].as_py()]
                    if row in hits:
                        items = sorted({*items, *(i for _, _, own in hits[row] for i in own)})
                        spans = sorted({*spans, *((a, b) for a, b, _ in hits[row])})
                    n_hit = reach = 0
                    for a, b in spans:
                        n_hit += max(b - max(a, reach), 0)
                        reach = max(reach, b)
                    made.append((count, n_hit, items, spans))
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.list_(pa.int64())))
            columns = [pa.array([m[k] for m in made], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:width], *columns], names=[*batch.schema.names[:width], *MADE]
            )

    longs = ArrayType(LongType())
    kinds = (LongType(), LongType(), longs, ArrayType(longs))
    kept = documents.select(*(f"`{c}`" for c in documents.columns if c.lower() not in MADE))
    width, place = len(kept.columns), _text.place(kept, text)
    fields = [*kept.schema.fields, *(StructField(n, k) for n, k in zip(MADE, kinds))]
    before = [documents[c] for c in ("items", "spans")]
    searched = [] if place is not None else [documents[text].cast("string").alias("_searched")]
    sent = documents.select(*(documents[c] for c in kept.columns), *before, *searched)
    return sent.mapInArrow(run, StructType(fields))


def decontaminate(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    shingle: int = SHINGLE,
    text: str = "text",
    index: int = INDEX,
) -> DataFrame:
    """``documents`` with n_words, n_hit, items (ids with windows in the text) and spans (of words).

    A word is hit if any occurrence of a window covers it.
    """
    grouped = (
        windows(benchmark, window, shingle)
        .groupBy("words", "n")
        .agg(F.sort_array(F.collect_set("item_id")).alias("items"), F.first("grams").alias("grams"))
    )
    pieces = max(1, -(-grouped.count() // index))
    place = F.pmod(F.xxhash64("words"), F.lit(pieces))
    out = documents.select(
        *(f"`{c}`" for c in documents.columns if c.lower() not in MADE),
        F.array().cast("array<long>").alias("items"),
        F.array().cast("array<array<long>>").alias("spans"),
    )
    for piece in range(pieces):
        rows = grouped.where(place == piece).collect()
        often = {r["gram"]: r["n"] for r in frequencies(documents, _by_size(rows, shingle), text).collect()}
        out = _matches(out, _index(rows, often, shingle), text)
    return out


def digests(df: DataFrame) -> DataFrame:
    """The items as a digest of their ids in the order of their texts."""
    names = F.array_sort(F.col("items").cast("array<string>"))
    return df.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
