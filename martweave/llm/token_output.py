"""Operator 8: token ids in files compressed by a Re-Pair grammar.

``write`` sorts the documents by id over the cluster (one range shuffle), encodes every
whole text and stores blocks of whole documents. In each block frequent pairs of ids are
replaced by new symbols, round after round; no symbol crosses the end of a document, so
a document's symbols are a span of its own. ``read`` expands blocks, each by itself.

The file format is a Parquet table, so that any store and a lost task are Spark's
business; one row is one block of at most ``BLOCK`` ids (a longer document is a block):

    part, block   place in the order of the whole: parts are ranges of doc_id
    start         number of ids before the block in its part
    doc_id        list of the block's documents, in order
    doc_ids       list: number of ids of each document, its end id included
    doc_symbols   list: number of symbols of each document
    rules         little-endian int32 pairs: what symbol ``base + i`` stands for
    lengths       little-endian int32: number of ids that symbol ``base + i`` expands to
    symbols       little-endian int32: the compressed ids
    base, n_ids   the first symbol that is a rule; ids in the block

With ``lengths`` any stretch of a document is decoded without expanding the rest
(``stretch``).

Encoding goes through the tokenizers library. It splits a text by the public byte-level
pattern and encodes every piece alone, so each distinct piece is given to it once and
kept (at most ``KEPT`` pieces and ``ROOM`` bytes a worker) instead of once for every time it occurs; bytes
are compared before a kept piece stands for another. Many new pieces go in one text, a
line each. The file's added tokens are recognised wherever they are written in a text,
as the library does by default: the text is cut at them, leftmost and longest first,
each is its own id, and what lies between is a text for the pattern.

The grammar of a block ends when no pair occurs ``LEAST`` times. A rule takes 12 bytes
and each place it replaces saves 4, so rarer pairs hardly pay.

Defined cases: a null or empty text is its end id alone; documents of one id follow each
other in the order of their texts' first ``PREFIX`` characters, then of a hash, so that an
id with very many rows is spread over tasks; a null id comes first and stays null; further
columns are left out; no documents give no rows.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martweave.llm import _kept, _text

BLOCK = 1 << 20
KEPT, ROOM = 2_000_000, 160 << 20
LINES = 2000
END = 0
LEAST = 8
PREFIX = 40
BINS = 18
SLICE = 1_000_000

FORMAT = (
    "part int, block int, start long, doc_id array<long>, doc_ids array<int>, doc_symbols array<int>,"
    " rules binary, lengths binary, symbols binary, base int, n_ids long"
)


class Encoder:
    """Ids of pieces by the tokenizers library, each distinct piece asked for once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.size = self.tokenizer.get_vocab_size()
        with open(path, encoding="utf-8") as file:
            added = json.load(file)["added_tokens"]
        self.special = {a["content"].encode(): a["id"] for a in added}
        self.plain = not any(a[k] for a in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
        longest = sorted(self.special, key=len, reverse=True)
        self.pattern = re.compile(b"|".join(map(re.escape, longest))) if longest else None
        self.newline = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.kept = _kept.Kept(KEPT, ROOM)

    def alone(self, pieces: list[str]) -> tuple[list[int], np.ndarray, np.ndarray]:
        """Each piece encoded by itself: an order of the pieces, and in it their numbers of ids and the ids.

        Only a piece of white space holds a line break; between two others a break is a
        piece and an id of its own, so that one text takes many pieces.
        """
        lone = len(self.newline) == 1
        blank = [not lone or p[-1].isspace() for p in pieces]
        many = [i for i, b in enumerate(blank) if not b]
        single = [i for i, b in enumerate(blank) if b]
        groups = [many[k : k + LINES] for k in range(0, len(many), LINES)]
        lines = ["\n".join(map(pieces.__getitem__, g)) for g in groups]
        counts, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
        for g, made in zip(groups, self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)):
            all_ids = np.array(made.ids, np.int32)
            breaks = np.flatnonzero(all_ids == self.newline[0])
            if len(breaks) != len(g) - 1:
                raise ValueError("the vocabulary joins line breaks to words")
            counts.append(np.diff(np.concatenate([[-1], breaks, [len(all_ids)]])) - 1)
            ids.append(np.delete(all_ids, breaks))
        texts = [pieces[i] for i in single]
        for made in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            ids.append(np.array(made.ids, np.int32))
            counts.append(np.array([len(ids[-1])]))
        return many + single, np.concatenate(counts), np.concatenate(ids)

    def whole(self, t: _text.Texts) -> tuple[np.ndarray, np.ndarray]:
        """As ``encoded``, with added tokens recognised in the texts."""
        if not self.plain:
            raise ValueError("an added token takes in its surroundings")
        data = t.data.tobytes()
        if self.pattern is None or not self.pattern.search(data):
            return self.encoded(t)
        # Cut at the tokens, each row by itself; between two cuts lies a token or a text of its own.
        bounds = t.at.tolist()
        found = [m for a, b in zip(bounds, bounds[1:]) for m in self.pattern.finditer(data, a, b)]
        start, end = (np.array([f(m) for m in found], np.int64) for f in (re.Match.start, re.Match.end))
        cuts = np.unique(np.concatenate([t.at, start, end]))
        ids, bound = self.encoded(_text.Texts(0, len(cuts) - 1, t.data, cuts))
        count = np.diff(bound)
        token = np.searchsorted(cuts, start)
        size = count.copy()
        size[token] = 1
        total = np.concatenate([[0], np.cumsum(size)])
        out = np.zeros(total[-1], np.int32)
        text = np.ones(len(count), bool)
        text[token] = False
        out[_text.ranges(total[:-1][text], count[text])] = ids[_text.ranges(bound[:-1][text], count[text])]
        out[total[token]] = [self.special[m[0]] for m in found]
        return out, total[np.searchsorted(cuts, t.at)]

    def encoded(self, t: _text.Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows, and each row's bound in them."""
        span = _text.pieces(t)
        if not len(span.start):
            return np.zeros(0, np.int32), np.zeros(len(t.at), np.int64)
        data = t.data.tobytes()

        def make(new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            spans = zip(span.start[new].tolist(), span.end[new].tolist())
            order, count, ids = self.alone([data[a:b].decode() for a, b in spans])
            back = np.argsort(np.array(order))
            begin = (np.cumsum(count) - count)[back]
            return ids[_text.ranges(begin, count[back])], count[back]

        ids, count = self.kept.get(t.data, span.start, span.end, make)
        total = np.concatenate([[0], np.cumsum(count)])
        return ids, total[span.row]


@lru_cache(1)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _bins(pair: np.ndarray) -> np.ndarray:
    return ((pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BINS)).astype(np.int64)


def compress(ids: np.ndarray, ends: np.ndarray, base: int, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rules (pairs), symbols, and whether a symbol is the last of its document.

    Each round replaces every pair that occurs ``least`` times or more; of overlapping
    places the left one is replaced. It ends when no pair inside a document occurs
    ``least`` times. Two symbols of earlier rounds never become neighbours, so after the
    first round only pairs with a new symbol are looked at.
    """
    symbol, last = ids.astype(np.int64), ends.copy()
    rules: list[np.ndarray] = []
    at = np.flatnonzero(~last[:-1])
    while len(at):
        pair = (symbol[at] << 32) | symbol[at + 1]
        # Counts of hashed pairs rule out most places before pairs are sorted.
        spread = _bins(pair)
        maybe = (np.bincount(spread, minlength=1 << BINS) >= least)[spread]
        at, pair = at[maybe], pair[maybe]
        ordered = np.sort(pair)
        start = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(at) else at
        chosen = ordered[start[np.diff(np.append(start, len(ordered))) >= least]]
        if not len(chosen):
            break
        # A table of hashed pairs finds nearly all; pairs that share a place are searched.
        place = np.full(1 << BINS, -1, np.int32)
        place[_bins(chosen)] = np.arange(len(chosen))
        rule = place[spread[maybe]]
        rest = np.flatnonzero((rule >= 0) & (chosen[rule] != pair))
        rule[rest] = np.minimum(np.searchsorted(chosen, pair[rest]), len(chosen) - 1)
        hit = (rule >= 0) & (chosen[rule] == pair)
        at, rule = at[hit], rule[hit]
        runs = np.concatenate([[True], np.diff(at) > 1])
        first = at[np.flatnonzero(runs)][np.cumsum(runs) - 1]
        left = (at - first) % 2 == 0
        at, rule = at[left], rule[left]
        # Rules that no place is left for are not stored.
        used = np.flatnonzero(np.bincount(rule, minlength=len(chosen)))
        number = np.zeros(len(chosen), np.int64)
        number[used] = base + np.arange(len(used))
        symbol[at] = number[rule]
        last[at] = last[at + 1]
        keep = np.ones(len(symbol), bool)
        keep[at + 1] = False
        symbol, last = symbol[keep], last[keep]
        rules.append(np.stack([chosen[used] >> 32, chosen[used] & 0xFFFFFFFF], 1))
        new = symbol >= base
        base += len(used)
        at = np.flatnonzero((new[:-1] | new[1:]) & ~last[:-1])
    return np.concatenate(rules) if rules else np.zeros((0, 2), np.int64), symbol, last


def _unfold(symbols: np.ndarray, rules: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """What each symbol stands for, one after the other, and the place of the symbol that each id comes from."""
    out, owner = symbols.astype(np.int64), np.arange(len(symbols))
    while len(out) and (large := out >= base).any():
        size = np.where(large, 2, 1)
        at = np.cumsum(size) - size
        wider = np.empty(int(size.sum()), np.int64)
        wider[at] = out
        pair = rules[out[large] - base]
        wider[at[large]] = pair[:, 0]
        wider[at[large] + 1] = pair[:, 1]
        out, owner = wider, np.repeat(owner, size)
    return out, owner


def lengths(rules: np.ndarray, base: int) -> np.ndarray:
    """Number of ids that each rule expands to."""
    _, owner = _unfold(base + np.arange(len(rules)), rules, base)
    return np.bincount(owner, minlength=len(rules))


def expand(symbols: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    """The ids that the symbols stand for: each rule is unfolded once and copied to its places."""
    symbols = symbols.astype(np.int64)
    large = np.flatnonzero(symbols >= base)
    used, rule = np.unique(symbols[large], return_inverse=True)
    ids, owner = _unfold(used, rules, base)
    many = np.bincount(owner, minlength=len(used))
    size = np.ones(len(symbols), np.int64)
    size[large] = many[rule]
    out = np.repeat(symbols, size)
    at = (np.cumsum(size) - size)[large]
    begin = (np.cumsum(many) - many)[rule]
    out[_text.ranges(at, many[rule])] = ids[_text.ranges(begin, many[rule])]
    return out


def stretch(symbols: np.ndarray, rules: np.ndarray, sizes: np.ndarray, base: int, first: int, last: int) -> np.ndarray:
    """The ids ``first`` to ``last`` of a document's symbols; only the rules they lie in are expanded."""
    length = np.where(symbols < base, 1, sizes[np.maximum(symbols - base, 0)] if len(sizes) else 1)
    end = np.cumsum(length)
    a, b = np.searchsorted(end, first, "right"), np.searchsorted(end, last, "left") + 1
    if first >= last:
        return np.zeros(0, np.int64)
    skipped = end[a] - length[a]
    return expand(symbols[a:b], rules, base)[first - skipped : last - skipped]


def write(documents: DataFrame, folder: str, path: str, end_id: int = END, least: int = LEAST) -> None:
    """Encode ``documents`` (doc_id, text) and write the blocks to ``folder``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, part, number = encoder(path), TaskContext.get().partitionId(), 0
        names: list[list] = []
        waiting: list[np.ndarray] = []
        held = done = 0

        def block() -> pa.RecordBatch:
            nonlocal number, held, done
            count = np.array([len(x) for x in waiting], np.int64)
            ids = np.concatenate(waiting)
            ends = np.zeros(len(ids), bool)
            ends[np.cumsum(count) - 1] = True
            rules, symbol, last = compress(ids, ends, make.size, least)
            per_doc = np.diff(np.concatenate([[-1], np.flatnonzero(last)]))
            binary = [x.astype("<i4").tobytes() for x in (rules, lengths(rules, make.size), symbol)]
            row = [part, number, done, list(names), count.tolist(), per_doc.tolist(), *binary, make.size, len(ids)]
            kinds = [
                pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()),
                pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.int64(),
            ]
            number += 1
            done += len(ids)
            names.clear()
            waiting.clear()
            held = 0
            titles = [f.split()[0] for f in FORMAT.split(",")]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=titles)

        for batch in batches:
            doc = batch.column(0).to_pylist()
            for t in _text.texts(batch.column(1), SLICE):
                ids, bound = make.whole(t)
                for i in range(t.first, t.last):
                    own = ids[bound[i - t.first] : bound[i - t.first + 1]]
                    if held and held + len(own) + 1 > BLOCK:
                        yield block()
                    names.append(doc[i])
                    waiting.append(np.append(own, np.int32(end_id)))
                    held += len(own) + 1
        if held:
            yield block()

    kept = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    # Equal rows may stand in any order, so a number of the row spreads even those.
    spread = kept.select(
        "*",
        F.substring("text", 1, PREFIX).alias("_prefix"),
        F.xxhash64("text").alias("_hash"),
        F.monotonically_increasing_id().alias("_row"),
    )
    by = ["doc_id", "_prefix", "_hash"]
    ordered = spread.repartitionByRange(*by, "_row").sortWithinPartitions(*by).select("doc_id", "text")
    ordered.mapInArrow(run, FORMAT).write.parquet(folder)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids before it), n_tokens and ids (little-endian unsigned 32-bit) of every document.

    A block knows its place in its part; of the parts, one number each comes to the
    driver and goes back, so the blocks themselves are not shuffled.
    """
    blocks = spark.read.parquet(folder)
    sums = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    ahead, total = [], 0
    for row in sums:
        ahead.append((row["part"], total))
        total += row["n"]
    parts = spark.createDataFrame(ahead, "part int, ahead long")  # a row for each task that wrote
    columns = ["start", "doc_id", "doc_ids", "rules", "symbols", "base"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                start, doc, count, rules, symbols, base = (batch.column(c)[row].as_py() for c in columns)
                pairs = np.frombuffer(rules, "<i4").reshape(-1, 2)
                data = expand(np.frombuffer(symbols, "<i4"), pairs, base).astype("<u4")
                bound = np.concatenate([[0], np.cumsum(count)])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc, pa.int64()),
                        pa.array(start + bound[:-1], pa.int64()),
                        pa.array(count, pa.int64()),
                        pa.BinaryArray.from_buffers(
                            pa.binary(), len(doc), [None, pa.py_buffer((bound * 4).astype(np.int32)), pa.py_buffer(data)]
                        ),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    made = blocks.join(F.broadcast(parts), "part").withColumn("start", F.col("start") + F.col("ahead")).select(*columns)
    return made.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def digests(read_back: DataFrame) -> DataFrame:
    """Of rows of ``read``: the checksum of each document's ids instead of the ids."""
    return read_back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
