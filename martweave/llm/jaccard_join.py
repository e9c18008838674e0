"""Operator 6: similarity join on word shingles with a MinHash LSH forest.

Words are runs of letters and digits, A-Z lower-cased; a text's shingles are its runs of
``words`` words (a shorter text has one). Two texts are linked if the Jaccard similarity
of their sets of shingles is ``threshold`` or more.

1. One pass over the texts makes a digest of each set of shingles and ``trees``
   signatures of ``depth`` minima. Texts with equal digests are copies; each group of
   copies goes on as one text, whatever its doc_ids are.
2. Each tree is a trie of the signatures: they are sorted over the cluster, by tree and
   signature, and each is compared with its neighbours. A signature that shares no
   prefix of the shortest useful length with a neighbour shares it with none and goes.
3. The forest is searched from the full depth up. At a depth, texts with a common prefix
   in a tree share a node; a node all of whose texts share the next longer prefix, or
   whose texts are those of another node, brings no new pair. Pairs of the others are
   verified if they did not meet at a longer prefix, or at this one in an earlier tree.
   Then the prefix is shortened, until a pair as weak as the weakest link found so far
   meets with probability ``recall`` or more; at the latest, where a pair at the threshold
   does. So a table whose links are all strong is done at long prefixes, and a weak
   link anywhere makes the search go on.
4. A node's texts are dealt into blocks of ``BLOCK`` texts or ``HEAVY`` shingles at most and
   pairs of blocks are compared each by itself, so one huge node is many small tasks.
   New pairs are found from the signatures; only the shingles of texts that have one move.
   Similarities are exact, from the shingles of the whole texts, counted for all pairs
   of a block pair at once by products of 0/1 matrices. What leaves is one row for each
   text: its number of links and its least linked partners as a forest, never the pairs.
5. Links add up for each text; the forests' connected components are the classes.

Nothing is sampled or capped: every node is compared in full. The work on a group of m
near copies grows as m * m comparisons in matrix products, which is what counting
links asks for; its rows grow as m * m / ``BLOCK``.

Result: doc_id, class_id (least doc_id of its component), copy_id (least doc_id with the
same shingles), n_links (linked texts that differ from it; copies of one text count
once), and n_shingles. Defined cases: a null text is empty; a text without words has no
shingles, is nobody's copy and is its own class; a null doc_id gives a row with null ids
and no links; rows are kept one to one, and each has the links of its own text, also
where rows of one doc_id differ; further columns are left out; no documents give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martweave.llm import _text
from martweave.llm._graph import components
from martweave.session import remove, work_folder

WORDS, THRESHOLD = 5, 0.8
TREES, DEPTH, RECALL = 16, 8, 0.9995
BLOCK = 1024
HEAVY = 2_000_000  # shingles in a block, sixteen megabytes
BIN, SIGNED = 2000, 10_000  # rows with shingles, and with signatures, in a task's group
MARKS = 26
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def meeting(similarity: float, trees: int, depth: int) -> float:
    """The probability that a pair of texts shares a prefix of ``depth`` in some tree."""
    return 1 - (1 - similarity**depth) ** trees


def prefix_length(similarity: float, trees: int, depth: int, recall: float) -> int:
    """The longest prefix at which pairs of a similarity meet often enough."""
    for length in range(depth, 0, -1):
        if meeting(similarity, trees, length) >= recall:
            return length
    raise ValueError("too few trees for this recall")


def _shingles(t: _text.Texts, words: int) -> tuple[np.ndarray, np.ndarray]:
    data, span = _text.words(t)
    return _text.grams(_text.hashes(data, span.start, span.end), span.row, words)


def _distinct(gram: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's grams sorted and once each, and the rows' bounds."""
    row = np.repeat(np.arange(len(bound) - 1), np.diff(bound))
    order = np.lexsort((gram, row))
    gram, row = gram[order], row[order]
    keep = np.ones(len(gram), bool)
    keep[1:] = (gram[1:] != gram[:-1]) | (row[1:] != row[:-1])
    gram, row = gram[keep], row[keep]
    return gram, np.searchsorted(row, np.arange(len(bound)))


def signatures(documents: DataFrame, words: int, trees: int, depth: int, text: str) -> DataFrame:
    """doc_id, n_shingles, digest (of the set) and signature (``depth`` minima of four bytes for each tree)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = _text.mix(np.arange(1, 2 * trees * depth + 1, dtype=np.uint64) * _GOLDEN)
        factor, shift = seeds[::2] | np.uint64(1), seeds[1::2]
        for batch in batches:
            for t in _text.texts(batch.column(1)):
                gram, bound = _distinct(*_shingles(t, words))
                count = np.diff(bound)
                some = np.flatnonzero(count)
                first = bound[some]
                minima = np.zeros((len(count), trees * depth), ">u4")
                digest = np.zeros((len(count), 2), np.uint64)
                if len(some):
                    for k in range(trees * depth):
                        least = np.minimum.reduceat(gram * factor[k] + shift[k], first)
                        minima[some, k] = _text.mix(least) >> np.uint64(32)
                    for k in range(2):
                        digest[some, k] = np.add.reduceat(_text.mix(gram ^ seeds[k]), first)
                fixed = [(digest, 16), (minima, 4 * trees * depth)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(t.first, len(count)),
                        pa.array(count, pa.int64()),
                        *(
                            pa.FixedSizeBinaryArray.from_buffers(pa.binary(n), len(count), [None, pa.py_buffer(np.ascontiguousarray(x))]).cast(pa.binary())
                            for x, n in fixed
                        ),
                    ],
                    names=["doc_id", "n_shingles", "digest", "signature"],
                )

    kept = documents.select(F.col("doc_id").cast("long"), F.col(text).cast("string"))
    return kept.mapInArrow(run, "doc_id long, n_shingles long, digest binary, signature binary")


def _fixed(column: pa.Array, width: int) -> np.ndarray:
    """Big-endian integers of binary values of one width."""
    _, offsets, data = column.buffers()
    first = np.frombuffer(offsets, np.int32)[column.offset] if len(column) else 0
    return np.frombuffer(data, ">u4", len(column) * width // 4, int(first))


def tries(texts: DataFrame, trees: int, depth: int, least: int) -> DataFrame:
    """tree, path (a signature), member, n_shingles and reach of each signature in a node of ``least`` or more.

    ``reach`` is the length of the prefix it shares with a neighbour in the order of its
    tree, which is the longest it shares with any. Neighbours of a task's first and last
    row lie elsewhere, so those two are taken to share all. Members break ties, so a
    signature that very many texts have is spread over tasks.
    """
    tree = F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")
    every = texts.select(tree, "member", "n_shingles", "signature")
    path = F.substring("signature", F.col("tree") * (4 * depth) + 1, F.lit(4 * depth)).alias("path")
    rows = every.select("tree", path, "member", "n_shingles")
    ordered = rows.repartitionByRange("tree", "path", "member").sortWithinPartitions("tree", "path", "member")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None
        reached = depth  # of the held row, with the one before it
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                batch = pa.concat_batches([held, batch])
            of = batch.column(0).to_numpy()
            paths = _fixed(batch.column(1), 4 * depth).reshape(-1, depth)
            same = (paths[1:] == paths[:-1]) & (of[1:] == of[:-1])[:, None]
            common = np.concatenate([[reached], np.cumprod(same, 1).sum(1)])
            reach = np.maximum(common[:-1], common[1:])
            keep = np.flatnonzero(reach >= least)
            held, reached = batch.slice(batch.num_rows - 1), int(common[-1])
            yield pa.RecordBatch.from_arrays(
                [*(c.take(pa.array(keep)) for c in batch.columns), pa.array(reach[keep], pa.int32())], names=[*batch.schema.names, "reach"]
            )
        if held is not None:
            yield pa.RecordBatch.from_arrays([*held.columns, pa.array([depth], pa.int32())], names=[*held.schema.names, "reach"])

    return ordered.mapInArrow(run, "tree int, path binary, member long, n_shingles long, reach int")


def _with_grams(documents: DataFrame, words: int, text: str) -> DataFrame:
    """digest and grams (sorted distinct hashes, eight bytes each) of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = _text.mix(np.arange(1, 3, dtype=np.uint64) * _GOLDEN)
        for batch in batches:
            for t in _text.texts(batch.column(0)):
                gram, bound = _distinct(*_shingles(t, words))
                n = len(bound) - 1
                some = np.flatnonzero(np.diff(bound))
                digest = np.zeros((n, 2), np.uint64)
                if len(some):
                    for k in range(2):
                        digest[some, k] = np.add.reduceat(_text.mix(gram ^ seeds[k]), bound[some])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), n, [None, pa.py_buffer(digest)]).cast(pa.binary()),
                        pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer((bound * 8).astype(np.int32)), pa.py_buffer(gram)]),
                    ],
                    names=["digest", "grams"],
                )

    return documents.select(F.col(text).cast("string")).mapInArrow(run, "digest binary, grams binary")


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each set on the left with each on the right."""
    out = np.zeros((len(left), len(right)), np.float32)
    a, b = np.concatenate(left), np.concatenate(right)
    common = np.intersect1d(a, b)
    if not len(common):
        return out
    rows = [np.repeat(np.arange(len(s)), [len(x) for x in s]) for s in (left, right)]
    place = [np.minimum(np.searchsorted(common, x), len(common) - 1) for x in (a, b)]
    hit = [common[p] == x for p, x in zip(place, (a, b))]
    rows, place = [r[h] for r, h in zip(rows, hit)], [p[h] for p, h in zip(place, hit)]
    order = [np.argsort(p, kind="stable") for p in place]
    rows, place = [r[o] for r, o in zip(rows, order)], [p[o] for p, o in zip(place, order)]
    step = 2048
    for k in range(0, len(common), step):
        part = []
        for r, p, n in zip(rows, place, out.shape):
            i, j = np.searchsorted(p, [k, k + step])
            matrix = np.zeros((n, min(step, len(common) - k)), np.float32)
            matrix[r[i:j], p[i:j] - k] = 1
            part.append(matrix)
        out += part[0] @ part[1].T
    return out


def _forest(member: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least member that each member is connected to by the links (i, j)."""
    root = member.copy()
    while True:
        before = root.copy()
        np.minimum.at(root, i, root[j])
        np.minimum.at(root, j, root[i])
        if (before == root).all():
            return root


def _forest(member: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least member that each member is connected to by the links (i, j)."""
    root = member.copy()
    while True:
        before = root.copy()
        np.minimum.at(root, i, root[j])
        np.minimum.at(root, j, root[i])
        if (before == root).all():
            return root


def _prefixes(signatures: pd.Series, trees: int, depth: int, length: int) -> np.ndarray:
    """A hash of the prefix of ``length`` in each tree, for every text."""
    minima = np.frombuffer(b"".join(signatures), ">u4").reshape(-1, trees, depth)
    out = np.zeros(minima.shape[:2], np.uint64)
    for k in range(length):
        out = _text.mix(out * _GOLDEN + minima[:, :, k] + np.uint64(1))
    return out


def _new_pairs(left: pd.DataFrame, right: pd.DataFrame | None, tree: int, length: int, trees: int, depth: int, threshold: float) -> np.ndarray:
    """Which pairs of one block (``right`` none) or two meet here first and are not too different in size."""
    other = left if right is None else right
    sizes = [s["n_shingles"].to_numpy().astype(np.float32) for s in (left, other)]
    fresh = np.minimum.outer(*sizes) >= np.float32(threshold - 1e-6) * np.maximum.outer(*sizes)
    if right is None:
        fresh = np.triu(fresh, 1)
    made: dict[int, list[np.ndarray]] = {}
    for k, size in ([(k, length + 1) for k in range(trees)] if length < depth else []) + [(k, length) for k in range(tree)]:
        if not fresh.any():
            break
        if size not in made:
            made[size] = [_prefixes(s["signature"], trees, depth, size) for s in (left, other)]
        a, b = made[size]
        fresh &= a[:, k][:, None] != b[:, k][None, :]
    return fresh


def _sides(rows: pd.DataFrame, low: int, high: int) -> tuple[pd.DataFrame, pd.DataFrame | None] | None:
    """A pair of blocks, or one block; none where one of two is empty."""
    if low == high:
        return rows, None
    own = (rows["own"] == low).to_numpy()
    return (rows[own], rows[~own]) if own.any() and not own.all() else None


def _compared(left: pd.DataFrame, right: pd.DataFrame | None, fresh: np.ndarray, threshold: float) -> tuple:
    """Members, numbers of links, roots and least similarities of the links among some pairs."""
    other = left if right is None else right
    sets = [[np.frombuffer(g, np.uint64) for g in s] for s in (left["grams"], other["grams"])]
    sizes = [np.array([len(x) for x in s], np.float64) for s in sets]
    ids = [s["member"].to_numpy() for s in (left, other)]
    rows, columns = np.flatnonzero(fresh.any(1)), np.flatnonzero(fresh.any(0))
    i = j = np.zeros(0, np.int64)
    similar = np.zeros(0)
    if len(rows):
        common = _overlaps([sets[0][k] for k in rows], [sets[1][k] for k in columns]).astype(np.float64)
        union = sizes[0][rows][:, None] + sizes[1][columns][None, :] - common
        i, j = np.nonzero((common >= threshold * union - 1e-9) & fresh[np.ix_(rows, columns)])
        similar = common[i, j] / union[i, j]
        i, j = rows[i], columns[j]
    member = ids[0] if right is None else np.concatenate(ids)
    j = j if right is None else j + len(left)
    links = np.bincount(i, minlength=len(member)) + np.bincount(j, minlength=len(member))
    least = np.ones(len(member))
    np.minimum.at(least, i, similar)
    np.minimum.at(least, j, similar)
    some = links > 0
    return member[some], links[some], _forest(member, i, j)[some], least[some]


def _among(df: DataFrame, column: str, ids: DataFrame, id: str) -> DataFrame:
    """The rows of ``df`` whose ``column`` is among the ids, and a few more; whoever calls joins the ids exactly.

    A bitmap of hashed ids is sent to the tasks, sixteen bits for each id and at most
    2^``MARKS`` (eight megabytes), so rows nobody asks for are not shuffled. With very many
    ids it lets more through, and the join does more.
    """
    bits = min(MARKS, max(18, (16 * ids.count()).bit_length()))
    place = F.pmod(F.xxhash64(F.col(id).cast("long")), F.lit(1 << bits))
    marks = ids.select(place.alias("place")).groupBy(F.shiftright("place", 15).alias("_bucket"))
    marks = marks.agg(F.bitmap_construct_agg(F.col("place") % 32768).alias("_marks"))
    probed = df.withColumn("_place", F.pmod(F.xxhash64(F.col(column).cast("long")), F.lit(1 << bits)))
    probed = probed.withColumn("_bit", F.col("_place") % 32768).withColumn("_bucket", F.shiftright("_place", 15))
    byte = F.conv(F.hex(F.substring("_marks", F.shiftright("_bit", 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = F.call_function("shiftright", byte, (F.col("_bit") % 8).cast("int")).bitwiseAND(F.lit(1)) == 1
    return probed.join(F.broadcast(marks), "_bucket").where(marked).select(*(df[c] for c in df.columns))


class _Forest:
    """The search of one forest, prefix by prefix; every step is a written table."""

    def __init__(self, documents: DataFrame, texts: DataFrame, trees: int, depth: int, threshold: float, words: int, text: str):
        self.spark = documents.sparkSession
        self.documents, self.texts = documents, texts
        self.trees, self.depth, self.threshold, self.words, self.text = trees, depth, threshold, words, text
        self.folders: list[str] = []

    def kept(self, df: DataFrame, purpose: str) -> DataFrame:
        folder = work_folder(self.spark, purpose)
        df.write.parquet(folder)
        self.folders.append(folder)
        return self.spark.read.parquet(folder)

    def drop(self, keep: int) -> None:
        """Delete the tables written since there were ``keep`` of them."""
        for folder in self.folders[keep:]:
            remove(self.spark, folder)
        del self.folders[keep:]

    def _nodes(self, shared: DataFrame, length: int, known: DataFrame | None) -> DataFrame:
        """tree, prefix, node, blocks and the members' hashes of nodes that may bring new pairs."""
        longer = F.xxhash64(F.substring("path", 1, 4 * (length + 1)))
        size = F.count("*")
        nodes = shared.groupBy("tree", "prefix").agg(
            size.alias("size"),
            F.sum("n_shingles").alias("weight"),
            F.bit_xor(F.xxhash64("member")).alias("one"),
            F.bit_xor(F.xxhash64("member", F.lit(1))).alias("two"),
            F.min(longer).alias("low"),
            F.max(longer).alias("high"),
        )
        nodes = nodes.where("size > 1 AND low != high" if length < self.depth else "size > 1")
        same = ["size", "one", "two"]
        if known is not None:
            nodes = nodes.join(known, same, "left_anti")
        first = nodes.groupBy(*same).agg(F.min(F.struct("tree", "prefix")).alias("first"), F.max("weight").alias("weight"))
        blocks = F.ceil(F.greatest(F.col("size") / BLOCK, F.col("weight") / HEAVY))
        return first.select("first.*", *same, blocks.alias("blocks")).withColumn("node", F.monotonically_increasing_id())

    def _dealt(self, shared: DataFrame, nodes: DataFrame) -> DataFrame:
        """node, tree, low, high (a pair of blocks), member, own (its block)."""
        rows = shared.join(nodes.select("tree", "prefix", "node", "blocks"), ["tree", "prefix"])
        rows = rows.withColumn("own", F.pmod(F.xxhash64("member", "tree"), "blocks"))
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        return rows.select(
            "node", "tree", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "member", "own", "n_shingles"
        )

    def _bins(self, dealt: DataFrame, rows: int, heavy: int) -> Column:
        """Groups put together up to so many rows or shingles."""
        load = dealt.agg(F.count("*").alias("rows"), F.coalesce(F.sum("n_shingles"), F.lit(0)).alias("weight")).first()
        bins = max(1, -(-load["rows"] // rows), -(-load["weight"] // heavy))
        return F.pmod(F.xxhash64("node", "low", "high"), F.lit(bins)).alias("bin")

    def content(self, tries: DataFrame) -> DataFrame:
        """member, signature and grams of every text that shares a node; the texts are read again for them, once."""
        members = tries.select("member").distinct()
        own = _among(self.texts.select("member", "copy_id", "digest", "signature"), "member", members, "member")
        own = self.kept(own, "own")
        wanted = _among(self.documents.select("doc_id", self.text), "doc_id", own, "copy_id")
        # Rows that repeat are one text, put together in each task before they are sent on.
        grams = _with_grams(wanted, self.words, self.text).groupBy("digest").agg(F.first("grams").alias("grams"))
        return self.kept(own.join(grams, "digest").select("member", "signature", "grams"), "content")

    def level(self, tries: DataFrame, content: DataFrame, length: int, known: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        """Links of pairs that share a prefix of ``length`` and met at no longer one; the nodes' members' hashes."""
        trees, depth, threshold = self.trees, self.depth, self.threshold
        shared = tries.where(F.col("reach") >= length).withColumn("prefix", F.substring("path", 1, 4 * length))
        nodes = self.kept(self._nodes(shared, length, known), "nodes")
        dealt = self.kept(self._dealt(shared, nodes), "blocks")
        signed = dealt.join(content.select("member", "signature"), "member")

        def groups(frame: pd.DataFrame) -> Iterator[tuple]:
            for (node, tree, low, high), rows in frame.groupby(["node", "tree", "low", "high"], sort=False):
                # A task that is run twice may bring a row twice.
                found = _sides(rows.drop_duplicates("member"), low, high)
                if found:
                    yield node, tree, low, high, *found, _new_pairs(*found, tree, length, trees, depth, threshold)

        def news(frame: pd.DataFrame) -> pd.DataFrame:
            out = []
            for node, tree, low, high, left, right, fresh in groups(frame):
                sides = ((left, fresh.any(1) if right is not None else fresh.any(1) | fresh.any(0)), (right, fresh.any(0)))
                out += [s[hit].assign(node=node, tree=tree, low=low, high=high) for s, hit in sides if s is not None]
            columns = ["node", "tree", "low", "high", "member", "own", "n_shingles"]
            return pd.concat([o[columns] for o in out]) if out else frame[columns][:0]

        kind = "node long, tree int, low long, high long, member long, own long, n_shingles long"
        fresh = self.kept(signed.groupBy(self._bins(dealt, SIGNED, 1 << 62)).applyInPandas(news, kind), "fresh")

        read = _among(content, "member", fresh.select("member").distinct(), "member")

        def verified(frame: pd.DataFrame) -> pd.DataFrame:
            out = [_compared(left, right, new, threshold) for *_, left, right, new in groups(frame)]
            made = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 4
            return pd.DataFrame(dict(zip(("member", "n_links", "root", "least"), made)))

        found = fresh.join(read, "member").groupBy(self._bins(fresh, BIN, HEAVY))
        return found.applyInPandas(verified, "member long, n_links long, root long, least double"), nodes.select("size", "one", "two")

    def links(self, recall: float) -> DataFrame:
        """member, n_links, root (a linked member or itself) of each member and place with links."""
        least = prefix_length(self.threshold, self.trees, self.depth, recall)
        tries_ = self.kept(tries(self.texts, self.trees, self.depth, least), "tries")
        content = self.content(tries_)
        lasting = len(self.folders)
        found: list[DataFrame] = []
        known: DataFrame | None = None
        weakest = 1.0
        for length in range(self.depth, least - 1, -1):
            links, nodes = self.level(tries_, content, length, known)
            folder, seen = work_folder(self.spark, "links"), work_folder(self.spark, "seen")
            links.write.parquet(folder)
            nodes.write.parquet(seen)
            self.drop(lasting)
            found.append(self.spark.read.parquet(folder))
            more = self.spark.read.parquet(seen)
            known = more if known is None else known.union(more)
            lowest = found[-1].agg(F.min("least")).first()[0]
            weakest = weakest if lowest is None else min(weakest, lowest)
            met = any(not f.isEmpty() for f in found)
            if met and meeting(weakest, self.trees, length) >= recall:
                break
        out = found[0]
        for more in found[1:]:
            out = out.union(more)
        self.drop(0)
        return out


def jaccard_join(
    documents: DataFrame,
    threshold: float = THRESHOLD,
    words: int = WORDS,
    trees: int = TREES,
    depth: int = DEPTH,
    recall: float = RECALL,
    text: str = "text",
) -> DataFrame:
    """doc_id, class_id, copy_id, n_links, n_shingles of every row of ``documents``."""
    spark = documents.sparkSession
    folder = work_folder(spark, "signatures")
    signatures(documents, words, trees, depth, text).write.parquet(folder)
    signed = spark.read.parquet(folder)

    usable = signed.where("doc_id IS NOT NULL AND n_shingles > 0")
    # Copies have the same signature, so any of theirs will do, and no join is needed.
    grouped = usable.groupBy("digest").agg(
        F.min("doc_id").alias("copy_id"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature")
    )
    folder = work_folder(spark, "texts")
    grouped.withColumn("member", F.monotonically_increasing_id()).write.parquet(folder)
    texts = spark.read.parquet(folder)
    found = _Forest(documents, texts, trees, depth, threshold, words, text).links(recall)

    sums = found.groupBy("member").agg(F.sum("n_links").alias("n_links"))
    linked = components(found.where("member != root").select(F.col("member").alias("a"), F.col("root").alias("b")))
    own = texts.select("member", "copy_id", "digest")
    known = linked.join(own, linked["node"] == own["member"]).join(sums, "member").select("digest", "copy_id", "component", "n_links")
    folder = work_folder(spark, "classes")
    known.write.parquet(folder)
    known = spark.read.parquet(folder)
    least = known.groupBy("component").agg(F.min("copy_id").alias("class_id"))
    linked = known.join(least, "component").select("digest", "class_id", "n_links")
    copies = usable.select("doc_id", "digest", "n_shingles").join(texts.select("digest", "copy_id"), "digest")
    placed = copies.join(linked, "digest", "left").select(
        "doc_id",
        F.coalesce("class_id", "copy_id").alias("class_id"),
        "copy_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        "n_shingles",
    )
    alone = signed.where("doc_id IS NULL OR n_shingles = 0").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("copy_id"), F.lit(0).cast("long").alias("n_links"), "n_shingles"
    )
    return placed.union(alone)
