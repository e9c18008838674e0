"""Operator 10: document quality from a conditional random field over lines.

Every line of a text has a few figures of its own (signs, capitals, bars, exclamation
marks, words repeated at once or in the line, length, digits, whether it repeats an earlier line) and those of
the lines before and after it. A linear chain of labels good and bad over the lines is
fitted to labelled documents. The forward-backward pass gives each line's probability to
be good; their mean, weighted by the lines' lengths, is the document's, and a logistic
curve fitted to the same documents turns it into the score.

Only documents are labelled, so the lines' labels are latent. At first a line is what its
own figures say, which a plain logistic curve learns from all lines with their documents'
labels; then, ``ROUNDS`` times, what the fitted chain says. Either is held to a mean of
``MOST`` good in a bad document at the most and of 1 - ``MOST`` in a good one at the least
(an offset for each document on its lines' log odds), and the chain is fitted to that. As
labelled documents are mostly of one kind throughout, up to ``MIXED`` of either kind get a
run of lines of one of the other kind, and tell the chain what a change of labels is like.

The model is fitted on at most ``SAMPLE`` labelled documents of either label, those with
the least hash of their id, of at most ``LONGEST`` lines each and ``LINES`` in all of a
label; only their figures (124 bytes a line) come to the driver, whatever repeats in the
tables. Scoring takes whole texts of all documents and shuffles nothing.

Defined cases: an empty or null text is one empty line and gets a score like any other;
labels that are null, of unknown documents, or held out are not used; a document that is
labelled twice, or whose id repeats, counts as often within the sample; with labels of one kind only (or none) every score is that
label (or one half); rows are kept one to one; all columns of the input are kept, and
``score`` and ``lines`` replace columns of those names, whatever their case.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from martweave.llm import _text

SAMPLE, LONGEST, LINES = 1500, 5000, 200_000
ROUNDS, MOST, MIXED = 2, 0.3, 400
OWN = 10  # figures of a line itself
STEPS, MORE, RATE, RIDGE = 200, 60, 0.2, 1e-4


class Lines(NamedTuple):
    """Figures of all lines (bias, own, those before, those after), their weights, and the rows' bounds."""

    figures: np.ndarray
    weight: np.ndarray
    row: np.ndarray


def _kinds() -> np.ndarray:
    """For every byte: is it a capital, a small letter, a digit, a sign, a bar, an exclamation mark."""
    out = np.zeros((6, 256), np.int32)
    out[0, 65:91] = out[1, 97:123] = out[1, 128:] = out[2, 48:58] = 1
    for low, high in ((33, 48), (58, 65), (91, 97), (123, 127)):
        out[3, low:high] = 1
    out[3, [ord(c) for c in ".,'-"]] = 0
    out[4, ord("|")] = out[5, ord("!")] = 1
    return out


def lines(t: _text.Texts) -> Lines:
    """The lines of a slice of texts; each text has one more than it has line breaks."""
    breaks = np.flatnonzero(t.data == 10)
    per_row = np.diff(np.searchsorted(breaks, t.at)) + 1
    row = np.concatenate([[0], np.cumsum(per_row)])
    start, end = np.zeros(row[-1], np.int64), np.zeros(row[-1], np.int64)
    opening, closing = np.zeros(row[-1], bool), np.zeros(row[-1], bool)
    opening[row[:-1]] = closing[row[1:] - 1] = True
    start[opening], start[~opening] = t.at[:-1], breaks + 1
    end[closing], end[~closing] = t.at[1:], breaks
    size = end - start
    sums = []
    for kind in _kinds():
        total = np.concatenate([[0], np.cumsum(kind[t.data])])
        sums.append(total[end] - total[start])
    capital, small, digit, sign, bar, mark = (x.astype(np.float64) for x in sums)

    data, span = _text.words(t)
    word = _text.hashes(data, span.start, span.end)
    line = np.searchsorted(start, span.start, "right") - 1
    order = np.lexsort((word, line))
    new = np.ones(len(order), bool)
    new[1:] = (word[order][1:] != word[order][:-1]) | (line[order][1:] != line[order][:-1])
    words = np.bincount(line, minlength=len(start))
    same = np.zeros(len(word), bool)
    same[1:] = (word[1:] == word[:-1]) & (line[1:] == line[:-1])
    twice = np.bincount(line[same], minlength=len(start))
    distinct = np.bincount(line[order][new], minlength=len(start))
    whole = np.bincount(line, weights=(word >> np.uint64(32)).astype(np.float64), minlength=len(start))
    owner = np.repeat(np.arange(len(per_row)), per_row)
    key = np.lexsort((np.arange(len(start)), whole, owner))
    again = np.zeros(len(start), bool)
    again[key[1:]] = (whole[key][1:] == whole[key][:-1]) & (owner[key][1:] == owner[key][:-1]) & (words[key][1:] > 3)

    large = np.maximum(size, 1)
    own = np.stack(
        [
            np.minimum(sign / large * 4, 2),
            capital / np.maximum(capital + small, 1),
            np.minimum(bar / large * 10, 2),
            np.minimum(mark / large * 10, 2),
            np.where(words > 0, 1 - distinct / np.maximum(words, 1), 0),
            np.log1p(words) / 4,
            size / np.maximum(words, 1) / 20,
            digit / large,
            again,
            np.minimum(twice / np.maximum(words, 1) * 4, 2),
        ],
        1,
    )
    own[:, 6] = np.minimum(own[:, 6], 2)
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[opening], after[closing] = 0, 0
    return Lines(np.concatenate([np.ones((len(own), 1)), own, before, after], 1), size + 1.0, row)


class Marginals(NamedTuple):
    good: np.ndarray
    pairs: np.ndarray


def _padded(values: np.ndarray, row: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    count = np.diff(row)[rows]
    inside = np.arange(int(count.max())) < count[:, None]
    out = np.zeros(inside.shape)
    out[inside] = values[_text.ranges(row[:-1][rows], count)]
    return out, inside


def marginals(logit: np.ndarray, row: np.ndarray, change: np.ndarray) -> Marginals:
    """Probability of each line to be good, and sums of the probabilities of neighbouring labels.

    ``logit``: log odds of good of each line alone; ``change``: 2 x 2 scores of label
    pairs. Rows of like length go through the chain together.
    """
    good, pairs = np.zeros(len(logit)), np.zeros((2, 2))
    move = np.exp(change)
    bucket = np.ceil(np.log2(np.diff(row))).astype(int)
    for size in np.unique(bucket):
        every = np.flatnonzero(bucket == size)
        step = max(1, (1 << 18) >> int(size))
        for k in range(0, len(every), step):
            rows = every[k : k + step]
            odds, inside = _padded(np.clip(logit, -30, 30), row, rows)
            n, length = odds.shape
            part = np.stack([np.exp(-np.maximum(odds, 0)), np.exp(np.minimum(odds, 0))], 2)
            forward, backward = np.empty((length, n, 2)), np.empty((length, n, 2))
            forward[0] = part[:, 0] / part[:, 0].sum(1, keepdims=True)
            for i in range(1, length):
                now = (forward[i - 1] @ move) * part[:, i]
                now /= now.sum(1, keepdims=True)
                forward[i] = np.where(inside[:, i, None], now, forward[i - 1])
            backward[-1] = 1
            for i in range(length - 2, -1, -1):
                later = (part[:, i + 1] * backward[i + 1]) @ move.T
                later /= later.sum(1, keepdims=True)
                backward[i] = np.where(inside[:, i + 1, None], later, 1.0)
                both = forward[i][:, :, None] * move * (part[:, i + 1] * backward[i + 1])[:, None, :]
                both /= both.sum((1, 2), keepdims=True)
                pairs += both[inside[:, i + 1]].sum(0)
            both = forward * backward
            probability = (both[:, :, 1] / both.sum(2)).T
            good[_text.ranges(row[:-1][rows], np.diff(row)[rows])] = probability[inside]
    return Marginals(good, pairs)


class Model(NamedTuple):
    weights: np.ndarray
    change: np.ndarray
    slope: float
    level: float
    constant: float | None = None


def _means(good: np.ndarray, x: Lines) -> np.ndarray:
    return np.add.reduceat(good * x.weight, x.row[:-1]) / np.add.reduceat(x.weight, x.row[:-1])


def _mixed(x: Lines, label: np.ndarray, most: int = MIXED) -> tuple[Lines, np.ndarray]:
    """Documents with a run of lines of one of the other kind in them, and the places of their lines in ``x``."""
    rng = np.random.default_rng(1)
    good, bad = (rng.permutation(np.flatnonzero(label == k))[:most].tolist() for k in (1, 0))
    figures, weight, places, count = [], [], [], []
    for a, b in [*zip(good, bad), *zip(bad, good)]:
        first, last = x.row[a], x.row[a + 1]
        if last - first > 24:  # some lines around the run are enough
            first = int(rng.integers(first, last - 24))
            last = first + 24
        start = int(rng.integers(x.row[b], x.row[b + 1]))
        run = np.arange(start, min(start + int(rng.integers(1, 6)), x.row[b + 1]))
        at = int(rng.integers(first, last + 1))
        order = np.concatenate([np.arange(first, at), run, np.arange(at, last)])
        own = x.figures[order, 1 : 1 + OWN]
        before, after = np.zeros_like(own), np.zeros_like(own)
        before[1:], after[:-1] = own[:-1], own[1:]
        figures.append(np.concatenate([np.ones((len(own), 1)), own, before, after], 1))
        weight.append(x.weight[order])
        places.append(order)
        count.append(len(order))
    row = np.concatenate([[0], np.cumsum(count)]).astype(np.int64)
    return Lines(np.concatenate(figures), np.concatenate(weight), row), np.concatenate(places)


def _odds(good: np.ndarray) -> np.ndarray:
    return np.log(np.clip(good, 1e-9, 1 - 1e-9) / np.clip(1 - good, 1e-9, 1))


def _chance(odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def _held(good: np.ndarray, x: Lines, label: np.ndarray) -> np.ndarray:
    """For each line the offset of its document, at which the lines' mean keeps to the document's label."""
    odds, many = _odds(good), np.diff(x.row)
    low, high = np.full(len(label), -30.0), np.full(len(label), 30.0)
    want = np.where(label == 1, 1 - MOST, MOST)
    for _ in range(40):
        middle = (low + high) / 2
        under = _means(_chance(odds + np.repeat(middle, many)), x) < want
        low, high = np.where(under, middle, low), np.where(under, high, middle)
    now = _means(good, x)
    return np.repeat(np.where((label == 1) == (now < want), (low + high) / 2, 0.0), many)


def _pairs(good: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Expected numbers of neighbouring labels, of lines whose labels do not depend on each other."""
    inner = np.ones(len(good), bool)
    inner[row[:-1]] = False
    at = np.flatnonzero(inner)
    both = np.stack([1 - good, good], 1)
    return both[at - 1].T @ both[at]


class _Ascent:
    """Steps along a gradient, each weight at a pace of its own."""

    def __init__(self, size: int):
        self.state, self.step = [np.zeros(size), np.zeros(size)], 0

    def move(self, gradient: np.ndarray) -> np.ndarray:
        self.step += 1
        self.state = [0.9 * self.state[0] + 0.1 * gradient, 0.99 * self.state[1] + 0.01 * gradient**2]
        first, second = (s / (1 - rate**self.step) for s, rate in zip(self.state, (0.9, 0.99)))
        return RATE * first / (np.sqrt(second) + 1e-9)


def _alone(x: Lines, line: np.ndarray) -> np.ndarray:
    """Probability of each line to be good by its own figures."""
    own = x.figures[:, : 1 + OWN]
    weights, ascent = np.zeros(1 + OWN), _Ascent(1 + OWN)
    for _ in range(STEPS):
        weights = weights + ascent.move(own.T @ (line - _chance(own @ weights)) / len(line) - RIDGE * weights)
    return _chance(own @ weights)


def fit(x: Lines, label: np.ndarray) -> Model:
    """Maximum likelihood of the lines' labels, as far as they are known at each turn."""
    if len(label) == 0 or label.min() == label.max():
        constant = 0.5 if len(label) == 0 else float(label[0])
        return Model(np.zeros(1 + 3 * OWN), np.zeros((2, 2)), 0.0, 0.0, constant)
    mixed, places = _mixed(x, label)
    every = Lines(
        np.concatenate([x.figures, mixed.figures]),
        np.concatenate([x.weight, mixed.weight]),
        np.concatenate([x.row, x.row[-1] + mixed.row[1:]]),
    )
    total = len(every.weight)
    weights, change = np.zeros(x.figures.shape[1]), np.zeros((2, 2))
    for turn in range(ROUNDS + 1):
        if turn == 0:
            alone = _alone(x, np.repeat(label, np.diff(x.row)).astype(float))
            good = _chance(_odds(alone) + _held(alone, x, label))
            seen = _pairs(good, x.row)
        else:
            now = marginals(x.figures @ weights, x.row, change).good
            good, seen = marginals(x.figures @ weights + _held(now, x, label), x.row, change)
        line = np.concatenate([good, good[places]])
        seen = seen + _pairs(good[places], mixed.row)
        ascent = _Ascent(len(weights) + 4)
        for _ in range(MORE if turn else STEPS):
            m = marginals(every.figures @ weights, every.row, change)
            gradient = np.concatenate([every.figures.T @ (line - m.good), (seen - m.pairs).ravel()]) / total
            move = ascent.move(gradient - RIDGE * np.concatenate([weights, change.ravel()]))
            weights, change = weights + move[:-4], change + move[-4:].reshape(2, 2)
    mean = _means(marginals(x.figures @ weights, x.row, change).good, x)
    share = np.where(label == 1, 0.5 / (label == 1).mean(), 0.5 / (label == 0).mean())
    theta = np.zeros(2)
    design = np.stack([mean - 0.5, np.ones(len(mean))], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ theta))
        slope = design.T @ (share * (label - p)) - 0.5 * theta
        curve = (design * (share * p * (1 - p))[:, None]).T @ design + 0.5 * np.eye(2)
        theta = theta + np.linalg.solve(curve, slope)
    return Model(weights, change, float(theta[0]), float(theta[1]))


def score(model: Model, t: _text.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scores of the rows; each line's probability to be good, and the rows' bounds in them."""
    x = lines(t)
    good = marginals(x.figures @ model.weights, x.row, model.change).good
    if model.constant is not None:
        return np.full(len(x.row) - 1, model.constant), np.full(len(good), model.constant), x.row
    return 1 / (1 + np.exp(-(model.slope * (_means(good, x) - 0.5) + model.level))), good, x.row


def train(documents: DataFrame, labels: DataFrame, text: str = "text", sample: int = SAMPLE, most: int = LINES) -> Model:
    """Fit to ``labels`` (doc_id, quality 0 or 1); pass only those that may be learnt from."""
    usable = labels.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("_label"))
    spread = F.xxhash64("_id")
    some = [usable.where(F.col("_label") == k).orderBy(spread, "_id").limit(sample) for k in (0, 1)]
    chosen = F.broadcast(some[0].union(some[1]))  # two times ``sample`` rows at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in _text.texts(batch.column(1)):
                x = lines(t)
                count = np.diff(x.row)
                keep = np.flatnonzero(count <= LONGEST)
                at = [slice(x.row[k], x.row[k + 1]) for k in keep]
                yield pa.RecordBatch.from_pydict(
                    {
                        "label": batch.column(0).slice(t.first, len(count)).take(pa.array(keep)),
                        "figures": pa.array([x.figures[s].astype("<f4").tobytes() for s in at], pa.binary()),
                        "weight": pa.array([x.weight[s].astype("<f8").tobytes() for s in at], pa.binary()),
                        "place": batch.column(2).slice(t.first, len(count)).take(pa.array(keep)),
                    }
                )

    found = documents.join(chosen, documents["doc_id"] == chosen["_id"]).select(
        "_label", F.col(text).cast("string"), F.col("doc_id").cast("long")
    )
    made = found.mapInArrow(run, "label int, figures binary, weight binary, place long")
    # An id may repeat in the documents: the bounds hold for what is collected.
    least = Window.partitionBy("label").orderBy(F.xxhash64("place"), "place", F.length("figures"), "figures")
    ranked = made.withColumn("n", F.row_number().over(least)).where(F.col("n") <= sample)
    lines_before = F.sum(F.length("weight") / 8).over(least.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = ranked.withColumn("lines", lines_before).where(F.col("lines") <= most).drop("n", "lines").collect()
    rows.sort(key=lambda r: (r["place"], bytes(r["figures"])))
    figures = [np.frombuffer(r["figures"], "<f4").reshape(-1, 1 + 3 * OWN) for r in rows]
    row = np.concatenate([[0], np.cumsum([len(f) for f in figures])]).astype(np.int64)
    if not rows:
        return fit(Lines(np.zeros((0, 1 + 3 * OWN)), np.zeros(0), row), np.zeros(0, np.int64))
    weight = np.concatenate([np.frombuffer(r["weight"], "<f8") for r in rows])
    return fit(Lines(np.concatenate(figures).astype(np.float64), weight, row), np.array([r["label"] for r in rows]))


def classify(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``documents`` with ``score`` and ``lines``: each line's probability to be good."""
    made = ("score", "lines")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in _text.texts(batch.column(width if place is None else place)):
                value, good, row = score(model, t)
                rest = [c.slice(t.first, t.last - t.first) for c in batch.columns[:width]]
                probability = pa.ListArray.from_arrays(pa.array(row, pa.int32()), pa.array(good))
                yield pa.RecordBatch.from_arrays(
                    [*rest, pa.array(value), probability], names=[*batch.schema.names[:width], *made]
                )

    kept = documents.select(*(f"`{c}`" for c in documents.columns if c.lower() not in made))
    width, place = len(kept.columns), _text.place(kept, text)
    fields = [*kept.schema.fields, StructField("score", DoubleType()), StructField("lines", ArrayType(DoubleType()))]
    sent = kept if place is not None else kept.withColumn("_scored", kept[text].cast("string"))
    return sent.mapInArrow(run, StructType(fields))
