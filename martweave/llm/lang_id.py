"""Operator 11: language of a text from averaged subword embeddings.

Words are runs of letters (A-Z and the capitals from U+00C0 to U+00DE lower-cased, other
ASCII left out). Each window of two, three or four bytes of a word with a blank at either
end is hashed to one of ``BUCKETS`` rows of a table of embeddings; a text is the mean of
its windows' rows, and a linear softmax over it gives the languages. Table and softmax
are learnt together by stochastic gradient descent in numpy.

As the mean is linear, a fitted model is one table of bucket by language, and a text's
scores are the mean of its windows' rows there; whole texts are scored, nothing is
shuffled, and a task holds a slice of texts.

Fitting takes at most ``SAMPLE`` texts, shared evenly among at most ``LANGUAGES``
languages (the most frequent ones), those of least hash of their id, and of each of them
``DRAWS`` windows drawn from its whole text: a known number of bytes comes to the driver.
One of five of these texts is not learnt from: a temperature is fitted to them, so that
scores are probabilities, and the least score whose takers are right in ``SURE`` of the
cases. ``accepted`` says whether a score is that high.

Defined cases: a text that is null or has no letter is ``und`` with score 0 and not
accepted, and so is every text if nothing could be learnt; rows without id, language or
letters are not learnt from; with one language every score is 1; of equal scores the
language that sorts first wins; rows are kept one to one; all columns of the input are
kept, and made ones replace columns of their names, whatever their case.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from martweave.llm import _text

BUCKETS, SIZE = 1 << 15, 16
SAMPLE, LANGUAGES, DRAWS = 3000, 1000, 512
EPOCHS, BATCH, RATE = 8, 32, 0.5
SURE = 0.995
UNKNOWN = "und"
_BLANK = 32


def windows(t: _text.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all windows of a slice of texts, and the rows' bounds in them."""
    data, span = _text.words(t, digits=False)
    capital = np.zeros(len(data), bool)
    capital[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    data = np.where(capital, data + 0x20, data).astype(np.uint8)
    # A stream of words, each with a blank before it; a row ends with a blank.
    size = span.end - span.start
    per_row = np.diff(span.row)
    closing = np.zeros(len(size), np.int64)
    closing[span.row[1:][per_row > 0] - 1] = 1
    at = np.cumsum(size + 1 + closing) - (size + 1 + closing)
    total = int((size + 1 + closing).sum())
    stream = np.full(total + 3, _BLANK, np.uint32)
    stream[_text.ranges(at + 1, size)] = data[_text.ranges(span.start, size)]
    bound = np.append(at, total)[span.row]
    inner = stream != _BLANK
    row_end = np.zeros(total + 3, bool)
    row_end[bound[1:][per_row > 0] - 1] = True
    made, valid = [], []
    value, good = stream[:total].copy(), ~row_end[:total]
    for n in (1, 2, 3):
        if n > 1:
            good = good & inner[n - 1 : total + n - 1]
        value = (value << np.uint32(8)) | stream[n : total + n]
        spread = (value ^ np.uint32(n * 0x3C6EF372)) * np.uint32(0x9E3779B1)
        spread = (spread ^ (spread >> np.uint32(15))) * np.uint32(0x85EBCA6B)
        made.append(spread >> np.uint32(32 - (BUCKETS.bit_length() - 1)))
        valid.append(good)
    # Windows of one place lie together, so those of a row do.
    keep = np.stack(valid, 1).ravel()
    bucket = np.stack(made, 1).ravel()[keep]
    before = np.concatenate([[0], np.cumsum(np.stack(valid, 1).sum(1))])
    return bucket.astype(np.int64), before[bound]


@lru_cache(None)
def _letter():
    import regex

    return regex.compile(r"\p{L}")


def lettered(t: _text.Texts) -> np.ndarray:
    """Whether each row has a letter; only rows without an ASCII letter are read as text."""
    small = t.data | 0x20
    found = np.concatenate([[0], np.cumsum((small >= 97) & (small <= 122) & (t.data < 0x80))])
    out = found[t.at[1:]] > found[t.at[:-1]]
    wide = np.concatenate([[0], np.cumsum(t.data >= 0x80)])
    for i in np.flatnonzero(~out & (wide[t.at[1:]] > wide[t.at[:-1]])).tolist():
        out[i] = _letter().search(t.data[t.at[i] : t.at[i + 1]].tobytes().decode()) is not None
    return out


class Model(NamedTuple):
    """``table``: score of each language for a bucket; ``temperature`` and ``threshold`` are the calibration."""

    languages: tuple[str, ...]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(1, keepdims=True))
    return x / x.sum(1, keepdims=True)


def fit(drawn: np.ndarray, label: np.ndarray, languages: tuple[str, ...], seed: int = 1) -> Model:
    """Gradient descent on texts of ``DRAWS`` windows each (``drawn``) and the places of their languages."""
    n, many = len(label), len(languages)
    if not n or many < 2:
        return Model(languages if n else (), np.zeros((BUCKETS, many)), np.zeros(many), 1.0, 0.0)
    rng = np.random.default_rng(seed)
    order = rng.permutation(n)
    checked, learnt = order[: n // 5], order[n // 5 :]
    embedding = rng.uniform(-1 / SIZE, 1 / SIZE, (BUCKETS, SIZE))
    weights, bias = np.zeros((SIZE, many)), np.zeros(many)
    share = 1 / np.maximum(np.bincount(label[learnt], minlength=many), 1)
    share *= len(learnt) / max(share[label[learnt]].sum(), 1e-9)
    steps = EPOCHS * -(-len(learnt) // BATCH)
    step = 0
    column = np.arange(SIZE)
    for _ in range(EPOCHS):
        shuffled = rng.permutation(learnt)
        for first in range(0, len(shuffled), BATCH):
            some = shuffled[first : first + BATCH]
            rate = RATE * (1 - step / steps)
            step += 1
            bucket = drawn[some]
            mean = embedding[bucket].mean(1)
            slope = _softmax(mean @ weights + bias)
            slope[np.arange(len(some)), label[some]] -= 1
            slope *= share[label[some]][:, None] / len(some)
            back = slope @ weights.T
            weights -= rate * SIZE * (mean.T @ slope)
            bias -= rate * slope.sum(0)
            # A bucket takes the slope of each text once for every draw of it, not for a part of a draw.
            cell = (bucket[:, :, None] * SIZE + column).ravel()
            push = np.broadcast_to(back[:, None, :], (*bucket.shape, SIZE)).ravel()
            embedding -= rate * np.bincount(cell, push, BUCKETS * SIZE).reshape(BUCKETS, SIZE)
    table = embedding @ weights
    logit = table[drawn[checked]].mean(1) + bias
    temperature = _temperature(logit, label[checked]) if len(checked) else 1.0
    threshold = _threshold(_softmax(logit / temperature), label[checked]) if len(checked) else 0.0
    return Model(languages, table, bias, temperature, threshold)


def _temperature(logit: np.ndarray, label: np.ndarray) -> float:
    """The temperature of least log loss; one wrong and one right vote are added, so a faultless sample has one too."""
    grid = np.geomspace(0.05, 20, 60)
    row = np.arange(len(label))
    loss = []
    for t in grid:
        p = _softmax(logit / t)
        top = p.max(1).mean()
        loss.append(-np.log(np.maximum(p[row, label], 1e-12)).sum() - np.log(max(1 - top, 1e-12)))
    return float(grid[int(np.argmin(loss))])


def _threshold(p: np.ndarray, label: np.ndarray) -> float:
    """The least score from which on ``SURE`` of the texts are right."""
    score, right = p.max(1), p.argmax(1) == label
    order = np.argsort(-score)
    good = np.cumsum(right[order]) >= SURE * np.arange(1, len(order) + 1)
    last = np.flatnonzero(good)
    return float(score[order][last[-1]]) if len(last) else 1.0


def train(
    documents: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE, languages: int = LANGUAGES
) -> Model:
    """Learn from all rows of ``documents`` that have an id, a language and a letter; pass only those that may be learnt from."""
    rows = documents.select(
        F.col(id).cast("string").alias("id"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")
    ).where("id IS NOT NULL AND lang IS NOT NULL")
    found = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).collect()
    if not found:
        return fit(np.zeros((0, DRAWS), np.int64), np.zeros(0, np.int64), ())
    each = max(1, sample // len(found))
    # About twice as many rows as are wanted go on to be ranked by their hash.
    rate = documents.sparkSession.createDataFrame(
        [(r["lang"], min(1.0, (2 * each + 20) / r["count"])) for r in found], "lang string, rate double"
    )
    spread = F.xxhash64("id")
    near = rows.join(F.broadcast(rate), "lang").where(F.pmod(spread, F.lit(1 << 30)) < F.col("rate") * (1 << 30))  # at most ``languages`` rows
    drawn = near.select("lang", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1 << 62)).alias("place"), "text").mapInArrow(
        _draw, "lang string, place long, drawn binary"
    )
    first = Window.partitionBy("lang").orderBy("place", "drawn")
    chosen = drawn.withColumn("n", F.row_number().over(first)).where(F.col("n") <= each).collect()
    chosen.sort(key=lambda r: (r["lang"], r["place"], bytes(r["drawn"])))
    names = tuple(sorted({r["lang"] for r in chosen}))
    label = np.array([names.index(r["lang"]) for r in chosen], np.int64)
    buckets = [np.frombuffer(r["drawn"], "<u2") for r in chosen]
    return fit(np.array(buckets, np.int64).reshape(len(label), DRAWS), label, names)


def _draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each text with a letter ``DRAWS`` windows, drawn by its place."""
    for batch in batches:
        place = batch.column(1).to_numpy()
        for t in _text.texts(batch.column(2)):
            bucket, bound = windows(t)
            rows = np.flatnonzero(lettered(t))
            drawn = []
            for i in rows.tolist():
                pick = np.random.default_rng(int(place[t.first + i])).integers(bound[i], bound[i + 1], DRAWS)
                drawn.append(bucket[pick].astype("<u2").tobytes())
            some = pa.array(rows + t.first)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(some), batch.column(1).take(some), pa.array(drawn, pa.binary())], names=["lang", "place", "drawn"]
            )


def predict(model: Model, t: _text.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Place of each row's language (-1: unknown) and its probability."""
    n, many = len(t.at) - 1, len(model.languages)
    known = lettered(t)
    if not many or not known.any():
        return np.full(n, -1), np.zeros(n)
    bucket, bound = windows(t)
    rows = np.flatnonzero(known)
    count = np.diff(bound)[rows]
    mean = np.zeros((len(rows), many))
    # Rows without a letter may have windows of other signs; they are sums of their own that nobody reads.
    filled = np.flatnonzero(np.diff(bound) > 0)
    where = np.searchsorted(filled, rows)
    for k in range(many):
        mean[:, k] = np.add.reduceat(model.table[:, k][bucket], bound[:-1][filled])[where] / count
    p = _softmax((mean + model.bias) / model.temperature)
    place, score = np.full(n, -1), np.zeros(n)
    place[rows], score[rows] = p.argmax(1), p.max(1)
    return place, score


def classify(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``documents`` with ``lang_pred``, ``score`` and ``accepted``."""
    made = ("lang_pred", "score", "accepted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array([*model.languages, UNKNOWN], pa.string())
        for batch in batches:
            for t in _text.texts(batch.column(batch.num_columns - 1)):
                place, score = predict(model, t)
                rest = [c.slice(t.first, t.last - t.first) for c in batch.columns[:-1]]
                said = names.take(pa.array(np.where(place < 0, len(model.languages), place)))
                accepted = pa.array((place >= 0) & (score >= model.threshold))
                yield pa.RecordBatch.from_arrays([*rest, said, pa.array(score), accepted], names=[*batch.schema.names[:-1], *made])

    kept = documents.select(*(f"`{c}`" for c in documents.columns if c.lower() not in made))
    kinds = (StringType(), DoubleType(), BooleanType())
    fields = kept.schema.fields + [StructField(c, k) for c, k in zip(made, kinds)]
    return kept.withColumn("_scored", documents[text].cast("string")).mapInArrow(run, StructType(fields))


def held_out(id: Column | str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves 1 when divided by 3; null for a null id."""
    return F.crc32((F.col(id) if isinstance(id, str) else id).cast("string")) % 3 == 1
