"""Operator 9: numbers of unigram pieces, without the pieces.

An Aho-Corasick automaton finds every vocabulary piece in the distinct words of a slice
(those not met before; equal bytes are compared, not hashes alone); a Viterbi pass then carries, for each position of a word, only the best score and its
number of pieces. All words of a slice advance together, one character a step.

Tie rules of the unigram tokenizer: a later candidate must be better, not equal, and
candidates come in the order of their starts, so of equal scores the longest last piece
wins. A character that no one-character piece covers costs the least score less ten; it
stands for its UTF-8 bytes if the vocabulary has byte pieces, else a run of such
characters is one unknown piece. Scores add up in double precision from left to right.

Texts are taken as the vocabulary takes them: blanks become the mark U+2581 and one is
put in front (``prefix``). No piece may hold a mark after another character, so words
that start with marks are scored alone; a vocabulary with such a piece is refused.

Defined cases: a null or empty text has no pieces; rows are kept one to one; all columns
of the input are kept and ``n_pieces`` replaces a column of that name, whatever its
case. Nothing is shuffled; a task holds a slice of texts and its distinct words.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField, StructType

from martweave.llm import _kept, _text

MARK = "▁"
PENALTY = 10.0
CHUNK = 100_000


class Unigram:
    """A vocabulary with scores; ``byte_pieces`` says that it has one for every byte."""

    def __init__(self, scores: dict[str, float], byte_pieces: bool):
        if any(MARK in p.lstrip(MARK) for p in scores):
            raise ValueError("a piece holds a mark after another character")
        self.byte_pieces = byte_pieces
        self.unknown = min(scores.values()) - PENALTY
        self.opening, self.inner = _kept.Kept(300_000), _kept.Kept(600_000)
        self.automaton = ahocorasick.Automaton()
        for piece, score in scores.items():
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()

    def counts(self, words: list[str]) -> np.ndarray:
        """Number of pieces of each word."""
        out = np.zeros(len(words), np.int64)
        first = size = 0
        for i, word in enumerate([*words, None]):
            if word is None or size > CHUNK:
                if i > first:
                    out[first:i] = self._counts(words[first:i])
                first, size = i, 0
            size += len(word or "")
        return out

    def _counts(self, words: list[str]) -> np.ndarray:
        # Words one after the other with a gap; node i stands before character i.
        text = "\0".join(words) + "\0"
        found = [(end + 1, end + 1 - n, score) for end, (n, score) in self.automaton.iter(text)]
        end = np.fromiter((f[0] for f in found), np.int64, len(found))
        start = np.fromiter((f[1] for f in found), np.int64, len(found))
        gain = np.fromiter((f[2] for f in found), np.float64, len(found))
        length = np.fromiter(map(len, words), np.int64, len(words))
        begin = np.cumsum(length + 1) - length - 1
        code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        inside = np.ones(len(code), bool)
        inside[begin + length] = False
        width = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)
        # A piece with the gap's character in it may reach over a gap.
        gaps = np.concatenate([[0], np.cumsum(~inside)])
        within = gaps[end] == gaps[start]
        end, start, gain = end[within], start[within], gain[within]
        single = np.zeros(len(code), bool)
        single[start[end - start == 1]] = True
        lone = np.flatnonzero(inside & ~single)
        pieces = np.concatenate([np.ones(len(end), np.int64), width[lone] if self.byte_pieces else np.ones(len(lone), np.int64)])
        odd = np.concatenate([np.zeros(len(end), bool), np.ones(len(lone), bool)])
        end, start = np.concatenate([end, lone + 1]), np.concatenate([start, lone])
        gain = np.concatenate([gain, np.full(len(lone), self.unknown)])
        depth = np.arange(len(code) + 1) - np.append(np.repeat(begin, length + 1), len(code))
        # By step, then node, then start: the first of the best is the one to take.
        order = np.lexsort((odd, start, end, depth[end]))
        end, start, gain, pieces, odd = end[order], start[order], gain[order], pieces[order], odd[order]
        best, count = np.zeros(len(code) + 1), np.zeros(len(code) + 1, np.int64)
        unknown = np.zeros(len(code) + 1, bool)
        steps = np.searchsorted(depth[end], np.arange(1, int(length.max(initial=0)) + 2))
        for a, b in zip(steps[:-1], steps[1:]):
            e, s = end[a:b], start[a:b]
            score = best[s] + gain[a:b]
            node = np.flatnonzero(np.concatenate([[True], e[1:] != e[:-1]]))
            top = np.maximum.reduceat(score, node)
            sizes = np.diff(np.append(node, len(e)))
            hit = np.flatnonzero(score == np.repeat(top, sizes))
            taken = hit[np.searchsorted(hit, node)]
            at, from_, strange = e[taken], s[taken], odd[a:b][taken]
            fused = strange & unknown[from_] & (not self.byte_pieces)
            best[at] = top
            count[at] = count[from_] + np.where(fused, 0, pieces[a:b][taken])
            unknown[at] = strange
        return count[begin + length]


@lru_cache(2)
def vocabulary(path: str) -> Unigram:
    """The pieces of a sentencepiece model file with the scores that it gives them."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    every = range(model.get_piece_size())
    plain = [i for i in every if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i))]
    return Unigram(
        {model.id_to_piece(i): model.get_score(i) for i in plain}, sum(map(model.is_byte, every)) == 256
    )


def _words(t: _text.Texts) -> _text.Spans:
    """Spans of words with the blanks before them; a row starts a word."""
    blank = t.data == 32
    start = blank.copy()
    start[1:] &= ~blank[:-1]
    starts = t.at[:-1][np.diff(t.at) > 0]
    start[starts] = True
    first = np.flatnonzero(start)
    return _text.Spans(first, np.append(first[1:], len(t.data)), np.searchsorted(first, t.at))


def count(model: Unigram, t: _text.Texts, prefix: bool = True) -> np.ndarray:
    """Number of pieces of each row."""
    if len(t.data) == 0:
        return np.zeros(len(t.at) - 1, np.int64)
    span = _words(t)
    opening = np.zeros(len(span.start), bool)
    opening[span.row[:-1][np.diff(span.row) > 0]] = prefix
    data = t.data.tobytes()
    made = np.zeros(len(span.start), np.int64)
    for some, mark, kept in ((np.flatnonzero(opening), MARK, model.opening), (np.flatnonzero(~opening), "", model.inner)):
        start, end = span.start[some], span.end[some]

        def make(new: np.ndarray, start=start, end=end, mark=mark) -> tuple[np.ndarray, np.ndarray]:
            spans = zip(start[new].tolist(), end[new].tolist())
            words = [mark + data[a:b].decode().replace(" ", MARK) for a, b in spans]
            return model.counts(words), np.ones(len(words), np.int64)

        made[some], _ = kept.get(t.data, start, end, make)
    total = np.concatenate([[0], np.cumsum(made)])
    return np.diff(total[span.row])


def token_counts(df: DataFrame, path: str, text: str = "text", prefix: bool = True) -> DataFrame:
    """``df`` with ``n_pieces``: the number of pieces of its whole ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = vocabulary(path)
        for batch in batches:
            made = [count(model, t, prefix) for t in _text.texts(batch.column(batch.num_columns - 1))]
            number = pa.array(np.concatenate(made) if made else [], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], number], names=[*batch.schema.names[:-1], "n_pieces"]
            )

    kept = df.select(*(f"`{c}`" for c in df.columns if c.lower() != "n_pieces"))
    fields = [*kept.schema.fields, StructField("n_pieces", LongType())]
    return kept.withColumn("n_pieces", df[text].cast("string")).mapInArrow(run, StructType(fields))
