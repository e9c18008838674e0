"""Equal byte spans found once, and what was made of them kept for the next slice.

A span of up to seven bytes is its own key (its bytes and its length), so that such keys
are equal only for equal bytes. A longer span has a hash for a key, and its bytes are
compared before it is taken for another one: texts are not trusted not to collide.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from martweave.llm import _text

SHORT = 7
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_LONG = np.uint64(0xFF) << np.uint64(56)
_MASK = np.array([(1 << 8 * n) - 1 for n in range(SHORT + 1)], np.uint64)


def keys(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A key of each span (none is empty); never 0. The spans are in order and do not overlap."""
    length = end - start
    short = np.minimum(length, SHORT)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    at = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    key = (at[start] & _MASK[short]) | (short.astype(np.uint64) << np.uint64(56))
    far = np.flatnonzero(length > SHORT)
    key[far] = _text.hashes(data, start[far], end[far]) | _LONG
    return key


def _unlike(a: np.ndarray, a_start: np.ndarray, b: np.ndarray, b_start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether spans of the same lengths hold other bytes."""
    out = np.zeros(len(length), bool)
    other = a[_text.ranges(a_start, length)] != b[_text.ranges(b_start, length)]
    bound = np.concatenate([[0], np.cumsum(length)])
    out[np.searchsorted(bound, np.flatnonzero(other), "right") - 1] = True
    return out


def distinct(data: np.ndarray, start: np.ndarray, end: np.ndarray, key: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """One span of each class of spans of equal bytes, and the class of every span."""
    key = keys(data, start, end) if key is None else key
    _, first, which = np.unique(key, return_index=True, return_inverse=True)
    length = end - start
    far = np.flatnonzero((length > SHORT) & (first[which] != np.arange(len(key))))
    like = first[which[far]]
    odd = length[far] != length[like]
    same = np.flatnonzero(~odd)
    odd[same] = _unlike(data, start[far[same]], data, start[like[same]], length[far[same]])
    more: dict[bytes, int] = {}
    extra = []
    for i in far[odd].tolist():
        text = data[start[i] : end[i]].tobytes()
        if text not in more:
            more[text] = len(first) + len(more)
            extra.append(i)
        which[i] = more[text]
    return np.concatenate([first, np.array(extra, first.dtype)]), which


class _Grown:
    """An array that is added to at its end."""

    def __init__(self, kind: str):
        self.size, self.held = 0, np.zeros(1024, kind)

    def add(self, values: np.ndarray) -> None:
        if self.size + len(values) > len(self.held):
            wider = np.zeros(max(2 * len(self.held), self.size + len(values)), self.held.dtype)
            wider[: self.size] = self.held[: self.size]
            self.held = wider
        self.held[self.size : self.size + len(values)] = values
        self.size += len(values)


class Kept:
    """Numbers made of spans, kept for at most ``most`` distinct ones and ``room`` of their bytes and numbers.

    What is new once the room is full is made again for each slice that holds it.
    """

    def __init__(self, most: int = 800_000, room: int = 64 << 20):
        self.most, self.room = most, room
        self.bits = int(2 * most).bit_length()
        self.key, self.number = np.zeros(1 << self.bits, np.uint64), np.zeros(1 << self.bits, np.int32)
        self.count = 0
        self.text, self.text_at = _Grown("u1"), _Grown("i8")
        self.values, self.at = _Grown("i4"), _Grown("i8")
        self.at.add(np.zeros(1, np.int64))

    def _slots(self, key: np.ndarray) -> np.ndarray:
        return ((_text.mix(key) * _GOLDEN) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _find(self, key: np.ndarray) -> np.ndarray:
        out = np.full(len(key), -1, np.int64)
        left, slot = np.arange(len(key)), self._slots(key)
        while len(left):
            found = self.key[slot]
            hit = found == key[left]
            out[left[hit]] = self.number[slot[hit]]
            on = ~hit & (found != 0)
            left, slot = left[on], (slot[on] + 1) & ((1 << self.bits) - 1)
        return out

    def _insert(self, key: np.ndarray, number: np.ndarray) -> None:
        left, slot = np.arange(len(key)), self._slots(key)
        while len(left):
            free = self.key[slot] == 0
            self.key[slot[free]] = key[left[free]]
            placed = self.key[slot] == key[left]
            self.number[slot[placed]] = number[left[placed]]
            left, slot = left[~placed], (slot[~placed] + 1) & ((1 << self.bits) - 1)

    def get(
        self,
        data: np.ndarray,
        start: np.ndarray,
        end: np.ndarray,
        make: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]],
    ) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of every span, one after the other, and how many each has.

        ``make`` gets the places of spans not known yet, one of each, and returns their
        numbers and how many each has.
        """
        key = keys(data, start, end)
        length = end - start
        place = self._find(key)
        far = np.flatnonzero((place >= 0) & (length > SHORT))
        at = self.text_at.held[place[far]]
        odd = length[far] != self.text_at.held[place[far] + 1] - at
        same = np.flatnonzero(~odd)
        odd[same] = _unlike(data, start[far[same]], self.text.held, at[same], length[far[same]])
        strange = far[odd]
        place[strange] = -1
        new = np.flatnonzero(place < 0)
        known = self.count
        if len(new):
            first, which = distinct(data, start[new], end[new], key[new])
            place[new] = known + which
            one = new[first]
            values, count = make(one)
            before = self.values.size
            self.at.size = known + 1
            self.at.add(before + np.cumsum(count))
            self.values.add(values)
            # A key that stands for other bytes already is not kept twice.
            _, lone = np.unique(key[one], return_index=True)
            fresh = np.zeros(len(one), bool)
            fresh[lone] = True
            fresh &= ~np.isin(key[one], key[strange])
            size = np.where(length[one] > SHORT, length[one], 0)
            total = known + len(one)
            if total < self.most and 4 * self.values.size + self.text.size + int(size.sum()) < self.room:
                if not self.text_at.size:
                    self.text_at.add(np.zeros(1, np.int64))
                self.text_at.add(self.text.size + np.cumsum(size))
                self.text.add(data[_text.ranges(start[one], size)])
                self._insert(key[one][fresh], (known + np.arange(len(one)))[fresh])
                self.count = total
            else:
                # Read below before the next slice writes over them.
                self.values.size = before
        begin = self.at.held[place]
        many = self.at.held[place + 1] - begin
        return self.values.held[_text.ranges(begin, many)], many
