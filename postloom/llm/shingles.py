"""Hashes of word shingles, for whole Arrow batches of texts at once.

Words are runs of bytes other than space and U+0009 to U+000D; A-Z are lower-cased. A shingle is a run of
words, hashed to 63 bits; hashes stand for shingles from here on, so that sets are sorted integer arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are hashed at once: temporaries take about 40 times this.
AT_ONCE = 1 << 18

_U = np.uint64


def _mixed(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every input bit over the output."""
    x = x ^ (x >> _U(31))
    x = x * _U(0x9E3779B97F4A7C15)
    x = x ^ (x >> _U(29))
    x = x * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(32))


class Shingler:
    """Sets of shingle hashes of texts; made once a task."""

    def __init__(self, words: int):
        self.words = words
        lower = np.arange(256)
        lower[65:91] += 32
        self.value = _mixed((lower + 1).astype(np.uint64) * _U(0x2545F4914F6CDD1D))
        self.gap = np.zeros(256, bool)
        self.gap[[9, 10, 11, 12, 13, 32]] = True
        self.power = self.inverse = np.ones(1, np.uint64)
        base = 0x5851F42D4C957F2D
        self.base, self.base_inverse = base, pow(base, -1, 1 << 64)
        self.factor = [_U(pow(0xD1342543DE82EF95, k + 1, 1 << 64)) for k in range(words)]

    def _powers(self, n: int) -> None:
        while len(self.power) < n:  # doubling: powers of the second half are those of the first times one more
            m = len(self.power)
            self.power = np.concatenate([self.power, self.power * _U(pow(self.base, m, 1 << 64))])
            self.inverse = np.concatenate([self.inverse, self.inverse * _U(pow(self.base_inverse, m, 1 << 64))])

    def sets(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Of each text, null counting as empty: its distinct shingle hashes in ascending order."""
        texts = texts.cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        lengths = np.diff(offsets)
        if texts.null_count:
            lengths = np.where(texts.is_valid().to_numpy(zero_copy_only=False), lengths, 0)
        i = 0
        while i < len(texts):
            j, size = i + 1, lengths[i]
            while j < len(texts) and size + lengths[j] <= AT_ONCE:
                size += lengths[j]
                j += 1
            yield from self._some(data, offsets[i:j], lengths[i:j])
            i = j

    def _some(self, data: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> Iterator[np.ndarray]:
        if (begins[1:] == begins[:-1] + lengths[:-1]).all():
            buf = data[begins[0] : begins[0] + lengths.sum()]
        else:
            buf = np.concatenate([data[b : b + n] for b, n in zip(begins, lengths)])
        edge = np.concatenate([[0], np.cumsum(lengths)])
        none = np.empty(0, np.uint64)
        if not len(buf):
            yield from (none for _ in begins)
            return
        gap = self.gap[buf]
        first = ~gap
        first[1:] &= gap[:-1]
        last = ~gap
        last[:-1] &= gap[1:]
        inner = edge[1:-1]
        inner = inner[(inner > 0) & (inner < len(buf))]
        first[inner] |= ~gap[inner]
        last[inner - 1] |= ~gap[inner - 1]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self._powers(len(buf) + 1)
        run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.value[buf] * self.power[: len(buf)], dtype=np.uint64)])
        word = _mixed((run[end] - run[start]) * self.inverse[start] + (end - start).astype(np.uint64))
        bounds = np.searchsorted(start, edge)
        k = self.words
        n = len(word) - k + 1
        total = sum((word[i : n + i] * self.factor[i] for i in range(k)), np.zeros(max(n, 0), np.uint64)) if n > 0 else none
        shingle = _mixed(total) >> _U(1)
        for a, b in zip(bounds[:-1], bounds[1:]):
            if b - a >= k:
                yield np.unique(shingle[a : b - k + 1])
            elif b > a:
                short = sum((word[a + i : a + i + 1] * self.factor[i] for i in range(b - a)), np.full(1, b - a, np.uint64))
                yield _mixed(short) >> _U(1)
            else:
                yield none
