"""Hashes of words and of runs of words, for many texts at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_U = np.uint64
# words are parted by blanks and the controls 9 to 13
_IN_WORD = np.array([not (b == 32 or 9 <= b <= 13) for b in range(256)])
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_ODD = (_U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (one to one)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    if n > 1:
        out[1:] = base
    return np.multiply.accumulate(out)


_BYTES = [mix(np.arange(1, 257, dtype=np.uint64) * odd) for odd in _ODD]


def _places(second: bool, n: int) -> np.ndarray:
    """A factor per place of a word. They follow no power of a base, whose sums modulo 2^64 some texts defeat."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _ODD[not second] + _U(0x5851F42D4C957F2D)) | _U(1)


_PLACES = [_places(second, 1 << 10) for second in (False, True)]


@dataclass
class Words:
    """Words of neighbouring texts. ``bounds[i]:bounds[i + 1]`` are those of text ``i``; places are in bytes."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))

    def hashes(self, lower: bool = False, second: bool = False) -> np.ndarray:
        """64-bit hash of every word; ``second`` is a hash independent of the first."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        lengths = self.ends - self.starts
        first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        at = np.arange(int(lengths.sum())) - np.repeat(first - self.starts, lengths)
        letters = self.data[at]
        if lower:
            letters = _LOWER[letters]
        longest = int(lengths.max())
        places = _PLACES[second]
        if longest > len(places):
            places = _places(second, longest)
        values = _BYTES[second][letters] * places[at - np.repeat(self.starts, lengths)]
        return mix(np.add.reduceat(values, first) + lengths.astype(np.uint64) * _U(0xD6E8FEB86659FD93))


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    inside = _IN_WORD[data]
    before = np.empty_like(inside)
    before[1:] = inside[:-1]
    begins = offsets[:-1][offsets[:-1] < len(data)]
    before[begins] = False
    if len(before):
        before[0] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[:-1] = inside[1:]
    after[begins[begins > 0] - 1] = False
    if len(after):
        after[-1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def run_hashes(words: np.ndarray, size: int, second: bool = False) -> np.ndarray:
    """Hash of every run of ``size`` neighbours, by where it starts; runs across texts included."""
    if len(words) < size:
        return np.zeros(0, np.uint64)
    base, total, done, part, covers = _ODD[not second], None, 0, words, 1
    while True:
        if size & covers:
            if total is None:
                total = part
            else:
                n = min(len(total), len(part) - done)
                total = total[:n] * _powers(base, covers + 1)[-1] + part[done : done + n]
            done += covers
        if covers * 2 > size:
            return mix(total[: len(words) - size + 1])
        n = len(part) - covers
        part = part[:n] * _powers(base, covers + 1)[-1] + part[covers:]
        covers *= 2
