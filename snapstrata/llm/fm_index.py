"""FM-index over word sequences: Burrows-Wheeler transform, wavelet matrix of packed bits, backward search.

Searches run for many patterns in step, as array operations.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


class Bits:
    """Packed bits with counts per 64 of them; `ones(i)` is how many lie before i."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[: len(packed)] = packed
        self.before = np.zeros(len(self.words), np.int32)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])
        self.zeros = len(bits) - int(bits.sum())

    def ones(self, i: np.ndarray) -> np.ndarray:
        block = i >> 6
        low = self.words[block] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1))
        return self.before[block] + np.bitwise_count(low)


class WaveletMatrix:
    """Rank of any symbol before any place, one level of bits for each binary digit of the symbols."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.depth = max(1, int(size - 1).bit_length())
        self.levels = []
        rest = symbols
        for level in reversed(range(self.depth)):
            bits = (rest >> level) & 1 == 1
            self.levels.append(Bits(bits))
            rest = np.concatenate([rest[~bits], rest[bits]])
        self.start = self._down(np.arange(size), np.zeros(size, np.int64))

    def _down(self, symbols: np.ndarray, i: np.ndarray) -> np.ndarray:
        for level, bits in zip(reversed(range(self.depth)), self.levels):
            ones = bits.ones(i)
            i = np.where((symbols >> level) & 1, bits.zeros + ones, i - ones)
        return i

    def rank(self, symbols: np.ndarray, i: np.ndarray) -> np.ndarray:
        return self._down(symbols, i) - self.start[symbols]


class Least:
    """Smallest value of any range, from those of ranges whose lengths are powers of two."""

    def __init__(self, values: np.ndarray):
        rows, width = [values.astype(np.int32)], len(values)
        while 2 * (half := 1 << (len(rows) - 1)) <= width:
            rows.append(np.minimum(rows[-1][:-half], rows[-1][half:]))
        self.at = np.cumsum([0, *map(len, rows)])[:-1]
        self.flat = np.concatenate(rows)
        self.log = np.zeros(width + 1, np.int64)
        self.log[1:] = np.floor(np.log2(np.arange(1, width + 1))).astype(np.int64)

    def of(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        k = self.log[hi - lo]
        base = self.at[k]
        return np.minimum(self.flat[base + lo], self.flat[base + hi - (1 << k)])


class FmIndex:
    """Index of sequences of symbols 1.. that each belong to an owner; equal prefixes up to `longest` symbols sort together."""

    def __init__(self, sequences: list[np.ndarray], owners: np.ndarray, longest: int):
        lengths = np.fromiter((len(x) + 1 for x in sequences), np.int64, len(sequences))
        text = np.zeros(int(lengths.sum()), np.int64)  # a 0 ends each sequence
        ends = np.cumsum(lengths)
        for x, end, n in zip(sequences, ends, lengths):
            text[end - n : end - 1] = x
        self.size = int(text.max(initial=0)) + 1
        suffixes = self._sorted(text, longest)
        bwt = text[suffixes - 1]
        self.wavelet = WaveletMatrix(bwt, self.size)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=self.size))])
        self.owner = Least(np.repeat(owners, lengths)[suffixes])

    @staticmethod
    def _sorted(text: np.ndarray, longest: int) -> np.ndarray:
        """Suffixes by their first `longest` symbols, by doubling; equal ones in any order, which no range of a shorter pattern sees."""
        rank, length = text, 1
        order = np.argsort(rank)
        while length < longest:
            after = np.zeros(len(text), np.int64)
            after[:-length] = rank[length:] + 1
            key = rank * (int(after.max(initial=0)) + 1) + after
            order = np.argsort(key)
            key = key[order]
            rank = np.empty(len(text), np.int64)
            rank[order] = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
            length *= 2
        return order

    def extended(self, symbols: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search: ranges of what was found with one symbol more before it."""
        both = self.wavelet.rank(np.concatenate([symbols, symbols]), np.concatenate([lo, hi]))
        return self.first[symbols] + both[: len(lo)], self.first[symbols] + both[len(lo) :]

    def matched_from(self, text: np.ndarray, at: np.ndarray, stop: np.ndarray, below: np.ndarray) -> np.ndarray:
        """Matching statistics to the left: for each place `at` of `text`, the leftmost start, not before `stop`, from which
        the words up to `at` occur in a sequence whose owner is less than `below`; `at + 1` if not even one word does."""
        out = at + 1

        def then(which: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, ...]:
            out[which] = left
            return np.zeros(len(which), bool), left, left

        self.search(text, at, stop, below, then)
        return out

    def search(
        self, text: np.ndarray, at: np.ndarray, stop: np.ndarray, below: np.ndarray,
        then: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]],
    ) -> None:
        """Searches as `matched_from`, each going on by itself: `then(which, left)` is told how far the searches `which` came,
        and returns which of them search again, from where, and their stops."""
        live = np.arange(len(at))
        place, stop = at.copy(), stop.copy()
        lo, hi = self.first[text[place]], self.first[text[place] + 1]
        while len(live):
            on = hi > lo
            on[on] = self.owner.of(lo[on], hi[on]) < below[live[on]]
            ended = np.flatnonzero(~on | (place <= stop))
            go = on & (place > stop)
            if len(ended):
                again, place_, stop_ = then(live[ended], np.where(on[ended], place[ended], place[ended] + 1))
                new = ended[again]
                place[new], stop[new] = place_[again], stop_[again]
                symbols = text[place[new]]
                lo[new], hi[new] = self.first[symbols], self.first[symbols + 1]
                if not again.all():
                    on = np.ones(len(live), bool)
                    on[ended[~again]] = False
                    live, place, stop, lo, hi, go = (x[on] for x in (live, place, stop, lo, hi, go))
            go = np.flatnonzero(go)
            place[go] -= 1
            lo[go], hi[go] = self.extended(text[place[go]], lo[go], hi[go])
