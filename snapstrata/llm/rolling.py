"""Hashes of words and of ranges of words, and Arrow batches of texts in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from snapstrata.llm.common import mixed

_ODD = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


class Hashes(dict):
    """Word to 64-bit hash, with a bound on what it remembers."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        self[word] = made = xxhash.xxh3_64_intdigest(word)
        return made

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


class Rolling:
    """Hashes of any range of words, from sums of word hashes times powers of an odd number."""

    powers = [(np.ones(1, np.uint64), np.ones(1, np.uint64)) for _ in _ODD]

    def __init__(self, words: np.ndarray, base: int):
        n = len(words) + 1
        if len(self.powers[base][0]) < n:
            odd, inverse = np.uint64(_ODD[base]), np.uint64(pow(_ODD[base], -1, 1 << 64))
            length = 2 * n
            Rolling.powers[base] = tuple(np.cumprod(np.concatenate([[np.uint64(1)], np.full(length, x, np.uint64)])) for x in (odd, inverse))
        up, self.down = (x[:n] for x in self.powers[base])
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(words * up[:-1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start])


def batches(docs: DataFrame, rows, schema: str) -> DataFrame:
    """rows(batch as columns of Python values) gives columns by name, as arrays."""
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            # A few megabytes of text at a time: what comes out can be larger than what goes in.
            step = max(1, int(batch.num_rows * (1 << 22) / max(batch.nbytes, 1)))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                made = rows({x: part.column(x).cast(pa.binary()).to_pylist() if x == "text" else part.column(x).to_pylist() for x in part.schema.names}, hashes)
                yield pa.RecordBatch.from_arrays([made[x] if isinstance(made[x], pa.Array) else pa.array(made[x]) for x in names], names)

    return docs.mapInArrow(run, schema)
