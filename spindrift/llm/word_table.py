"""Ids of distinct words, remembered by a worker, and batches of texts cut to a size."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Distinct words that a worker remembers before it drops the rarer half, and ids of all of them together.
REMEMBERED = 400_000
MOST_IDS = 8_000_000


class WordTable:
    """Rows of ids by word. A subclass says how to ``learn`` words: it appends them and their ids.

    Up to ``remembered`` words and ``most_ids`` ids are kept between calls; beyond that the more frequent half stays.
    """

    def __init__(self, nothing: str | bytes, remembered: int = REMEMBERED, most_ids: int = MOST_IDS):
        self.nothing, self.remembered, self.most_ids = nothing, remembered, most_ids
        self.known: dict[str | bytes, int] = {}
        self.start, self.length, self.hits = (np.zeros(1 << 16, dtype=np.int64) for _ in range(3))
        self.flat = np.zeros(1 << 18, dtype=np.uint32)
        self.used = 0
        self.append([nothing], np.zeros(0, dtype=np.uint32), np.zeros(1, dtype=np.int64))

    def learn(self, new: list) -> None:
        raise NotImplementedError

    def rows(self, words: list) -> np.ndarray:
        """Row of each of some distinct words in the tables."""
        at = np.fromiter(map(self.known.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        missing = np.flatnonzero(at < 0)
        if len(missing) and (len(self.known) > self.remembered or self.used > self.most_ids):
            self._keep_frequent()
            at = np.fromiter(map(self.known.get, words, repeat(-1)), dtype=np.int64, count=len(words))
            missing = np.flatnonzero(at < 0)
        if len(missing):
            new = [words[k] for k in missing.tolist()]
            self.learn(new)
            at[missing] = np.fromiter(map(self.known.__getitem__, new), dtype=np.int64, count=len(new))
        return at

    def _keep_frequent(self) -> None:
        names = list(self.known)  # in the order of their rows
        order = np.argsort(-self.hits[: len(names)], kind="stable")[: self.remembered // 2]
        order = order[np.cumsum(self.length[order]) <= self.most_ids // 2]
        rows = np.union1d(order, [self.known[self.nothing]])
        length, hits = self.length[rows], self.hits[rows] // 2
        flat = self.flat[spread(self.start[rows], length)]
        self.known, self.used = {}, 0
        self.append([names[k] for k in rows.tolist()], flat, length)
        self.hits[: len(rows)] = hits
        self.hits[len(rows) :] = 0

    def append(self, words: list, flat: np.ndarray, length: np.ndarray) -> None:
        first = len(self.known)
        self.known.update(zip(words, range(first, first + len(words))))
        while first + len(words) > len(self.start):
            self.start, self.length, self.hits = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.length, self.hits))
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.start[first : first + len(words)] = self.used + np.cumsum(length) - length
        self.length[first : first + len(words)] = length
        self.flat[self.used : self.used + len(flat)] = flat
        self.used += len(flat)


def byte_letters() -> dict[int, str]:
    """The letter that byte-level tokenizers write for each byte: printable ones as they are, others from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {b: chr(b if b in shown else next(others)) for b in range(256)}


def spread(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Positions start[k], start[k] + 1, ... of all runs, one after the other."""
    before = np.cumsum(length) - length
    return np.arange(int(length.sum()), dtype=np.int64) + np.repeat(start - before, length)


def text_slices(batch: pa.RecordBatch, size: int = 4_000_000) -> Iterator[tuple[pa.RecordBatch, pa.StringArray]]:
    """Slices of a batch with about ``size`` bytes of text, one row at least, and their texts."""
    texts = batch.column("text").cast(pa.string())
    total = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    begin = 0
    while begin < len(texts):
        before = total[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, before + size, side="right")))
        yield batch.slice(begin, end - begin), texts.slice(begin, end - begin)
        begin = end
