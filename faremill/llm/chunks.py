"""Texts as numbered chunks: what a tokenizer does is done once per distinct chunk.

A batch of texts is cut into chunks that the tokenizer treats independently, and the chunks
are numbered by Arrow. Only distinct chunks are encoded; the ids of the texts are gathered
from theirs in one step.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

REMEMBERED = 500_000


def gather(flat: np.ndarray, start: np.ndarray, length: np.ndarray, which: np.ndarray):
    """The runs flat[start[w] : start[w] + length[w]] one after another, and where each ends."""
    lengths = length[which]
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(start[which] - ends + lengths, lengths) + np.arange(total)], ends


class ChunkCodes:
    """Ids of chunks, remembered between batches up to a bounded number of chunks."""

    def __init__(self, encode: Callable[[list[str]], Sequence[Sequence[int]]], remembered: int = REMEMBERED):
        self.encode, self.remembered = encode, remembered
        self._forget()

    def _forget(self) -> None:
        self.at: dict[str, int] = {}
        self.flat, self.start, self.length = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def _keep(self, chunks: list[str]) -> None:
        """Forget all others: what the last texts share with these is likely to come again."""
        which = np.fromiter(map(self.at.__getitem__, chunks), np.int64, len(chunks))
        flat, ends = gather(self.flat, self.start, self.length, which)
        length = self.length[which]
        self._forget()
        self.flat, self.start, self.length = flat, ends - length, length
        self.at = dict(zip(chunks, range(len(chunks))))

    def _learn(self, chunks: list[str]) -> None:
        coded = self.encode(chunks)
        length = np.fromiter(map(len, coded), np.int64, len(coded))
        flat = np.fromiter((i for ids in coded for i in ids), np.int32, int(length.sum()))
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(length) - length])
        self.length = np.concatenate([self.length, length])
        self.flat = np.concatenate([self.flat, flat])
        known = len(self.at)
        self.at.update(zip(chunks, range(known, known + len(chunks))))

    def ids(self, lists: pa.ListArray):
        """Ids of lists of chunks one after another (int32), and where each list ends."""
        coded = lists.flatten().dictionary_encode()
        chunks = coded.dictionary.to_pylist()
        if len(self.at) + len(chunks) > self.remembered:
            self._keep([c for c in chunks if c in self.at])
        get = self.at.get
        new = [c for c in chunks if get(c) is None]
        if new:
            self._learn(new)
        at = np.fromiter(map(self.at.__getitem__, chunks), np.int64, len(chunks))
        which = at[coded.indices.to_numpy(zero_copy_only=False)] if len(chunks) else np.empty(0, np.int64)
        flat, ends = gather(self.flat, self.start, self.length, which)
        chunk_ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)).astype(np.int64)
        if not len(ends):
            return flat, np.zeros(len(lists), np.int64)
        return flat, np.concatenate([[0], ends])[chunk_ends]


def per_text(flat: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    return np.split(flat, ends[:-1]) if len(ends) else []


def texts_of(column: pa.Array) -> pa.Array:
    """Strings without nulls."""
    return pc.fill_null(column.cast(pa.large_string()), "")
