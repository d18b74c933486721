"""A cuckoo filter over 64-bit hashes, in arrays: all operations take many hashes at once.

A bucket has four slots of 16 bits. A hash gives a fingerprint (never 0, which is an empty
slot) and a bucket; its other bucket is the first one changed by a hash of the fingerprint,
so an entry can be moved knowing only itself. A filter never denies a hash that was inserted
and not deleted. Only hashes that were inserted may be deleted.
"""

from __future__ import annotations

import numpy as np

SLOTS = 4
BUCKETS = 1 << 13
# Inserting goes on finding places well beyond this share of the slots.
MOST_LOAD = 0.9
_ROUNDS = 2000
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Full(ValueError):
    """The hashes do not fit."""


def _spots(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, bucket) from two independent parts of the mixed hash."""
    mixed = (hashes ^ (hashes >> np.uint64(31))) * _MIX
    mixed ^= mixed >> np.uint64(29)
    prints = (mixed >> np.uint64(48)).astype(np.uint16)
    prints[prints == 0] = 1
    return prints, (mixed & np.uint64(buckets - 1)).astype(np.int64)


def _other(bucket: np.ndarray, prints: np.ndarray, buckets: int) -> np.ndarray:
    jump = ((prints.astype(np.uint64) * _MIX) >> np.uint64(40)).astype(np.int64) | 1
    return bucket ^ (jump & (buckets - 1))


class CuckooFilter:
    def __init__(self, buckets: int = BUCKETS):
        if buckets & (buckets - 1):
            raise ValueError("the number of buckets is no power of two")
        self.table = np.zeros((buckets, SLOTS), np.uint16)

    @classmethod
    def load(cls, data: bytes) -> CuckooFilter:
        found = cls(1)
        found.table = np.frombuffer(data, "<u2").reshape(-1, SLOTS).copy()
        return found

    def dump(self) -> bytes:
        return self.table.astype("<u2").tobytes()

    def __len__(self) -> int:
        return int(np.count_nonzero(self.table))

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        prints, bucket = _spots(hashes, len(self.table))
        other = _other(bucket, prints, len(self.table))
        return ((self.table[bucket] == prints[:, None]) | (self.table[other] == prints[:, None])).any(axis=1)

    def insert(self, hashes: np.ndarray) -> None:
        """Insert every hash once per mention; raises Full where the table has no room left."""
        if len(self) + len(hashes) > MOST_LOAD * self.table.size:
            raise Full(f"{len(self) + len(hashes)} entries for {self.table.size} slots")
        prints, bucket = _spots(hashes, len(self.table))
        # A fixed seed: a task that is run again builds the same filter.
        pick, turn = np.random.default_rng(len(self)), 0
        prints, bucket = self._settle(prints, bucket)
        prints, bucket = self._settle(prints, _other(bucket, prints, len(self.table)))
        while len(prints):
            turn += 1
            if turn > _ROUNDS:
                raise Full("no place found by moving entries")
            # One entry per full bucket takes a slot; what stood there goes to its other bucket.
            _, one = np.unique(bucket, return_index=True)
            slot = pick.integers(0, SLOTS, len(one))
            thrown = self.table[bucket[one], slot]
            self.table[bucket[one], slot] = prints[one]
            waits = np.ones(len(prints), bool)
            waits[one] = False
            moved = _other(bucket[one], thrown, len(self.table))
            prints, bucket = self._settle(np.concatenate([thrown, prints[waits]]), np.concatenate([moved, bucket[waits]]))

    def _settle(self, prints: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Put entries into free slots of their buckets; returns those without one."""
        order = np.argsort(bucket, kind="stable")
        prints, bucket = prints[order], bucket[order]
        new = np.ones(len(bucket), bool)
        new[1:] = bucket[1:] != bucket[:-1]
        rank = np.arange(len(bucket)) - np.flatnonzero(new)[np.cumsum(new) - 1]
        free = self.table[bucket] == 0
        fits = rank < free.sum(axis=1)
        # The free slot whose number among the free ones is the entry's rank in its bucket.
        slot = np.argmax(free & (np.cumsum(free, axis=1) == rank[:, None] + 1), axis=1)
        self.table[bucket[fits], slot[fits]] = prints[fits]
        return prints[~fits], bucket[~fits]

    def delete(self, hashes: np.ndarray) -> None:
        """Take one entry per mention away; raises KeyError for a hash that is not in the filter."""
        prints, bucket = _spots(hashes, len(self.table))
        left = np.arange(len(hashes))
        for _ in range(len(hashes) + 1):
            if not len(left):
                return
            # Entries of one bucket and fingerprint are taken one per turn, so that no slot is emptied twice.
            first, second = bucket[left], _other(bucket[left], prints[left], len(self.table))
            pair = np.minimum(first, second) * (1 << 16) + prints[left]
            _, one = np.unique(pair, return_index=True)
            for place in (first, second):
                hit = self.table[place[one]] == prints[left][one][:, None]
                has = hit.any(axis=1)
                self.table[place[one][has], np.argmax(hit, axis=1)[has]] = 0
                done = one[has]
                one = one[~has]
                left[done] = -1
            if len(one):
                raise KeyError("a hash was deleted that is not in the filter")
            left = left[left >= 0]
