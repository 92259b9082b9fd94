"""A cuckoo filter over arrays of 64-bit hashes, in numpy."""

from __future__ import annotations

import numpy as np

SLOTS = 4
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class CuckooFilter:
    """Holds a 16-bit fingerprint of each hash in one of its two buckets.

    ``contains`` never misses what was added and not removed; it errs on others
    about once in 8,000.  Each add stores a copy, so that different
    hashes with one fingerprint can be removed one by one; only what was added may
    be removed.  A table that is nine tenths full gets another beside it.
    """

    def __init__(self, bits: int = 16, tables: list[bytes] | None = None):
        self.bits = bits
        stored = [np.frombuffer(t, dtype=np.uint16).reshape(-1, SLOTS).copy() for t in tables or []]
        self.tables = stored or [self._empty()]

    def _empty(self) -> np.ndarray:
        return np.zeros((2**self.bits, SLOTS), dtype=np.uint16)

    def _places(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = h.astype(np.int64).view(np.uint64)
        print_ = (h >> np.uint64(48)).astype(np.uint16)
        print_[print_ == 0] = 1
        return (h & np.uint64(2**self.bits - 1)).astype(np.int64), print_

    def _other(self, bucket: np.ndarray, print_: np.ndarray) -> np.ndarray:
        jump = (print_.astype(np.uint64) * _SPREAD) >> np.uint64(64 - self.bits)
        return bucket ^ (jump.astype(np.int64) | 1)

    def contains(self, h: np.ndarray) -> np.ndarray:
        one, print_ = self._places(h)
        two = self._other(one, print_)
        found = np.zeros(len(h), dtype=bool)
        for table in self.tables:
            for bucket in (one, two):
                found |= (table[bucket] == print_[:, None]).any(axis=1)
        return found

    def add(self, h: np.ndarray) -> None:
        bucket, print_ = self._places(h)
        at = 0
        while len(bucket):
            if at == len(self.tables):
                self.tables.append(self._empty())
            table = self.tables[at]
            room = max(0, int(0.9 * table.size) - int((table != 0).sum()))
            over = self._settle(table, bucket[:room], print_[:room])
            bucket, print_ = np.r_[over[0], bucket[room:]], np.r_[over[1], print_[room:]]
            at += 1

    def _settle(self, table: np.ndarray, bucket: np.ndarray, print_: np.ndarray, turns: int = 500):
        """Place fingerprints; return those that found no place.

        A turn takes one fingerprint of each bucket: into a free slot, else, from
        the second try on, into the slot of another, which moves on."""
        tried = np.zeros(len(bucket), dtype=np.int64)
        for turn in range(turns):
            if not len(bucket):
                break
            b, first = np.unique(bucket, return_index=True)
            f, t = print_[first], tried[first]
            free = table[b] == 0
            room = free.any(axis=1)
            table[b[room], free[room].argmax(axis=1)] = f[room]
            b, f, t = b[~room], f[~room], t[~room]
            slot = (b + turn) % SLOTS
            out = np.where(t > 0, table[b, slot], f)
            table[b, slot] = np.where(t > 0, f, table[b, slot])
            waits = np.ones(len(bucket), dtype=bool)
            waits[first] = False
            bucket = np.r_[bucket[waits], self._other(b, out)]
            print_ = np.r_[print_[waits], out]
            tried = np.r_[tried[waits], t + 1]
        return bucket, print_

    def remove(self, h: np.ndarray) -> None:
        bucket, print_ = self._places(h)
        for table in self.tables:
            for second in (False, True):
                left = np.zeros(len(bucket), dtype=bool)
                waits = np.arange(len(bucket))
                while len(waits):
                    at = bucket[waits]
                    if second:
                        at = self._other(at, print_[waits])
                    b, first = np.unique(at, return_index=True)
                    mine = waits[first]
                    same = table[b] == print_[mine][:, None]
                    hit = same.any(axis=1)
                    table[b[hit], same[hit].argmax(axis=1)] = 0
                    left[mine[~hit]] = True
                    rest = np.ones(len(waits), dtype=bool)
                    rest[first] = False
                    waits = waits[rest]
                bucket, print_ = bucket[left], print_[left]
        if len(bucket):
            raise ValueError("a hash was removed that is not in the filter")

    def __len__(self) -> int:
        return sum(int((t != 0).sum()) for t in self.tables)

    def stored(self) -> list[bytes]:
        return [t.tobytes() for t in self.tables]
