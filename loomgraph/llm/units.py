"""A memo of bounded size for byte-level tokenizers: texts are cut into units at spaces, and known units looked up.

The usual split pattern of byte-level tokenizers starts a match at every space that follows a character other than
white space, and at the last space of a run before such a character; to the left of the cut it sees white space or its
end either way. So a text may be cut before such spaces, and its units encoded alone or beside others, without change.
Spaces that aren't surely so are not cut at. Units are found, hashed and looked up with array operations.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from loomgraph.llm.common import _powers, mix

#: Bytes that are no white space: as the last byte of a character, and as its first.
ENDS = (np.arange(256) > 0x20) & (np.arange(256) < 0x7F)
STARTS = ENDS | ((np.arange(256) >= 0xC3) & ~np.isin(np.arange(256), (0xE1, 0xE2, 0xE3)))
#: Longer units are encoded wherever they stand.
LONGEST = 96
#: Bytes of text whose arrays a worker holds at once, but for a single longer text.
SLICE = 1 << 19


def cuts(joined: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the units of texts that stand one byte apart, text i from at[i]."""
    space = np.flatnonzero(joined[1:-1] == 0x20) + 1
    space = space[ENDS[joined[space - 1]] | STARTS[joined[space + 1]]]
    first, stop = at[:-1], at[1:] - 1
    own = stop > first
    starts = np.union1d(space, first[own])
    ends = np.append(starts[1:], 0)
    last = np.searchsorted(starts, stop[own]) - 1
    ends[last] = stop[own]
    return starts, ends


class UnitMemo:
    """Ids of texts. ``encode`` takes units and gives their ids one after another, and how many each has."""

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], units: int = 1 << 20):
        self.encode, self.most, self.held = encode, units, 0
        self.mask = np.uint64(4 * units - 1)  # units is a power of two
        self.keys = np.zeros(4 * units, np.uint64)
        self.checks = np.zeros(4 * units, np.uint32)
        self.offsets = np.zeros(4 * units, np.uint32)
        self.counts = np.zeros(4 * units, np.uint8)
        self.pool, self.used = np.zeros(4 * units, np.uint16), 0
        self.bytes = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        self.powers, self.inverse = _powers(1 << 20)

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and how many each has. Whole texts are taken SLICE bytes at a time."""
        found, first, held = [], 0, 0
        for i, text in enumerate(texts):
            held += len(text)
            if held >= SLICE or i == len(texts) - 1:
                found.append(self.some(texts[first : i + 1]))
                first, held = i + 1, 0
        if not found:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])

    def some(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        joined = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        at = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=at[1:])
        starts, ends = cuts(joined, at)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        n = len(joined)
        if len(self.powers) < n + 1:
            self.powers, self.inverse = _powers(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.bytes[joined] * self.powers[:n], out=sums[1:])
        size = (ends - starts).astype(np.uint64)
        raw = (sums[ends] - sums[starts]) * self.inverse[starts]
        del sums
        keys = mix(raw + size) | np.uint64(1)
        checks = (mix(raw ^ (size * np.uint64(0x9E3779B97F4A7C15))) >> np.uint64(17)).astype(np.uint32)
        slot = self.find(keys, checks)
        counts = np.where(slot >= 0, self.counts[slot], 0).astype(np.int64)
        offsets = np.where(slot >= 0, self.offsets[slot], 0).astype(np.int64)
        pool = self.pool
        if len(gone := np.flatnonzero(slot < 0)):
            long = ends[gone] - starts[gone] > LONGEST
            both = np.where(long, np.arange(len(gone), dtype=np.uint64) << np.uint64(1), keys[gone])  # even: long units stand for themselves
            _, one, back = np.unique(both, return_index=True, return_inverse=True)
            view = memoryview(joined)
            ids, own = self.encode([view[a:b].tobytes() for a, b in zip(starts[gone[one]].tolist(), ends[gone[one]].tolist(), strict=True)])
            first = np.cumsum(own) - own
            counts[gone], offsets[gone] = own[back], first[back] + self.used
            short = ~long[one]
            fits = short & (np.cumsum(short) <= self.most - self.held) & (ids.max(initial=0) < 1 << 16) & (self.used + len(ids) <= len(self.pool))
            pool = np.concatenate((self.pool[: self.used].astype(np.uint32), ids))
            if fits.any():
                keep = np.flatnonzero(fits)
                kept = np.repeat(fits, own)
                place = np.cumsum(own[keep]) - own[keep] + self.used
                self.pool[self.used : self.used + kept.sum()] = ids[kept]
                self.add(keys[gone[one[keep]]], checks[gone[one[keep]]], place, own[keep])
                self.used += int(kept.sum())
        ends_at = np.cumsum(counts)
        out = pool[np.repeat(offsets - (ends_at - counts), counts) + np.arange(ends_at[-1])].astype(np.uint32)
        per_text = np.diff(np.concatenate(([0], ends_at))[np.searchsorted(starts, at)])
        return out, per_text

    def find(self, keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """Places in the table, -1 where a unit isn't known."""
        slot = (keys & self.mask).astype(np.int64)
        there = self.keys[slot]
        rest = np.flatnonzero((there != keys) & (there != 0))
        while len(rest):
            slot[rest] = (slot[rest] + 1) & int(self.mask)
            there_rest = self.keys[slot[rest]]
            there[rest] = there_rest
            rest = rest[(there_rest != keys[rest]) & (there_rest != 0)]
        slot[(there == 0) | (self.checks[slot] != checks)] = -1
        return slot

    def add(self, keys: np.ndarray, checks: np.ndarray, offsets: np.ndarray, counts: np.ndarray) -> None:
        """Enter units that find() didn't know. One whose 64-bit key is taken stays out of the memo."""
        slot = (keys & self.mask).astype(np.int64)
        rest = np.arange(len(keys))
        while len(rest):
            taken = self.keys[slot[rest]]
            free = np.flatnonzero(taken == 0)
            _, one = np.unique(slot[rest[free]], return_index=True)
            new = rest[free[one]]
            at = slot[new]
            self.keys[at], self.checks[at], self.offsets[at], self.counts[at] = keys[new], checks[new], offsets[new], counts[new]
            self.held += len(new)
            rest = rest[self.keys[slot[rest]] != keys[rest]]
            slot[rest] = (slot[rest] + 1) & int(self.mask)
