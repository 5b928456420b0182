"""Minimal perfect hashing of distinct keys, level by level."""

import numpy as np

_MIX = 0x9E3779B97F4A7C15
_STEP = 0xD1B54A32D192ED03
# Places for each key that is left at a level.
_ROOM = 2


def mixed(keys: np.ndarray, level: int) -> np.ndarray:
    """64 bits of each key; different keys differ at every level."""
    out = keys.astype(np.uint64) + np.uint64(_STEP * (level + 1) % (1 << 64))
    out = (out ^ (out >> np.uint64(31))) * np.uint64(_MIX)
    out = (out ^ (out >> np.uint64(29))) * np.uint64(_STEP)
    return out ^ (out >> np.uint64(32))


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return (mixed(keys, -1) % np.uint64(parts)).astype(np.int64)


class PerfectHash:
    """Maps each of n keys to a place of its own in 0 to n - 1.

    A level has twice as many places as keys are left; a key that is alone at its place
    stays, the others go to the next level. A place's number is the count of taken
    places before it. Other keys get some place or none, so the caller keeps the
    keys and verifies them.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels = [np.unpackbits(x).astype(bool) for x in levels]
        self.before, n = [], 0
        for taken in self.levels:
            self.before.append(n + np.cumsum(taken) - taken)
            n += int(taken.sum())

    @staticmethod
    def build(keys: np.ndarray) -> list[np.ndarray]:
        """The levels for distinct keys, as bits; a multiple of eight places each."""
        levels = []
        while len(keys):
            size = -(-_ROOM * len(keys) // 8) * 8
            spot = (mixed(keys, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(spot, minlength=size) == 1
            levels.append(np.packbits(alone))
            keys = keys[~alone[spot]]
        return levels

    def of(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key; -1 for a key that no level takes."""
        out, rest = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (taken, before) in enumerate(zip(self.levels, self.before, strict=True)):
            spot = (mixed(keys[rest], level) % np.uint64(len(taken))).astype(np.int64)
            here = taken[spot]
            out[rest[here]] = before[spot[here]]
            rest = rest[~here]
        return out
