"""A hash table from whole numbers to whole numbers that looks up arrays of keys at once."""

from __future__ import annotations

import numpy as np

_STEP = np.uint64(0x9E3779B97F4A7C15)


class HashTable:
    """Open addressing over numpy arrays; keys are 0 or more, values 32 bits wide, ``missing`` if absent."""

    def __init__(self, bits: int = 16, missing: int = -1):
        self.missing = missing
        self._clear(bits)

    def _clear(self, bits: int) -> None:
        self.bits, self.used = bits, 0
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, self.missing, np.int32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * _STEP) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        there = self.keys[slot]
        out = self.values[slot]
        open_ = np.flatnonzero((there != keys) & (there >= 0))
        out[there < 0] = self.missing
        mask = (1 << self.bits) - 1
        while len(open_):
            slot[open_] = (slot[open_] + 1) & mask
            there = self.keys[slot[open_]]
            out[open_] = np.where(there == keys[open_], self.values[slot[open_]], self.missing)
            open_ = open_[(there != keys[open_]) & (there >= 0)]
        return out

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Adds keys, each once, that are not there yet."""
        if 2 * (self.used + len(keys)) > len(self.keys):
            full = self.keys >= 0
            keys, values = np.concatenate([self.keys[full], keys]), np.concatenate([self.values[full], values])
            self._clear(max(self.bits, int(4 * len(keys)).bit_length()))
        slot, todo, mask = self._slot(keys), np.arange(len(keys)), (1 << self.bits) - 1
        while len(todo):
            free = self.keys[slot[todo]] < 0
            self.keys[slot[todo[free]]] = keys[todo[free]]
            mine = self.keys[slot[todo]] == keys[todo]
            self.values[slot[todo[mine]]] = values[todo[mine]]
            todo = todo[~mine]
            slot[todo] = (slot[todo] + 1) & mask
        self.used += len(keys)
