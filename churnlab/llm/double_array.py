"""A double-array trie over byte strings, built once on the driver from a vocabulary and walked with numpy.

State ``s`` has the child ``base[s] + byte + 1`` if ``check`` there names ``s``. Missing children lead to state -1.
"""

from __future__ import annotations

import numpy as np


class DoubleArray:
    """``value[s]`` is the number of the key that ends in state ``s``, or -1. The root is state 0."""

    def __init__(self, keys: list[bytes]):
        children: list[dict[int, int]] = [{}]
        ends: dict[int, int] = {}
        for number, key in enumerate(keys):
            node = 0
            for byte in key:
                nxt = children[node].get(byte)
                if nxt is None:
                    nxt = children[node][byte] = len(children)
                    children.append({})
                node = nxt
            ends[node] = number
        # A node's base depends on its own bytes only: nodes with most children choose first, from a mark that moves
        # on as the slots there fill up; nodes with one child take the slots left over.
        base = np.zeros(len(children), np.int64)
        free, mark = np.ones(2 * len(children) + 4096, bool), 1
        free[0] = False
        for node in sorted((n for n, c in enumerate(children) if len(c) > 1), key=lambda n: -len(children[n])):
            codes, at, fit = np.array(list(children[node])) + 1, mark, np.zeros(1, bool)
            while True:
                if at + 1024 > len(free):
                    free = np.r_[free, np.ones(len(free), bool)]
                fit = free[np.arange(at, at + 512)[:, None] + codes].all(axis=1)
                if fit.any():
                    break
                at += 512
            base[node] = at + int(fit.argmax())
            free[base[node] + codes] = False
            mark = base[node] - 128 if base[node] > mark + 256 else mark
        single = [(n, next(iter(c)) + 1) for n, c in enumerate(children) if len(c) == 1]
        free = np.r_[free, np.ones(len(single) + 512, bool)]
        slots = np.nonzero(free[257:])[0][:len(single)] + 257
        for (node, code), slot in zip(single, slots.tolist()):
            base[node] = slot - code
            free[slot] = False
        used = int(np.nonzero(~free)[0].max()) + 260
        self.base, self.check = np.zeros(used, np.int32), np.full(used, -1, np.int32)
        self.value = np.full(used, -1, np.int32)
        self.check[0] = -2
        todo = [(0, 0)]
        while todo:
            node, place = todo.pop()
            self.base[place] = base[node]
            self.value[place] = ends.get(node, -1)
            for byte, kid in children[node].items():
                to = int(base[node]) + byte + 1
                self.check[to] = place
                todo.append((kid, to))

    def step(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Child of each state by each byte, -1 if there is none (also from state -1)."""
        to = self.base[states] + codes + 1
        return np.where((states >= 0) & (self.check[to] == states), to, -1)

    def child(self, state: int, byte: int) -> int:
        to = int(self.base[state]) + byte + 1
        return to if self.check[to] == state else -1
