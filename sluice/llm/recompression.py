"""Run-length grammars of integer sequences by recompression, and longest common extensions on them.

Rounds alternate. Block compression replaces each maximal block c...c by one symbol for (c, length). Pair compression
splits the alphabet in two by a hash bit of each symbol and replaces each pair of a left symbol and a right one, which never overlap.
Equal symbols mean equal stretches, and equal stretches are parsed alike but for a bounded number of symbols at
either end of a round. Two places are therefore compared from the lowest round up, taking the symbols that a
stretch's beginning may have alone, and then down again to the first difference: a bounded number of steps in each of O(log n) rounds.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from sluice.llm.common import mixed

#: A sequence so short isn't compressed further.
SHORT = 16
#: Hash bits that a pair round tries for the split of the alphabet that makes most pairs.
SPLITS = 4


@dataclass
class Round:
    """Symbols before a round, and for each the number of its parent after it.

    ``first`` is each parent's first child and ``length`` its number of children, ``start`` the place of each symbol in the sequence.
    """

    symbols: np.ndarray
    start: np.ndarray
    parent: np.ndarray
    first: np.ndarray
    length: np.ndarray


def _renamed(symbols: np.ndarray, first: np.ndarray, length: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Symbols of the parents: single children keep their own, others get a new one for each (child, mark)."""
    out = symbols[first].copy()
    joint = np.flatnonzero(length > 1)
    if len(joint):
        pairs = np.stack((symbols[first[joint]], marks[joint]))
        order = np.lexsort(pairs[::-1])
        pairs = pairs[:, order]
        new = np.concatenate(([True], (pairs[:, 1:] != pairs[:, :-1]).any(0)))
        out[joint[order]] = int(symbols.max()) + np.cumsum(new)
    return out


def compressed(sequence: np.ndarray) -> list[Round]:
    """The rounds of a sequence of non-negative integers. The last one's parents are too few to be worth another."""
    symbols = sequence.astype(np.int64)
    start = np.arange(len(symbols) + 1)  # with the end
    rounds: list[Round] = []
    blocks = True
    fruitless = 0
    while len(symbols) > SHORT and fruitless < 2 * SPLITS:
        if blocks:
            begins = np.ones(len(symbols), bool)
            np.not_equal(symbols[1:], symbols[:-1], out=begins[1:])
        else:
            seed = np.uint64(len(rounds) + 1) << np.uint64(32)
            bits = mixed(symbols.view(np.uint64) ^ seed)
            most = None
            for i in range(SPLITS):
                left = (bits >> np.uint64(i)) & np.uint64(1) == 1
                for left in (left, ~left):
                    pair = left[:-1] & ~left[1:]
                    number = int(np.count_nonzero(pair))
                    if most is None or number > most:
                        most, best = number, pair
            begins = np.ones(len(symbols), bool)
            begins[1:] = ~best
        first = np.flatnonzero(begins)
        fruitless = fruitless + 1 if len(first) == len(symbols) else 0
        if len(first) < len(symbols):
            length = np.diff(np.append(first, len(symbols)))
            marks = length if blocks else symbols[np.minimum(first + 1, len(symbols) - 1)]
            rounds.append(Round(symbols, start, np.cumsum(begins) - 1, first, length))
            symbols = _renamed(symbols, first, length, marks)
            start = start[np.append(first, len(start) - 1)]
        elif not blocks:  # no split made a pair: another hash may
            rounds.append(Round(symbols, start, np.arange(len(symbols)), first, np.ones(len(symbols), np.int64)))
        blocks = not blocks
    rounds.append(Round(symbols, start, np.arange(len(symbols)), np.arange(len(symbols)), np.ones(len(symbols), np.int64)))
    return rounds


def mirrored(rounds: list[Round]) -> list[Round]:
    """The rounds of the reversed sequence, parsed as the sequence is."""
    out = []
    for r in rounds:
        n, parents = len(r.symbols), len(r.first)
        out.append(Round(r.symbols[::-1], r.start[-1] - r.start[::-1], parents - 1 - r.parent[::-1],
                         (n - r.first - r.length)[::-1], r.length[::-1]))
    return out


class Extensions:
    """Longest common extensions to the right of pairs of places, many at a time."""

    def __init__(self, rounds: list[Round]):
        self.rounds = rounds

    def _advance(self, r: Round, a: np.ndarray, b: np.ndarray, live: np.ndarray) -> np.ndarray:
        """Move the live pairs on past what their parents' symbols have in common; return those that met no difference.

        Within a parent children are equal (a block) or two (a pair), so a step takes as many as both have left of equal symbols.
        """
        n = len(r.symbols)
        live = live[(a[live] < n) & (b[live] < n)]
        live = live[r.symbols[a[live]] == r.symbols[b[live]]]
        pa, pb = r.parent[a[live]], r.parent[b[live]]
        left_a, left_b = r.first[pa] + r.length[pa] - a[live], r.first[pb] + r.length[pb] - b[live]
        block_a = (r.length[pa] > 1) & (r.symbols[r.first[pa]] == r.symbols[r.first[pa] + r.length[pa] - 1])
        block_b = (r.length[pb] > 1) & (r.symbols[r.first[pb]] == r.symbols[r.first[pb] + r.length[pb] - 1])
        step = np.minimum(np.where(block_a, left_a, 1), np.where(block_b, left_b, 1))
        a[live] += step
        b[live] += step
        return live

    def _at_parents(self, r: Round, places: np.ndarray) -> np.ndarray:
        n = len(r.symbols)
        inside = np.minimum(places, n - 1)
        return (places >= n) | (r.first[r.parent[inside]] == inside)

    def find(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Number of equal symbols from places x and y on, place by place."""
        top = len(self.rounds) - 1
        a, b = x.astype(np.int64).copy(), y.astype(np.int64).copy()
        level = np.zeros(len(a), np.int64)  # round in which each pair met its first difference
        live = np.arange(len(a))
        for k, r in enumerate(self.rounds):
            level[live] = k
            if k == top:
                while len(live):
                    live = self._advance(r, a, b, live)
                break
            while True:
                apart = live[~(self._at_parents(r, a[live]) & self._at_parents(r, b[live]))]
                if not len(apart):
                    break
                moved = self._advance(r, a, b, apart)
                if len(moved) < len(apart):
                    gone = np.zeros(len(a), bool)
                    gone[apart] = True
                    gone[moved] = False
                    live = live[~gone[live]]
            n, parents = len(r.symbols), len(r.first)
            for places in (a, b):
                own = places[live]
                places[live] = np.where(own < n, r.parent[np.minimum(own, n - 1)], parents)
        for k in range(top, -1, -1):
            r = self.rounds[k]
            here = np.flatnonzero(level >= k)
            if not len(here):
                continue
            n, parents = len(r.symbols), len(r.first)
            if k < top:
                down = np.flatnonzero(level > k)
                for places in (a, b):
                    own = places[down]
                    places[down] = np.where(own < parents, r.first[np.minimum(own, parents - 1)], n)
            moving = here
            while len(moving):
                moving = self._advance(r, a, b, moving)
        return self.rounds[0].start[a] - x
