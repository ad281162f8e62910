"""A minimal acyclic transducer of words: shared prefixes and suffixes, one number per word, ids by number.

The automaton is built from sorted words with Daciuk's incremental algorithm (2000); arcs carry the number of
words that come before (Lucchesi and Kowaltowski, 1993), so that the outputs along a word's path add up to its
place among the words, and that place leads to its ids.

The file holds little-endian unsigned 32-bit integers: slots, states, words, ids; then the arcs as an open hash table
(keys state * 256 + byte + 1, 0 for empty; targets; outputs), a final mark for each state, where each word's ids
start, and the ids. Readers map it into memory and share its pages.
"""

from __future__ import annotations

import mmap

import numpy as np

HASH = 2654435761  # Knuth's multiplicative hash


class _Builder:
    def __init__(self):
        self.arcs: list[dict] = [{}]
        self.final = [False]
        self.register: dict = {}
        self.free: list[int] = []

    def state(self) -> int:
        if self.free:
            s = self.free.pop()
            self.arcs[s], self.final[s] = {}, False
            return s
        self.arcs.append({})
        self.final.append(False)
        return len(self.arcs) - 1

    def settle(self, path: list[tuple[int, int]], keep: int) -> None:
        """Replace the states of the last word's path beyond ``keep`` arcs by equal ones, from the end."""
        while len(path) > keep:
            parent, byte = path.pop()
            child = self.arcs[parent][byte]
            same = self.register.setdefault((self.final[child], tuple(self.arcs[child].items())), child)
            if same != child:
                self.arcs[parent][byte] = same
                self.free.append(child)

    def build(self, words: list[bytes]) -> None:
        path: list[tuple[int, int]] = []
        last = b""
        for word in words:
            common = 0
            while common < len(last) and common < len(word) and last[common] == word[common]:
                common += 1
            self.settle(path, common)
            state = self.arcs[path[-1][0]][path[-1][1]] if path else 0
            for byte in word[common:]:
                child = self.state()
                self.arcs[state][byte] = child
                path.append((state, byte))
                state = child
            self.final[state] = True
            last = word
        self.settle(path, 0)


def compiled(entries: dict[bytes, bytes]) -> bytes:
    """The file's bytes for words and their ids (little-endian unsigned 32-bit integers)."""
    words = sorted(entries)
    builder = _Builder()
    builder.build(words)
    arcs, final = builder.arcs, builder.final
    order, seen, stack = [], set(), [(0, False)]
    while stack:  # children before parents
        state, done = stack.pop()
        if done:
            order.append(state)
        elif state not in seen:
            seen.add(state)
            stack.append((state, True))
            stack.extend((child, False) for child in arcs[state].values() if child not in seen)
    number = {state: i for i, state in enumerate(reversed(order))}  # the start is 0
    below: dict[int, int] = {}
    keys, targets, outputs = [], [], []
    for state in order:
        count = int(final[state])
        for byte, child in arcs[state].items():  # added in ascending order, as the words are sorted
            keys.append(number[state] * 256 + byte + 1)
            targets.append(number[child])
            outputs.append(count)
            count += below[child]
        below[state] = count
    bits = max(4, (2 * len(keys) + 1).bit_length())
    size = 1 << bits
    table = np.zeros((3, size), "<u4")
    taken = bytearray(size)
    for key, target, output in zip(keys, targets, outputs):
        slot = ((key * HASH) & 0xFFFFFFFF) >> (32 - bits)
        while taken[slot]:
            slot = (slot + 1) & (size - 1)
        taken[slot] = 1
        table[0, slot], table[1, slot], table[2, slot] = key, target, output
    marks = np.zeros(len(order), "<u4")
    for state in order:
        marks[number[state]] = final[state]
    ids = b"".join(entries[word] for word in words)
    starts = np.cumsum([0, *(len(entries[word]) // 4 for word in words)]).astype("<u4")
    head = np.array([size, len(order), len(words), len(ids) // 4], "<u4")
    return b"".join((head.tobytes(), table.tobytes(), marks.tobytes(), starts.tobytes(), ids))


class Lexicon:
    """A compiled file, mapped into memory."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.map = memoryview(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))
        numbers = self.map.cast("I")
        self.size, self.states, self.words, n_ids = numbers[:4].tolist()
        places = np.cumsum([4, self.size, self.size, self.size, self.states, self.words + 1, n_ids]).tolist()
        self.keys, self.targets, self.outputs, self.final, self.starts, _ = (
            numbers[a:b] for a, b in zip(places, places[1:]))
        self.ids = self.map[4 * places[5] :]
        self.shift, self.mask = 32 - (self.size.bit_length() - 1), self.size - 1

    def find(self, word: bytes) -> bytes | None:
        """The word's ids, or None if the lexicon doesn't have it."""
        keys, targets, outputs, shift, mask = self.keys, self.targets, self.outputs, self.shift, self.mask
        state = place = 0
        for byte in word:
            key = state * 256 + byte + 1
            slot = ((key * HASH) & 0xFFFFFFFF) >> shift
            while (held := keys[slot]) != key:
                if not held:
                    return None
                slot = (slot + 1) & mask
            place += outputs[slot]
            state = targets[slot]
        if not self.final[state]:
            return None
        return bytes(self.ids[4 * self.starts[place] : 4 * self.starts[place + 1]])

    def find_all(self, words: list[bytes]) -> list[bytes | None]:
        """``find`` of many words at once: they go through the automaton together, byte by byte."""
        if not words:
            return []
        size = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        start = np.cumsum(size) - size
        state = np.zeros(len(words), np.int64)
        place = np.zeros(len(words), np.int64)
        at, alive = 0, np.arange(len(words))
        found = np.zeros(len(words), bool)
        keys, targets, outputs, final = map(np.asarray, (self.keys, self.targets, self.outputs, self.final))
        while len(alive):
            ended = size[alive] == at
            done, alive = alive[ended], alive[~ended]
            found[done] = final[state[done]] == 1
            key = state[alive] * 256 + data[start[alive] + at] + 1
            slot = ((key * HASH) & 0xFFFFFFFF) >> self.shift
            held = keys[slot]
            other = np.flatnonzero((held != key) & (held != 0))
            while len(other):
                slot[other] = (slot[other] + 1) & self.mask
                held[other] = keys[slot[other]]
                other = other[(held[other] != key[other]) & (held[other] != 0)]
            there = held == key
            alive, slot = alive[there], slot[there]
            place[alive] += outputs[slot]
            state[alive] = targets[slot]
            at += 1
        out: list = [None] * len(words)
        hits = np.flatnonzero(found)
        starts = np.asarray(self.starts)
        for i, a, b in zip(hits.tolist(), (4 * starts[place[hits]].astype(np.int64)).tolist(), (4 * starts[place[hits] + 1].astype(np.int64)).tolist()):
            out[i] = bytes(self.ids[a:b])
        return out
