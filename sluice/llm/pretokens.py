"""Pre-tokens of texts, cut in NumPy by a tokenizer's own pattern, and a flat table of the frequent ones' lengths."""

from __future__ import annotations

import json
import math
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sluice.llm.common import mixed, pieces, texts
from sluice.llm.token_units import Encoder, Memo, byte_of_character, encoded
from sluice.sources.workspace import write_table

SPACE, LETTER, DIGIT, MARK, ODD = range(5)
#: UTF-16 units of a pre-token that fit a key; longer ones are left to the workers' caches.
WIDTH = 16
#: UTF-16 units that are cut at a time; longer texts are taken in stretches that end before a blank.
BLOCK = 1 << 19
#: Pre-tokens of a summary, and of the table: 2.4 MB, whatever the input.
ENTRIES = 1 << 15
#: Places of a task's counts, a power of two: 22 MB.
COUNTED = 1 << 19
#: Summaries that are merged at a time, and the most that reach the driver: 8 * 32,768 of 48 bytes, 13 MB.
FAN = 8

_FIRST = np.arange(0, WIDTH, 4)
_MASKS = np.array([[(1 << 16 * min(max(n - at, 0), 4)) - 1 for n in range(WIDTH + 1)] for at in _FIRST.tolist()], np.uint64)
_FACTORS = mixed(np.arange(1, 5, dtype=np.uint64)) | np.uint64(1)


def classes(encoder: Encoder) -> tuple[np.ndarray, np.ndarray] | None:
    """What the tokenizer itself does with each 16-bit character: its kind, and its normal form.

    A character is of a kind only if its normal form is one character that no neighbour changes; all others, such as combining marks and
    surrogates, are odd, and the library gets their words whole. None if the tokenizer's pattern isn't the known one.
    """
    if not encoder.direct or encoder.blank:
        return None
    normal = encoder.tokenizer.normalizer.normalize_str if encoder.tokenizer.normalizer else str
    cut = encoder.tokenizer.pre_tokenizer.pre_tokenize_str
    kinds, forms = np.full(1 << 16, ODD, np.uint8), np.arange(1 << 16, dtype=np.uint16)
    for code in (*range(0x1100), *range(0x1200, 0xD800), *range(0xE000, 1 << 16)):  # conjoining letters and surrogates stay odd
        form = normal(chr(code))
        if len(form) != 1 or ord(form) >> 16 or unicodedata.category(chr(code))[0] == "M":
            continue
        joins = [len(cut(side + form + side)) == 1 for side in "a!"]
        forms[code] = ord(form)
        if not cut(form):
            kinds[code] = SPACE
        elif any(joins):
            kinds[code] = LETTER if joins[0] else MARK
        elif len(cut("0" + form + "0")) == 3:
            kinds[code] = DIGIT
    return kinds, forms


class Cut:
    """Pre-tokens of one block of texts: ``row``, ``start`` and ``end`` of each, and the words that the library must see whole."""

    def __init__(self, kinds: np.ndarray, forms: np.ndarray, rows: list[int], stretches: list[bytes]):
        blank = " ".encode("utf-16-le")
        data = blank + blank.join(stretches) + blank
        raw = np.frombuffer(data, "<u2")
        kind = kinds[raw]
        self.units = np.zeros(len(raw) + WIDTH, "<u2")
        self.units[: len(raw)] = forms[raw]
        begins = np.zeros(len(raw), bool)
        begins[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
        self._contract(kind, begins)
        borders = np.flatnonzero(begins)
        inner = kind[borders] != SPACE
        start, end = borders[inner], np.append(borders, len(raw))[1:][inner]
        offsets = np.cumsum([1, *(len(s) // 2 + 1 for s in stretches)])[:-1]
        rows = np.array(rows, np.int64)

        odd = np.flatnonzero(kind == ODD)
        self.words: list[tuple[int, str]] = []
        if len(odd):
            space = kind == SPACE
            first = np.flatnonzero(~space[1:] & space[:-1]) + 1
            last = np.flatnonzero(space[1:] & ~space[:-1]) + 1
            whole = np.zeros(len(first), bool)
            whole[np.searchsorted(first, odd, "right") - 1] = True
            of = rows[np.searchsorted(offsets, first[whole], "right") - 1]
            self.words = [(row, data[2 * a : 2 * b].decode("utf-16-le"))
                          for row, a, b in zip(of.tolist(), first[whole].tolist(), last[whole].tolist())]
            plain = ~whole[np.searchsorted(first, start, "right") - 1]
            start, end = start[plain], end[plain]
        self.start, self.end = start, end
        self.row = rows[np.searchsorted(offsets, start, "right") - 1] if len(start) else np.empty(0, np.int64)

    def _contract(self, kind: np.ndarray, begins: np.ndarray) -> None:
        """An apostrophe that begins a pre-token takes one or two of the letters after it, as the pattern's first choices say."""
        at = np.flatnonzero(begins & (self.units[: len(kind)] == ord("'")))
        at = at[kind[at + 1] == LETTER]
        one, two = self.units[at + 1], self.units[at + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = np.zeros(len(at), bool)
        for a, b in ("re", "ve", "ll"):
            long |= (one == ord(a)) & (two == ord(b))
        begins[at[short | long] + 1] = False
        begins[at[short] + 2] = True
        begins[at[long] + 3] = True

    def keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the pre-tokens that fit a key, their keys (a column each) and sizes."""
        size = self.end - self.start
        fit = np.flatnonzero(size <= WIDTH)
        # eight bytes from every unit on
        window = np.ndarray((len(self.units) - 3,), "<u8", self.units, strides=(2,))
        size, start = size[fit], self.start[fit]
        keys = np.zeros((len(_FIRST), len(fit)), np.uint64)
        long = slice(None)
        for part, (at, masks) in enumerate(zip(_FIRST.tolist(), _MASKS)):
            if at:
                long = np.flatnonzero(size > at)
            keys[part, long] = window[start[long] + at] & masks[size[long]]
        return fit, keys, size

    def text(self, places: np.ndarray) -> list[bytes]:
        data = self.units.tobytes()
        return [data[2 * a : 2 * b] for a, b in zip(self.start[places].tolist(), self.end[places].tolist())]


def stretches(values: list[str], special: list[str]):
    """Blocks of (rows, UTF-16 texts), and the rows of texts with special strings, which the library gets whole."""
    rows, found, size, whole = [], [], 0, []
    blocks = []
    for row, text in enumerate(values):
        if any(mark in text for mark in special):
            whole.append(row)
            continue
        at = 0
        while at < len(text):
            end = text.find(" ", at + BLOCK) if len(text) - at > BLOCK else -1
            end = len(text) if end < 0 else end
            data = text[at:end].encode("utf-16-le")
            rows.append(row)
            found.append(data)
            size += len(data) // 2
            at = end
            if size >= BLOCK:
                blocks.append((rows, found))
                rows, found, size = [], [], 0
    if rows:
        blocks.append((rows, found))
    return blocks, whole


def hashed(keys: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        total = sizes.astype(np.uint64)
        for part, factor in zip(keys, _FACTORS):
            total += part * factor
        return mixed(total)


class Lengths:
    """Token counts of pre-tokens, by open addressing in flat arrays; at most half of the places are taken."""

    def __init__(self, keys: np.ndarray, sizes: np.ndarray, tokens: np.ndarray):
        places = 1 << max(4, (2 * len(sizes) - 1).bit_length())
        self.keys, self.sizes = np.zeros((len(_FIRST), places), np.uint64), np.zeros(places, np.uint8)
        self.tokens = np.zeros(places, np.uint32)
        for i, at in enumerate((hashed(keys, sizes) & np.uint64(places - 1)).tolist()):
            while self.sizes[at]:
                at = (at + 1) % places
            self.keys[:, at], self.sizes[at], self.tokens[at] = keys[:, i], sizes[i], tokens[i]

    def find(self, keys: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The number of tokens of each key, -1 for unknown ones; a key is known only if all its units agree."""
        last = len(self.sizes) - 1
        place = (hashed(keys, sizes) & np.uint64(last)).astype(np.int64)
        out = np.full(len(sizes), -1, np.int64)
        left = None  # places of the keys still looked for; at first all
        while len(place):
            own = (keys, sizes) if left is None else (keys[:, left], sizes[left])
            same = self.sizes[place] == own[1]
            for part, column in zip(self.keys, own[0]):
                same &= part[place] == column
            found = np.flatnonzero(same)
            out[found if left is None else left[found]] = self.tokens[place[found]]
            on = np.flatnonzero((self.sizes[place] > 0) & ~same)
            left = on if left is None else left[on]
            place = (place[on] + 1) & last
        return out


class _Summary:
    """Counts of keys in a table of ``COUNTED`` places by hash; a place has one key, the last that came, and the count of all of its keys.

    So a frequent key may hide another, and a rare one may pass for it.
    """

    def __init__(self):
        self.keys, self.sizes = np.zeros((len(_FIRST), COUNTED), np.uint64), np.zeros(COUNTED, np.uint8)
        self.counts = np.zeros(COUNTED, np.int64)

    def add(self, keys, sizes, counts=1) -> None:
        place = (hashed(keys, sizes) & np.uint64(COUNTED - 1)).astype(np.int64)
        np.add.at(self.counts, place, counts)
        self.sizes[place] = sizes
        for part, column in zip(self.keys, keys):
            part[place] = column

    def first(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys, sizes and counts of the ``ENTRIES`` highest counts."""
        used = np.flatnonzero(self.counts)
        used = used[np.argsort(-self.counts[used], kind="stable")[:ENTRIES]]
        return self.keys[:, used], self.sizes[used].astype(np.int64), self.counts[used]

    def batch(self) -> pa.RecordBatch:
        keys, sizes, counts = self.first()
        return pa.RecordBatch.from_arrays([pa.array(column) for column in (*keys.view(np.int64), sizes, counts)], pa.schema(_COLUMNS))

    def take(self, batch) -> None:
        *keys, sizes, counts = (column.to_numpy() for column in batch.columns)
        self.add(np.array(keys).view(np.uint64), sizes, counts)


_COLUMNS = [(name, pa.int64()) for name in (*(f"key{i}" for i in range(len(_FIRST))), "size", "n")]
_SUMMARY = ", ".join(f"{name} bigint" for name, _ in _COLUMNS)


def frequent(docs: DataFrame, tables, special: list[str], folder: str) -> tuple[np.ndarray, np.ndarray]:
    """Keys and sizes of the most frequent pre-tokens, at most ``ENTRIES``; all texts are counted and nothing is shuffled.

    Each task writes a summary; tasks that read ``FAN`` summaries each write theirs, until the driver can merge ``FAN`` of them.
    Summaries leave rare pre-tokens out and places are shared, so counts are near ones: the choice steers speed alone.
    """

    def count(batches):
        kinds, forms = tables.value
        summary = _Summary()
        for piece in pieces(batches):
            for block in stretches(texts(piece.column(0)), special)[0]:
                summary.add(*Cut(kinds, forms, *block).keys()[1:])
        yield summary.batch()

    def merge(batches):
        summary = _Summary()
        for batch in batches:
            summary.take(batch)
        yield summary.batch()

    level = 0
    found = write_table(docs.select("text").mapInArrow(count, _SUMMARY), f"{folder}/0")
    while (files := len(found.inputFiles())) > FAN:
        level += 1
        found = write_table(found.coalesce(math.ceil(files / FAN)).mapInArrow(merge, _SUMMARY), f"{folder}/{level}")
    summary = _Summary()
    for batch in found.toArrow().to_batches():
        summary.take(batch)
    return summary.first()[:2]


class Counter:
    """Numbers of tokens: of pre-tokens by the library's model, of words and texts by the whole library; each once while it is remembered."""

    def __init__(self, spec: str, remembered: int):
        self.encoder = Encoder(spec)
        character = {b: c for c, b in byte_of_character().items()}
        self.alphabet = [character[b] for b in range(256)]
        self.cut, self.words = Memo(self.tokens, remembered), Memo(self.whole, remembered)

    def tokens(self, found: list[bytes]) -> list[int]:
        model, alphabet = self.encoder.model, self.alphabet
        names = (data.decode("utf-16-le") for data in found)
        return [len(model.tokenize("".join([alphabet[b] for b in name.encode()]))) for name in names]

    def whole(self, found: list[str]) -> list[int]:
        return [len(ids) // 4 for ids in encoded(self.encoder.tokenizer, found)]


def special_strings(spec: str) -> list[str]:
    """Strings that the library cuts out of a text before its pattern."""
    return [token["content"] for token in json.loads(spec)["added_tokens"]]
