"""Fill-in-the-middle: texts cut into prefix, middle and suffix at ranks that an indexable skip list finds exactly."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from sluice.llm.common import id_and_text, mixed, pieces, texts, with_id

PLAIN, PSM, SPM = "plain", "psm", "spm"


@dataclass(frozen=True)
class Settings:
    """``plain`` and ``spm``: percentages of texts that stay as they are, and of the others that put the suffix first."""

    seed: str = "1"
    plain: int = 10
    spm: int = 20
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self):
        marks = (self.prefix, self.suffix, self.middle)
        first = [mark[:1] for mark in marks]
        if not all(marks) or len(set(marks)) < 3 or any(c in mark[1:] for c in first for mark in marks):
            raise ValueError("marks must differ, and hold the characters that marks begin with only there")
        if any(a != b and b.startswith(a) for a in marks for b in marks):
            raise ValueError("no mark may begin another one")


class SkipList:
    """An indexable skip list over a text's units, in arrays.

    Lane 0 has every unit; each higher lane has about one in ``STEP`` nodes of the lane below, chosen by a hash of the
    place, and the first always. A node's link carries how many units and how many code points it passes over, so a
    descent that adds up these widths comes to any rank in steps that grow with the logarithm of the length.
    A unit is a run of ASCII letters, or any other single code point.
    """

    STEP = 8

    def __init__(self, data: bytes):
        """``data``: the text in UTF-8."""
        raw = np.frombuffer(data, np.uint8)
        letter = ((raw | np.uint8(32)) - np.uint8(97)) < 26
        point = (raw & np.uint8(0xC0)) != 0x80
        begins = point.copy()
        begins[1:] &= ~(letter[1:] & letter[:-1])
        starts = np.flatnonzero(begins)
        self.units = len(starts)
        self.down: list[np.ndarray] = []  # place of each node of a lane in the lane below
        self.passed: list[tuple[np.ndarray, np.ndarray]] = []  # units and code points that a link passes over
        if not self.units:
            return
        self._lane(np.ones(self.units, np.int64), np.add.reduceat(point, starts, dtype=np.int64))
        towers = mixed(np.arange(self.units, dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        while len(towers) > self.STEP:
            chosen = towers % np.uint64(self.STEP) == 0
            chosen[0] = True
            nodes = np.flatnonzero(chosen)
            towers = towers[nodes] // np.uint64(self.STEP)
            self.down.append(nodes)
            self._lane(*(np.add.reduceat(width, nodes) for width in self.passed[-1]))

    def _lane(self, units: np.ndarray, points: np.ndarray) -> None:
        self.passed.append((units, points))

    def points_before(self, rank: int) -> int:
        """Code points of the first ``rank`` units."""
        left, points, node = rank, 0, 0
        for lane in range(len(self.passed) - 1, -1, -1):
            units, widths = self.passed[lane]
            while node < len(units) and units[node] <= left:
                left -= int(units[node])
                points += int(widths[node])
                node += 1
            if not left:
                break
            if lane:  # here the node exists, as a rank beyond it would have passed it
                node = int(self.down[lane - 1][node])
        return points


def cut(doc_id, text: str, settings: Settings = Settings()) -> tuple:
    """n, form, prefix_chars, middle_chars and output of one text."""
    lanes = SkipList(text.encode())
    n = lanes.units
    key = f"{settings.seed}:{'' if doc_id is None else doc_id}"
    h1, h2, h3, h4 = np.frombuffer(hashlib.sha256(key.encode()).digest()[:16], ">u4").tolist()
    marks = (settings.prefix, settings.suffix, settings.middle)
    if not text or any(mark in text for mark in marks) or h3 % 100 >= 100 - settings.plain:
        return n, PLAIN, None, None, text
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = lanes.points_before(first), lanes.points_before(second)
    parts = {settings.prefix: text[:a], settings.middle: text[a:b], settings.suffix: text[b:]}
    form, order = (SPM, (marks[1], marks[0], marks[2])) if h4 % 100 < settings.spm else (PSM, marks)
    return n, form, a, b - a, "".join(mark + parts[mark] for mark in order)


def fill_in_middle(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and output of every document.

    A text has n units: runs of ASCII letters, and any other code point alone. h1 to h4 are the first four 32-bit groups
    of the SHA-256 of seed, colon and doc_id. The prefix ends after the smaller of h1 % (n + 1) and h2 % (n + 1) units,
    the middle after the larger. The form is plain, with the text as output, if the text is empty or holds a mark, or for
    ``plain`` percent of the texts by h3; else spm for ``spm`` percent by h4, else psm: the parts in that order, each after its mark.
    Lengths are in code points and null for plain texts.

    Null texts count as empty; a null id counts as an empty one. Rows are kept as they are, repeated ones get equal results. An empty table
    gives an empty result, other columns don't matter. A text is cut in one pass over its own bytes, however long it is.
    """
    schema = with_id(docs, ("n", T.LongType()), ("form", T.StringType()), ("prefix_chars", T.LongType()),
                     ("middle_chars", T.LongType()), ("output", T.StringType()))

    def run(batches):
        for piece in pieces(batches):
            rows = [cut(i, text, settings) for i, text in zip(piece.column("doc_id").to_pylist(), texts(piece.column("text")))]
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), *(pa.array(values, kind) for values, kind in zip(zip(*rows), kinds))], schema.names)

    return id_and_text(docs).mapInArrow(run, schema)


def restored(output: Column, form: Column, settings: Settings = Settings()) -> Column:
    """The text that an output of this form was made from.

    Parts hold no mark, and no mark begins within another, so each mark's first place is its own.
    """
    def parted(text: Column, mark: str) -> tuple[Column, Column]:
        before = F.substring_index(text, mark, 1)
        return before, F.substr(text, F.length(before) + F.lit(len(mark) + 1))

    _, rest = parted(output, settings.prefix)
    prefix, rest = parted(rest, settings.suffix)
    suffix, middle = parted(rest, settings.middle)
    psm = F.concat(prefix, middle, suffix)
    _, rest = parted(output, settings.suffix)
    suffix, rest = parted(rest, settings.prefix)
    prefix, middle = parted(rest, settings.middle)
    return F.when(form == PSM, psm).when(form == SPM, F.concat(prefix, middle, suffix)).otherwise(output)
