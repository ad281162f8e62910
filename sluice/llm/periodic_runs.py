"""Periodic runs of words: harmonic-grid candidates, extended exactly by a run-length grammar made by recompression."""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from sluice.llm.common import id_and_text, pieces, with_id
from sluice.llm.recompression import Extensions, compressed, mirrored

#: Words of documents that are searched together.
TOGETHER = 1 << 17
#: Turns in which only the first open candidate of a stretch is extended, before all that are left are.
TURNS = 4


@dataclass(frozen=True)
class Settings:
    """``repeats``: periods that a run has at least. ``least``: words that it has at least."""

    repeats: int = 4
    least: int = 6

    def __post_init__(self):
        if self.repeats < 2 or self.least < 1:
            raise ValueError("a run has two periods at least")


def _grid(words: np.ndarray, ends: np.ndarray, longest: np.ndarray, settings: Settings):
    """Candidates (place, period) in stretches: places on the period's grid whose word comes back ``repeats`` - 1 times at once.

    ``words`` holds documents from the longest to the shortest, each closed by a symbol of its own; ``ends`` are their ends.
    A run with ``repeats`` periods has so many grid places in a row, all with one word; other words of
    the period must come back too, and a few are looked at to leave out most places that begin no run.
    Comparisons add up to n / 1 + n / 2 + ..., about n log n.
    """
    r = settings.repeats
    places, periods = [], []
    top = int(longest[0]) // r if len(longest) else 0
    for q in range(1, top + 1):
        long = int(np.searchsorted(-longest, -r * q, side="right"))  # documents that can hold a run of this period
        reach = int(ends[long - 1])
        grid = words[:reach:q]
        same = grid[1:] == grid[:-1]
        if len(same) < r - 1:
            continue
        enough = same[: len(same) - r + 2]
        for i in range(1, r - 1):
            enough = enough & same[i : len(same) - r + 2 + i]
        found = np.flatnonzero(enough) * q
        for d in {1, q // 2, q - 1, q // 3} - {0}:
            if not len(found):
                break
            if d < q:
                at = found + d
                for i in range(r - 2):
                    found = found[words[at + i * q] == words[at + (i + 1) * q]]
                    at = found + d
        if len(found):
            places.append(found)
            periods.append(np.full(len(found), q, np.int64))
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(places), np.concatenate(periods)


def _extended(words: np.ndarray, places: np.ndarray, periods: np.ndarray, settings: Settings) -> np.ndarray:
    """start, end and period of the runs that the candidates lie in, each with its smallest period."""
    rounds = compressed(words)
    right, left = Extensions(rounds), Extensions(mirrored(rounds))
    n = len(words)
    found = []
    turn = 0
    while len(places):
        new = np.ones(len(places), bool)
        if turn < TURNS:  # candidates of a period stand in order; those that follow within its grid are of one stretch
            new[1:] = (periods[1:] != periods[:-1]) | (places[1:] != places[:-1] + periods[1:])
        x, q = places[new], periods[new]
        ahead = right.find(x, x + q)
        behind = left.find(n - x, n - x - q)
        start, end = x - behind, x + q + ahead
        good = end - start >= np.maximum(settings.least, settings.repeats * q)
        found.append(np.stack((start[good], end[good], q[good])))
        # a stretch's places up to the difference that its first candidate met are in the same run; any other run lies beyond
        beyond = ~new & (places > (x + ahead)[np.cumsum(new) - 1])
        places, periods = places[beyond], periods[beyond]
        turn += 1
    runs = np.concatenate(found, axis=1)
    order = np.lexsort((runs[2], runs[1], runs[0]))
    runs = runs[:, order]
    first = np.ones(runs.shape[1], bool)
    first[1:] = (runs[0, 1:] != runs[0, :-1]) | (runs[1, 1:] != runs[1, :-1])  # with multiples of a period the same stretch comes back
    return runs[:, first]


def runs_of(documents: list[np.ndarray], settings: Settings = Settings()) -> list[np.ndarray]:
    """The runs of each sequence of word numbers: rows of start, length and period, by start and then period.

    All are searched together, on one sequence with a closing symbol of its own after each; only those with candidates get a grammar.
    """
    none = np.zeros((0, 3), np.int64)
    out = [none] * len(documents)
    order = sorted((i for i, d in enumerate(documents) if len(d) >= settings.least), key=lambda i: (-len(documents[i]), i))
    if not order:
        return out
    longest = np.array([len(documents[i]) for i in order], np.int64)
    closing = 1 + max(int(documents[i].max()) for i in order)
    words = np.concatenate([part for k, i in enumerate(order) for part in (documents[i], [closing + k])])
    ends = np.cumsum(longest + 1)
    # grid places past the end must differ from all others
    room = int(longest[0]) + 1
    padded = np.concatenate((words, closing + len(order) + np.arange(room)))
    places, periods = _grid(padded, ends, longest, settings)
    if not len(places):
        return out
    owner = np.searchsorted(ends, places, side="right")
    used = np.unique(owner)
    begins = ends - longest - 1
    # documents with candidates alone, one after the other; candidates of a period stay in order
    length = longest[used] + 1
    moved = np.cumsum(length) - length
    kept = np.concatenate([words[begins[k] : ends[k]] for k in used])
    at = places - begins[owner] + moved[np.searchsorted(used, owner)]
    start, end, period = _extended(kept, at, periods, settings)
    of = np.searchsorted(moved, start, side="right") - 1
    for k, number in enumerate(used):
        lo, hi = np.searchsorted(of, (k, k + 1))
        rows = np.stack((start[lo:hi] - moved[k], end[lo:hi] - start[lo:hi], period[lo:hi]), axis=1)
        out[order[number]] = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    return out


def looped(words: np.ndarray, doc_id) -> np.ndarray:
    """One document in ten, by the CRC-32 of its id, repeats a stretch up to its end: word i >= a becomes word a + (i - a) % p."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return words[np.where(i < a, i, a + (i - a) % p)]


def kept_words(count: int, runs: np.ndarray) -> np.ndarray:
    """Which words stay: those that no run holds after its first period."""
    edge = np.zeros(count + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:-1]) == 0


def periodic_runs(docs: DataFrame, each=None, schema=(), settings: Settings = Settings(), change=None) -> DataFrame:
    """doc_id, n_runs, start, length, period and exponent_milli of every document, and what ``each(runs, collapsed)`` gives.

    Words are separated by blanks and ASCII line marks and numbered from 0. A run is a stretch of words with smallest period
    q, at least ``least`` and ``repeats`` * q long, that neither neighbour extends. The four numbers are those of the longest one (the first,
    then the one of smallest period, of equals), null without runs. ``runs`` has a row of start, length and period for each, by start
    and period; ``collapsed`` is the text of the words that no run holds after its first q, joined by blanks, in UTF-8. Without ``each``
    they are the columns runs and collapsed. ``change(words, doc_id)`` may put other words of the document in place beforehand.

    Whole texts are searched, long ones too: work grows with n log n, memory with n. Null and empty texts have no words and no runs.
    Rows are kept as they are, with null or repeated ids too. An empty table gives an empty result, other columns don't matter.
    """
    if each is None:
        rows = T.ArrayType(T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")]))
        schema = (("runs", rows), ("collapsed", T.StringType()))
    numbers = ("n_runs", "start", "length", "period", "exponent_milli")
    result = with_id(docs, *((name, T.LongType()) for name in numbers), *schema)

    def row(runs: np.ndarray, own: np.ndarray, names: list[bytes]) -> tuple:
        best = (None,) * 4
        if len(runs):
            start, length, period = runs[np.lexsort((runs[:, 2], runs[:, 0], -runs[:, 1]))[0]].tolist()
            best = (start, length, period, 1000 * length // period)
            own = own[kept_words(len(own), runs)]
        collapsed = b" ".join(map(names.__getitem__, own.tolist()))
        more = each(runs, collapsed) if each else (
            [dict(zip(("start", "length", "period"), r)) for r in runs.tolist()], collapsed.decode())
        return (len(runs), *best, *more)

    def batch_of(part: list, kinds, ids: pa.Array) -> pa.RecordBatch:
        index: dict[bytes, int] = {}
        documents = []
        for doc_id, words in part:
            own = np.array([index.setdefault(word, len(index)) for word in words], np.int64)
            documents.append(change(own, doc_id) if change else own)
        names = list(index)
        rows = [row(runs, own, names) for runs, own in zip(runs_of(documents, settings), documents)]
        return pa.RecordBatch.from_arrays([ids, *(pa.array(c, kind) for c, kind in zip(zip(*rows), kinds))], result.names)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = to_arrow_schema(result).types[1:]
        for piece in pieces(batches):
            ids = piece.column("doc_id")
            part: list = []
            first = size = 0
            for i, (doc_id, text) in enumerate(zip(ids.to_pylist(), piece.column("text").cast(pa.binary()).to_pylist())):
                part.append((doc_id, (text or b"").split()))
                size += len(part[-1][1])
                if size >= TOGETHER or i == piece.num_rows - 1:
                    yield batch_of(part, kinds, ids.slice(first, len(part)))
                    part, first, size = [], i + 1, 0

    return id_and_text(docs).mapInArrow(run, result)
