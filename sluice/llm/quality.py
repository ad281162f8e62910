"""Quality by a factorisation machine (Rendle, 2010) over hashed words, structure and metadata of a text."""

from __future__ import annotations

import string
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from sluice.llm.common import id_and_text, pieces, texts, with_id
from sluice.llm.labelled import FITTED, crc, held_out, sampled

#: Places of hashed words, structure statistics in steps, and metadata in steps.
WORDS = 4096
STEPS = 12
STATISTICS = ("letters", "capitals", "digits", "marks", "bars", "repeated lines", "distinct words", "most frequent word",
              "word length", "repeated marks", "neighbouring repeats")
METADATA = ("bytes", "lines", "words")
WIDTH = WORDS + STEPS * (len(STATISTICS) + len(METADATA))

_UPPER, _LETTERS = string.ascii_uppercase.encode(), string.ascii_letters.encode() + bytes(range(128, 256))
_DIGITS, _MARKS = string.digits.encode(), string.punctuation.encode()
_DOUBLED = tuple((mark * 2).encode() for mark in "!?#$%&*=")


@dataclass(frozen=True)
class Settings:
    """``most``: labelled rows to fit on. ``rank``: length of a feature's vector for pairwise interactions."""

    most: int = FITTED
    rank: int = 8
    epochs: int = 8
    batch: int = 256
    rate: float = 0.02
    l2: float = 1e-5


def _share(data: bytes, kind: bytes) -> float:
    return (len(data) - len(data.translate(None, kind))) / len(data)


def measures(data: bytes) -> tuple[list[bytes], list[float], list[float]]:
    """Distinct words, statistics of structure (shares from 0 to 1) and metadata (sizes) of a text."""
    words = data.lower().split()
    counts = Counter(words)
    if not words:
        return [], [0.0] * len(STATISTICS), [float(len(data)), float(data.count(b"\n")), 0.0]
    lines = data.split(b"\n")
    repeats = sum(map(bytes.__eq__, words, words[1:]))
    statistics = [
        _share(data, _LETTERS), _share(data, _UPPER), _share(data, _DIGITS), _share(data, _MARKS), _share(data, b"|\t"),
        1 - len(set(lines)) / len(lines), len(counts) / len(words), max(counts.values()) / len(words),
        min(1.0, len(data) / len(words) / 20), min(1.0, sum(map(data.count, _DOUBLED)) / len(words)), repeats / len(words)]
    return list(counts), statistics, [float(len(data)), float(len(lines)), float(len(words))]


def features(data: bytes) -> tuple[list[int], list[float]]:
    """Places and values of a text's features: words of equal weight that sum to a square of 1, and a one for each measure's step."""
    words, statistics, metadata = measures(data)
    places = sorted({crc(word) % WORDS for word in words})
    values = [max(1, len(places)) ** -0.5] * len(places)
    at = WORDS
    for share in statistics:  # finer towards 0
        places.append(at + min(STEPS - 1, int(share ** 0.5 * STEPS)))
        at += STEPS
    for size in metadata:
        places.append(at + min(STEPS - 1, int(np.log2(size + 1) * 0.6)))
        at += STEPS
    return places, values + [1.0] * (len(STATISTICS) + len(METADATA))


class Machine:
    """w0 + sum of w_i x_i + the pairwise interactions, which take linear time as half of (sum of v_i x_i)^2 - sum of (v_i x_i)^2."""

    def __init__(self, bias: float, weights: np.ndarray, vectors: np.ndarray):
        self.bias, self.weights, self.vectors = bias, weights, vectors

    def scores(self, rows: list[tuple[list[int], list[float]]]) -> np.ndarray:
        lengths = np.array([len(places) for places, _ in rows])
        places = np.concatenate([np.array(p, np.int64) for p, _ in rows])
        values = np.concatenate([np.array(v) for _, v in rows])
        starts = np.cumsum(lengths) - lengths  # every text has the features of its measures
        scaled = self.vectors[places] * values[:, None]
        total = np.add.reduceat(scaled, starts, axis=0)
        squares = np.add.reduceat((scaled * scaled).sum(1), starts)
        linear = np.add.reduceat(self.weights[places] * values, starts)
        logit = self.bias + linear + 0.5 * ((total * total).sum(1) - squares)
        return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, settings: Settings = Settings()) -> Machine:
    """Logistic loss by Adam over small dense batches. Without examples of both labels the score is the share of good ones."""
    random = np.random.default_rng(0)
    if not len(y) or y.min() == y.max():
        rate = (y.sum() + 0.5) / (len(y) + 1)
        return Machine(float(np.log(rate / (1 - rate))), np.zeros(WIDTH), np.zeros((WIDTH, settings.rank)))
    w, v = np.zeros(WIDTH), random.normal(0, 0.02, (WIDTH, settings.rank))
    bias = np.array([np.log(y.mean() / (1 - y.mean()))])
    parameters = [bias, w, v]
    first, second = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]
    turn = 0
    for _ in range(settings.epochs):
        order = random.permutation(len(y))
        for at in range(0, len(y), settings.batch):
            chosen = order[at : at + settings.batch]
            x = np.zeros((len(chosen), WIDTH))
            for i, row in enumerate(chosen):
                x[i, rows[row][0]] = rows[row][1]
            total = x @ v
            logit = bias[0] + x @ w + 0.5 * ((total * total).sum(1) - (x * x) @ (v * v).sum(1))
            error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y[chosen]) / len(chosen)
            gradients = [np.array([error.sum()]), x.T @ error + settings.l2 * w,
                         x.T @ (error[:, None] * total) - ((x * x).T @ error)[:, None] * v + settings.l2 * v]
            turn += 1
            for p, g, m, s in zip(parameters, gradients, first, second):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                p -= settings.rate * (m / (1 - 0.9 ** turn)) / (np.sqrt(s / (1 - 0.999 ** turn)) + 1e-8)
    return Machine(float(bias[0]), w, v)


def _examples(rows: DataFrame):
    def read(batches):
        for piece in pieces(batches):
            found = [features(text.encode()) for text in texts(piece.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [piece.column("y"), pa.array([p for p, _ in found], pa.list_(pa.int32())),
                 pa.array([v for _, v in found], pa.list_(pa.float32()))], ["y", "places", "xs"])

    return rows.mapInArrow(read, "y int, places array<int>, xs array<float>").toArrow()


def quality(docs: DataFrame, labels: DataFrame, least: float = 0.3, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from ``least`` on) of every document.

    Features are the whole text's hashed distinct words, statistics of its structure and its sizes; never labels,
    lang, source or id. The machine is fitted on at most ``most`` labelled documents (the first by a hash of the id, 64 MB of text at most)
    whose crc32(doc_id) mod 5 isn't 0, labels 0 and 1 only. Scores are probabilities; null and empty texts get
    that of no words and size 0.

    Rows are kept as they are, with null or repeated ids too; a null id counts as held out. Empty labels give every
    document the score 0.5, an empty table of documents gives an empty result. Other columns don't matter.
    """
    with sampled(docs, labels, "quality", settings.most) as rows:
        table = _examples(rows)
    places, values = (table.column(name).combine_chunks() for name in ("places", "xs"))
    ends, places, values = places.offsets.to_numpy(), places.flatten().to_numpy(), values.flatten().to_numpy()
    rows = [(places[a - ends[0] : b - ends[0]], values[a - ends[0] : b - ends[0]]) for a, b in zip(ends[:-1], ends[1:])]
    machine = fit(rows, table.column("y").to_numpy().astype(np.float64), settings)
    shared = docs.sparkSession.sparkContext.broadcast((machine.bias, machine.weights, machine.vectors))

    def score(batches):
        machine = Machine(*shared.value)
        for piece in pieces(batches):
            scores = machine.scores([features(text.encode()) for text in texts(piece.column("text"))])
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("held_out"), pa.array(scores), pa.array((scores >= least).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

    found = id_and_text(docs).withColumn("held_out", held_out(F.col("doc_id")))
    return found.mapInArrow(score, with_id(
        docs, ("held_out", T.BooleanType()), ("score", T.DoubleType()), ("predicted", T.IntegerType())))
