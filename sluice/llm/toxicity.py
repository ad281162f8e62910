"""Toxicity by a linear model whose scores must not change when identity terms are swapped."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from sluice.llm.common import PIECE_ROWS, id_and_text, kept, pieces, texts, with_id
from sluice.llm.labelled import FITTED, crc, held_out, sampled
from sluice.llm.token_units import UNITS, Memo

# Terms that name groups of people; a term may stand for any other of its row.
IDENTITY_TERMS = (
    ("woman", "man"), ("women", "men"), ("girl", "boy"), ("girls", "boys"), ("female", "male"), ("mother", "father"),
    ("gay", "straight", "lesbian", "bisexual"), ("transgender", "cisgender"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "african", "european"), ("immigrant", "citizen", "refugee", "foreigner"),
    ("immigrants", "citizens", "refugees", "foreigners"), ("old", "young"), ("deaf", "blind", "disabled"),
    ("frau", "mann"), ("frauen", "männer"), ("femme", "homme"), ("femmes", "hommes"), ("mujer", "hombre"), ("mujeres", "hombres"),
)

BITS = 20
_BLANK = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


@dataclass(frozen=True)
class Settings:
    """``most``: labelled rows to fit on. ``swap``: weight of the squared score changes under swaps. ``l1``: pull of weights to zero.
    ``least``: documents of the sample that a feature must be in."""

    most: int = FITTED
    swap: float = 1.0
    l1: float = 5e-4
    least: int = 5
    epochs: int = 12
    batch: int = 128
    rate: float = 0.5


def distinct_words(text: str) -> set[bytes]:
    return set(text.lower().encode().translate(_BLANK).split())


def features(word: bytes) -> tuple[int, int, int]:
    """Places of a word and of its first 4 and 5 characters, by which inflected forms share weight."""
    start = word.decode(errors="replace")
    mask = (1 << BITS) - 1
    return crc(word) & mask, crc(b"4" + start[:4].encode()) & mask, crc(b"5" + start[:5].encode()) & mask


def swapped(text: str, terms) -> list[tuple[set[bytes], set[bytes]]]:
    """For each sentence with an identity term: the words that it loses and wins when its terms are swapped for the next of their row."""
    other = {}
    for row in terms:
        for a, b in zip(row, (*row[1:], row[0])):
            other[a.encode()] = b.encode()
    found = []
    for sentence in text.lower().replace("!", ".").replace("?", ".").replace("\n", ".").split("."):
        words = set(sentence.encode().translate(_BLANK).split())
        lost = words & other.keys()
        if lost:
            won = {other[word] for word in lost}
            found.append((lost - won, won - words))
    return found


def _numbers(words) -> list[int]:
    return [n for word in words for n in features(word)]


def _examples(rows: DataFrame, terms):
    """Places of the words, label and swaps of the sampled documents."""
    def read(batches):
        for piece in pieces(batches):
            out = []
            for text, y in zip(texts(piece.column("text")), piece.column("y").to_pylist()):
                swaps = swapped(text, terms)
                out.append({"y": y, "places": _numbers(sorted(distinct_words(text))),
                            "lost": [_numbers(sorted(a)) for a, _ in swaps], "won": [_numbers(sorted(b)) for _, b in swaps]})
            yield pa.RecordBatch.from_pylist(out, pa.schema([
                ("y", pa.int32()), ("places", pa.list_(pa.int32())), ("lost", pa.list_(pa.list_(pa.int32()))),
                ("won", pa.list_(pa.list_(pa.int32())))]))

    return rows.mapInArrow(read, "y int, places array<int>, lost array<array<int>>, won array<array<int>>").toArrow()


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All elements of a list column, and where each list starts; with the end."""
    column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    return column.flatten().to_numpy(), np.concatenate(([0], np.cumsum(lengths)))


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0.0], np.cumsum(values)))
    return total[starts[1:]] - total[starts[:-1]]


class Model:
    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    def of_words(self, words) -> list[float]:
        return [float(sum(self.weights[n] for n in features(word))) for word in words]


def fit(examples: pa.Table, terms=IDENTITY_TERMS, settings: Settings = Settings()) -> Model:
    """Logistic loss plus ``swap`` times the mean squared change of the score (the logit) under swaps of identity terms.

    Swaps are those in the labelled sentences and, so that no term goes unseen, each term against the next of its row. Proximal
    Adagrad with an L1 pull. Without examples of both labels the score is the share of toxic ones, below 0.5, as no text then differs from others.
    """
    y = examples.column("y").to_numpy().astype(np.float64)
    weights = np.zeros(1 << BITS, np.float32)
    if not len(y) or y.min() == y.max():
        rate = min(0.49, (y.sum() + 0.5) / (len(y) + 1))
        return Model(weights, float(np.log(rate / (1 - rate))))
    places, starts = _flat(examples.column("places"))
    pairs = [(lost, won) for row in zip(examples.column("lost").to_pylist(), examples.column("won").to_pylist()) for lost, won in zip(*row)]
    pairs += [(_numbers([a.encode()]), _numbers([b.encode()])) for row in terms for a, b in zip(row, (*row[1:], row[0]))]
    common = np.bincount(places, minlength=1 << BITS) >= settings.least
    common[[n for lost, won in pairs for n in (*lost, *won)]] = True
    number = np.cumsum(common) - 1
    used = np.flatnonzero(common)
    keep = common[places]
    starts = np.concatenate(([0], np.cumsum(keep)))[starts]
    places = number[places[keep]]
    swap_places = number[[n for lost, won in pairs for n in (*lost, *won)]]
    swap_signs = np.array([s for lost, won in pairs for s in (*[-1.0] * len(lost), *[1.0] * len(won))])
    swap_starts = np.cumsum([0, *(len(lost) + len(won) for lost, won in pairs)])

    w, bias, seen, seen_bias = np.zeros(len(used)), float(np.log(y.mean() / (1 - y.mean()))), np.full(len(used), 1e-3), 1e-3
    random = np.random.default_rng(0)
    for _ in range(settings.epochs):
        order = random.permutation(len(y))
        for at in range(0, len(y), settings.batch):
            rows = order[at : at + settings.batch]
            lengths = starts[rows + 1] - starts[rows]
            own = places[np.repeat(starts[rows] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())]
            ends = np.concatenate(([0], np.cumsum(lengths)))
            error = 1 / (1 + np.exp(-np.clip(_sums(w[own], ends) + bias, -30, 30))) - y[rows]
            g = np.bincount(own, np.repeat(error, lengths), len(w)) / len(rows)
            change = _sums(w[swap_places] * swap_signs, swap_starts)
            g += settings.swap * np.bincount(
                swap_places, swap_signs * np.repeat(change, np.diff(swap_starts)), len(w)) * 2 / len(pairs)
            seen += g * g
            step = settings.rate / np.sqrt(seen)
            w -= step * g
            w = np.sign(w) * np.maximum(np.abs(w) - step * settings.l1, 0)
            seen_bias += error.mean() ** 2
            bias -= settings.rate / np.sqrt(seen_bias) * error.mean()
    weights[used] = w
    return Model(weights, float(bias))


def toxicity(docs: DataFrame, labels: DataFrame, terms=IDENTITY_TERMS, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from 0.5 on) of every document.

    The model sees whole texts as sets of words and of their first letters, never labels, lang, source or id. It is
    fitted on at most ``most`` labelled documents (the first by a hash of the id, 64 MB of text at most) whose crc32(doc_id) mod 5 isn't 0,
    labels 0 and 1 only. Scores are probabilities; null and empty texts get the one of no words.

    Rows are kept as they are, with null or repeated ids too; a null id counts as held out. Empty labels
    give every document the score 0.49, an empty table of documents gives an empty result. Other columns don't matter.
    """
    with sampled(docs, labels, "toxic", settings.most) as rows:
        model = fit(_examples(rows, terms), terms, settings)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))
    rows = id_and_text(docs).withColumn("held_out", held_out(F.col("doc_id")))

    def score(batches):
        weights, bias = shared.value
        memo = kept(("toxicity", weights[:: 1 << 8].tobytes(), bias), lambda: Memo(Model(weights, bias).of_words, UNITS))
        for piece in pieces(batches):
            words = [distinct_words(text) for text in texts(piece.column("text"))]
            known = memo.know(words)
            logit = np.array([sum(map(known.__getitem__, own)) for own in words], np.float64) + bias
            scores = 1 / (1 + np.exp(-np.clip(logit, -500, 500)))
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("held_out"), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

    return rows.mapInArrow(score, with_id(
        docs, ("held_out", T.BooleanType()), ("score", T.DoubleType()), ("predicted", T.IntegerType())))


def drop_toxic(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that aren't predicted toxic, with all their columns."""
    scored = F.struct("*").alias("_doc")
    whole = docs.select(scored, F.col("doc_id"), F.col("text"))
    return whole.filter(~_is_toxic(whole, docs, labels, **settings)).select("_doc.*")


def _is_toxic(whole: DataFrame, docs: DataFrame, labels: DataFrame, terms=IDENTITY_TERMS, settings: Settings = Settings()):
    with sampled(docs, labels, "toxic", settings.most) as rows:
        model = fit(_examples(rows, terms), terms, settings)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    @F.arrow_udf("boolean")
    def toxic(column: pa.Array) -> pa.Array:
        weights, bias = shared.value
        memo = kept(("toxicity", weights[:: 1 << 8].tobytes(), bias), lambda: Memo(Model(weights, bias).of_words, UNITS))
        found: list[bool] = []
        for at in range(0, len(column), PIECE_ROWS):  # so that the words of a whole batch don't add up
            words = [distinct_words(text) for text in texts(column.slice(at, PIECE_ROWS))]
            known = memo.know(words)
            found += [bool(sum(map(known.__getitem__, own)) + bias >= 0) for own in words]
        return pa.array(found, pa.bool_())

    return toxic(F.col("text").cast("string"))
