"""Language identification: multinomial naive Bayes over hashed character n-grams, counted and scored in sparse batches."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from sluice.llm.common import id_and_text, pieces, texts, with_id

UNKNOWN = "und"
FOLDS, HELD_OUT = 4, 2
#: Buckets that n-grams are hashed into, unless there are so many languages that the matrix would pass ``ENTRIES``.
BUCKETS = 1 << 16
#: Numbers of the matrix of languages and buckets, at most; the driver and each worker hold 8 bytes for each.
ENTRIES = 1 << 22
#: Languages at most, and bytes of all their names; a column with more isn't one of languages and is refused.
MOST_LANGUAGES, NAME_BYTES = 1 << 14, 1 << 22
#: Log probabilities are whole multiples of 2 ** -SHIFT, so that sums don't depend on their order.
SHIFT = 24
#: Ranges of buckets that counts are added up in, and shares of the tasks that are added up first.
RANGES, SALTS = 64, 64
#: Gathered numbers at a time.
GATHERED = 1 << 21
_BLANK = np.array([c if chr(c).isalpha() else 32 for c in range(128)], np.uint32)
_ODD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    """``orders``: lengths of the n-grams. ``smoothing``: count that every bucket of a language begins with."""

    orders: tuple[int, ...] = (1, 2, 3, 4)
    smoothing: float = 0.5


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves the held-out remainder: such rows are never learned from. A null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(True))


def ngrams(values: list[str], orders: tuple[int, ...], buckets: int):
    """The sparse rows of some texts, one order after the other: number of the text and bucket of each n-gram, texts in order.

    Texts are lower-cased, each run of ASCII characters that are no letters counts as a blank, and a blank stands at both ends.
    """
    coded = [f" {text.lower()} ".encode("utf-32-le") for text in values]
    points = np.frombuffer(b"".join(coded), "<u4")
    text = np.repeat(np.arange(len(coded)), [len(c) // 4 for c in coded])
    points = np.where(points < 128, _BLANK[np.minimum(points, 127)], points)
    keep = np.ones(len(points), bool)
    keep[1:] = (points[1:] != 32) | (points[:-1] != 32) | (text[1:] != text[:-1])
    points, text = points[keep].astype(np.uint64), text[keep]
    shift = np.uint64(64 - (buckets.bit_length() - 1))
    with np.errstate(over="ignore"):
        value = np.zeros(len(points), np.uint64)
        for n in range(1, max(orders, default=0) + 1):
            count = len(points) - n + 1
            if count <= 0:
                break
            value = value[:count] + points[n - 1 :]
            value += np.uint64(1)
            value *= _ODD
            value ^= value >> np.uint64(29)
            if n in orders:
                whole = text[:count] == text[n - 1 :]
                found = (value[whole] * _ODD) >> shift if buckets > 1 else np.zeros(int(whole.sum()))
                yield text[:count][whole], found.astype(np.int64)


class Model:
    """``languages`` in ascending order; ``table`` has a row of fixed-point log probabilities for each bucket, ``prior`` one in all."""

    def __init__(self, languages: list[str], prior: np.ndarray, table: np.ndarray):
        self.languages, self.prior, self.table = languages, prior, table

    def sums(self, rows, count: int) -> np.ndarray:
        """Fixed-point log probability of each text and language: sparse rows times the matrix, in blocks."""
        total = np.repeat(self.prior[None, :], count, axis=0)
        step = max(1, GATHERED // len(self.languages))
        for owner, bucket in rows:
            for at in range(0, len(owner), step):
                own = owner[at : at + step]
                first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
                total[own[first]] += np.add.reduceat(self.table.take(bucket[at : at + step], axis=0), first, axis=0)
        return total

    def predict(self, values: list[str], orders: tuple[int, ...]) -> tuple[list[str], np.ndarray]:
        """Language and its posterior probability for each text. Equal probabilities go to the smallest name."""
        if not self.languages:
            return [UNKNOWN] * len(values), np.zeros(len(values))
        total = self.sums(ngrams(values, orders, len(self.table)), len(values))
        best = total.argmax(1)
        rest = (total - total[np.arange(len(values)), best][:, None]) / float(1 << SHIFT)
        score = 1 / np.exp(rest).sum(1)
        letters = np.array([any(map(str.isalpha, text)) for text in values], bool)
        names = [self.languages[i] if known else UNKNOWN for i, known in zip(best.tolist(), letters.tolist())]
        return names, np.where(letters, score, 0.0)


def _languages(known: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and their numbers of documents."""
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    size = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("lang")), F.lit(0))).first()
    if size[0] > MOST_LANGUAGES or size[1] > NAME_BYTES:
        raise ValueError(f"{size[0]} languages of {size[1]} bytes: at most {MOST_LANGUAGES} and {NAME_BYTES} are supported")
    rows = sorted((r.lang, r.n) for r in counts.collect())
    return [lang for lang, _ in rows], np.array([n for _, n in rows], np.float64)


def _counted(known: DataFrame, languages: list[str], buckets: int, orders: tuple[int, ...]) -> np.ndarray:
    """n-grams of every learned text, counted by language and bucket.

    A task adds up its own texts and hands on one row for each range of buckets, whatever its size; rows are added up by
    shares of the tasks first, then in all.
    """
    number = {lang: i for i, lang in enumerate(languages)}
    ranges = min(RANGES, buckets)
    shape = (len(languages), buckets)

    def count(batches):
        counts = np.zeros(shape[0] * shape[1], np.int64)
        any_text = False
        for piece in pieces(batches):
            own = np.array([number[lang] for lang in piece.column("lang").to_pylist()], np.int64)
            for owner, bucket in ngrams(texts(piece.column("text")), orders, buckets):
                place = own.take(owner) * buckets + bucket
                any_text = any_text or len(place) > 0
                if len(place) > len(counts) // 8:
                    counts += np.bincount(place, minlength=len(counts))
                else:
                    place, n = np.unique(place, return_counts=True)
                    counts[place] += n
        if any_text:
            from pyspark import TaskContext

            parts = np.split(counts.reshape(shape), ranges, axis=1)
            salt = TaskContext.get().partitionId() % SALTS
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(ranges), pa.int32()), pa.array([salt] * ranges, pa.int32()),
                 pa.array([np.ascontiguousarray(part).tobytes() for part in parts], pa.binary())], ["part", "salt", "counts"])

    def add(batches):
        sums: dict = {}
        for batch in batches:
            for part, salt, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                found = np.frombuffer(data, np.int64)
                sums[part, salt] = sums[part, salt] + found if (part, salt) in sums else found
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array([part for part, _ in sums], pa.int32()), pa.array([salt for _, salt in sums], pa.int32()),
                 pa.array([found.tobytes() for found in sums.values()], pa.binary())], ["part", "salt", "counts"])

    schema = "part int, salt int, counts binary"
    found = known.select("lang", "text").mapInArrow(count, schema).repartition("part", "salt").mapInArrow(add, schema)
    found = found.withColumn("salt", F.lit(0)).repartition("part").mapInArrow(add, schema)
    total = np.zeros(shape, np.int64)
    width = buckets // ranges
    for row in found.collect():  # as many bytes as the matrix has
        total[:, row.part * width : (row.part + 1) * width] = np.frombuffer(row.counts, np.int64).reshape(shape[0], width)
    return total


def fit(docs: DataFrame, settings: Settings = Settings()) -> Model:
    """A model of all documents that may be learned from and have text and language."""
    known = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"), "doc_id").filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))).select("lang", "text")
    languages, documents = _languages(known)
    if not languages:
        return Model([], np.zeros(0, np.int64), np.zeros((1, 0), np.int64))
    buckets = min(BUCKETS, 1 << ((ENTRIES // len(languages)).bit_length() - 1))
    counts = _counted(known, languages, buckets, settings.orders).astype(np.float64) + settings.smoothing
    table = np.log(counts / counts.sum(1, keepdims=True)).T
    prior = np.log(documents / documents.sum())
    return Model(languages, np.rint(prior * (1 << SHIFT)).astype(np.int64), np.rint(table * (1 << SHIFT)).astype(np.int64))


def language_id(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document.

    The model counts the character n-grams of every document with text and language whose crc32(doc_id) mod 4 isn't 2, by
    language and hashed bucket; its matrix of log probabilities, of bounded size, is broadcast. Whole texts are scored. ``score`` is the
    posterior probability of ``lang_pred``. Neither lang, source nor doc_id plays a part in a prediction.

    Texts that are null or have no letter get ``und`` and 0, and so does everything if there is nothing to learn from. Rows are kept as
    they are, with null or repeated ids too; a null id counts as held out. An empty table gives an empty result, other columns don't matter.
    """
    model = fit(docs, settings)
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.prior, model.table))
    rows = id_and_text(docs).withColumn("held_out", held_out(F.col("doc_id")))

    def score(batches):
        model = Model(*shared.value)
        for piece in pieces(batches):
            names, scores = model.predict(texts(piece.column("text")), settings.orders)
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("held_out"), pa.array(names, pa.string()), pa.array(scores)],
                ["doc_id", "held_out", "lang_pred", "score"])

    return rows.mapInArrow(score, with_id(
        docs, ("held_out", T.BooleanType()), ("lang_pred", T.StringType()), ("score", T.DoubleType())))
