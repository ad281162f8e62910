"""Exact deduplication that hot groups of copies can't unbalance."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from sluice.llm.common import pieces
from sluice.sources.workspace import materialize

WHITE = r"[\x20\x09-\x0D]+"
WHITE_BYTES = b" \t\n\x0b\x0c\r"
#: Rows of a task that are compared before any shuffle.
TOGETHER = 4096
#: Parts that a group of copies is merged in before its winners are combined.
SALTS = 256


def content_of(text: Column) -> Column:
    """The text without blanks and ASCII line and page marks; null counts as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), WHITE, "")


def _rank(n_chars: Column, doc_id: Column) -> Column:
    """Smallest for the row that stays: most code points, then smallest id, null ids last."""
    return F.struct((-n_chars).alias("less"), doc_id.isNull().alias("no_id"), doc_id.alias("doc_id"))


def _keyed(docs: DataFrame, digest, salts: int) -> DataFrame:
    rows = docs.select(
        F.col("doc_id"), F.coalesce(F.length(F.col("text").cast("string")), F.lit(0)).alias("n_chars"),
        content_of(F.col("text")).alias("content"))
    # salts follow from the row itself, so that a task that runs again deals out the same ones
    return rows.select("*", digest(F.col("content")).alias("digest"),
                       F.pmod(F.xxhash64("doc_id", "n_chars"), F.lit(salts)).cast("int").alias("salt"))


def sha256(content: Column) -> Column:
    return F.sha2(content, 256)


def winners(docs: DataFrame, salts: int = SALTS, digest=sha256) -> DataFrame:
    """digest, check, best, n of every group of equal contents: the row that stays and the number of rows.

    Copies are dropped in each task first (the partial aggregation), then among the rows of one salt, then
    among the winners of the salts. Every stage groups by the content itself, not only by its digest.
    """
    salted = _keyed(docs, digest, salts).groupBy("digest", "content", "salt").agg(
        F.min(_rank(F.col("n_chars"), F.col("doc_id"))).alias("best"), F.count(F.lit(1)).alias("n"))
    whole = salted.repartition("digest").groupBy("digest", "content").agg(
        F.min("best").alias("best"), F.sum("n").alias("n"))
    return whole.select("digest", F.xxhash64("content").alias("check"), "best", "n")


def exact_dedup(docs: DataFrame, salts: int = SALTS, digest=sha256) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row of ``docs``, which has doc_id and text.

    Rows are equal if their texts are, after blanks, tabs, line feeds and their like are deleted; null counts
    as empty. Of equal rows the one with the most code points in its original text stays, then the smallest
    id, null ids last. Of rows that repeat both id and length exactly one is kept. Empty texts form one
    group. Extra columns don't matter; an empty table gives an empty result.

    Texts go through two shuffles, as ``winners`` tells. Members find their group by digest, a second hash of
    the content and their salt, so a hot group is spread over ``salts`` keys; nothing is broadcast by force.
    """
    keyed = _keyed(docs, digest, salts)
    members = materialize(
        keyed.select("doc_id", "n_chars", "digest", F.xxhash64("content").alias("check"), "salt")
        .groupBy("doc_id", "n_chars", "digest", "check", "salt").agg(F.count(F.lit(1)).alias("repeats")), "members")
    found = winners(docs, salts, digest)
    # a digest with two contents under the same second hash can't be told apart by members; it would be an error
    found = found.groupBy("digest", "check").agg(
        F.first("best").alias("best"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("contents"))
    found = found.withColumn("n", F.when(F.col("contents") == 1, F.col("n")).otherwise(
        F.raise_error(F.lit("two contents with one digest and check")).cast("bigint"))).drop("contents")
    places = members.select("digest", "check", "salt").distinct()
    salted = places.join(found, ["digest", "check"]).select("digest", "check", "salt", "best", "n")
    joined = members.join(salted, ["digest", "check", "salt"])
    own = _rank(F.col("n_chars"), F.col("doc_id")) == F.col("best")
    return joined.select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), F.col("n").alias("group_size"), own.alias("own"), "digest",
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("repeats"))).alias("copy"),
    ).select("doc_id", "keep_id", "group_size", (F.col("own") & (F.col("copy") == 1)).alias("kept"),
             F.col("digest").alias("text_sha256"))


def _local_copies(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` without those that repeat the content of a better one among the rows around them in their task."""
    def drop(batches):
        for piece in pieces(batches, TOGETHER):
            data = pc.fill_null(piece.column("text").cast(pa.string()), "")
            ids = piece.column("doc_id").to_pylist()
            best: dict = {}
            for i, (text, n, doc_id) in enumerate(zip(data.cast(pa.binary()).to_pylist(), pc.utf8_length(data).to_pylist(), ids)):
                rank = (-n, doc_id is None, doc_id if doc_id is not None else 0, i)
                content = text.translate(None, WHITE_BYTES)
                if content not in best or rank < best[content]:
                    best[content] = rank
            yield piece.take(pa.array(sorted(rank[-1] for rank in best.values())))

    return docs.mapInArrow(drop, docs.schema)


def drop_exact_copies(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; one row of those that repeat id and length.

    The rows themselves go through the three stages: copies are dropped in each task, then among the rows of a
    digest and salt, then among those of a digest. Contents are compared in full each time, but not shuffled beside the rows.
    """
    rank = _rank(F.coalesce(F.length(F.col("_row.text").cast("string")), F.lit(0)), F.col("_row.doc_id"))
    rows = _local_copies(docs).select(F.struct("*").alias("_row"))
    rows = rows.withColumn("_digest", sha256(content_of(F.col("_row.text")))).withColumn(
        "_salt", F.pmod(F.xxhash64("_row.doc_id"), F.lit(salts)).cast("int"))
    for keys in (("_digest", "_salt"), ("_digest",)):
        rows = rows.repartition(*keys).withColumn("_content", content_of(F.col("_row.text")))
        first = Window.partitionBy(*keys, "_content").orderBy(rank)
        rows = rows.withColumn("_place", F.row_number().over(first)).filter("_place = 1").drop("_content", "_place")
    return rows.select("_row.*")
