"""Mixing sources to target weights by weighted sampling without replacement (Efraimidis and Spirakis, 2006)."""

from __future__ import annotations

import string

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from sluice.operators.sequence import add_sequence
from sluice.sources.workspace import materialize, scratch, write_table

#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (5, 2, 1)
#: Key ranges in which the documents of a source are summed at a time; the one where its target ends is parted again.
BUCKETS = 4096
#: Rows of a source that are sorted in one task; a range with more is parted again.
SORTED = 65_536
#: Width below which a range isn't parted: its keys are equal, or differ by rounding.
NARROW = 1e-15
MARKS = (string.punctuation + string.digits).encode()


@F.arrow_udf(T.StructType([T.StructField(name, T.LongType()) for name in ("size", "bytes", "plain")]))
def measured(text: pa.Array) -> pa.Array:
    """Words between blanks, UTF-8 bytes, and bytes that are neither ASCII marks nor digits; null counts as empty."""
    found = [(len(b.split()), len(b), len(b.translate(None, MARKS)))
             for b in (value.as_buffer().to_pybytes() if value.is_valid else b"" for value in text)]
    return pa.StructArray.from_arrays(
        [pa.array([row[i] for row in found], pa.int64()) for i in range(3)], ["size", "bytes", "plain"])


def plain_share(m: Column) -> Column:
    """The default quality weight: the squared share of bytes that are neither marks nor digits, above 0 and up to 1."""
    share = (m["plain"] + 1).cast("double") / (m["bytes"] + 1).cast("double")
    return share * share


def _keyed(docs: DataFrame, quality, seed: str) -> DataFrame:
    """Each row with its size and its exponential key: the rate is the weight, so a heavy document tends to come early."""
    digits = F.substring(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(seed))), 1, 13)
    u = (F.conv(digits, 16, 10).cast("bigint").cast("double") + 1.0) / float(1 << 52)
    rows = docs.select(F.struct("*").alias("_row"), measured(F.col("text").cast("string")).alias("m"), u.alias("u"))
    rows = rows.select("_row", F.col("m.size").alias("size"), (-F.log("u") / quality(F.col("m"))).alias("key"))
    return rows.withColumn("x", F.col("key") / (1.0 + F.col("key")))  # in the order of the keys, from 0 up to 1


def _bucket(low: Column, width: Column) -> Column:
    """The part of a range in which x lies."""
    return F.greatest(F.lit(0), F.least(F.floor((F.col("x") - low) / width * BUCKETS), F.lit(BUCKETS - 1))).cast("int")


def _side(cuts: Column, turns: int) -> Column:
    """-1 for x before the range where its source's target ends, 1 behind it, 0 in it; ``cuts`` has a source's ranges, each in the last."""
    side = F.lit(0)
    for turn in reversed(range(turns)):
        cut = F.get(cuts, F.lit(turn))
        bucket = _bucket(cut["low"], cut["width"])
        side = F.when(cut.isNull(), 0).when(bucket < cut["edge"], -1).when(bucket > cut["edge"], 1).otherwise(side)
    return side


def _parted(sums: DataFrame, plan: DataFrame) -> DataFrame:
    """The plan with the bucket where each source's target ends: ``sums`` has the sizes and rows of buckets of the range ``low``, ``width``."""
    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ends = sums.withColumn("end", F.sum("size").over(upto)).withColumn("start", F.col("end") - F.col("size"))
    edge = (
        ends.join(plan.select("name", "rest", "base"), F.col("source").eqNullSafe(F.col("name")))
        .filter((F.col("base") + F.col("start") < F.col("rest")) & (F.col("rest") <= F.col("base") + F.col("end")))
        .groupBy(F.col("name").alias("of")).agg(F.min_by(F.struct("bucket", "start", "rows"), "bucket").alias("found"))
    )
    cut = F.struct("low", "width", F.col("found.bucket").alias("edge"))
    done = F.col("found").isNull()
    return plan.join(edge, F.col("name").eqNullSafe(F.col("of")), "left").select(
        "name", "source_size", "target", "epochs", "rest",
        F.when(done, F.col("cuts")).otherwise(F.concat("cuts", F.array(cut))).alias("cuts"),
        F.when(done, F.col("base")).otherwise(F.col("base") + F.col("found.start")).alias("base"),
        F.when(done, F.col("low")).otherwise(F.col("low") + F.col("width") * F.col("found.bucket") / BUCKETS).alias("low"),
        F.when(done, F.col("width")).otherwise(F.col("width") / BUCKETS).alias("width"),
        F.when(done, F.lit(0)).otherwise(F.col("found.rows")).cast("bigint").alias("rows"))


def _targets(sums: DataFrame, ratio: float, most: float, weights, folder: str) -> DataFrame:
    """source, source_size and target of every source; ``sums`` has a row for each.

    All sources share by weight; those whose share passes their limit get the limit and leave the rest to
    the others, until no share is above. Each turn reads one row of sums.
    """
    placed = add_sequence(sums.withColumn("no_name", F.col("source").isNull()), "place", start=0, maximum=None,
                          order_by=("no_name", "source"), folder=folder)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    rows = placed.select("source", "source_size", weight.cast("double").alias("weight"),
                         (F.col("source_size") * most).alias("most"))
    total = rows.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0] * ratio
    level = 0.0
    while True:
        full = F.col("weight") * F.lit(level) >= F.col("most")
        taken, open_weight = rows.agg(F.coalesce(F.sum(F.when(full, F.col("most"))), F.lit(0.0)),
                                      F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0))).first()
        above = (total - taken) / open_weight if open_weight else level
        if above <= level:
            break
        level = above
    share = F.col("weight") * F.lit(level)
    return rows.select("source", "source_size", F.least(share, F.col("most")).alias("target"))


def _planned(keyed: DataFrame, ratio: float, most: float, weights, folder: str) -> tuple[DataFrame, int]:
    """A row for each source, with the ranges around the end of its target, and the number of turns that made them."""
    places = keyed.select(F.col("_row.source").cast("string").alias("source"), "x", "size")
    summed = F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows")
    sums = write_table(places.groupBy("source", _bucket(F.lit(0.0), F.lit(1.0)).alias("bucket")).agg(*summed), f"{folder}/sums")
    targets = _targets(sums.groupBy("source").agg(F.sum("size").alias("source_size")), ratio, most, weights, f"{folder}/sources")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = targets.withColumn("epochs", epochs.cast("bigint")).select(
        F.col("source").alias("name"), "source_size", "target", "epochs",
        (F.col("target") - F.col("epochs") * F.col("source_size")).alias("rest"),
        F.expr("CAST(array() AS array<struct<low: double, width: double, edge: int>>)").alias("cuts"),
        F.lit(0).cast("bigint").alias("base"), F.lit(0.0).alias("low"), F.lit(1.0).alias("width"))
    turns = 0
    while True:
        plan = write_table(_parted(sums, plan), f"{folder}/plan{turns}")
        turns += 1
        wide = plan.filter((F.col("rows") > SORTED) & (F.col("width") > NARROW)).select("name", "cuts", "low", "width")
        if wide.isEmpty():
            return materialize(plan, "mix-plan"), turns
        places = write_table(
            places.drop("low", "width").join(wide, F.col("source").eqNullSafe(F.col("name")))
            .filter(_side(F.col("cuts"), turns) == 0).select("source", "x", "size", "low", "width"), f"{folder}/places{turns}")
        sums = places.groupBy("source", _bucket(F.col("low"), F.col("width")).alias("bucket")).agg(*summed)


def mix(docs: DataFrame, ratio: float = 1.5, most: float = 2.0, weights=WEIGHTS, quality=plain_share, seed: str = "") -> DataFrame:
    """Every row of ``docs`` (doc_id, text, source, ...) as ``_row``, with its place in the mix: size, source_size, target, copies, taken.

    A document's size is its number of words. The sources share ``ratio`` times all sizes by weight, none
    above ``most`` times its own. A source's target is filled with complete epochs of its documents first;
    the rest is taken in the order of exponential keys, -ln(u) / quality, up to the document at which the
    sum of sizes comes nearest to the target. ``copies`` counts how often the row is taken, ``taken`` is
    copies times size. u comes from doc_id and seed alone, so reruns agree.

    No source is sorted as a whole: sizes are summed over key ranges, and the one range per source in which the
    target ends is parted again until it has at most ``SORTED`` rows, or its keys are equal; only that is put in order. Turns after the first read
    the source, place and size of that range's rows. ``quality`` maps the measures to weights above 0 and up to 1.

    Null sources are one source, last in order; null ids share one u; equal keys go by id, nulls last, then
    size. Null or empty texts have size 0. Repeated rows count each. An empty table gives an empty result.
    Columns of other names may be anything.
    """
    keyed = _keyed(docs, quality, seed)
    with scratch(docs.sparkSession, "mix") as folder:
        plan, turns = _planned(keyed, ratio, most, weights, folder)

    # a source without a rest has no ranges: all of its rows are behind
    side = F.when(F.size("cuts") == 0, 1).otherwise(_side(F.col("cuts"), turns))
    rows = keyed.join(plan, F.col("_row.source").cast("string").eqNullSafe(F.col("name"))).withColumn("side", side)
    clear = rows.filter("side != 0").withColumn("chosen", (F.col("side") < 0).cast("bigint"))
    order = Window.partitionBy("name").orderBy("key", F.col("_row.doc_id").isNull(), "_row.doc_id", "size") \
        .rowsBetween(Window.unboundedPreceding, 0)
    last = rows.filter("side = 0").withColumn("sum", F.sum("size").over(order) + F.col("base"))
    near = 2 * F.col("sum") - F.col("size") <= 2 * F.col("rest")
    last = last.withColumn("chosen", near.cast("bigint")).drop("sum")
    copies = F.col("epochs") + F.col("chosen")
    return clear.unionByName(last).select(
        "_row", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mixed_rows(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: rows of ``docs`` with all their columns, each as often as it is taken."""
    taken = mix(docs, **settings).filter("copies > 0")
    return taken.select("_row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))).select("_row.*")
