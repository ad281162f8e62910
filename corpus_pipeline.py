"""A training corpus in five stages: toxic documents out, copies out, near copies out, sources mixed, texts encoded."""

from __future__ import annotations

import public_tokenizers
from pyspark import cloudpickle

import sluice
from sluice.llm.exact_dedup import drop_exact_copies
from sluice.llm.jaccard_join import drop_near_copies
from sluice.llm.mixing import mixed_rows
from sluice.llm.queries import bpe_digests
from sluice.llm.toxicity import drop_toxic
from sluice.sources.workspace import materialize

# ships the package with the tasks, so that workers need not have it installed
cloudpickle.register_pickle_by_value(sluice)


def toxicity(spark, docs, sf_dir):
    """Documents that the classifier doesn't reject; it learns from the labels beside the documents."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark, docs, sf_dir):
    """One document of each group of equal texts."""
    return drop_exact_copies(docs)


def near_dedup(spark, docs, sf_dir):
    """One document of each component of near copies: five words, a similarity of 0.8."""
    return drop_near_copies(docs)


def mixing(spark, docs, sf_dir):
    """Documents as often as the mix of their sources takes them."""
    return mixed_rows(docs)


def encoding(spark, docs, sf_dir):
    """Ids of every document and the text that they decode to, as digests."""
    return bpe_digests(docs)


STAGES = [
    ("toxicity", toxicity), ("exact dedup", exact_dedup), ("near dedup", near_dedup), ("mixing", mixing), ("encoding", encoding),
]

#: Classifiers and tokenizers have no SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The stages applied to documents, each to what its predecessor kept, as it was written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
