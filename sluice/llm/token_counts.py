"""Token counts: a broadcast table of frequent pre-tokens' lengths, then the workers' own memory of the rest."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from sluice.llm.common import id_and_text, kept, pieces, texts, utf8_length, with_id
from sluice.llm.pretokens import Counter, Cut, Lengths, classes, frequent, special_strings, stretches
from sluice.llm.token_units import UNITS
from sluice.sources.workspace import scratch


def token_counts(docs: DataFrame, tokenizer_file: str, limit: int = 2048, remembered: int = UNITS) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every document, as the tokenizers library counts them.

    Two tiers, both on the map side. Texts are cut into pre-tokens by the file's own pattern; the lengths of the most frequent ones
    (``pretokens.ENTRIES``, found by a pass over all texts) are broadcast as a flat hash table that compares whole keys. Others
    are encoded by the library's model once in each worker, which remembers ``remembered`` to twice as many of them. Neither texts nor pre-tokens
    nor their counts are shuffled. Words with characters whose treatment depends on their neighbours, and texts with special
    strings, go to the whole library; so do all texts under a tokenizer with another pattern than ``token_units.LETTERS_OR_DIGIT``.

    Null and empty texts have 0 bytes and tokens. Rows are kept as they are, with null or repeated ids too; other
    columns don't matter. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    with open(tokenizer_file, encoding="utf-8") as file:
        spec = file.read()
    own = Counter(spec, remembered)
    tables, special = classes(own.encoder), special_strings(spec)
    lengths = None
    if tables:
        with scratch(spark, "frequent") as folder:
            keys, sizes = frequent(id_and_text(docs), spark.sparkContext.broadcast(tables), special, folder)
        names = [key.tobytes()[: 2 * size] for key, size in zip(np.ascontiguousarray(keys.T, "<u8"), sizes.tolist())]
        lengths = Lengths(keys, sizes, np.array(own.tokens(names), np.int64))
    table = spark.sparkContext.broadcast((tables, lengths, spec))

    def count(batches):
        tables, lengths, spec = table.value
        counter = kept(("token counts", hash(spec), remembered), lambda: Counter(spec, remembered))
        for piece in pieces(batches):
            values = texts(piece.column("text"))
            n = np.zeros(len(values), np.int64)
            blocks, whole = stretches(values, special) if tables else ([], range(len(values)))
            for block in blocks:
                cut = Cut(*tables, *block)
                tokens = np.full(len(cut.start), -1, np.int64)
                fit, keys, sizes = cut.keys()
                tokens[fit] = lengths.find(keys, sizes)
                missed = np.flatnonzero(tokens < 0)
                names = cut.text(missed)
                known = counter.cut.know([names])
                tokens[missed] = [known[name] for name in names]
                np.add.at(n, cut.row, tokens)
                known = counter.words.know([[word for _, word in cut.words]])
                for row, word in cut.words:
                    n[row] += known[word]
            for row, tokens in zip(whole, counter.whole([values[row] for row in whole])):
                n[row] = tokens
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), utf8_length(piece.column("text")), pa.array(n), pa.array(n > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    schema = with_id(docs, ("n_bytes", T.LongType()), ("n_tokens", T.LongType()), ("over_limit", T.BooleanType()))
    return id_and_text(docs).mapInArrow(count, schema)
