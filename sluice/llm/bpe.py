"""Byte-level BPE: frequent words through a memory-mapped transducer, others by exact merging; and decoding."""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sluice.llm.common import id_and_text, kept, pieces, texts, with_id
from sluice.llm.frequent import frequent_units
from sluice.llm.lexicon import Lexicon, compiled
from sluice.llm.token_units import UNITS, Encoder, Memo, byte_of_character, spaced, words
from sluice.sources.native import filesystem, qualified
from sluice.sources.workspace import new_folder

#: Words with this share of all are in the lexicon, so at most 1 / SHARE.
SHARE = 1e-5


class Decoder:
    """Texts of ids under a byte-level vocabulary; bytes that are no UTF-8 become replacement characters."""

    def __init__(self, spec: str):
        parts = json.loads(spec)
        if (parts.get("decoder") or {}).get("type") != "ByteLevel":
            raise ValueError("the tokenizer has no byte-level decoder")
        alphabet = byte_of_character()
        names = {number: name for name, number in parts["model"]["vocab"].items()}
        names |= {token["id"]: token["content"] for token in parts["added_tokens"]}
        values = [self._bytes(names.get(i, ""), alphabet) for i in range(max(names, default=-1) + 1)]
        self.flat = np.frombuffer(b"".join(values), np.uint8)
        self.lengths = np.array([*map(len, values), 0], np.int64)  # the last stands for ids beyond the vocabulary
        self.starts = np.cumsum(self.lengths) - self.lengths

    @staticmethod
    def _bytes(name: str, alphabet: dict[str, int]) -> bytes:
        found = [alphabet.get(c) for c in name]
        return name.encode() if None in found else bytes(found)

    def data(self, ids: np.ndarray) -> bytes:
        ids = np.minimum(ids, len(self.lengths) - 1)
        lengths = self.lengths[ids]
        shift = self.starts[ids] - (np.cumsum(lengths) - lengths)
        found = self.flat[np.repeat(shift, lengths) + np.arange(int(lengths.sum()))].tobytes()
        try:
            found.decode()
        except UnicodeDecodeError:
            return found.decode(errors="replace").encode()
        return found

    def text(self, ids: np.ndarray) -> str:
        return self.data(ids).decode()


def lexicon_file(docs: DataFrame, spec: str, share: float = SHARE) -> str:
    """Compile the frequent words of all documents and hand the file to every worker; returns its name there."""
    spark = docs.sparkSession
    common = [" " + word for word in frequent_units(docs, words, share)]  # as units: nearly all words stand after a blank
    data = compiled(dict(zip((unit.encode() for unit in common), Encoder(spec)(common))))
    folder = qualified(spark, new_folder(spark, "lexicon"))
    fs, root = filesystem(folder)
    fs.create_dir(root, recursive=True)
    name = folder.rpartition("/")[2] + ".bin"
    with fs.open_output_stream(f"{root}/{name}") as out:
        out.write(data)
    spark.sparkContext.addFile(f"{folder}/{name}")
    return name


def bpe_encode(docs: DataFrame, tokenizer_file: str, each=None, schema=(("ids", T.ArrayType(T.LongType())),), share: float = SHARE) -> DataFrame:
    """doc_id and n_tokens of every document, with what ``each(ids, decoder)`` gives (a tuple for the fields of ``schema``; the ids themselves by default).

    Ids are those of the tokenizers library without added special tokens, truncation and padding. Words are
    units with the white space before them. Those with at least ``share`` of all occurrences are compiled into
    a minimal acyclic transducer, which workers map into memory; words it doesn't have are merged exactly, by the
    library's own model, and remembered in a bounded cache.

    Null and empty texts have no ids. Rows are kept as they are, with null or repeated ids too; other columns
    don't matter. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    with open(tokenizer_file, encoding="utf-8") as file:
        spec = file.read()
    name = lexicon_file(docs, spec, share)
    shared = spark.sparkContext.broadcast(spec)
    each = each or (lambda ids, decoder: (ids.tolist(),))
    result = with_id(docs, ("n_tokens", T.LongType()), *schema)

    def encode(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(result)

        def build():
            lexicon, encoder = Lexicon(SparkFiles.get(name)), Encoder(shared.value)

            def find(units):
                found = lexicon.find_all([unit.encode() for unit in units])
                rest = [i for i, ids in enumerate(found) if ids is None]
                for i, ids in zip(rest, encoder([units[i] for i in rest])):
                    found[i] = ids
                return found

            return Memo(find, UNITS), Decoder(shared.value)

        memo, decoder = kept(("bpe", name), build)
        for piece in pieces(batches):
            units = [spaced(text) for text in texts(piece.column("text"))]
            known = memo.know(units)
            rows = []
            for own in units:
                ids = np.frombuffer(b"".join(map(known.__getitem__, own)), "<u4")
                rows.append((len(ids), *each(ids, decoder)))
            columns = [piece.column("doc_id"), *(pa.array(c, kind) for c, kind in zip(zip(*rows), arrow.types[1:]))]
            yield pa.RecordBatch.from_arrays(columns, arrow.names)

    return id_and_text(docs).mapInArrow(encode, result)


def bpe_decode(rows: DataFrame, tokenizer_file: str) -> DataFrame:
    """``rows`` with a column decoded: the text of their column ids, as the library's decode gives it with special tokens kept.

    Null ids give a null text, ids outside the vocabulary (null ones too) nothing.
    """
    with open(tokenizer_file, encoding="utf-8") as file:
        shared = rows.sparkSession.sparkContext.broadcast(file.read())

    @F.arrow_udf("string")
    def decoded(column: pa.Array) -> pa.Array:
        decoder = kept(("decoder", hash(shared.value)), lambda: Decoder(shared.value))
        return pa.array([None if ids is None else decoder.text(np.array(
            [-1 if i is None or i < 0 else i for i in ids], np.int64).astype(np.uint64)) for ids in column.to_pylist()], pa.string())

    return rows.withColumn("decoded", decoded(F.col("ids").cast("array<bigint>")))
