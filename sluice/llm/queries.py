"""The operators' queries over the test tables, with production settings, and the SQL that must agree where there is one."""

from __future__ import annotations

import hashlib
import zlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sluice.llm import jaccard_join
from sluice.llm.bpe import bpe_encode
from sluice.llm.cover_tree import top_k
from sluice.llm.exact_dedup import exact_dedup
from sluice.llm.fill_in_middle import fill_in_middle, restored
from sluice.llm.language_id import language_id
from sluice.llm.license_scan import license_scan
from sluice.llm.mixing import mix
from sluice.llm.periodic_runs import looped, periodic_runs
from sluice.llm.quality import quality
from sluice.llm.record_files import read_sequences, write_sequences
from sluice.llm.token_counts import token_counts
from sluice.llm.toxicity import toxicity
from sluice.sources.workspace import new_folder

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER))


@query
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


ORACLES["op2_exact_dedup"] = r"""
WITH d AS (
    SELECT doc_id, length(coalesce(text, '')) AS n_chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS content
    FROM documents
), k AS (
    SELECT doc_id, content, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY content) AS group_size,
        row_number() OVER w AS place
    FROM d WINDOW w AS (PARTITION BY content ORDER BY n_chars DESC, doc_id)
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(content) AS text_sha256 FROM k
"""


@query
def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("_row.doc_id", "size", "source_size", "target", "taken")


ORACLES["op10_mix_sources"] = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
        (strlen(regexp_replace(coalesce(text, ''), '[!-@\[-`{-~]', '', 'g')) + 1)::DOUBLE
            / (strlen(coalesce(text, '')) + 1)::DOUBLE AS share,
        (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 1.0) / 4503599627370496.0 AS u
    FROM documents
), k AS (
    SELECT doc_id, source, size, -ln(u) / (share * share) AS key FROM d
), s AS (
    SELECT source, sum(size)::BIGINT AS source_size, 2.0::DOUBLE * sum(size) AS most,
        ([5.0, 2.0, 1.0])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
    FROM k GROUP BY source
), levels AS (
    SELECT 0 AS turn, 0.0::DOUBLE AS level
    UNION ALL
    SELECT turn + 1, (SELECT (sum(source_size)::DOUBLE * 1.5::DOUBLE
        - coalesce(sum(most) FILTER (weight * l.level >= most), 0.0)) / sum(weight) FILTER (weight * l.level < most) FROM s)
    FROM levels l WHERE turn < 30
), t AS (
    SELECT source, source_size, least(weight * (SELECT max(level) FROM levels), most) AS target,
        CASE WHEN source_size > 0 THEN floor(least(weight * (SELECT max(level) FROM levels), most) / source_size) ELSE 0 END AS epochs
    FROM s
), p AS (
    SELECT doc_id, size, source_size, target, epochs, target - epochs * source_size AS rest,
        sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id NULLS LAST, size ROWS UNBOUNDED PRECEDING) AS upto
    FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
    (epochs::BIGINT + CASE WHEN rest > 0 AND 2 * upto - size <= 2 * rest THEN 1 ELSE 0 END) * size AS taken FROM p
"""


@query
def op5_record_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "sequences")
    write_sequences(table(spark, sf_dir, "documents"), folder, public_tokenizers.path(WORD_TOKENIZER), end_id=2)
    return read_sequences(spark, folder, lambda ids: (zlib.crc32(ids.tobytes()),), "ids_crc32 bigint")


def bpe_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256: the ids of every text, and the text that they decode to."""
    digests = (("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType()))
    return bpe_encode(docs, public_tokenizers.path(BYTE_TOKENIZER), lambda ids, decoder: (
        hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(decoder.data(ids)).hexdigest()), digests)


@query
def op7_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"))


@query
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents")).drop("spans")


@query
def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


ORACLES["op8_exact_top_k"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS vector FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, d.vec_id,
        list_sum(list_transform(list_zip(q.vector, d.vector), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM v q JOIN v d ON q.vec_id % 50 = 0 AND d.vec_id <> q.vec_id
), r AS (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s
)
SELECT * FROM r WHERE rank <= 5
"""


@query
def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = jaccard_join.Settings(n=4, percent=85)
    return jaccard_join.near_copies(table(spark, sf_dir, "documents"), settings).select("doc_id", "n_shingles", "component_id")


ORACLES["op9_jaccard_join"] = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS words
    FROM documents
), s AS (
    SELECT doc_id, CASE WHEN len(words) = 0 THEN []::VARCHAR[] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
        ELSE list_distinct(list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i : i + 3], ' '))) END AS shingles
    FROM w
), e AS (
    SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM s
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT s.doc_id, len(shingles) AS n_shingles, min(b) AS component_id FROM s JOIN reach ON s.doc_id = reach.a GROUP BY s.doc_id, shingles
"""


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fill_in_middle(table(spark, sf_dir, "documents"))
    whole = restored(F.col("output"), F.col("form"))
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                      F.sha2("output", 256).alias("output_sha256"), F.sha2(whole, 256).alias("restored_sha256"))


ORACLES["op11_fill_in_middle"] = r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS hash FROM documents
), u AS (
    SELECT doc_id, text, regexp_extract_all(text, '(?s)[A-Za-z]+|[^A-Za-z]') AS units, ('0x' || hash[1:8])::BIGINT AS h1,
        ('0x' || hash[9:16])::BIGINT AS h2, ('0x' || hash[17:24])::BIGINT AS h3, ('0x' || hash[25:32])::BIGINT AS h4
    FROM d
), c AS (
    SELECT *, len(units)::BIGINT AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a,
        greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b
    FROM u
), p AS (
    SELECT doc_id, n, text,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
            WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
        array_to_string(units[1 : a], '') AS prefix, array_to_string(units[a + 1 : b], '') AS middle,
        array_to_string(units[b + 1 :], '') AS suffix
    FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM p
"""


@query
def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"))


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    digests = (("runs_sha256", T.StringType()), ("collapsed_sha256", T.StringType()))
    return periodic_runs(table(spark, sf_dir, "documents"), lambda runs, collapsed: (
        hashlib.sha256("".join("%d,%d,%d\n" % tuple(run) for run in runs.tolist()).encode()).hexdigest(),
        hashlib.sha256(collapsed).hexdigest()), digests, change=looped)
