"""Counts, encodings, record files and decoding against the tokenizers library itself."""

import functools
import hashlib
import json
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sluice.llm import bpe, pretokens, queries, record_files
from sluice.llm.lexicon import Lexicon, compiled
from sluice.llm.token_counts import token_counts
from sluice.llm.token_units import Encoder, Memo, encoded, library, spaced, words
from sluice.sources.workspace import new_folder, write_table
from tests.conftest import TESTDATA
from tests.llm.conftest import TEXTS

WORD, BYTE = (public_tokenizers.path(name) for name in (queries.WORD_TOKENIZER, queries.BYTE_TOKENIZER))
FOLDER = f"{TESTDATA}/sf0.001"


def ids_of(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def table(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


def by_library(path, texts):
    tokenizer = Tokenizer.from_file(path)
    return [e.ids for e in tokenizer.encode_batch(list(texts), add_special_tokens=False)]


def test_counts_of_the_table(spark, table):
    rows = queries.QUERIES["op3_token_counts"](spark, FOLDER).collect()
    expected = dict(zip(table, map(len, by_library(WORD, table.values()))))
    assert len(rows) == len(table)
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in rows} == {
        i: (len(text.encode()), expected[i], expected[i] > 2048) for i, text in table.items()}


def test_counts_of_odd_texts(spark, documents):
    rows = token_counts(documents(), WORD).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in rows), key=str) == sorted(
        ((i, len((text or "").encode()), len(ids_of(WORD, text))) for i, text, _ in TEXTS), key=str)
    assert token_counts(documents([]), WORD).collect() == []
    assert [r.n_tokens for r in token_counts(documents([(1, None, "a")]), WORD).collect()] == [0]


def test_table_and_cache_agree(spark, documents, table, monkeypatch):
    """Everything through the workers' caches, a full table, and one that keeps few pre-tokens, give the same."""
    docs = documents([(i, text, "a") for i, text in table.items()] + [(-1 - at, text, "b") for at, (_, text, _) in enumerate(TEXTS)])
    found = [sorted(token_counts(docs, WORD).collect())]
    for entries in (0, 100):
        monkeypatch.setattr(pretokens, "ENTRIES", entries)
        found.append(sorted(token_counts(docs, WORD).collect()))
    assert found[0] == found[1] == found[2] and len(found[0]) == len(table) + len(TEXTS)


def test_no_pre_token_is_shuffled(spark, documents, plan, monkeypatch):
    """Neither the counting passes nor the look-up have an exchange; many summaries are merged in levels."""
    plans = []
    monkeypatch.setattr(pretokens, "FAN", 2)
    monkeypatch.setattr(pretokens, "write_table", lambda df, path: plans.append(plan(df)) or write_table(df, path))
    texts = [(i, f"word{i % 7} and more of it", "a") for i in range(64)]
    docs = spark.read.parquet(*write_table(documents(texts).repartition(8), new_folder(spark, "texts")).inputFiles())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    spark.conf.set("spark.sql.files.openCostInBytes", "16k")
    try:
        rows = token_counts(docs, WORD)
        assert sorted(r.n_tokens for r in rows.collect()) == sorted(len(ids_of(WORD, text)) for _, text, _ in texts)
        assert len(plans) > 2 and "Exchange" not in "".join(plans) + plan(rows)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


LETTERS = st.sampled_from(list("abst'réVvLlDm \t\n\x1c\x85.,!-09Σσςİß\u0301\u0338=≠가ᄀ\u1161각\u11a8中、’“”٣½ \u00a0\u3000\u200b😀क\u093cK\0"))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(LETTERS, max_size=30).map("".join), min_size=1, max_size=5))
def test_cuts_are_the_librarys(values):
    """Pre-tokens and whole words together have the library's pieces, text by text."""
    counter, tables, tokenizer = COUNTER()
    blocks, whole = pretokens.stretches(values, [])
    assert not whole
    found = [0] * len(values)
    for block in blocks:
        cut = pretokens.Cut(*tables, *block)
        for row, n in zip(cut.row.tolist(), counter.tokens(cut.text(np.arange(len(cut.start))))):
            found[row] += n
        for (row, _), n in zip(cut.words, counter.whole([word for _, word in cut.words])):
            found[row] += n
    assert found == [len(e.ids) for e in tokenizer.encode_batch(values, add_special_tokens=False)]


@functools.cache
def COUNTER():
    with open(WORD, encoding="utf-8") as file:
        counter = pretokens.Counter(file.read(), 100)
    return counter, pretokens.classes(counter.encoder), counter.encoder.tokenizer


def test_every_character_between_others(monkeypatch):
    """Every 16-bit character alone, after a letter, a mark and an apostrophe; in stretches of any size."""
    counter, tables, tokenizer = COUNTER()
    values = [f"a{c} {c}a !{c}! '{c}e 0{c}0" for c in map(chr, (*range(0xD800), *range(0xE000, 1 << 16)))]
    monkeypatch.setattr(pretokens, "BLOCK", 3000)
    found = np.zeros(len(values), int)
    for block in pretokens.stretches(values, [])[0]:
        cut = pretokens.Cut(*tables, *block)
        np.add.at(found, cut.row, counter.tokens(cut.text(np.arange(len(cut.start)))))
        for (row, _), n in zip(cut.words, counter.whole([word for _, word in cut.words])):
            found[row] += n
    expected = [len(e.ids) for e in tokenizer.encode_batch(values, add_special_tokens=False)]
    assert [(hex(ord(v[1])), a, b) for v, a, b in zip(values, found.tolist(), expected) if a != b] == []


def test_records_of_the_table(spark, table):
    rows = sorted(queries.QUERIES["op5_record_files"](spark, FOLDER).collect())
    start, expected = 0, []
    order = sorted(table)
    for i, ids in zip(order, by_library(WORD, (table[i] for i in order))):
        data = np.array([*ids, 2], "<u4")
        expected.append((i, start, len(data), zlib.crc32(data.tobytes())))
        start += len(data)
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows] == expected


def test_records_of_odd_texts(spark, documents, tmp_path):
    folder = str(tmp_path / "records")
    manifest = record_files.write_sequences(documents(), folder, WORD, end_id=2, files=4)
    rows = record_files.read_sequences(spark, folder).collect()
    assert sorted(((r.doc_id, r.ids) for r in rows), key=str) == sorted(((i, [*ids_of(WORD, text), 2]) for i, text, _ in TEXTS), key=str)
    rows.sort(key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((i for i, _, _ in TEXTS), key=lambda i: (i is not None, i))
    assert [r.start for r in rows] == np.cumsum([0, *(r.n_tokens for r in rows)]).tolist()[:-1]
    assert sum(r.records for r in manifest.collect()) == len(TEXTS)
    shuffled = record_files.read_sequences(spark, folder, seed=3).collect()
    assert sorted(map(str, shuffled)) == sorted(map(str, rows))
    empty = str(tmp_path / "empty")
    assert record_files.write_sequences(documents([]), empty, WORD, end_id=2).count() == 0
    assert record_files.read_sequences(spark, empty).collect() == []


def test_files_of_several_ranges(spark, tmp_path):
    """Files of more records than a task of the reader takes at a time."""
    folder, n = str(tmp_path / "records"), 2 * (2 * record_files.RANGE + 9)
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "one two").alias("text"))
    manifest = record_files.write_sequences(docs, folder, WORD, end_id=2, files=2).collect()
    assert max(r.records for r in manifest) > record_files.RANGE
    rows = sorted(record_files.read_sequences(spark, folder).select("doc_id", "start", "n_tokens").collect())
    sizes = [3 if i % 3 else 1 for i in range(n)]
    assert [tuple(r) for r in rows] == [*zip(range(n), np.cumsum([0, *sizes]).tolist(), sizes)]


def test_damaged_records_are_noticed(spark, documents, tmp_path):
    folder = tmp_path / "records"
    record_files.write_sequences(documents(), str(folder), WORD, end_id=2, files=1)
    file = next(folder.glob("part-*.rec"))
    data = bytearray(file.read_bytes())
    data[len(data) // 2] ^= 1
    file.write_bytes(data)
    with pytest.raises(Exception, match="damaged"):
        record_files.read_sequences(spark, str(folder)).collect()


@given(st.lists(st.tuples(st.none() | st.integers(-2**63, 2**63 - 1), st.lists(st.integers(0, 2**32 - 1))), max_size=5))
def test_frames_round_trip(rows):
    data = b"".join(record_files.framed(record_files.payload_of(i, np.array(ids, "<u4"))) for i, ids in rows)
    at, found = 0, []
    while at < len(data):
        payload, at = record_files.unframed(data, at)
        doc_id, ids = record_files.parsed(payload)
        found.append((doc_id, ids.tolist()))
    assert found == rows


def test_round_trip_of_the_table(spark, table):
    tokenizer = Tokenizer.from_file(BYTE)
    expected = {}
    for i, ids in zip(table, by_library(BYTE, table.values())):
        expected[i] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                       hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    rows = queries.QUERIES["op7_bpe_encode_decode"](spark, FOLDER).collect()
    assert {r.doc_id: tuple(r[1:]) for r in rows} == expected and len(rows) == len(table)


def test_encoding_and_decoding_of_odd_texts(spark, documents):
    rows = bpe.bpe_decode(bpe.bpe_encode(documents(), BYTE), BYTE).collect()
    tokenizer = Tokenizer.from_file(BYTE)
    expected = []
    for i, text, _ in TEXTS:
        ids = ids_of(BYTE, text)
        expected.append((i, len(ids), ids, tokenizer.decode(ids, skip_special_tokens=False)))
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, expected))
    assert bpe.bpe_encode(documents([]), BYTE).collect() == []


def test_decoding_of_odd_ids(spark):
    rows = [([220, 50256, 127],), (None,), ([],), ([99999999, -1, None, 72],), ([47490, 230],)]
    tokenizer = Tokenizer.from_file(BYTE)
    found = [r.decoded for r in bpe.bpe_decode(spark.createDataFrame(rows, "ids array<bigint>"), BYTE).collect()]
    assert found == [tokenizer.decode(rows[0][0], skip_special_tokens=False), None, "", tokenizer.decode([72], skip_special_tokens=False),
                     tokenizer.decode([47490, 230], skip_special_tokens=False)]


@pytest.mark.parametrize("change", [
    lambda parts: parts["added_tokens"].append({**parts["added_tokens"][0], "id": 0, "content": "fox", "special": False}),
    lambda parts: parts["pre_tokenizer"].update(add_prefix_space=True), lambda parts: parts["pre_tokenizer"].update(use_regex=False),
    lambda parts: parts.update(normalizer={"type": "StripAccents"}), lambda parts: parts["model"].update(dropout=0.5)])
def test_letters_of_other_tokenizers_go_to_the_library(change):
    with open(BYTE, encoding="utf-8") as file:
        parts = json.load(file)
    assert Encoder(json.dumps(parts)).direct
    change(parts)
    encoder = Encoder(json.dumps(parts))
    assert not encoder.direct
    if not parts["model"]["dropout"]:
        assert encoder([" foxes,", "é"]) == encoded(encoder.tokenizer, [" foxes,", "é"])


WORDLIKE = st.text(st.sampled_from("aZzÀßéÿªµº×÷ſKÅİΣ東1'.,<|>-\u0338\u0301 \n"), max_size=8)


@settings(max_examples=500)
@given(st.lists(WORDLIKE, max_size=6))
def test_letters_directly(encoders, units):
    for encoder in encoders:
        assert encoder(units) == [np.array(encoder.tokenizer.encode(unit, add_special_tokens=False).ids, "<u4").tobytes() for unit in units]


@pytest.fixture(scope="module")
def encoders():
    return [Encoder(Tokenizer.from_file(path).to_str(), remembered=20) for path in (WORD, BYTE)]


TEXT = st.text(st.sampled_from("ab z'sS .,!\n\t  \x1c\x85 éÉ́ΣİﬁA9東_<|>") | st.characters(codec="utf-8"), max_size=40)


@pytest.fixture(scope="module")
def tokenizers():
    out = []
    for path, split in ((WORD, words), (BYTE, spaced)):
        with open(path, encoding="utf-8") as file:
            tokenizer = library(file.read())
            encoder = Encoder(tokenizer.to_str(), remembered=50)
        assert encoder.direct
        out.append((tokenizer, split, Memo(lambda units, t=tokenizer: encoded(t, units), remembered=50)))
        out.append((tokenizer, split, Memo(encoder, remembered=5)))
    return out


@settings(max_examples=300, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(TEXT, max_size=4))
def test_units_give_the_texts_ids(tokenizers, texts):
    for tokenizer, split, memo in tokenizers:
        units = [split(text) for text in texts]
        known = memo.know(units)
        for text, own in zip(texts, units):
            ids = np.frombuffer(b"".join(known[unit] for unit in own), "<u4").tolist()
            assert ids == tokenizer.encode(text, add_special_tokens=False).ids
            if split is spaced:
                assert "".join(own) == text


@given(st.dictionaries(st.binary(max_size=6), st.lists(st.integers(0, 2**32 - 1), max_size=3), max_size=40), st.lists(st.binary(max_size=6)))
def test_lexicon(tmp_path_factory, entries, others):
    path = tmp_path_factory.mktemp("lexicon") / "l.bin"
    entries = {word: np.array(ids, "<u4").tobytes() for word, ids in entries.items()}
    path.write_bytes(compiled(entries))
    lexicon = Lexicon(str(path))
    assert lexicon.words == len(entries)
    for word in [*entries, *others]:
        assert lexicon.find(word) == entries.get(word)
    assert lexicon.find_all([*entries, *others]) == [entries.get(word) for word in [*entries, *others]]


def test_lexicon_is_minimal(tmp_path):
    """One state for each set of endings."""
    some = [a + b + c for a in (b"re", b"un", b"") for b in (b"do", b"tie", b"lock") for c in (b"", b"s", b"ing")]
    (tmp_path / "l").write_bytes(compiled({word: b"" for word in some}))
    starts = {word[:n] for word in some for n in range(len(word) + 1)}
    endings = {frozenset(word[len(start):] for word in some if word.startswith(start)) for start in starts}
    assert Lexicon(str(tmp_path / "l")).states == len(endings)
