"""Fill-in-the-middle, language identification and periodic runs, against brute force and on odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from sluice.llm import language_id as L
from sluice.llm.fill_in_middle import Settings as Cuts, SkipList, cut, fill_in_middle, restored
from sluice.llm.periodic_runs import Settings as Runs, looped, periodic_runs, runs_of
from sluice.llm.queries import QUERIES
from sluice.llm.recompression import Extensions, compressed, mirrored
from tests.conftest import TESTDATA
from tests.llm.conftest import LONG, TEXTS

FOLDER = f"{TESTDATA}/sf0.01"
UNIT = re.compile("[A-Za-z]+|[^A-Za-z]")


# fill-in-the-middle

@given(st.text(st.sampled_from("ab Z9é東🤖\n<P>SM\x00"), max_size=400))
@settings(max_examples=200, deadline=None)
def test_every_rank_is_reached(text):
    units = UNIT.findall(text)
    lanes = SkipList(text.encode())
    assert lanes.units == len(units)
    assert [lanes.points_before(k) for k in range(len(units) + 1)] == [len("".join(units[:k])) for k in range(len(units) + 1)]


def test_long_text_has_lanes():
    text = "ab cd, éf " * 20_000
    lanes, units = SkipList(text.encode()), UNIT.findall(text)
    assert len(lanes.passed) > 4 and all(len(b[0]) < len(a[0]) / 4 for a, b in zip(lanes.passed, lanes.passed[1:]))
    for k in (0, 1, 77_777, len(units) - 1, len(units)):
        assert lanes.points_before(k) == len("".join(units[:k]))


def forms_of(doc_id, text):
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle, suffix = ("".join(part) for part in (units[:a], units[a:b], units[b:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(units), "plain", None, None, text
    if h4 % 100 < 20:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_cuts_match_brute_force(spark, documents):
    marks = ["<", "<P", "P>", "<S>", "<M", "a<P>", ">", "S>x", "<S<", "é", " ", "word", "\x00", "東"]
    chance = random.Random(3)
    made = [(100 + i, "".join(chance.choices(marks, k=chance.randrange(12))), "a") for i in range(400)]
    rows = fill_in_middle(documents(TEXTS + made)).withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    expected = [(i, *forms_of("" if i is None else i, text or ""), text or "") for i, text, _ in TEXTS + made]
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, expected))
    assert {r.form for r in rows} == {"plain", "psm", "spm"}
    assert fill_in_middle(documents([])).collect() == []


def test_marks_are_checked():
    assert cut(1, "a b", Cuts(plain=0, spm=100, prefix="[A]", suffix="[B]", middle="[C]"))[1] == "spm"
    for marks in (("<P>", "<P>", "<M>"), ("", "a", "b"), ("<P", "<P>", "<M>"), ("<<P>", "<S>", "<M>")):
        with pytest.raises(ValueError):
            Cuts(prefix=marks[0], suffix=marks[1], middle=marks[2])


# language

def test_held_out_languages(spark):
    rows = QUERIES["op12_language_id"](spark, FOLDER).collect()
    known = {r.doc_id: r.lang for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert len(rows) == len(known) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    right = [r.lang_pred == known[r.doc_id] for r in rows if r.held_out]
    assert len(right) > 200 and np.mean(right) > 0.97


def grams_of(text, orders):
    text = re.sub(r"[\x00-\x40\x5b-\x60\x7b-\x7f]+", " ", f" {text.lower()} ")
    return [text[i : i + n] for n in orders for i in range(len(text) - n + 1)]


def test_predictions_match_brute_force(documents, spark):
    """Naive Bayes on the n-grams' own buckets, one by one."""
    words = {"en": "the of and house water", "de": "der die und haus wässer", "fr": "le les et maison éau"}
    chance = random.Random(1)
    rows = []
    for i in range(150):
        lang = chance.choice(list(words))
        own = words[lang].split() + chance.choice(list(words.values())).split()[:2]
        rows.append((i, " ".join(chance.choices(own, k=chance.randrange(1, 30))), lang))
    rows += [(200, None, "en"), (201, "12 34", "en"), (202, "the", None), (None, "le", "fr"), (203, "", "de"), (3, "the", "en"), (3, "the", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    for most in (L.Settings(), L.Settings(orders=(2,), smoothing=2.0)):
        counts, n_docs, buckets = {}, Counter(), L.BUCKETS
        bucket = {}
        for i, text, lang in rows:
            for gram in grams_of(text or "", most.orders):
                # the gram between letters of its own, so that the text's n-grams give its bucket
                if gram not in bucket:
                    bucket[gram] = one_bucket(gram, buckets)
            if i is not None and zlib.crc32(str(i).encode()) % 4 != 2 and text is not None and lang is not None:
                n_docs[lang] += 1
                counts.setdefault(lang, Counter()).update(bucket[gram] for gram in grams_of(text, most.orders))
        total = {lang: sum(c.values()) + most.smoothing * buckets for lang, c in counts.items()}
        expected = []
        for i, text, _ in rows:
            logs = {lang: math.log(n_docs[lang] / sum(n_docs.values())) + sum(
                math.log((counts[lang][bucket[g]] + most.smoothing) / total[lang]) for g in grams_of(text or "", most.orders)) for lang in counts}
            best = max(sorted(logs), key=logs.get)
            score = 1 / sum(math.exp(v - logs[best]) for v in logs.values())
            named = any(c.isalpha() for c in text or "")
            expected.append((i, best if named else "und", round(score if named else 0.0, 4)))
        got = [(r.doc_id, r.lang_pred, round(r.score, 4)) for r in L.language_id(docs, most).collect()]
        assert sorted(map(repr, got)) == sorted(map(repr, expected))


def one_bucket(gram, buckets):
    """The bucket of an n-gram: its code points folded one by one."""
    mask, odd, value = (1 << 64) - 1, 0x9E3779B97F4A7C15, 0
    for c in gram:
        value = (value + ord(c) + 1) * odd & mask
        value ^= value >> 29
    return (value * odd & mask) >> (64 - buckets.bit_length() + 1)


def test_odd_languages(documents, spark):
    rows = L.language_id(documents()).collect()
    assert len(rows) == len(TEXTS) and {r.lang_pred for r in rows} == {"en", "und"}
    assert {(r.lang_pred, r.score) for r in rows if r.doc_id in (4, 5, 6)} == {("und", 0.0)}
    assert all(r.held_out for r in rows if r.doc_id is None)
    assert L.language_id(documents([])).collect() == []
    untold = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert [tuple(r) for r in L.language_id(untold).collect()] == [(1, False, "und", 0.0)]


def test_many_languages_share_the_matrix(spark, monkeypatch):
    monkeypatch.setattr(L, "ENTRIES", 1 << 9)
    rows = [(i, f"w{chr(97 + i % 26)}{i % 26} text", f"l{i % 26}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert L.fit(docs).table.size <= 1 << 9
    assert {r.lang_pred for r in L.language_id(docs).collect()} <= {lang for _, _, lang in rows}
    monkeypatch.setattr(L, "MOST_LANGUAGES", 20)
    with pytest.raises(ValueError, match="languages"):
        L.language_id(docs)


# periodic runs

def brute_runs(s, repeats=4, least=6):
    found = {}
    for q in range(1, len(s) // repeats + 1):
        i = 0
        while i + q < len(s):
            j = i
            while j + q < len(s) and s[j] == s[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, repeats * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted(((a, e - a, q) for (a, e), q in found.items()), key=lambda r: (r[0], r[2]))


SEQUENCES = st.one_of(
    st.lists(st.integers(0, 1), max_size=120), st.lists(st.integers(0, 9), max_size=60),
    st.builds(lambda head, unit, times, tail: head + unit * times + tail, st.lists(st.integers(0, 4), max_size=9),
              st.lists(st.integers(0, 4), min_size=1, max_size=12), st.integers(1, 9), st.lists(st.integers(0, 4), max_size=9)),
    st.builds(lambda parts: [x for unit, times in parts for _ in range(times) for x in unit],
              st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=5), st.integers(1, 7)), max_size=6)))


@given(st.lists(SEQUENCES, max_size=6))
@settings(max_examples=300, deadline=None)
def test_runs_match_brute_force(sequences):
    got = runs_of([np.array(s, np.int64) for s in sequences])
    assert [[tuple(r) for r in runs.tolist()] for runs in got] == [brute_runs(s) for s in sequences]


@pytest.mark.parametrize("repeats, least", [(2, 2), (3, 5), (5, 1)])
def test_runs_of_other_settings(repeats, least):
    chance = np.random.default_rng(repeats)
    for _ in range(60):
        s = np.repeat(chance.integers(0, 3, 60), chance.integers(1, 4, 60))
        got = runs_of([s], Runs(repeats, least))[0]
        assert [tuple(r) for r in got.tolist()] == brute_runs(s.tolist(), repeats, least)


@given(SEQUENCES, st.data())
@settings(max_examples=200, deadline=None)
def test_extensions_match_brute_force(sequence, data):
    s = sequence + [99]
    place = st.integers(0, len(s) - 1)
    pairs = data.draw(st.lists(st.tuples(place, place), min_size=1, max_size=20))
    x, y = (np.array(side) for side in zip(*pairs))
    rounds = compressed(np.array(s))
    for values, found in ((s, rounds), (s[::-1], mirrored(rounds))):
        expected = []
        for i, j in pairs:
            k = 0
            while max(i, j) + k < len(s) and values[i + k] == values[j + k]:
                k += 1
            expected.append(k)
        assert Extensions(found).find(x, y).tolist() == expected


def test_grammar_is_small():
    for s in (np.zeros(100_000, np.int64), np.tile(np.arange(37), 3000), np.random.default_rng(0).integers(0, 999, 100_000)):
        rounds = compressed(s)
        assert len(rounds) < 60 and sum(len(r.symbols) for r in rounds) < 12 * len(s)


def row_of(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = sorted(((a, e - a, q) for (a, e), q in brute_runs_fast(words).items()), key=lambda r: (r[0], r[2]))
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    dropped = {i for start, length, q in runs for i in range(start + q, start + length)}
    collapsed = " ".join(w for i, w in enumerate(words) if i not in dropped)
    listed = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed.encode()).hexdigest())


def test_runs_of_the_table(spark):
    rows = QUERIES["op13_periodic_runs"](spark, FOLDER).collect()
    expected = [row_of(r.doc_id, r.text or "") for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    assert sorted(map(tuple, rows)) == sorted(expected, key=lambda r: r[0])
    assert sum(r.n_runs > 0 for r in rows) > 20


def test_runs_of_odd_rows(documents):
    got = periodic_runs(documents()).collect()
    assert len(got) == len(TEXTS) and periodic_runs(documents([])).collect() == []
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    b = by_id[20]
    assert [tuple(r) for r in b.runs] == [(1, 3000, 1)] and b.collapsed == "a b" and b.exponent_milli == 3_000_000
    assert by_id[5].runs == [] and by_id[5].collapsed == "" and by_id[5].start is None
    assert by_id[9].n_runs == 0  # its words come back after 977 * 13 lines, of 30,000
    assert by_id[9].collapsed == LONG


def brute_runs_fast(words):
    index, found = {}, {}
    s = np.array([index.setdefault(w, len(index)) for w in words])
    for q in range(1, len(s) // 4 + 1):
        same = np.concatenate(([0], s[q:] == s[:-q], [0])).astype(np.int8)
        edge = np.diff(same)
        for a, e in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
            if e + q - a >= max(6, 4 * q):
                found.setdefault((a, e + q), q)
    return found


def test_looped_words():
    words = np.arange(50)
    changed = [i for i in range(200) if not np.array_equal(looped(words, i), words)]
    assert 5 < len(changed) < 40 and all(zlib.crc32(str(i).encode()) % 10 == 0 for i in changed)
    assert looped(words[:0], changed[0]).tolist() == []
