"""Deduplication, near copies, mixing and licences against brute force, on odd rows too."""

import hashlib
import math
import random
import re
import weakref
from collections import Counter, defaultdict
from unittest.mock import patch

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from sluice.llm import common, exact_dedup, jaccard_join, license_scan, mixing
from sluice.llm.common import kept
from sluice.llm.components import components
from sluice.sources.workspace import materialize
from tests.llm.conftest import TEXTS

WHITE = re.compile("[\x20\x09-\x0d]+")


def by_id(rows):
    return sorted(map(tuple, rows), key=lambda row: [(x is None, str(x)) for x in row])


# exact copies

def expected_dedup(rows):
    groups = defaultdict(list)
    for i, text, *_ in rows:
        groups[WHITE.sub("", text or "")].append((-len(text or ""), i is None, i or 0, i))
    out = []
    for content, members in groups.items():
        members.sort(key=lambda m: m[:3])
        digest = hashlib.sha256(content.encode()).hexdigest()
        out.extend((m[3], members[0][3], len(members), k == 0, digest) for k, m in enumerate(members))
    return out


@pytest.mark.parametrize("salts", [1, 4, exact_dedup.SALTS])
def test_exact_dedup(documents, salts):
    found = exact_dedup.exact_dedup(documents(), salts)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert by_id(found.collect()) == by_id(expected_dedup(TEXTS))


def test_exact_dedup_compares_contents(documents):
    """A digest that all texts share changes nothing but the digest."""
    found = exact_dedup.exact_dedup(documents(), 4, digest=lambda content: F.substring(F.sha2(content, 256), 1, 0)).collect()
    assert by_id(r[:4] for r in found) == by_id(r[:4] for r in expected_dedup(TEXTS))


def test_drop_exact_copies(documents):
    docs = documents()
    for salts in (1, 4):
        kept = exact_dedup.drop_exact_copies(docs, salts)
        assert kept.schema == docs.schema
        assert by_id((r.doc_id,) for r in kept.collect()) == by_id((i,) for i, _, _, first, _ in expected_dedup(TEXTS) if first)
    assert exact_dedup.drop_exact_copies(documents([])).count() == exact_dedup.exact_dedup(documents([])).count() == 0


def test_hot_group_of_copies(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "a  copy").otherwise(
        F.concat(F.lit("text "), F.col("id"))).alias("text"))
    rows = exact_dedup.exact_dedup(docs).filter("group_size > 1").collect()
    assert len(rows) == 1000 and {(r.keep_id, r.group_size) for r in rows} == {(0, 1000)} and sum(r.kept for r in rows) == 1


# near copies

def shingle_set(text, n):
    words = WHITE.sub(" ", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")).strip(" ").split(" ")
    if words == [""]:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))) if len(words) >= n else frozenset([tuple(words)])


def expected_components(rows, n, percent):
    sets = [shingle_set(text, n) for _, text, *_ in rows]
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            both = len(sets[x] & sets[y])
            if sets[x] and sets[y] and 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
                label[root(x)] = root(y)
    first = defaultdict(list)
    for x, (i, *_) in enumerate(rows):
        first[root(x)].append((i is None, i))
    return [(i, len(sets[x]), min(first[root(x)], key=lambda k: (k[0], k[1] or 0))[1]) for x, (i, *_) in enumerate(rows)]


def edited(rng, words, share):
    words = list(words)
    for _ in range(int(len(words) * share)):
        at = rng.randrange(len(words))
        rng.choice((lambda: words.__setitem__(at, f"new{rng.random()}"), lambda: words.pop(at), lambda: words.insert(at, "put")))()
    return words


def near_rows(seed):
    """Chains of edits, whose ends are no longer similar, texts of all sizes, a passage and a line that many share."""
    rng = random.Random(seed)
    rows, passage = [], [f"p{i}" for i in range(60)]
    for size in (1, 2, 3, 4, 5, 6, 8, 12, 20, 45, 90, 150, 400):
        base = [f"w{rng.randrange(3000)}" for _ in range(size)]
        for share in (0, 0, 0.01, 0.02, 0.03, 0.05):
            words = base
            for _ in range(4):
                words = edited(rng, words, share)
                rows.append(" ".join(words))
        for _ in range(6):
            own = [f"w{rng.randrange(3000)}" for _ in range(size)]
            at = rng.randrange(size + 1)
            rows.append(" ".join(own[:at] + passage + own[at:]))
    rng.shuffle(rows)
    return [(i, text) for i, text in enumerate(rows)]


@pytest.mark.parametrize("step", [jaccard_join._sets, jaccard_join._groups])
def test_workers_give_up_what_they_kept(step):
    """A worker that scored texts before doesn't hold its model and words while it searches for near copies."""
    class Docs:
        def mapInArrow(self, function, schema):
            self.function = self.__dict__.get("function", function)
            return self

        repartition = sortWithinPartitions = lambda self, *columns: self

    docs, model = Docs(), type("Model", (), {})()
    gone = weakref.ref(kept("model", lambda: model))
    del model
    with patch.object(jaccard_join, "F"):
        step(docs, jaccard_join.Settings())
    assert list(docs.function([pa.RecordBatch.from_pylist([{"doc_id": 1, "row": 2, "text": "one two three"}])]))
    assert gone() is None


def test_workers_return_memory(monkeypatch):
    """When a kept object makes room for the next one, and when that one is built, freed memory goes back to the system."""
    gone, seen = [], []
    monkeypatch.setattr(common, "give_back", lambda: seen.append(gone[0]() is None if gone else None))
    model = type("Model", (), {})()
    kept(("a model", 1), lambda: model)
    gone.append(weakref.ref(model))
    del model
    seen.clear()
    for _ in range(2):
        kept(("bands", 1), object)
    assert seen == [True, True]  # the old one was dead each time; nothing is done while the key stays
    monkeypatch.undo()
    common.give_back()


@pytest.mark.parametrize("n, percent, seed", [(4, 85, 1), (5, 80, 2), (2, 60, 3)])
def test_near_copies(spark, n, percent, seed):
    rows = near_rows(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    found = jaccard_join.near_copies(docs, jaccard_join.Settings(n=n, percent=percent)).select("doc_id", "n_shingles", "component_id")
    assert by_id(found.collect()) == by_id(expected_components(rows, n, percent))


def test_near_copies_of_odd_rows(documents):
    found = jaccard_join.near_copies(documents(), jaccard_join.Settings(n=4, percent=85))
    assert by_id(found.select("doc_id", "n_shingles", "component_id").collect()) == by_id(expected_components(TEXTS, 4, 85))
    assert jaccard_join.near_copies(documents([])).count() == 0


def test_drop_near_copies(documents):
    docs = documents()
    kept = jaccard_join.drop_near_copies(docs)
    expected = {(i, c) for i, n, c in expected_components(TEXTS, 5, 80) if n}
    assert kept.schema == docs.schema
    assert Counter(r.doc_id for r in kept.collect() if shingle_set(r.text, 5)).keys() == {c for _, c in expected}
    assert kept.filter("trim(text) = '' OR text IS NULL").count() >= 3  # empty texts are nobody's copies


@pytest.mark.parametrize("block", [3, 1024])
def test_groups_are_compared_in_full(spark, monkeypatch, block):
    """Chains in which a leader is similar to few of its group, compared in one block and in many."""
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rng = random.Random(5)
    rows = []
    for c in range(12):
        words = [f"c{c}w{i}" for i in range(120)]
        for _ in range(10):
            words = edited(rng, words, 0.05)
            rows.append((len(rows), " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = jaccard_join.near_copies(docs, jaccard_join.Settings(n=4, percent=70))
    assert by_id(found.select("doc_id", "n_shingles", "component_id").collect()) == by_id(expected_components(rows, 4, 70))


def test_sketches_are_shuffled_once(spark, monkeypatch, plan):
    """Sketches of sets stand in one shuffle on their way to the rows that are compared, and in one of these rows."""
    plans = {}
    write = jaccard_join.write_table
    monkeypatch.setattr(jaccard_join, "write_table", lambda df, path: plans.update({path.rsplit("/", 1)[-1]: plan(df)}) or write(df, path))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        jaccard_join.near_copies(spark.createDataFrame(near_rows(1)[:50], "doc_id long, text string"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for name in ("pairs-2", "pairs-3"):
        shuffled = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", plans[name])
        assert sum("sketch#" in columns for columns in shuffled) == 2 < len(shuffled)


def test_rows_that_repeat_do_not_multiply(spark, monkeypatch):
    """Two similar texts of 300 rows each, of the same ids: one row of each set is compared."""
    base = [f"w{i}" for i in range(200)]
    rows = [(1, " ".join(base)), (2, " ".join([*base[:-2], "x"]))] * 300 + [(3, "something else that is not like them")]
    counted = []
    write = jaccard_join.write_table
    monkeypatch.setattr(jaccard_join, "write_table", lambda df, path: counted.append((path, write(df, path))) or counted[-1][1])
    sizes = []
    linked = jaccard_join._linked
    monkeypatch.setattr(jaccard_join, "_linked", lambda pairs, elements, percent: sizes.append((pairs.count(), elements.count())) or linked(pairs, elements, percent))
    found = jaccard_join.near_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert {(r.doc_id, r.component_id) for r in found} == {(1, 1), (2, 1), (3, 3)} and len(found) == 601
    assert max(e for _, e in sizes) == 2 and max(p for p, _ in sizes) == 1


@pytest.mark.parametrize("block", [16, 1024])
def test_a_large_group_around_the_threshold(spark, monkeypatch, block):
    """Variants of one text, from 0.6 to 0.95 similar with each other, so that many pairs of one group are no links."""
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rng = random.Random(11)
    base = [f"w{i}" for i in range(150)]
    rows = [(i, " ".join(edited(rng, base, rng.choice((0.005, 0.02, 0.03, 0.05))))) for i in range(250)]
    found = jaccard_join.near_copies(spark.createDataFrame(rows, "doc_id long, text string"), jaccard_join.Settings(n=4, percent=85))
    expected = expected_components(rows, 4, 85)
    assert 3 < len({c for *_, c in expected}) < 200
    assert by_id(found.select("doc_id", "n_shingles", "component_id").collect()) == by_id(expected)


def test_a_forest_joins_what_all_pairs_join():
    rng = np.random.default_rng(2)
    n = np.full(60, 40, np.int64)
    bases = rng.integers(0, 1 << 62, (4, jaccard_join.WORDS), dtype=np.uint64)
    sketches = bases[rng.integers(0, 4, 60)] ^ (np.uint64(1) << rng.integers(0, 60, (60, jaccard_join.WORDS), dtype=np.uint64)) * (
        rng.random((60, jaccard_join.WORDS)) < 0.13)
    columns = (np.arange(60, dtype=np.int32) // 2, n, sketches)
    every = list(jaccard_join.close_pairs(columns, columns, 80, False))
    some = list(jaccard_join.close_pairs(columns, columns, 80, True))
    assert set(some) <= set(every) and len(some) < 30 < len(every)

    def parts(pairs):
        label = list(columns[0])
        for i, j in pairs:
            label = [label[i] if x == label[j] else x for x in label]
        return len(set(label))
    assert parts(some) == parts(every)


@given(st.lists(st.sets(st.integers(0, 40), min_size=1, max_size=30), min_size=2, max_size=12))
def test_sketches_rule_out_no_similar_pair(sets):
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    columns = (np.arange(len(sets)), np.array([len(s) for s in sets]), np.stack([jaccard_join.sketch(a) for a in arrays]))
    found = set(jaccard_join.close_pairs(columns, columns, 80))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j and 100 * len(a & b) >= 80 * len(a | b):
                assert (i, j) in found


@given(st.sets(st.integers(0, 2**64 - 1), min_size=1, max_size=400), st.data())
@settings(max_examples=200, deadline=None)
def test_similar_sets_share_keys(elements, data):
    """The pigeonhole: sets above the similarity have more keys in common than ``spare``."""
    drop = data.draw(st.sets(st.sampled_from(sorted(elements)), max_size=len(elements) - 1))
    add = data.draw(st.sets(st.integers(0, 2**64 - 1), max_size=12))
    a, b = set(elements), (set(elements) - drop) | add
    one = jaccard_join.Settings(percent=80)
    if 100 * len(a & b) >= one.percent * len(a | b):
        bands = jaccard_join.Bands(one)
        keys = [set(bands.keys(np.array(sorted(s), np.uint64)).tolist()) for s in (a, b)]
        met = Counter(key & 63 for key in keys[0] & keys[1])
        needs = [{row["band"]: row["need"] for row in bands.needs(np.array(sorted(s), np.uint64))} for s in (a, b)]
        assert any(n >= max(need[band] for need in needs) for band, n in met.items() if all(band in need for need in needs))


@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 9)), max_size=12))
def test_parity_sketches_bound_the_difference(pairs):
    """Parts of two sets' sketches differ in no more places than the sets do."""
    bands = jaccard_join.Bands(jaccard_join.Settings())
    a, b = ({x * 7919 << 32 for x, _ in pairs} or {1}), ({y * 7919 << 32 for _, y in pairs} or {1})
    if bands.of(len(a))[0] == bands.of(len(b))[0]:
        parts = bands.parts(bands.of(len(a))[0])[0]
        value = [Counter() for _ in range(2)]
        for out, s in zip(value, (a, b)):
            for x in s:
                out[(x >> 32) % parts] ^= x + 1
        assert sum(value[0][p] != value[1][p] for p in range(parts)) <= len(a ^ b)


@pytest.mark.parametrize("links", [
    [(1, 2), (2, 3), (3, 4), (10, 9)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 50)] + [(70, 71)],
    [(5, 5), (1, 1)], []])
def test_components(spark, links):
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    expected = {}
    for a, b in links:
        if a != b:
            expected |= {a: {a, b} | expected.get(a, set()), b: {a, b} | expected.get(b, set())}
    for _ in range(80):
        for node, near in expected.items():
            expected[node] = set().union(near, *(expected[x] for x in near))
    assert found == {node: min(near) for node, near in expected.items()}


# mixing

def shares(sizes, ratio=1.5, most=2.0, weights=mixing.WEIGHTS):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    full, total = set(), ratio * sum(sizes.values())
    while True:
        rest = [s for s in names if s not in full]
        level = (total - sum(most * sizes[s] for s in full)) / sum(weight[s] for s in rest) if rest else 0
        above = {s for s in rest if weight[s] * level >= most * sizes[s]}
        if not above:
            return {s: most * sizes[s] if s in full else weight[s] * level for s in names}
        full |= above


@pytest.mark.parametrize("ratio", [0.0, 0.3, 1.0, 1.5, 2.0])
def test_mix(documents, ratio):
    rng = random.Random(1)
    rows = [(i, " ".join("w" for _ in range(rng.randrange(30))), rng.choice("abcdefg") if i % 3 else "hot") for i in range(600)]
    rows += TEXTS[:9] + TEXTS[11:]
    docs = documents(rows)
    found = mixing.mix(docs, ratio=ratio)
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len([w for w in WHITE.split(text or "") if w])
    taken, target, largest = defaultdict(int), {}, defaultdict(int)
    result = found.select("_row.source", "size", "source_size", "target", "copies", "taken").collect()
    assert len(result) == len(rows)
    for r in result:
        taken[r.source] += r.taken
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], r.size)
        assert r.source_size == sizes[r.source] and r.taken == r.copies * r.size <= 2 * r.size
    expected = shares(sizes, ratio)
    for source, total in taken.items():
        assert target[source] == pytest.approx(expected[source])
        assert abs(total - target[source]) <= largest[source] / 2 + 1e-9
    again = mixing.mix(documents(rows), ratio=ratio).select("_row.doc_id", "_row.text", "taken").collect()
    assert by_id(again) == by_id(found.select("_row.doc_id", "_row.text", "taken").collect())


@pytest.mark.parametrize("rows, turns", [
    ([(i, " ".join(["12345"] * (1 + i % 7)) + (" word" * (i % 50) if i % 3 else ""), ("a", "b", None)[i % 3]) for i in range(400)], 2),
    ([(7, "7 7 7", "d")] * 40 + [(i, "some 1", "d") for i in range(9)], 6)])
def test_mix_of_parted_ranges(documents, monkeypatch, rows, turns):
    """Sources of digits, whose keys are large, and equal keys: ranges are parted until one row, or equal keys, are sorted, with the same result."""
    columns = "_row.doc_id", "_row.source", "size", "target", "taken"
    whole = sorted(mixing.mix(documents(rows), ratio=0.7).select(*columns).collect(), key=str)
    plans = []
    monkeypatch.setattr(mixing, "materialize", lambda df, label: plans.append(materialize(df, label)) or plans[-1])
    monkeypatch.setattr(mixing, "BUCKETS", 64)
    monkeypatch.setattr(mixing, "SORTED", 1)
    assert sorted(mixing.mix(documents(rows), ratio=0.7).select(*columns).collect(), key=str) == whole
    ends = plans[0].collect()
    assert all(r["rows"] <= 1 or r["width"] <= mixing.NARROW for r in ends)
    assert max(len(r["cuts"]) for r in ends) >= turns


def test_mixed_rows(documents):
    docs = documents()
    mixed = mixing.mixed_rows(docs)
    assert mixed.schema == docs.schema
    copies = mixing.mix(docs).agg(F.sum("copies")).first()[0]
    assert mixed.count() == copies
    assert mixing.mixed_rows(documents([])).count() == mixing.mix(documents([])).count() == 0
    assert [r.taken for r in mixing.mix(documents([(1, None, None), (2, "", "a")])).collect()] == [0, 0]


def test_heavy_documents_come_early(documents):
    rows = [(i, "plain words only here" if i % 2 else "#### %%%% 1234 $$$$", "a") for i in range(2000)]
    chosen = mixing.mix(documents(rows), ratio=0.5).filter("copies > 0").collect()
    plain = sum(r["_row"].doc_id % 2 for r in chosen)
    assert len(chosen) == 1000 and plain > 800


# licences

def naive_scan(text, settings=license_scan.Settings()):
    scanner = license_scan.Scanner(license_scan.PHRASES, license_scan.TEMPLATES, settings)
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    sequences = [license_scan.words_of(t.encode()) for t in [*license_scan.PHRASES, *(t for _, t in license_scan.TEMPLATES)]]
    data = [w.encode() for w in words]
    places, matches = [], []
    for t, sequence in enumerate(sequences):
        least = scanner.automaton.least[t]
        for shift in range(-len(data), len(sequence) + 1):
            first = None
            for at in range(len(data) + 1):
                same = at < len(data) and 0 <= at + shift < len(sequence) and data[at] == sequence[at + shift]
                if same and first is None:
                    first = at
                elif not same and first is not None:
                    if at - first >= least:
                        matches.append(((t, shift), (first, at - 1)))
                        if t < len(license_scan.PHRASES) and at - first == len(sequence):
                            places.append((first, t))
                    first = None
    pairs = {(t, at, at + shift) for (t, shift), (first, last) in matches for at in range(first, last + 1)}
    return len(words), sorted(places), longest_chains(pairs, settings.gap)


def longest_chains(pairs, gap):
    """Words of the best chain of each template: any two words in order may follow each other if they are near enough."""
    longest = {}
    for t, at, place in sorted(pairs):
        before = [n for (u, x, y), n in longest.items() if u == t and 0 < at - x <= gap + 1 and 0 < place - y <= gap + 1]
        longest[t, at, place] = 1 + max(before, default=0)
    best = defaultdict(int)
    for (t, _, _), n in longest.items():
        best[t] = max(best[t], n)
    return dict(best)


def best_spans(spans):
    best = defaultdict(int)
    for t, first, last, covered in spans:
        assert first <= last and covered <= last - first + 1
        assert all(last < a or b < first for u, a, b, _ in spans if u == t and (a, b) != (first, last))
        best[t] = max(best[t], covered)
    return dict(best)


ODD_LICENSES = [
    "Licensed under the Apache License, Version 2.0", "MIT license mit LICENSE", "the gnu general public gnu general public license",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of THIS library and associated documentation files",
    "cc by cc cc by by", "of the of the of the license version", "", "license", "x " * 300 + "apache license " * 40,
    "Redistribution and use in source and binary forms with modification are permitted provided that the following conditions",
    "é mit license東京 mit東 license"]


@pytest.mark.parametrize("text", ODD_LICENSES)
def test_scan_against_every_diagonal(text):
    scanner = license_scan.Scanner(license_scan.PHRASES, license_scan.TEMPLATES, license_scan.Settings())
    n, places, spans = scanner.scan(text.encode())
    assert (n, sorted(places), best_spans(spans)) == naive_scan(text)


WORDS = sorted({w.decode() for _, t in license_scan.TEMPLATES for w in license_scan.words_of(t.encode())} | {"foo", "cc", "mit"})


@given(st.lists(st.sampled_from([*WORDS, *license_scan.PHRASES, *(t for _, t in license_scan.TEMPLATES)]), max_size=25))
@settings(max_examples=80, deadline=None)
def test_scan_of_random_words(words):
    text = " ".join(words)
    scanner = license_scan.Scanner(license_scan.PHRASES, license_scan.TEMPLATES, license_scan.Settings())
    n, places, spans = scanner.scan(text.encode())
    assert (n, sorted(places), best_spans(spans)) == naive_scan(text)


GRANT = dict(license_scan.TEMPLATES)["gpl-grant"]
APACHE = dict(license_scan.TEMPLATES)["apache-grant"]


@pytest.mark.parametrize("text, label", [
    (GRANT.replace("redistribute it", "redistribute your option any it"), "gpl-grant"),
    (" ".join(GRANT.split()[-7:]) + " " + GRANT, "gpl-grant"),
    (GRANT + " " + " ".join(GRANT.split()[:7]), "gpl-grant"),
    (APACHE.replace("compliance with", "compliance of the License with"), "apache-grant"),
    (APACHE.replace("may not use", "apache license version may not use"), "apache-grant")])
def test_words_of_its_own_inside_keep_a_label(text, label):
    scanner = license_scan.Scanner(license_scan.PHRASES, license_scan.TEMPLATES, license_scan.Settings())
    row = scanner.row(text.encode())
    assert label in row[5].split(",") and row[6] >= 0.95


def test_every_template_gives_its_label():
    scanner = license_scan.Scanner(license_scan.PHRASES, license_scan.TEMPLATES, license_scan.Settings())
    for label, text in license_scan.TEMPLATES:
        assert label in scanner.row(f"some words {text} and others".encode())[5].split(",")
    many = scanner.scan((" and so on ".join([APACHE] * 50)).encode())[2]
    whole = [(first, last) for t, first, last, covered in many if scanner.labels[t] == "apache-grant" and covered == scanner.sizes[t]]
    assert len(whole) == 50 and all(b < c for (_, b), (c, _) in zip(whole, whole[1:]))


def test_license_scan(documents):
    rows = license_scan.license_scan(documents()).collect()
    found = {r.doc_id: r for r in rows}
    assert len(rows) == len(TEXTS) and found[12].base_labels == "apache,cc-by,mit" and "apache-notice" in found[12].labels
    assert (found[12].n_base, found[12].first_word, found[12].last_word, found[12].score) == (4, 3, 12, 1.0)
    assert (found[5].n_words, found[5].n_base, found[5].first_word, found[5].labels, found[5].score) == (0, 0, None, "", 0.0)
    assert all(0 <= r.score <= 1 for r in rows) and found[12].spans[0].label
    assert license_scan.license_scan(documents([])).collect() == []
