"""Top-k search against brute force."""

import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from sluice.llm import cover_tree
from sluice.llm.cover_tree import CoverTree, Search, top_k


def expected(rows, k, every):
    vectors = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v):
            vectors[i, tuple(int(np.floor(256 * float(np.float32(x)))) for x in v)] = None
    out = []
    for i, v in vectors:
        if i % every == 0:
            found = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in vectors if j != i and len(w) == len(v))
            out.extend((i, rank + 1, j, -score) for rank, (score, j) in enumerate(found[:k]))
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "clash") for i, v in rows], "vec_id long, embedding array<float>, data string")


@pytest.mark.parametrize("block", [7, 50, 5000])
def test_top_k(spark, block):
    rng = random.Random(block)
    centers = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(6)]
    rows = [(i, [x + rng.gauss(0, 0.1) for x in centers[i % 6]]) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(60)]  # ties
    found = sorted(map(tuple, top_k(frame(spark, rows), k=5, every=10, block=block).collect()))
    assert found == expected(rows, 5, 10)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (50, None), (100, [nan, 1.0]), (150, [inf, 1.0]), (200, [None, 1.0]), (250, []), (None, [1.0, 1.0]),
            (300, [1.0, 2.0, 3.0]), (1, [0.5, -0.5]), (2, [-1.0, 3.0]), (2, [-1.0, 3.0]), (0, [1.0, 2.0]), (-50, [0.001, -0.001]), (7, [1.0, 2.0])]
    assert sorted(map(tuple, top_k(frame(spark, rows)).collect())) == expected(rows, 5, 50)
    assert top_k(frame(spark, [])).collect() == []
    assert top_k(frame(spark, [(0, [1.0])])).collect() == []


@given(st.lists(st.lists(st.integers(-300, 300), min_size=3, max_size=3), min_size=1, max_size=120))
@settings(max_examples=40, deadline=None)
def test_tree_is_a_cover_tree(points):
    points = np.array(points, float)
    tree = CoverTree.from_bytes(CoverTree(points, np.arange(len(points))).to_bytes())
    assert sorted(tree.ids.tolist()) == list(range(len(points))) and (tree.points == points[tree.ids]).all()
    for n in range(len(tree.radii)):
        own = tree.points[tree.starts[n] : tree.ends[n]]
        assert np.isclose(np.sqrt(((own - tree.centers[n]) ** 2).sum(1)).max(), tree.radii[n], atol=1e-5)
        below = tree.children[tree.first[n] : tree.first[n + 1]]
        if len(below):
            cover = cover_tree.BASE ** (np.ceil(np.log(tree.radii[n]) / np.log(cover_tree.BASE)) - 1)
            centers = tree.centers[below]
            apart = np.sqrt(((centers[:, None] - centers[None]) ** 2).sum(2))[~np.eye(len(below), dtype=bool)]
            assert (tree.radii[below] <= cover + 1e-6).all() and (apart > cover - 1e-6).all()  # covering, separation
            assert (centers[0] == tree.centers[n]).all()  # nesting
            assert tree.starts[below[0]] == tree.starts[n] and tree.ends[below[-1]] == tree.ends[n]


def test_bounds_prune(spark):
    """Far clusters are never compared point by point."""
    random_ = np.random.default_rng(1)
    centers = random_.normal(0, 200, (40, 16))
    points = np.rint(np.repeat(centers, 100, 0) + random_.normal(0, 4, (4000, 16)))
    compared = []

    class Counted(Search):
        def _compare(self, node, own):
            compared.append(len(own) * (self.q.ends[node] - self.q.starts[node]))
            super()._compare(node, own)

    queries = CoverTree.from_bytes(CoverTree(points[::20], np.arange(0, 4000, 20), cover_tree.GROUP).to_bytes())
    data = CoverTree.from_bytes(CoverTree(points, np.arange(4000)).to_bytes())
    found = Counted(queries, data, 5)
    exact = queries.points @ data.points.T
    exact[queries.ids[:, None] == data.ids[None]] = -np.inf
    assert (np.sort(exact, 1)[:, :-6:-1] == found.scores).all()
    assert sum(compared) < 0.3 * exact.size


def merged(rows, k, every):
    """As ``expected``, where ids repeat: every row of an id is asked and answers, but a pair of ids and a score counts once."""
    vectors, out = {(i, tuple(int(np.floor(256 * x)) for x in v)) for i, v in rows}, []
    for i in {i for i, _ in vectors if i % every == 0}:
        found = {(-sum(a * b for a, b in zip(v, w)), j) for q, v in vectors if q == i for j, w in vectors if j != i and len(w) == len(v)}
        out.extend((i, rank + 1, j, -score) for rank, (score, j) in enumerate(sorted(found)[:k]))
    return sorted(out)


@pytest.mark.parametrize("block", [9, 5000])
def test_repeated_ids(spark, block):
    rng = random.Random(block)
    rows = [(i % 70, [rng.randrange(-2, 3) / 256 for _ in range(3 + i % 2)]) for i in range(600)]  # few vectors: many equal scores
    assert sorted(map(tuple, top_k(frame(spark, rows), k=4, every=5, block=block).collect())) == merged(rows, 4, 5)


def test_long_vectors_are_exact(spark):
    """Products that single floats don't hold, beside those that they do."""
    rng = random.Random(4)
    rows = [(i, [float(rng.randrange(-(2**length), 2**length)) / 256 for _ in range(6)]) for i in range(400) for length in [(4, 11, 22)[i % 3]]]
    assert sorted(map(tuple, top_k(frame(spark, rows), every=10, block=60).collect())) == expected(rows, 5, 10)


@given(st.integers(0, 10_000), st.integers(1, 7), st.sampled_from([1, 3, 300]))
@settings(max_examples=25, deadline=None)
def test_search_of_many_trees(seed, k, spread):
    """The trees met one after the other give what all points give at once, whether bounds or products decide."""
    rng = np.random.default_rng(seed)
    sizes = rng.integers(1, 400, rng.integers(1, 9))
    centers = rng.integers(-spread * 20, spread * 20 + 1, (5, 4))
    points = (centers[rng.integers(0, 5, sizes.sum())] + rng.integers(-spread, spread + 1, (sizes.sum(), 4))).astype(float)
    ids = rng.integers(0, 150, len(points))
    asked = rng.permutation(len(points))[:90]
    search = Search(CoverTree.from_bytes(CoverTree(points[asked], ids[asked], cover_tree.GROUP).to_bytes()), None, k)
    for part in np.split(np.arange(len(points)), np.cumsum(sizes)[:-1]):
        search.meet(CoverTree.from_bytes(CoverTree(points[part], ids[part]).to_bytes()))
    for query, own, scores, found in zip(search.q.points.astype(float), search.q.ids, search.scores, search.ids):
        best = sorted({(-int(s), int(i)) for s, i in zip(points @ query, ids) if i != own})[:k]
        assert [(-int(s), int(i)) for s, i in zip(scores, found) if s > cover_tree.NONE] == best


def test_number_of_tasks_has_a_limit(spark, name):
    """The driver holds something of every task: many blocks are dealt out to few of them."""
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(300)]
    spark.sparkContext.setJobGroup(name, name)
    try:
        found = sorted(map(tuple, top_k(frame(spark, rows), every=10, block=1).collect()))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert found == expected(rows, 5, 10)
    status = spark.sparkContext.statusTracker()
    stages = [status.getStageInfo(s) for j in status.getJobIdsForGroup(name) for s in status.getJobInfo(j).stageIds]
    assert max(s.numTasks for s in stages if s) <= 300  # 9,000 pairs of blocks


@pytest.mark.parametrize("rows, every", [(500, 50), (15_000_000, 50), (20_000_000, 50), (20_000_000, 1), (2_000_000_000, 50)])
def test_layout(rows, every):
    asked = rows // every
    n, q, held = -(-rows // 2048), -(-asked // 2048), asked * (4 * 64 + 16 * 5 + 64)
    wide, tall = cover_tree.layout(n, q, held, 6)
    assert 1 <= wide <= q and 1 <= tall <= n and wide * tall <= cover_tree.TASKS
    assert held / wide <= cover_tree.HELD  # what a task holds at once
    assert wide * tall >= min(12, n * q // cover_tree.PAIRS)
    assert tall * q <= max(1.5 * n, 18 * q / wide + q)  # copies of the query blocks
