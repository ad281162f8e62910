"""Exact top-k search by inner product with two cover trees, one of the queries and one of the data, in blocks."""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from sluice.llm.common import give_back

#: Most rows of a block; a block's tree and its distances stay in one task's memory.
BLOCK = 2048
#: Ratio of the radii of two levels.
BASE = 1.3
#: Points below which a node isn't divided, of the data and of the queries: small groups of queries prune more.
LEAF, GROUP = 64, 8
#: Nodes of the data that a query group looks at before it prunes again.
STEP = 64
#: Share of pairs of points whose bounds don't rule them out, from which they are all compared by one matrix product.
DENSE = 0.25
#: Queries whose products with a block are looked at together.
ROWS = 256
#: Points of the first tree that every query is compared with before any bound, spread over the tree.
FIRST = 256
#: Times k of a query's points that are worth telling the k best from before they are sorted.
MANY = 32
#: Most data blocks in a row that a query block is compared with whole, after bounds that ruled out less than half.
PAUSE = 63
#: Bytes of query blocks and their results that a task holds.
HELD = 96 << 20
#: Pairs of blocks that a task is worth.
PAIRS = 64
#: Query blocks are copied for at most so many tasks that they come to this multiple of the data blocks, where that leaves tasks enough.
COPIES = 1.5
#: Most tasks that pairs of blocks are dealt out to; the driver holds something of each.
TASKS = 2000
#: Below every score, and has a negative.
NONE = np.iinfo(np.int64).min + 1


def _distances(points: np.ndarray) -> np.ndarray:
    norms = (points * points).sum(1)
    apart = points @ points.T
    apart *= -2
    apart += norms[:, None]
    apart += norms
    return np.sqrt(np.maximum(apart, 0, out=apart), out=apart)


class CoverTree:
    """A cover tree over the rows of ``points``: children of a node lie within its radius, cover its points within the next
    smaller power of ``BASE``, and their centres are further apart than that; one child has the node's own centre.

    Nodes are numbered from the root (0); ``start`` and ``end`` tell a node's points in ``points``, which is
    reordered so that they stand together. Points that are all equal form one leaf, however many they are.
    """

    def __init__(self, points: np.ndarray, ids: np.ndarray, leaf: int = LEAF):
        apart = _distances(points)
        order: list[np.ndarray] = []
        centers, radii, starts, ends, children = [], [], [], [], []

        def node(members: np.ndarray, center: int) -> int:
            number, radius = len(centers), float(apart[center, members].max())
            centers.append(center)
            radii.append(radius)
            starts.append(sum_of[0])
            ends.append(0)
            children.append([])
            if len(members) <= leaf or radius == 0:
                order.append(members)
                sum_of[0] += len(members)
            else:
                cover = BASE ** (np.ceil(np.log(radius) / np.log(BASE)) - 1)
                rest, middle = members, center
                while len(rest):
                    near = apart[middle, rest] <= cover
                    children[number].append(node(rest[near], middle))
                    rest = rest[~near]
                    middle = rest[0] if len(rest) else -1
            ends[number] = sum_of[0]
            return number

        sum_of = [0]
        node(np.arange(len(points)), 0)
        placed = np.concatenate(order)
        self.points, self.ids = points[placed], ids[placed]
        self.at = np.argsort(placed)[centers].astype(np.int32)  # where the centres stand in points
        self.radii, self.starts, self.ends = np.array(radii), np.array(starts, np.int32), np.array(ends, np.int32)
        self.first = np.cumsum([0, *map(len, children)], dtype=np.int32)
        self.children = np.array([c for own in children for c in own], np.int32)

    FIELDS = ("at", "points", "ids", "radii", "starts", "ends", "first", "children")

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{name: getattr(self, name) for name in self.FIELDS} | {"points": _narrow(self.points)})
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> CoverTree:
        tree = cls.__new__(cls)
        with np.load(io.BytesIO(data)) as arrays:
            for name in cls.FIELDS:
                setattr(tree, name, arrays[name])
        squares = np.einsum("ij,ij->i", tree.points, tree.points, dtype=np.float64)
        # whole numbers, of which every sum of a product's terms is one below 2 ** 24, where both sides are so short: single floats hold it
        short = tree.points.dtype.kind == "i" and squares.max(initial=0) < 2**24
        tree.points = tree.points.astype(np.float32 if short else np.float64)
        tree.norms = np.sqrt(squares)[tree.at]
        tree.leaf = tree.first[1:] == tree.first[:-1]
        tree.leaves = np.flatnonzero(tree.leaf)  # in the order of their points
        tree.room = None
        tree.unique = len(np.unique(tree.ids)) == len(tree.ids)
        return tree

    @property
    def centers(self) -> np.ndarray:
        return self.points[self.at]

    def products(self, queries: np.ndarray, points: np.ndarray) -> np.ndarray:
        """Products of at most ``ROWS`` queries with points of this tree, always in the same place: new memory costs half as much as the products."""
        kind, shape = np.result_type(queries, points), (len(queries), len(points))
        if self.room is None or self.room.dtype != kind:
            self.room = np.empty(ROWS * len(self.points), kind)
        return np.matmul(queries, points.T, out=self.room[: shape[0] * shape[1]].reshape(shape))

    def below(self, nodes: np.ndarray) -> np.ndarray:
        """Children of the nodes."""
        return np.concatenate([self.children[self.first[n] : self.first[n + 1]] for n in nodes])

    def leaves_of(self, nodes: np.ndarray) -> np.ndarray:
        """Leaves below the nodes or among them."""
        starts = self.starts[self.leaves]
        first, last = np.searchsorted(starts, self.starts[nodes]), np.searchsorted(starts, self.ends[nodes])
        return self.leaves[_ranges(first, last)]

    def sizes(self, nodes: np.ndarray) -> np.ndarray:
        return (self.ends[nodes] - self.starts[nodes]).astype(np.int64)


def _narrow(points: np.ndarray) -> np.ndarray:
    """The same numbers in fewer bytes, if they are small whole ones."""
    for kind in (np.int8, np.int16, np.int32):
        limits = np.iinfo(kind)
        if not points.size or limits.min <= points.min() and points.max() <= limits.max:
            narrow = points.astype(kind)
            return narrow if (narrow == points).all() else points
    return points


def _ranges(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The numbers from each first to before its last, one range after the other."""
    lengths = (last - first).astype(np.int64)
    return np.repeat(last - np.cumsum(lengths), lengths) + np.arange(lengths.sum())


class Search:
    """The k best points for each query of one tree among those of the trees that it meets, by score, then smaller id.

    Points of one id and score count once. What was found in one tree bounds the search in the next.
    """

    def __init__(self, queries: CoverTree, data: CoverTree | None, k: int):
        self.q, self.k = queries, k
        n = len(queries.points)
        self.scores = np.full((n, k), NONE, np.int64)
        self.ids = np.full((n, k), np.iinfo(np.int64).max, np.int64)
        self.pairs = 0  # node pairs looked at
        self.compared = 0  # pairs of points
        self.pause = self.wait = 0
        self.begun = False
        if data is not None:
            self.meet(data)

    def meet(self, data: CoverTree) -> None:
        """Search another tree."""
        self.p = data
        whole = len(self.q.points) * len(data.points)
        if not whole:
            return
        if self.wait:
            self.wait -= 1
            self._compare(0, np.arange(len(data.points)))
            return
        if not self.begun:
            self._begin()
            self.begun = True
        before = self.compared
        self._both(0, np.array([0]))
        # trees in which the bounds rule out little seldom come alone
        self.pause = min(2 * self.pause + 1, PAUSE) if self.compared - before > whole / 2 else 0
        self.wait = self.pause

    def _begin(self) -> None:
        """A first k-th score for each query, from points all over the tree."""
        n = len(self.p.points)
        self._compare(0, np.arange(0, n, max(1, n // FIRST)))

    def _bounds(self, node: int, nodes: np.ndarray) -> np.ndarray:
        """No query below the node has a larger product with a point below the nodes than this."""
        return self._all_bounds(np.array([node]), nodes)[0]

    def _all_bounds(self, groups: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """The bounds of each node of the queries with each of the data's."""
        q, p = self.q, self.p
        self.pairs += len(groups) * len(nodes)
        bound = (q.points[q.at[groups]] @ p.points[p.at[nodes]].T).astype(np.float64)
        rq, rp = q.radii[groups, None], p.radii[nodes]
        bound += rq * p.norms[nodes] + rp * q.norms[groups, None] + rq * rp
        return bound + 1e-9 * (1 + np.abs(bound))  # the roots are rounded

    def _worst(self, node: int) -> int:
        """The group's worst k-th score; nothing below it can matter to any of its queries."""
        return int(self.scores[self.q.starts[node] : self.q.ends[node], -1].min())

    def _both(self, node: int, nodes: np.ndarray) -> None:
        q, p = self.q, self.p
        bounds = self._bounds(node, nodes)
        nodes = nodes[bounds >= self._worst(node)]
        if not len(nodes):
            return
        if q.leaf[node]:
            self._leaf(node, nodes)
            return
        points = self._dense(node, nodes)
        if points is not None:
            self._compare(node, points)
            return
        coarse = ~p.leaf[nodes] & (p.radii[nodes] > q.radii[node])
        if coarse.any():
            nodes = np.concatenate([nodes[~coarse], p.below(nodes[coarse])])
        for child in q.children[q.first[node] : q.first[node + 1]]:
            self._both(int(child), nodes)

    def _dense(self, node: int, nodes: np.ndarray) -> np.ndarray | None:
        """The points below the nodes that any query below the node needs, if a fair share of all pairs of both is needed."""
        q, p = self.q, self.p
        groups, parts = q.leaves_of(np.array([node])), p.leaves_of(nodes)
        worst = np.minimum.reduceat(self.scores[q.starts[node] : q.ends[node], -1], q.starts[groups] - q.starts[node])
        needed = self._all_bounds(groups, parts) >= worst[:, None]
        sizes, some = p.sizes(parts), needed.any(0)
        if q.sizes(groups) @ (needed @ sizes) < DENSE * int(q.ends[node] - q.starts[node]) * sizes[some].sum():
            return None
        parts = parts[some]
        return _ranges(p.starts[parts], p.ends[parts])

    def _leaf(self, node: int, nodes: np.ndarray) -> None:
        p = self.p
        bounds = self._bounds(node, nodes)
        while True:
            open_ = bounds >= self._worst(node)
            nodes, bounds = nodes[open_], bounds[open_]
            if not len(nodes):
                return
            best = np.argsort(-bounds, kind="stable")
            now, nodes, bounds = nodes[best[:STEP]], nodes[best[STEP:]], bounds[best[STEP:]]
            leaves, inner = now[p.leaf[now]], now[~p.leaf[now]]
            if len(leaves):
                self._compare(node, np.concatenate([np.arange(p.starts[n], p.ends[n]) for n in leaves]))
            if len(inner):
                more = p.below(inner)
                nodes = np.concatenate([nodes, more])
                bounds = np.concatenate([bounds, self._bounds(node, more)])

    def _compare(self, node: int, points: np.ndarray) -> None:
        q, p = self.q, self.p
        first, last = int(q.starts[node]), int(q.ends[node])
        self.compared += (last - first) * len(points)
        if not len(points):
            return
        data, ids = (p.points, p.ids) if len(points) == len(p.points) else (p.points[points], p.ids[points])
        found = []
        for at in range(first, last, ROWS):
            own = slice(at, min(at + ROWS, last))
            score, worst = p.products(q.points[own], data), self.scores[own, -1]
            hot = np.flatnonzero(score.max(1) >= worst)
            if not len(hot):
                continue
            score, least = score if len(hot) == len(score) else score[hot], worst[hot, None].astype(score.dtype)
            needed = score >= least
            if p.unique and len(points) > self.k and np.count_nonzero(needed) > MANY * self.k * len(hot):
                score[ids == q.ids[own][hot, None]] = -np.inf
                needed = score >= np.maximum(least, np.partition(score, -self.k, 1)[:, -self.k, None])
            row, column = np.divmod(np.flatnonzero(needed), len(points))
            score, row, other = np.rint(score[row, column]).astype(np.int64), hot[row], ids[column]
            better = (score > worst[row]) | (score == worst[row]) & (other < self.ids[own, -1][row])
            better &= other != q.ids[own][row]
            found.append((row[better] + at, score[better], other[better]))
        if found:
            self._keep(*map(np.concatenate, zip(*found)))

    def _keep(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Put found points in their places among the k best of their queries."""
        if not len(rows):
            return
        own = np.unique(rows)
        rows = np.concatenate([np.repeat(own, self.k), rows])
        scores = np.concatenate([self.scores[own].ravel(), scores])
        ids = np.concatenate([self.ids[own].ravel(), ids])
        order = np.lexsort((ids, -scores, rows))
        rows, scores, ids = rows[order], scores[order], ids[order]
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:] != rows[:-1]) | (scores[1:] != scores[:-1]) | (ids[1:] != ids[:-1])
        rows, scores, ids = rows[new], scores[new], ids[new]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        top = place < self.k
        self.scores[own], self.ids[own] = NONE, np.iinfo(np.int64).max
        self.scores[rows[top], place[top]], self.ids[rows[top], place[top]] = scores[top], ids[top]


def finite(vector: Column) -> Column:
    """Whether all components are finite numbers; null for no vector."""
    limit = float("inf")
    return F.forall(vector.cast("array<double>"), lambda v: v.isNotNull() & (v < limit) & (v > -limit))


def whole(vector: Column) -> Column:
    """floor(256 * x) of every component."""
    return F.transform(vector.cast("array<double>"), lambda v: F.floor(v * 256.0).cast("double"))


def _trees(vectors: DataFrame, blocks: int, block: int, leaf: int) -> DataFrame:
    """Cover trees of at most ``block`` distinct rows of one vector length each, and a number by which they can be dealt out.

    Blocks are cut from the tasks' sorted rows, so that a task that runs again cuts the same.
    """
    def build(batches):
        schema = pa.schema([("number", pa.int32()), ("tree", pa.binary())])
        number, size, taken, held = TaskContext.get().partitionId(), 0, 0, []

        def tree():
            tree = CoverTree(np.concatenate([points for points, _ in held]), np.concatenate([ids for _, ids in held]), leaf)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([tree.to_bytes()], pa.binary())], schema=schema)

        for batch in batches:
            ids, column = batch.column("vec_id").to_numpy(), batch.column("vector")
            flat, lengths = column.flatten().to_numpy(zero_copy_only=False), pc.list_value_length(column).to_numpy()
            starts = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
            at = 0
            while at < len(ids):
                if held and (lengths[at] != size or taken == block):
                    yield tree()
                    number, taken = number + 1, 0
                size = int(lengths[at])
                same = at + int(np.argmin(np.append(lengths[at:] == size, False)))
                end = min(same, at + block - taken)
                held.append((flat[starts[at] : starts[end]].reshape(-1, size), ids[at:end]))
                at, taken = end, taken + end - at
        if held:
            yield tree()

    rows = vectors.distinct().coalesce(blocks).select("vec_id", "vector", F.size("vector").alias("size"))
    return rows.sortWithinPartitions("size", "vec_id", "vector").select("vec_id", "vector").mapInArrow(build, "number int, tree binary")


def layout(n: int, q: int, held: int, parallel: int) -> tuple[int, int]:
    """Into how many groups the query blocks and the data blocks are dealt. A task searches a group of the one in a group of the other.

    ``held``: bytes of all query blocks and their results; ``parallel``: tasks that run at once. Every data block is copied
    for each group of query blocks and the other way round, so the groups are few and large, as far as a task's memory allows.
    """
    wide = min(q, max(1, -(-held // HELD)))
    fair = max(int(COPIES * n / q), -(-3 * parallel // wide))
    return wide, max(1, min(n, -(-n * q // (PAIRS * wide)), fair, TASKS // wide))


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id and score of the k best rows for each row whose vec_id is divisible by ``every``.

    The score is the integer inner product of floor(256 * x). Ties go to the smaller vec_id. Rows are spread over
    blocks by hash, each block is indexed by a cover tree once, and so are the queries. Every pair of a query block and a
    data block is searched by both trees together: a pair of nodes is dropped when its bound, from the centres and
    covering radii, is below the worst k-th score in the query group. Where the bounds rule out little, all points are compared
    by matrix products. A task searches a group of data blocks for a group of query blocks, one tree after the other, with the
    scores found so far; the number of tasks has a limit. The tasks' results are merged by rank.

    Vectors that are null, empty or hold null or non-finite components take no part; vectors of another length are
    no candidates; rows with a null id are none either. Rows that share the query's id count as its own; a query that
    repeats is answered once. Products are exact up to 2 ** 53. With fewer candidates than k all are given; an empty table
    gives an empty result. Other columns don't matter.
    """
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    rows = rows.filter(F.col("vec_id").isNotNull() & (F.size("embedding") > 0))
    usable = rows.filter(finite(F.col("embedding"))).select("vec_id", whole(F.col("embedding")).alias("vector"))
    asked = F.col("vec_id") % every == 0
    # for the layout alone, so that rows which repeat or aren't usable may count
    size = F.when(asked, F.size("embedding"))
    counts = rows.agg(F.count(F.lit(1)).alias("n"), F.count(size).alias("q"), F.sum(size).alias("values")).first()
    n, q = max(1, -(-counts["n"] // block)), max(1, -(-counts["q"] // block))
    held = 4 * (counts["values"] or 0) + (16 * k + 64) * counts["q"]
    wide, tall = layout(n, q, held, vectors.sparkSession.sparkContext.defaultParallelism)

    def search(batches):
        schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
        cell, searches = None, {}

        def results():
            for found in (found for same in searches.values() for found in same):
                real = found.scores.ravel() > NONE
                columns = [np.repeat(found.q.ids, k)[real], found.ids.ravel()[real], found.scores.ravel()[real]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)
            searches.clear()

        for batch in batches:
            for i in range(batch.num_rows):
                if batch.column("cell")[i].as_py() != cell:
                    yield from results()
                    cell = batch.column("cell")[i].as_py()
                tree = CoverTree.from_bytes(batch.column("tree")[i].as_py())
                same = searches.setdefault(tree.points.shape[1], [])
                if batch.column("data")[i].as_py():
                    for one in same:
                        one.meet(tree)
                else:
                    same.append(Search(tree, None, k))
        yield from results()
        give_back()

    # blocks, not rows, are paired; in a cell the query blocks stand before the data
    group = F.pmod(F.col("number"), F.lit(wide))
    queries = _trees(usable.filter(asked), q, block, GROUP).select(
        F.explode(F.sequence(group, group + (tall - 1) * wide, F.lit(wide))).alias("cell"), F.lit(False).alias("data"), "tree")
    group = F.pmod(F.col("number"), F.lit(tall)) * wide
    data = _trees(usable, n, block, LEAF).select(
        F.explode(F.sequence(group, group + (wide - 1))).alias("cell"), F.lit(True).alias("data"), "tree")
    cells = queries.unionByName(data).repartitionById(min(wide * tall, TASKS), "cell").sortWithinPartitions("cell", "data")
    found = cells.mapInArrow(search, "query_id bigint, vec_id bigint, score bigint")
    # a row that was found for several rows of its query's id has one rank
    place = F.dense_rank().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score").distinct()
