"""Near copies by n-gram Jaccard similarity: a parity-sketch join with exact verification.

A document's set holds the 64-bit hashes of its distinct word n-grams. A parity sketch flips one bit for each
element, so two sketches differ in at most as many bits as the sets differ in elements. If 100 * intersection >=
s * union, that is at most (a + b) * (100 - s) / (100 + s). Sketches of a size band are cut into more parts than that, so
similar sets agree in some parts (pigeonhole), and parts are join keys. The bits of a part (2 ** 64 of them) aren't stored; a
part is the XOR of its set bits' fingerprints, which tells equal parts from others and follows the parity just so.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from sluice.llm.common import kept, mixed, pieces
from sluice.llm.components import components
from sluice.sources.workspace import materialize, scratch, write_table

#: Documents whose part keys a task brings together before they are shuffled.
TOGETHER = 2048
#: Rows of an Arrow batch on the way out.
ROWS = 1 << 16
#: Sets of a group that are compared with as many others in one step.
BLOCK = 1024
#: 64-bit words of the sketch by which pairs of a group are told apart before their elements are compared.
WORDS = 32
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    """``n``: words of a shingle. ``percent``: least similarity. ``ratio``: largest to smallest size of a band. ``spare``: equal parts that
    similar sets have beyond one, as a share of those that may differ; sets that meet in fewer groups aren't compared.
    ``empty``: parts that sets of any size may have empty before these are keys too, as such a share."""

    n: int = 5
    percent: int = 80
    ratio: float = 1.5
    spare: float = 1 / 16
    empty: float = 0.04


def shingles(data: bytes, n: int) -> np.ndarray:
    """Sorted distinct hashes of a text's n-grams of words; with fewer words, of the whole sequence."""
    words = data.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = min(n, len(words))
    count = len(words) - n + 1
    with np.errstate(over="ignore"):
        found = np.full(count, n, np.uint64)
        for i in range(n):
            found = mixed(found * GOLDEN + hashes[i : i + count])
    found.sort()
    keep = np.ones(count, bool)
    np.not_equal(found[1:], found[:-1], out=keep[1:])
    return found[keep]


def set_id(elements: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit hashes of a set, as signed integers."""
    with np.errstate(over="ignore"):
        first = mixed(elements + GOLDEN).sum(dtype=np.uint64) ^ mixed(np.array([len(elements)], np.uint64))[0]
        second = np.bitwise_xor.reduce(mixed(elements ^ GOLDEN), initial=np.uint64(0))
    return int(first.view(np.int64)), int(second.view(np.int64))


def sketch(elements: np.ndarray) -> np.ndarray:
    """The set's parity sketch: every element flips one bit."""
    bits = np.bincount((mixed(elements ^ np.uint64(1)) % np.uint64(64 * WORDS)).astype(np.int64), minlength=64 * WORDS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.uint64)


def close_pairs(left, right, percent: int, forest: bool = False):
    """Places of pairs of (component, size, sketch) columns that may be similar, in different components.

    Neither sizes nor the sketches' distance, which is no larger than the sets' difference, rule them out. With ``forest`` a pair
    that is handed on counts as a link, and no other is between the components that it joins: fewer pairs than there are sets.
    """
    component, size, sketches = right
    joined = np.arange(1 + max(int(c.max(initial=0)) for c in (component, left[0])))
    for i, (own, n, bits) in enumerate(zip(*left)):
        at = np.flatnonzero((joined[component] != joined[own]) & (100 * np.minimum(size, n) >= percent * np.maximum(size, n)))
        apart = np.bitwise_count(sketches[at] ^ bits).sum(1, dtype=np.int64)
        at = at[apart <= (size[at] + n) * (100 - percent) // (100 + percent)]
        if forest and len(at):
            others, first = np.unique(joined[component[at]], return_index=True)
            at = at[first]
            joined[np.isin(joined, others)] = joined[own]
        for j in at:
            yield i, int(j)


class Bands:
    """Size bands and their parts."""

    def __init__(self, settings: Settings):
        self.settings = settings
        self.lows = [1]

    def low(self, band: int) -> int:
        while len(self.lows) <= band:
            self.lows.append(max(self.lows[-1] + 1, int(self.lows[-1] * self.settings.ratio)))
        return self.lows[band]

    def parts(self, band: int) -> tuple[int, int, int]:
        """Number of parts, how many may differ between similar sets, and how many keys these share beyond one."""
        most = self.low(band + 1) - 1
        differ = 2 * most * (100 - self.settings.percent) // (100 + self.settings.percent)
        empty, spare = int(differ * self.settings.empty), int(differ * self.settings.spare)
        return differ + 1 + spare + empty, differ, spare

    def need(self, band: int, size: int, filled: int) -> tuple[int, bool]:
        """The least number of keys that a set shares with a similar one, and whether its empty parts must be keys.

        A set of this size differs from a similar one in no more elements than (100 - percent) / percent of its own.
        If it has so many empty parts that all equal ones might be among them, they are keys.
        """
        parts, differ, spare = self.parts(band)
        sure = parts - min(differ, size * (100 - self.settings.percent) // self.settings.percent) - (parts - filled)
        return (sure, False) if sure > spare else (1 + spare, True)

    def of(self, size: int) -> list[int]:
        """The set's own band and those above where it can be the smaller one of a similar pair."""
        band = 0
        while self.low(band + 1) <= size:
            band += 1
        found = [band]
        while 100 * size >= self.settings.percent * self.low(found[-1] + 1):
            found.append(found[-1] + 1)
        return found

    def needs(self, elements: np.ndarray) -> list[dict]:
        return [{"band": band, "need": self.need(band, len(elements), len(np.unique(self.places(band, elements))))[0]}
                for band in self.of(len(elements))] if len(elements) else []

    def places(self, band: int, elements: np.ndarray) -> np.ndarray:
        return (elements >> np.uint64(32)) % np.uint64(self.parts(band)[0])

    def keys(self, elements: np.ndarray) -> np.ndarray:
        """Keys of the set's parts. Their last 6 bits are the band's."""
        out = []
        for band in self.of(len(elements)):
            place = self.places(band, elements)
            order = np.argsort(place, kind="stable")
            place, bits = place[order], mixed(elements[order] * GOLDEN)
            first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
            number, value = place[first], np.bitwise_xor.reduceat(bits, first)
            if self.need(band, len(elements), len(first))[1]:
                rest = np.setdiff1d(np.arange(self.parts(band)[0], dtype=np.uint64), number)
                number, value = np.concatenate((number, rest)), np.concatenate((value, np.zeros(len(rest), np.uint64)))
            with np.errstate(over="ignore"):
                key = mixed(value ^ mixed(number * GOLDEN + np.uint64(band + 1)))
            out.append((key & ~np.uint64(63)) | np.uint64(band & 63))
        return np.concatenate(out)


def _bands(settings: Settings) -> Bands:
    """The bands, kept by the worker in place of what it kept for an operator before."""
    return kept(("bands", settings), lambda: Bands(settings))


def _bytes(column: pa.Array) -> list[bytes]:
    return pc.fill_null(column.cast(pa.binary()), b"").to_pylist()


NEEDS = pa.list_(pa.struct([("band", pa.int32()), ("need", pa.int32())]))


def _sets(docs: DataFrame, settings: Settings) -> DataFrame:
    """doc_id, row, n_shingles, h1, h2 and, for each band, the least number of shared keys; ``row`` is a hash of id and text."""
    def find(batches):
        bands = _bands(settings)
        for piece in pieces(batches):
            sets = [shingles(data, settings.n) for data in _bytes(piece.column("text"))]
            ids = [set_id(elements) for elements in sets]
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("row"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([a for a, _ in ids], pa.int64()), pa.array([b for _, b in ids], pa.int64()),
                 pa.array([bands.needs(s) for s in sets], NEEDS)], ["doc_id", "row", "n_shingles", "h1", "h2", "needs"])

    return docs.mapInArrow(find, "doc_id bigint, row bigint, n_shingles bigint, h1 bigint, h2 bigint, needs array<struct<band int, need int>>")


def _stars(keys: np.ndarray, sets: np.ndarray, key=None, leader=None, last=None):
    """Of rows sorted by key and set: which begin a key, each row's leader (its key's first set), which aren't repeats."""
    new = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    new[0] = keys[0] != key if key is not None else True
    at = np.maximum.accumulate(np.where(new, np.arange(len(keys)), -1))
    leaders = sets[np.maximum(at, 0)]
    if leader is not None:
        leaders = np.where(at < 0, leader, leaders)
    repeat = np.zeros(len(keys), bool)
    repeat[1:] = ~new[1:] & (sets[1:] == sets[:-1])
    repeat[0] = not new[0] and sets[0] == last
    return new, leaders, ~repeat


def _groups(docs: DataFrame, settings: Settings) -> DataFrame:
    """key, leader, member: for every key that several sets have, a row for each set but the smallest, which leads.

    A task first brings together the keys of its own documents and hands on one set for each key, so a key that
    very many documents have arrives from each task's batches once. Members found there are dealt out by key and set.
    """
    def emit(batches):
        bands = _bands(settings)
        for piece in pieces(batches, TOGETHER):
            keys, sets, seen = [], [], set()
            for data in _bytes(piece.column("text")):
                elements = shingles(data, settings.n)
                if not len(elements):
                    continue
                one = set_id(elements)
                if one not in seen:
                    seen.add(one)
                    own = bands.keys(elements)
                    keys.append(own)
                    sets.append(np.full(len(own), one[0], np.int64))
            if not keys:
                continue
            keys, sets = np.concatenate(keys).view(np.int64), np.concatenate(sets)
            order = np.lexsort((sets, keys))
            keys, sets = keys[order], sets[order]
            new, leaders, real = _stars(keys, sets)
            real = np.flatnonzero(real & (new | (sets != leaders)))
            for at in range(0, len(real), ROWS):
                rows = real[at : at + ROWS]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[rows]), pa.array(sets[rows]), pa.array(leaders[rows], mask=new[rows])], ["key", "member", "leader"])

    def lead(batches):
        key = leader = last = None
        for batch in batches:
            local = batch.filter(pc.is_valid(batch.column("leader")))
            if local.num_rows:
                yield local
            batch = batch.filter(pc.is_null(batch.column("leader")))
            if not batch.num_rows:
                continue
            keys, sets = batch.column("key").to_numpy(), batch.column("member").to_numpy()
            new, leaders, real = _stars(keys, sets, key, leader, last)
            key, leader, last = keys[-1], leaders[-1], sets[-1]
            real &= ~new & (sets != leaders)
            if real.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[real]), pa.array(sets[real]), pa.array(leaders[real])], ["key", "member", "leader"])

    schema = "key bigint, member bigint, leader bigint"
    place = F.when(F.col("leader").isNull(), F.col("key")).otherwise(F.xxhash64("key", "member"))
    return docs.mapInArrow(emit, schema).repartition(place).sortWithinPartitions("key", "member").mapInArrow(lead, schema)


def _elements(docs: DataFrame, sets: DataFrame, wanted: DataFrame, n: int, folder: str) -> DataFrame:
    """h1, sid, n, sketch and elements of the wanted sets (h1), each from the text of one document that has it.

    The chosen rows are a table of their own, so that Spark sees its size and moves no texts to it while it is small. Only
    rows that stand several times are brought together, for one of them to stay.
    """
    rows = sets.filter("n_shingles > 0").join(wanted, "h1", "left_semi").groupBy("h1", "h2", "n_shingles", "row").agg(
        F.count(F.lit(1)).alias("times"))
    chosen = rows.groupBy("h1", "h2", "n_shingles").agg(F.min(F.struct("row", "times")).alias("one"))
    chosen = write_table(chosen.select("one.row", (F.col("one.times") > 1).alias("repeats")), f"{folder}/chosen")
    picked = docs.join(chosen, "row")
    texts = picked.filter("NOT repeats").select("text").union(picked.filter("repeats").dropDuplicates(["row"]).select("text"))

    def find(batches):
        for piece in pieces(batches):
            found = [shingles(data, n) for data in _bytes(piece.column("text"))]
            ids = [set_id(elements) for elements in found]
            sid = [(a + (1 << 63)).to_bytes(8, "big") + b.to_bytes(8, "big", signed=True) for a, b in ids]  # sorts as h1
            yield pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in ids], pa.int64()), pa.array(sid, pa.binary()),
                 pa.array([len(elements) for elements in found], pa.int64()),
                 pa.array([sketch(elements).tobytes() for elements in found], pa.binary()),
                 pa.array([elements.tobytes() for elements in found], pa.binary())], ["h1", "sid", "n", "sketch", "elements"])

    return texts.mapInArrow(find, "h1 bigint, sid binary, n bigint, sketch binary, elements binary")


def _linked(pairs: DataFrame, elements: DataFrame, percent: int) -> DataFrame:
    """a and b (set ids) of the pairs (x, y of h1) that are similar: 100 * intersection >= percent * union."""
    def verify(batches):
        for piece in pieces(batches):
            keep = []
            for x, y in zip(piece.column("ea").to_pylist(), piece.column("eb").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                small, large = sorted((len(x), len(y)))
                if 100 * small < percent * large:
                    keep.append(False)
                    continue
                both = np.concatenate((x, y))
                both.sort()
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield piece.select(["a", "b"]).filter(pa.array(keep))

    first = elements.select(F.col("h1").alias("x"), F.col("sid").alias("a"), F.col("elements").alias("ea"))
    second = elements.select(F.col("h1").alias("y"), F.col("sid").alias("b"), F.col("elements").alias("eb"))
    joined = pairs.select("x", "y").join(first, "x").join(second, "y").select("a", "b", "ea", "eb")
    return joined.mapInArrow(verify, "a binary, b binary")


def _rows(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), _row().alias("row"))


def _row():
    return F.xxhash64(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))


def _ordered(x: str, y: str) -> list:
    return [F.least(x, y).alias("x"), F.greatest(x, y).alias("y")]


def _band(key: str = "key"):
    return F.col(key).bitwiseAND(F.lit(63)).cast("int")


def _left(need):
    """Shared keys that are left of ``need`` if a set leaves out ``_leaves(need)`` of its own."""
    return need - _leaves(need)


def _leaves(need):
    return F.floor((need - 1) / 2)


def _members(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """key, h1 and need of the sets that are in enough groups of their band to be similar to another one."""
    members = groups.select("key", F.col("member").alias("h1")).union(groups.select("key", "leader")).distinct()
    members = members.withColumn("met", F.count(F.lit(1)).over(Window.partitionBy("h1", _band())))
    needs = sets.select("h1", F.explode("needs").alias("of")).select("h1", F.col("of.band").bitwiseAND(F.lit(63)).alias("band"), "of.need")
    needs = needs.groupBy("h1", "band").agg(F.min("need").alias("need"))
    return members.withColumn("band", _band()).join(needs, ["h1", "band"]).filter("met >= need").select("key", "h1", "need")


class _Linking:
    """Turns members of groups (key, h1), sets that share a key, into links, until every similar pair is linked, if by a path.

    A set meets each similar one in ``need`` groups of a band, at least. First each group's sets are compared with its
    leader, if they meet it often. In groups whose sets then still belong to several components, all pairs of
    different components are looked at, in blocks, by size and sketch, which hardly let a pair pass that isn't similar. Of those that
    pass a first turn compares only as many as join a block's components, and a second one, over the groups that are then
    still open, all that are left. Before that each
    set leaves out nearly half its need of its largest groups; two sets leave out no more of their common ones than one does.
    """

    def __init__(self, members: DataFrame, elements: DataFrame, settings: Settings, folder: str):
        self.members, self.elements, self.settings, self.folder = members, elements, settings, folder
        self.turn = 0
        self.tested = self.links = None

    def test(self, pairs: DataFrame) -> bool:
        """Compare pairs that weren't compared before; True if some are similar."""
        self.turn += 1
        pairs = pairs.select(*_ordered("x", "y")).distinct()
        if self.tested is not None:
            pairs = pairs.join(self.tested, ["x", "y"], "left_anti")
        pairs = write_table(pairs, f"{self.folder}/pairs-{self.turn}")
        links = write_table(_linked(pairs, self.elements, self.settings.percent), f"{self.folder}/links-{self.turn}")
        self.tested = pairs if self.tested is None else self.tested.union(pairs)
        self.links = links if self.links is None else self.links.union(links)
        return not links.isEmpty()

    def around_first_leaders(self) -> DataFrame:
        leaders = self.members.groupBy("key").agg(F.min("h1").alias("leader"))
        stars = self.members.join(leaders, "key").filter("h1 != leader")
        met = stars.groupBy(F.col("leader").alias("x"), F.col("h1").alias("y"), _band().alias("band")).agg(
            F.count(F.lit(1)).alias("met"), F.max("need").alias("need"))
        return met.filter(F.col("met") >= _left(F.col("need")))

    def open_groups(self, nodes: DataFrame) -> DataFrame:
        """key, h1, sid, component and size of group for groups with several components."""
        rows = self.members.join(self.elements.select("h1", "sid"), "h1").join(nodes, F.col("sid") == F.col("node"), "left")
        rows = rows.select("key", "h1", "need", "sid", F.coalesce("component", "sid").alias("component"))
        several = rows.groupBy("key").agg(F.min("component").alias("least"), F.max("component").alias("most"),
                                          F.count(F.lit(1)).alias("size")).filter("least != most")
        return rows.join(several.select("key", "size"), "key")

    def in_full(self, rows: DataFrame, forest: bool) -> DataFrame:
        """Pairs of different components in a group that neither size nor sketch tell apart; with ``forest`` only enough to join them.

        A group of more than ``BLOCK`` sets is dealt out to pairs of blocks. Sketches, most of a row's bytes, join the rows just before.
        """
        percent, fields = self.settings.percent, ["key", "first", "second", "block", "h1", "n", "sketch", "component"]
        blocks = F.ceil(F.col("size") / BLOCK).cast("int")
        block = F.pmod(F.xxhash64("h1"), blocks.cast("bigint")).cast("int")
        rows = rows.join(self.elements.select("sid", "n", "sketch"), "sid")
        dealt = rows.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1))).select(
            "key", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"), "block", "h1", "n",
            "sketch", "component")

        def compare(table, edges):
            """Pairs of the groups between the edges. Columns are decoded once for all, and groups of two are compared together."""
            ids, n, block = (table.column(c).to_numpy() for c in ("h1", "n", "block"))
            inner = table.column("first").to_numpy() == table.column("second").to_numpy()
            component = table.column("component").combine_chunks().dictionary_encode().indices.to_numpy()
            sketches = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint64).reshape(-1, WORDS)
            starts, sizes = edges[:-1], np.diff(edges)
            x = starts[sizes == 2]
            y = x + 1
            x, y = (side[(component[x] != component[y]) & (inner[x] | (block[x] != block[y]))
                         & (100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y]))] for side in (x, y))
            near = np.bitwise_count(sketches[x] ^ sketches[y]).sum(1, dtype=np.int64) <= (n[x] + n[y]) * (100 - percent) // (100 + percent)
            pairs = [np.stack((x[near], y[near]))]
            for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
                at = np.arange(start, start + size)
                left = right = at
                if not inner[start]:
                    first = block[at] == block[at].min()
                    left, right = at[first], at[~first]
                if len(right) and component[at].min() != component[at].max():
                    sides = ((component[side], n[side], sketches[side]) for side in (left, right))
                    found = np.array(list(close_pairs(*sides, percent, forest)), np.int64).reshape(-1, 2)
                    pairs.append(np.stack((left[found[:, 0]], right[found[:, 1]])))
            x, y = ids[np.concatenate(pairs, axis=1)]
            found = np.unique(np.stack((np.minimum(x, y), np.maximum(x, y))), axis=1)
            return pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1])], ["x", "y"])

        def find(batches):
            rest = None
            for batch in batches:
                table = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch])
                if not table.num_rows:
                    continue
                marks = [table.column(c).to_numpy() for c in ("key", "first", "second")]
                edges = np.append(0, np.flatnonzero(np.logical_or.reduce([m[1:] != m[:-1] for m in marks])) + 1)
                if len(edges) > 1:
                    yield compare(table.slice(0, int(edges[-1])), edges)
                rest = table.slice(int(edges[-1]))
            if rest is not None and rest.num_rows > 1:
                yield compare(rest, np.array([0, rest.num_rows]))

        places = ["key", "first", "second"]
        return dealt.select(*fields).repartition(*places).sortWithinPartitions(*places).mapInArrow(find, "x bigint, y bigint")

    def run(self) -> DataFrame:
        self.test(self.around_first_leaders())
        nodes = components(self.links)
        for forest in (True, False):
            rows = self.open_groups(nodes)
            own = Window.partitionBy("h1", _band()).orderBy(F.desc("size"), "key")
            few = rows.withColumn("place", F.row_number().over(own)).filter(F.col("place") > _leaves(F.col("need"))).drop("place")
            if self.test(self.in_full(few, forest)):
                nodes = components(self.links)
        return nodes


def near_copies(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_shingles, component_id, row and stays of every document.

    A document's set is that of its distinct word n-grams (words are separated by blanks and ASCII line marks; A-Z
    count as a-z); with fewer than ``n`` words it is the whole sequence alone, without words it is empty and linked with
    nothing. Two documents link when 100 * intersection >= percent * union. ``component_id`` is the smallest doc_id
    that a document reaches by links. One row of a component ``stays``: that of the smallest id.

    Equal sets are one node, so copies aren't compared. Candidates are sets that agree in a part of their
    parity sketches; all are verified on their elements. No pair of similar sets is missed: see ``_Linking``.
    Sets are told apart by 128-bit hashes and their elements by 64-bit hashes.

    Null texts are empty. A null id stands after all others in a component. Rows that repeat id and text stay or go
    together. An empty table gives an empty result. Other columns don't matter.
    """
    spark = docs.sparkSession
    rows = _rows(docs)
    sets = materialize(_sets(rows, settings), "sets")
    with scratch(spark, "near-copies") as folder:
        groups = write_table(_groups(rows.select("text"), settings), f"{folder}/groups")
        members = write_table(_members(groups, sets), f"{folder}/members")
        elements = write_table(_elements(rows, sets, members.select("h1").distinct(), settings.n, folder), f"{folder}/elements")
        nodes = materialize(_Linking(members, elements, settings, folder).run(), "nodes")
    hexed = F.concat(*(F.lpad(F.hex(h), 16, "0") for h in (F.col("h1").bitwiseXOR(F.lit(-(1 << 63))), "h2")))
    known = sets.filter("n_shingles > 0").withColumn("sid", F.unhex(hexed)).join(
        nodes, F.col("sid") == F.col("node"), "left").withColumn("of", F.coalesce("component", "sid"))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    first = known.groupBy("of").agg(best.alias("first")).select(
        "of", F.col("first.doc_id").alias("component_id"), F.col("first.row").alias("first_row"))
    linked = known.join(first, "of").select(
        "doc_id", "n_shingles", "component_id", "row", (F.col("row") == F.col("first_row")).alias("stays"))
    alone = sets.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "row", F.lit(True).alias("stays"))
    return linked.union(alone)


def drop_near_copies(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` with all their columns, one for each component; documents without words all stay."""
    # a table of its own, so that Spark sees its size and broadcasts it only if small
    gone = materialize(near_copies(docs, settings).filter("NOT stays").select(F.col("row").alias("_gone")), "gone")
    whole = docs.select(F.struct("*").alias("_doc"), _row().alias("_row"))
    return whole.join(gone, F.col("_row") == F.col("_gone"), "left_anti").select("_doc.*")
