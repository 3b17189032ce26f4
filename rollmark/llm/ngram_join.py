"""Jaccard join of word n-gram sets through R-trees of count vectors.

1. A set's members are hashed into groups, and the numbers per group are a point. Two sets share at
   most the sum of the smaller of both counts over the groups, since a shared member counts in both.
2. Points are dealt by members. In any fixed order of all members, similar sets share one of the first
   few (for a similarity of 0.8, the first fifth), and several of some more: `l` of the first fifth and `l`
   more. The order puts frequent members last, as told by a small table of counts. A set that has fewer
   than `l` of these members in common with all others together is done, which a passage that it shares with
   some does not hinder. The others deal their point by these members, but for the `l - 1` that most have.
3. The points dealt to one member are put into an R-tree: nested groups of close points, each with the
   greatest count per group of hashes. The tree is joined with itself from the root on: a pair of nodes
   goes on only if the summed minima of their counts reach what their smallest sets would have to share,
   their sizes fit, and they are not of one component already. What is left at the leaves are pairs of
   points, to which the same bound applies. Where all pairs are wanted, pairs of points also have to pass the
   same bound over many more groups, counted up to two in bits, and a pair that meets under several members
   is made under the first that both have among their least.
4. Pairs that survive are verified on the whole sets.

Many points of one member are cut into chunks of bounded size, and every pair of chunks is joined in a
task of its own. Pairs within a group of copies are not all made: the first rounds verify for each point
only its best partners, link what they confirm into components, and leave out what is within one; the
last round takes all pairs that survive between components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from rollmark.llm import text as t
from rollmark.llm.components import components
from rollmark.llm.stored import Scratch

WORDS, SIMILARITY = 5, 0.8
#: Groups of hashes, so coordinates of a point.
GROUPS = 64
#: Two to this power counts tell how frequent a member is.
TALLY_BITS = 17
#: Points in a leaf, children of a node, and points from which a member's are cut into chunks.
LEAF, FANOUT, CHUNK = 32, 4, 2048
#: Of so many members, one more is to be shared.
MORE = 16
#: Members by which a point is dealt in the first round.
FIRST = 2
#: Of the members a class is dealt by, so many tell where a pair that meets under several is made.
LEAST = 4
#: Classes whose ids are sent to all tasks to find their texts; of more, texts are shuffled.
SENT = 1_000_000
#: Rounds in which each point keeps its best partners only, after the first.
ROUNDS = 1

_SALTS = np.array([0x452821E638D01377, 0xBE5466CF34E90C6C, 0xC0AC29B7C97C50DD], np.uint64)
#: A count that does not fit stands for any number.
_MANY = np.iinfo(np.uint8).max


def _bucket(members: np.ndarray) -> np.ndarray:
    return (t.mix(members ^ _SALTS[2]) >> np.uint64(64 - TALLY_BITS)).astype(np.int64)


def _tallied(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << TALLY_BITS, np.int64)
        for batch in batches:
            for _, _, data, offsets in t.slices(batch.column(0)):
                members, _ = t.shingles(*t.hashed_words(data, offsets), size)
                total += np.bincount(_bucket(members), minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(at, pa.int32()), "n": pa.array(total[at], pa.int64())})

    return run


def frequency_levels(texts: DataFrame, size: int) -> np.ndarray:
    """For each bucket of members how far its count lies above the usual one, as a power of two. Only the
    order of members follows from it: the result does not depend on it, the work does."""
    sums = texts.mapInArrow(_tallied(size), "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(1 << TALLY_BITS)
    total[sums.column("bucket").to_numpy()] = sums.column("n").to_numpy()
    usual = float(np.median(total))
    return np.log2(1 + np.maximum(total - usual, 0) / max(1.0, usual**0.5)).astype(np.uint8)


def _pointed(size: int, percent: int, levels: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in t.slices(batch.column(1)):
                sets, owner = t.shingles(*t.hashed_words(data, offsets), size)
                n = np.bincount(owner, minlength=j - i)
                at = t.segment_starts(owner)
                marks = np.zeros((j - i, 2), np.uint64)
                for c in range(2):
                    if len(at):
                        marks[owner[at], c] = np.add.reduceat(t.mix(sets ^ _SALTS[c]), at)
                group = (t.mix(sets) & np.uint64(GROUPS - 1)).astype(np.int64)
                points = np.bincount(owner * GROUPS + group, minlength=(j - i) * GROUPS)
                points = np.minimum(points, _MANY).astype(np.uint8)
                bits, beyond = t.group_bits(sets, owner, j - i)
                order = np.lexsort((sets, levels[_bucket(sets)], owner))
                begins = np.concatenate([[0], np.cumsum(n)])
                place = np.arange(len(sets)) - begins[owner]
                dealt = n - (percent * n + 99) // 100 + np.maximum(1, n // MORE)
                dealt[n == 0] = 0
                first = sets[order][place < dealt[owner]]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column(0).slice(i, j - i),
                    "n_shingles": pa.array(n, pa.int64()),
                    "set_lo": pa.array(marks[:, 0].view(np.int64)),
                    "set_hi": pa.array(marks[:, 1].view(np.int64)),
                    "members": pa.ListArray.from_arrays(
                        np.concatenate([[0], np.cumsum(dealt)]).astype(np.int32), first.view(np.int64)),
                    "point": pa.Array.from_buffers(
                        pa.binary(), j - i,
                        [None, pa.py_buffer(np.arange(j - i + 1, dtype=np.int32) * GROUPS), pa.py_buffer(points)]),
                    "bits": pa.Array.from_buffers(
                        pa.binary(), j - i,
                        [None, pa.py_buffer(np.arange(j - i + 1, dtype=np.int32) * t.LONGS * 8), pa.py_buffer(bits)]),
                    "beyond": pa.array(beyond, pa.int64()),
                })

    return run


def points(docs: DataFrame, size: int, percent: int, levels: np.ndarray) -> DataFrame:
    """(doc_id, n_shingles, set_lo, set_hi, members, point, bits, beyond) of each row of (doc_id, text). The two marks
    are sums over the hashed set: equal for equal sets, and as good as never otherwise."""
    schema = ("doc_id bigint, n_shingles bigint, set_lo bigint, set_hi bigint, members array<bigint>, point binary, "
              "bits binary, beyond bigint")
    return docs.mapInArrow(_pointed(size, percent, levels), schema)


class _Join:
    """Self-join of the points of one batch: counts, set sizes, components, and the chunk of each. If there are
    any: the bits of many more groups with what is beyond, the member, and the least members of each."""

    def __init__(self, percent: int, counts: np.ndarray, n: np.ndarray, component: np.ndarray, side: np.ndarray,
                 bits: np.ndarray | None = None, beyond: np.ndarray | None = None, member: np.ndarray | None = None,
                 least: np.ndarray | None = None):
        self.percent, self.counts, self.n, self.component, self.side = percent, counts, n, component, side
        self.bits, self.beyond, self.member, self.least = bits, beyond, member, least

    def _shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        least = np.minimum(a, b)
        bound = least.sum(axis=-1, dtype=np.int64)
        return np.where((least == _MANY).any(axis=-1), np.iinfo(np.int64).max, bound)

    def _enough(self, shared: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
        return np.minimum(shared, n + m) * (100 + self.percent) >= self.percent * (n + m)

    def among(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Those of the pairs that may be similar, with the bound on what they share."""
        n, m = self.n[i], self.n[j]
        fits = (100 * n >= self.percent * m) & (100 * m >= self.percent * n) & (self.component[i] != self.component[j])
        fits &= (self.side[i] == 0) | (self.side[i] != self.side[j])
        i, j = i[fits], j[fits]
        shared = self._shared(self.counts[i], self.counts[j])
        fits = self._enough(shared, self.n[i], self.n[j])
        i, j, shared = i[fits], j[fits], shared[fits]
        if self.bits is not None and len(i):
            fits = np.concatenate([self._here(i[k : k + 4096], j[k : k + 4096]) for k in range(0, len(i), 4096)])
            i, j, shared = i[fits], j[fits], shared[fits]
        if self.bits is not None and len(i):
            shared = np.minimum(shared, np.concatenate([
                np.bitwise_count(self.bits[i[k : k + 4096]] & self.bits[j[k : k + 4096]]).sum(axis=1, dtype=np.int64)
                for k in range(0, len(i), 4096)]) + np.minimum(self.beyond[i], self.beyond[j]))
            fits = self._enough(shared, self.n[i], self.n[j])
            i, j, shared = i[fits], j[fits], shared[fits]
        return i, j, shared

    def _here(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which of the pairs have no other member where they are made."""
        a, b = self.least[i], self.least[j]
        both = (a[:, :, None] == b[:, None, :]).any(axis=2)
        first = np.where(both, a, np.iinfo(np.int64).max).min(axis=1)
        return ~both.any(axis=1) | (first == self.member[i])

    def _packed(self, at: np.ndarray) -> Iterator[np.ndarray]:
        """Leaves of close points: halves along the group in which the counts differ most."""
        if len(at) <= LEAF:
            yield at
            return
        counts = self.counts[at].astype(np.float32)
        widest = int(counts.var(axis=0).argmax())
        order = np.argsort(counts[:, widest], kind="stable")
        half = len(at) // 2
        yield from self._packed(at[order[:half]])
        yield from self._packed(at[order[half:]])

    def tree(self, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The surviving pairs among the points `at`, by a join of their R-tree with itself."""
        leaves = list(self._packed(at))
        flat = np.concatenate(leaves)
        edges = np.concatenate([[0], np.cumsum([len(x) for x in leaves])])
        begin = edges[:-1]
        whole = dict(
            high=np.maximum.reduceat(self.counts[flat], begin, axis=0),
            n_low=np.minimum.reduceat(self.n[flat], begin), n_high=np.maximum.reduceat(self.n[flat], begin),
            c_low=np.minimum.reduceat(self.component[flat], begin), c_high=np.maximum.reduceat(self.component[flat], begin),
            s_low=np.minimum.reduceat(self.side[flat], begin), s_high=np.maximum.reduceat(self.side[flat], begin),
        )
        levels = [whole]
        while len(levels[-1]["n_low"]) > 1:
            below = levels[-1]
            starts = np.arange(0, len(below["n_low"]), FANOUT)
            levels.append({
                name: (np.minimum if name.endswith("low") else np.maximum).reduceat(x, starts, axis=0)
                for name, x in below.items()
            })
        x = y = np.zeros(1, np.int64)
        for depth in range(len(levels) - 1, -1, -1):
            alive = self._nodes(levels[depth], x, y)
            x, y = x[alive], y[alive]
            if depth:
                x, y = self._children(x, y, len(levels[depth - 1]["n_low"]))
        for k in range(0, len(x), 64):
            parts = [self._points(edges, a, b) for a, b in zip(x[k : k + 64], y[k : k + 64])]
            i, j = (flat[np.concatenate(p)] for p in zip(*parts))
            yield self.among(i, j)

    def _nodes(self, level: dict, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Which pairs of nodes may hold similar points that are not yet linked."""
        out = np.zeros(len(x), bool)
        for k in range(0, len(x), 4096):
            a, b = x[k : k + 4096], y[k : k + 4096]
            small_a, small_b = level["n_low"][a], level["n_low"][b]
            fits = (100 * level["n_high"][a] >= self.percent * small_b) & (100 * level["n_high"][b] >= self.percent * small_a)
            lowest = np.minimum(level["c_low"][a], level["c_low"][b])
            fits &= lowest != np.maximum(level["c_high"][a], level["c_high"][b])
            low, high = np.minimum(level["s_low"][a], level["s_low"][b]), np.maximum(level["s_high"][a], level["s_high"][b])
            fits &= (low == 0) | (low != high)
            shared = self._shared(level["high"][a], level["high"][b])
            out[k : k + 4096] = fits & self._enough(shared, small_a, small_b)
        return out

    @staticmethod
    def _children(x: np.ndarray, y: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        step = np.arange(FANOUT)
        a = np.repeat(x[:, None] * FANOUT + step, FANOUT, axis=1).ravel()
        b = np.tile(y[:, None] * FANOUT + step, (1, FANOUT)).ravel()
        keep = (a < n) & (b < n) & (a <= b)
        return a[keep], b[keep]

    @staticmethod
    def _points(edges: np.ndarray, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        i, j = np.arange(edges[a], edges[a + 1]), np.arange(edges[b], edges[b + 1])
        i, j = np.repeat(i, len(j)), np.tile(j, len(i))
        if a == b:
            return i[i < j], j[i < j]
        return i, j


def _best(i: np.ndarray, j: np.ndarray, likeness: np.ndarray) -> np.ndarray:
    """Which pairs are the best one of i, or the best one of j."""
    out = np.zeros(len(i), bool)
    for own in (i, j):
        order = np.lexsort((-likeness, own))
        out[order[t.segment_starts(own[order])]] = True
    return out


def _joined(percent: int, all_pairs: bool):
    """Rows (dealt, rep, n, component, side, point), for all pairs also (member, least_0 and on, bits,
    beyond), ordered by dealt -> surviving pairs (a, b)."""

    def pairs(rows: pa.Table) -> pa.RecordBatch:
        dealt, rep, n, component, side = (
            rows.column(c).to_numpy() for c in ("dealt", "rep", "n", "component", "side"))
        counts = np.frombuffer(b"".join(rows.column("point").to_pylist()), np.uint8).reshape(-1, GROUPS)
        wide = ()
        if all_pairs:
            bits = np.frombuffer(b"".join(rows.column("bits").to_pylist()), np.uint64).reshape(-1, t.LONGS)
            least = np.stack([rows.column(f"least_{k}").to_numpy() for k in range(LEAST)], axis=1)
            wide = bits, rows.column("beyond").to_numpy(), rows.column("member").to_numpy(), least
        join = _Join(percent, counts, n, component, side, *wide)
        begin = t.segment_starts(dealt)
        size = np.diff(np.append(begin, len(dealt)))
        found = []
        own_size = np.repeat(size, size)
        for step in range(1, int(size[size <= LEAF].max(initial=0))):  # trees of one leaf, all at once
            i = np.flatnonzero((dealt[:-step] == dealt[step:]) & (own_size[:-step] <= LEAF))
            for k in range(0, len(i), 1 << 15):
                found.append(join.among(i[k : k + (1 << 15)], i[k : k + (1 << 15)] + step))
        for k in np.flatnonzero(size > LEAF):
            found += join.tree(np.arange(begin[k], begin[k] + size[k]))
        none = np.zeros(0, np.int64)
        i, j, shared = (np.concatenate(x) for x in zip((none, none, none), *found))
        if not all_pairs and len(i):
            # An earlier and a later partner each: if all are confirmed, the points are connected.
            i, j = np.where(rep[i] < rep[j], i, j), np.where(rep[i] < rep[j], j, i)
            keep = _best(i, j, np.minimum(shared, n[i] + n[j]) / (n[i] + n[j]))
            i, j = i[keep], j[keep]
        a, b = np.minimum(rep[i], rep[j]), np.maximum(rep[i], rep[j])
        return pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            waiting = rows if waiting is None else pa.concat_tables([waiting, rows])
            last = waiting.column("dealt")[-1].as_py()
            if waiting.column("dealt")[0].as_py() == last:
                continue
            cut = int(np.searchsorted(waiting.column("dealt").to_numpy(), last))
            yield pairs(waiting.slice(0, cut))
            waiting = waiting.slice(cut).combine_chunks()
        if waiting is not None:
            yield pairs(waiting)

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in t.slices(batch.column(1)):
                sets, owner = t.shingles(*t.hashed_words(data, offsets), size)
                edges = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=j - i))]).astype(np.int32)
                yield pa.RecordBatch.from_pydict({
                    "rep": batch.column(0).slice(i, j - i),
                    "members": pa.ListArray.from_arrays(edges, sets.view(np.int64))})

    return run


class _Verify:
    """Which of the pairs (a, b) of classes are similar, by their whole sets. A class's set is made when a
    pair has it for the first time."""

    def __init__(self, scratch: Scratch, docs: DataFrame, size: int, percent: int):
        self.scratch, self.docs, self.size, self.percent = scratch, docs, size, percent
        self.sets: DataFrame | None = None

    def __call__(self, pairs: DataFrame) -> DataFrame:
        nodes = pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
        if self.sets is not None:
            nodes = nodes.join(self.sets, "rep", "left_anti")
        nodes = self.scratch.stored(nodes, "nodes")
        few = nodes.count() <= SENT
        texts = self.docs.join(
            F.broadcast(nodes) if few else nodes, self.docs["doc_id"] == nodes["rep"], "left_semi")
        made = texts.mapInArrow(_sets(self.size), "rep bigint, members array<bigint>").distinct()
        new = self.scratch.stored(made, "member-sets")
        self.sets = new if self.sets is None else self.sets.unionByName(new)
        a, b = (self.sets.select(F.col("rep").alias(c), F.col("members").alias(f"members_{c}")) for c in "ab")
        both = pairs.join(a, "a").join(b, "b").withColumn("both", t.in_both("members_a", "members_b"))
        union = F.size("members_a") + F.size("members_b") - F.col("both")
        return both.filter(F.col("both") * 100 >= union * self.percent).select(
            F.col("a").alias("u"), F.col("b").alias("v"))


def _shared_members(each: DataFrame) -> DataFrame:
    """Rows (member, ...) of members that several rows have, with their number `k`."""
    return each.withColumn("k", F.count(F.lit(1)).over(Window.partitionBy("member"))).filter("k > 1")


def _posted(pointed: DataFrame, percent: int) -> DataFrame:
    """(member, rep, n, point, first, least): the members that each class's point is dealt by, and the least of
    them; `first` marks those of the first round. What similar sets share at least follows from the smaller size that a partner may have."""
    classes = pointed.filter("n_shingles > 0 and doc_id is not null").groupBy("set_lo", "set_hi").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("members").alias("members"))
    least = F.greatest(F.lit(1), F.floor(F.ceil(F.col("n") * percent / 100) / MORE)).cast("int")
    each = classes.select("rep", F.col("n").cast("int").alias("n"), F.explode("members").alias("member"))
    for last in (False, True):  # classes that are done take partners from others
        own = _shared_members(each).groupBy("rep").agg(
            F.min("n").alias("n"), F.sort_array(F.collect_list(F.struct("k", "member"))).alias("m"))
        own = own.filter(F.size("m") >= least)
        if not last:
            each = own.select("rep", "n", F.explode("m.member").alias("member"))
    kept = own.select("rep", F.slice("m", 1, F.size("m") - least + 1)["member"].alias("m"))
    marked = F.transform("m", lambda x: F.struct(
        x.alias("member"), F.array_contains(F.slice(F.sort_array("m"), 1, FIRST), x).alias("first")))
    smallest = F.slice(F.sort_array("m"), 1, LEAST).alias("least")
    dealt = _shared_members(kept.select("rep", smallest, F.inline(marked)).distinct()).drop("k")
    shapes = pointed.filter("n_shingles > 0").select(
        F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), "point").distinct()
    return dealt.join(shapes, "rep").select("member", "rep", "n", "point", "first", "least")


def _chunked(posted: DataFrame, chunk: int) -> DataFrame:
    """Adds `part`: members with many points have them cut by hash."""
    many = posted.groupBy("member").agg(F.ceil(F.count("*") / chunk).cast("int").alias("parts")).filter("parts > 1")
    part = F.pmod(F.xxhash64(F.lit("part"), "rep"), F.coalesce("parts", F.lit(1))).cast("int")
    return posted.join(many, "member", "left").withColumn("part", part).drop("parts")


def _round(posted: DataFrame, percent: int, wide: DataFrame | None) -> DataFrame:
    """Surviving pairs of posted (member, rep, n, point, component, part, least): the best ones within chunks, or, if
    there is a table of (rep, bits, beyond), all of them."""
    all_pairs = wide is not None
    own = posted.withColumns({"dealt": F.xxhash64("member", "part"), "side": F.lit(0)})
    if all_pairs:
        # Chunks that are one component, the same one, have nothing to find; few members have chunks.
        chunk = posted.groupBy("member", "part").agg(
            F.min("component").alias("low"), F.max("component").alias("high"))
        cut = chunk.join(chunk.groupBy("member").agg(F.count("*").alias("k")).filter("k > 1").select("member"), "member")
        two = cut.alias("x").join(cut.alias("y"), "member").filter(
            "y.part > x.part and least(x.low, y.low) < greatest(x.high, y.high)")
        ends = F.explode(F.array(
            F.struct(F.col("x.part").alias("part"), F.lit(1).alias("side")),
            F.struct(F.col("y.part").alias("part"), F.lit(2).alias("side"))))
        met = two.select("member", F.xxhash64("member", "x.part", "y.part").alias("dealt"), ends.alias("e"))
        own = own.unionByName(posted.join(met.select("member", "dealt", "e.*"), ["member", "part"]))
    columns = ["dealt", "rep", "n", "component", "side", "point"]
    if all_pairs:
        columns += ["member", *(f"least_{k}" for k in range(LEAST)), "bits", "beyond"]
        own = own.join(wide, "rep").withColumns({
            f"least_{k}": F.col("least")[F.least(F.lit(k), F.size("least") - 1)] for k in range(LEAST)})
    rows = own.select(*columns)
    rows = rows.repartition("dealt").sortWithinPartitions("dealt")
    return rows.mapInArrow(_joined(percent, all_pairs), "a bigint, b bigint").distinct()


def linked_classes(
    scratch: Scratch, docs: DataFrame, pointed: DataFrame, size: int, percent: int, chunk: int, rounds: int
) -> DataFrame:
    """(node, component) of the classes that have a similar one, named by their smallest doc_id."""
    posted = scratch.stored(_posted(pointed, percent), "posted")
    verify = _Verify(scratch, docs, size, percent)
    wide = pointed.filter("n_shingles > 0").select(F.col("doc_id").alias("rep"), "bits", "beyond").distinct()
    found = docs.sparkSession.createDataFrame([], "node bigint, component bigint")
    tried = None
    for turn in range(rounds + 2):
        last = turn == rounds + 1
        now = posted.filter("first") if turn == 0 else posted
        now = now.join(found, F.col("rep") == F.col("node"), "left").select(
            "member", "rep", "n", "point", F.coalesce("component", "rep").alias("component"), *(["least"] if last else []))
        if turn:
            mixed = now.groupBy("member").agg(
                F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("k"))
            # A member of two points had its only pair in the round before, if that had all members.
            least = 3 if last and turn > 1 else 2
            mixed = mixed.filter((F.col("low") < F.col("high")) & (F.col("k") >= least))
            now = now.join(mixed.select("member"), "member", "left_semi")
        pairs = _round(_chunked(now, chunk), percent, wide if last else None)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = scratch.stored(pairs, "pairs")
        if pairs.isEmpty():
            continue
        tried = pairs if tried is None else tried.unionByName(pairs)
        links = found.selectExpr("node as u", "component as v").unionByName(verify(pairs))
        found = scratch.stored(components(scratch.stored(links, "links")), "found")
    return found


def ngram_join(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, similarity: float = SIMILARITY,
    *, chunk: int = CHUNK, rounds: int = ROUNDS,
) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id.

    Documents are linked if the similarity (shared over all) of their sets of word shingles reaches
    `similarity`, which counts in whole per cent; component_id is the smallest doc_id that can be reached
    over links, the document's own included. Shingles are told apart by a 64-bit hash; apart from that
    the result is exact, whatever `chunk` and `rounds`.

    Cases: a null or empty text, or one of spaces only, has the empty set and is linked with nothing. A
    text with fewer words than a shingle has one shingle, all its words. A row without doc_id is linked
    with nothing and gets a null component_id. Rows that repeat a doc_id with the same text agree in all
    columns; with another text they count as that id's further texts. Other columns of docs are not read.
    No rows give no rows.
    """
    percent = round(100 * similarity)
    if not 1 <= percent <= 100:
        raise ValueError("similarity must be from 0.01 to 1")
    scratch = Scratch(docs.sparkSession)
    own = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    levels = frequency_levels(own.select("text"), words)
    pointed = scratch.stored(points(own, words, percent, levels), "points")
    found = linked_classes(scratch, own, pointed, words, percent, chunk, rounds)
    classes = pointed.filter("n_shingles > 0 and doc_id is not null").groupBy("set_lo", "set_hi").agg(
        F.min("doc_id").alias("rep"))
    scratch.drop_all(pointed, found)
    named = classes.join(found, F.col("rep") == F.col("node"), "left").select(
        "set_lo", "set_hi", F.coalesce("component", "rep").alias("class_component"))
    out = pointed.select("doc_id", "n_shingles", "set_lo", "set_hi").join(named, ["set_lo", "set_hi"], "left")
    return out.select("doc_id", "n_shingles", _component().alias("component_id"))


def _component() -> Column:
    of_class = F.when(F.col("n_shingles") > 0, F.col("class_component")).otherwise(F.col("doc_id"))
    return F.when(F.col("doc_id").isNotNull(), F.coalesce(of_class, F.col("doc_id")))
