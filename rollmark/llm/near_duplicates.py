"""Near-duplicate documents by an inverted join over signature coordinates.

1. A document's set is its distinct word shingles. Equal sets are one class, known by its smallest
   doc_id; all that follows works on classes, so exact copies cost nothing.
2. A signature has one minimum per coordinate. A posting is a (coordinate, minimum) pair with its
   class. Two sets agree on each coordinate with a chance equal to their similarity, so similar
   sets share at least `matches` of the `coordinates` postings (binomial: at a similarity of 0.8
   and 64 coordinates, fewer than 36 agree in about 3 of a million pairs, and ever more rarely
   above that).
3. Prefix: with a class's postings ordered from rare to frequent, classes that share `matches`
   of them also share one of the first `coordinates - matches + 1`. Postings that only one class
   has can only be skipped over, so most documents fall out here, and passages that many documents
   share stand at the end of the order and are not joined at all.
4. Skip: the long lists are never merged. Where two classes collide in the prefix, their equal
   coordinates are counted from four bits of each, which travel with the posting: the count is never
   too small, and a pair below the threshold goes at once.
5. Pairs above the threshold are confirmed on the full sets, unless a bound on what the two sets share
   rules them out before: their shingles, hashed into groups, are counted up to two in bits that both
   must have, and what is beyond two in a group is added.

Within a posting not all pairs are made. All its classes are first compared with one of them; what
is linked becomes one component. Then a few more centres are tried for what is left. At last all
classes that still are in different components are compared with each other; in large postings but
for those that share too few shingles with all the others there. A posting all whose classes, but for one,
have been centres has no pair left to compare. So no component is missed, while a large group of near copies
costs about its size instead of its square.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rollmark.llm import text as t
from rollmark.llm.components import components
from rollmark.llm.stored import Scratch

WORDS, SIMILARITY = 5, 0.8
COORDINATES, MATCHES = 64, 36
#: In each round, so many centres of every posting are compared with all its classes.
CENTRES = (2, 16)
#: Of the postings of a class, so many tell where a pair that meets in several is made.
LEAST = 4
#: Classes of a posting from which it is worth telling those that can have no link there.
CROWD = 512
#: Classes whose ids are sent to all tasks to find their texts; of more, texts are shuffled.
SENT = 1_000_000


SIGNED = {
    "doc_id": "bigint", "n_shingles": "bigint", "set_lo": "bigint", "set_hi": "bigint", "postings": "array<bigint>",
    "sketch": "array<bigint>", "bits": "array<bigint>", "beyond": "bigint",
}


def _longs(coordinates: int) -> int:
    """Numbers of 64 bits that hold one bit of each coordinate."""
    return -(-coordinates // 64)


def _four_bits(least: np.ndarray) -> np.ndarray:
    """Four bits of each minimum: first the lowest bit of all of them, then the next, and so on."""
    rows, coordinates = least.shape
    planes = np.zeros((rows, 4, 64 * _longs(coordinates)), np.uint8)
    planes[:, :, :coordinates] = (t.mix(least)[:, None, :] >> np.arange(4, dtype=np.uint64)[:, None]) & np.uint64(1)
    return np.packbits(planes, axis=2).reshape(rows, -1).view(np.int64)


def _signed(size: int, coordinates: int, full: bool):
    """Arrow batches (doc_id, text) -> one row per document, with its whole set if `full`."""
    rng = np.random.default_rng(8)
    factor = rng.integers(0, 2**63, coordinates, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shift = rng.integers(0, 2**63, coordinates, dtype=np.uint64)
    salts = np.array([0x243F6A8885A308D3, 0x13198A2E03707344], np.uint64)
    low = np.uint64(coordinates - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for i, j, data, offsets in t.slices(batch.column(1)):
                sets, owner = t.shingles(*t.hashed_words(data, offsets), size)
                at = t.segment_starts(owner)
                rows = owner[at]
                n = np.bincount(owner, minlength=j - i)
                marks = np.zeros((j - i, 2), np.uint64)
                for c in range(2):
                    if len(at):
                        marks[rows, c] = np.add.reduceat(t.mix(sets ^ salts[c]), at)
                columns = {
                    "doc_id": ids.slice(i, j - i),
                    "n_shingles": pa.array(n, pa.int64()),
                    "set_lo": pa.array(marks[:, 0].view(np.int64)),
                    "set_hi": pa.array(marks[:, 1].view(np.int64)),
                }
                if full:
                    bounds = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                    columns["shingles"] = pa.ListArray.from_arrays(bounds, sets.view(np.int64))
                else:
                    least = np.zeros((j - i, coordinates), np.uint64)
                    for c in range(coordinates):
                        if len(at):
                            v = np.minimum.reduceat(sets * factor[c] + shift[c], at)
                            least[rows, c] = (v & ~low) | np.uint64(c)
                    columns["postings"] = pa.ListArray.from_arrays(
                        np.arange(j - i + 1, dtype=np.int32) * coordinates, least.view(np.int64).ravel()
                    )
                    bits, beyond = t.group_bits(sets, owner, j - i)
                    columns["bits"] = pa.ListArray.from_arrays(
                        np.arange(j - i + 1, dtype=np.int32) * t.LONGS, bits.ravel())
                    columns["beyond"] = pa.array(beyond, pa.int64())
                    columns["sketch"] = pa.ListArray.from_arrays(
                        np.arange(j - i + 1, dtype=np.int32) * (4 * _longs(coordinates)), _four_bits(least).ravel()
                    )
                    columns = {c: columns[c] for c in SIGNED}
                yield pa.RecordBatch.from_pydict(columns)

    return run


def signatures(docs: DataFrame, words: int, coordinates: int = COORDINATES) -> DataFrame:
    """(doc_id, n_shingles, set_lo, set_hi, postings) of each row of (doc_id, text). The two set
    marks are sums over the hashed set: equal for equal sets, and as good as never otherwise."""
    if coordinates & (coordinates - 1) or coordinates < 16:
        raise ValueError("coordinates must be a power of two from 16 on")
    return docs.mapInArrow(_signed(words, coordinates, False), ", ".join(f"{c} {kind}" for c, kind in SIGNED.items()))


def full_sets(docs: DataFrame, words: int) -> DataFrame:
    schema = "doc_id bigint, n_shingles bigint, set_lo bigint, set_hi bigint, shingles array<bigint>"
    return docs.mapInArrow(_signed(words, 2, True), schema)


def _unequal(coordinates: int) -> str:
    """SQL for the number of coordinates whose four bits differ, of the sketches s and s_2. It is evaluated for
    each two classes of a posting, and the JVM only compiles a join whose code is short."""
    n = _longs(coordinates)
    return " + ".join(
        "bit_count(" + " | ".join(f"(s[{k + n * bit}] ^ s_2[{k + n * bit}])" for bit in range(4)) + ")" for k in range(n))


def _may_be_linked(percent: int, a: str, b: str) -> str:
    """SQL for the bound: may the sets with columns n_, bits_ and beyond_ of both names be similar enough? (As a
    sum of so many terms, its code was too long for the JVM to compile.)"""
    shared = f"aggregate(zip_with(bits{a}, bits{b}, (x, y) -> bit_count(x & y)), 0, (sum, x) -> sum + x)"
    return f"({shared} + least(beyond{a}, beyond{b})) * {100 + percent} >= (n{a} + n{b}) * {percent}"


def _prefixes(classes: DataFrame, matches: int) -> DataFrame:
    """(rep, n, s, w, posting) for the rarest postings of classes that may have a partner; w are the least of them."""
    each = classes.select("number", F.explode("postings").alias("posting"))
    shared = each.groupBy("posting").agg(F.count("*").alias("lists")).filter("lists > 1")
    kept = (
        each.join(shared, "posting")
        .repartition("number")  # rows are smaller than lists of one or two of them
        .groupBy("number").agg(F.sort_array(F.collect_list(F.struct("lists", "posting"))).alias("p"))
        .filter(F.size("p") >= matches)
    )
    sketches = classes.select("number", "rep", F.col("n_shingles").alias("n"), F.col("sketch").alias("s"))
    prefix = kept.select("number", F.slice("p", 1, F.size("p") - matches + 1)["posting"].alias("p"))
    return prefix.join(sketches, "number").select(
        "rep", "n", "s", F.slice(F.sort_array("p"), 1, LEAST).alias("w"), F.explode("p").alias("posting"))


class _Confirm:
    """Which of the pairs (a, b) of classes are linked. A class's whole set is made when a pair has
    it for the first time."""

    def __init__(self, scratch: Scratch, docs: DataFrame, classes: DataFrame, words: int, percent: int):
        self.scratch, self.docs, self.words, self.percent = scratch, docs, words, percent
        self.bounds = classes.select("rep", F.col("n_shingles").alias("n"), "bits", "beyond")
        self.sets: DataFrame | None = None

    def _ends(self, pairs: DataFrame) -> tuple[DataFrame, bool]:
        """The classes of the pairs, marked for broadcast if there are few; and whether there are."""
        nodes = self.scratch.stored(pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct(), "ends")
        few = nodes.count() <= SENT
        return (F.broadcast(nodes) if few else nodes), few

    def add(self, nodes: DataFrame) -> None:
        """Make the sets of these classes (rep) that are not there yet."""
        if self.sets is not None:
            nodes = nodes.join(self.sets, "rep", "left_anti")
        nodes = self.scratch.stored(nodes, "nodes")
        many = nodes.count()
        if self.sets is not None and not many:
            return
        texts = self.docs.join(
            F.broadcast(nodes) if many <= SENT else nodes, self.docs["doc_id"] == nodes["rep"], "left_semi")
        new = self.scratch.stored(
            full_sets(texts, self.words).select(F.col("doc_id").alias("rep"), "shingles").distinct(), "sets"
        )
        self.sets = new if self.sets is None else self.sets.unionByName(new)

    def hopeless(self, nodes: DataFrame) -> DataFrame:
        """Those of the classes too many of whose shingles no other of them has: what two sets share
        is at most what one of them shares with any, and must reach `percent` of its size."""
        self.add(nodes)
        sets = self.sets.join(nodes, "rep", "left_semi")
        each = sets.select("rep", F.explode("shingles").alias("shingle"))
        alone = each.groupBy("shingle").agg(F.count("*").alias("n"), F.min("rep").alias("rep")).filter("n = 1")
        alone = alone.groupBy("rep").agg(F.count("*").alias("alone"))
        sizes = sets.groupBy("rep").agg(F.count("*").alias("sets"), F.sum(F.size("shingles")).alias("n"))
        few = (F.col("n") - F.col("alone")) * 100 < F.col("n") * self.percent
        return sizes.join(alone, "rep").filter(few & (F.col("sets") == 1)).select("rep")

    def _possible(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs that the bound does not rule out."""
        a, b = (self.bounds.select(*[F.col(c).alias(f"{c}_{x}" if c != "rep" else x) for c in self.bounds.columns]) for x in "ab")
        return pairs.join(a, "a").join(b, "b").filter(_may_be_linked(self.percent, "_a", "_b")).select("a", "b").distinct()

    def __call__(self, pairs: DataFrame, bounded: bool = False) -> DataFrame:
        """`bounded`: whether the pairs have passed the bound."""
        if not bounded:
            pairs = self.scratch.stored(self._possible(pairs), "possible")
        nodes, few = self._ends(pairs)
        self.add(nodes)
        sets = self.sets.join(nodes, "rep", "left_semi") if few else self.sets
        side = [sets.select(F.col("rep").alias(c), F.col("shingles").alias(f"shingles_{c}")) for c in "ab"]
        both = pairs.join(side[0], "a").join(side[1], "b").withColumn(
            "both", t.in_both("shingles_a", "shingles_b"))
        union = F.size("shingles_a") + F.size("shingles_b") - F.col("both")
        return both.filter(F.col("both") * 100 >= union * self.percent).select(
            F.col("a").alias("u"), F.col("b").alias("v"))


def _without_hopeless(posted: DataFrame, confirm: _Confirm) -> DataFrame:
    """In postings of many classes, leave out those that cannot be linked with any of these. (A pair
    that meets in such a posting has both its classes among them; other postings stay as they are.)"""
    many = posted.groupBy("posting").agg(F.count("*").alias("lists")).filter(F.col("lists") >= CROWD)
    crowded = posted.join(many.select("posting", F.lit(True).alias("crowded")), "posting", "left")
    among = crowded.filter("crowded").select("rep").distinct()
    store = confirm.scratch.stored
    out = store(confirm.hopeless(store(among, "crowd")), "hopeless").withColumn("hopeless", F.lit(True))
    return crowded.join(out, "rep", "left").filter("crowded is null or hopeless is null").drop("crowded", "hopeless")


def _open(posted: DataFrame, turn: int) -> DataFrame:
    """The postings of several components in which two classes or more have been no centre so far. (A centre
    was compared with all classes of its posting.)"""
    been = [F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), _slot(k, n).cast("int")))
            for k, n in enumerate(CENTRES[:turn])]
    most = F.greatest(*map(F.bit_count, been), F.lit(0))
    return posted.groupBy("posting").agg(
        F.min("component").alias("least"), F.max("component").alias("most"), (F.count("*") - most).alias("others")
    ).filter("least < most and others > 1").select("posting")


def _order(turn: int) -> Column:
    return F.xxhash64(F.lit(turn), "rep")


def _slot(turn: int, centres: int) -> Column:
    """Of the classes with the same slot in a posting, the first by _order is a centre in this round."""
    return F.pmod(_order(turn), F.lit(centres))


def class_components(
    scratch: Scratch, docs: DataFrame, signed: DataFrame, words: int, similarity: float, coordinates: int, matches: int
) -> tuple[DataFrame, DataFrame]:
    """(set_lo, set_hi, rep) of every class, and (node, component) of the linked ones."""
    spark, percent, stored = docs.sparkSession, round(100 * similarity), scratch.stored
    classes = stored(
        signed.filter("n_shingles > 0 and doc_id is not null").groupBy("set_lo", "set_hi").agg(
            F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"),
            F.first("postings").alias("postings"), F.first("sketch").alias("sketch"), F.first("bits").alias("bits"),
            F.first("beyond").alias("beyond"),
        ).withColumn("number", F.monotonically_increasing_id()), "classes",
    )
    prefix = stored(_prefixes(classes, matches), "prefix")
    confirm = _Confirm(scratch, docs, classes, words, percent)
    close = F.expr(f"least(n, n_2) * 100 >= greatest(n, n_2) * {percent} and "
                   f"{_unequal(coordinates)} <= {coordinates - matches}")
    found = spark.createDataFrame([], "node bigint, component bigint")
    tried = None
    for turn, centres in enumerate((*CENTRES, None)):
        rows = prefix if centres is None else prefix.drop("w")
        posted = rows.withColumn("component", F.col("rep"))
        if turn:
            posted = rows.join(found, F.col("rep") == F.col("node"), "left").withColumn(
                "component", F.coalesce("component", "rep")).drop("node")
            posted = stored(posted.join(_open(posted, turn), "posting", "left_semi"), "posted")
            if centres is None:
                posted = _without_hopeless(posted, confirm).join(confirm.bounds.drop("n"), "rep")
                posted = stored(posted, "hopeful")
        whole = ("rep", "n", "s", "component")
        if centres is None:
            whole = (*whole, "w", "bits", "beyond")
            other = posted.select("posting", *(F.col(c).alias(f"{c}_2") for c in whole))
            # A pair that meets in several postings is made in the first that both have among their least.
            once = "coalesce(array_min(array_intersect(w, w_2)), posting) = posting"
            apart = F.expr("component != component_2 and rep < rep_2")
            near = close & F.expr(f"{once} and {_may_be_linked(percent, '', '_2')}")  # the cheapest first
        else:
            other = posted.groupBy("posting", _slot(turn, centres).alias("k")).agg(
                F.min_by(F.struct(*whole), _order(turn)).alias("c")
            ).select("posting", *(F.col(f"c.{c}").alias(f"{c}_2") for c in whole))
            apart, near = F.expr("component != component_2"), close
        pairs = posted.join(other, "posting").filter(apart & near).select(
            F.least("rep", "rep_2").alias("a"), F.greatest("rep", "rep_2").alias("b")).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        if pairs.isEmpty():
            continue
        tried = pairs if tried is None else tried.unionByName(pairs)
        links = found.selectExpr("node as u", "component as v").unionByName(confirm(pairs, centres is None))
        found = components(stored(links, "linked"))
    return classes.select("set_lo", "set_hi", "rep"), found


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS,
    similarity: float = SIMILARITY, coordinates: int = COORDINATES, matches: int = MATCHES,
) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, kept.

    Documents are linked if the similarity (shared over all shingles) of their whole sets reaches
    `similarity`, which counts in whole per cent. component_id is the smallest doc_id that can be
    reached over links, the document's own included; kept marks the document that has it.

    Cases: a null or empty text, or one of spaces only, has the empty set and is linked with
    nothing. A text with fewer words than a shingle has one shingle, all its words. A row without
    doc_id is linked with nothing, gets a null component_id, and is kept. Rows that repeat a doc_id
    with the same text agree in all columns; with another text they count as that id's further
    texts. Other columns of docs are not read. No rows give no rows.
    """
    own = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    scratch = Scratch(docs.sparkSession)
    signed = scratch.stored(signatures(own, words, coordinates), "signed")
    classes, found = class_components(scratch, own, signed, words, similarity, coordinates, matches)
    classes, found = scratch.stored(classes, "reps"), scratch.stored(found, "found")
    signed = scratch.stored(signed.select("doc_id", "n_shingles", "set_lo", "set_hi"), "sizes")
    scratch.drop_all(classes, found, signed)
    named = classes.join(found, F.col("rep") == F.col("node"), "left").select(
        "set_lo", "set_hi", F.coalesce("component", "rep").alias("class_component")
    )
    out = signed.select("doc_id", "n_shingles", "set_lo", "set_hi").join(named, ["set_lo", "set_hi"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("class_component")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce(component, F.col("doc_id")))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )
