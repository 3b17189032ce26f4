"""Ranked lexical search over a K2-treap of the term-document grid.

A block of documents is a grid with a row for each term and a column for each document; a cell holds the
impact of the term in the document, if it occurs there. The grid is stored as a compressed quadtree: for
every level, four bits for each node that say which quadrants hold anything, and the greatest impact in
each of those. Empty quadrants have no node.

Items are answered by best-first descent. An item's terms are rows; each row has one path of nodes per
range of documents, and the paths of all its rows go down together. The weighted impact maxima of the
paths, summed, bound the score of every document in the range, and are the score itself once the range is
one document. Ranges are opened by decreasing bound, some for each item at a time, so that one step serves
all items; what can no longer enter an item's best `k` is dropped: exactly, with ties by doc_id.

The jobs: (1) number of documents and of terms; (2) the blocks of the grid, a table in the shared folder;
(3) document frequencies, from the blocks; (4) for each set of items of a fixed size, one pass over the
blocks, in which a task keeps the best `k` of each item over all its blocks. Only these are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rollmark.llm import text as t
from rollmark.llm.stored import stored
from rollmark.plans.session import scratch_path

#: Terms are runs of ASCII letters and digits and of anything beyond ASCII.
OUTSIDE = np.zeros(256, bool)
OUTSIDE[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True

#: Documents and bytes of text from which a block is complete.
BLOCK_DOCS, BLOCK_BYTES = 1 << 13, 1 << 24
#: (item, term) pairs that are sent to the tasks at once, and terms by which rows are chosen beforehand.
PAIRS_AT_ONCE, ROWS_CHOSEN = 1 << 18, 1 << 21
#: Ranges of documents that are opened for an item in one step: so many, or a share of those that wait.
OPENED, SHARE = 64, 2

BLOCK = ("n_rows int, n_cols int, height int, terms array<bigint>, in_docs array<bigint>, doc_ids binary, "
         "quadrants binary, maxima binary, sizes array<bigint>")


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    docs = terms = 0
    for batch in batches:
        for i, j, data, offsets in t.slices(batch.column(0)):
            _, _, owner = t.word_spans(data, offsets, OUTSIDE)
            docs, terms = docs + len(np.unique(owner)), terms + len(owner)
    yield pa.RecordBatch.from_pydict({"docs": pa.array([docs], pa.int64()), "terms": pa.array([terms], pa.int64())})


def corpus_size(docs: DataFrame) -> tuple[int, int]:
    """(documents with a term, terms with repeats) of (text)."""
    row = docs.mapInArrow(_counts, "docs bigint, terms bigint").agg(F.sum("docs"), F.sum("terms")).first()
    return row[0] or 0, row[1] or 0


def _spread(x: np.ndarray) -> np.ndarray:
    """The bits of numbers below 2**31 moved apart by one place each."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


class Treap:
    """The quadtree of one block. Level 0 is the root; ``maxima[0]`` is its greatest impact, and
    ``maxima[l + 1]`` those of the nodes below level l, in the order of ``quadrants[l]``'s bits."""

    def __init__(self, height: int, quadrants: list[np.ndarray], maxima: list[np.ndarray]):
        self.height, self.quadrants, self.maxima = height, quadrants, maxima
        self.first = [np.concatenate([[0], np.cumsum(np.bitwise_count(q), dtype=np.int64)]) for q in quadrants]

    @classmethod
    def build(cls, rows: np.ndarray, cols: np.ndarray, impacts: np.ndarray) -> "Treap":
        """From distinct cells, at least one."""
        side = int(max(rows.max(), cols.max())) + 1
        height = max(1, (side - 1).bit_length())
        cell = (_spread(rows) << np.uint64(1)) | _spread(cols)
        order = np.argsort(cell)
        cell, high = cell[order], impacts[order].astype(np.uint32)
        quadrants, maxima = [], [high]
        for _ in range(height):
            above = cell >> np.uint64(2)
            at = t.segment_starts(above)
            bit = np.uint8(1) << (cell & np.uint64(3)).astype(np.uint8)
            quadrants.append(np.bitwise_or.reduceat(bit, at))
            high = np.maximum.reduceat(high, at)
            maxima.append(high)
            cell = above[at]
        return cls(height, quadrants[::-1], maxima[::-1])

    def below(self, level: int, node: np.ndarray, quadrant: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the nodes have something in this quadrant, and the number of the node there."""
        bits = self.quadrants[level][node]
        there = (bits >> quadrant) & np.uint8(1)
        before = np.bitwise_count(bits & ((np.uint8(1) << quadrant) - np.uint8(1)))
        return there.astype(bool), self.first[level][node] + before


def _blocks(n_docs: int, n_terms: int, chosen: np.ndarray | None, block_docs: int, block_bytes: int):
    """Arrow batches (doc_id, text) -> blocks of the grid."""

    def block(ids: list, parts: list) -> pa.RecordBatch | None:
        doc = np.concatenate([p[0] for p in parts])
        term, tf, size = (np.concatenate([p[k] for p in parts]) for k in (1, 2, 3))
        if not len(doc):
            return None
        ids = np.concatenate(ids)
        order = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        used, row = np.unique(term, return_inverse=True)
        in_docs = np.bincount(row)
        share = 100 - 50 + (50 * size * n_docs) // n_terms
        impact = (1_000_000_000 * tf) // (1000 * tf + 20 * share)
        treap = Treap.build(row, place[doc], impact)
        return pa.RecordBatch.from_pydict({
            "n_rows": pa.array([len(used)], pa.int32()), "n_cols": pa.array([len(ids)], pa.int32()),
            "height": pa.array([treap.height], pa.int32()),
            "terms": pa.array([used.view(np.int64)], pa.list_(pa.int64())),
            "in_docs": pa.array([in_docs], pa.list_(pa.int64())),
            "doc_ids": pa.array([ids[order].tobytes()], pa.binary()),
            "quadrants": pa.array([np.concatenate(treap.quadrants).tobytes()], pa.binary()),
            "maxima": pa.array([np.concatenate(treap.maxima).tobytes()], pa.binary()),
            "sizes": pa.array([[len(q) for q in treap.quadrants] + [len(treap.maxima[-1])]], pa.list_(pa.int64())),
        })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts, docs, size = [], [], 0, 0
        for batch in batches:
            for i, j, data, offsets in t.slices(batch.column(1)):
                words, owner = t.hashed_words(data, offsets, OUTSIDE)
                length = np.bincount(owner, minlength=j - i)
                if chosen is not None and len(words):
                    at = np.searchsorted(chosen, words)
                    at[at == len(chosen)] = 0
                    keep = chosen[at] == words
                    words, owner = words[keep], owner[keep]
                order = np.lexsort((words, owner))
                words, owner = words[order], owner[order]
                at = np.flatnonzero(np.concatenate(
                    [[True], (words[1:] != words[:-1]) | (owner[1:] != owner[:-1])])) if len(words) else order
                tf = np.diff(np.append(at, len(words)))
                parts.append((docs + owner[at], words[at], tf, length[owner[at]]))
                ids.append(batch.column(0).slice(i, j - i).to_numpy(zero_copy_only=False).astype(np.int64))
                docs, size = docs + j - i, size + len(data)
                if docs >= block_docs or size >= block_bytes:
                    made = block(ids, parts)
                    ids, parts, docs, size = [], [], 0, 0
                    if made is not None:
                        yield made
        if docs and (made := block(ids, parts)) is not None:
            yield made

    return run


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, data, offsets in t.slices(batch.column(1)):
            words, owner = t.hashed_words(data, offsets, OUTSIDE)
            yield pa.RecordBatch.from_pydict({
                "item_id": batch.column(0).slice(i, j - i).take(pa.array(owner)),
                "term": pa.array(words.view(np.int64)),
            })


class _Best:
    """The best `k` documents of every item so far, ordered by score and, if equal, by doc_id."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.item, self.score, self.doc = (np.zeros(0, np.int64) for _ in range(3))
        self.least = np.ones(items, np.int64)
        self.last = np.full(items, np.iinfo(np.int64).max)

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray) -> None:
        item, score, doc = (np.concatenate(x) for x in (
            (self.item, item), (self.score, score), (self.doc, doc)))
        order = np.lexsort((doc, -score, item))
        item, score, doc = item[order], score[order], doc[order]
        starts = t.segment_starts(item)
        rank = np.arange(len(item)) - np.repeat(starts, np.diff(np.append(starts, len(item))))
        keep = rank < self.k
        self.item, self.score, self.doc = item[keep], score[keep], doc[keep]
        full = rank == self.k - 1
        self.least[item[full]], self.last[item[full]] = score[full], doc[full]

    def may_enter(self, item: np.ndarray, bound: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Could a document with this score and this doc_id, or a later one, be among the best?"""
        least = self.least[item]
        return (bound > least) | ((bound == least) & (doc <= self.last[item]))


def _descend(treap: Treap, doc_ids: np.ndarray, pairs: tuple, best: _Best, opened: int) -> None:
    """Answer all items in one block. `pairs` are (item, row, weight) of the terms that occur in it."""
    item, row, weight = pairs
    height = treap.height
    # A frontier for each level: ranges (item, first column, bound) and, for each, its paths.
    empty = np.zeros(0, np.int64)
    ranges = {level: [empty] * 3 for level in range(height + 1)}
    paths = {level: [empty] * 3 for level in range(height + 1)}  # owner range, node, pair
    own, owner = np.unique(item, return_inverse=True)
    bound = np.bincount(owner, weight * int(treap.maxima[0][0])).astype(np.int64)
    ranges[0], paths[0] = [own, np.zeros(len(own), np.int64), bound], [owner, np.zeros(len(item), np.int64), np.arange(len(item))]
    while True:
        # Of all open ranges of an item, those with the greatest bounds, whatever their level.
        sizes = [len(ranges[level][0]) for level in range(height)]
        if not sum(sizes):
            return
        level_of = np.repeat(np.arange(height), sizes)
        whose, first, bound = (np.concatenate([ranges[level][c] for level in range(height)]) for c in range(3))
        alive = best.may_enter(whose, bound, doc_ids[np.minimum(first, len(doc_ids) - 1)])
        order = np.lexsort((level_of, -bound, ~alive, whose))
        starts = t.segment_starts(whose[order])
        held = np.diff(np.append(starts, len(order)))
        rank, limit = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order)) - np.repeat(starts, held)
        limit[order] = np.repeat(np.maximum(opened, held // SHARE), held)
        chosen = alive & (rank < limit)
        edges = np.concatenate([[0], np.cumsum(sizes)])
        new_ranges, new_paths = {}, {}
        for level in range(height):
            if not sizes[level]:
                continue
            here = slice(edges[level], edges[level + 1])
            take, stay = chosen[here], (alive & ~chosen)[here]
            rest, path = ranges[level], paths[level]
            if take.any():
                new_ranges[level], new_paths[level] = _halves(treap, level, rest, path, take, row, weight)
            number = np.cumsum(stay) - 1
            kept = stay[path[0]]
            ranges[level] = [x[stay] for x in rest]
            paths[level] = [number[path[0][kept]], path[1][kept], path[2][kept]]
        for level, (own, starts, bound) in new_ranges.items():
            if level + 1 == height:
                real = starts < len(doc_ids)
                ids = doc_ids[starts[real]]
                enters = best.may_enter(own[real], bound[real], ids)
                best.add(own[real][enters], bound[real][enters], ids[enters])
                continue
            there = ranges[level + 1]
            shift = len(there[0])
            ranges[level + 1] = [np.concatenate(x) for x in zip(there, (own, starts, bound))]
            path = new_paths[level]
            paths[level + 1] = [np.concatenate(x) for x in zip(paths[level + 1], (path[0] + shift, path[1], path[2]))]


def _halves(treap: Treap, level: int, ranges: list, paths: list, take: np.ndarray, row, weight) -> tuple[list, list]:
    """Both halves of the taken ranges, with the paths that go on in each."""
    number = np.cumsum(take) - 1
    going = take[paths[0]]
    owner, node, pair = number[paths[0][going]], paths[1][going], paths[2][going]
    width = 1 << (treap.height - level - 1)
    lower = ((row[pair] >> (treap.height - level - 1)) & 1).astype(np.uint8) * np.uint8(2)
    owners, nodes, followed = [], [], []
    for half in (0, 1):
        there, below = treap.below(level, node, lower + np.uint8(half))
        owners.append(owner[there] * 2 + half)
        nodes.append(below[there])
        followed.append(pair[there])
    owner, node, pair = (np.concatenate(x) for x in (owners, nodes, followed))
    high = treap.maxima[level + 1][node]
    bound = np.bincount(owner, weight[pair] * high.astype(np.float64), minlength=2 * int(take.sum())).astype(np.int64)
    reached = np.bincount(owner, minlength=len(bound)) > 0
    number = np.cumsum(reached) - 1
    own = np.repeat(ranges[0][take], 2)[reached]
    starts = (np.repeat(ranges[1][take], 2) + np.tile([0, width], int(take.sum())))[reached]
    return [own, starts, bound[reached]], [number[owner], node, pair]


def _searched(items: tuple, k: int, opened: int):
    """Blocks -> (item_id, doc_id, score) of each item's best in the task. `items` are the item ids, and
    (number of the item, term, weight) ordered by term."""
    item_ids, item, term, weight = items

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(len(item_ids), k)
        for batch in batches:
            for at in range(batch.num_rows):
                one = {name: batch.column(c)[at] for c, name in enumerate(batch.schema.names)}
                terms = one["terms"].values.to_numpy().view(np.uint64)
                row = np.searchsorted(terms, term)
                row[row == len(terms)] = 0
                there = terms[row] == term
                if not there.any():
                    continue
                sizes = one["sizes"].values.to_numpy()
                quadrants = np.frombuffer(one["quadrants"].as_buffer(), np.uint8)
                maxima = np.frombuffer(one["maxima"].as_buffer(), np.uint32)
                low, up = np.cumsum(sizes[:-1]), np.cumsum(sizes)
                treap = Treap(one["height"].as_py(), np.split(quadrants, low[:-1]), np.split(maxima, up[:-1]))
                ids = np.frombuffer(one["doc_ids"].as_buffer(), np.int64)
                _descend(treap, ids, (item[there], row[there], weight[there]), best, opened)
        if len(best.item):
            yield pa.RecordBatch.from_pydict({
                "item_id": pa.array(item_ids[best.item]), "doc_id": pa.array(best.doc), "score": pa.array(best.score)})

    return run


def index_documents(
    docs: DataFrame, n_docs: int, n_terms: int, chosen: np.ndarray | None = None, *,
    block_docs: int = BLOCK_DOCS, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The grid of (doc_id, text) as blocks of consecutive documents, stored. With `chosen`, sorted
    hashes of terms, it has only their rows."""
    made = docs.mapInArrow(_blocks(n_docs, n_terms, chosen, block_docs, block_bytes), BLOCK)
    return stored(made, "treap-blocks")


def search(
    docs: DataFrame, items: DataFrame, k: int = 50, *, block_docs: int = BLOCK_DOCS, block_bytes: int = BLOCK_BYTES,
    pairs_at_once: int = PAIRS_AT_ONCE, rows_chosen: int = ROWS_CHOSEN, opened: int = OPENED,
) -> DataFrame:
    """Each item's `k` best documents: item_id, rank (from 1), doc_id, score.

    `docs` has (doc_id, text), `items` (item_id, text). A term's weight is
    floor(1000 ln((2N + 2) / (2 df + 1))), its impact (10**9 tf) div (1000 tf + 20 m) with
    m = 50 + (50 n N) div L; the score sums weight times impact over the item's distinct terms, in whole
    numbers. Equal scores are ordered by doc_id. Terms are told apart by a 64-bit hash.

    If the items together have at most `rows_chosen` terms, the grid has only their rows: what is sent to
    the tasks is bounded, and the answers are the same. Items are then taken in sets of at most
    `pairs_at_once` (item, term) pairs, an item being in one set as a whole.

    Cases: a null or empty text, or one of separators only, has no terms: it is no document for N, and
    an item without terms, or whose terms occur nowhere, has no rows. Rows without doc_id or item_id take
    no part. Rows that repeat a doc_id are documents of their own; rows that repeat an item_id are one item
    with the terms of all. Other columns are not read. No documents or no items give no rows.
    """
    spark = docs.sparkSession
    out = "item_id bigint, rank int, doc_id bigint, score bigint"
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    own = own.filter("doc_id is not null")
    asked = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    asked = asked.filter("item_id is not null").mapInArrow(_terms, "item_id bigint, term bigint").distinct()
    asked = stored(asked, "item-terms")
    n_docs, n_terms = corpus_size(own.select("text"))
    distinct = asked.select("term").distinct()
    wanted = distinct.count()
    if not n_docs or not wanted:
        return spark.createDataFrame([], out)
    chosen = None
    if wanted <= rows_chosen:
        chosen = np.sort(distinct.toArrow().column(0).to_numpy().view(np.uint64))
    blocks = index_documents(own, n_docs, n_terms, chosen, block_docs=block_docs, block_bytes=block_bytes)
    in_docs = (
        blocks.select(F.explode(F.arrays_zip("terms", "in_docs")).alias("t"))
        .groupBy(F.col("t.terms").alias("term")).agg(F.sum("t.in_docs").alias("df"))
    )
    weight = F.floor(1000 * F.log((2.0 * n_docs + 2) / (2 * F.col("df") + 1))).cast("bigint")
    weighted = asked.join(in_docs, "term").select("item_id", "term", weight.alias("weight")).filter("weight > 0")
    # Sets of items: by a running count of their terms over a few ranges of item ids.
    counted = stored(weighted.groupBy("item_id").agg(F.count("*").alias("terms")), "item-sizes")
    weighted = stored(weighted, "weighted-terms")
    found, done = scratch_path(spark, "found"), None
    for low, high in _sets(counted, pairs_at_once):
        part = weighted.filter(F.col("item_id").between(low, high)).toArrow()
        ids, number = np.unique(part.column("item_id").to_numpy(), return_inverse=True)
        term = part.column("term").to_numpy().view(np.uint64)
        order = np.argsort(term, kind="stable")
        sent = (ids, number[order], term[order], part.column("weight").to_numpy()[order])
        best = blocks.mapInArrow(_searched(sent, k, opened), "item_id bigint, doc_id bigint, score bigint")
        best.write.mode("append").parquet(found)
        done = True
    if done is None:
        return spark.createDataFrame([], out)
    best = spark.read.schema("item_id bigint, doc_id bigint, score bigint").parquet(found)
    newest = (F.desc("score"), F.asc("doc_id"))
    salted = Window.partitionBy("item_id", F.pmod(F.xxhash64("doc_id"), F.lit(64))).orderBy(*newest)
    few = best.withColumn("rank", F.row_number().over(salted)).filter(F.col("rank") <= k)
    return few.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*newest))).filter(
        F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def _sets(counted: DataFrame, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of item ids whose items have at most `most` pairs (or are one item). The
    driver sees one row per set: each next set is the part of the running count that still fits."""
    at = None
    while True:
        rest = counted if at is None else counted.filter(F.col("item_id") > at)
        # `most` rows hold at least one whole set, as every item has a pair.
        head = rest.orderBy("item_id").limit(most + 1)
        run = head.withColumn("sum", F.sum("terms").over(Window.orderBy("item_id")))
        row = run.agg(
            F.min("item_id").alias("low"), F.max(F.when(F.col("sum") <= most, F.col("item_id"))).alias("high")).first()
        if row["low"] is None:
            return
        at = row["low"] if row["high"] is None else row["high"]
        yield row["low"], at
