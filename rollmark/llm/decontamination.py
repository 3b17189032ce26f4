"""Benchmark items in documents, found in a latent space and confirmed word by word.

1. Frequencies of hashed words over all passages (runs of WINDOW words) of all documents give TF-IDF
   weights.
2. A randomised singular value decomposition of the passages' TF-IDF matrix A: with a random matrix
   R, Y = A R; one pass over the documents sums both A'Y and Y'Y, from which the driver derives an
   orthonormal basis of Y, A's projection to it, and so the leading right singular vectors. What
   reaches the driver has a fixed size.
3. Candidates: windows of every document and passages of the items are projected to the singular
   vectors; a window is a candidate for an item if the cosine to one of its passages is high. As step
   4 asks for answer words around a window, only windows that have them there are projected.
4. A candidate is confirmed if the longest common subsequence of the item's words and the words
   around the window covers enough of the item, and enough of the item's answer words are there.
   The answer is a column of the benchmark, or else the item's RARE rarest words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from rollmark.llm import text as t

WINDOW, STEP = 16, 4
#: Hashed words; singular vectors kept, and random directions.
BITS, LATENT, DIRECTIONS = 14, 24, 32
COVERED, ANSWERED, RARE = 0.6, 0.5, 4
#: Of the share that the subsequence is to cover, the least cosine.
LIKE = 1 / 3
#: Buckets in a block of the summed matrix; bytes of items compared at once.
BLOCK, ITEM_BYTES = 1024, 1 << 18
#: Pairs of a window and an answer word near it that are looked at together.
PAIRS = 1 << 20


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, bucket, text number) of every word; punctuation parts words."""
    words, owner = t.hashed_words(data, offsets, t.PUNCTUATION)
    return words, (words >> np.uint64(64 - BITS)).astype(np.int64), owner


def _passages(owner: np.ndarray) -> np.ndarray:
    """The passage number of every word: each text is cut into runs of WINDOW words."""
    starts = t.segment_starts(owner)
    lengths = np.diff(np.append(starts, len(owner)))
    place = np.arange(len(owner)) - np.repeat(starts, lengths)
    return np.cumsum(place % WINDOW == 0) - 1


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    count, total = np.zeros(1 << BITS, np.int64), 0
    for batch in batches:
        for _, _, data, offsets in t.slices(batch.column(0)):
            _, bucket, owner = _words(data, offsets)
            if len(bucket):
                count += np.bincount(bucket, minlength=1 << BITS)
                total += int(_passages(owner)[-1]) + 1
    bucket = np.append(np.flatnonzero(count), -1)
    yield pa.RecordBatch.from_pydict({"bucket": pa.array(bucket), "n": pa.array(np.append(count[bucket[:-1]], total))})


def weights(texts: DataFrame) -> np.ndarray:
    """Inverse frequency of each hashed word over all passages (which are short: how often a word
    occurs stands for how many have it)."""
    df, total = np.zeros(1 << BITS), 0
    found = texts.mapInArrow(_frequencies, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    for r in found.collect():  # at most 2**BITS + 1 rows
        if r["bucket"] < 0:
            total = r["n"]
        else:
            df[r["bucket"]] = r["n"]
    return np.log((total + 1) / (df + 1)).astype(np.float32) + 0.01


def _products(idf: np.ndarray):
    random = np.random.default_rng(5).standard_normal((1 << BITS, DIRECTIONS)).astype(np.float32) * idf[:, None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, yy = np.zeros((1 << BITS, DIRECTIONS)), np.zeros((DIRECTIONS, DIRECTIONS))
        for batch in batches:
            for _, _, data, offsets in t.slices(batch.column(0), 1 << 19):
                _, bucket, owner = _words(data, offsets)
                if not len(bucket):
                    continue
                passage = _passages(owner)
                y = np.add.reduceat(random.take(bucket, axis=0), t.segment_starts(passage), axis=0)
                yy += y.T.astype(float) @ y
                order = np.argsort(bucket.astype(np.uint16), kind="stable")
                cuts = t.segment_starts(bucket[order])
                g[bucket[order[cuts]]] += np.add.reduceat(y.take(passage[order], axis=0), cuts, axis=0)
        both = np.vstack([g * idf[:, None], yy])
        blocks = [both[k : k + BLOCK] for k in range(0, len(both), BLOCK)]
        yield pa.RecordBatch.from_pydict({
            "block": pa.array(np.arange(len(blocks)), pa.int32()),
            "lane": pa.array(np.full(len(blocks), TaskContext.get().partitionId() % 64), pa.int32()),
            "sum": pa.array([b.tobytes() for b in blocks], pa.binary()),
        })

    return run


def _added(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(x, np.float64) for x in frame["sum"])
    return pd.DataFrame({"block": [key[0]], "sum": [total.tobytes()]})


def latent_space(texts: DataFrame, idf: np.ndarray) -> np.ndarray:
    """The leading right singular vectors of the passages' TF-IDF matrix, times the weights: a row
    per hashed word."""
    lanes = texts.mapInArrow(_products(idf), "block int, lane int, sum binary")
    lanes = lanes.groupBy("block", "lane").applyInPandas(_added, "block int, sum binary")  # of many tasks, 64 sums
    rows = lanes.groupBy("block").applyInPandas(_added, "block int, sum binary").collect()
    if not rows:
        return np.zeros((1 << BITS, LATENT), np.float32)
    both = np.concatenate([np.frombuffer(r["sum"], np.float64) for r in sorted(rows, key=lambda r: r["block"])])
    both = both.reshape(-1, DIRECTIONS)
    g, yy = both[: 1 << BITS], both[1 << BITS :]
    value, vector = np.linalg.eigh(yy)
    usable = value > max(value.max(), 1e-30) * 1e-9
    basis = vector[:, usable] / np.sqrt(value[usable])  # Y times this is orthonormal
    right = np.linalg.svd((g @ basis).T, full_matrices=False)[2][:LATENT].T
    out = np.zeros((1 << BITS, LATENT), np.float32)
    out[:, : right.shape[1]] = right * idf[:, None]
    return out


def common_subsequence(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, a column of the table as the bits of one number."""
    places: dict[int, int] = {}
    for k, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for x in b:
        hit = row & places.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


class Items:
    """A block of benchmark items: their words, answers, and passages in the latent space."""

    def __init__(self, ids: list, texts: list[str], answers: list[str | None], idf: np.ndarray, space: np.ndarray):
        def read(column: list) -> list[tuple[np.ndarray, np.ndarray]]:
            data, offsets = t.utf8(pa.array(column, pa.string()))
            words, bucket, owner = _words(data, offsets)
            cuts = np.searchsorted(owner, np.arange(len(column) + 1))
            return [(words[a:b], bucket[a:b]) for a, b in zip(cuts, cuts[1:])]

        self.ids, self.words, self.answers = ids, [], []
        vectors, of = [], []
        for k, ((words, bucket), (answer, _)) in enumerate(zip(read(texts), read(answers))):
            self.words.append(words.tolist())
            if not len(answer) and len(words):
                answer = words[np.lexsort((words, -idf[bucket]))[:RARE]]
            self.answers.append(set(answer.tolist()))
            last = max(0, len(words) - WINDOW)
            for start in sorted({*range(0, last + 1, WINDOW), last}):
                if len(words):
                    vectors.append(space[bucket[start : start + WINDOW]].sum(axis=0))
                    of.append(k)
        v = np.array(vectors, np.float32).reshape(-1, space.shape[1])
        self.vectors = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)
        self.cuts = np.searchsorted(of, np.arange(len(ids) + 1))
        self.lengths = np.array([len(w) for w in self.words], np.int64)

    def anchored(self, answered: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(hash, item, number within the item) of the words of which the region of a leak has some,
        ordered by hash, and how many of them it has at least."""
        least = np.array([int(np.ceil(answered * len(a) - 1e-9)) for a in self.answers], np.int64)
        some = [sorted(a if n > 0 else set(w)) for a, n, w in zip(self.answers, least, self.words)]
        item = np.repeat(np.arange(len(some)), [len(x) if w else 0 for x, w in zip(some, self.words)])
        word = np.array([x for own, w in zip(some, self.words) if w for x in own], np.uint64)
        number = np.arange(len(item)) - np.searchsorted(item, item)
        order = np.argsort(word, kind="stable")
        return word[order], item[order], number[order], np.maximum(least, 1)


def _ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which, number) for all numbers of every range."""
    many = np.maximum(hi - lo, 0)
    which = np.repeat(np.arange(len(lo)), many)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many) + lo[which]


def _searched(items: Items, space: np.ndarray, cosine: float, covered: float, answered: float):
    anchor, anchor_item, anchor_number, least = items.anchored(answered)
    maybe = np.zeros(1 << BITS, bool)
    maybe[(anchor >> np.uint64(64 - BITS)).astype(np.int64)] = True

    def windows(owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the windows of a slice's words begin and end; the last of a text ends with it."""
        starts = t.segment_starts(owner)
        ends = np.append(starts[1:], len(owner))
        many = np.maximum(1, -(-(ends - starts - WINDOW) // STEP) + 1)
        text = np.repeat(np.arange(len(starts)), many)
        number = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
        first = np.maximum(np.minimum(starts[text] + number * STEP, ends[text] - WINDOW), starts[text])
        return first, np.minimum(first + WINDOW, ends[text])

    def anchors(words: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, item, number of the anchor word), ordered by item."""
        at = np.flatnonzero(maybe[bucket])
        which, k = _ranges(np.searchsorted(anchor, words[at], "left"), np.searchsorted(anchor, words[at], "right"))
        order = np.argsort(anchor_item[k], kind="stable")
        return at[which][order], anchor_item[k][order], anchor_number[k][order]

    def around(first: np.ndarray, lo: np.ndarray, hi: np.ndarray, item: np.ndarray, number: np.ndarray):
        """(window, item) of windows with enough different anchor words around them; each word is
        around the windows from lo to hi."""
        ends = np.cumsum(hi - lo)
        k = 0
        while k < len(lo):  # whole items, as many as fit
            done = ends[k - 1] if k else 0
            m = max(int(np.searchsorted(ends, done + PAIRS, "right")), k + 1)
            m = int(np.searchsorted(item, item[m], "left")) if m < len(lo) else m
            m = m if m > k else int(np.searchsorted(item, item[k], "right"))
            which, window = _ranges(lo[k:m], hi[k:m])
            own, word = item[k:m][which], number[k:m][which]
            order = np.lexsort((word, window, own))
            own, window, word = own[order], window[order], word[order]
            pair = np.ones(len(own), bool)
            pair[1:] = (own[1:] != own[:-1]) | (window[1:] != window[:-1])
            new = pair.copy()
            new[1:] |= word[1:] != word[:-1]
            cuts = np.flatnonzero(pair)
            if len(cuts):
                enough = np.add.reduceat(new.astype(np.int64), cuts) >= least[own[cuts]]
                yield window[cuts[enough]], own[cuts[enough]]
            k = m

    def likeness(first: np.ndarray, last: np.ndarray, bucket: np.ndarray, row: np.ndarray, own: np.ndarray) -> np.ndarray:
        """The best cosine of each window to a passage of its item."""
        out = np.zeros(len(row), np.float32)
        for lo in range(0, len(row), 20_000):
            window, back = np.unique(row[lo : lo + 20_000], return_inverse=True)
            which, k = _ranges(first[window], last[window])
            v = np.add.reduceat(space.take(bucket[k], axis=0), t.segment_starts(which), axis=0)
            v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)
            item = own[lo : lo + 20_000]
            pair, passage = _ranges(items.cuts[item], items.cuts[item + 1])
            near = np.einsum("ij,ij->i", v[back[pair]], items.vectors[passage])
            out[lo : lo + 20_000] = np.maximum.reduceat(near, t.segment_starts(pair))
        return out

    def confirm(words: np.ndarray, item: int, lo: int, hi: int) -> tuple[float, float]:
        own = items.words[item]
        region = words[lo:hi].tolist()
        there = set(region)
        answer = items.answers[item]
        share = len(answer & there) / len(answer) if answer else 1.0
        # a common subsequence has no words but those of the item that are there
        if share < answered or sum(map(there.__contains__, own)) < covered * len(own):
            return 0.0, share
        return common_subsequence(own, region) / len(own), share

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for i, j, data, offsets in t.slices(batch.column(1)):
                words, bucket, owner = _words(data, offsets)
                if not len(words) or not len(anchor):
                    continue
                place, of, number = anchors(words, bucket)
                if not len(place):
                    continue
                first, last = windows(owner)
                found: dict[tuple[int, int], tuple[float, float, float, int]] = {}
                bounds = np.searchsorted(owner, np.arange(j - i + 1))
                n = items.lengths[of]
                lo = np.searchsorted(first, np.maximum(place - n - WINDOW + 1, bounds[owner[place]]), "left")
                hi = np.searchsorted(first, np.minimum(place + n + 1, bounds[owner[place] + 1]), "left")
                for row, own in around(first, lo, hi, of, number):
                    like = likeness(first, last, bucket, row, own)
                    near = like >= cosine
                    at, item, how = first[row[near]], own[near], like[near]
                    order = np.lexsort((at, item))
                    at, item, how = at[order], item[order], how[order]
                    new = np.ones(len(at), bool)  # windows of one item that are close have one region
                    new[1:] = (item[1:] != item[:-1]) | (owner[at[1:]] != owner[at[:-1]]) | (np.diff(at) > 2 * WINDOW)
                    cuts = np.append(np.flatnonzero(new), len(at))
                    for x, z in zip(cuts, cuts[1:]):
                        doc, own_item = int(owner[at[x]]), int(item[x])
                        n = int(items.lengths[own_item])
                        while x < z:  # but a region does not grow with the text
                            y = x + int(np.searchsorted(at[x:z], at[x] + max(n, 2 * WINDOW), "right"))
                            left = max(int(bounds[doc]), int(at[x]) - n)
                            right = min(int(bounds[doc + 1]), int(at[y - 1]) + WINDOW + n)
                            part, share = confirm(words, own_item, left, right)
                            if part >= covered:
                                hit = (part, share, float(how[x:y].max()), left - int(bounds[doc]))
                                found[doc, own_item] = max(hit, found.get((doc, own_item), hit))
                            x = y
                if found:
                    keys = sorted(found)
                    rows = [found[k] for k in keys]
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": ids.take(pa.array([i + k[0] for k in keys])),
                        "item_id": pa.array([items.ids[k[1]] for k in keys], pa.int64()),
                        "overlap": pa.array([r[0] for r in rows]), "answered": pa.array([r[1] for r in rows]),
                        "cosine": pa.array([r[2] for r in rows]), "start_word": pa.array([r[3] for r in rows], pa.int64()),
                    })

    return run


def leaks(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item: str = "text", answer: str | None = None, cosine: float | None = None, covered: float = COVERED,
    answered: float = ANSWERED,
) -> DataFrame:
    """One row per document row and item that is in it: doc_id, item_id, overlap (the share of the
    item's words in the longest common subsequence), answered, cosine, start_word. Unless given, the
    least cosine follows from covered; it is low enough for words left out, replaced and inserted.

    Null, empty and wordless texts on either side match nothing. A text shorter than a window is
    one window. Repeated document rows give repeated rows, repeated items too. A row without doc_id
    can have leaks and gives rows with a null doc_id; items without an item_id alike. Other columns
    are not read. No documents or no items give no rows.
    """
    spark = docs.sparkSession
    cosine = LIKE * covered if cosine is None else cosine
    own = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    idf = weights(own.select("text"))
    space = latent_space(own.select("text"), idf)
    schema = "doc_id bigint, item_id bigint, overlap double, answered double, cosine double, start_word bigint"
    items = benchmark.select(
        F.col(item_id).cast("bigint").alias("item_id"), F.coalesce(F.col(item).cast("string"), F.lit("")).alias("text"),
        (F.col(answer).cast("string") if answer else F.lit(None).cast("string")).alias("answer"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 100), F.lit(0))).first()[0]
    blocks = max(1, -(-size // ITEM_BYTES))
    out = spark.createDataFrame([], schema)
    for k in range(blocks):  # a block of items is small enough to be sent to every task
        some = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        block = Items([r.item_id for r in some], [r.text for r in some], [r.answer for r in some], idf, space)
        out = out.unionByName(own.mapInArrow(_searched(block, space, cosine, covered, answered), schema))
    return out
