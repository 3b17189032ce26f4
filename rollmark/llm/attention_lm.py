"""A small causal self-attention model over subword ids, trained in numpy, and its scoring.

A text is its ids and then an end id. In a window of WINDOW ids each position attends to itself and
those before it (one head, learned position scores); what it gathers, added to its own vector and
rectified, predicts the class of the next id. An id's probability is its class's, times its share
of the class after ids of the current class, drawn to its share in all ids. Classes group ids that are
alike in what is around them. All these counts are of all training texts. So are the weights: a few texts
give them a common start, then every task goes on with each window of its training texts, and the mean by
ids is taken.

Windows overlap: a window scores only its last STRIDE positions (the first window all of them), so
every id is scored once, and with at least WINDOW - STRIDE ids before it wherever there are so many.

Beside it, the scores of a plain word model with add-one smoothing are returned. Its counts are of
all training texts. The HEAD most frequent words are looked up where the text is read; the others
are joined, so no word is frequent enough to weigh on a single task.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from rollmark.llm import text as t
from rollmark.llm.packing import Encoder
from rollmark.llm.stored import stored

END_ID, IDS = 50256, 50257
WINDOW, STRIDE = 32, 24
#: Ids with a vector of their own; classes; widths.
OWN, CLASSES, KEY, VALUE = 2048, 128, 16, 32
#: Ids of training texts that the weights start from; steps and windows of a step.
SAMPLE, STEPS, BATCH = 1_000_000, 800, 128
#: Rate of the tasks, which fit the weights on all training texts, and the ids they take at a time.
RATE, AT_A_TIME = 0.002, 1_000_000
#: Ids with a context, and the frequent ids that it is counted by, on either side.
KNOWN, NEAR = 4096, 255
#: Logarithms within these bounds, either way, are taken as they are by exp; of others the largest is subtracted.
REACH = 80.0
#: Weight of the share in all texts, in occurrences.
PULL = 10.0
HEAD = 1 << 16
_END_WORD = np.uint64(0x5851F42D4C957F2D)


# --- windows ------------------------------------------------------------------------------------


def windows(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For sequences of so many predictions each: the window's sequence, its first position there,
    and how many of its leading positions another window scores."""
    many = np.maximum(1, -(-(lengths - WINDOW) // STRIDE) + 1)
    owner = np.repeat(np.arange(len(lengths)), many)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
    return owner, number * STRIDE, np.where(number > 0, WINDOW - STRIDE, 0)


class Model:
    """Weights, and the maps from ids to symbols (inputs) and classes (outputs)."""

    def __init__(self, counts: np.ndarray, follows: np.ndarray | None, class_of: np.ndarray | None = None,
                 pair: np.ndarray | None = None):
        """counts: of each id in all training texts; follows: all pairs (id, next id), or the classes
        and how often each id follows each class."""
        rng = np.random.default_rng(11)
        if follows is not None:
            class_of = _classes(counts, _contexts(counts)(follows[:, 0], follows[:, 1], np.zeros(KNOWN * 512, np.int64)))
            pair = _pairs(class_of)(follows[:, 0], follows[:, 1], np.zeros(CLASSES * IDS, np.int64))
        self.class_of = class_of
        order = np.lexsort((np.arange(IDS), -counts))
        self.symbol = OWN + self.class_of
        self.symbol[order[:OWN]] = np.arange(OWN)
        weight = counts + 0.05
        share = weight / np.bincount(self.class_of, weight, CLASSES)[self.class_of]
        pair = pair.reshape(CLASSES, IDS)
        self.share = np.empty((CLASSES, IDS), np.float32)
        for own, row in zip(self.share, pair):  # by class, as all at once takes ten times the room
            both = np.bincount(self.class_of, row, CLASSES)
            own[:] = np.log((row + PULL * share) / (both[self.class_of] + PULL))
        n = OWN + CLASSES

        def table(rows: int, width: int, scale: float) -> np.ndarray:
            return (rng.standard_normal((rows, width)) * scale).astype(np.float32)

        self.p = {
            "q": table(n, KEY, 0.3), "k": table(n, KEY, 0.3), "v": table(n, VALUE, 0.1), "r": table(n, VALUE, 0.3),
            "u": table(VALUE, CLASSES, 0.1), "place": np.zeros((WINDOW, WINDOW), np.float32),
        }
        seen = np.bincount(self.class_of, counts, CLASSES) + 1
        held = np.bincount(self.class_of, minlength=CLASSES) > 0
        self.p["b"] = np.where(held, np.log(seen / seen.sum()), -1e4).astype(np.float32)
        self.mask = np.where(np.tri(WINDOW, dtype=bool), 0, -1e9).astype(np.float32)

    def table(self) -> np.ndarray:
        """What is looked up for a symbol: q (scaled), k, v, a 1 that counts the weights, and r."""
        p = self.p
        ones = np.ones((OWN + CLASSES, 1), np.float32)
        return np.concatenate([p["q"] * float(1 / np.sqrt(KEY)), p["k"], p["v"], ones, p["r"]], axis=1)

    def attend(self, x: np.ndarray, table: np.ndarray, lo: int = 0) -> tuple[np.ndarray, ...]:
        """For the positions of each window from lo on: weights that are not divided by their sum, what they gather
        and their sum, and what predicts the next class before it is rectified."""
        own = table.take(x, axis=0)
        q, k, v, r = own[:, lo:, :KEY], own[:, :, KEY : 2 * KEY], own[:, :, 2 * KEY : -VALUE], own[:, lo:, -VALUE:]
        a = q @ k.transpose(0, 2, 1)
        a += self.p["place"][lo:]
        beyond = a.size and (a.max() > REACH or a.min() < -REACH)
        a += self.mask[lo:]
        if beyond:
            a -= a.max(axis=2, keepdims=True)
        np.exp(a, out=a)
        o = a @ v
        o[:, :, :VALUE] /= o[:, :, VALUE:]
        return q, k, v, a, o, r + o[:, :, :VALUE]

    def classes(self, g: np.ndarray) -> np.ndarray:
        """For each row what the classes' probabilities are in proportion to, as logarithms that exp can take."""
        z = g @ self.p["u"]
        z += self.p["b"]
        if len(z) and (z.max() > REACH or z[:, np.argmax(self.p["b"])].min() < -REACH):
            z -= z.max(axis=1, keepdims=True)
        return z

    def step(self, x: np.ndarray, y: np.ndarray, used: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss over the used positions, and its gradients."""
        p, lo = self.p, int(used.any(axis=0).argmax())
        used, y = used[:, lo:], y[:, lo:]
        q, k, v, a, o, h = self.attend(x, self.table(), lo)
        g, target = np.maximum(h[used], 0), y[used]  # a row for each used position
        e = self.classes(g)
        np.exp(e, out=e)
        rows, n = np.arange(len(target)), max(1, len(target))
        total = e @ np.ones(CLASSES, np.float32)
        loss = float(-np.log(np.maximum(e[rows, target] / total, 1e-30)).sum() / n)
        e *= (1 / (total * n))[:, None]
        e[rows, target] -= 1 / n
        dh = np.zeros_like(h)
        dh[used] = (e @ p["u"].T) * (g > 0)
        do = np.empty_like(o)
        np.divide(dh, o[:, :, VALUE:], out=do[:, :, :VALUE])
        do[:, :, VALUE] = -np.einsum("btv,btv->bt", do[:, :, :VALUE], o[:, :, :VALUE])
        ds = do @ v.transpose(0, 2, 1)
        ds *= a
        d = np.zeros((*x.shape, 2 * KEY + 2 * VALUE), np.float32)
        d[:, lo:, :KEY] = ds @ k
        d[:, :, KEY : 2 * KEY] = ds.transpose(0, 2, 1) @ q
        d[:, :, 2 * KEY : -VALUE] = a.transpose(0, 2, 1) @ do[:, :, :VALUE]
        d[:, lo:, -VALUE:] = dh
        order = np.argsort(x.astype(np.int16), axis=None, kind="stable")
        symbols = x.ravel()[order]
        starts = np.flatnonzero(np.diff(symbols, prepend=-1))
        sums = np.zeros((OWN + CLASSES, d.shape[2]), np.float32)
        sums[symbols[starts]] = np.add.reduceat(d.reshape(-1, d.shape[2]).take(order, axis=0), starts, axis=0)
        place = np.zeros_like(p["place"])
        place[lo:] = ds.sum(axis=0)
        return loss, {
            "u": g.T @ e, "b": np.ones(len(e), np.float32) @ e, "place": place,
            "q": sums[:, :KEY] * float(1 / np.sqrt(KEY)), "k": sums[:, KEY : 2 * KEY],
            "v": sums[:, 2 * KEY : -VALUE], "r": sums[:, -VALUE:]}

    def fit(
        self, sequences: list[np.ndarray], steps: int = STEPS, batch: int = BATCH, begun: bool = False,
    ) -> list[float]:
        """Adam over windows of the sequences, drawn in a fixed random order; if it has begun, at a low
        rate over each window once, in as many steps as that takes."""
        x, y, used = self._laid_out(sequences)
        rng, losses = np.random.default_rng(12), []
        if begun:
            parts = []
            for rows in (np.flatnonzero(used[:, 0]), np.flatnonzero(~used[:, 0])):  # first windows, and the others
                if len(rows):
                    parts += np.array_split(rng.permutation(rows), -(-len(rows) // batch))
            parts = [parts[i] for i in rng.permutation(len(parts))]
            steps = len(parts)
        m = {c: np.zeros_like(w) for c, w in self.p.items()}
        s = {c: np.zeros_like(w) for c, w in self.p.items()}
        for i in range(1, steps + 1):
            rows = parts[i - 1] if begun else rng.integers(0, len(x), batch)
            loss, grads = self.step(x[rows], y[rows], used[rows])
            losses.append(loss)
            rate = (RATE if begun else 0.02) * min(1, i / 30) * (1 - 0.9 * i / steps)
            for c, d in grads.items():
                m[c] *= 0.9
                m[c] += 0.1 * d
                s[c] *= 0.99
                s[c] += 0.01 * (d * d)
                by = np.sqrt(s[c])
                by *= (1 - 0.99**i) ** -0.5
                by += 1e-8
                np.divide(m[c], by, out=by)
                by *= rate / (1 - 0.9**i)
                self.p[c] -= by
        return losses

    def _laid_out(self, sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lengths = np.array([len(q) - 1 for q in sequences])
        flat = np.concatenate(sequences).astype(np.int64)
        starts = np.cumsum(lengths + 1) - lengths - 1
        owner, first, done = windows(lengths)
        place = first[:, None] + np.arange(WINDOW)
        inside = place < lengths[owner][:, None]
        at = starts[owner][:, None] + np.where(inside, place, 0)
        return self.symbol[flat[at]], self.class_of[flat[at + 1]], inside & (np.arange(WINDOW) >= done[:, None])

    def log10(self, sequences: list[np.ndarray], most: int = 128) -> np.ndarray:
        """Decimal logarithm of each sequence's probability; a sequence begins with the end id,
        which is not scored."""
        out = np.zeros(len(sequences))
        lengths = np.array([len(q) - 1 for q in sequences])
        flat = np.concatenate(sequences).astype(np.int64)
        starts = np.cumsum(lengths + 1) - lengths - 1
        owner, first, done = windows(lengths)
        table, ones = self.table(), np.ones(CLASSES, np.float32)
        for skip in (0, WINDOW - STRIDE):  # first windows, and the others, of which so many positions are not scored
            kind = np.flatnonzero(done == skip)
            for i in range(0, len(kind), most):
                o, f = owner[kind[i : i + most]], first[kind[i : i + most]]
                place = f[:, None] + np.arange(WINDOW)
                inside = place < lengths[o][:, None]
                at = starts[o][:, None] + np.where(inside, place, 0)
                *_, h = self.attend(self.symbol[flat[at]], table, skip)
                scored, at = inside[:, skip:], at[:, skip:]
                row, _ = np.nonzero(scored)
                target = flat[at[scored] + 1]
                z = self.classes(np.maximum(h[scored], 0))
                score = z[np.arange(len(z)), self.class_of[target]]
                np.exp(z, out=z)
                score = score - np.log(z @ ones) + self.share[self.class_of[flat[at[scored]]], target]
                out += np.bincount(o[row], score, len(out))
        return out / np.log(10)


def _known(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All ids, the most frequent first, and those of them that have a context."""
    order = np.lexsort((np.arange(IDS), -counts))
    return order, order[:KNOWN][counts[order[:KNOWN]] > 0]


def _contexts(counts: np.ndarray):
    """Counts of what comes after and before each known id, by the frequent ids."""
    order, known = _known(counts)
    row, column = np.full(IDS, -1), np.full(IDS, NEAR)
    row[known], column[order[:NEAR]] = np.arange(len(known)), np.arange(NEAR)

    def add(before: np.ndarray, after: np.ndarray, sums: np.ndarray) -> np.ndarray:
        for own, other, shift in ((before, after, 0), (after, before, 256)):
            r = row[own]
            np.add.at(sums, (r * 512 + column[other] + shift)[r >= 0], 1)
        return sums

    return add


def _pairs(class_of: np.ndarray):
    """Counts of each id after each class."""

    def add(before: np.ndarray, after: np.ndarray, sums: np.ndarray) -> np.ndarray:
        np.add.at(sums, class_of[before] * IDS + after, 1)
        return sums

    return add


def _classes(counts: np.ndarray, contexts: np.ndarray) -> np.ndarray:
    """A class for every id: k-means over what comes before and after it; ids that are too rare to
    tell are grouped by how often they occur."""
    rng = np.random.default_rng(13)
    order, known = _known(counts)
    out = np.full(IDS, CLASSES - 1)
    rest = order[len(known) :]
    out[rest[counts[rest] > 0]] = CLASSES - 2
    groups = CLASSES - 2
    if len(known) <= groups:
        out[known] = np.arange(len(known))
        return out
    context = contexts.reshape(KNOWN, 512)[: len(known)].astype(float)
    context = np.sqrt(context / np.maximum(context.sum(axis=1, keepdims=True), 1))
    weight = np.sqrt(counts[known].astype(float))
    centre = context[:groups].copy()
    for _ in range(15):
        gap = (centre**2).sum(axis=1) - 2 * context @ centre.T
        near = np.argmin(gap, axis=1)
        total = np.bincount(near, weight, groups)
        moved = np.zeros_like(centre)
        np.add.at(moved, near, context * weight[:, None])
        empty = total == 0
        centre = moved / np.maximum(total, 1e-9)[:, None]
        centre[empty] = context[rng.integers(0, len(known), empty.sum())]
    out[known] = near
    return out


# --- distributed parts ------------------------------------------------------------------------


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words, as sums over some megabytes of text."""
    held: list[np.ndarray] = []

    def flush() -> pa.RecordBatch:
        word, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *held]), return_counts=True)
        held.clear()
        return pa.RecordBatch.from_pydict({"word": pa.array(word.view(np.int64)), "n": pa.array(n, pa.int64())})

    size = 0
    for batch in batches:
        for i, j, data, offsets in t.slices(batch.column(0)):
            held.append(t.hashed_words(data, offsets)[0])
            held.append(np.full(j - i, _END_WORD))
            size += len(held[-2])
            if size > 2_000_000:
                yield flush()
                size = 0
    yield flush()


def _read(head_words: np.ndarray, head_counts: np.ndarray, vocabulary: str | None, ranks: str | None):
    """(row, doc_id, held_out, text) -> ids, and the word model's sums over the head."""
    logs = np.log10(head_counts + 1.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(vocabulary, ranks)
        for batch in batches:
            texts = batch.column(3)
            for i, j, data, offsets in t.slices(texts):
                words, owner = t.hashed_words(data, offsets)
                words = np.concatenate([words, np.full(j - i, _END_WORD)])
                owner = np.concatenate([owner, np.arange(j - i)])
                at = np.minimum(np.searchsorted(head_words, words), max(0, len(head_words) - 1))
                hit = head_words[at] == words if len(head_words) else np.zeros(len(words), bool)
                tail = np.flatnonzero(~hit)
                tail = tail[np.argsort(owner[tail], kind="stable")]
                bounds = np.searchsorted(owner[tail], np.arange(j - i + 1)).astype(np.int32)
                ids = [np.array(encode(x or ""), dtype="<u2").tobytes() for x in texts.slice(i, j - i).to_pylist()]
                yield pa.RecordBatch.from_pydict({
                    "row": batch.column(0).slice(i, j - i), "doc_id": batch.column(1).slice(i, j - i),
                    "held_out": batch.column(2).slice(i, j - i), "ids": pa.array(ids, pa.binary()),
                    "n_tokens": pa.array(np.bincount(owner, minlength=j - i), pa.int64()),
                    "head_known": pa.array(np.bincount(owner[hit], minlength=j - i), pa.int64()),
                    "head_sum": pa.array(np.bincount(owner[hit], logs[at[hit]] if len(logs) else None, j - i).astype(float)),
                    "tail": pa.ListArray.from_arrays(bounds, words[tail].view(np.int64)),
                })

    return run


def _sequence(ids: bytes) -> np.ndarray:
    return np.concatenate([[END_ID], np.frombuffer(ids, "<u2"), [END_ID]])


def _id_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(IDS, np.int64)
    for batch in batches:
        for ids in batch.column(0).to_pylist():
            counts += np.bincount(np.frombuffer(ids, "<u2"), minlength=IDS) if len(ids) > 200_000 else 0
            if len(ids) <= 200_000:
                np.add.at(counts, np.frombuffer(ids, "<u2"), 1)
            counts[END_ID] += 1
    seen = np.flatnonzero(counts)
    yield pa.RecordBatch.from_pydict({"id": pa.array(seen, pa.int64()), "n": pa.array(counts[seen], pa.int64())})


def _sums(read: DataFrame, add, size: int, block: int) -> np.ndarray:
    """What add() counts in the pairs (id, next id) of all texts: a table of a fixed size per task,
    summed block by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(size, np.int64)
        for batch in batches:
            some = [_sequence(x) for x in batch.column(0).to_pylist()]
            if some:
                flat = np.concatenate(some).astype(np.int64)
                inside = np.ones(len(flat), bool)
                inside[np.cumsum([len(x) for x in some]) - 1] = False
                for lo in range(0, len(flat) - 1, 1 << 20):
                    at = lo + np.flatnonzero(inside[lo : min(lo + (1 << 20), len(flat) - 1)])
                    add(flat[at], flat[at + 1], sums)
        for k in range(0, size, block):
            own = sums[k : k + block]
            at = np.flatnonzero(own)
            if len(at):
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([k], pa.int64()), "lane": pa.array([TaskContext.get().partitionId() % 64], pa.int32()),
                    "at": pa.array([at.astype(np.int32).tobytes()], pa.binary()), "n": pa.array([own[at].tobytes()], pa.binary())})

    def added(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        sums = np.zeros(block, np.int64)
        for x, n in zip(frame["at"], frame["n"]):
            sums[np.frombuffer(x, np.int32)] += np.frombuffer(n, np.int64)
        at = np.flatnonzero(sums)
        return pd.DataFrame({"block": [key[0]], "at": [at.astype(np.int32).tobytes()], "n": [sums[at].tobytes()]})

    kind = "block bigint, at binary, n binary"
    lanes = read.select("ids").mapInArrow(run, "block bigint, lane int, at binary, n binary")
    lanes = lanes.groupBy("block", "lane").applyInPandas(added, kind)  # of many tasks, 64 sums
    out = np.zeros(size, np.int64)
    for r in lanes.groupBy("block").applyInPandas(added, kind).toLocalIterator():
        out[r["block"] + np.frombuffer(r["at"], np.int32)] = np.frombuffer(r["n"], np.int64)
    return out


def _fitted(read: DataFrame, model: Model) -> None:
    """Every task goes on with the weights over all its texts, some megabytes at a time; the model gets
    the mean, by ids."""
    shared = read.sparkSession.sparkContext.broadcast(model)  # a fixed size
    names = sorted(model.p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, held, size, total = copy.copy(shared.value), [], 0, 0
        own.p = {c: w.copy() for c, w in own.p.items()}

        def go_on() -> None:
            own.fit(held, begun=True)
            held.clear()

        for batch in batches:
            for ids in batch.column(0).to_pylist():
                held.append(_sequence(ids))
                size, total = size + len(held[-1]), total + len(held[-1])
                if size > AT_A_TIME:
                    go_on()
                    size = 0
        if size:
            go_on()
        if total:
            flat = np.concatenate([own.p[c].ravel() for c in names]).astype(np.float64) * total
            yield pa.RecordBatch.from_pydict({
                "lane": pa.array([TaskContext.get().partitionId() % 64], pa.int32()), "n": pa.array([total], pa.int64()),
                "w": pa.array([flat.tobytes()], pa.binary())})

    def added(frame: pd.DataFrame) -> pd.DataFrame:
        w = sum(np.frombuffer(x, np.float64) for x in frame["w"])
        return pd.DataFrame({"lane": [int(frame["lane"].iloc[0]) // 8], "n": [int(frame["n"].sum())], "w": [w.tobytes()]})

    kind = "lane int, n bigint, w binary"
    lanes = read.select("ids").mapInArrow(run, kind)
    for _ in range(2):  # of many tasks, 64 sums and then 8
        lanes = lanes.groupBy("lane").applyInPandas(added, kind)
    got = lanes.toPandas()
    if len(got):
        got = added(got)
        flat, at = np.frombuffer(got["w"][0], np.float64) / got["n"][0], 0
        for c in names:
            w = model.p[c]
            model.p[c], at = flat[at : at + w.size].reshape(w.shape).astype(np.float32), at + w.size


def train(read: DataFrame, sample: int = SAMPLE, steps: int = STEPS) -> Model:
    """Fit on the rows (doc_id, ids) of training texts: counts over all of them, first weights on
    about `sample` ids of texts chosen by a hash, then weights on all texts."""
    counts = np.zeros(IDS, np.int64)
    for r in read.select("ids").mapInArrow(_id_counts, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[r["id"]] = r["n"]
    class_of = _classes(counts, _sums(read, _contexts(counts), KNOWN * 512, 256 * 512))
    model = Model(counts, None, class_of, _sums(read, _pairs(class_of), CLASSES * IDS, 4 * IDS))
    share = min(1.0, sample / max(1, counts.sum()))
    place = F.pmod(F.xxhash64(F.lit("fit"), "doc_id", "ids"), F.lit(1_000_000))
    chosen = read.filter(place < int(1_000_000 * share) + 1)
    taken, got = 0, []
    for r in chosen.select("ids").orderBy(F.xxhash64("doc_id", "ids")).limit(20_000).toLocalIterator():
        got.append(_sequence(bytes(r["ids"])))
        taken += len(got[-1])
        if taken > 2 * sample:
            break
    model.fit(got or [np.array([END_ID, END_ID])], steps)
    got.clear()
    _fitted(read, model)
    return model


def score(
    docs: DataFrame, training: Column, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE,
    steps: int = STEPS, head: int = HEAD, vocabulary: str | None = None, ranks: str | None = None,
) -> DataFrame:
    """One row per row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    `training` says which rows are learned from; where it is null the row is held out. A null or
    empty text has its end token alone. Repeated rows are scored, and learned from, each by itself.
    If nothing is learned from, no token is known and the model has its initial weights. Other
    columns of docs are not read. No rows give no rows.
    """
    own = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), (~F.coalesce(training, F.lit(False))).alias("held_out"),
        F.col(text).cast("string").alias("text"))
    words = own.filter(~F.col("held_out")).select("text").mapInArrow(_word_counts, "word bigint, n bigint")
    counts = stored(words.groupBy("word").agg(F.sum("n").alias("n")), "words")
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    frequent = counts.orderBy(F.desc("n"), "word").limit(head).collect()
    top = np.array(sorted((np.array(r["word"], np.int64).view(np.uint64), r["n"]) for r in frequent), dtype=object).reshape(-1, 2)
    read = own.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text").mapInArrow(
        _read(top[:, 0].astype(np.uint64), top[:, 1].astype(float), vocabulary, ranks),
        "row bigint, doc_id bigint, held_out boolean, ids binary, n_tokens bigint, head_known bigint, "
        "head_sum double, tail array<bigint>")
    read = stored(read, "read")
    tail = read.select("row", F.explode("tail").alias("word")).groupBy("word", "row").count().join(counts, "word")
    tail = tail.groupBy("row").agg(
        F.sum("count").alias("tail_known"), F.sum(F.col("count") * F.log10(F.col("n") + 1.0)).alias("tail_sum"))
    shared = docs.sparkSession.sparkContext.broadcast(train(read.filter("not held_out"), sample, steps))  # a fixed size

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [_sequence(x) for x in batch.column(1).to_pylist()]
            sizes = np.cumsum([len(x) for x in ids])
            total, lo = np.zeros(len(ids)), 0
            while lo < len(ids):
                hi = max(lo + 1, int(np.searchsorted(sizes, (sizes[lo - 1] if lo else 0) + 500_000)))
                total[lo:hi] = shared.value.log10(ids[lo:hi])
                lo = hi
            yield pa.RecordBatch.from_pydict({"row": batch.column(0), "score": pa.array(total)})

    scores = read.select("row", "ids").mapInArrow(scored, "row bigint, score double")
    out = read.drop("ids", "tail").join(tail, "row", "left").join(scores, "row")
    known = F.col("head_known") + F.coalesce("tail_known", F.lit(0))
    base = F.col("head_sum") + F.coalesce("tail_sum", F.lit(0.0)) - F.col("n_tokens") * float(np.log10(n + v + 1))
    return out.select(
        "doc_id", "held_out", "n_tokens", known.cast("bigint").alias("n_known"),
        F.lit(n).cast("bigint").alias("train_tokens"), base.alias("base_score"), "score")
