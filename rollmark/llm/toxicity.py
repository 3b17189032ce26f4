"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

1. Over all labelled texts, the number of toxic and of other texts with each hashed n-gram is
   counted. Its ratio r is the logarithm of the smoothed share among toxic texts over the share
   among the others.
2. The n-grams whose ratio stands out most from chance are kept as features.
3. A text's feature is r if it has the n-gram and 0 otherwise; a logistic classifier over these is
   fitted on a bounded sample of labelled rows, weighted back to the classes' true shares.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType

from rollmark.llm import text as t
from rollmark.llm.ngrams import grams, sampled

ORDERS, BITS = (3, 4, 5), 18
#: Features kept; labelled rows per class that the weights are fitted on.
FEATURES, SAMPLE = 1 << 14, 4000
#: Labels are sent to every task up to so many; more are joined by shuffling.
SENT_LABELS = 1_000_000


def _present(column: pa.Array, wanted: np.ndarray | None = None) -> Iterator[np.ndarray]:
    """The distinct buckets of each text, or the wanted ones among them, in order."""
    mark = np.zeros(1 << BITS, bool)
    for i, j, data, offsets in t.slices(column):
        found = []
        for bucket, text in grams(data, offsets, ORDERS, BITS):
            if wanted is not None:
                hit = np.flatnonzero(wanted[bucket])
                bucket, text = bucket[hit], text[hit]
            found.append((bucket, np.searchsorted(text, np.arange(j - i + 1))))
        for k in range(j - i):
            own = [bucket[cuts[k] : cuts[k + 1]] for bucket, cuts in found]
            if wanted is not None:
                yield np.unique(np.concatenate([np.zeros(0, np.int64), *own]))
                continue
            for bucket in own:
                mark[bucket] = True
            buckets = np.flatnonzero(mark)
            mark[buckets] = False
            yield buckets


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((2, 1 << BITS), np.int64)
    for batch in batches:
        labels = batch.column(0).to_numpy(zero_copy_only=False)
        for label, buckets in zip(labels, _present(batch.column(1))):
            counts[int(label)][buckets] += 1
    bucket = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_pydict({
        "bucket": pa.array(bucket), "toxic": pa.array(counts[1, bucket]), "other": pa.array(counts[0, bucket]),
    })


class Model:
    """Which n-grams count (`wanted`), and what each adds to the log odds (`weight`)."""

    def __init__(self, wanted: np.ndarray, weight: np.ndarray, bias: float):
        self.wanted, self.weight, self.bias = wanted, weight, bias

    def score(self, column: pa.Array) -> np.ndarray:
        odds = np.array([self.bias + self.weight[b].sum() for b in _present(column, self.wanted)])
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def _fit(rows: list[np.ndarray], y: np.ndarray, share: np.ndarray, ratio: np.ndarray) -> tuple[np.ndarray, float]:
    """Weighted logistic regression on r-valued features (numbers 0..len(ratio)-1)."""
    lengths = np.array([len(r) for r in rows])
    column = np.concatenate([np.zeros(0, np.int64), *rows]).astype(np.int64)
    row = np.repeat(np.arange(len(rows)), lengths)
    value = ratio[column]
    w, speed = np.zeros(len(ratio)), np.zeros(len(ratio)) + 1e-8
    bias, bias_speed = 0.0, 1e-8
    for _ in range(120):
        odds = np.bincount(row, value * w[column], minlength=len(rows)) + bias
        error = share * (1 / (1 + np.exp(-np.clip(odds, -500, 500))) - y)
        slope = np.bincount(column, value * error[row], minlength=len(ratio)) + 1e-4 * w
        speed += slope**2
        w -= 0.05 * slope / np.sqrt(speed)
        bias_speed += error.sum() ** 2
        bias -= 0.2 * error.sum() / np.sqrt(bias_speed)
    return w, bias


def _picked(numbers: np.ndarray):
    wanted = numbers >= 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [numbers[b].astype(np.int32).tobytes() for b in _present(batch.column(1), wanted)]
            yield pa.RecordBatch.from_pydict({"label": batch.column(0), "x": pa.array(rows, pa.binary())})

    return run


def train(labelled: DataFrame, features: int = FEATURES, sample: int = SAMPLE) -> Model:
    """Fit on rows of (key, text, label) with labels 0 and 1; other labels are not learned from.
    Without rows of both labels the score is the share of toxic rows everywhere (0.5 without any)."""
    rows = labelled.filter("label in (0, 1)").select("key", "text", F.col("label").cast("int").alias("label"))
    chosen, counts = sampled(rows, "label", F.col("key"), sample)
    n = np.array([counts.get(0, 0), counts.get(1, 0)], float)
    if not n.all():
        nothing = np.zeros(1 << BITS)
        return Model(nothing.astype(bool), nothing, 0.0 if not n.any() else (30.0 if n[1] else -30.0))
    table = rows.select("label", "text").mapInArrow(_counted, "bucket bigint, toxic bigint, other bigint")
    table = table.groupBy("bucket").agg(F.sum("toxic").alias("p"), F.sum("other").alias("q"))
    r = F.log((F.col("p") + 1) / (n[1] + 2)) - F.log((F.col("q") + 1) / (n[0] + 2))
    z = F.abs(r) / F.sqrt(1 / (F.col("p") + 1) + 1 / (F.col("q") + 1))
    best = table.select("bucket", r.alias("r"), z.alias("z")).orderBy(F.desc("z"), "bucket").limit(features).collect()
    numbers = np.full(1 << BITS, -1)
    numbers[[b.bucket for b in best]] = np.arange(len(best))
    ratio = np.array([b.r for b in best])
    got = chosen.select("label", "text").mapInArrow(_picked(numbers), "label int, x binary").collect()
    y = np.array([g.label for g in got], float)
    taken = np.maximum([(y == 0).sum(), (y == 1).sum()], 1)
    share = (n / n.sum() / taken)[y.astype(int)]
    w, bias = _fit([np.frombuffer(g.x, np.int32) for g in got], y, share, ratio)
    weight = np.zeros(1 << BITS)
    weight[[b.bucket for b in best]] = ratio * w
    return Model(numbers >= 0, weight, bias)


def score(docs: DataFrame, text: str, model: Model) -> DataFrame:
    """docs with the columns score (0 to 1) and predicted (1 from 0.5 on) after its own; names it
    has already are replaced. A null text counts as an empty one and gets the score of no n-grams.
    Repeated rows get the same answer. No rows give no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS numbers

    @F.pandas_udf(DoubleType())
    def of(texts):
        import pandas as pd

        return pd.Series(shared.value.score(pa.Array.from_pandas(texts, type=pa.string())), dtype="float64")

    keep = [c for c in docs.columns if c not in ("score", "predicted")]
    return docs.select(*keep, of(F.col(text).cast("string")).alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0)
    )


def learn_from_labels(docs: DataFrame, labels: DataFrame, **limits: int) -> Model:
    """The contract's split: rows whose crc32(doc_id as text) mod 5 is not 0 are learned from. A
    document with several labels is learned once, by the largest."""
    one = labels.filter("doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("label"))
    taught = one.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    if taught.count() <= SENT_LABELS:
        taught = F.broadcast(taught)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(taught, "doc_id")
    return train(rows.withColumnRenamed("doc_id", "key"), **limits)
