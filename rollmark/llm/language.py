"""Language identification in two steps: first the family, then the language within it.

Texts become square-rooted, normalised counts of hashed character n-grams. One-versus-one linear
support vector machines tell families apart, and others, trained on a family's texts alone,
separate the close languages inside it; each step is decided by votes, then by summed margins.
The machines are trained on a bounded sample of labelled rows and then applied to every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rollmark.llm import text as t
from rollmark.llm.ngrams import grams, sampled

#: Language codes by family. A language that is not here is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "af", "fy", "lb", "sv", "da", "no", "nb", "nn", "is", "fo"),
    "romance": ("es", "fr", "it", "pt", "ca", "gl", "ro", "oc", "la"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"),
    "baltic": ("lt", "lv"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz", "ky", "tk"),
    "indic": ("hi", "mr", "ne", "bn", "gu", "pa", "ur"),
    "semitic": ("ar", "he", "mt", "am"),
}
FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes}

ORDERS, BITS = (1, 2, 3, 4), 12
#: Labelled rows per language that the machines are fitted on.
SAMPLE = 1000
UNDECIDED = "und"
#: A text fits no language below this part of the likeness that all but LEAST of the rows set aside
#: (one in ASIDE) of its size have; sizes in bytes, and the rows that a size needs for a floor of its own.
PART, LEAST, ASIDE, FLOORS_OF, ENOUGH = 0.6, 0.01, 5, (32, 128, 512), 20


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of 2**BITS numbers per text."""
    n, width = len(offsets) - 1, 1 << BITS
    out = np.zeros(n * width)
    for bucket, text in grams(data, offsets, ORDERS, BITS):
        out += np.bincount(text * width + bucket, minlength=n * width)
    out = np.sqrt(out.reshape(n, width)).astype(np.float32)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def separator(x: np.ndarray, y: np.ndarray, strength: float = 10.0, steps: int = 150) -> np.ndarray:
    """A linear support vector machine (squared hinge loss, both classes of equal weight) for y of
    -1 and 1, by accelerated gradient steps. The last column of x is all 1, its weight the bias."""
    c = strength / np.where(y > 0, (y > 0).sum(), (y < 0).sum())
    w = last = np.zeros(x.shape[1], np.float32)
    rate = 1 / (1 + 2 * 4 * strength)  # rows have a squared length of at most 2
    for k in range(steps):
        ahead = w + (k / (k + 3)) * (w - last)
        slack = np.maximum(0, 1 - y * (x @ ahead))
        last, w = w, ahead - rate * (ahead - 2 * (x.T @ (c * slack * y).astype(np.float32)))
    return w


def _with_bias(x: np.ndarray, rows: np.ndarray, most: int = 256) -> np.ndarray:
    """These rows and a column of 1, copied once."""
    out = np.ones((len(rows), x.shape[1] + 1), np.float32)
    for i in range(0, len(rows), most):
        out[i : i + most, :-1] = x[rows[i : i + most]]
    return out


class OneVersusOne:
    """Votes of linear machines between each two of the given classes; rows of other labels are left out."""

    def __init__(self, classes: list[str], x: np.ndarray, labels: np.ndarray):
        self.classes = classes
        self.pairs = list(combinations(range(len(classes)), 2))
        self.weights = np.zeros((len(self.pairs), x.shape[1] + 1), np.float32)
        for k, (a, b) in enumerate(self.pairs):
            of_two = np.flatnonzero(np.isin(labels, [classes[a], classes[b]]))
            y = np.where(labels[of_two] == classes[a], 1, -1).astype(np.float32)
            self.weights[k] = separator(_with_bias(x, of_two), y)

    def decide(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(class number, confidence between 0 and 1) of each row."""
        n = len(x)
        if len(self.classes) == 1:
            return np.zeros(n, int), np.ones(n)
        margin = x @ self.weights[:, :-1].T + self.weights[:, -1]
        votes, sums = np.zeros((n, len(self.classes))), np.zeros((n, len(self.classes)))
        sure = np.zeros((n, len(self.classes)))
        for k, (a, b) in enumerate(self.pairs):
            m = margin[:, k].astype(float)
            votes[:, a] += m >= 0
            votes[:, b] += m < 0
            sums[:, a] += m
            sums[:, b] -= m
            p = 1 / (1 + np.exp(np.clip(-3 * m, -50, 50)))
            sure[:, a] += p
            sure[:, b] += 1 - p
        best = np.argmax(votes + np.tanh(sums / len(self.pairs)) / 4, axis=1)
        return best, sure[np.arange(n), best] / (len(self.classes) - 1)


class Hierarchy:
    """The family's machines, and those of each family's languages; with the sizes of the rows, also
    how like a language's mean a text is to be."""

    def __init__(self, x: np.ndarray, labels: np.ndarray, sizes: np.ndarray | None = None):
        family = np.array([FAMILY.get(c, c) for c in labels], dtype=object)
        self.families = OneVersusOne(sorted(set(family)), x, family)
        self.languages = [OneVersusOne(sorted(set(labels[family == f])), x, labels) for f in self.families.classes]

        self.floors = np.full(len(FLOORS_OF) + 1, -1.0)
        aside = np.zeros(len(x), bool)
        for c in set(labels):
            aside[np.flatnonzero(labels == c)[ASIDE - 1 :: ASIDE]] = True
        self.means = np.stack([
            x[(labels == c) & ~aside].astype(np.float32).mean(axis=0) for c in sorted(set(labels))])
        self.means /= np.maximum(np.linalg.norm(self.means, axis=1, keepdims=True), 1e-9)
        if sizes is not None and aside.any():
            like, size = self.likeness(x[aside].astype(np.float32)), np.digitize(sizes[aside], FLOORS_OF)
            lowest = np.quantile(like, LEAST) / 2  # of small sizes without enough rows
            for k in range(len(self.floors)):
                if (size == k).sum() >= ENOUGH:
                    lowest = np.quantile(like[size == k], LEAST)
                self.floors[k] = PART * lowest  # longer texts are no less alike

    def likeness(self, x: np.ndarray) -> np.ndarray:
        """The best cosine of each row to a language's mean."""
        return (x @ self.means.T).max(axis=1)

    def fits(self, x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Whether each row is as like a language as texts of its size are."""
        return self.likeness(x) >= self.floors[np.digitize(sizes, FLOORS_OF)]

    def decide(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(language, confidence) of each row."""
        family, score = self.families.decide(x)
        out = np.empty(len(x), dtype=object)
        for k, inner in enumerate(self.languages):
            rows = np.flatnonzero(family == k)
            if len(rows):
                language, sure = inner.decide(x[rows])
                out[rows] = np.array(inner.classes, dtype=object)[language]
                score[rows] = score[rows] * sure
        return out, score


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, data, offsets in t.slices(batch.column(1)):
            rows = [x.tobytes() for x in features(data, offsets).astype(np.float16)]
            yield pa.RecordBatch.from_pydict({
                "label": batch.column(0).slice(i, j - i), "x": pa.array(rows, pa.binary()),
                "size": pa.array(np.diff(offsets), pa.int64())})


def train(labelled: DataFrame, sample: int = SAMPLE) -> Hierarchy | None:
    """Fit on about `sample` rows per language of (key, text, label); None if there are no rows."""
    rows, _ = sampled(labelled.filter("label is not null and text rlike '\\\\p{L}'"), "label", F.col("key"), sample)
    got = rows.select("label", "text").mapInArrow(_vectors, "label string, x binary, size bigint").collect()
    if not got:
        return None
    x = np.empty((len(got), 1 << BITS), np.float16)  # the driver's memory is tight
    for own, r in zip(x, got):
        own[:] = np.frombuffer(r.x, np.float16)
    labels, sizes = np.array([r.label for r in got], dtype=object), np.array([r.size for r in got])
    got.clear()
    return Hierarchy(x, labels, sizes)


def identify(docs: DataFrame, text: str, model: Hierarchy | None, strict: bool = False) -> DataFrame:
    """docs with the columns lang_pred and score after its own (names it has already are replaced).

    lang_pred is a language of the training rows, or `und` with score 0 if the text is null, has
    no letter, or nothing was learned; if strict, also if it is less like the languages learned than
    their texts of its size are (another script, noise, mostly digits and symbols). Repeated rows get the same answer. No rows give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x 2**BITS numbers

    @F.pandas_udf("lang_pred string, score double")
    def decide(texts):
        import pandas as pd

        names, scores = np.full(len(texts), UNDECIDED, dtype=object), np.zeros(len(texts))
        if shared.value is not None:
            for i, j, data, offsets in t.slices(pa.Array.from_pandas(texts, type=pa.string())):
                x = features(data, offsets)
                names[i:j], scores[i:j] = shared.value.decide(x)
                if strict:
                    out = i + np.flatnonzero(~shared.value.fits(x, np.diff(offsets)))
                    names[out], scores[out] = UNDECIDED, 0
        return pd.DataFrame({"lang_pred": names, "score": scores})

    keep = [c for c in docs.columns if c not in ("lang_pred", "score")]
    letters = F.coalesce(F.col(text).cast("string").rlike(r"\p{L}"), F.lit(False))
    found = F.struct(F.lit(UNDECIDED).alias("lang_pred"), F.lit(0.0).alias("score"))
    guess = docs.withColumn("_guess", decide(F.col(text).cast("string")))
    return guess.withColumn("_guess", F.when(letters, F.col("_guess")).otherwise(found)).select(
        *keep, F.col("_guess.lang_pred").alias("lang_pred"), F.col("_guess.score").alias("score")
    )


def learn_from_documents(docs: DataFrame, sample: int = SAMPLE) -> Hierarchy | None:
    """The contract's split: rows whose crc32(doc_id as text) mod 3 is not 1 are learned from."""
    taught = docs.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1)
    return train(taught.select(F.col("doc_id").alias("key"), F.col("text").cast("string").alias("text"),
                               F.col("lang").cast("string").alias("label")), sample)
