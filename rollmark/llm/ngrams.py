"""Hashed character n-grams of whole texts, as arrays, and bounded samples of labelled rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from rollmark.llm.text import LOWER, mix

_BASE = np.uint64(0xD6E8FEB86659FD93)

#: Every white space counts as one space, A-Z as a-z.
_FOLD = LOWER.copy()
_FOLD[[9, 10, 11, 12, 13]] = 32


def grams(
    data: np.ndarray, offsets: np.ndarray, orders: tuple[int, ...], bits: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order, the bucket (below 2**bits) of every n-gram of bytes and its text's number.
    A text begins and ends with a space."""
    n = len(offsets) - 1
    text = np.repeat(np.arange(n), np.diff(offsets))
    padded = np.full(len(data) + 2 * n, 32, np.uint8)
    padded[np.arange(len(data)) + 2 * text + 1] = _FOLD[data]
    text = np.repeat(np.arange(n, dtype=np.int64), np.diff(offsets) + 2)
    code = padded.astype(np.uint64) + np.uint64(1)
    h, reach = np.zeros(len(code), np.uint64), 0
    powers = np.cumprod(np.full(max(orders), _BASE))
    for order in sorted(orders):
        if len(code) < order:
            return
        while reach < order:
            h, reach = h[: len(code) - reach] + code[reach:] * powers[reach], reach + 1
        inside = np.flatnonzero(text[: len(h)] == text[order - 1 :])
        yield (mix(h[inside]) >> np.uint64(64 - bits)).astype(np.int64), text[inside]


def sampled(rows: DataFrame, label: str, ids: Column, most: int) -> tuple[DataFrame, dict]:
    """Rows of about `most` per label at most, chosen by a hash of the id alone, so that the choice
    is the same in every run; and the number of all rows by label. With few rows all are taken."""
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    share = F.lit(0)
    for value, n in counts.items():
        if n:
            share = F.when(F.col(label) == F.lit(value), int(1_000_000 * min(1, most / n))).otherwise(share)
    return rows.filter(F.pmod(F.xxhash64(F.lit("sample"), ids), F.lit(1_000_000)) < share), counts
