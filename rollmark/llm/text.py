"""Words of whole texts as arrays: the shared ground of the operators that read documents.

Texts come as Arrow columns. A column is seen as one byte array with offsets, so that splitting,
lower-casing and hashing run over all texts of a slice at once and no Python object is made per
word. A null text counts as an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

#: Bytes of text worked on at once; a longer text makes a slice of its own.
SLICE_BYTES = 1 << 17

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: White space and ASCII punctuation.
PUNCTUATION = SPACE.copy()
PUNCTUATION[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BYTE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64)
_BYTE = (_BYTE << np.uint64(1)) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after the other, and where each begins; one more for the end."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of at most so many bytes: (first row, row after the last, bytes, offsets)."""
    data, offsets = utf8(column)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def word_spans(
    data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each word begins and ends, and its text's number. Words are runs of anything but
    separators: by default space, tab, line feed, vertical tab, form feed and carriage return."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~separators[data]
    border = np.zeros(len(data) + 1, bool)
    border[offsets] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | border[1:-1]
    last[:-1] &= ~inside[1:] | border[1:-1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, separators: np.ndarray = SPACE) -> np.ndarray:
    """A 64-bit hash of each word, with A-Z lower-cased."""
    value = np.where(separators, np.uint64(0), _BYTE)
    if not len(starts):
        return np.zeros(0, np.uint64)
    tail = data[starts[0] :]
    starts = starts - starts[0]
    place = np.arange(len(tail)) - np.repeat(starts, np.diff(np.append(starts, len(tail))))
    powers = np.cumprod(np.full(int(place.max()) + 1, _BASE))
    return mix(np.add.reduceat(value[LOWER[tail]] * powers[place], starts))


def hashed_words(
    data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACE
) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of every word, in order."""
    starts, _, text = word_spans(data, offsets, separators)
    return word_hashes(data, starts, separators), text


def shingles(words: np.ndarray, text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of so many words as (hash, text number), ordered by text number. A text
    with fewer words has one: all of them."""
    out, owner = [], []
    per_text = np.bincount(text) if len(text) else np.zeros(0, np.int64)
    begins = np.concatenate([[0], np.cumsum(per_text)])[:-1] if len(per_text) else per_text
    for k in range(1, size + 1):
        if k < size:
            at = begins[per_text == k]
        elif len(words) >= size:
            at = np.flatnonzero(text[: len(text) - size + 1] == text[size - 1 :])
        else:
            at = np.zeros(0, np.int64)
        if len(at):
            h = np.full(len(at), np.uint64(k))
            for step in range(k):
                h = mix(h * _BASE + words[at + step])
            out.append(h)
            owner.append(text[at])
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h, owner = np.concatenate(out), np.concatenate(owner)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return h[new], owner[new]


def segment_starts(owner: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    if not len(owner):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))


def in_both(a: str, b: str) -> Column:
    """How many shingles two columns of whole sets share. Counted where the sets are: batches of pairs of
    sets, copied for Python, were what filled an executor's memory."""
    return F.size(F.array_intersect(a, b))


#: Groups of hashes that the bound on what two sets share counts in, and the numbers of 64 bits that tell one or
#: more, and two or more, in each.
GROUPS = 1024
LONGS = 2 * GROUPS // 64


def group_bits(sets: np.ndarray, owner: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text, bits of the groups with one shingle or more and with two or more, and what is beyond. Two
    sets share at most as many shingles as they have bits in common, and the smaller of what is beyond."""
    group = (mix(sets ^ np.uint64(0x9216D5D98979FB1B)) & np.uint64(GROUPS - 1)).astype(np.int64)
    counts = np.bincount(owner * GROUPS + group, minlength=rows * GROUPS).reshape(rows, GROUPS)
    bits = np.packbits(np.concatenate([counts > 0, counts > 1], axis=1), axis=1)
    return np.ascontiguousarray(bits).view(np.int64), np.maximum(counts - 2, 0).sum(axis=1)
