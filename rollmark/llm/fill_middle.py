"""Fill-in-the-middle: a text's lines are cut into prefix, middle and suffix, and put in another order.

The cuts are found in words of eight bytes. The UTF-8 bytes of many texts, one after the other, are seen
as 64-bit numbers; arithmetic on a whole number sets the top bit of each byte that ends a line, and of
each that begins a code point. Bits per word, summed up, make a directory: how many lines end before a
byte is one look-up and the bits of one word; the byte that ends the k-th line is a search in the
directory, after which the bit is selected inside its word.
"""

from __future__ import annotations

from collections.abc import Iterator

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from rollmark.llm import text as t

PREFIX, SUFFIX, MIDDLE = SENTINELS = ("<P>", "<S>", "<M>")
SEED, RATE, SPM_RATE = 7, 100, 50

_WORD = np.dtype("<u8")


def _each(byte: int) -> np.uint64:
    return np.uint64(0x0101010101010101 * byte)


_LOW, _TOP = _each(0x7F), _each(0x80)


def line_ends(words: np.ndarray) -> np.ndarray:
    """The top bit of every byte that is a line feed. Adding 0x7F to the lower seven bits carries into
    the top bit unless they are all 0, and never into the next byte."""
    other = words ^ _each(0x0A)
    return ~(((other & _LOW) + _LOW) | other) & _TOP


def point_starts(words: np.ndarray) -> np.ndarray:
    """The top bit of every byte that is not 10xxxxxx, so begins a code point."""
    return (~words | (words << np.uint64(1))) & _TOP


class Marks:
    """Marked bytes with a directory for rank and select."""

    def __init__(self, marks: np.ndarray):
        self.marks = np.append(marks, np.uint64(0))
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(marks), dtype=np.int64)])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marked bytes before each byte position."""
        word, byte = at >> 3, (at & 7).astype(np.uint64)
        below = (np.uint64(1) << (byte * np.uint64(8))) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.marks[word] & below)

    def select(self, k: np.ndarray) -> np.ndarray:
        """Byte position of each k-th marked byte, counted from 1."""
        word = np.searchsorted(self.before, k, "left") - 1
        rest, bits = k - self.before[word], self.marks[word]
        for step in range(1, 8):
            bits = np.where(rest > step, bits & (bits - np.uint64(1)), bits)
        return word * 8 + (np.bitwise_count((bits & -bits) - np.uint64(1)) >> 3)


def _hashes(seed: int, doc_id) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]


def _transform(seed: int, rate: int, spm_rate: int, sentinels: tuple[str, str, str]):
    p, s, m = (x.encode() for x in sentinels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for i, j, data, offsets in t.slices(texts):
                n = j - i
                words = np.zeros(len(data) // 8 + 1, _WORD)
                words.view(np.uint8)[: len(data)] = data
                lines, points = Marks(line_ends(words)), Marks(point_starts(words))
                begin, end = offsets[:-1], offsets[1:]
                seen = lines.rank(begin)
                ended = lines.rank(end) - seen
                last = np.zeros(n, bool)
                filled = end > begin
                last[filled] = data[end[filled] - 1] != 0x0A
                units = ended + last

                h = np.array([_hashes(seed, x) for x in ids.slice(i, n).to_pylist()], np.int64).reshape(n, 4)
                own = pc.fill_null(texts.slice(i, n), "")
                plain = (units == 0) | (h[:, 2] % 100 >= rate)
                for sentinel in sentinels:
                    plain |= pc.match_substring(own, sentinel).to_numpy(zero_copy_only=False)
                spm = h[:, 3] % 100 < spm_rate
                cuts = np.sort(h[:, :2] % (units[:, None] + 1), axis=1)
                at = []
                for c in cuts.T:
                    inner = (c > 0) & (c <= ended)
                    place = np.where(c == 0, begin, end)
                    place[inner] = lines.select((seen + c)[inner]) + 1
                    at.append(place)
                first, second = at
                chars = [points.rank(x) for x in (begin, first, second)]

                whole, out = data.tobytes(), []
                for k in range(n):
                    a, b, c, d = int(begin[k]), int(first[k]), int(second[k]), int(end[k])
                    if plain[k]:
                        out.append(whole[a:d])
                    elif spm[k]:
                        out.append(b"".join((s, whole[c:d], p, whole[a:b], m, whole[b:c])))
                    else:
                        out.append(b"".join((p, whole[a:b], s, whole[c:d], m, whole[b:c])))
                form = np.where(plain, "plain", np.where(spm, "spm", "psm"))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": ids.slice(i, n),
                    "n": pa.array(units, pa.int64()),
                    "form": pa.array(form.tolist(), pa.string()),
                    "prefix_chars": pa.array(chars[1] - chars[0], pa.int64(), mask=plain),
                    "middle_chars": pa.array(chars[2] - chars[1], pa.int64(), mask=plain),
                    "output": pa.array(out, pa.binary()).cast(pa.string()),
                })

    return run


def fill_middle(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, seed: int = SEED, rate: int = RATE,
    spm_rate: int = SPM_RATE, sentinels: tuple[str, str, str] = SENTINELS,
) -> DataFrame:
    """One row per row of docs: doc_id, n (lines), form, prefix_chars, middle_chars, output.

    `rate` per cent of the texts are transformed, `spm_rate` per cent of these with the suffix first;
    sentinels stand before prefix, suffix and middle. Which, and where a text is cut, follows from the
    sha256 of seed and doc_id alone, so it is the same in every run and for any partitioning.

    Cases: a null or empty text has no lines and stays plain, as '' does. A text that holds a sentinel
    stays plain, since it could not be restored. A text without a line feed is one line; cuts may fall on
    its ends, so prefix, middle and suffix may be empty. A row without doc_id is cut as if its id were
    written as ''. Rows that repeat an id are cut by the same numbers, each by its own lines. Other columns
    are not read. No rows give no rows.
    """
    if len(set(sentinels)) < 3 or any(not x or x[0] in y[1:] for x in sentinels for y in sentinels):
        raise ValueError("sentinels must differ, and hold no sentinel's first character but at their start")
    own = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    return own.mapInArrow(_transform(seed, rate, spm_rate, tuple(sentinels)), schema)


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that an output was made of."""
    p, s, m = (f"\\Q{x}\\E" for x in sentinels)

    def part(k: int) -> Column:
        return F.split(output, f"{p}|{s}|{m}").getItem(k)

    return (
        F.when(form == "psm", F.concat(part(1), part(3), part(2)))
        .when(form == "spm", F.concat(part(2), part(3), part(1)))
        .otherwise(output)
    )
