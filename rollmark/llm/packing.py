"""Packing token ids into fixed-length sequences: vector bin packing by dot products.

A piece is a run of a document's ids. It takes up three things at once: tokens, one segment, and
its loss-bearing tokens. A sequence has a limit for each. The sequence that is open takes, among
the waiting pieces that fit, the one with the largest dot product of its demand and what is left,
both as shares of the limits; so a piece is preferred that is large where there is room.

Documents may be cut, so a sequence that no waiting piece fits takes the front of one. Sequences
come out full, and what is left at a task's end is dealt to sequences whose length is a power of
two, which need no padding. Each task packs the rows it reads, holding a bounded number of pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

END = 1
WINDOW, SEGMENTS = 2048, 64
#: Pieces waiting in a task.
WAITING = 128

_WIDE = re.compile("[^\x00-ɏ]|<\\|")


class Encoder:
    """Byte-level BPE ids of a text. The same vocabulary is at hand in two forms; the faster one
    serves texts in Latin letters without special tokens, for which both are bound to agree."""

    def __init__(self, vocabulary: str | None = None, ranks: str | None = None):
        import base64

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(vocabulary or public_tokenizers.path("byte_bpe_50k.json"))
        self.fast = None
        if vocabulary is None or ranks is not None:
            with open(ranks or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding(
                "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}
            )

    def __call__(self, text: str) -> list[int]:
        if self.fast is not None and not _WIDE.search(text):
            return self.fast.encode_ordinary(text)
        return self.whole.encode(text, add_special_tokens=False).ids


@dataclass
class Piece:
    doc: object
    ids: np.ndarray  #: of the whole document
    start: int
    length: int
    loss_from: int  #: the document's ids from here on bear loss

    def loss(self, length: int | None = None) -> int:
        end = self.start + (self.length if length is None else length)
        return max(0, end - max(self.start, self.loss_from))

    def cut(self, length: int) -> Piece:
        """Take so many ids off the front."""
        front = Piece(self.doc, self.ids, self.start, length, self.loss_from)
        self.start, self.length = self.start + length, self.length - length
        return front

    def longest(self, tokens: int, loss: int) -> int:
        """Ids from the front that keep to both limits."""
        free = max(0, self.loss_from - self.start)
        return min(self.length, tokens, free + loss)


class Packer:
    """Documents in, finished sequences (lists of pieces) out."""

    def __init__(self, window: int, segments: int, loss: int, waiting: int = WAITING):
        if min(window, segments, loss, waiting) < 1:
            raise ValueError("limits must be positive")
        self.limits = np.array([window, segments, loss], float)
        self.most = waiting
        self.waiting: list[Piece] = []

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        window, _, loss = self.limits.astype(int)
        while piece.length > window and piece.longest(window, loss) == window:
            yield [piece.cut(window)]
        self.waiting.append(piece)
        if len(self.waiting) >= self.most:
            yield self._fill()

    def finish(self) -> Iterator[list[Piece]]:
        while self.waiting:
            yield self._fill()

    def _fill(self) -> list[Piece]:
        left = self.limits.copy()
        out: list[Piece] = []
        need = np.array([[p.length, 1, p.loss()] for p in self.waiting], float)
        while left[0] >= 1 and left[1] >= 1 and self.waiting:
            worth = (need / self.limits) @ (left / self.limits)
            fits = (need <= left).all(axis=1)
            if fits.any():
                k = int(np.argmax(np.where(fits, worth, -1.0)))
                piece = self.waiting.pop(k)
                need = np.delete(need, k, axis=0)
            else:
                k = int(np.argmax(worth))
                size = self.waiting[k].longest(int(left[0]), int(left[2]))
                if size == 0:
                    break
                piece = self.waiting[k].cut(size)
                need[k] = [self.waiting[k].length, 1, self.waiting[k].loss()]
            out.append(piece)
            left -= [piece.length, 1, piece.loss()]
        used = int(self.limits[0] - left[0])
        if left[0] >= 1:
            self._shorten(out, used, 1 << (used.bit_length() - 1))
        return out

    def _shorten(self, out: list[Piece], used: int, to: int) -> None:
        """Give back what is beyond the length `to`."""
        while used > to:
            piece = out.pop()
            used -= piece.length
            if used < to:
                out.append(piece.cut(to - used))
                used = to
            self.waiting.append(piece)


def _packed(window: int, segments: int, loss: int, end: int, vocabulary: str | None, ranks: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = Encoder(vocabulary, ranks), Packer(window, segments, loss)
        number = TaskContext.get().partitionId() << 33
        rows: list[tuple] = []

        def emit(sequence: list[Piece]) -> None:
            nonlocal number
            offset = 0
            for p in sequence:
                ids = p.ids[p.start : p.start + p.length].tobytes()
                rows.append((p.doc, p.start, p.length, ids, len(p.ids), number, offset, p.loss()))
                offset += p.length
            number += 1

        def flush() -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * 8
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 4]
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=NAMES)

        for batch in batches:
            for doc, text, loss_from in zip(*(batch.column(k).to_pylist() for k in range(3))):
                ids = np.array([*encode(text or ""), end], dtype="<u4")
                for sequence in packer.add(Piece(doc, ids, 0, len(ids), loss_from or 0)):
                    emit(sequence)
                if len(rows) >= 2000:
                    yield flush()
        for sequence in packer.finish():
            emit(sequence)
        yield flush()

    return run


NAMES = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "loss_tokens"]
SCHEMA = ("doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, "
          "sequence_id bigint, offset bigint, loss_tokens bigint")


def pack(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", loss_from: Column | None = None,
    window: int = WINDOW, segments: int = SEGMENTS, loss: int | None = None, end: int = END,
    vocabulary: str | None = None, ranks: str | None = None,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens,
    sequence_id, offset, loss_tokens.

    A document is its text's ids and then `end`. loss_from is the number of leading ids that bear
    no loss (an instruction's prompt); by default all ids bear it. A sequence has at most `window`
    ids, `segments` pieces and `loss` loss-bearing ids (by default as many as `window`). One that
    is not full has a power of two as its length.

    A null or empty text is the end id alone. Null doc_ids and repeated rows are packed like
    others. Other columns of docs are not read. No rows give no rows.
    """
    own = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"),
        (F.lit(0) if loss_from is None else loss_from).cast("bigint").alias("loss_from"),
    )
    return own.mapInArrow(_packed(window, segments, loss or window, end, vocabulary, ranks), SCHEMA)
