import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollmark.llm.fill_middle import Marks, fill_middle, line_ends, point_starts, restored
from tests.llm.rows import ODD, frame


def plainly(doc_id, text, rate=100, spm_rate=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    i, j = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    a, b, c = "".join(units[:i]), "".join(units[i:j]), "".join(units[j:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return doc_id, len(units), "plain", None, None, text
    if h[3] % 100 < spm_rate:
        return doc_id, len(units), "spm", len(a), len(b), f"<S>{c}<P>{a}<M>{b}"
    return doc_id, len(units), "psm", len(a), len(b), f"<P>{a}<S>{c}<M>{b}"


def texts(seed=5):
    rng = random.Random(seed)
    pieces = ["\n", "\n\n", "a", "é", "漢字", "🙂", "\r\n", "\x0b", "<", "<P", "P>", "\x8a", "Ċ", "word ", "\0"]
    rows = [(k, "".join(rng.choices(pieces, k=rng.randint(0, 40))), "en", "s", 0) for k in range(300)]
    rows += [(1000 + k, x, "en", "s", 0) for k, x in enumerate(
        ["<P>", "a<S>b\nc", "x\n<M>", "\n", "\n" * 17, "no line feed", "<", "a\nb<", "<P\n<S\n<M\n", "é" * 8 + "\n"])]
    return rows + ODD + [(2000, "line\n" * 60_000, "en", "s", 0), (-3, "one\ntwo\nthree", "en", "s", 0)]


@pytest.mark.parametrize("rate, spm_rate", [(100, 50), (60, 0), (0, 50), (100, 100)])
def test_equals_the_plain_form(spark, rate, spm_rate):
    rows = texts()
    docs = frame(spark, rows).selectExpr("*", "'x' as output", "1 as n", "'y' as form").repartition(3)
    got = fill_middle(docs, rate=rate, spm_rate=spm_rate).collect()
    key = str
    assert sorted((tuple(r) for r in got), key=key) == sorted((plainly(r[0], r[1], rate, spm_rate) for r in rows), key=key)


def test_round_trip(spark):
    docs = frame(spark, [r for r in texts() if r[0] is not None]).dropDuplicates(["doc_id"])
    made = fill_middle(docs).withColumn("back", restored(F.col("output"), F.col("form")))
    assert made.filter("form != 'plain'").count() > 200
    both = made.join(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "doc_id")
    assert both.filter("not (back <=> text)").count() == 0
    assert fill_middle(frame(spark, [])).collect() == []


def test_rank_and_select_of_marked_bytes():
    rng = np.random.default_rng(1)
    data = rng.choice(np.array([0x0A, 0x8A, 0x0B, 0x00, 0xFF, 0x80, 0xC3, 0x41], np.uint8), 8 * 40)
    words = data.view("<u8")
    ends = np.flatnonzero(data == 0x0A)
    marks = Marks(line_ends(words))
    assert marks.select(np.arange(1, len(ends) + 1)).tolist() == ends.tolist()
    at = np.arange(len(data) + 1)
    assert marks.rank(at).tolist() == np.searchsorted(ends, at).tolist()
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    assert Marks(point_starts(words)).rank(at).tolist() == np.searchsorted(starts, at).tolist()


def test_sentinels_that_could_not_be_told_apart(spark):
    with pytest.raises(ValueError):
        fill_middle(frame(spark, []), sentinels=("<P<", "<S>", "<M>"))
