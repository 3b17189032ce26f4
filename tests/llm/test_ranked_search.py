import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from rollmark.llm.ranked_search import Treap, search
from tests.llm.rows import ODD, documents, frame

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k):
    docs = [(i, Counter(terms(x))) for i, x in docs if i is not None]
    held = [(i, c) for i, c in docs if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(x for _, c in held for x in c)
    own = {}
    for i, x in items:
        if i is not None:
            own.setdefault(i, set()).update(terms(x))
    out = set()
    for i, asked in own.items():
        scored = []
        for doc, c in held:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * ((10**9 * c[x]) // (1000 * c[x] + 20 * m))
                for x in asked if c[x]
            )
            if score > 0:
                scored.append((-score, doc))
        out |= {(i, r, doc, -score) for r, (score, doc) in enumerate(sorted(scored)[:k], 1)}
    return out


def corpus(seed=2):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(60)] + ["É", "é", "X9", "x9", "漢字", "a-b", "mid.dle", "\x00nul"]
    weights = [1 / (k + 1) for k in range(len(words))]
    docs = [(k * 3 - 50, " ".join(rng.choices(words, weights, k=rng.randint(0, 40)))) for k in range(180)]
    docs += [(1000 + k, "W1 w2, w3!") for k in range(30)] + [(900, None), (901, ""), (902, " \t."), (None, "w1 w5")]
    docs += [(5000, "w7 w8 " * 4000)]
    items = [(k, " ".join(rng.choices(words, k=rng.randint(1, 9)))) for k in range(40)]
    items += [(100, None), (101, ""), (102, "unheard"), (None, "w1"), (103, "w1 w1 W1"), (103, "w2"), (104, "w1 w2 w3")]
    return docs, items


@pytest.mark.parametrize("options", [
    {}, {"block_docs": 7}, {"block_docs": 1}, {"rows_chosen": 0, "block_docs": 16}, {"pairs_at_once": 9, "opened": 1},
    {"pairs_at_once": 1, "block_bytes": 300}])
def test_equals_scoring_every_document(spark, options):
    docs, items = corpus()
    d = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 as score", "2 as rank", "'x' as term")
    i = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "7 as doc_id")
    for k in (50, 3):
        got = [tuple(r) for r in search(d.repartition(3), i, k, **options).collect()]
        assert len(got) == len(set(got))
        assert set(got) == brute(docs, items, k)
        if options:
            return


def test_ties_and_repeated_rows(spark):
    docs = [(k, "same words here") for k in range(120, 0, -1)] + [(500, "other"), (500, "other words")]
    items = [(1, "same words"), (2, "other")]
    got = {tuple(r) for r in search(
        spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4),
        spark.createDataFrame(items, "item_id bigint, text string"), 10, block_docs=9).collect()}
    want = brute(docs, items, 10)
    assert got == want
    assert {r[2] for r in got if r[0] == 2} == {500}


def test_no_rows(spark):
    some, none = frame(spark, documents(each=2)), frame(spark, [])
    items = spark.createDataFrame([(1, "the")], "item_id bigint, text string")
    assert search(none, items).collect() == []
    assert search(some, items.limit(0)).collect() == []
    assert search(frame(spark, ODD[:3]), items).collect() == []


def test_the_tree_holds_its_cells_and_their_maxima():
    rng = np.random.default_rng(3)
    grid = np.where(rng.random((37, 90)) < 0.1, rng.integers(1, 1000, (37, 90)), 0)
    rows, cols = np.nonzero(grid)
    shuffled = rng.permutation(len(rows))
    treap = Treap.build(rows[shuffled], cols[shuffled], grid[rows, cols][shuffled])
    back = np.zeros((128, 128), np.int64)

    def walk(level, node, row, col):
        side = 1 << (treap.height - level)
        inside = back[row : row + side, col : col + side]
        if level == treap.height:
            inside[:] = treap.maxima[level][node]
            return
        for q in range(4):
            there, below = treap.below(level, np.array([node]), np.array([q], np.uint8))
            if there[0]:
                walk(level + 1, below[0], row + (q >> 1) * side // 2, col + (q & 1) * side // 2)
        assert inside.max() == treap.maxima[level][node]

    walk(0, 0, 0, 0)
    assert (back[:37, :90] == grid).all() and back.sum() == grid.sum()
