import random

import numpy as np
import pytest

from rollmark.llm.ngram_join import GROUPS, _Join, ngram_join
from tests.llm.rows import ODD, documents, frame, prose
from tests.llm.test_near_duplicates import brute, varied


def corpus(seed):
    """Copies, near copies around the threshold, and a passage that many texts share."""
    rng = random.Random(seed)
    rows = documents(each=6)
    for family in range(3):
        base = prose(rng, "en", 70 + 30 * family)
        rows += [(1000 * (family + 1) + k, varied(rng, base, rng.randint(0, 7)), "en", "s", 0) for k in range(50)]
    passage = prose(rng, "de", 40)
    rows += [(5000 + k, f"{prose(rng, 'fr', 30)} {passage} {prose(rng, 'es', rng.randint(5, 30))}", "fr", "s", 0) for k in range(60)]
    rows += [(6000 + k, passage.upper(), "en", "s", 0) for k in range(5)]
    short = "one two three four five six seven eight nine ten".split()
    rows += [(7000 + k, " ".join(short[: k + 1]), "en", "s", 0) for k in range(10)]
    return rows + ODD


@pytest.mark.parametrize("size, options", [
    (5, {}), (2, {"chunk": 8}), (5, {"chunk": 40, "rounds": 0}), (3, {"similarity": 0.55, "chunk": 20, "rounds": 1})])
def test_equals_comparing_all_pairs(spark, size, options):
    rows = corpus(size)
    docs = frame(spark, rows).selectExpr("*", "1 as component_id", "'x' as member", "2 as n", "3 as point")
    got = ngram_join(docs.repartition(3), words=size, **options).collect()
    assert len(got) == len(rows)
    want = {r[:3] for r in brute(rows, size, round(100 * options.get("similarity", 0.8)))}
    assert {tuple(r) for r in got} == want


def test_long_texts_and_no_rows(spark):
    text = prose(random.Random(3), "en", 60_000)
    got = ngram_join(frame(spark, [(2, text, "", "", 0), (1, text + " end", "", "", 0), (3, "so", "", "", 0)])).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(1, 1), (2, 1), (3, 3)}
    assert ngram_join(frame(spark, [])).collect() == []


def test_the_tree_loses_no_pair_of_points():
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 6, (8, GROUPS))
    counts = (centres[rng.integers(0, 8, 700)] + rng.integers(0, 2, (700, GROUPS)) * (rng.random((700, GROUPS)) < 0.3))
    counts = counts.astype(np.uint16)
    n = counts.sum(axis=1, dtype=np.int64)
    component, side = rng.integers(0, 300, 700), rng.integers(0, 3, 700)
    join = _Join(80, counts, n, component, side)
    i, j = np.triu_indices(700, 1)
    key = lambda pair: set(map(tuple, np.sort(np.stack(pair[:2], 1), axis=1).tolist()))
    want = key(join.among(i, j))
    assert want
    found = [key(part) for part in join.tree(np.arange(700))]
    assert set().union(*found) == want


def test_a_pair_that_meets_under_several_members_is_made_once():
    n, member = np.full(6, 10), np.array([4, 4, 7, 7, 9, 9])
    least = np.array([[4, 7, 9, 9], [2, 4, 7, 9]] * 3)
    bits = np.ones((6, 4), np.uint64)
    join = _Join(80, np.full((6, GROUPS), 1), n, np.arange(6), np.zeros(6), bits, np.full(6, 9), member, least)
    made = [join.among(np.array([k]), np.array([k + 1]))[0].tolist() for k in (0, 2, 4)]
    assert made == [[0], [], []]
    join.least = np.array([[4, 4, 4, 4], [2, 2, 2, 2]] * 3)  # nothing to tell by: made under each
    assert [len(join.among(np.array([k]), np.array([k + 1]))[0]) for k in (0, 2, 4)] == [1, 1, 1]


def test_many_groups_rule_out_what_few_groups_cannot():
    n = np.array([10, 10])
    bits = np.array([[1023], [1023 << 4]], np.uint64)  # six in common
    few = _Join(80, np.full((2, GROUPS), 1), n, np.arange(2), np.zeros(2))
    many = _Join(80, np.full((2, GROUPS), 1), n, np.arange(2), np.zeros(2), bits, np.zeros(2, int),
                 np.ones(2, int), np.array([[1] * 4, [2] * 4]))
    assert len(few.among(np.array([0]), np.array([1]))[0]) == 1
    assert len(many.among(np.array([0]), np.array([1]))[0]) == 0
