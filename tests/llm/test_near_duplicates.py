import random
import re

import numpy as np
import pytest

from rollmark.llm.components import components
from rollmark.llm import near_duplicates as module
from rollmark.llm import text as t
from rollmark.llm.near_duplicates import near_duplicates
from tests.llm.rows import ODD, documents, frame, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text, size):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def brute(rows, size, percent):
    sets = [(r[0], shingle_set(r[1], size)) for r in rows]
    root = {i: i for i, _ in sets if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (a, s) in enumerate(sets):
        for b, u in sets[:k]:
            if a is not None and b is not None and s and u and 100 * len(s & u) >= percent * len(s | u):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {(i, len(s), None if i is None else find(i), i is None or find(i) == i) for i, s in sets}


def varied(rng, text, changes):
    words = text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = "changed%d" % rng.randrange(1000)
    return " ".join(words)


@pytest.mark.parametrize("size", [2, 5])
def test_equals_comparing_all_pairs(spark, size):
    rng = random.Random(size)
    rows = documents(each=8)
    base = prose(rng, "en", 80)
    rows += [(100 + k, varied(rng, base, rng.randint(0, 6)), "en", "s", 0) for k in range(60)]
    rows += [(200 + k, base.upper(), "en", "s", 0) for k in range(5)]
    rows += [(300, "one", "en", "s", 0), (301, "ONE", "en", "s", 0), (302, "one two", "en", "s", 0)] + ODD
    docs = frame(spark, rows).selectExpr("*", "1 as component_id", "true as kept", "'x' as posting")
    got = near_duplicates(docs, words=size, similarity=0.8).collect()
    assert len(got) == len(rows)
    assert {tuple(r) for r in got} == brute(rows, size, 80)


def test_a_very_long_text_and_no_rows(spark):
    text = prose(random.Random(3), "en", 60_000)
    got = near_duplicates(frame(spark, [(1, text, "", "", 0), (2, text + " end", "", "", 0)])).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(1, 1), (2, 1)}
    assert near_duplicates(frame(spark, [])).collect() == []


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(50)] + [(7, 7), (300, 299)]
    got = dict(components(spark.createDataFrame(links, "u bigint, v bigint")).collect())
    assert got == {**{k: 0 for k in range(41)}, **{100 + k: 100 for k in range(50)}, 299: 299, 300: 299}


def test_postings_whose_pairs_were_all_compared_are_not_compared_again(spark):
    rows = [("two", 1, 1), ("two", 2, 2), ("linked", 1, 1), ("linked", 5, 1)] + [("many", k, k) for k in range(40)]
    posted = spark.createDataFrame(rows, "posting string, rep bigint, component bigint")
    assert {r.posting for r in module._open(posted, 1).collect()} <= {"two", "many"}
    assert [r.posting for r in module._open(posted, 2).collect()] == ["many"]


def test_what_sets_share_is_counted_without_python(spark):
    both = spark.createDataFrame([([3, 1, 9, -4], [9, 2, 3])], "a array<bigint>, b array<bigint>").select(t.in_both("a", "b"))
    assert both.first()[0] == 2
    assert "Python" not in both._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("coordinates", [16, 64, 128])
def test_unequal_coordinates_are_counted_in_few_terms(spark, coordinates):
    least = np.random.default_rng(coordinates).integers(0, 40, (30, coordinates), dtype=np.uint64)
    bits, sketch = t.mix(least) & np.uint64(15), module._four_bits(least).tolist()
    pairs = spark.createDataFrame([(i, j, sketch[i], sketch[j]) for i in range(30) for j in range(30)], "i int, j int, s array<bigint>, s_2 array<bigint>")
    for r in pairs.selectExpr("i", "j", f"{module._unequal(coordinates)} as n").collect():
        assert r.n == (bits[r.i] != bits[r.j]).sum()
    assert module._unequal(coordinates).count("s_2") == 4 * -(-coordinates // 64)


def test_the_bound_on_shared_shingles_is_one_term(spark):
    """As a sum of 32 terms, the code of the join was too long for the JVM to compile."""
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 500, n).astype(np.uint64)) for n in (1, 40, 300, 480)]
    bits, beyond = t.group_bits(np.concatenate(sets), np.repeat(np.arange(4), [len(x) for x in sets]), 4)
    rows = [(len(x), b.tolist(), int(m)) for x, b, m in zip(sets, bits, beyond)]
    both = spark.createDataFrame([(*x, *y) for x in rows for y in rows], "n bigint, bits array<bigint>, beyond bigint, n_2 bigint, bits_2 array<bigint>, beyond_2 bigint")
    sql = module._may_be_linked(80, "", "_2")
    got = [r[0] for r in both.selectExpr(sql).collect()]
    for k, (x, y) in enumerate((x, y) for x in rows for y in rows):
        shared = sum(bin((a & b) & (2**64 - 1)).count("1") for a, b in zip(x[1], y[1])) + min(x[2], y[2])
        assert got[k] == (shared * 180 >= (x[0] + y[0]) * 80)
    assert sql.count("bit_count") == 1


def test_a_row_is_shuffled_for_each_posting_without_the_marks_of_its_set(spark):
    rows = [(k, k, 3, [10, 20, 30 + k], [0] * 4) for k in range(4)]
    classes = spark.createDataFrame(rows, "number bigint, rep bigint, n_shingles bigint, postings array<bigint>, sketch array<bigint>")
    got = module._prefixes(classes, 2).collect()
    assert {(r.rep, r.n, r.posting) for r in got} == {(k, 3, 10) for k in range(4)}
