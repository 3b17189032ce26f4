import pytest
from pyspark.sql import functions as F

import models
from rollmark.operators.arbitrate import arbitrate_marks, existing_marks, split_accepted
from rollmark.streaming.arbitration import verdict
from rows import as_dicts, event, frame, random_events


def settle(spark, rows, history=None, **options):
    settled = arbitrate_marks(
        frame(spark, rows), None if history is None else frame(spark, history), **options
    )
    return {r["ID"]: r["reject_reason"] for r in as_dicts(settled)}


# standing mark (by, role, mark) or None; request (by, role, mark); expected reason
TABLE = [
    (None, (1, 0, 1), None),
    (None, (1, 3, 2), None),
    ((1, 2, 1), (1, 2, 1), "same_value"),
    ((1, 3, 2), (1, 2, 2), "same_value"),
    ((1, 2, 1), (1, 2, 0), None),
    ((1, 3, 2), (2, 2, 2), None),
    ((1, 0, 1), (2, 2, 1), None),
    ((1, 0, 1), (1, 2, 1), "same_value"),
    ((1, 2, 1), (1, 0, 0), "teacher_mark"),
    ((1, 3, 2), (2, 1, 0), "teacher_mark"),
    ((1, 1, 1), (1, 1, 1), "same_value"),
    ((1, 0, 1), (1, 1, 1), "same_value"),
    ((1, 1, 1), (1, 1, 0), None),
    ((1, 0, 1), (2, 1, 1), None),
    ((1, 1, 1), (2, 0, 0), "monitor_mark"),
    ((1, 0, 1), (2, 0, 0), "other_user"),
    ((1, 0, 1), (1, 0, 1), "same_value"),
    ((1, 1, 1), (1, 0, 1), "same_value"),
    ((1, 0, 1), (1, 0, 0), None),
    ((1, 1, 1), (1, 0, 0), None),
]


def test_decision_table(spark):
    requests, standing, wanted = [], [], {}
    for i, (old, new, reason) in enumerate(TABLE):
        if old:
            by, role, mark = old
            standing.append(event(f"old{i}", by=by, role=role, mark=mark, student=i))
        by, role, mark = new
        requests.append(event(f"new{i}", at=5, by=by, role=role, mark=mark, student=i))
        wanted[f"new{i}"] = reason
        assert verdict(old, by, role, mark) == reason
    assert settle(spark, requests, standing) == wanted
    in_one = settle(spark, standing + requests)
    assert {k: v for k, v in in_one.items() if k.startswith("new")} == wanted
    assert all(v is None for k, v in in_one.items() if k.startswith("old"))


def test_chain_and_equal_times(spark):
    rows = [
        event("a", at=1, by=5, role=0, mark=1),
        event("b", at=2, by=5, role=0, mark=1),
        event("c", at=2, by=6, role=1, mark=0),
        event("d", at=3, by=5, role=0, mark=1),
        event("e", at=4, by=6, role=2, mark=0),  # same marker and mark: the student's mark stays
        event("f", at=5, by=6, role=0, mark=2),
        event("g", at=6, by=9, role=3, mark=2),
        event("h", at=7, by=6, role=1, mark=2),
        event("i", at=8, by=9, role=2, mark=2),
        event("j", at=9, by=9, role=2, mark=1),
    ]
    assert settle(spark, rows) == {
        "a": None, "b": "same_value", "c": None, "d": "monitor_mark", "e": "same_value", "f": None,
        "g": None, "h": "teacher_mark", "i": "same_value", "j": None,
    } == models.arbitrate(rows)


@pytest.mark.parametrize("rows_per_task", [5_000_000, 40])
@pytest.mark.parametrize("seed", [1, 2])
def test_random_interleavings(spark, seed, rows_per_task):
    """The second setting splits the groups into many chunks."""
    rows = [r for s in range(3) for r in random_events(seed * 10 + s, 300, keys=3 + 20 * s, markers=2 + s)]
    assert settle(spark, rows, rows_per_task=rows_per_task) == models.arbitrate(rows)


@pytest.mark.parametrize("rows_per_task", [5_000_000, 30])
def test_one_key_holds_most_rows(spark, rows_per_task):
    rows = random_events(5, 500, keys=1, markers=2) + random_events(6, 100, keys=30)
    assert settle(spark, rows, rows_per_task=rows_per_task) == models.arbitrate(rows)


@pytest.mark.parametrize("rows_per_task", [5_000_000, 30])
def test_history_comes_first(spark, rows_per_task):
    rows = random_events(7, 200, keys=6)
    old = [{**r, "ID": "h" + r["ID"], "TYPE_MARK": i % 2} for i, r in enumerate(random_events(8, 60, keys=4))]
    assert settle(spark, rows, old, rows_per_task=rows_per_task) == models.arbitrate(rows, old)


def test_copies_of_one_request_are_spread(spark):
    rows = [event("x", by=5, role=0)] * 60 + [event("y", at=1, by=5, role=0, mark=0)]
    settled = as_dicts(arbitrate_marks(frame(spark, rows), rows_per_task=10))
    assert len(settled) == 61
    assert sum(r["accepted"] for r in settled if r["ID"] == "x") == 1
    assert {r["reject_reason"] for r in settled if r["ID"] == "x"} == {None, "same_value"}


def test_accepted_and_rejected_make_the_input(spark):
    rows = random_events(9, 200)
    accepted, rejected = split_accepted(arbitrate_marks(frame(spark, rows)))
    assert accepted.count() + rejected.count() == len(rows)
    assert accepted.columns == frame(spark, rows).columns
    assert rejected.filter(F.col("reject_reason").isNull()).count() == 0


@pytest.mark.parametrize("rows_per_task", [5_000_000, 20])
def test_existing_marks(spark, rows_per_task):
    history = [{**r, "TYPE_MARK": i % 4 // 3} for i, r in enumerate(random_events(11, 150, keys=3))]
    asks = random_events(12, 80, keys=4)
    found = {
        r["ID"]: r["prev_id"]
        for r in as_dicts(existing_marks(frame(spark, asks), frame(spark, history), rows_per_task=rows_per_task))
    }
    for a in asks:
        earlier = [
            h for h in history
            if h["TYPE_MARK"] == 0 and all(h[k] == a[k] for k in models.KEY)
            and (h["DATE_CREATE"], h["ID"]) < (a["DATE_CREATE"], a["ID"])
        ]
        newest = max(earlier, key=lambda h: (h["DATE_CREATE"], h["ID"]), default=None)
        assert found[a["ID"]] == (newest and newest["ID"])
