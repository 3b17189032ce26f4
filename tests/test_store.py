from datetime import date

from pyspark.sql import functions as F

from rollmark.operators import latest
from rollmark.plans.session import scratch_path
from rollmark.schemas import ENRICHED_EVENT, OUTPUT_COLUMNS, STORE_COLUMNS
from rollmark.sinks import deltas, history, latest as latest_sink
from rollmark.sinks.files import exists, file_system
from rollmark.sinks.history import append_history, compact_history, file_ranges, find_mark, read_history
from rollmark.sinks.latest import compact_latest, read_mart, read_state, upsert_latest
from rollmark.sinks.messages import to_messages, write_messages
from rows import as_dicts, enriched, event, random_events


def stored(spark, rows):
    df = enriched(spark, rows).withColumn("MARKED_BY", F.col("MARKED_BY").cast("bigint"))
    return df.select(*STORE_COLUMNS)


def months(n=60):
    days = [date(2024, 1, 31), date(2024, 2, 1), date(2024, 2, 29), date(2024, 3, 1)]
    return [{**r, "LESSON_DATE": days[i % 4]} for i, r in enumerate(random_events(31, n, keys=3, ties=False))]


def folders(spark, path):
    """folder -> its data files, of everything below a table."""
    fs, root = file_system(spark, path)
    out, found = {}, fs.listFiles(root, True)
    while found.hasNext():
        file = found.next().getPath()
        if file.getName().endswith(".parquet"):
            out.setdefault(file.getParent().toString().split(path)[-1].strip("/"), set()).add(file.getName())
    return out


def test_history_is_pruned_by_month(spark):
    path = scratch_path(spark, "h")
    append_history(stored(spark, months()), path)
    assert read_history(spark, path).count() == 60
    part = read_history(spark, path, date(2024, 2, 1), date(2024, 2, 29))
    assert part.count() == 30
    assert all("lesson_month=202402" in f for f in part.inputFiles()) and part.inputFiles()
    assert dict(read_history(spark, path).dtypes)["lesson_month"] == "string"


def test_append_is_idempotent_and_reads_nothing(spark):
    path = scratch_path(spark, "h")
    rows = months()
    append_history(stored(spark, rows[:40]), path, "run", 0)
    before = folders(spark, path)
    append_history(stored(spark, rows[:40]), path, "run", 0)  # the batch runs again
    assert folders(spark, path) == before
    append_history(stored(spark, rows[20:]), path, "run", 1)
    append_history(stored(spark, []), path, "run", 2)
    append_history(stored(spark, rows[:40]), path, "another", 0)  # a fresh checkpoint
    for merged in (False, True):
        got = as_dicts(read_history(spark, path))
        assert len(got) == 60 and len({r["ID"] for r in got}) == 60
        if not merged:
            assert compact_history(spark, path) == ["202401", "202402", "202403"]


def test_the_plan_of_a_batch_has_no_scan_of_the_history(spark, monkeypatch):
    path, plans = scratch_path(spark, "h"), []
    append_history(stored(spark, months()), path, "run", 0)
    write = deltas.DeltaTable._write
    monkeypatch.setattr(deltas.DeltaTable, "_write", lambda self, rows, folder: (
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString()), write(self, rows, folder))[1])
    append_history(stored(spark, months()), path, "run", 1)
    upsert_latest(stored(spark, months()), scratch_path(spark, "l"), "run", 1)
    assert len(plans) == 2 and not any("parquet" in plan for plan in plans)


def test_an_interrupted_batch_is_written_anew(spark):
    path = scratch_path(spark, "h")
    rows = months()
    append_history(stored(spark, rows[:20]), path, "run", 0)
    append_history(stored(spark, rows[20:40]), path, "run", 1)
    (name,) = [f for f in deltas._batches(spark, path) if f.endswith("run_1")]
    fs, done = file_system(spark, f"{path}/part={name}/_SUCCESS")
    fs.delete(done, False)
    assert read_history(spark, path).count() == 20
    append_history(stored(spark, rows[20:]), path, "run", 1)
    assert read_history(spark, path).count() == 60 and len(deltas._batches(spark, path)) == 2


def test_merged_months_do_not_overlap_and_others_stay(spark):
    path = scratch_path(spark, "h")
    rows = months()
    for _ in range(3):
        append_history(stored(spark, rows), path)
    february = [r for r in rows if r["LESSON_DATE"].month == 2]
    append_history(stored(spark, february), path)
    assert compact_history(spark, path, least=4) == ["202402"]
    merged = {f for f in folders(spark, path) if "part=g-" in f}
    assert {f.rsplit("=", 1)[1] for f in merged} == {"202402"}
    assert read_history(spark, path).count() == 60
    before = folders(spark, path)
    append_history(stored(spark, [r for r in rows if r["LESSON_DATE"].month == 3]), path)
    assert compact_history(spark, path, least=2) == ["202401", "202403"]
    now = folders(spark, path)
    assert all(now[f] == before[f] for f in merged)
    for month in ("202401", "202402", "202403"):
        files = sorted(file_ranges(spark, path).filter(F.col("lesson_month") == month).collect(), key=lambda r: r.first)
        assert sum(f.n_rows for f in files) == {"202401": 15, "202402": 30, "202403": 15}[month]
        assert all(a.last <= b.first for a, b in zip(files, files[1:]))
    compact_history(spark, path)
    append_history(stored(spark, rows[:1]), path)
    compact_history(spark, path)
    compact_history(spark, path)
    assert not [f for f in folders(spark, path) if "part=d-" in f]
    assert read_history(spark, path).count() == 60


def test_find_mark_skips_row_groups(spark):
    path = scratch_path(spark, "h")
    day = date(2024, 3, 4)
    rows = [event(i, student=i * 2, at=i, day=day) for i in range(4000)]
    small = {"parquet.page.row.count.limit": "200"}
    dated = stored(spark, rows).withColumn("lesson_month", F.lit("202403")).coalesce(1)
    history.table(path, **small).add(dated)

    def looked_up(student):
        found = find_mark(spark, path, journal_id=1, student_id=student, lesson_id=10, day=day)
        got = [r.ID for r in found.collect()]
        return got, _scanned(found)

    assert looked_up(2000)[0] == ["1000"]
    assert looked_up(2000)[1] == 200  # one page, by the sort order
    assert looked_up(2001) == ([], 0)  # absent, but inside the range: by the Bloom filter


def _scanned(df):
    """Rows that the file scans of an executed plan gave."""
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            todo.append(node.finalPhysicalPlan())
        elif "QueryStage" in name:
            todo.append(node.plan())
        else:
            if name.startswith("Scan"):
                total += node.metrics().apply("numOutputRows").value()
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
    return total


def test_upsert_equals_latest_over_all(spark):
    path = scratch_path(spark, "l")
    rows = months(80)
    want = sorted(latest.latest_rows(stored(spark, rows)).select(*STORE_COLUMNS).collect())
    for k, part in enumerate((rows[50:], rows[:30], rows[20:60], rows[50:], [])):
        upsert_latest(stored(spark, part), path, "run", k)
        if k % 2:
            compact_latest(spark, path)
    assert sorted(read_state(spark, path).collect()) == want
    assert read_mart(spark, path).count() == len(want) and len(read_mart(spark, path).columns) == 30
    one = date(2024, 2, 1)
    assert sorted(read_state(spark, path, [one]).collect()) == [r for r in want if r.LESSON_DATE == one]


def test_a_batch_leaves_the_files_of_its_day_untouched(spark):
    path = scratch_path(spark, "l")
    day = date(2024, 1, 2)
    upsert_latest(stored(spark, [event(k, student=k, day=day) for k in range(9)]), path)
    compact_latest(spark, path)
    before = folders(spark, path)
    upsert_latest(stored(spark, [event("new", at=9, student=3, day=day)]), path, "run", 0)
    after = folders(spark, path)
    assert all(after[f] == files for f, files in before.items()) and len(after) == len(before) + 1
    assert {r.ID for r in read_state(spark, path).collect()} == {"new"} | {str(k) for k in range(9) if k != 3}


def test_a_reader_misses_nothing_while_partitions_are_merged(spark):
    """What was opened before a merge can be read after it, and what a merge half made is not seen."""
    path = scratch_path(spark, "l")
    days = [date(2024, 1, 1 + i) for i in range(3)]
    for k in range(3):
        upsert_latest(stored(spark, [event(f"{k}-{i}", at=k, student=i, day=d) for i, d in enumerate(days)]), path)
    opened = read_state(spark, path)
    compact_latest(spark, path)
    assert {r.ID for r in opened.collect()} == {"2-0", "2-1", "2-2"} == {r.ID for r in read_state(spark, path).collect()}
    upsert_latest(stored(spark, [event("z", at=9, student=1, day=days[1])]), path)
    opened = read_state(spark, path)
    table = latest_sink.table(path)
    table._write(table._rows(spark, []), "g-000000000099")  # a merge that ended before it published
    assert {r.ID for r in read_state(spark, path).collect()} == {"2-0", "z", "2-2"}
    compact_latest(spark, path)
    assert {r.ID for r in opened.collect()} == {"2-0", "z", "2-2"} == {r.ID for r in read_state(spark, path).collect()}
    assert not exists(spark, f"{path}/part=g-000000000099")


def test_the_last_batch_of_a_run_is_not_merged(spark):
    path = scratch_path(spark, "l")
    for k in range(3):
        upsert_latest(stored(spark, [event(k, at=k, student=1)]), path, "run", k)
    compact_latest(spark, path)
    table = latest_sink.table(path)
    assert table.pending(spark) == 1
    assert [r.ID for r in table.read(spark, but=("run", 2)).collect()] == ["1"]
    assert [r.ID for r in read_state(spark, path).collect()] == ["2"]


def test_messages_round_trip_and_replay(spark):
    df = enriched(spark, [event(i, at=i) for i in range(5)])
    path = scratch_path(spark, "m")
    for _ in range(2):
        write_messages(to_messages(df), "parquet", batch_id=3, path=path)
    back = spark.read.parquet(path)
    assert back.count() == 5
    row = back.filter("key = '2'").select(F.from_json("value", ENRICHED_EVENT).alias("e")).select("e.*").first()
    assert row.DATE_CREATE == "2024-03-04 09:00:02.000000" and row.LESSON_DATE == "2024-03-04"
    assert list(row.asDict()) == OUTPUT_COLUMNS
    assert "STUDENT_FIO" not in back.first().value
