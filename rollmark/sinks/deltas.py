"""Tables that take a batch at the cost of the batch.

A batch writes a folder of its own and reads nothing of the table. What the table says is worked out
when it is read: one row per key over all folders, where rows that no unmerged batch touches pass as they
are. Merging folds batches into the partitions they touch, beside the table, and then publishes a new
pointer: one small file that names the folder of every merged partition. Nothing is moved or replaced in
place, so a reader sees the table either before or after a merge, never between.

    <path>/part=d-<number>-<run>_<batch>/<by>=.../   a batch, there once its _SUCCESS is
    <path>/part=g-<number>/<by>=.../                 merged partitions
    <path>/_pointer/<number>                         {"parts": {value: folder}, "merged": {value: [folders]}}

There is one writer and one merger at a time, which may be the same. What a merge replaces stays until the
next merge, so a read may last until the next but one.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rollmark.sinks.files import exists, file_system

#: The batch that brought a row, counted over the table's life.
NUMBER = "_number"
_BATCH = re.compile(r"part=(d-(\d{12})-(.*)_(.*))")

Step = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class View:
    """What a reader sees: the folder of each merged partition, and the batches of each partition that
    are not merged yet."""

    version: int = 0
    parts: dict[str, str] = field(default_factory=dict)
    merged: dict[str, list[str]] = field(default_factory=dict)
    batches: dict[str, list[str]] = field(default_factory=dict)


@dataclass(frozen=True)
class DeltaTable:
    """``columns`` is the DDL of the rows, ``by`` the partition column among them, ``key`` what rows are
    told apart by (it holds ``by``, or follows from it). ``reduce`` keeps one row per key of rows that also have
    ``_number``, and must give the same in any order and grouping of merges. Files are sorted by ``sort``;
    merged ones of one partition do not overlap. ``whole`` is for small tables and for keys that may be NULL:
    all rows are reduced when they are read, those of merged partitions too."""

    path: str
    columns: str
    by: str
    key: tuple[str, ...]
    reduce: Step
    sort: tuple[str, ...] = ()
    whole: bool = False
    options: dict[str, str] = field(default_factory=dict)

    # --- writing ------------------------------------------------------------------------------

    def add(self, rows: DataFrame, run: str = "", batch: int | None = None) -> None:
        """Add a batch. One that is there already, by the same run and number, stays as it is; one that
        was interrupted is written anew."""
        spark = rows.sparkSession
        there = _batches(spark, self.path)
        name = f"{_safe(run)}_{uuid.uuid4().hex if batch is None else batch}"
        number, done = next(((n, ok) for n, own, ok in there.values() if own == name), (None, False))
        if done:
            return
        if number is None:
            number = 1 + max([_pointer(spark, self.path)[1].get("number", 0), *(n for n, _, _ in there.values())])
        # The hint gathers a partition's rows into few files and splits a partition that is large.
        rows = rows.withColumn(NUMBER, F.lit(number).cast("bigint")).hint("rebalance", self.by)
        self._write(rows, f"d-{number:012d}-{name}")

    def _write(self, rows: DataFrame, folder: str) -> None:
        laid = rows.sortWithinPartitions(self.by, *self.sort)
        laid.write.mode("overwrite").options(**self.options).partitionBy(self.by).parquet(f"{self.path}/part={folder}")

    # --- reading ------------------------------------------------------------------------------

    def view(self, spark: SparkSession) -> View:
        """The present state, read between two looks at the pointer that agree."""
        while True:
            version, state = _pointer(spark, self.path)
            merged = state.get("merged", {})
            batches: dict[str, list[str]] = {}
            for folder, (_, _, complete) in sorted(_batches(spark, self.path).items()):
                if complete:
                    for value in _values(spark, f"{self.path}/part={folder}", self.by):
                        if folder not in merged.get(value, ()):
                            batches.setdefault(value, []).append(folder)
            if _pointer(spark, self.path)[0] == version:
                return View(version, state.get("parts", {}), merged, batches)

    def _rows(self, spark: SparkSession, folders: Sequence[tuple[str, str]], **more: Column) -> DataFrame:
        schema = f"{self.columns}, {NUMBER} bigint, part string"
        if not folders:
            return spark.createDataFrame([], schema).withColumns({n: F.lit("") for n in more}).drop("part")
        paths = [f"{self.path}/part={folder}/{self.by}={value}" for folder, value in folders]
        rows = spark.read.schema(schema).option("basePath", self.path).parquet(*paths)
        return rows.withColumns(more).drop("part")

    def files(self, spark: SparkSession, folders: Sequence[tuple[str, str]]) -> DataFrame:
        """The rows of some (folder, partition) as they lie in the files, with the name of their file."""
        return self._rows(spark, folders, file=F.col("_metadata.file_name"))

    def read(
        self, spark: SparkSession, wanted: Callable[[str], bool] | None = None, *, where: Step | None = None,
        but: tuple[str, int] | None = None, view: View | None = None,
    ) -> DataFrame:
        """One row per key. ``wanted`` tells which partitions are read, by the text of their value;
        ``where`` is applied to the rows before they are reduced and must keep or drop all rows of a key;
        ``but`` leaves out the batch of a run, which must not be merged yet."""
        view = view or self.view(spark)
        where = where or (lambda df: df)
        left_out = None if but is None else (_safe(but[0]), str(but[1]))
        asked = [v for v in {*view.parts, *view.batches} if wanted is None or wanted(v)]
        fresh = [(f, v) for v in sorted(asked) for f in view.batches.get(v, ())
                 if _BATCH.fullmatch(f"part={f}").group(3, 4) != left_out]
        base = where(self._rows(spark, [(view.parts[v], v) for v in sorted(asked) if v in view.parts]))
        if not fresh:
            return base.drop(NUMBER)
        news = where(self._rows(spark, fresh))
        if not any(v in view.parts for v in asked):
            return self.reduce(news).drop(NUMBER)
        if self.whole:
            return self.reduce(base.unionByName(news)).drop(NUMBER)
        keys = news.select(*self.key).distinct()
        touched = base.join(keys, list(self.key), "left_semi").unionByName(news)
        return base.join(keys, list(self.key), "left_anti").unionByName(self.reduce(touched)).drop(NUMBER)

    # --- merging ------------------------------------------------------------------------------

    def pending(self, spark: SparkSession) -> int:
        """Batches that are not merged yet."""
        return len({f for folders in self.view(spark).batches.values() for f in folders})

    def merge(self, spark: SparkSession, least: int = 1) -> list[str]:
        """Fold batches into the partitions that at least ``least`` of them touch; gives these partitions.

        The last batch of every run stays out: it may be run again, and may ask what was there before it.
        """
        self._clean(spark)
        view = self.view(spark)
        last: dict[str, str] = {}
        for folder, (_, own, complete) in sorted(_batches(spark, self.path).items()):
            run = own.rsplit("_", 1)[0]
            if complete and run:
                last[run] = folder
        ripe = {v: [f for f in folders if f not in last.values()] for v, folders in view.batches.items()}
        ripe = {v: folders for v, folders in ripe.items() if folders and len(folders) >= least}
        if not ripe:
            return []
        rows = self._rows(spark, [(f, v) for v, folders in ripe.items() for f in folders])
        rows = rows.unionByName(self._rows(spark, [(view.parts[v], v) for v in ripe if v in view.parts]))
        number = view.version + 1
        # Ranges cut the rows evenly, whatever the size of a partition.
        self._write(self.reduce(rows).repartitionByRange(self.by, *(self.sort or self.key)), f"g-{number:012d}")
        made = _values(spark, f"{self.path}/part=g-{number:012d}", self.by)
        state = {
            "parts": {**view.parts, **{v: f"g-{number:012d}" for v in made}},
            "merged": {v: [*view.merged.get(v, ()), *ripe.get(v, ())] for v in {*view.merged, *ripe}},
            "number": max([0, *(n for n, _, _ in _batches(spark, self.path).values())]),
        }
        _publish(spark, self.path, number, state)
        return sorted(ripe)

    def _clean(self, spark: SparkSession) -> None:
        """Delete what the merge before replaced, and what an interrupted one left."""
        version, state = _pointer(spark, self.path)
        fs, root = file_system(spark, self.path)
        if not fs.exists(root):
            return
        merged, kept = state.get("merged", {}), set(state.get("parts", {}).values())
        gone = set()
        for folder, (_, _, complete) in _batches(spark, self.path).items():
            values = _values(spark, f"{self.path}/part={folder}", self.by)
            if complete and all(folder in merged.get(v, ()) for v in values):
                gone.add(folder)
        for status in fs.listStatus(root):
            name = status.getPath().getName()
            if name.startswith("part=g-") and name[5:] not in kept:
                gone.add(name[5:])
        for folder in gone:
            fs.delete(file_system(spark, f"{self.path}/part={folder}")[1], True)
        if any(gone & set(folders) for folders in merged.values()):
            left = {v: [f for f in folders if f not in gone] for v, folders in merged.items()}
            _publish(spark, self.path, version + 1, {**state, "merged": {v: fs_ for v, fs_ in left.items() if fs_}})
        pointers = file_system(spark, f"{self.path}/_pointer")[1]
        if fs.exists(pointers):
            for status in fs.listStatus(pointers):
                if int(status.getPath().getName().lstrip(".") or 0) < version:
                    fs.delete(status.getPath(), False)


def _safe(run: str) -> str:
    return re.sub(r"[^A-Za-z0-9-]", "-", run)


def _batches(spark: SparkSession, path: str) -> dict[str, tuple[int, str, bool]]:
    """folder -> (number, run and batch, complete?) of every batch."""
    fs, root = file_system(spark, path)
    if not fs.exists(root):
        return {}
    out = {}
    for status in fs.listStatus(root):
        found = _BATCH.fullmatch(status.getPath().getName())
        if found:
            folder, number, run, batch = found.groups()
            out[folder] = int(number), f"{run}_{batch}", exists(spark, f"{path}/part={folder}/_SUCCESS")
    return out


def _values(spark: SparkSession, folder: str, by: str) -> list[str]:
    """The partitions below a folder, as they stand in its names."""
    fs, root = file_system(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()]
    return [name.split("=", 1)[1] for name in names if name.startswith(f"{by}=")]


def _pointer(spark: SparkSession, path: str) -> tuple[int, dict]:
    fs, root = file_system(spark, f"{path}/_pointer")
    if not fs.exists(root):
        return 0, {}
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    newest = max([n for n in names if n.isdigit()], default=None)
    if newest is None:
        return 0, {}
    stream = fs.open(file_system(spark, f"{path}/_pointer/{newest}")[1])
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return int(newest), json.loads(text)


def _publish(spark: SparkSession, path: str, version: int, state: dict) -> None:
    """Write the file beside, and give it its name: it is there whole or not at all."""
    fs, root = file_system(spark, f"{path}/_pointer")
    fs.mkdirs(root)
    beside = file_system(spark, f"{path}/_pointer/.{version:012d}")[1]
    stream = fs.create(beside, True)
    stream.write(bytearray(json.dumps(state, sort_keys=True).encode()))
    stream.close()
    if not fs.rename(beside, file_system(spark, f"{path}/_pointer/{version:012d}")[1]):
        raise OSError(f"version {version} of {path} is there already: is there another merger?")
