"""Intermediate tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rollmark.plans.session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows, read back from a table in the shared folder: what is built on them neither
    computes them again nor depends on the executors that did."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Intermediate tables of one job, which go when their last reader is done."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (out, path)
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete these tables; nothing may read them any more."""
        for table in tables:
            _, path = self.paths.pop(id(table))
            target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)

    def drop_all(self, *but: DataFrame) -> None:
        kept = {id(table) for table in but}
        self.drop(*[table for key, (table, _) in list(self.paths.items()) if key not in kept])
