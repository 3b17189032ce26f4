"""The journal's relational tables, from files or from a database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rollmark.operators.admit import School

_PAIR = "JOURNAL_ID bigint, RESPONSIBLE_ID bigint"

# The columns of each table that are read.
TABLES = {
    "lessons": "ID bigint, DATE date, TYPE_ID int, NUMBER int, BLOCKED boolean",
    "responsible_teachers": _PAIR,
    "responsible_students": _PAIR,
    "grants": "user_id bigint, journal_id bigint, grant_kind string",
    "dean_office": "user_id bigint",
}


def read_school(spark: SparkSession, root: str, fmt: str = "parquet") -> School:
    """All tables from folders named after them below ``root``."""
    return School(
        **{name: spark.read.schema(ddl).format(fmt).load(f"{root}/{name}") for name, ddl in TABLES.items()}
    )


# The column that a table is split by when it is read in parallel.
SPLIT_BY = {
    "lessons": "ID", "responsible_teachers": "JOURNAL_ID", "responsible_students": "JOURNAL_ID",
    "grants": "journal_id", "dean_office": "user_id",
}


def read_school_jdbc(
    spark: SparkSession, url: str, *, per_table: dict[str, dict[str, str]] | None = None, **options: str
) -> School:
    """All tables from a database, each with a projection to its declared columns. ``options`` hold
    for all tables and ``per_table`` for single ones: ``numPartitions``, ``lowerBound`` and
    ``upperBound`` there read a large table in parallel, split by its own id column."""

    def read(name: str, ddl: str) -> DataFrame:
        own = {**options, **(per_table or {}).get(name, {})}
        reader = spark.read.format("jdbc").option("url", url).option("dbtable", name)
        if "numPartitions" in own:
            own.setdefault("partitionColumn", SPLIT_BY[name])
        wanted = [field.split() for field in ddl.split(", ")]
        return reader.options(**own).load().selectExpr(*[f"CAST({c} AS {kind}) AS {c}" for c, kind in wanted])

    return School(**{name: read(name, ddl) for name, ddl in TABLES.items()})
