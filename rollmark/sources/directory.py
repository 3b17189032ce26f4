"""User-directory documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollmark.schemas import EDUCATION, PERSONAL, WORK


def _list_or_empty(text: str, ddl: str):
    """Array field given as raw JSON text: NULL when absent, empty when it is not a list."""
    raw = F.col(text)
    as_list = F.from_json(raw, ddl)
    return F.when(raw.isNull(), F.lit(None)).when(
        F.ltrim(raw).startswith("["), F.coalesce(as_list, F.array().cast(ddl))
    ).otherwise(F.array().cast(ddl))


def parse_documents(docs: DataFrame, document: str = "document") -> DataFrame:
    """JSON documents to (PERSONAL, EDUCATION, WORK).

    The two lists are taken as text first, because a list of the wrong shape counts as empty
    while an absent one counts as absent.
    """
    shape = f"PERSONAL {' '.join(PERSONAL.split())}, EDUCATION string, WORK string"
    parsed = docs.select(F.inline(F.array(F.from_json(document, shape))))
    return parsed.select(
        "PERSONAL",
        _list_or_empty("EDUCATION", " ".join(EDUCATION.split())).alias("EDUCATION"),
        _list_or_empty("WORK", " ".join(WORK.split())).alias("WORK"),
    )


def read_directory(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """A stored directory: columnar files with the nested columns, or text lines of JSON."""
    if fmt == "text":
        lines = spark.read.format("text").options(**options).load(path)
        return parse_documents(lines, "value")
    schema = f"PERSONAL {PERSONAL}, EDUCATION {EDUCATION}, WORK {WORK}"
    return spark.read.schema(schema).format(fmt).options(**options).load(path)
