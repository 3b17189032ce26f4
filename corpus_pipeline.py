"""A corpus from documents to packed sequences, stage by stage.

A stage takes (spark, docs, sf_dir) and returns the documents that it keeps, with the columns they
came with; the last returns the pieces of the packed sequences. Between stages the documents are a
table in the shared folder, so a lost executor costs a stage's tasks at most.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollmark.llm import decontamination, language, near_duplicates, packing, secret_scan
from rollmark.llm.stored import stored

#: Keys that are sent to all tasks, 16 bytes each; more are joined by a shuffle of the documents.
SENT = 1_000_000
#: What goes to Python at a time. A batch is held several times, by the JVM outside its heap and by the Python
#: worker, which keeps the room for the stages after; as many rows as Spark takes by default are tens of MB.
BATCH = "2m"


def _in_small_batches(stage: Callable[[SparkSession, DataFrame, str], DataFrame]):
    """The setting stays with the session, as what the stage returns is computed later."""
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH)
        return stage(spark, docs, sf_dir)

    return run


def _sendable(keys: DataFrame) -> DataFrame | None:
    """A stored table of keys, marked for broadcast if it is small; None if it has no rows."""
    keys = stored(keys, "keys")
    n = keys.count()
    return None if n == 0 else F.broadcast(keys) if n <= SENT else keys


def _without(docs: DataFrame, keys: DataFrame | None) -> DataFrame:
    return docs if keys is None else docs.join(keys, "key", "left_anti")


def _with_key(docs: DataFrame) -> DataFrame:
    """(row, key, text): each row as a whole, so its columns clash with nothing, and the bigint it is told
    apart by. That is its doc_id where no other row has the same, and otherwise a number above 2**62 that
    follows from doc_id and text: texts under one id are told apart, and rows that repeat both are not."""
    ids = docs.groupBy(F.col("doc_id").alias("id")).agg(F.count("*").alias("rows"))
    shared = _sendable(ids.filter("rows > 1 or id is null or id >= 1L << 62").select(
        F.col("id").cast("bigint").alias("id"), F.lit(True).alias("shared")))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("bigint").alias("id"), "text")
    if shared is None:
        return rows.select("row", F.col("id").alias("key"), "text")
    both = rows.alias("r").join(shared.alias("s"), F.col("r.id").eqNullSafe(F.col("s.id")), "left")
    other = F.xxhash64("r.id", "text").bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    return both.select("row", F.when(F.col("shared"), other).otherwise(F.col("r.id")).alias("key"), "text")


@_in_small_batches
def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned; those without a letter, with null or empty text,
    or that no language fits (another script, noise), go. If no row has a language to learn from, nothing
    can be told and all documents stay. Rows are judged one by one, repeated ones alike."""
    model = language.learn_from_documents(docs)
    if model is None:
        return docs
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("text"))
    kept = language.identify(rows, "text", model, strict=True)
    return kept.filter(F.col("lang_pred") != language.UNDECIDED).select("row.*")


@_in_small_batches
def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity of 0.8) the one with the
    smallest doc_id; ids that several rows have come last. Texts are compared, whatever their ids: of rows that
    repeat id and text one stays, and of several texts under one id each that copies nothing. Documents
    without a word are near copies of nothing."""
    keyed = _with_key(docs)
    near = stored(near_duplicates.near_duplicates(keyed, doc_id="key").select(
        F.col("doc_id").alias("key"), "component_id"), "near")
    copies = _sendable(near.filter("key != component_id").select("key").distinct())
    kept = _without(keyed, copies)
    repeated = _sendable(near.filter("key = component_id").groupBy("key").count().filter("count > 1").select("key"))
    if repeated is not None:
        once = kept.join(repeated, "key", "left_semi").dropDuplicates(["key"])
        kept = _without(kept, repeated).unionByName(once)
    return kept.select("row.*")


@_in_small_batches
def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark; of rows under one id each is judged by its text."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    keyed = _with_key(docs)
    found = decontamination.leaks(keyed.select(F.col("key").alias("doc_id"), "text"), benchmark)
    leaked = _sendable(found.select(F.col("doc_id").alias("key")).distinct())
    return _without(keyed, leaked).select("row.*")


@_in_small_batches
def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with [secret] in place of every secret; a null text stays null. A column n_chars, if
    there is one, is counted again."""
    out = secret_scan.redact(docs)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


@_in_small_batches
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents by sequence and offset, with a checksum of their ids. A null or empty text is
    its end alone; rows that repeat an id are packed each."""
    return packing.pack(docs).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identified), ("near_duplicates", deduplicated), ("decontamination", decontaminated),
    ("secrets", redacted), ("packing", packed),
]

#: SQL can express neither the trained language model nor the latent search.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
