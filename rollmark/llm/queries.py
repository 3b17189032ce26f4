"""The operators as queries over the given tables: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollmark.llm import (
    attention_lm, decontamination, fill_middle, language, neighbours, ngram_join, packing, page_text, ranked_search,
    secret_scan, toxicity, url_templates,
)
from rollmark.llm.near_duplicates import near_duplicates

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _remainder(key: str, divisor: int):
    return F.crc32(F.col(key).cast("string").cast("binary")) % divisor


def op1_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return decontamination.leaks(_table(spark, d, "documents"), _table(spark, d, "benchmark"))


def op2_language(spark: SparkSession, d: str) -> DataFrame:
    docs = _table(spark, d, "documents")
    model = language.learn_from_documents(docs)
    rows = docs.select("doc_id", (_remainder("doc_id", 3) == 1).alias("held_out"), "text")
    return language.identify(rows, "text", model).drop("text")


def op3_neighbours(spark: SparkSession, d: str) -> DataFrame:
    vectors = _table(spark, d, "embeddings")
    return neighbours.nearest(vectors, vectors.filter("vec_id % 50 = 0"), k=5)


URL_RULES = [
    url_templates.Rule("allow", "com", "/"), url_templates.Rule("block", "example.com", "/en/"),
    url_templates.Rule("allow", "www.example.com", "/en/"), url_templates.Rule("block", "net", "/es/"),
    url_templates.Rule("block", "net", "/fr/"),
]


def op4_attention_lm(spark: SparkSession, d: str) -> DataFrame:
    return attention_lm.score(_table(spark, d, "documents"), training=_remainder("doc_id", 7) != 2)


def op5_url_templates(spark: SparkSession, d: str) -> DataFrame:
    judged = url_templates.judge(_table(spark, d, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "template")


def op6_page_text(spark: SparkSession, d: str) -> DataFrame:
    return page_text.extract_pages(_table(spark, d, "pages"))


def op7_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(_table(spark, d, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_near_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicates(_table(spark, d, "documents"), words=2, similarity=0.8)


def op9_toxicity(spark: SparkSession, d: str) -> DataFrame:
    docs = _table(spark, d, "documents")
    model = toxicity.learn_from_labels(docs, _table(spark, d, "labels"))
    rows = docs.select("doc_id", (_remainder("doc_id", 5) == 0).alias("held_out"), "text")
    return toxicity.score(rows, "text", model).drop("text")


def op10_secrets(spark: SparkSession, d: str) -> DataFrame:
    found = secret_scan.find_secrets(_table(spark, d, "documents").select("doc_id", "text"))
    base = F.filter("secrets", lambda s: s["kind"] != "guess")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"),
                        count("guess"))


def op11_fill_middle(spark: SparkSession, d: str) -> DataFrame:
    made = fill_middle.fill_middle(_table(spark, d, "documents"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op12_ngram_join(spark: SparkSession, d: str) -> DataFrame:
    return ngram_join.ngram_join(_table(spark, d, "documents"), words=5, similarity=0.8)


def op13_ranked_search(spark: SparkSession, d: str) -> DataFrame:
    return ranked_search.search(_table(spark, d, "documents"), _table(spark, d, "benchmark"), k=50)


QUERIES: dict[str, Query] = {
    "op1_decontamination": op1_decontamination,
    "op2_language": op2_language,
    "op3_neighbours": op3_neighbours,
    "op4_attention_lm": op4_attention_lm,
    "op5_url_templates": op5_url_templates,
    "op6_page_text": op6_page_text,
    "op7_packing": op7_packing,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_toxicity": op9_toxicity,
    "op10_secrets": op10_secrets,
    "op11_fill_middle": op11_fill_middle,
    "op12_ngram_join": op12_ngram_join,
    "op13_ranked_search": op13_ranked_search,
}
