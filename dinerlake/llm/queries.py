"""The registered queries of the training-data operators.

Each reads its whole tables and derives its columns from what its operator returns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dinerlake.llm import decontaminate, html_text, langid, lexical, repair, secrets, toxicity
from dinerlake.llm.bagminhash import near_copies
from dinerlake.llm.common import configure, held_out
from dinerlake.llm.licenses import license_scan
from dinerlake.llm.mixing import mix
from dinerlake.llm.sharding import kd_shards
from dinerlake.llm.substrings import remove_repeats
from dinerlake.llm.topk import top_k


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op3_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(table(spark, sf_dir, "documents"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs)
    found = docs.select("doc_id", "text").withColumn("found", langid.language(model))
    return found.select(
        "doc_id", held_out().alias("held_out"), F.col("found.lang").alias("lang_pred"), "found.score"
    )


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents have no path; they are filed by block of 50 ids and source, and the first of a block is its
    LICENSE file."""
    block = F.expr("doc_id div 50").cast("string")
    path = F.when(F.col("doc_id") % 50 == 0, F.concat(block, F.lit("/LICENSE"))).otherwise(
        F.concat_ws("/", block, F.coalesce("source", F.lit("none")),
                    F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))))
    docs = table(spark, sf_dir, "documents").select(path.alias("path"), "text")
    found = license_scan(docs)
    return found.select("path", "license", "score", "origin", "directory")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    found = docs.withColumn("found", toxicity.toxicity(model))
    return found.select(
        "doc_id", held_out().alias("held_out"), "found.score",
        (F.col("found.score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        F.col("found.sentences").alias("sentences"),
    )


def op8_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaked_pairs(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = pages.select("page_id", "url", html_text.main_text().alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    kept = F.when(F.col("kept").isNull(), F.col("whole")).otherwise(F.sha2(F.col("kept").cast("binary"), 256))
    return found.select("doc_id", "n_words", "n_removed", kept.alias("kept_sha256"))


def op11_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = kd_shards(table(spark, sf_dir, "documents"), shards=40)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """The rows of ``conversations`` with faults put in by a hash of their key; dropped ones are flagged."""
    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat_ws(":", shown("conv_id"), shown("turn")).cast("binary")) % 20
    text = (
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(shown("text"), "[.!?]", ""))
        .otherwise(shown("text"))
    )
    copies = F.when(kind == 3, 2).otherwise(1)
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(shown("role")).alias("role"),
        text.alias("text"), (kind == 0).alias("dropped"),
        F.explode(F.array_repeat(F.lit(0), copies)).alias("copy"),
    )


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repair.mended(damaged(table(spark, sf_dir, "conversations")), F.col("dropped"))
    return repair.reports(found)


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_top_k": op2_top_k,
    "op3_near_copies": op3_near_copies,
    "op4_secrets": op4_secrets,
    "op5_language": op5_language,
    "op6_licenses": op6_licenses,
    "op7_toxicity": op7_toxicity,
    "op8_leaks": op8_leaks,
    "op9_main_text": op9_main_text,
    "op10_repeats": op10_repeats,
    "op11_shards": op11_shards,
    "op12_repair": op12_repair,
    "op13_search": op13_search,
}
