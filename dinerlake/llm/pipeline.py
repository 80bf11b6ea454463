"""A document pipeline of five stages; each stage's result is written and reread by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dinerlake.llm import decontaminate, secrets, toxicity
from dinerlake.llm.bagminhash import one_of_each
from dinerlake.llm.common import configure, numbered, scratch, written
from dinerlake.llm.mixing import mix

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
FIGURES = ("size", "source_size", "target", "taken")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under the threshold; NULL and empty texts score 0 and stay."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.toxicity(model)["score"] < toxicity.THRESHOLD)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each class of near copies (NULL ids last), one row of repeated
    rows, and every document without a word."""
    configure(spark)
    return one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item; NULL and empty texts stay, an empty benchmark drops nothing."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts replaced by the name of their kind."""
    configure(spark)
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with all their columns and size, source_size, target, taken.

    A figure whose name is also a column of the documents is called ``mix_<name>`` instead.  NULL and empty texts
    have no words and are never taken; repeated rows are taken one by one; a NULL source is the last
    source; an empty table gives no rows.
    """
    configure(spark)
    rows = numbered(docs.select(F.struct("*").alias("row")), "mixing")
    mixed = mix(rows.select("rid", "row.doc_id", "row.source", "row.text"), keep=("rid",)).where("taken > 0")
    taken = {c.lower() for c in docs.columns}
    figures = [F.col(c).alias(f"mix_{c}" if c in taken else c) for c in FIGURES]
    return rows.join(mixed.drop("doc_id", "source"), "rid").select("row.*", *figures)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
]

# Trained scores, signatures and edit distances have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of ``documents`` after all stages, in a written table; see each stage for its rows.

    NULLs, empty and very long texts, ties, repeated rows, empty tables and other columns are handled by
    every stage as its function says; other columns come through to the end.  A stage's scratch tables are
    removed once its result is written; after a failure they stay.
    """
    configure(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        before = docs
        with scratch(spark):
            docs = written(stage(spark, before, sf_dir), f"pipeline-{name}", keep=True)
    return docs
