"""From raw documents to training sequences: five stages, each over all that the stage before has kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from walkgrid.llm import decontam, langid, line_dedup, near_dedup, packing
from walkgrid.llm.common import table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; null texts, texts without letters and texts far from every language go."""
    model = langid.fit(docs.filter(~langid.held_out()).select("doc_id", "text", "lang"))
    return langid.identify(docs.select(*COLUMNS), model).filter("not rejected").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their source's boilerplate lines; documents that held nothing else go."""
    found = line_dedup.drop_boilerplate(docs.select(*COLUMNS)).filter("n_dropped = 0 or trim(kept_text) != ''")
    changed = F.col("n_dropped") > 0
    return found.withColumn("text", F.when(changed, F.col("kept_text")).otherwise(F.col("text"))).withColumn("n_chars", F.when(changed, F.length("kept_text")).otherwise(F.col("n_chars")).cast("long")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest id, of each group of near-duplicates."""
    return near_dedup.drop_near_duplicates(docs.select(*COLUMNS)).select(*COLUMNS)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontam.drop_contaminated(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All tokens of the documents in sequences of at most 2048."""
    return packing.pack_documents(docs.select("doc_id", "text"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("line_dedup", lines),
    ("near_dedup", near_duplicates),
    ("decontaminate", benchmark),
    ("pack", pack),
]
#: Two stages (a trained classifier, packing by local search) have no SQL text; the tests hold every stage against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each keeps is a table that the next one reads."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = table(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
