"""The corpus pipeline: each stage applies one operator to all that its predecessor kept.

Stages take (spark, docs, sf_dir) and return the columns of documents; the last one returns the packed pieces. Rows that share a
document number stay or go together where a stage decides by number. Rows without a number pass every stage that decides so.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridmill.llm import decontamination, language, linededup, neardup, packing
from gridmill.session import scratch

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that have no letter, or that no learnt language explains: their letters are as good as random."""
    docs = docs.select(*COLUMNS)
    languages, logp = language.learn(docs, F.lit(True))
    found = language.predict(docs, languages, logp, keep_text=True)
    explained = (F.col("lang_pred") != language.UNKNOWN) & (F.col("evidence") >= language.NO_LANGUAGE)
    return found.where(explained | F.lit(not languages) & F.col("text").rlike(r"\p{L}")).select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of lines are cut out; documents of which no word is left go."""
    left = linededup.delete_repeats(docs.select(*COLUMNS))
    return left.where((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")).withColumn(
        "n_chars", F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 80 % of their five-word shingles, the one with the smallest number stays."""
    docs = docs.select(*COLUMNS)
    gone = neardup.near_copies(docs, k=5, percent=80).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontamination.clean(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all remaining documents with their places in sequences."""
    return packing.pack(docs)


STAGES = [
    ("language", language_stage),
    ("line_dedup", line_stage),
    ("near_copies", near_copy_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]
#: Learned models and tokenizers are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents through all stages; every stage's rows are written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = scratch(spark, f"corpus-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
