"""From raw documents to token ids: five stages, each over all that the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; between stages it is written as Parquet and
read again. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardgrid.llm import common, decontamination, langid, linededup, neardup, sentencepieces
from wardgrid.llm.queries import model_path


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told without doubt; those without a letter or between two languages go.
    Learned from the labelled documents that are not held out."""
    model = langid.train(docs.filter(~langid.held_out()))
    told = langid.predict(docs, model)
    return told.filter((F.col("lang_pred") != langid.UNKNOWN) & ~F.col("ambiguous")).select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated runs of lines; one of which nothing is left goes."""
    done = linededup.dedup(docs)
    emptied = (F.col("n_deleted") > 0) & (~F.col("kept_text").rlike(linededup.FILLED))
    cut = F.col("n_deleted") > 0
    out = done.filter(~F.coalesce(emptied, F.lit(False))).withColumn("text", F.col("kept_text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(cut, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: that with the smallest id."""
    return neardup.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    items = common.table(spark, sf_dir, "benchmark", "item_id", "text")
    return decontamination.decide(docs, items).filter(~F.col("contaminated")).select(*docs.columns)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document."""
    done = sentencepieces.encode(docs.select("doc_id", "lang", "source", "text"), model_path())
    return done.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language ID", language_stage),
    ("line dedup", line_stage),
    ("near duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("SentencePiece", token_stage),
]

# several stages can't be expressed in SQL; tests compare them with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
