"""Corpus preparation: quality classifier, line dedup, n-gram Jaccard join, decontamination, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdspark.llm import decontaminate, line_dedup, ngram_join, packing, quality
from crowdspark.llm.common import written
from crowdspark.llm.queries import tokenizer_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the classifier rejects; it is fitted to the documents it judges."""
    return quality.keep_good(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes repeated passages; drops a document if nothing of its text is left. n_chars follows the text."""
    done = line_dedup.dedup_passages(docs).where("removed_lines = 0 or trim(translate(text, '\n\t\r', '   ')) <> ''")
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.when(F.col("removed_lines") > 0, F.length("text").cast(
            docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return done.select(*docs.columns)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates, the one with the smallest doc_id.

    Shingles of five words, and a similarity of 0.8 or more.
    """
    return ngram_join.keep_one(docs, n_words=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of 2048 tokens; one row per piece."""
    return packing.pack_documents(docs, tokenizer_path, end_id=1, window=2048)


STAGES = [("quality classifier", quality_classifier), ("line dedup", line_dedup_stage), ("n-gram Jaccard join", ngram_jaccard),
          ("benchmark decontamination", decontamination), ("packing", packing_stage)]

#: No SQL for the classifier, the latent search and the tokenizer: tests compare run() with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over ``documents``; each one's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
