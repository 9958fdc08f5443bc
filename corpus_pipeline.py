"""The corpus pipeline: ``documents`` through four stages, each on all that the
one before kept.

1. language ID: documents whose language cannot be told go (no letters, or a
   score under ``MIN_LANGUAGE_SCORE``);
2. quality rules: documents that fail the rules go;
3. near-duplicates (n-gram Jaccard join): the smallest ``doc_id`` of each group stays;
4. best-fit packing of what is left.

Every stage but the last returns the columns of its input, unchanged. Rows with
a null ``doc_id`` are judged like all others and are nobody's duplicate; rows
that repeat a ``doc_id`` and its text count as one document from stage 3 on.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficlens.llm.language_id import UNDETERMINED, learn, predictor
from trafficlens.llm.ngram_join import ngram_join, possibly_among
from trafficlens.llm.packing import best_fit_packing
from trafficlens.llm.quality_rules import kept_rows
from trafficlens.llm.tables import Scratch

# One of four languages scores 0.25 by chance.
MIN_LANGUAGE_SCORE = 0.35


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = "__language"
    apply = predictor(spark, learn(docs))
    return (docs.withColumn(found, apply("text"))
            .where((F.col(found)["lang_pred"] != UNDETERMINED) & (F.col(found)["score"] >= MIN_LANGUAGE_SCORE))
            .select(*docs.columns))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return kept_rows(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Only rows that may be listed (as a copy that goes, or as a repeated id) are
    joined with the lists; all others pass without a shuffle of their text."""
    groups = ngram_join(docs).where(F.col("doc_id").isNotNull())
    repeated = groups.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("doc_id")
    gone = groups.where(F.col("doc_id") != F.col("component_id")).select("doc_id")
    listed = possibly_among(gone.unionByName(repeated), "doc_id")
    kept = docs.where(listed).join(gone, "doc_id", "left_anti")
    once = kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return reduce(DataFrame.unionByName, [
        part.select(*docs.columns) for part in (docs.where(~listed), kept.join(repeated, "doc_id", "left_anti"), once)])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return best_fit_packing(docs)


STAGES = [
    ("language_id", language),
    ("quality_rules", quality),
    ("ngram_join", near_duplicates),
    ("best_fit_packing", packing),
]

# The language model is no SQL; tests/llm/test_pipeline.py holds the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return scratch.result(STAGES[-1][1](spark, docs, sf_dir))
