"""The corpus pipeline: five stages over ``documents``, each written as Parquet
and read again as the next one's input.

language ID (documents in no known language go) -> line dedup (lines that stand
in ten documents or more go from all of them) -> n-gram Jaccard join (one document
of each group of near duplicates stays) -> benchmark decontamination (documents
that hold a benchmark item go) -> best-fit packing (all that is left, in
sequences of 4096 tokens).

Defined cases: null and empty texts go in the first stage, as no language is found in
them; rows with one doc_id and text but other languages or sources are judged one by
one; of rows that share a doc_id the first by text hash stays in the third stage, and of near
copies the one with the smallest doc_id (with null ids alone: the smallest text hash);
texts are processed whole, whatever their length; further columns pass all stages but
the last, whatever their names; an empty table has no rows at the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellar.llm import common, decontaminate, jaccard_join, language, line_dedup, packing


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_identified(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(docs, min_docs=10).withColumn("text", F.col("kept_text"))
    return out.select(*[
        F.col(x) if x in ("doc_id", "text")
        else F.length("text").cast(docs.schema[x].dataType).alias(x) if x == "n_chars"
        else F.col("rest").getField(x).alias(x) for x in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one_of_each(docs, shingle=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, decontaminate.benchmark(spark, sf_dir))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.cut_pieces(docs, packing.default_tokenizer()))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", best_fit_packing),
]

#: Near duplicates, learned languages and tokens are beyond SQL; the tests
#: compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
