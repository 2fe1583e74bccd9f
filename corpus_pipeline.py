"""The corpus pipeline: stages over the documents table, each written as Parquet and read again by the next.

Every stage works on all that the one before kept. All but the last return the columns of
``documents``; the last returns the pieces of packed sequences. Nulls, empty tables and
repeated rows follow the operators: a text without a letter has no language and goes; a
document with a null id can't be compared, so it stays; of rows that share an id, one stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from anemos.llm import jaccard, langid, packing, quality
from anemos.llm.queries import table, word_vocabulary
from anemos.session import settle


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of the highest grade reaches the limit, by a model fitted on rated ones."""
    model = quality.fit(docs, quality.grades(table(spark, sf_dir, "labels")))
    return docs.where(quality.rate_with(spark, model)("text")["selected"])


def clear_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found and not ambiguous."""
    found = langid.predict_with(spark, langid.fit(langid.learning_rows(docs)))(F.col("text"))
    return docs.where((found["lang"] != "und") & ~found["ambiguous"])


def free_name(docs: DataFrame, name: str) -> str:
    """The name, with as many underscores before it as make it differ from all columns."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of similar ones."""
    groups = jaccard.similar_documents(docs)
    first, copy = free_name(docs, "first"), free_name(docs, "copy")
    firsts = groups.where("doc_id = component_id").select(F.col("doc_id").alias(first)).distinct()
    kept = docs.join(firsts, F.col("doc_id") == F.col(first), "left_semi")
    same = Window.partitionBy("doc_id").orderBy(*(F.col(f"`{c}`") for c in docs.columns if c != "doc_id"))
    return kept.withColumn(copy, F.row_number().over(same)).where(F.col(copy) == 1).drop(copy).union(docs.where("doc_id IS NULL"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents as pieces of packed sequences."""
    return packing.pack(settle(packing.cut_documents(docs, word_vocabulary()), "pieces"))


STAGES = [("quality classifier", good_quality), ("language id", clear_language),
          ("n-gram jaccard join", one_of_similar), ("packing", packed)]

#: SQL can't state trained models or tokens; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
