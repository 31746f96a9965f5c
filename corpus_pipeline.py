"""The corpus pipeline: stages of the operators in ``meterflow.llm``, each written and read again.

A document is dropped if it is scored as toxic, if it is a near-duplicate of one that stays (of each
group the row with the smallest id stays, of rows that share it or have none one of them), or if it holds a benchmark item. In what is left personal data get surrogates, and the texts
are packed into sequences.
"""
from __future__ import annotations

from public_tokenizers import path
from pyspark.sql import DataFrame, SparkSession, functions as F

from meterflow.llm.decontamination import drop_contaminated
from meterflow.llm.jaccard import link_documents
from meterflow.llm.packing import pack_documents
from meterflow.llm.pii import replace_entities
from meterflow.llm.store import small_batches, step
from meterflow.llm.toxicity import held_out, keep_below, train

KEY = "a key of the session"


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that the classifier scores 0.5 or more. It is fitted on labelled documents of the table, leaving out
    the fold that the toxicity query holds out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out())
    model = train(docs, labels)
    return keep_below(docs, model)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones: the row with the least id, rows without an id last.

    Rows are told apart by a number that is written with them, so neither repeated ids nor missing ones matter. Rows without words are in no group.
    """
    key = "row"
    while key in docs.columns:
        key += "_"
    rows = step(docs.withColumn(key, F.monotonically_increasing_id()), "numbered")
    groups = step(link_documents(rows, key).select(F.col("doc_id").alias("_row"), "component_id"), "groups")
    named = groups.join(rows.select(F.col(key).alias("_row"), "doc_id"), "_row")
    first = named.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row"))["_row"].alias("_row"))
    return rows.join(first.select(F.col("_row").alias(key)), key, "left_semi").drop(key)


def not_in_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a benchmark item."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def with_surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced; ``n_chars`` is that of the new text."""
    replaced = replace_entities(docs, KEY)
    return replaced.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else replaced


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 2048 tokens."""
    with small_batches(spark):
        return step(pack_documents(docs, path("word_bpe_49k.json")), "packed")


STAGES = [
    ("toxicity", not_toxic),
    ("near_duplicates", one_of_each_group),
    ("benchmark", not_in_benchmark),
    ("personal_data", with_surrogates),
    ("packing", packed),
]

#: SQL has no classifier, SimHash, keyed surrogates or tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's rows written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = step(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
