"""Corpus pipeline: from documents to packed token sequences.

``STAGES`` lists (name, function) pairs; a function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame, which is written as Parquet and read again
as the next one's ``docs``. All but the last return the columns of documents.

1. quality rules: documents that the base rules or the learned list reject go;
2. line dedup: lines of templates that recur across documents are taken out
   (a document left without a word goes);
3. n-gram Jaccard join: one row of each group of near copies stays, the one
   with the smallest ``doc_id`` (null last; any one of several such rows);
4. benchmark decontamination: documents with a benchmark passage go;
5. packing: token ids of what is left, packed into sequences.

The stages use learned rules, hashes of sets and a tokenizer, so SQL cannot
express them; tests compare each operator with a brute-force version, and check
here that every stage works on what its predecessor kept.

Defined results for odd input: rows with a null or repeated ``doc_id`` are rows
of their own in every stage (line dedup treats rows that repeat both id and text
alike); null and empty texts fail the base rules and go; extra columns are kept
until packing, except that ``__row`` and ``__group`` are names of the Jaccard
stage; an empty table gives no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpipulse.llm import decontaminate, jaccard, lines, packing, quality
from kpipulse.llm.store import stored

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    rules = quality.learn_rules(docs, labels)
    return quality.judge(docs, rules).filter("kept").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    left = lines.drop_template_lines(docs, keep_emptied=False)
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars")))
    return left.select(*docs.columns)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # rows are numbered and stored: ids may repeat or be null
    rows = stored(docs.withColumn("__row", F.monotonically_increasing_id()), "jaccard-rows")
    classes = jaccard.similar_classes(rows.select(F.col("__row").alias("doc_id"), "text"))
    group = classes.select(F.col("doc_id").alias("__row"), F.col("component_id").alias("__group"))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__row")
    stay = rows.select("doc_id", "__row").join(group, "__row").groupBy("__group").agg(F.min(place)["__row"].alias("__row"))
    return rows.join(stay.select("__row"), "__row", "left_semi").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return decontaminate.remove_contaminated(docs, benchmark)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs.select("doc_id", "text"), TOKENIZER)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each stored and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
