"""A training-data pipeline over documents: each stage works on what the one before it kept.

Order: toxicity, near duplicates, secrets, packing. Every stage takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read again as the next one's docs; all but the last
return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwright.llm import toxicity
from inkwright.llm.jaccard import BROADCAST_IDS, class_of_rows
from inkwright.llm.packing import pack
from inkwright.llm.secrets import redact
from inkwright.llm.store import written

#: The stages call operators that SQL cannot express.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5; the model is fitted on labelled documents among docs."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.fit(docs, labels), 0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group linked by Jaccard of 0.8 or more on shingles of five words: of least doc_id, then of least text hash.

    Rows are documents of their own, also where they share an id. Rows without shingles or doc_id are all kept;
    of rows with one id and equal texts any one is.
    """
    rows = written(class_of_rows(docs, k=5, num=80, den=100), "rows").where("class is not null")
    least = rows.where("doc_id = component_id").groupBy("class").agg(F.min("text_hash").alias("keeper"), F.count("*").alias("times"))
    # classes whose least id has several rows; there are none where ids are keys
    several = written(least.where("times > 1").drop("times"), "several")
    found = rows.where("doc_id <> component_id")
    if not several.isEmpty():
        found = found.unionByName(rows.where("doc_id = component_id").join(several, "class").where("text_hash <> keeper").drop("keeper"))
    gone = written(found.select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash")).distinct(), "gone")

    def of(found: DataFrame, how: str, rows: DataFrame) -> DataFrame:
        found = F.broadcast(found) if found.count() <= BROADCAST_IDS else found
        return rows.join(found, (docs["doc_id"].cast("long") == found["gone_id"]) & (F.xxhash64(docs["text"]) == found["gone_hash"]), how)

    kept = of(gone, "left_anti", docs)
    if several.isEmpty():
        return kept
    again = rows.where("doc_id = component_id").join(several, "class").where("text_hash = keeper")
    again = written(again.select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash")).distinct(), "again")
    return of(again, "left_anti", kept).unionByName(of(again, "left_semi", kept).dropDuplicates(["doc_id", "text"]))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with each span of a secret replaced by [secret] and n_chars counted anew."""
    out = redact(docs)
    return out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), size=2048, end_id=0)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("secret_scan", redact_secrets),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
