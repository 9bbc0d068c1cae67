"""The queries opN_<name> over the driver's tables, each by its operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from inkwright.llm.toxicity import fit, score

    # a null doc_id has no remainder, so it is held out of nothing
    docs, fold = table(spark, sf_dir, "documents"), F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5, F.lit(-1))
    scores = score(docs, fit(docs, table(spark, sf_dir, "labels"), fold != 0))
    return scores.select("doc_id", (fold == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from inkwright.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), size=2048, end_id=0)


def op3_token_id_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from inkwright.llm.tokens import orc_digests

    return orc_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from inkwright.llm.tokens import bpe_digests

    return bpe_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from inkwright.llm.vectors import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"), 0.95)


#: Rules of the url filter: host and path, and what they say.
URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from inkwright.llm.urls import filter_urls

    return filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from inkwright.llm.vectors import nearest

    return nearest(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0", k=20)


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from inkwright.llm.jaccard import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"), k=3, num=90, den=100)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from inkwright.llm.secrets import secret_digests

    return secret_digests(table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files /source/lang/doc_id; those whose whole text is much like a license's text or notice are licence files."""
    from inkwright.llm.licenses import scan

    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", F.lit(""), "source", "lang", F.col("doc_id").cast("string"))
    return scan(docs.select("doc_id", path.alias("path"), "text"), whole=True)


def queries() -> dict:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    """SQL where it can express the query: op1 and op9 fit models, op2 to op4 call libraries, op5 and op7 search by hashes and trees, op10 has whole texts as constants."""
    from inkwright.llm.jaccard import components_sql
    from inkwright.llm.urls import filter_sql

    return {"op6_url_filter": filter_sql(URL_RULES), "op8_ngram_jaccard_join": components_sql(3, 90, 100)}
