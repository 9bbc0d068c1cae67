"""Character sets by frequency differencing and set algebra."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwright.functions.text import code_point, plane


def union_lists(lists: DataFrame, *names: str) -> DataFrame:
    """(ch) in any of the named lists of (list_name, ch)."""
    return lists.where(F.col("list_name").isin(*names)).select("ch").distinct()


def without(a: DataFrame, *others: DataFrame) -> DataFrame:
    for b in others:
        a = a.join(b, "ch", "left_anti")
    return a


def exclusions(built_in: DataFrame, own: DataFrame) -> DataFrame:
    """(ch) of the built-in exclusions and one's own."""
    return built_in.select("ch").union(own.select("ch")).distinct()


def funnel_reason(freq: DataFrame, standard: DataFrame, foreign: DataFrame, excluded: DataFrame, min_freq: int) -> DataFrame:
    """freq with reason, the first that holds: low_freq, standard, foreign, excluded, else kept."""
    rows = freq
    for name, members in (("standard", standard), ("foreign", foreign), ("excluded", excluded)):
        rows = rows.join(members.select("ch", F.lit(True).alias(f"_{name}")), "ch", "left")
    reason = F.when(F.col("freq") < min_freq, "low_freq")
    for name in ("standard", "foreign", "excluded"):
        reason = reason.when(F.col(f"_{name}"), name)
    return rows.select("ch", "freq", reason.otherwise("kept").alias("reason"))


def funnel(reasons: DataFrame) -> DataFrame:
    return reasons.groupBy("reason").agg(F.count("*").alias("n"))


def derive(freq: DataFrame, standard: DataFrame, foreign: DataFrame, excluded: DataFrame, forced: DataFrame, min_freq: int) -> DataFrame:
    """(ch, freq, plane, source): what the funnel kept, tagged diff, and the forced (ch, ord, tag) rows but excluded ones.

    Tags are joined by + in ascending ord, diff first; forced characters that weren't seen have freq 0.
    """
    kept = funnel_reason(freq, standard, foreign, excluded, min_freq).where("reason = 'kept'").select("ch", F.lit(0).alias("ord"), F.lit("diff").alias("tag"))
    tags = kept.unionByName(without(forced.select("ch", F.col("ord").cast("int").alias("ord"), "tag"), excluded)).distinct()
    tags = tags.groupBy("ch").agg(F.array_sort(F.collect_list(F.struct("ord", "tag"))).alias("t"))
    out = tags.join(freq, "ch", "left")
    source = F.array_join(F.transform("t", lambda x: x["tag"]), "+")
    return out.select("ch", F.coalesce("freq", F.lit(0)).cast("long").alias("freq"), plane(F.col("ch")).alias("plane"), source.alias("source"))


def sizes(charset: DataFrame, by: str) -> DataFrame:
    return charset.groupBy(by).agg(F.count("*").alias("n"))


def overlap(charset: DataFrame, other: DataFrame) -> DataFrame:
    return charset.select("ch").intersect(other.select("ch")).agg(F.count("*").alias("n"))


def review(charset: DataFrame, examples: DataFrame) -> DataFrame:
    """(ch, codepoint, freq, plane, source, example), most frequent first, then by character."""
    rows = charset.join(examples.withColumnRenamed("key", "ch"), "ch", "left")
    rows = rows.select("ch", code_point(F.col("ch")).alias("codepoint"), "freq", "plane", "source", F.coalesce("example", F.lit("")).alias("example"))
    return rows.orderBy(F.desc("freq"), "ch")
