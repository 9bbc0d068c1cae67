"""Stratified plans with budgets, coverage and balance; every draw is a hash of keys, so no partitioning changes a plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from inkwright.operators.qa import hash_order
from inkwright.store import written

#: Shares of difficulties, in the order they are drawn.
DIFFICULTIES = (("clean", 0.25), ("light", 0.35), ("medium", 0.25), ("hard", 0.15))
TIERS = {"char": 1200, "word": 1800, "sentence": 2000}
RENDERS = 3


def unit(seed: str, *columns: str) -> Column:
    """A number in [0, 1) from the first 52 bits of a hash."""
    return F.conv(F.substring(hash_order(seed, *columns), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def draw(u: Column, weights: tuple[tuple[str, float], ...] = DIFFICULTIES) -> Column:
    """The category whose cumulative share u falls under."""
    out, total = None, 0.0
    for name, share in weights[:-1]:
        total = round(total + share, 12)
        out = F.when(u < total, name) if out is None else out.when(u < total, name)
    return out.otherwise(weights[-1][0]) if out is not None else F.lit(weights[-1][0])


def scaled(sizes: dict[str, int], total: int) -> dict[str, int]:
    """sizes in proportion to total, at least one each, halves to even."""
    whole = sum(sizes.values())
    return {k: max(1, round(v * total / whole)) for k, v in sizes.items()}


def round_robin(rows: DataFrame, of: list[str], group: list[str], seed: str, keys: list[str], n: int) -> DataFrame:
    """At most n rows of each `of`, in rounds that take one row of every group; rows in a group and groups in a round by hash."""
    w = Window.partitionBy(*of, *group).orderBy(hash_order(seed, *keys), *keys)
    # a row of a later round than n is behind n others, so it needn't meet the window over all groups
    rows = rows.withColumn("turn", F.row_number().over(w)).where(F.col("turn") <= n)
    turns = Window.partitionBy(*of) if of else Window.partitionBy()
    pick = F.row_number().over(turns.orderBy("turn", hash_order(seed, *group), *group))
    return rows.withColumn("pick", pick).where(F.col("pick") <= n)


def buckets_in_turn(rows: DataFrame, buckets: list[str], seed: str, keys: list[str], n: int) -> DataFrame:
    """n rows (fewer if there are no more) with turn: rounds that take one row of every bucket in the buckets' own order, by hash within one."""
    w = Window.partitionBy(*buckets).orderBy(hash_order(seed, *keys), *keys)
    rows = rows.withColumn("turn", F.row_number().over(w)).where(F.col("turn") <= n)
    return rows.orderBy("turn", *buckets).limit(n)


def with_difficulty(rows: DataFrame, seed: str, *keys: str) -> DataFrame:
    """rows with a difficulty drawn by hash where they have none."""
    drawn = draw(unit(seed, *keys))
    return rows.withColumn("difficulty", F.coalesce("difficulty", drawn) if "difficulty" in rows.columns else drawn)


def fill_budget(rows: DataFrame, size: str, budget: int, order: list[Column], by: list[str] | None = None) -> DataFrame:
    """Items in order while those before them hold fewer than budget rows; size is an item's number of rows.

    Items are cut to the first `budget` of the order before the running sum, which can only need so many
    items of a row or more each; so the window holds budget rows of each group at most.
    """
    if by:
        w = Window.partitionBy(*by).orderBy(*order)
        rows = rows.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= budget).drop("_rn")
    else:
        w = Window.partitionBy().orderBy(*order)
        rows = rows.where(F.col(size) > 0).orderBy(*order).limit(budget)
    before = F.coalesce(F.sum(size).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("before", before).where(F.col("before") < budget)


def dealt(rows: DataFrame, key: str, each: int = 500_000) -> DataFrame:
    """rows dealt by key to tasks of about `each` rows, a number that grows with them: adaptive execution joins tasks by their packed
    bytes, and small rows are few of these. Aggregates and windows of the same key stay in these tasks."""
    n = max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // each))
    return rows.repartition(n, key)


def uniform(items: DataFrame, fonts: DataFrame, key: str, family: str, font: str, budget: int, n_items: int, seed: str) -> DataFrame:
    """Each of n_items items in max(1, budget // n_items) fonts of those that cover it, families in turn.

    fonts: (key, font, family) of the fonts that cover each item.
    """
    per = max(1, budget // max(1, n_items))
    return round_robin(items.join(fonts, key), [key], [family], seed, [key, font], per)


def dense_index(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows with idx, from 0 in order: ranks within ranges, then counts of the ranges before; no window over all rows.

    Ranges are drawn from samples, so the rows are written with their range before they are counted and ranked.
    """
    ranged = written(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranges")
    inner = ranged.withColumn("_rn", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    counts = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    counts = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    out = inner.join(F.broadcast(counts), "_part")  # one row per partition
    return out.withColumn("idx", F.col("_before") + F.col("_rn") - 1).drop("_part", "_rn", "_before")


def staged_pick(rows: DataFrame, stages: list[tuple[Column, list[str], int, list[Column]]], key: str) -> DataFrame:
    """The first k rows of each group of each stage (condition, group, k, order), without rows of stages before; with the stage's number.

    A stage's picks, k rows of each group, are written, so that the stages after it don't make them again.
    """
    out, left = None, rows
    for number, (condition, group, k, order) in enumerate(stages):
        w = Window.partitionBy(*group).orderBy(*order, key)
        took = left.where(condition).withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn").withColumn("stage", F.lit(number))
        took = written(took, "picked")
        out = took if out is None else out.unionByName(took)
        left = left.join(took.select(key), key, "left_anti")
    return out


def tiers_in_order(**tiers: DataFrame) -> DataFrame:
    """All tiers' rows with tier and tier_ord."""
    out = None
    for i, (name, rows) in enumerate(tiers.items()):
        rows = rows.withColumns({"tier": F.lit(name), "tier_ord": F.lit(i)})
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out
