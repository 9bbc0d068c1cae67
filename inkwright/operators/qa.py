"""Checks of a finished data set: pairing, distributions, pairs of confusable characters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from inkwright.functions.text import chars
from inkwright.store import written


def pairing(disk: DataFrame, metadata: DataFrame, labels: DataFrame) -> DataFrame:
    """(file, on_disk, in_metadata, in_labels, mismatch) of files that are not in all three, or whose texts differ."""
    rows = disk.select("file", F.lit(True).alias("d")).distinct()
    rows = rows.join(metadata.select("file", F.col("text").alias("mt"), F.lit(True).alias("m")), "file", "full_outer")
    rows = rows.join(labels.select("file", F.col("text").alias("lt"), F.lit(True).alias("l")), "file", "full_outer")
    has = lambda c: F.coalesce(F.col(c), F.lit(False))
    differs = has("m") & has("l") & ~F.col("mt").eqNullSafe(F.col("lt"))
    rows = rows.select("file", has("d").alias("on_disk"), has("m").alias("in_metadata"), has("l").alias("in_labels"), differs.alias("mismatch"))
    return rows.where("not (on_disk and in_metadata and in_labels) or mismatch")


def symmetric_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """(key, side): keys that only a ("left") or only b ("right") has."""
    x, y = a.select(key).distinct().withColumn("x", F.lit(1)), b.select(key).distinct().withColumn("y", F.lit(1))
    rows = x.join(y, key, "full_outer").where("x is null or y is null")
    return rows.select(key, F.when(F.col("y").isNull(), "left").otherwise("right").alias("side"))


def distribution(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(field, value, n, share) of each column, null and empty values left out."""
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns)))
    counts = rows.select(pairs.alias("p")).select("p.*").where("value is not null and value <> ''").groupBy("field", "value").agg(F.count("*").alias("n"))
    totals = counts.groupBy("field").agg(F.sum("n").alias("total"))
    return counts.join(totals, "field").select("field", "value", "n", (F.col("n") / F.col("total")).alias("share"))


def extremes(rows: DataFrame, key: str) -> DataFrame:
    """(keys, most, least): how many keys there are, and the greatest and least number of rows of one."""
    return rows.groupBy(key).agg(F.count("*").alias("n")).agg(F.count("*").alias("keys"), F.max("n").alias("most"), F.min("n").alias("least"))


def document_frequency(rows: DataFrame, text: str = "text", rare: int = 3) -> DataFrame:
    """(ch, n, rare): rows that hold each character."""
    n = rows.select(F.explode(F.array_distinct(chars(F.col(text)))).alias("ch")).groupBy("ch").agg(F.count("*").alias("n"))
    return n.withColumn("rare", F.col("n") < rare)


def weak_pairs(pairs: DataFrame, rows: DataFrame, text: str = "text", least: int = 3) -> DataFrame:
    """(target, confusable, n_target, n_confusable) of pairs of which either side has fewer rows than least."""
    n = rows.groupBy(F.col(text).alias("t")).agg(F.count("*").alias("n"))
    a, b = n.select(F.col("t").alias("target"), F.col("n").alias("n_target")), n.select(F.col("t").alias("confusable"), F.col("n").alias("n_confusable"))
    out = pairs.select("target", "confusable").join(a, "target", "left").join(b, "confusable", "left").fillna(0, ["n_target", "n_confusable"])
    return out.where(F.least("n_target", "n_confusable") < least).select("target", "confusable", "n_target", "n_confusable")


def exact_quantiles(rows: DataFrame, column: Column, shares: dict[str, float], by: list[str] | None = None) -> DataFrame:
    """(by..., a column for each of shares): exact quantiles, between two values in proportion; null values don't count, none: null.

    Values are counted, cut into ranges and ranked in each, and ranges are told the number of values before them; so a group of
    all rows is neither held in memory nor sorted by one task.
    """
    by = by or []
    counts = rows.select(*by, column.alias("_v")).groupBy(*by, "_v").agg(F.count("_v").alias("_n"))
    ranged = written(counts.repartitionByRange(*by, "_v").withColumn("_part", F.spark_partition_id()), "ranges")
    # a row for each group in each range
    parts = ranged.groupBy(*by, "_part").agg(F.sum("_n").alias("_in"))
    before = F.sum("_in").over(Window.partitionBy(*by).orderBy("_part")) - F.col("_in")
    parts = parts.select(*(F.col(c).alias(f"_{c}") for c in by), F.col("_part").alias("_at"), before.alias("_before"), F.sum("_in").over(Window.partitionBy(*by)).alias("_all"))
    same = F.col("_part") == F.col("_at")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    upto = F.col("_before") + F.sum("_n").over(Window.partitionBy("_part", *by).orderBy("_v"))
    ranked = ranged.join(parts, same).withColumn("_upto", upto)
    out = {}
    for name, share in shares.items():
        place = F.lit(share) * (F.col("_all") - 1)
        out[f"{name}_lo"] = F.min(F.when(F.col("_upto") > F.floor(place), F.col("_v")))
        out[f"{name}_hi"] = F.min(F.when(F.col("_upto") > F.ceil(place), F.col("_v")))
        out[f"{name}_of"] = F.max(place - F.floor(place))
    found = ranked.groupBy(*by).agg(*(c.alias(k) for k, c in out.items()))
    return found.select(*by, *((F.col(f"{k}_lo") + (F.col(f"{k}_hi") - F.col(f"{k}_lo")) * F.col(f"{k}_of")).alias(k) for k in shares))


def quantiles(rows: DataFrame, column: Column, by: list[str] | None = None) -> DataFrame:
    """(by..., median, p01, least)"""
    return exact_quantiles(rows, column.cast("double"), {"median": 0.5, "p01": 0.01, "least": 0.0}, by)


def size_faults(rows: DataFrame, height: int = 48, widths: tuple[int, int] = (8, 20000)) -> DataFrame:
    return rows.where((F.col("height") != height) | ~F.col("width").between(*widths))


def gate(ink: Column, contrast: Column, least_ink: float = 0.004, least_contrast: float = 45.0) -> Column:
    """The first gate that fails, or null."""
    return F.when(ink < least_ink, "ink").when(contrast < least_contrast, "contrast")


def hash_order(seed: str, *columns: str) -> Column:
    """A key to shuffle by: SHA-256 of the seed and the columns, the same in any partitioning."""
    return F.sha2(F.concat_ws("|", F.lit(seed), *(F.col(c).cast("string") for c in columns)), 256)


def sample_exactly(rows: DataFrame, n: int, seed: str, *keys: str) -> DataFrame:
    """n rows of least hash."""
    return rows.orderBy(hash_order(seed, *keys), *keys).limit(n)


def total_bytes(rows: DataFrame, content: str) -> DataFrame:
    """(files, bytes) of a column of texts or bytes; null ones are files of no bytes."""
    return rows.agg(F.count("*").alias("files"), F.coalesce(F.sum(F.octet_length(content)), F.lit(0)).cast("long").alias("bytes"))


#: What keeps a data set from being published; anything else that is found only warns.
FATAL = ("pairing", "unreadable", "glyphs")


def findings(pairs_: DataFrame, images: DataFrame, measures: DataFrame, glyphs: DataFrame | None, weak: DataFrame | None) -> DataFrame:
    """(check, fatal, n, example): faults of each check and the first of them by name; checks without faults have no row.

    pairs_: of pairing. images: (file, height, width, error). measures: (file, ink_ratio, contrast). glyphs: (file,
    missing). weak: of weak_pairs. Empty frames and None add nothing.
    """
    parts = [
        pairs_.select(F.lit("pairing").alias("check"), F.col("file").alias("what")),
        images.where("error is not null").select(F.lit("unreadable"), "file"),
        size_faults(images.where("error is null")).select(F.lit("size"), "file"),
        measures.withColumn("g", gate(F.col("ink_ratio"), F.col("contrast"))).where("g is not null").select("g", "file"),
    ]
    if glyphs is not None:
        parts.append(glyphs.where("missing <> ''").select(F.lit("glyphs"), "file"))
    if weak is not None:
        parts.append(weak.select(F.lit("weak pairs"), F.concat_ws("/", "target", "confusable")))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.groupBy("check").agg(F.count("*").alias("n"), F.min("what").alias("example")).select("check", F.col("check").isin(*FATAL).alias("fatal"), "n", "example")
