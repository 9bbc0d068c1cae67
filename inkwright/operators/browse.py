"""Queries of a result browser: filters, sort orders, pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sort orders: column and whether it descends; ties and the default keep the input's order.
ORDERS = {
    "default": None,
    "cer_desc": ("cer_clipped", True),
    "cer_asc": ("cer_clipped", False),
    "acc_desc": ("acc", True),
    "acc_asc": ("acc", False),
    "len_desc": ("n_chars", True),
    "len_asc": ("n_chars", False),
}
PAGE = 60


def matching(rows: DataFrame, model: str = "all", tier: str = "all", difficulty: str = "all", correctness: str = "all", pair: str = "all", query: str = "") -> DataFrame:
    """Rows that fit every filter; "all" and the empty query let everything through. The query is a case-sensitive part of gt or prediction."""
    for column, value in (("model", model), ("tier", tier), ("difficulty", difficulty)):
        if value != "all":
            rows = rows.where(F.col(column) == value)
    if correctness != "all":
        rows = rows.where((F.col("acc") == 1) if correctness == "correct" else (F.col("acc") != 1))
    if pair == "pair":
        rows = rows.where(F.coalesce("minimal_pair_with", F.lit("")) != "")
    if query:
        rows = rows.where(F.contains(F.col("gt"), F.lit(query)) | F.contains(F.col("prediction"), F.lit(query)))
    return rows


def samples(rows: DataFrame, tier: str = "all", difficulty: str = "all", plane: str = "all") -> DataFrame:
    """Samples by tier, difficulty and plane; plane "ext" is both extension planes, "pair" rows with a pair."""
    rows = rows if tier == "all" else rows.where(F.col("tier") == tier)
    rows = rows if difficulty == "all" else rows.where(F.col("difficulty") == difficulty)
    if plane == "ext":
        return rows.where(F.col("plane").isin("ExtA", "ExtB+"))
    if plane == "pair":
        return rows.where("pair_with is not null")
    return rows if plane == "all" else rows.where(F.col("plane") == plane)


def ordered(rows: DataFrame, order: str, original: list[str]) -> list[Column]:
    if ORDERS[order] is None:
        return [F.col(c) for c in original]
    column, down = ORDERS[order]
    return [F.desc(column) if down else F.asc(column), *(F.col(c) for c in original)]


def page(rows: DataFrame, number: int, order: str, original: list[str], size: int = PAGE) -> DataFrame:
    """Page number, clamped to the pages there are, of rows in an order made total by the original one."""
    pages = max(1, -(-rows.count() // size))
    number = min(max(1, number), pages)
    return rows.orderBy(*ordered(rows, order, original)).offset((number - 1) * size).limit(size)


def card(rows: DataFrame, labels: tuple[str, str] = ("written %s", "spoken %s")) -> DataFrame:
    """rows with what a card shows: wide (sentences and texts of more than 8 characters), ok, ext (the extension plane, else null) and pair_label.

    labels are for the target and the confusable side of a pair, %s being the other side. Columns that rows lack count as null.
    """
    has = lambda c: F.col(c) if c in rows.columns else F.lit(None).cast("string")
    wide = (F.col("tier") == "sentence") | (F.col("n_chars") > 8)
    ext = F.when(has("plane").isin("ExtA", "ExtB+"), has("plane"))
    label = F.when(has("pair_role") == "target", labels[0]).when(has("pair_role") == "confusable", labels[1])
    ok = F.coalesce(has("acc").cast("double") == 1, F.lit(False))
    return rows.withColumns({"wide": wide, "ok": ok, "ext": ext, "pair_label": F.replace(label, F.lit("%s"), has("pair_with"))})


def markers(rows: DataFrame) -> DataFrame:
    """(ch): the characters to mark, those of single-character rows that are targets."""
    return rows.where("tier = 'char' and role = 'target'").select(F.col("text").alias("ch")).distinct()
