"""Answers of recognition models: unwrapping, normalising and scoring, all as Columns but for NFKC."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from inkwright.functions.text import chars

#: Tags, lead-in phrases and edge characters that answers are stripped of.
TAGS = ("div", "p", "span", "br", "b", "i", "em", "strong", "html", "body")
LEADS = (
    "圖片中的文字[是為:：]?",
    "文字內容[是為:：]?",
    "辨識結果[是為:：]?",
    "答案[是為:：]?",
    "輸出[:：]?",
    "結果[:：]?",
    "The text (?:is|reads)[:：]?",
    "Text[:：]?",
)
QUOTES = "「」『』\"'`　 "


def strip_thinking(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)<think>.*?</think>", "")


def strip_fences(c: Column) -> Column:
    return F.regexp_replace(c, r"```[a-zA-Z]*\n?|```", "")


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, rf"(?i)</?(?:{'|'.join(TAGS)})\s*/?>", "")


def strip_space(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def unwrap_json(c: Column) -> Column:
    """Of a JSON list the texts of its strings and objects, of an object its text; anything else as it is.

    An object's text is its member text, else content. Other members of a list are left out.
    """
    v = F.try_parse_json(c)
    text = lambda x: F.coalesce(F.try_variant_get(x, "$.text", "string"), F.try_variant_get(x, "$.content", "string"))
    kind = lambda x: F.schema_of_variant(x)
    items = F.try_variant_get(v, "$", "array<variant>")
    joined = F.array_join(
        F.transform(items, lambda x: F.when(kind(x) == "STRING", F.try_variant_get(x, "$", "string")).when(kind(x).startswith("OBJECT"), F.coalesce(text(x), F.lit(""))).otherwise("")), ""
    )
    return (
        F.when(v.isNull() | ~c.rlike(r"^[\[{]"), c)
        .when(kind(v).startswith("ARRAY"), joined)
        .when(kind(v).startswith("OBJECT"), F.coalesce(text(v), c))
        .otherwise(c)
    )


def strip_lead(c: Column) -> Column:
    return F.regexp_replace(c, rf"(?i)^(?:{'|'.join(LEADS)})\s*", "")


def join_lines(c: Column) -> Column:
    lines = F.transform(F.split(c, r"\R", -1), strip_space)
    return F.array_join(F.filter(lines, lambda x: x != ""), "")


def postprocess(c: Column) -> Column:
    """The answer alone: reasoning, fences, tags, JSON, lead-ins, quotes and line breaks taken off in this order; null: empty."""
    c = strip_space(strip_tags(strip_fences(strip_thinking(F.coalesce(c, F.lit(""))))))
    c = F.when(c.rlike(r"^[\[{]"), unwrap_json(c)).otherwise(c)
    c = strip_space(strip_lead(strip_space(c)))
    return join_lines(F.btrim(c, F.lit(QUOTES)))


@F.pandas_udf(StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


def normalize(c: Column) -> Column:
    """NFKC without any white space; null: empty. Texts of Latin-1 letters and ASCII signs are their own NFKC and stay in the JVM."""
    c = F.coalesce(c, F.lit(""))
    own = c.rlike(r"^[\x00-\x7fÀ-ÿ]*$")
    # every row goes through Python, whatever branch it takes, so those that need no NFKC go as nulls
    return F.regexp_replace(F.when(own, c).otherwise(_nfkc(F.when(~own, c))), r"(?U)\s+", "")


def multiset_overlap(a: Column, b: Column) -> Column:
    """Sum over characters of the lesser of both counts; a count is what deleting the character takes off the length."""
    count = lambda c, ch: F.length(c) - F.length(F.replace(c, ch, F.lit("")))
    return F.aggregate(F.array_distinct(chars(a)), F.lit(0), lambda acc, ch: acc + F.least(count(a, ch), count(b, ch)))


def metrics(pred: Column, gt: Column) -> dict[str, Column]:
    """edit_distance, cer, cer_clipped, acc, ned_sim and f1 of normalised texts, unrounded.

    Of a text that stands whole in the other, as cut answers do, the distance is what is longer and the overlap the shorter text.
    """
    n, m = F.length(gt), F.length(pred)
    within = F.contains(gt, pred) | F.contains(pred, gt)
    d = F.when(within, F.abs(n - m)).otherwise(F.levenshtein(pred, gt))
    cer = d / F.greatest(F.lit(1), n)
    both = F.when(within, F.least(n, m)).otherwise(multiset_overlap(pred, gt))
    p, r = both / F.greatest(F.lit(1), m), both / F.greatest(F.lit(1), n)
    return {
        "edit_distance": d.cast("long"),
        "cer": cer,
        "cer_clipped": F.least(cer, F.lit(1.0)),
        "acc": (pred == gt).cast("double"),
        "ned_sim": 1 - d / F.greatest(F.lit(1), m, n),
        "f1": F.when(p + r == 0, 0.0).otherwise(2 * p * r / (p + r)),
    }
