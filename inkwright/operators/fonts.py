"""Coverage of texts by fonts, over the long table (font_key, family, cp) of code points."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwright.functions.text import chars, font_key, stem
from inkwright.sources import sfnt


def code_points(texts: DataFrame, text: str = "text") -> DataFrame:
    """(text, cp) of the different characters of each text."""
    return texts.select(text).distinct().select(text, F.explode(F.array_distinct(F.transform(chars(F.col(text)), F.ascii))).alias("cp"))


def covering(texts: DataFrame, cmap: DataFrame, text: str = "text") -> DataFrame:
    """(text, font_key) where the font has every character: an equi-join on code points and a count, no pairs tried."""
    need = code_points(texts, text)
    total = need.groupBy(text).agg(F.count("*").alias("need"))
    have = need.join(cmap.select("font_key", "cp").distinct(), "cp").groupBy(text, "font_key").agg(F.count("*").alias("have"))
    return have.join(total, text).where("have = need").select(text, "font_key")


def unrenderable(texts: DataFrame, cmap: DataFrame, text: str = "text") -> DataFrame:
    """Texts that no font covers."""
    return texts.select(text).distinct().join(covering(texts, cmap, text), text, "left_anti")


def missing(rows: DataFrame, fonts: DataFrame, text: str = "text", key: str = "font_key") -> DataFrame:
    """rows of known fonts, fonts being (font_key, cmap array<int>), with the characters that are missing, in order, repeats kept.

    Each text's different characters meet the fonts' code points in an anti-join; no cmap is searched. Null texts miss nothing.
    """
    known = fonts.select(key).distinct()
    points = fonts.select(F.col(key).alias("_font"), F.explode("cmap").alias("_cp")).distinct()
    used = rows.join(known, key, "left_semi").select(F.col(text).alias("_text"), F.col(key).alias("_font")).distinct()
    used = used.select("_text", "_font", F.explode(F.array_distinct(chars(F.col("_text")))).alias("_ch")).withColumn("_cp", F.ascii("_ch"))
    lost = used.join(points, ["_font", "_cp"], "left_anti").groupBy("_text", "_font").agg(F.collect_list("_ch").alias("_lost"))
    out = rows.join(known, key, "left_semi").join(lost, (F.col(text) == F.col("_text")) & (F.col(key) == F.col("_font")), "left")
    named = F.array_join(F.filter(chars(F.col(text)), lambda c: F.array_contains(F.col("_lost"), c)), "")
    return out.withColumn("missing", F.coalesce(named, F.lit(""))).drop("_text", "_font", "_lost")


def probe_coverage(cmap: DataFrame, probe: list[int], by: str = "font_key") -> DataFrame:
    """(by, coverage): the share of the probe's code points that each font has."""
    hit = F.count_distinct(F.when(F.col("cp").isin(probe), F.col("cp")))
    return cmap.groupBy(by).agg((hit / F.lit(max(1, len(probe)))).alias("coverage"))


def usable(coverage: DataFrame, least: float = 0.5) -> DataFrame:
    return coverage.where(F.col("coverage") >= least)


def ranked(fonts: DataFrame) -> DataFrame:
    """Fonts by extended coverage, then basic coverage, then key."""
    return fonts.orderBy(F.desc("coverage_ext"), F.desc("coverage_bmp"), "font_key")


def expand_weights(fonts: DataFrame, weights: list[int], lo: str = "axis_lo", hi: str = "axis_hi") -> DataFrame:
    """A row per weight within the axis, or one of null."""
    fit = F.filter(F.array(*map(F.lit, weights)), lambda w: w.between(F.col(lo), F.col(hi)))
    fit = F.when(F.size(fit) > 0, fit).otherwise(F.array(F.lit(None).cast("int")))
    return fonts.withColumn("variation", F.explode(fit))


def report(fonts: DataFrame) -> DataFrame:
    """One row: files, instances, usable, fully extended, sorted families."""
    return fonts.agg(
        F.count_distinct("path").alias("files"),
        F.count("*").alias("instances"),
        F.count_if(F.col("coverage_bmp") >= 0.5).alias("usable"),
        F.count_if(F.col("coverage_ext") >= 0.99).alias("full_ext"),
        F.array_sort(F.collect_set("family")).alias("families"),
    )


def candidates(files: DataFrame, whitelist: list[str]) -> DataFrame:
    """files (path, own, ...) of font kinds that are one's own or whose plain name holds a part of the whitelist, each path once; null paths go."""
    name = F.element_at(F.split("path", "/"), -1)
    listed = F.lit(False)
    for part in whitelist:
        listed = listed | F.contains(stem(name), F.lit(part))
    rows = files.where(F.lower(name).rlike(r"\.(ttf|otf|ttc|otc)$") & (F.coalesce("own", F.lit(False)) | listed))
    return rows.groupBy("path").agg(*(F.max(c).alias(c) for c in files.columns if c != "path"))


FACES = "path string, face int, cps array<int>, axis_lo double, axis_hi double, error string"


def faces(files: DataFrame) -> DataFrame:
    """FACES rows of (path, content): one for each face of a file; unreadable files have an error instead, null and empty ones too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.string(), pa.int32(), pa.list_(pa.int32()), pa.float64(), pa.float64(), pa.string())
        for batch in batches:
            # file by file, as a font may be tens of megabytes
            for path, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                try:
                    found = [(path, n, cps, *(axis or (None, None)), None) for n, cps, axis in sfnt.faces(data.as_py() or b"")]
                except Exception as e:  # whatever a broken file makes of the parser
                    found = [(path, None, None, None, None, f"{type(e).__name__}: {e}")]
                columns = zip(*found, strict=True) if found else [[]] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [f.split()[0] for f in FACES.split(", ")])

    return files.select("path", "content").mapInArrow(run, FACES)


def catalogue(faces_: DataFrame, weights: list[int], probe_bmp: list[int], probe_ext: list[int]) -> DataFrame:
    """(font_key, family, path, face, variation, cps, n_glyphs, coverage_bmp, coverage_ext): an instance for each weight within a face's axis, else one."""
    rows = expand_weights(faces_.where("error is null"), weights)
    family = F.regexp_extract("path", r"([^/]*?)(?:\.[^./]*)?$", 1)
    share = lambda probe: F.size(F.array_intersect("cps", F.array(*map(F.lit, probe)))) / F.lit(max(1, len(set(probe))))
    return rows.select(
        font_key(family, F.col("face"), F.col("variation")).alias("font_key"), family.alias("family"), "path", "face", "variation", "cps",
        F.size("cps").alias("n_glyphs"), share(probe_bmp).alias("coverage_bmp"), share(probe_ext).alias("coverage_ext"),
    )


def for_plan(plan: DataFrame, fonts: DataFrame, key: str = "font_key") -> DataFrame:
    """plan rows with their font's columns, and an error where there is no such font. fonts is unique by key."""
    rows = plan.join(fonts.withColumn("_known", F.lit(True)), key, "left")
    return rows.withColumn("error", F.when(F.col("_known").isNull(), F.concat(F.lit("no font "), F.coalesce(key, F.lit("null"))))).drop("_known")
