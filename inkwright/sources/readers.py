"""Readers of the files a benchmark is made of."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from inkwright.functions.picture import pixels_of
from inkwright.functions.text import HAN, Preset, is_letter


def jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines by an explicit schema; blank lines give no rows."""
    return spark.read.text(path).where(F.trim("value") != "").select(F.from_json("value", schema).alias("r")).select("r.*")


def label_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, text) of the lines that hold a tab, cut at the first."""
    parts = F.split("value", "\t", 2)
    return spark.read.text(path).where(F.contains("value", F.lit("\t"))).select(parts[0].alias("file"), parts[1].alias("text"))


def eval_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """CSV with a header, quoted line breaks and doubled quotes."""
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    return (reader.schema(schema) if schema else reader).csv(path)


def json_document(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A JSON document; with a schema a missing file gives no rows."""
    if schema and not exists(spark, path):
        return spark.createDataFrame([], schema)
    return (spark.read.schema(schema) if schema else spark.read).option("multiLine", True).json(path)


def lexicon(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(word, romanisation, weight, ord) of dictionary files.

    What stands before a line of three dots is a header; blank lines and lines of # are skipped; a third
    column that ends in % is the weight, 0 if it is no number. Files are read whole, as their header
    needs; they are parsed apart and in the order of the list, files of one of its entries in that of their paths.
    """
    files = None
    for n, one in enumerate([path] if isinstance(path, str) else path):
        part = spark.read.text(one, wholetext=True).select(F.lit(n).alias("entry"), F.input_file_name().alias("f"), "value")
        files = part if files is None else files.unionByName(part)
    if files is None:
        return spark.createDataFrame([], "word string, romanisation string, weight double, ord long")
    body = F.regexp_replace("value", r"(?s)^.*?\n\.\.\.\n", "")
    rows = files.select("entry", "f", F.posexplode(F.split(body, r"\r?\n", -1)).alias("pos", "line")).where((F.trim("line") != "") & ~F.col("line").startswith("#"))
    cols = F.split("line", "\t", -1)
    third = F.get(cols, F.lit(2))
    weight = F.when(F.endswith(F.trim(third), F.lit("%")), F.coalesce(F.try_to_number(F.regexp_replace(F.trim(third), "%$", ""), F.lit("999999999.999999")).cast("double"), F.lit(0.0)))
    # one row per file
    order = files.select("entry", "f").distinct().select("entry", "f", F.dense_rank().over(Window.orderBy("entry", "f")).alias("n"))
    return rows.join(F.broadcast(order), ["entry", "f"]).select(
        cols[0].alias("word"), F.coalesce(F.get(cols, F.lit(1)), F.lit("")).alias("romanisation"), F.coalesce(weight, F.lit(0.0)).alias("weight"), (F.col("n").cast("long") * F.lit(1 << 40) + F.col("pos")).alias("ord")
    ).where("word <> ''")


def char_lines(spark: SparkSession, path: str, comments: str = "line", preset: Preset | None = HAN) -> DataFrame:
    """(ch): the letters of the preset's script (None: all characters) in a list; comments: "line" skips lines that start with #, "any" cuts at # anywhere."""
    line = F.trim("value") if comments == "line" else F.trim(F.split("value", "#", 2)[0])
    rows = spark.read.text(path).select(line.alias("line")).where((F.col("line") != "") & ~F.col("line").startswith("#"))
    rows = rows.select(F.explode(F.split("line", "")).alias("ch")).where("trim(ch) <> ''").distinct()
    return rows if preset is None else rows.where(is_letter(F.col("ch"), preset))


def listing(spark: SparkSession, path: str, pattern: str = "*.[jJ][pP][gG]") -> DataFrame:
    """(file, length) of the files of a folder that fit the pattern."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select(F.element_at(F.split("path", "/"), -1).alias("file"), "length")


def images_in(spark: SparkSession, path: str, pattern: str = "*.[pP][nN][gG]") -> DataFrame:
    """(file, length, height, width, channels, pixels, error) of the PNG files of a folder; unreadable ones have an error."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return rows.select(F.element_at(F.split("path", "/"), -1).alias("file"), "length", pixels_of(F.col("content")).alias("i")).select("file", "length", "i.*")


def font_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of the font files of a folder and the folders in it."""
    pattern = "*.{[tT][tT][fF],[oO][tT][fF],[tT][tT][cC],[oO][tT][cC]}"
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path).select("path", "content")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at path, in any file system that Spark knows."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
