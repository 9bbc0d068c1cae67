"""Writers of labels, metadata, reports and exports."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwright.store import written


def label_lines(rows: DataFrame, path: str, order: str = "idx") -> None:
    """Lines of file, tab, text in order."""
    rows.orderBy(order).select(F.concat_ws("\t", "file", "text").alias("value")).write.text(path)


def metadata_lines(rows: DataFrame, path: str, drop: tuple[str, ...] = ("ok", "idx")) -> None:
    """JSON lines; null members are left out."""
    rows.drop(*drop).write.option("ignoreNullFields", True).json(path)


def packaged(rows: DataFrame, path: str, schema: dict[str, str], image: str | None = None, files: int | None = None) -> None:
    """Parquet with zstd by an explicit schema, so a column of nulls keeps its type; strings are never null.

    image names a column of files' bytes, which becomes a struct of bytes and path, the row's file. files: a set
    that one download holds goes to so many files (one, as a rule), larger ones to as many as there are tasks.
    """
    cols = [F.coalesce(F.col(c).cast(t), F.lit("")).alias(c) if t == "string" else F.col(c).cast(t).alias(c) for c, t in schema.items()]
    if image:
        cols.insert(0, F.struct(F.col(image).alias("bytes"), F.col("file").alias("path")).alias("image"))
    out = rows.select(*cols)
    (out.coalesce(files) if files else out).write.option("compression", "zstd").parquet(path)


def result_lines(rows: DataFrame, path: str) -> None:
    """CSV with a header; texts keep their line breaks, blanks and quotes."""
    rows.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def review_lines(rows: DataFrame, path: str) -> None:
    """Columns parted by tabs under a header, in one file, the most frequent first: a character set has no more rows than there are characters."""
    flat = [F.regexp_replace(F.col(c).cast("string"), r"[\t\r\n]", " ").alias(c) for c in rows.columns]
    rows.orderBy(F.desc("freq"), "ch").select(*flat).coalesce(1).write.option("header", True).option("sep", "\t").option("quote", "\u0000").option("emptyValue", "").csv(path)


def image_files(rows: DataFrame, folder: str, name: str = "file", content: str = "image") -> DataFrame:
    """(file, error): each row's bytes as a file of a folder that all executors see; null bytes and failed writes have an error.

    A file appears under its name when it is whole, so a task that runs again does no harm.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files, errors = batch.column(0).to_pylist(), []
            for file, data in zip(files, batch.column(1).to_pylist(), strict=True):
                part = f"{folder}/.{uuid.uuid4().hex}"
                try:
                    if data is None or not file or "/" in file:
                        raise OSError("no image" if file else "no name")
                    with open(part, "wb") as f:
                        f.write(data)
                    os.replace(part, f"{folder}/{file}")
                    errors.append(None)
                except OSError as e:
                    errors.append(str(e))
            yield pa.RecordBatch.from_arrays([pa.array(files, pa.string()), pa.array(errors, pa.string())], ["file", "error"])

    return written(rows.select(name, content).mapInArrow(run, "file string, error string"), "image-files")


def copied_images(rows: DataFrame, source: str, folder: str) -> DataFrame:
    """Copies the files that rows name from one folder to another, which is cleared first; (file) of those that are missing."""
    spark = rows.sparkSession
    os.makedirs(folder, exist_ok=True)
    for f in os.scandir(folder):
        if f.is_file():
            os.remove(f.path)
    present = spark.read.format("binaryFile").load(source).select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("content").alias("image"))
    have, lost = image_set(rows, present)
    failed = image_files(have, folder).where("error is not null").select("file")
    return lost.unionByName(failed)


def append_results(rows: DataFrame, path: str, resume: bool = True) -> None:
    rows.write.mode("append" if resume else "overwrite").partitionBy("model").parquet(path)


def json_array(rows: DataFrame, columns: list[str], order: list[Column], pretty: bool = False) -> str:
    """One JSON array of a bounded export, in order."""
    parts = [r[0] for r in rows.orderBy(*order).select(F.to_json(F.struct(*columns))).collect()]
    return "[\n  " + ",\n  ".join(parts) + "\n]" if pretty else "[" + ",".join(parts) + "]"


def failures(rows: DataFrame, most: int = 200) -> DataFrame:
    """The first failures of a report."""
    return rows.where("not ok").orderBy("idx").select("idx", "text", "error").limit(most)


def image_set(rows: DataFrame, present: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(files to copy, files that are missing) of those rows name."""
    wanted = rows.select("file").distinct()
    return present.join(wanted, "file", "left_semi"), wanted.join(present, "file", "left_anti")


def size_bucket(n: int) -> str:
    return "n<1K" if n < 1000 else "1K<n<10K" if n < 10_000 else "10K<n<100K" if n < 100_000 else "100K<n<1M"


#: A place for a value in a template.
TOKEN = re.compile(r"\{\{\s*([\w.]+)\s*\}\}")


def yaml_tree(text: str) -> dict:
    """A YAML catalogue, where the library for it is installed."""
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("reading YAML takes the yaml library") from e
    return yaml.safe_load(text) or {}


def unused(values: dict[str, str], template: str) -> list[str]:
    """Keys that neither the template nor a value names."""
    named = set(TOKEN.findall(template)).union(*(TOKEN.findall(v) for v in values.values()))
    return sorted(set(values) - named)


def filled(template: str, values: dict[str, str]) -> tuple[str, list[str]]:
    """(the template with its values, the keys that have none)."""
    values = resolved(values)
    out = TOKEN.sub(lambda m: values.get(m[1], m[0]), template)
    return out, sorted(set(TOKEN.findall(out)))


def flattened(tree: dict, prefix: str = "") -> dict[str, str]:
    """A nested catalogue as dotted keys; line breaks at ends of texts go."""
    out: dict[str, str] = {}
    for k, v in tree.items():
        key = f"{prefix}{k}"
        out |= flattened(v, key + ".") if isinstance(v, dict) else {key: str(v).rstrip("\n")}
    return out


def resolved(values: dict[str, str], rounds: int = 5) -> dict[str, str]:
    """Values with {{key}} tokens replaced until none is left; a cycle raises."""
    token = TOKEN
    for _ in range(rounds):
        new = {k: token.sub(lambda m: values.get(m[1], m[0]), v) for k, v in values.items()}
        if new == values:
            break
        values = new
    if any(token.search(v) and token.search(v)[1] in values for v in values.values()):
        raise ValueError("tokens refer to each other")
    return values
