"""Runs of models over records, their scores and reports."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from inkwright.functions.score import metrics, normalize, postprocess

#: Most models of a registry.
MODELS = 1000
MEANS = ("cer_clipped", "acc", "ned_sim", "f1")


def pending(models: DataFrame, records: DataFrame, log: DataFrame, first: int | None = None, order: str = "file") -> DataFrame:
    """(model, record...) without those whose (model, file) has a row in log without an error; first: of each model.

    models is a registry: more than MODELS of them raise ValueError.
    """
    keys = [r.model for r in models.select("model").limit(MODELS + 1).collect()]
    if len(keys) > MODELS:
        raise ValueError(f"more than {MODELS} models")
    records = records.orderBy(order).limit(first) if first else records
    todo = records.withColumn("model", F.explode(F.array(*map(F.lit, keys)).cast("array<string>")))
    return todo.join(log.where(F.coalesce("error", F.lit("")) == "").select("model", "file").distinct(), ["model", "file"], "left_anti")


def latest_success(log: DataFrame, order: str, keys: tuple[str, ...] = ("model", "file")) -> DataFrame:
    """The last row without an error of each key."""
    rows = log.where(F.coalesce("error", F.lit("")) == "")
    rest = [c for c in log.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order)).alias("r")).select(*keys, "r.*")


def infer(rows: DataFrame, model: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str, tasks: int | None = None) -> DataFrame:
    """Runs model over Arrow batches; it returns rows with an error text instead of raising."""
    return (rows.repartition(tasks) if tasks else rows).mapInArrow(model, schema)


def scored(rows: DataFrame, raw: str = "prediction_raw", gt: str = "gt", clean: bool = True) -> DataFrame:
    """rows with prediction and metrics; scores are of normalised texts, prediction isn't normalised."""
    rows = rows.withColumn("prediction", postprocess(F.col(raw)) if clean else F.coalesce(F.col(raw), F.lit("")))
    rows = rows.withColumns({"_p": normalize(F.col("prediction")), "_g": normalize(F.col(gt))})
    return rows.withColumns(metrics(F.col("_p"), F.col("_g"))).drop("_p", "_g")


def with_errors(rows: DataFrame, include: bool) -> DataFrame:
    return rows if include else rows.where(F.coalesce("error", F.lit("")) == "")


def summary(rows: DataFrame, by: list[str], where: Column | None = None, digits: int = 6) -> DataFrame:
    """(by..., n, means); no rows: null means."""
    rows = rows if where is None else rows.where(where)
    return rows.groupBy(*by).agg(F.count("*").alias("n"), *(F.bround(F.avg(m), digits).alias(m) for m in MEANS))


def report(rows: DataFrame, tier: str = "tier", digits: int = 6, ext: Column | None = None) -> DataFrame:
    """(model, tier, n, means) for each tier, and over all as tier "all", in one pass by grouping sets; with ext, rows that it holds for also count as tier "ext"."""
    if ext is not None:
        both = [F.lit("all"), F.col(tier)]
        rows = rows.withColumn("_tier", F.explode(F.when(F.coalesce(ext, F.lit(False)), F.array(*both, F.lit("ext"))).otherwise(F.array(*both))))
        return summary(rows, ["model", "_tier"], digits=digits).withColumnRenamed("_tier", "tier")
    means = [F.bround(F.avg(m), digits).alias(m) for m in MEANS]
    sets = rows.groupingSets([["model"], ["model", tier]], "model", tier).agg(F.grouping(tier).alias("_all"), F.count("*").alias("n"), *means)
    return sets.select("model", F.when(F.col("_all") == 1, "all").otherwise(F.col(tier)).alias("tier"), "n", *MEANS)


def with_metadata(rows: DataFrame, metadata: DataFrame, columns: list[str], key: str = "file") -> DataFrame:
    """rows with columns of metadata, empty where there is none; metadata is unique by key."""
    out = rows.join(metadata.select(key, *columns), key, "left")
    return out.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns})


def pair_hits(rows: DataFrame, pair_chars: list[str], gt: str = "gt", prediction: str = "prediction") -> DataFrame:
    """(model, tier, ch, hits, hits_exact, total): one trial for each row and pair character that its truth holds.

    Rows explode once into their own pair characters instead of being scanned for each pair.
    """
    from inkwright.functions.text import chars

    own = F.array_distinct(F.filter(chars(F.col(gt)), lambda c: c.isin(pair_chars)))
    trials = rows.select("model", "tier", F.col(gt).alias("g"), F.col(prediction).alias("p"), F.explode(own).alias("ch"))
    hit = F.sum(F.contains(F.col("p"), F.col("ch")).cast("long"))
    return trials.groupBy("model", "tier", "ch").agg(hit.alias("hits"), F.sum((F.col("p") == F.col("ch")).cast("long")).alias("hits_exact"), F.count("*").alias("total"))


def pair_table(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """(model, target, confusable, char_hits, char_total, sentence_hits, sentence_total, place) of pairs that a model had as single characters.

    A trial is a row of tier char whose truth is the target, or one of tier sentence whose truth holds it; a hit is a
    prediction that holds it. Places go by hits among characters, then by target. pairs (target, confusable) is unique by target.
    """
    from inkwright.functions.text import chars

    char = F.col("tier") == "char"
    trials = rows.where("tier in ('char', 'sentence')").select("model", "tier", "gt", "prediction", F.explode(F.array_distinct(chars(F.col("gt")))).alias("target"))
    trials = trials.join(pairs.select("target", "confusable"), "target").where(~char | (F.col("gt") == F.col("target")))
    hit = F.contains(F.col("prediction"), F.col("target"))
    count = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    out = trials.groupBy("model", "target", "confusable").agg(count(char & hit).alias("char_hits"), count(char).alias("char_total"), count(~char & hit).alias("sentence_hits"), count(~char).alias("sentence_total"))
    # a row per model and pair
    place = F.row_number().over(Window.partitionBy("model").orderBy(F.desc("char_hits"), "target"))
    return out.where("char_total > 0").withColumn("place", place.cast("long"))


def models(registry: DataFrame, keys: str = "") -> DataFrame:
    """Models whose key (column model) is in a list parted by commas; of an empty list all."""
    wanted = [k.strip() for k in keys.split(",") if k.strip()]
    return registry.where(F.col("model").isin(wanted)) if wanted else registry


def request(tag: Column, prompt: str, image: Column, temperature: float = 0) -> Column:
    """The JSON body that asks a model server for the text of an image."""
    options = F.struct(F.lit(temperature).alias("temperature"))
    return F.to_json(F.struct(tag.alias("model"), F.lit(prompt).alias("prompt"), F.array(F.regexp_replace(F.base64(image), r"[\r\n]", "")).alias("images"), F.lit(False).alias("stream"), options.alias("options")))


def answer(body: Column) -> Column:
    """The text of a model server's JSON answer; empty if it has none."""
    return F.coalesce(F.from_json(body, "response string")["response"], F.lit(""))


def server(host: str, timeout: float = 180) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A model for infer: posts each row's column body to host/api/generate and puts reply, latency_sec and error in its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import time
        import urllib.request

        for batch in batches:
            at = batch.schema.get_field_index("body")
            out: list[tuple[str | None, float, str]] = []
            for body in batch.column(at).to_pylist():
                start = time.perf_counter()
                try:
                    if body is None:
                        raise FileNotFoundError("no image")
                    ask = urllib.request.Request(f"{host}/api/generate", body.encode(), {"Content-Type": "application/json"})
                    with urllib.request.urlopen(ask, timeout=timeout) as r:
                        reply, why = r.read().decode(), ""
                except Exception as e:  # a row that fails is a row with an error, which the next run takes again
                    reply, why = None, f"{type(e).__name__}: {e}"
                out.append((reply, round(time.perf_counter() - start, 3), why))
            kept = [i for i in range(batch.num_columns) if i != at]
            columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True) if out else ([], [], []), (pa.string(), pa.float64(), pa.string()), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), *columns], [*(batch.schema.names[i] for i in kept), "reply", "latency_sec", "error"])

    return run


def evaluated(todo: DataFrame, images: DataFrame, host: str, prompt: str, tasks: int | None = None) -> DataFrame:
    """Scored rows of todo (model, tag, file, gt, ...): each image (file, content) goes to the model server; a missing image is an error."""
    rows = todo.join(images.select("file", F.col("content").alias("_image")), "file", "left")
    rows = rows.withColumn("body", F.when(F.col("_image").isNotNull(), request(F.col("tag"), prompt, F.col("_image")))).drop("_image")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "body")
    rows = infer(rows, server(host), f"{schema}, reply string, latency_sec double, error string", tasks)
    return scored(rows.withColumn("prediction_raw", answer(F.col("reply"))).drop("reply"))


def tag_pairs(rows: DataFrame, pairs: DataFrame, text: str = "text") -> DataFrame:
    """rows with minimal_pair_with by text, from either side of pairs (target, confusable); the own pair first."""
    p = pairs.select(F.col("target").alias(text), F.col("confusable").alias("_own"))
    back = pairs.groupBy(F.col("confusable").alias(text)).agg(F.min("target").alias("_back"))
    out = rows.join(p, text, "left").join(back, text, "left")
    role = F.when(F.col("_own").isNotNull(), "target").when(F.col("_back").isNotNull(), "confusable")
    return out.withColumns({"pair_with": F.coalesce("_own", "_back"), "pair_role": role}).drop("_own", "_back")
