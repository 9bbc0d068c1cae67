"""python -m inkwright COMMAND: plan, evaluate, score, report, verify, package, samples and fonts over files."""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwright.functions.text import HAN, LATIN, human_bytes, word_entry
from inkwright.operators import charset, corpus, evals, fonts, images, qa
from inkwright.plans import build, planner, report
from inkwright.session import session
from inkwright.sources import readers, sinks
from inkwright.store import written

#: Members of a record that the commands read; others are left out.
RECORD = (
    "file string, text string, tier string, role string, source string, difficulty string, plane string, font string, font_family string, font_license string, "
    "charset_source string, minimal_pair_with string, jyutping string, canto_chars string, corpus_freq long, n_chars long, width long, height long, ink_ratio double, contrast double, idx long"
)
PROMPT = "Read the text in the image. Answer with the text alone."
IMAGES = "*.{[jJ][pP][gG],[pP][nN][gG]}"


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="inkwright", description=__doc__)
    p.add_argument("--master")
    sub = p.add_subparsers(dest="command", required=True)
    a = sub.add_parser("plan", help="documents, lists and a font table to a plan")
    for name in ("--documents", "--standard", "--fonts", "--pairs", "--out"):
        a.add_argument(name, required=True)
    for name in ("--core", "--ext", "--include", "--exclude"):
        a.add_argument(name, help="a list of characters")
    a.add_argument("--total", type=int, default=0)
    a.add_argument("--seed", type=int, default=20260825)
    a.add_argument("--min-freq", type=int, default=3)
    a.add_argument("--script", choices=("han", "latin"), default="han")
    a.add_argument("--plan-only", action="store_true", help="show the plan, write nothing")
    a = sub.add_parser("evaluate", help="images to a model server; appends scored rows, failures run again next time")
    for name in ("--metadata", "--images", "--models", "--results"):
        a.add_argument(name, required=True)
    a.add_argument("--host", default="http://127.0.0.1:11434")
    a.add_argument("--keys", default="", help="models to run, parted by commas; else all")
    a.add_argument("--limit", type=int, default=0, help="the first records of each model; 0: all")
    a.add_argument("--prompt", default=PROMPT)
    a.add_argument("--no-resume", action="store_true")
    a = sub.add_parser("score", help="predictions to scored rows")
    for name in ("--predictions", "--out"):
        a.add_argument(name, required=True)
    a.add_argument("--no-resume", action="store_true")
    a = sub.add_parser("report", help="scored rows to means by model and tier")
    a.add_argument("--scores", required=True)
    a.add_argument("--pairs", help="also a table of pairs")
    a.add_argument("--with-errors", action="store_true")
    a = sub.add_parser("verify", help="files, metadata, labels, images and glyphs; exit code 1 if a check is fatal")
    for name in ("--images", "--metadata", "--labels"):
        a.add_argument(name, required=True)
    a.add_argument("--fonts", help="a table (font_key, cmap); without it glyphs aren't checked")
    a.add_argument("--pairs")
    a.add_argument("--sample", type=int, default=0, help="images to decode; 0: all PNG files")
    a.add_argument("--seed", type=int, default=20260825)
    a = sub.add_parser("package", help="metadata and images to one Parquet file and a card")
    for name in ("--metadata", "--images", "--dest"):
        a.add_argument(name, required=True)
    a.add_argument("--scores", help="scored rows for the card; without them it says TBD")
    a.add_argument("--name", default="benchmark")
    a.add_argument("--license", default="cc-by-4.0")
    a = sub.add_parser("samples", help="a showcase: JSON and copies of its images")
    for name in ("--metadata", "--images", "--pairs", "--out"):
        a.add_argument(name, required=True)
    a.add_argument("--per-bucket", type=int, default=2)
    a = sub.add_parser("fonts", help="font files to a catalogue")
    a.add_argument("--own", required=True, help="a folder whose fonts all may be used")
    a.add_argument("--system", help="a folder whose fonts may be used if the whitelist names them")
    a.add_argument("--whitelist", default="", help="parts of plain names, parted by commas")
    a.add_argument("--weights", default="300,400,500,700,900")
    a.add_argument("--probe", required=True, help="characters of the basic plane that fonts are tried with")
    a.add_argument("--probe-ext", default="", help="characters beyond it")
    a.add_argument("--out", required=True)
    return p


def _records(spark: SparkSession, path: str) -> DataFrame:
    return readers.jsonl(spark, path, RECORD)


def _plan(spark: SparkSession, args: argparse.Namespace) -> int:
    preset = HAN if args.script == "han" else LATIN
    docs = spark.read.parquet(args.documents)
    sentences = corpus.sentences(docs, preset)
    freq = corpus.char_frequency(sentences, preset=preset)
    none = spark.createDataFrame([], "ch string")
    pairs = spark.read.parquet(args.pairs)
    forced = pairs.select(F.col("target").alias("ch"), F.lit(3).alias("ord"), F.lit("pair").alias("tag"))
    for path, ord_, tag in ((args.core, 1, "core"), (args.ext, 2, "ext"), (args.include, 4, "manual")):
        if path:
            forced = forced.unionByName(readers.char_lines(spark, path, "any", preset).withColumns({"ord": F.lit(ord_), "tag": F.lit(tag)}))
    excluded = charset.exclusions(none, readers.char_lines(spark, args.exclude, "any", preset)) if args.exclude else none
    own = charset.derive(freq, readers.char_lines(spark, args.standard, preset=preset), none, excluded, forced, args.min_freq)
    words = docs.select("source", F.explode(F.split("text", r"\s+", -1)).alias("text")).where(word_entry(F.col("text"), preset)).distinct()
    sizes = planner.scaled(planner.TIERS, args.total) if args.total else planner.TIERS
    plan = build.build_plan(own, words, sentences, pairs, spark.read.parquet(args.fonts), sizes, args.seed)
    if args.plan_only:
        plan.groupBy("tier", "difficulty").count().orderBy("tier", "difficulty").show()
        plan.orderBy("idx").show(20)
    else:
        plan.write.parquet(args.out)
    return 0


def _evaluate(spark: SparkSession, args: argparse.Namespace) -> int:
    registry = evals.models(readers.json_document(spark, args.models, "model string, tag string").where("model is not null"), args.keys)
    if registry.isEmpty():
        print("no such model")
        return 1
    resume = not args.no_resume and readers.exists(spark, args.results)
    log = spark.read.parquet(args.results).select("model", "file", "error") if resume else spark.createDataFrame([], "model string, file string, error string")
    records = _records(spark, args.metadata).withColumnRenamed("text", "gt").drop("idx", "width", "height", "ink_ratio", "contrast")
    todo = evals.pending(registry, records, log, args.limit or None).join(registry, "model")
    files = spark.read.format("binaryFile").option("pathGlobFilter", IMAGES).load(args.images).select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    sinks.append_results(evals.evaluated(todo, files, args.host, args.prompt), args.results, not args.no_resume)
    return 0


def _scores(spark: SparkSession, path: str, with_errors: bool) -> DataFrame:
    rows = spark.read.parquet(path)
    rows = rows if "error" in rows.columns else rows.withColumn("error", F.lit(None).cast("string"))
    return evals.with_errors(rows, with_errors)


def _report(spark: SparkSession, args: argparse.Namespace) -> int:
    rows = _scores(spark, args.scores, args.with_errors)
    ext = F.col("plane").isin("ExtA", "ExtB+") if "plane" in rows.columns else None
    evals.report(rows, ext=ext).orderBy("model", "tier").show(200, False)
    if args.pairs:
        evals.pair_table(rows, spark.read.parquet(args.pairs)).orderBy("model", "place").show(200, False)
    return 0


def _verify(spark: SparkSession, args: argparse.Namespace) -> int:
    records = _records(spark, args.metadata)
    found = qa.pairing(readers.listing(spark, args.images, IMAGES), records, readers.label_lines(spark, args.labels))
    files = readers.images_in(spark, args.images)
    if args.sample:
        files = qa.sample_exactly(files, args.sample, str(args.seed), "file")
    grey = images.grey_of(files.where("error is null"))
    glyphs = fonts.missing(records.withColumnRenamed("font", "font_key"), spark.read.parquet(args.fonts)) if args.fonts else None
    weak = qa.weak_pairs(spark.read.parquet(args.pairs), records.where("tier = 'char'")) if args.pairs else None
    result = qa.findings(found, files, images.measure(grey, key="file"), glyphs, weak).collect()  # a row per check
    for r in sorted(result, key=lambda r: (not r.fatal, r.check)):
        print(f"{'fatal' if r.fatal else 'warning'}: {r.check}: {r.n}, such as {r.example}")
    if not args.fonts:
        print("glyphs: not checked, no fonts given")
    qa.distribution(records, ["tier", "difficulty", "source", "role"]).orderBy("field", F.desc("n"), "value").show(100, False)
    return int(any(r.fatal for r in result))


def _package(spark: SparkSession, args: argparse.Namespace) -> int:
    records = _records(spark, args.metadata).drop("idx")
    files = spark.read.format("binaryFile").option("pathGlobFilter", IMAGES).load(args.images).select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    schema = {c.split()[0]: c.split()[1] for c in RECORD.split(", ") if c.split()[0] not in ("idx", "file")} | {"file": "string"}
    sinks.packaged(records.join(files, "file"), f"{args.dest}/data", schema, image="content", files=1)
    scores = [r.asDict() for r in evals.report(_scores(spark, args.scores, False)).orderBy("model", "tier").collect()] if args.scores else None
    none = spark.createDataFrame([], "idx long, text string, error string")
    made = report.build_report(records, none, none, {"dataset": args.name})
    Path(args.dest, "README.md").write_text(report.card(made, args.name, args.license, scores), encoding="utf-8")
    return 0


def _samples(spark: SparkSession, args: argparse.Namespace) -> int:
    records = _records(spark, args.metadata).drop("minimal_pair_with")
    rows = build.showcase(records, spark.read.parquet(args.pairs), per_bucket=args.per_bucket)
    columns = ["file", "text", "tier", "difficulty", "plane", "source", F.col("font_family").alias("font"), "n_chars", "role", "width", "pair_with", "pair_role"]
    rows = written(rows.select(*columns), "samples")
    tier = F.array_position(F.array(*map(F.lit, build.TIER_ORDER)), F.col("tier"))
    Path(args.out).mkdir(parents=True, exist_ok=True)
    Path(args.out, "samples.json").write_text(sinks.json_array(rows, rows.columns, [tier, F.col("file")], pretty=True), encoding="utf-8")
    lost = sinks.copied_images(rows, args.images, f"{args.out}/samples").count()
    size = sum(f.stat().st_size for f in Path(args.out, "samples").iterdir())
    print(f"{rows.count()} samples, {spark.range(1).select(human_bytes(F.lit(size)).alias('s')).first().s}, {lost} images missing")
    for r in build.showcase_counts(rows).orderBy("field", F.desc("n"), "value").collect():
        print(f"{r.field} {r.value}: {r.n}")
    return int(lost > 0)


def _fonts(spark: SparkSession, args: argparse.Namespace) -> int:
    files = readers.font_files(spark, args.own).withColumn("own", F.lit(True))
    if args.system:
        files = files.unionByName(readers.font_files(spark, args.system).withColumn("own", F.lit(False)))
    parts = [w.strip() for w in args.whitelist.split(",") if w.strip()]
    names = fonts.candidates(files.select("path", "own"), parts)
    faces = written(fonts.faces(files.select("path", "content").join(names.select("path"), "path", "left_semi").dropDuplicates(["path"])), "faces")
    for r in faces.where("error is not null").select("path", "error").orderBy("path").limit(100).collect():
        print(f"left out: {r.path}: {r.error}")
    weights = [int(w) for w in args.weights.split(",")]
    own = fonts.catalogue(faces, weights, sorted(set(map(ord, args.probe))), sorted(set(map(ord, args.probe_ext))) or [0x10FFFF])
    usable = fonts.usable(own.withColumn("coverage", F.col("coverage_bmp"))).drop("coverage")
    usable.write.mode("overwrite").parquet(args.out)
    fonts.report(own).show(1, False)
    fonts.ranked(usable).select("font_key", "n_glyphs", "coverage_bmp", "coverage_ext").show(20, False)
    return int(spark.read.parquet(args.out).isEmpty())


def _score(spark: SparkSession, args: argparse.Namespace) -> int:
    rows = spark.read.parquet(args.predictions)
    if not args.no_resume and readers.exists(spark, args.out):
        done = spark.read.parquet(args.out).select("model", "file").distinct()
        rows = rows.join(done, ["model", "file"], "left_anti")
    evals.scored(rows).write.mode("overwrite" if args.no_resume else "append").parquet(args.out)
    return 0


COMMANDS = {"plan": _plan, "evaluate": _evaluate, "score": _score, "report": _report, "verify": _verify, "package": _package, "samples": _samples, "fonts": _fonts}


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    return COMMANDS[args.command](session(args.master), args)


if __name__ == "__main__":
    sys.exit(main())
