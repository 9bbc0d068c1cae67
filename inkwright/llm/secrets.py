"""Secret scans by patterns and by two character Markov models, in SQL functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: kind, pattern, least characters and the group they are counted of.
BASE = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),
    ("access", r"AKIA[A-Z0-9]+", 16, 0),
    ("hex", r"[0-9a-f]+", 32, 0),
)
#: The same kinds as patterns that only fit what can be kept, to pass over texts without a match quickly.
_MAYBE = (
    r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]""",
    r"AKIA[A-Z0-9]{12}",
    r"(?<![0-9a-f])[0-9a-f]{32}",
)
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-"
_RUN = r"[A-Za-z0-9+/_-]"
#: Least characters of a run that the models judge, and of a run that they learn from.
JUDGED, LEARNT = 20, 12
#: Random strings generated as samples, of 43 characters each; pseudo-count of a pair of characters.
RANDOM_SAMPLES, SMOOTH = 3000, 0.5
_EMPTY = "cast(array() as array<struct<start: bigint, end: bigint, kind: string>>)"


def _code(c: Column) -> Column:
    return F.instr(F.lit(ALPHABET), c) - 1


def _spans(text: Column, pattern: str, kind: str, least: int, group: int, maybe: str) -> Column:
    """[(start, end, kind)] of the leftmost non-overlapping matches of which the group is long enough.

    A match starts after the texts between matches and the matches before it, in code points.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    sized = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    all_ = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("hit"), sized.alias("part"))
    walk = F.aggregate(
        F.filter(all_, lambda x: x["hit"].isNotNull()),
        F.struct(F.lit(0).cast("long").alias("at"), F.expr(_EMPTY).alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + F.length(x["gap"]) + F.length(x["hit"])).alias("at"),
            F.when(
                F.length(x["part"]) >= least,
                F.concat(
                    acc["out"],
                    F.array(
                        F.struct(
                            (acc["at"] + F.length(x["gap"])).alias("start"),
                            (acc["at"] + F.length(x["gap"]) + F.length(x["hit"])).alias("end"),
                            F.lit(kind).alias("kind"),
                        )
                    ),
                ),
            )
            .otherwise(acc["out"])
            .alias("out"),
        ),
        lambda acc: acc["out"],
    )
    return F.when(text.rlike(maybe), walk).otherwise(F.expr(_EMPTY))


def labelled_pairs(docs: DataFrame, text: str = "text") -> DataFrame:
    """(label, pair, n): counts of neighbouring characters in samples of both labels.

    label 0, ordinary identifiers: every run of the alphabet in any text that is letters, dashes and
    underscores, or digits, alone. label 1, random strings: every run that follows a name of the
    assignment pattern, and generated base64 and hexadecimal strings, the same at each run.
    """
    spark = docs.sparkSession
    runs = docs.select(F.explode(F.regexp_extract_all(F.col(text), F.lit(rf"(?<!{_RUN}){_RUN}{{{LEARNT},}}+"), F.lit(0))).alias("s"))
    plain = runs.where(F.col("s").rlike(r"^(?:[A-Za-z_-]+|[0-9]+)$")).select(F.lit(0).alias("label"), "s")
    named = docs.where(F.col(text).rlike(_MAYBE[0])).select(
        F.lit(1).alias("label"), F.explode(F.regexp_extract_all(F.col(text), F.lit(BASE[0][1]), F.lit(2))).alias("s")
    )
    named = named.where((F.length("s") >= JUDGED) & ~F.col("s").rlike(r"^[A-Za-z_.-]+$"))
    seeds = spark.range(RANDOM_SAMPLES).select(F.sha2(F.concat(F.lit("sample "), F.col("id").cast("string")), 256).alias("h"))
    made = seeds.select(F.lit(1).alias("label"), F.explode(F.array(F.base64(F.unhex("h")), "h")).alias("s"))
    pairs = plain.unionByName(named).unionByName(made)
    pairs = pairs.select("label", F.explode(F.transform(F.sequence(F.lit(1), F.length("s") - 1), lambda i: F.substring(F.col("s"), i, 2))).alias("pair"))
    return pairs.groupBy("label", "pair").agg(F.count("*").alias("n"))


def fit_models(docs: DataFrame, text: str = "text") -> tuple[str, float]:
    """Log-likelihood ratios of all pairs of characters, comma-joined, and the threshold of their mean.

    The table has len(ALPHABET) ** 2 entries whatever the input. The threshold is halfway between the
    means of both labels' samples.
    """
    size = len(ALPHABET)
    counts = labelled_pairs(docs, text).select(
        "label", _code(F.substring("pair", 1, 1)).alias("a"), _code(F.substring("pair", 2, 1)).alias("b"), "n"
    )
    counts = counts.where("a >= 0 and b >= 0").groupBy("a", "b").agg(
        *(F.sum(F.when(F.col("label") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in (0, 1))
    )
    grid = docs.sparkSession.range(0, size * size, 1, 1).select(F.col("id"), F.floor(F.col("id") / size).cast("int").alias("a"), (F.col("id") % size).cast("int").alias("b"))
    grid = grid.join(F.broadcast(counts), ["a", "b"], "left").fillna(0, ["n0", "n1"])
    after = Window.partitionBy("a")
    p = [(F.col(f"n{k}") + SMOOTH) / (F.sum(f"n{k}").over(after) + SMOOTH * size) for k in (0, 1)]
    grid = grid.withColumn("llr", F.log(p[1] / p[0]))
    row = grid.agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", F.format_string("%.4f", "llr").alias("v")))), lambda x: x["v"]), ",").alias("table"),
        *((F.sum(F.col(f"n{k}") * F.col("llr")) / F.greatest(F.lit(1), F.sum(f"n{k}"))).alias(f"m{k}") for k in (0, 1)),
    ).first()
    return row["table"], (row["m0"] + row["m1"]) / 2


def _ratio(s: Column, table: str) -> Column:
    """Mean log-likelihood ratio of the pairs of characters in s."""
    llr = F.split(F.lit(table), ",").cast("array<double>")
    pairs = F.transform(
        F.sequence(F.lit(1), F.length(s) - 1),
        lambda i: F.element_at(llr, (_code(F.substring(s, i, 1)) * len(ALPHABET) + _code(F.substring(s, i + 1, 1)) + 1).cast("int")),
    )
    return F.aggregate(pairs, F.lit(0.0), lambda a, x: a + x) / F.size(pairs)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def _sorted(spans: Column) -> Column:
    order = [k for k, *_ in BASE] + ["random"]
    rank = lambda x: F.array_position(F.array(*map(F.lit, order)), x["kind"])
    ranked = F.array_sort(F.transform(spans, lambda x: F.struct(x["start"].alias("start"), rank(x).alias("r"), x["end"].alias("end"), x["kind"].alias("kind"))))
    return F.transform(ranked, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind")))


def _fresh(name: str, columns: list[str]) -> str:
    """name, with as many underscores before it as keep it apart from columns, whatever their case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def find_secrets(docs: DataFrame, text: str = "text", into: str = "secret_spans", base_into: str = "base_spans", models: tuple[str, float] | None = None) -> DataFrame:
    """docs with two more columns of [(start, end, kind)] by start and kind: all spans, and those of BASE.

    The models add runs of JUDGED characters or more that are likelier random strings than ordinary
    identifiers, kind "random", where they touch no span of BASE. Positions are code points, ends
    exclusive. Null and empty texts have no spans; equal rows have equal spans; every row comes back
    once. Both new columns replace columns of docs that have their names; others stay.
    """
    table, least = models or fit_models(docs, text)
    t = F.coalesce(F.col(text), F.lit(""))
    base = F.concat(*(_spans(t, p, k, n, g, m) for (k, p, n, g), m in zip(BASE, _MAYBE, strict=True)))
    run, runs = rf"(?<!{_RUN}){_RUN}{{{JUDGED},}}+", _fresh("runs", [*docs.columns, into, base_into])
    out = docs.withColumn(base_into, _sorted(base)).withColumn(runs, _spans(t, run, "random", JUDGED, 0, run))
    random = F.filter(
        F.col(runs),
        lambda x: ~F.exists(F.col(base_into), lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))
        & (_ratio(F.substring(t, (x["start"] + 1).cast("int"), (x["end"] - x["start"]).cast("int")), table) > F.lit(least)),
    )
    return out.withColumn(into, F.when(F.size(runs) > 0, _sorted(F.concat(F.col(base_into), random))).otherwise(F.col(base_into))).drop(runs)


def secret_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random) of each row of documents."""
    rows = find_secrets(docs.select("doc_id", "text"))
    n = lambda c, k: F.size(F.filter(F.col(c), lambda x: x["kind"] == k)).cast("long")
    return rows.select(
        "doc_id",
        *(n("base_spans", k).alias(f"n_{k}") for k, *_ in BASE),
        F.sha2(_joined(F.col("base_spans")).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("secret_spans")).alias("spans"),
        n("secret_spans", "random").alias("n_random"),
    )


def redact(docs: DataFrame, text: str = "text", mark: str = "[secret]", models: tuple[str, float] | None = None) -> DataFrame:
    """docs with every span of a secret in text replaced by mark; spans that overlap become one mark.

    Null texts stay null; equal rows stay equal; all columns stay in their places, whatever their names.
    """
    spans = _fresh("spans", docs.columns)
    base = _fresh("base", [*docs.columns, spans])
    found = find_secrets(docs, text, spans, base, models)
    t = F.col(text)
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    cut = lambda a, n: F.substring(t, (a + 1).cast("int"), n.cast("int"))
    walk = F.aggregate(
        F.col(spans),
        start,
        lambda acc, x: F.struct(
            F.greatest(acc["at"], x["end"]).alias("at"),
            F.when(x["start"] >= acc["at"], F.concat(acc["out"], cut(acc["at"], x["start"] - acc["at"]), F.lit(mark))).otherwise(acc["out"]).alias("out"),
        ),
        lambda acc: F.concat(acc["out"], cut(acc["at"], F.length(t))),
    )
    return found.withColumn(text, F.when(F.size(spans) > 0, walk).otherwise(t)).drop(spans, base)

