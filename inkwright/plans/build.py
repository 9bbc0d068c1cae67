"""The plan of a benchmark: three tiers under budgets, fonts that cover each text, difficulties, one dense index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from inkwright.functions.text import chars, plane
from inkwright.operators import evals, fonts, qa
from inkwright.plans import planner
from inkwright.store import written

#: Texts of each group that meet the fonts at first; Spark cuts groups to as many before the shuffle.
FIRST = 1000


def with_hits(rows: DataFrame, charset: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """rows that hold a character of charset (ch), with canto_chars, their sorted different such characters, and n_canto_chars; null keys go.

    The charset comes as one text, a row that is broadcast: what translating it away takes from a text are the hits, so no text is exploded or shuffled.
    """
    all_ = charset.where(F.length("ch") == 1).agg(F.array_join(F.array_sort(F.collect_set("ch")), "").alias("_charset"))
    for key in keys:
        rows = rows.where(F.col(key).isNotNull())
    rest = F.call_function("translate", F.col(text), F.col("_charset"), F.lit(""))
    hits = F.array_sort(F.array_except(chars(F.col(text)), chars(rest)))
    rows = rows.crossJoin(F.broadcast(all_)).withColumn("h", hits).where(F.size("h") > 0)
    return rows.withColumns({"canto_chars": F.array_join("h", ""), "n_canto_chars": F.size("h").cast("long")}).drop("h", "_charset")


def fonts_for(texts: DataFrame, cmap: DataFrame, n: int, seed: str) -> DataFrame:
    """(text, font_key, pick) for up to n fonts that cover each text, families in turn."""
    families = cmap.select("font_key", "family").distinct()
    covering = fonts.covering(texts, cmap.select("font_key", "cp")).join(families, "font_key")
    return planner.round_robin(covering, ["text"], ["family"], seed, ["text", "font_key"], n).select("text", "font_key", "pick")


def char_items(charset: DataFrame, pairs: DataFrame) -> DataFrame:
    """(text, role): the charset as targets and the different confusable characters as counterparts; one character may be both."""
    targets = charset.select(F.col("ch").alias("text"), F.lit("target").alias("role"))
    return targets.unionByName(pairs.select(F.col("confusable").alias("text"), F.lit("counterpart").alias("role")).distinct())


def with_attributes(rows: DataFrame, charset: DataFrame) -> DataFrame:
    """rows (text, ...) with what charset tells of their character; others have frequency 0 and come as counterparts."""
    known = charset.select(F.col("ch").alias("text"), "freq", F.col("source").alias("charset_source"))
    more = {"corpus_freq": F.coalesce("freq", F.lit(0)), "charset_source": F.coalesce("charset_source", F.lit("counterpart")), "plane": plane(F.col("text")), "source": F.lit("charset")}
    return rows.join(known, "text", "left").withColumns(more).drop("freq")


def char_tier(charset: DataFrame, pairs: DataFrame, cmap: DataFrame, budget: int, seed: str) -> DataFrame:
    """Each character and each confusable counterpart equally often, at least once each even over budget."""
    items = char_items(charset, pairs)
    per = max(1, budget // max(1, items.count()))
    rows = with_attributes(items.join(fonts_for(items, cmap, per, seed), "text"), charset)
    own = pairs.select(F.col("target").alias("text"), F.col("confusable").alias("minimal_pair_with"))
    return rows.join(own, "text", "left").withColumn("item", qa.hash_order(seed, "role", "text"))


def first_covered(rows: DataFrame, cmap: DataFrame, budget: int, seed: str, by: list[str]) -> tuple[DataFrame, DataFrame, int]:
    """(rows, picks of their texts, groups): the first rows of each group in order of item and text, so many that their picks fill its equal part of budget, or all.

    Only these meet the fonts. They begin with FIRST and grow fourfold until every group is full or has no more, so nothing is lost where few are covered.
    """
    k = FIRST
    while True:
        if by:
            w = Window.partitionBy(*by).orderBy("item", "text")
            firsts = rows.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")
        else:
            firsts = rows.orderBy("item", "text").limit(k)
        firsts = written(firsts, "firsts")
        picks = written(fonts_for(firsts, cmap, planner.RENDERS, seed), "picks")
        size = picks.groupBy("text").agg(F.count("*").alias("renders"))
        groups = firsts.join(size, "text", "left").groupBy(*by).agg(F.count("*").alias("n"), F.coalesce(F.sum("renders"), F.lit(0)).alias("renders"))
        groups = groups.agg(F.count("*").alias("groups"), F.count_if(F.col("n") >= k).alias("more"), F.min(F.when(F.col("n") >= k, F.col("renders"))).alias("open")).first()
        if not groups.more or groups.open >= max(1, budget // groups.groups):
            return firsts, picks, groups.groups
        k *= 4


def text_tier(rows: DataFrame, cmap: DataFrame, budget: int, seed: str, by_source: bool) -> DataFrame:
    """Texts in hashed order, up to RENDERS fonts each, until the budget is full; with by_source each source fills an equal part."""
    rows = rows.withColumn("item", qa.hash_order(seed, "source", "text"))
    rows, picks, sources = first_covered(rows, cmap, budget, seed, ["source"] if by_source else [])
    size = picks.groupBy("text").agg(F.count("*").alias("renders"))
    items = rows.join(size, "text")
    order = [F.col("item"), F.col("text")]
    if by_source:
        share = budget // max(1, sources)
        kept = planner.fill_budget(items, "renders", max(1, share), order, ["source"])
    else:
        kept = planner.fill_budget(items, "renders", budget, order)
    out = kept.join(picks, "text").drop("before", "renders")
    # at most budget rows and a few more for each source
    cut = F.row_number().over(Window.partitionBy().orderBy("source", "item", "text", "pick"))
    return out.withColumn("_rn", cut).where(F.col("_rn") <= budget).drop("_rn")


def build_plan(charset: DataFrame, words: DataFrame, sentences: DataFrame, pairs: DataFrame, cmap: DataFrame, sizes: dict[str, int] | None = None, seed: int = 20260825) -> DataFrame:
    """(idx, tier, text, source, font_key, difficulty, role, ...) of all tiers in order.

    charset (ch, freq, source), words and sentences (source, text), pairs (target, confusable), cmap
    (font_key, family, cp). A text that no font covers gives no rows: among characters its share is
    lost, else the next text takes it. Draws are hashes of seed and row, the same in any partitioning.
    """
    sizes, s = sizes or planner.TIERS, str(seed)
    charset = written(charset, "charset")  # a row a character; each tier asks for it
    hit = lambda rows: with_hits(rows.select("source", "text").distinct(), charset, ["source", "text"])
    tiers = planner.tiers_in_order(
        char=char_tier(charset, pairs, cmap, sizes["char"], s),
        word=text_tier(hit(words), cmap, sizes["word"], s, False).withColumn("role", F.lit("word")),
        sentence=text_tier(hit(sentences), cmap, sizes["sentence"], s, True).withColumn("role", F.lit("sentence")),
    )
    plan = planner.dense_index(tiers, ["tier_ord", "role", "source", "item", "text", "pick"])
    return plan.withColumn("difficulty", planner.draw(planner.unit(s, "idx"))).drop("tier_ord", "item", "pick")


def unrenderable(charset: DataFrame, cmap: DataFrame) -> DataFrame:
    """Characters that no font has, for the report."""
    return fonts.unrenderable(charset.select(F.col("ch").alias("text")), cmap)


def most_frequent(records: DataFrame, n: int) -> DataFrame:
    """(text, corpus_freq) of the n texts of greatest frequency, those that stand first among equals."""
    rows = records.groupBy("text").agg(F.max("corpus_freq").alias("corpus_freq"), F.min("idx").alias("_first"))
    return rows.orderBy(F.desc("corpus_freq"), "_first").limit(n).drop("_first")


def showcase(records: DataFrame, pairs: DataFrame, seed: str = "20260825", n_pairs: int = 7, n_ext: int = 9, per_bucket: int = 2) -> DataFrame:
    """A small selection: both sides of the first pairs (clean ones first), frequent extension characters, every tier and difficulty, three of each sentence source."""
    first = pairs.orderBy("ord").limit(n_pairs)
    sides = first.select(F.col("target").alias("text")).union(first.select("confusable")).distinct().withColumn("in_pair", F.lit(True))
    ext = most_frequent(records.where("tier = 'char' and plane in ('ExtA', 'ExtB+')"), n_ext).select("text", F.lit(True).alias("in_ext"))
    rows = records.join(F.broadcast(sides), "text", "left").join(F.broadcast(ext), "text", "left")
    h = qa.hash_order(seed, "file")
    char = F.col("tier") == "char"
    stages = [
        (char & F.col("in_pair"), ["text"], 1, [F.when(F.col("difficulty") == "clean", 0).otherwise(1), h]),
        (char & F.col("in_ext"), ["text"], 1, [h]),
        (F.lit(True), ["tier", "difficulty"], per_bucket, [h]),
        (F.col("tier") == "sentence", ["source"], 3, [h]),
    ]
    picked = planner.staged_pick(rows, stages, "file").drop("in_pair", "in_ext")
    return evals.tag_pairs(picked, pairs)


TIER_ORDER = ("char", "word", "sentence")


def showcase_order(rows: DataFrame) -> DataFrame:
    """rows by tier, then file; tiers of other names come first."""
    return rows.orderBy(F.array_position(F.array(*map(F.lit, TIER_ORDER)), F.col("tier")), "file")


def showcase_counts(rows: DataFrame) -> DataFrame:
    """(field, value, n): rows by tier, difficulty and plane, where they have one, and those of pairs."""
    fields = [F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c in ("tier", "difficulty", "plane")]
    pair = F.struct(F.lit("pair").alias("field"), F.when(F.col("pair_with").isNotNull(), "yes").alias("value"))
    out = rows.select(F.explode(F.array(*fields, pair)).alias("p")).select("p.*").where("coalesce(value, '') <> ''")
    return out.groupBy("field", "value").agg(F.count("*").alias("n"))
