"""Corpora to sentences, words and character frequencies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwright.functions.text import Preset, acceptable, chars, clean_text, is_letter, keep_allowed, split_sentences, word_entry


def sentences(docs: DataFrame, preset: Preset, source: str = "source", doc_id: str = "doc_id", text: str = "text", newlines: str = "split", split: bool = True, strict: bool = True) -> DataFrame:
    """(source, text, doc_id, pos): acceptable pieces of cleaned texts, each once per source, where it stood first.

    One aggregation with partial minima, so a sentence that a whole source repeats meets in one row
    per task before the shuffle. Null texts and sources of null give rows under a null source.
    """
    t = clean_text(F.col(text), newlines)
    pieces = split_sentences(t, preset) if split else F.array(F.replace(t, F.lit("-"), F.lit("")))
    # cleaned inside the generator: a filter pushed below a projection would clean a piece for each predicate anew
    pieces = F.transform(pieces, lambda p: keep_allowed(F.trim(p), preset))
    rows = docs.select(F.col(source).alias("source"), F.col(doc_id).alias("doc_id"), F.posexplode(pieces).alias("pos", "text"))
    rows = rows.where(acceptable(F.col("text"), preset) if strict else F.length("text") > 0)
    first = rows.groupBy("source", "text").agg(F.min(F.struct("doc_id", "pos")).alias("at"))
    return first.select("source", "text", F.col("at.doc_id").alias("doc_id"), F.col("at.pos").cast("long").alias("pos"))


def join_tokens(utterances: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Words of an array of structs, joined without a separator, as column text."""
    return utterances.withColumn("text", F.array_join(F.transform(F.col(tokens), lambda t: t["word"]), ""))


def first_articles(articles: DataFrame, ord_: str, max_articles: int) -> DataFrame:
    """The first articles, whole rows; those of a key that the cut falls on all stay. capped needs sentences of no others."""
    return articles.join(F.broadcast(articles.select(ord_).orderBy(ord_).limit(max_articles).distinct()), ord_, "left_semi")


def capped(articles: DataFrame, ord_: str, max_articles: int, found: DataFrame, sentence_cap: int) -> DataFrame:
    """Sentences (ord, ...) of the first articles, up to and with the article that reaches the cap.

    Counts are summed per article before the running sum, whose window holds one row per article read.
    """
    from pyspark.sql.window import Window

    firsts = articles.select(ord_).orderBy(ord_).limit(max_articles)
    per = found.groupBy(ord_).agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.orderBy(ord_).rowsBetween(Window.unboundedPreceding, -1))
    kept = per.join(firsts, ord_, "left_semi").withColumn("before", F.coalesce(upto, F.lit(0))).where(F.col("before") < sentence_cap)
    return found.join(kept.select(ord_), ord_, "left_semi")


def char_frequency(rows: DataFrame, text: str = "text", keep: Column | None = None, preset: Preset | None = None, by: list[str] | None = None) -> DataFrame:
    """(by..., ch, freq) over all characters of text; null and empty texts have none.

    Words, each with the space after it, are counted first, so that characters are told apart once per different word.
    """
    words = rows.select(*(by or []), F.explode(F.split(F.col(text), "(?<= )", -1)).alias("_word")).groupBy(*(by or []), "_word").agg(F.count("*").alias("_times"))
    out = words.select(*(by or []), "_times", F.explode(chars(F.col("_word"))).alias("ch"))
    if preset is not None:
        out = out.where(is_letter(F.col("ch"), preset))
    if keep is not None:
        out = out.where(keep)
    return out.groupBy(*(by or []), "ch").agg(F.sum("_times").alias("freq"))


def concatenated(**sources: DataFrame) -> DataFrame:
    """Rows of all sources, each with its name as source; columns that a source lacks are null."""
    out = None
    for name, rows in sources.items():
        rows = rows.withColumn("source", F.lit(name))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def heaviest(rows: DataFrame, key: str, weight: str, order: str, *more: str) -> DataFrame:
    """(key, weight, order, more..., first) of the row of greatest weight per key, the first of equals; first: where the key stood first."""
    best = rows.groupBy(key).agg(F.max_by(F.struct(weight, order, *more), F.struct(F.col(weight), -F.col(order))).alias("m"), F.min(order).alias("first"))
    return best.select(key, "m.*", "first")


def first_example(rows: DataFrame, key: str, value: str, order: list[str]) -> DataFrame:
    """(key, example): value of the first row of each key."""
    return rows.groupBy(key).agg(F.min_by(value, F.struct(*order)).alias("example"))


def lexicon(lines: DataFrame, preset: Preset) -> tuple[DataFrame, DataFrame]:
    """(single characters, words) of (word, romanisation, weight, ord), each with its heaviest reading."""
    best = heaviest(lines, "word", "weight", "ord", "romanisation")
    single = (F.length("word") == 1) & is_letter(F.col("word"), preset)
    return best.where(single), best.where(word_entry(F.col("word"), preset))


def licences(sentences_: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows of sources that gave sentences."""
    return sources.join(sentences_.select("source").distinct(), "source", "left_semi")


def marker_density(freq: DataFrame, markers: list[str], by: str) -> DataFrame:
    """(by, marked, total, density): share of marker characters among all."""
    marked = F.sum(F.when(F.col("ch").isin(markers), F.col("freq")).otherwise(0))
    return freq.groupBy(by).agg(marked.alias("marked"), F.sum("freq").alias("total")).withColumn("density", F.col("marked") / F.col("total"))
