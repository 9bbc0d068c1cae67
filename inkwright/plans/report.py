"""What was built: counts, a report as JSON and a card as Markdown."""

from __future__ import annotations

import json
from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwright.sources.sinks import failures as first_failures
from inkwright.sources.sinks import size_bucket

SECTIONS = {"by_tier": "tier", "by_difficulty": "difficulty", "by_source": "source"}


def counts(records: DataFrame) -> DataFrame:
    """(section, key, n): records by tier, difficulty and source, single characters by plane, and all of them under images.

    Null keys count as "-". No records: no rows but those of distinct texts and fonts, which are 0.
    """
    keys = [F.struct(F.lit(s).alias("section"), F.coalesce(F.col(c), F.lit("-")).alias("key")) for s, c in SECTIONS.items()]
    keys.append(F.struct(F.lit("images").alias("section"), F.lit("all").alias("key")))
    plane = F.struct(F.lit("by_plane").alias("section"), F.coalesce("plane", F.lit("-")).alias("key"))
    each = F.when(F.col("tier") == "char", F.array(*keys, plane)).otherwise(F.array(*keys))
    by = records.select(F.explode(each).alias("k")).groupBy("k.section", "k.key").agg(F.count("*").alias("n"))
    # texts stand as hashes, which is all that is shuffled of them
    sizes = records.select(F.sha2(F.col("text"), 256).alias("t"), F.col("font").alias("f")).agg(F.count_distinct("t").alias("t"), F.count_distinct("f").alias("f"))
    sizes = sizes.select(F.explode(F.array(F.struct(F.lit("texts").alias("key"), F.col("t").alias("n")), F.struct(F.lit("fonts").alias("key"), F.col("f").alias("n")))).alias("s"))
    return by.unionByName(sizes.select(F.lit("distinct").alias("section"), "s.key", "s.n"))


def build_report(records: DataFrame, failed: DataFrame, unrenderable: DataFrame, settings: dict, most: int = 200) -> dict:
    """A nested report: settings, counts, characters that no font has, and the first failures (idx, text, error).

    Only counts, at most a charset and `most` failures reach the driver.
    """
    by: dict[str, dict[str, int]] = defaultdict(dict)
    for r in counts(records).collect():
        by[r.section][r.key] = r.n
    stats = {
        "n_images": by["images"].get("all", 0),
        "n_failed": failed.count(),
        **{s: dict(sorted(by[s].items())) for s in (*SECTIONS, "by_plane")},
        "n_distinct_texts": by["distinct"]["texts"],
        "n_fonts_used": by["distinct"]["fonts"],
    }
    lost = [r.text for r in unrenderable.select("text").orderBy("text").collect()]
    rows = first_failures(failed.withColumn("ok", F.lit(False)), most).collect()
    return settings | {"stats": stats | {"n_unrenderable_chars": len(lost)}, "unrenderable_chars": lost, "failures": [r.asDict() for r in rows]}


def as_json(report: dict) -> str:
    return json.dumps(report, ensure_ascii=False, indent=2)


def card(report: dict, name: str, licence: str, scores: list[dict] | None = None) -> str:
    """A data set card: front matter, a table for each count, and scores by model and tier, TBD where there are none."""
    stats = report["stats"]
    out = ["---", f"license: {licence}", f"pretty_name: {name}", "size_categories:", f"- {size_bucket(stats['n_images'])}", "---", "", f"# {name}", ""]
    out += [f"{stats['n_images']:,} images of {stats['n_distinct_texts']:,} texts in {stats['n_fonts_used']:,} fonts; {stats['n_failed']:,} failed.", ""]
    for section in (*SECTIONS, "by_plane"):
        out += [f"| {section.removeprefix('by_')} | images |", "|-|-|", *(f"| {k} | {n:,} |" for k, n in stats[section].items()), ""]
    out += ["| model | tier | n | CER | ACC | 1-NED | F1 |", "|-|-|-|-|-|-|-|"]
    shown = lambda v: "TBD" if v is None else f"{v:.4f}"
    for s in scores or [{"model": "-", "tier": "all", "n": 0}]:
        out.append(f"| {s['model']} | {s['tier']} | {s['n']:,} | " + " | ".join(shown(s.get(m)) for m in ("cer_clipped", "acc", "ned_sim", "f1")) + " |")
    return "\n".join(out) + "\n"
