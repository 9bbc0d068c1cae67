"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line of seconds."""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))
os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")

from inkwright import queries as own  # noqa: E402
from inkwright.session import session  # noqa: E402

HEADLINE = (
    "charset_derivation", "acceptable_sentences", "char_frequency", "charset_review", "score_rows", "eval_summary", "pair_hit_table", "postprocess_output",
    "cover_join", "missing_glyphs", "resume_pending", "latest_success", "distribution_share", "doc_frequency_rare", "round_robin", "source_balanced",
    "max_weight_dedup", "difficulty_draw", "showcase_pick", "dense_index", "stats_report", "contrast_gate",
)


#: Images of the rendering benchmark: the published runs of this kind of work are of about 5,000.
IMAGES = 5000


def render_seconds(spark) -> float:
    """Seconds to render IMAGES lines of 6 to 13 made-up glyphs at four difficulties."""
    import numpy as np
    from pyspark.sql import functions as F

    from inkwright.operators import render

    rng = np.random.default_rng(1)
    letters = "abcdefghijklmnopqrstuvwxyz"
    pool = {}
    for c in letters:
        g = np.zeros((40, 30), np.uint8)
        for y, x in rng.integers(2, 22, (4, 2)):
            g[y : y + 4, 3:27] = 255
            g[3:37, x : x + 4] = 255
        pool[c] = g
    level = F.element_at(F.array(*map(F.lit, render.LEVELS)), (F.col("id") % len(render.LEVELS) + 1).cast("int"))
    text = F.substring(F.translate(F.md5(F.col("id").cast("string")), "0123456789", "ghijklmnop"), 1, 6 + (F.col("id") % 8).cast("int"))
    plan = spark.range(IMAGES).select(F.col("id").alias("idx"), text.alias("text"), F.lit("f").alias("font_key"), level.alias("difficulty"))
    start = time.perf_counter()
    render.render(plan, {"f": pool}, 1, spark.sparkContext.defaultParallelism).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = session(f"local[{cpus}]", int(cpus), **{"spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    catalogue = own.queries()
    catalogue["char_frequency"](spark, sf_dir).count()  # starts the JVM's compiler and the Python workers
    took = {}
    for name in HEADLINE:
        start = time.perf_counter()
        catalogue[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - start, 3)
    took["render_5000_images"] = round(render_seconds(spark), 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": Path(sf_dir).name.removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
