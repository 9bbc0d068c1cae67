import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from inkwright.operators import browse, charset, corpus, evals, fonts, images, qa
from inkwright.plans import planner
from inkwright.sources import readers, sinks
from inkwright.functions.text import HAN
from inkwright.streaming import resume


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_charset_funnel_and_tags(spark):
    freq = spark.createDataFrame([("嘅", 9), ("的", 9), ("鯛", 9), ("綫", 9), ("稀", 2), ("咗", 5)], "ch string, freq long")
    one = lambda s: spark.createDataFrame([(c,) for c in s], "ch string")
    standard, foreign, excluded = one("的咗"), one("鯛"), one("綫")
    reasons = dict(rows(charset.funnel_reason(freq, standard, foreign, excluded, 3).select("ch", "reason")))
    assert reasons == {"嘅": "kept", "的": "standard", "鯛": "foreign", "綫": "excluded", "稀": "low_freq", "咗": "standard"}
    forced = spark.createDataFrame([("嘅", 1, "core"), ("咗", 1, "core"), ("嘅", 3, "pair"), ("𨋢", 2, "ext"), ("綫", 4, "manual")], "ch string, ord int, tag string")
    got = rows(charset.derive(freq, standard, foreign, excluded, forced, 3))
    assert got == sorted([("嘅", 9, "BMP", "diff+core+pair"), ("咗", 5, "BMP", "core"), ("𨋢", 0, "ExtB+", "ext")], key=str)


def test_sentences_first_seen_once_per_source(spark):
    docs = spark.createDataFrame([(1, "a", "我哋今日飲茶。我哋今日飲茶！好"), (2, "a", "我哋今日飲茶"), (3, "b", "我哋今日飲茶"), (4, "b", None)], "doc_id long, source string, text string")
    assert rows(corpus.sentences(docs, HAN)) == [("a", "我哋今日飲茶", 1, 0), ("b", "我哋今日飲茶", 3, 0)]
    spoken = spark.createDataFrame([(1, [("唔", ), ("-好", ), ("啦你", )])], "doc_id long, tokens array<struct<word string>>")
    whole = corpus.sentences(corpus.join_tokens(spoken).withColumn("source", F.lit("s")), HAN, split=False)
    assert rows(whole) == [("s", "唔好啦你", 1, 0)]


def test_heaviest_first_of_ties(spark):
    df = spark.createDataFrame([("a", 1.0, 0, "x"), ("a", 2.0, 1, "y"), ("a", 2.0, 2, "z"), ("b", 0.0, 3, "w")], "word string, weight double, ord long, romanisation string")
    assert rows(corpus.heaviest(df, "word", "weight", "ord", "romanisation").select("word", "romanisation", "first")) == [("a", "y", 0), ("b", "w", 3)]


def test_capped_reads_whole_articles(spark):
    articles = spark.createDataFrame([(i,) for i in range(10)], "ord long")
    found = spark.createDataFrame([(i, f"s{j}") for i in range(10) for j in range(3)], "ord long, text string")
    assert corpus.capped(articles, "ord", 5, found, 7).count() == 9
    assert corpus.capped(articles, "ord", 2, found, 100).count() == 6


def test_first_articles_leave_others_uncut(spark):
    articles = spark.createDataFrame([(i // 2, "x" if i < 8 else "bad") for i in range(12)], "ord long, text string")
    fails = F.when(F.col("text") == "bad", F.raise_error(F.lit("read"))).otherwise(F.col("text"))
    got = corpus.first_articles(articles, "ord", 3).withColumn("text", fails)
    assert rows(got) == [(0, "x"), (0, "x"), (1, "x"), (1, "x")]


def test_human_sizes_beyond_a_long(spark, tmp_path):
    from fractions import Fraction

    from inkwright import queries as Q

    keys = [0, 10, 11, 100, 1000, 10000, 2097151, 2097152, 6379940, 8999999, 10**9, None]
    spark.createDataFrame([(k,) for k in keys], "o_orderkey long").write.parquet(f"{tmp_path}/orders.parquet")

    def size(k):
        if k is None:
            return None
        power = next((p for p in range(4) if k**3 < 1024 ** (p + 1)), 4)
        return f"{float(round(Fraction(k**3, 1024**power) * 10)) / 10:.1f} {['B', 'KB', 'MB', 'GB', 'TB'][power]}"

    assert {r.o_orderkey: r["size"] for r in Q.queries()["human_sizes"](spark, str(tmp_path)).collect()} == {k: size(k) for k in keys}


def test_tasks_grow_with_rows(spark):
    for n in (20_000, 100_000):
        got = planner.dealt(spark.range(n), "id", 1000).distinct().groupBy(F.spark_partition_id()).count().agg(F.count("*").alias("tasks"), F.max("count").alias("most")).first()
        assert got.tasks == n // 1000 and got.most < 1500


def test_font_coverage(spark):
    cmap = spark.createDataFrame([("f1", "A", ord(c)) for c in "冇有"] + [("f2", "B", ord(c)) for c in "冇"], "font_key string, family string, cp int")
    texts = spark.createDataFrame([("冇有",), ("冇",), ("冇冇",), ("𨋢",)], "text string")
    assert rows(fonts.covering(texts, cmap)) == [("冇", "f1"), ("冇", "f2"), ("冇冇", "f1"), ("冇冇", "f2"), ("冇有", "f1")]
    assert rows(fonts.unrenderable(texts, cmap)) == [("𨋢",)]
    assert dict(rows(fonts.probe_coverage(cmap, [ord("冇"), ord("有")]))) == {"f1": 1.0, "f2": 0.5}
    maps = spark.createDataFrame([("f2", [ord("冇")])], "font_key string, cmap array<int>")
    used = spark.createDataFrame([("有冇有", "f2"), ("有", "unknown")], "text string, font_key string")
    assert rows(fonts.missing(used, maps).select("text", "missing")) == [("有冇有", "有有")]
    axis = spark.createDataFrame([("v", 350, 750), ("s", 0, 0)], "font_key string, axis_lo int, axis_hi int")
    assert rows(fonts.expand_weights(axis, [300, 400, 500, 700, 900]).select("font_key", "variation")) == [("s", None), ("v", 400), ("v", 500), ("v", 700)]


def test_pairs_with_a_character_on_both_sides(spark):
    pairs = spark.createDataFrame([("係", "系"), ("喺", "係")], "target string, confusable string")
    texts = spark.createDataFrame([("係",), ("系",), ("喺",), ("好",)], "text string")
    got = {r.text: (r.pair_with, r.pair_role) for r in evals.tag_pairs(texts, pairs).collect()}
    assert got == {"係": ("系", "target"), "系": ("係", "confusable"), "喺": ("係", "target"), "好": (None, None)}


def test_plan_of_sentences_splits_as_the_budget_asks(spark):
    """Two sources of enough sentences, 3 renders each, half of 2000 for each: 1002 rows of the first, cut to 998 of the second."""
    items = spark.createDataFrame([(s, i, 3) for s in ("hk", "wiki") for i in range(700)], "source string, item long, renders int")
    kept = planner.fill_budget(items, "renders", 1000, [qa.hash_order("1", "item")], ["source"])
    per = {r.source: r.n for r in kept.groupBy("source").agg(F.sum("renders").alias("n")).collect()}
    assert per == {"hk": 1002, "wiki": 1002}
    renders = kept.withColumn("render", F.explode(F.sequence(F.lit(0), F.col("renders") - 1)))
    cut = planner.dense_index(renders, ["source", "item", "render"]).where("idx < 2000")
    assert dict(rows(cut.groupBy("source").count())) == {"hk": 1002, "wiki": 998}


def test_plan_of_characters_has_169_items_seven_times(spark):
    items = spark.createDataFrame([(f"c{i}",) for i in range(169)], "text string")
    covering = items.crossJoin(spark.createDataFrame([(f"f{i}", f"fam{i % 5}") for i in range(12)], "font string, family string"))
    plan = planner.uniform(items, covering, "text", "family", "font", 1200, 169, "s")
    assert plan.count() == 1183
    families = plan.groupBy("text").agg(F.count_distinct("family").alias("n")).agg(F.min("n")).first()[0]
    assert families == 5
    assert planner.scaled({"char": 1200, "word": 1800, "sentence": 2000}, 500) == {"char": 120, "word": 180, "sentence": 200}


def test_draw_is_near_its_shares(spark):
    df = spark.range(20000).select(planner.draw(planner.unit("x", "id")).alias("d")).groupBy("d").count()
    got = {r.d: r["count"] / 20000 for r in df.collect()}
    assert all(abs(got[k] - w) < 0.02 for k, w in planner.DIFFICULTIES)


def test_dense_index_and_stages(spark):
    ids = list(range(500))
    random.Random(1).shuffle(ids)
    df = spark.createDataFrame([(i, i % 3) for i in ids], "k long, g long").repartition(7)
    assert rows(planner.dense_index(df, ["k"]).select("k", "idx")) == sorted([(i, i) for i in range(500)], key=str)
    picked = planner.staged_pick(df, [(F.lit(True), ["g"], 2, [F.asc("k")]), (F.col("g") == 0, ["g"], 2, [F.asc("k")])], "k")
    assert sorted(r.k for r in picked.collect()) == [0, 1, 2, 3, 4, 5, 6, 9]
    tiers = planner.tiers_in_order(char=df.limit(2), word=df.limit(1).drop("g"))
    assert sorted(r.tier_ord for r in tiers.collect()) == [0, 0, 1]


def test_resume_and_errors(spark):
    models = spark.createDataFrame([("m1",), ("m2",)], "model string")
    records = spark.createDataFrame([("a",), ("b",)], "file string")
    log = spark.createDataFrame([("m1", "a", "", 1), ("m1", "b", "timeout", 2), ("m2", "a", "timeout", 3), ("m2", "a", None, 4), ("m2", "a", "", 5)], "model string, file string, error string, n int")
    assert rows(evals.pending(models, records, log)) == [("m1", "b"), ("m2", "b")]
    assert rows(evals.latest_success(log, "n").select("model", "file", "n")) == [("m1", "a", 1), ("m2", "a", 5)]
    assert evals.with_errors(log, False).count() == 3 and evals.with_errors(log, True).count() == 5

    def stub(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([None if f == "a" else "bad" for f in b.column(1).to_pylist()], pa.string())], ["model", "error"])

    out = evals.infer(evals.pending(models, records, log.limit(0)).select("model", "file"), stub, "model string, error string")
    assert rows(out.groupBy("error").count()) == [("bad", 2), (None, 2)]


def test_streamed_runs_resume(spark, tmp_path):
    source, results = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([("a",), ("b",)], "file string").write.parquet(source)
    models = spark.createDataFrame([("m",)], "model string")
    schema = "model string, file string, error string, batch long"
    process = lambda df: df.withColumn("error", F.when(F.col("file") == "b", "x"))
    for _ in range(2):
        resume.run(resume.article_stream(spark, source, "file string"), models, process, results, str(tmp_path / "ck"), schema).awaitTermination()
    assert rows(spark.read.schema(schema).parquet(results).select("file", "error")) == [("a", None), ("b", "x")]
    spark.createDataFrame([("a",), ("c",)], "file string").write.mode("append").parquet(source)
    resume.run(resume.article_stream(spark, source, "file string"), models, process, results, str(tmp_path / "ck"), schema).awaitTermination()
    assert rows(resume.current(spark, results, schema).select("file")) == [("a",), ("c",)]
    assert spark.read.schema(schema).parquet(results).count() == 3
    resume.retry(spark.read.parquet(source).distinct(), models, lambda df: df.withColumn("error", F.lit(None).cast("string")), results, schema)
    assert rows(resume.current(spark, results, schema).select("file")) == [("a",), ("b",), ("c",)]


def test_pairing_and_sizes(spark):
    f = lambda *r: spark.createDataFrame(list(r), "file string, text string")
    got = {r.file: (r.on_disk, r.in_metadata, r.in_labels, r.mismatch) for r in qa.pairing(f(("a", ""), ("b", ""), ("d", "")), f(("a", "x"), ("b", "x"), ("c", "x")), f(("a", "x"), ("b", "y"))).collect()}
    assert got == {"b": (True, True, True, True), "c": (False, True, False, False), "d": (True, False, False, False)}
    sizes = spark.createDataFrame([(48, 8), (47, 100), (48, 7)], "height int, width int")
    assert qa.size_faults(sizes).count() == 2


def test_quantiles_equal_numpy(spark):
    rng = random.Random(3)
    data = [(g, None if rng.random() < 0.1 else float(rng.randrange(40))) for g in (None, "a", "b") for _ in range(300)] + [("one", 7.0), ("none", None)]
    df = spark.createDataFrame(data, "g string, v double").repartition(5)
    got = {r.g: r for r in qa.exact_quantiles(df, F.col("v"), {"q0": 0.0, "q1": 0.013, "q2": 0.5, "q3": 1.0}, ["g"]).collect()}
    for g in (None, "a", "b", "one"):
        want = np.quantile([v for k, v in data if k == g and v is not None], [0.0, 0.013, 0.5, 1.0])
        assert np.allclose([got[g][f"q{i}"] for i in range(4)], want)
    assert got["none"].q2 is None and len(got) == 5
    assert qa.quantiles(df, F.col("v")).collect()[0].median == np.median([v for _, v in data if v is not None])
    assert qa.quantiles(df.limit(0), F.col("v"), ["g"]).collect() == []


def test_models_are_bounded(spark):
    many = spark.range(evals.MODELS + 1).select(F.col("id").cast("string").alias("model"))
    records, log = spark.createDataFrame([("a",)], "file string"), spark.createDataFrame([], "model string, file string, error string")
    with pytest.raises(ValueError):
        evals.pending(many, records, log)
    assert evals.pending(many.limit(0), records, log).collect() == []


def test_browser(spark):
    df = spark.createDataFrame([(i, "m", "sentence", "hard", f"g{i}", "p", float(i % 2), i / 10, 5, None) for i in range(130)], "ord int, model string, tier string, difficulty string, gt string, prediction string, acc double, cer_clipped double, n_chars int, minimal_pair_with string")
    assert browse.matching(df, correctness="correct").count() == 65
    assert browse.matching(df, query="g12").count() == 11 and browse.matching(df, pair="pair").count() == 0
    assert [r.ord for r in browse.page(df, 99, "default", ["ord"]).collect()] == list(range(120, 130))
    assert browse.page(df, 0, "cer_desc", ["ord"]).first().ord == 129
    assert browse.page(df.limit(0), 3, "default", ["ord"]).collect() == []
    assert browse.card(df).where("wide and ok").count() == 65
    kinds = spark.createDataFrame([("char", "ExtA", None), ("char", "BMP", "x")], "tier string, plane string, pair_with string")
    assert browse.samples(kinds, plane="ext").count() == 1 and browse.samples(kinds, plane="pair").count() == 1


def test_image_metrics(spark):
    flat, lines = np.full((48, 100), 120, np.uint8), np.full((48, 100), 240, np.uint8)
    lines[10:38:6, 5:95] = 20
    assert images.ink_ratio(flat) == 0 and images.contrast(flat) == 0
    assert images.ink_ratio(lines) > 0.05 and images.contrast(lines) == 220
    data = [(0, flat.tobytes(), 48, 100), (1, lines.tobytes(), 48, 100), (2, b"x", 48, 100), (3, None, None, None)]
    df = spark.createDataFrame(data, "idx long, pixels binary, height int, width int")
    got = {r.idx: r for r in images.measure(df).withColumn("gate", qa.gate(F.col("ink_ratio"), F.col("contrast"))).collect()}
    assert [got[i].gate for i in range(2)] == ["ink", None] and got[2].error == got[3].error == "unreadable"
    a, b = (sorted(map(tuple, images.measure(df.limit(2).repartition(n), 7, 9.0).collect())) for n in (1, 2))
    assert a == b
    assert images.resized(lines).shape == (48, 100) and images.resized(np.zeros((96, 4), np.uint8)).shape == (48, 8)
    rng = images.generator(1, 2)
    assert images.color_contrast(np.zeros((4, 4, 3), np.uint8), rng, (0.9, 1.1)).shape == (4, 4, 3)


def test_readers_and_sinks(spark, tmp_path):
    (tmp_path / "dict.yaml").write_text("name: x\n...\n# c\n\n佢\tkeoi5\t50%\n佢\tkeoi6\tx%\n好\n", encoding="utf-8")
    got = rows(readers.lexicon(spark, str(tmp_path / "dict.yaml")).select("word", "romanisation", "weight"))
    assert got == [("佢", "keoi5", 50.0), ("佢", "keoi6", 0.0), ("好", "", 0.0)]
    (tmp_path / "chars").write_text("# head\n冇\n\n有 # 嘅\n", encoding="utf-8")
    assert rows(readers.char_lines(spark, str(tmp_path / "chars"), "any")) == [("冇",), ("有",)]
    (tmp_path / "labels").write_text("a.jpg\tx\ty\nno tab\n", encoding="utf-8")
    assert rows(readers.label_lines(spark, str(tmp_path / "labels"))) == [("a.jpg", "x\ty")]
    (tmp_path / "m.jsonl").write_text('{"file": "a"}\n\n{"file": "b", "text": "t"}\n', encoding="utf-8")
    assert rows(readers.jsonl(spark, str(tmp_path / "m.jsonl"), "file string, text string")) == [("a", None), ("b", "t")]
    (tmp_path / "e.csv").write_text('file,gt\na,"x ""q""\ny"\n', encoding="utf-8")
    assert rows(readers.eval_csv(spark, str(tmp_path / "e.csv"))) == [("a", 'x "q"\ny')]
    for n in ("a.jpg", "b.JPG", "c.png"):
        (tmp_path / n).write_bytes(b"12")
    assert rows(readers.listing(spark, str(tmp_path))) == [("a.jpg", 2), ("b.JPG", 2)]
    df = spark.createDataFrame([(1, True, "b", "t2", None), (0, True, "a", "t1", None)], "idx int, ok boolean, file string, text string, contrast double")
    sinks.label_lines(df, str(tmp_path / "out.tsv"))
    assert [r.value for r in spark.read.text(str(tmp_path / "out.tsv")).collect()] == ["a\tt1", "b\tt2"]
    sinks.metadata_lines(df, str(tmp_path / "meta"))
    assert spark.read.json(str(tmp_path / "meta")).columns == ["file", "text"]
    sinks.packaged(df, str(tmp_path / "pq"), {"file": "string", "contrast": "double"})
    assert spark.read.parquet(str(tmp_path / "pq")).dtypes == [("file", "string"), ("contrast", "double")]
    assert sinks.json_array(df, ["file"], [F.col("idx")]) == '[{"file":"a"},{"file":"b"}]'
    assert sinks.failures(df.withColumns({"ok": F.lit(False), "error": F.lit("e")}), 1).count() == 1
    have, lost = sinks.image_set(df, spark.createDataFrame([("a", 1)], "file string, length int"))
    assert rows(have) == [("a", 1)] and rows(lost) == [("b",)]
    assert sinks.flattened({"a": {"b": "x\n"}, "c": 1}) == {"a.b": "x", "c": "1"}
    assert sinks.resolved({"a": "{{b}}!", "b": "{{ c }}", "c": "z"}) == {"a": "z!", "b": "z", "c": "z"}
    with pytest.raises(ValueError):
        sinks.resolved({"a": "{{b}}", "b": "{{a}}"})
    sinks.append_results(df.withColumn("model", F.lit("m")), str(tmp_path / "res"))
    assert readers.json_document(spark, str(tmp_path / "m.jsonl")) is not None
