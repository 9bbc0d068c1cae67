import random

import pytest
from pyspark.sql import functions as F

from inkwright.__main__ import main
from inkwright.plans import build, planner

CHARS = "嘅咗佢哋喺乜嘢嚟啲嗰"


@pytest.fixture(scope="module")
def parts(spark):
    rnd = random.Random(1)
    charset = spark.createDataFrame([(c, 10, "diff") for c in CHARS] + [("𨋢", 0, "ext")], "ch string, freq long, source string")
    line = lambda: "".join(rnd.choice(CHARS + "我好人") for _ in range(8))
    sentences = spark.createDataFrame(sorted({(s, line()) for s in ("wiki", "talk") for _ in range(60)}), "source string, text string")
    words = spark.createDataFrame([("lex", a + b) for a in CHARS for b in "人𠮟"], "source string, text string")
    pairs = spark.createDataFrame([("嘅", "既", 0), ("佢", "但", 1), ("喺", "係", 2)], "target string, confusable string, ord int")
    cmap = [(f"f{i}", f"fam{i % 3}", ord(c)) for i in range(6) for c in CHARS + "我好人既但係" if not (i == 5 and c == "嘅")]
    return charset, words, sentences, pairs, spark.createDataFrame(cmap, "font_key string, family string, cp int")


def test_plan_keeps_budgets_coverage_and_order(spark, parts):
    sizes = {"char": 60, "word": 20, "sentence": 40}
    plan = [r.asDict() for r in build.build_plan(*parts, sizes=sizes, seed=3).collect()]
    again = [r.asDict() for r in build.build_plan(*(p.repartition(3) for p in parts), sizes=sizes, seed=3).collect()]
    key = lambda r: r["idx"]
    assert sorted(plan, key=key) == sorted(again, key=key)
    assert sorted(r["idx"] for r in plan) == list(range(len(plan)))
    tiers = [r["tier"] for r in sorted(plan, key=key)]
    assert tiers == sorted(tiers, key=("char", "word", "sentence").index)
    n = {t: tiers.count(t) for t in sizes}
    # 11 + 3 items, four fonts each; the character that no font has gives none
    assert n == {"char": 13 * 4, "word": 20, "sentence": 40}
    assert not any(r["text"] == "𨋢" for r in plan) and [r.text for r in build.unrenderable(parts[0], parts[4]).collect()] == ["𨋢"]
    assert not any(r["font_key"] == "f5" and "嘅" in r["text"] for r in plan)
    assert not any("𠮟" in r["text"] for r in plan)
    assert all(any(c in CHARS for c in r["text"]) for r in plan if r["tier"] != "char")
    assert {r["minimal_pair_with"] for r in plan if r["text"] == "佢" and r["tier"] == "char"} == {"但"}
    by_source = {s: sum(r["source"] == s for r in plan if r["tier"] == "sentence") for s in ("talk", "wiki")}
    assert by_source == {"talk": 21, "wiki": 19}
    assert {r["difficulty"] for r in plan} <= {d for d, _ in planner.DIFFICULTIES}


def test_showcase(spark, parts):
    plan = build.build_plan(*parts, sizes={"char": 60, "word": 20, "sentence": 40}, seed=3)
    records = plan.withColumns({"file": F.concat_ws("_", "tier", "idx")})
    rows = build.showcase(records, parts[3], n_pairs=2, per_bucket=1).collect()
    assert len({r.file for r in rows}) == len(rows)
    assert {r.text for r in rows if r.stage == 0} == {"嘅", "既", "佢", "但"}
    assert {(r.pair_with, r.pair_role) for r in rows if r.text == "但"} == {("佢", "confusable")}
    assert {r.tier for r in rows} == {"char", "word", "sentence"}


def test_commands(spark, parts, tmp_path, capsys):
    p = lambda n: str(tmp_path / n)
    docs = spark.createDataFrame([(i, "a", "我哋今日飲茶嘅人好多。佢喺嗰度食嘢啲人" * 2) for i in range(4)], "doc_id long, source string, text string")
    docs.write.parquet(p("docs"))
    parts[3].write.parquet(p("pairs"))
    parts[4].write.parquet(p("fonts"))
    (tmp_path / "standard").write_text("# list\n我人好\n", encoding="utf-8")
    args = ["plan", "--documents", p("docs"), "--standard", p("standard"), "--fonts", p("fonts"), "--pairs", p("pairs"), "--out", p("plan"), "--total", "50"]
    assert main(args + ["--plan-only"]) == 0 and main(args) == 0
    assert spark.read.parquet(p("plan")).count() > 0
    spark.createDataFrame([("m", "char", "冇", "```\n冇\n```"), ("m", "word", "冇有", "有")], "model string, tier string, gt string, prediction_raw string").write.parquet(p("pred"))
    assert main(["score", "--predictions", p("pred"), "--out", p("scores")]) == 0
    assert main(["report", "--scores", p("scores")]) == 0
    assert "char" in capsys.readouterr().out
    (tmp_path / "img").mkdir()
    (tmp_path / "img" / "a.jpg").write_bytes(b"1")
    (tmp_path / "m.jsonl").write_text('{"file": "a.jpg", "text": "冇"}\n', encoding="utf-8")
    (tmp_path / "l.tsv").write_text("a.jpg\t冇\n", encoding="utf-8")
    check = ["verify", "--images", p("img"), "--metadata", p("m.jsonl"), "--labels", p("l.tsv")]
    assert main(check) == 0
    (tmp_path / "l.tsv").write_text("a.jpg\t有\n", encoding="utf-8")
    assert main(check) == 1


@pytest.mark.parametrize("covered", [40, 3])
def test_only_first_texts_meet_the_fonts(spark, monkeypatch, covered):
    import hashlib

    texts = [f"w{i:02d}" for i in range(40)]
    texts.sort(key=lambda t: hashlib.sha256(f"1|s|{t}".encode()).hexdigest())
    good, met = texts[-covered:], []
    cmap = spark.createDataFrame([("f", "f", 1)], "font_key string, family string, cp int")

    def fonts_for(rows, cmap, n, seed):
        met.append(rows.count())
        return rows.where(F.col("text").isin(good)).select("text", F.lit("f").alias("font_key"), F.lit(1).alias("pick")).distinct()

    monkeypatch.setattr(build, "fonts_for", fonts_for)
    monkeypatch.setattr(build, "FIRST", 4)
    df = spark.createDataFrame([("s", t) for t in texts], "source string, text string")
    for by_source in (False, True):
        met.clear()
        got = {r.text for r in build.text_tier(df, cmap, 2, "1", by_source).collect()}
        assert got == set(good[:2])
        assert met == ([4] if covered == 40 else [4, 16, 40])
