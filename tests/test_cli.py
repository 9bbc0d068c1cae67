import numpy as np
import pytest

from inkwright import __main__ as cli
from inkwright.functions.text import LATIN
from inkwright.operators import render
from inkwright.sources import readers


@pytest.fixture
def run(spark, monkeypatch):
    monkeypatch.setattr(cli, "session", lambda master=None: spark)
    return lambda *argv: cli.main(list(argv))


def test_a_second_score_adds_no_rows(spark, tmp_path, run):
    rows = [("m", "a.jpg", "日本", "日本", "char", ""), ("m", "b.jpg", "香港", "香", "word", "timed out")]
    frame = spark.createDataFrame(rows, "model string, file string, gt string, prediction_raw string, tier string, error string")
    frame.write.parquet(f"{tmp_path}/p")
    for _ in range(2):
        assert run("score", "--predictions", f"{tmp_path}/p", "--out", f"{tmp_path}/s") == 0
    assert spark.read.parquet(f"{tmp_path}/s").count() == 2
    run("score", "--predictions", f"{tmp_path}/p", "--out", f"{tmp_path}/s", "--no-resume")
    assert spark.read.parquet(f"{tmp_path}/s").count() == 2


def test_report_leaves_failed_rows_out_unless_asked(spark, tmp_path, run, capsys):
    rows = [("m", "char", 0.0, 1.0, 1.0, 1.0, ""), ("m", "char", 1.0, 0.0, 0.0, 0.0, "timed out")]
    frame = spark.createDataFrame(rows, "model string, tier string, cer_clipped double, acc double, ned_sim double, f1 double, error string")
    frame.write.parquet(f"{tmp_path}/s")
    run("report", "--scores", f"{tmp_path}/s")
    assert "|m    |char|1  |" in capsys.readouterr().out
    run("report", "--scores", f"{tmp_path}/s", "--with-errors")
    assert "|m    |char|2  |" in capsys.readouterr().out
    frame.drop("error").write.parquet(f"{tmp_path}/t")
    run("report", "--scores", f"{tmp_path}/t")
    assert "|m    |char|2  |" in capsys.readouterr().out


def test_readers_keep_list_order_and_scripts(spark, tmp_path):
    (tmp_path / "b.yaml").write_text("name: x\n...\n有\tjau5\t10%\n", encoding="utf-8")
    (tmp_path / "a.yaml").write_text("name: x\n...\n有\tjau6\t10%\n", encoding="utf-8")
    got = readers.lexicon(spark, [f"{tmp_path}/b.yaml", f"{tmp_path}/a.yaml"]).orderBy("ord").collect()
    assert [r.romanisation for r in got] == ["jau5", "jau6"]
    assert readers.lexicon(spark, []).collect() == []
    (tmp_path / "chars").write_text("有a1。\n", encoding="utf-8")
    of = lambda **more: {r.ch for r in readers.char_lines(spark, f"{tmp_path}/chars", **more).collect()}
    assert of() == {"有"} and of(preset=LATIN) == {"a"} and of(preset=None) == set("有a1。")
    assert readers.json_document(spark, f"{tmp_path}/none.json", "a int").collect() == []


def test_homography_takes_corners_to_corners():
    a, b = np.array([(0, 0), (9, 0), (9, 4), (0, 4)], float), np.array([(1, 0.5), (8, -1), (10, 5), (-0.5, 3)])
    p = render.homography(a, b)
    for (x, y), (u, v) in zip(a, b, strict=True):
        z = p[6] * x + p[7] * y + 1
        assert np.allclose(((p[0] * x + p[1] * y + p[2]) / z, (p[3] * x + p[4] * y + p[5]) / z), (u, v))
