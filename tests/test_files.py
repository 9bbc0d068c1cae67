"""Font files, images, packaging and the commands that read and write them."""

import base64
import json
import struct
import threading
import zlib
from http.server import BaseHTTPRequestHandler, HTTPServer

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkwright import __main__ as cli
from inkwright.functions import picture
from inkwright.more_queries import _font_file
from inkwright.operators import browse, evals, fonts, qa
from inkwright.plans import report
from inkwright.sources import readers, sfnt, sinks


@pytest.fixture
def run(spark, monkeypatch):
    monkeypatch.setattr(cli, "session", lambda master=None: spark)
    return lambda *argv: cli.main([str(a) for a in argv])


def filtered(a: np.ndarray) -> bytes:
    """a as a PNG file whose lines go through all five filters in turn."""
    h, w, n = a.shape
    raw, above = b"", np.zeros(w * n, int)
    for y in range(h):
        line = a[y, :, ::-1].reshape(-1).astype(int)
        left = np.concatenate([np.zeros(n, int), line[:-n]])
        corner = np.concatenate([np.zeros(n, int), above[:-n]])
        p = left + above - corner
        d = [abs(p - left), abs(p - above), abs(p - corner)]
        paeth = np.where((d[0] <= d[1]) & (d[0] <= d[2]), left, np.where(d[1] <= d[2], above, corner))
        guess = [0 * line, left, above, (left + above) // 2, paeth][y % 5]
        raw += bytes([y % 5]) + ((line - guess) % 256).astype(np.uint8).tobytes()
        above = line
    chunk = lambda tag, body: struct.pack(">I", len(body)) + tag + body + struct.pack(">I", zlib.crc32(tag + body))
    return picture.SIGN + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def test_png_round_trip_and_filters():
    rng = np.random.default_rng(1)
    for a in (rng.integers(0, 256, (7, 11), np.uint8), rng.integers(0, 256, (13, 5, 3), np.uint8), np.zeros((1, 1), np.uint8)):
        assert np.array_equal(picture.decode(picture.encode(a)), a)
    a = rng.integers(0, 256, (10, 9, 3), np.uint8)
    assert np.array_equal(picture.decode(filtered(a)), a)
    whole = picture.encode(a)
    for bad in (b"", b"GIF89a", whole[:60], whole[:-30], picture.SIGN):
        with pytest.raises(ValueError):
            picture.decode(bad)


def test_png_columns(spark):
    data = [(1, bytes(range(6)), 2, 3), (2, bytes(range(18)), 2, 3), (3, b"x", 2, 3), (4, None, 2, 3), (5, b"", None, None)]
    df = spark.createDataFrame(data, "i int, pixels binary, height int, width int").withColumn("png", picture.png(F.col("pixels"), F.col("height"), F.col("width")))
    got = {r.i: r for r in df.select("i", "pixels", picture.pixels_of(F.col("png")).alias("d")).collect()}
    assert [got[i].d.channels for i in (1, 2)] == [1, 3] and all(got[i].d.pixels == got[i].pixels for i in (1, 2))
    assert all(got[i].d.error and got[i].d.pixels is None for i in (3, 4, 5))
    assert df.limit(0).select(picture.pixels_of(F.col("png"))).collect() == []


def _segment_map(segments):
    """A character map of format 4: (start, end, delta, glyphs or None)."""
    segments = [*segments, (0xFFFF, 0xFFFF, 1, None)]
    n, ids, offsets = len(segments), [], []
    for i, (_, _, _, glyphs) in enumerate(segments):
        offsets.append(0 if glyphs is None else 2 * (n - i + len(ids)))
        ids += glyphs or []
    pack = lambda v: struct.pack(f">{len(v)}H", *(x & 0xFFFF for x in v))
    body = pack([2 * n, 0, 0, 0]) + pack([s[1] for s in segments]) + pack([0]) + pack([s[0] for s in segments]) + pack([s[2] for s in segments]) + pack(offsets) + pack(ids)
    return struct.pack(">HHHHI", 0, 1, 3, 1, 12) + struct.pack(">HHH", 4, 6 + len(body), 0) + body


def test_faces_of_font_files(spark, tmp_path):
    assert sfnt.faces(_font_file(65, 70, (300, 900))) == [(0, list(range(65, 71)), (300.0, 900.0))]
    assert sfnt.code_points(_segment_map([(65, 67, -64, None), (97, 100, 5, [7, 0, 8, 9]), (200, 201, -200, None)])) == [65, 66, 67, 97, 99, 100, 201]
    one, two = _font_file(65, 66, None), _font_file(0x20000, 0x20002, None)
    head = struct.pack(">4sIIII", b"ttcf", 0x10000, 2, 20, 20 + len(one))
    move = lambda data, by: data[:12] + b"".join(struct.pack(">4sIII", *struct.unpack_from(">4sI", data, 12 + 16 * i), struct.unpack_from(">I", data, 20 + 16 * i)[0] + by, *struct.unpack_from(">I", data, 24 + 16 * i)) for i in range(1)) + data[28:]
    both = head + move(one, 20) + move(two, 20 + len(one))
    assert [(n, p) for n, p, _ in sfnt.faces(both)] == [(0, [65, 66]), (1, [0x20000, 0x20001, 0x20002])]
    folder = tmp_path / "f" / "deep"
    folder.mkdir(parents=True)
    (folder / "A.ttc").write_bytes(both)
    (folder / "B.TTF").write_bytes(one)
    (folder / "broken.otf").write_bytes(one[:40])
    (folder / "notes.txt").write_bytes(one)
    got = fonts.faces(readers.font_files(spark, str(tmp_path / "f"))).collect()
    assert sorted((r.path.rsplit("/")[-1], r.face, r.error is None) for r in got if r.error is None) == [("A.ttc", 0, True), ("A.ttc", 1, True), ("B.TTF", 0, True)]
    assert [r.path.rsplit("/")[-1] for r in got if r.error] == ["broken.otf"]


def test_font_command(spark, tmp_path, run, capsys):
    (tmp_path / "own").mkdir()
    (tmp_path / "sys").mkdir()
    (tmp_path / "own" / "Mine.ttf").write_bytes(_font_file(65, 90, (350, 750)))
    (tmp_path / "own" / "Broken.ttf").write_bytes(b"x")
    for name in ("Free_Sans.otf", "Shop.otf"):
        (tmp_path / "sys" / name).write_bytes(_font_file(60, 90, None))
    args = ["fonts", "--own", tmp_path / "own", "--system", tmp_path / "sys", "--whitelist", "freesans", "--probe", "ABC", "--out", tmp_path / "out"]
    assert run(*args) == 0 and "Broken.ttf" in capsys.readouterr().out
    assert sorted(r.font_key for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["Free_Sans", "Mine@400", "Mine@500", "Mine@700"]
    assert run(*args[:-3], "xyz", "--out", tmp_path / "none") == 1


RECORDS = [("a.png", "日", "char", "target", "BMP", 0), ("b.png", "嘅", "char", "target", "ExtA", 1), ("c.png", "日本", "sentence", "sentence", None, 2)]


@pytest.fixture
def made(spark, tmp_path):
    """Three images of stripes, their metadata and labels."""
    (tmp_path / "img").mkdir()
    a = np.full((48, 100), 240, np.uint8)
    a[10:38:6, 5:95] = 20
    lines = []
    for file, text, tier, role, plane, idx in RECORDS:
        (tmp_path / "img" / file).write_bytes(picture.encode(a if idx else np.stack([a] * 3, 2)))
        lines.append({"file": file, "text": text, "tier": tier, "role": role, "plane": plane, "difficulty": "clean", "source": "s", "font": "f1", "font_family": "F", "n_chars": len(text), "width": 100, "height": 48, "corpus_freq": 5, "idx": idx})
    (tmp_path / "m.jsonl").write_text("\n".join(json.dumps(r) for r in lines), encoding="utf-8")
    (tmp_path / "l.tsv").write_text("".join(f"{r[0]}\t{r[1]}\n" for r in RECORDS), encoding="utf-8")
    spark.createDataFrame([("嘅", "既", 0)], "target string, confusable string, ord int").write.parquet(str(tmp_path / "pairs"))
    return tmp_path


def test_verify_tells_fatal_from_warning(spark, made, run, capsys):
    check = ["verify", "--images", made / "img", "--metadata", made / "m.jsonl", "--labels", made / "l.tsv"]
    assert run(*check) == 0 and "fatal" not in capsys.readouterr().out
    assert run(*check, "--pairs", made / "pairs", "--sample", 2) == 0 and "warning: weak pairs: 1" in capsys.readouterr().out
    (made / "img" / "b.png").write_bytes(picture.encode(np.full((40, 100), 9, np.uint8)))
    assert run(*check) == 0
    out = capsys.readouterr().out
    assert "warning: size: 1, such as b.png" in out and "warning: ink: 1, such as b.png" in out
    spark.createDataFrame([("f1", [ord(c) for c in "日本"])], "font_key string, cmap array<int>").write.parquet(str(made / "fonts"))
    assert run(*check, "--fonts", made / "fonts") == 1 and "fatal: glyphs: 1, such as b.png" in capsys.readouterr().out
    (made / "img" / "a.png").write_bytes(b"no image")
    assert run(*check) == 1 and "fatal: unreadable: 1, such as a.png" in capsys.readouterr().out
    (made / "img" / "a.png").unlink()
    assert run(*check) == 1 and "fatal: pairing: 1, such as a.png" in capsys.readouterr().out


def test_package_and_card(spark, made, run):
    assert run("package", "--metadata", made / "m.jsonl", "--images", made / "img", "--dest", made / "out") == 0
    rows = spark.read.parquet(str(made / "out" / "data"))
    assert len(rows.inputFiles()) == 1 and rows.dtypes[0] == ("image", "struct<bytes:binary,path:string>")
    assert sorted((r.image.path, r.text, r.plane, r.jyutping) for r in rows.collect()) == [("a.png", "日", "BMP", ""), ("b.png", "嘅", "ExtA", ""), ("c.png", "日本", "", "")]
    assert rows.where("octet_length(image.bytes) = 0").isEmpty()
    card = (made / "out" / "README.md").read_text(encoding="utf-8")
    assert "3 images of 3 texts in 1 fonts" in card and "| char | 2 |" in card and "TBD" in card and "n<1K" in card


def test_samples(spark, made, run, capsys):
    (made / "out" / "samples").mkdir(parents=True)
    (made / "out" / "samples" / "old.png").write_bytes(b"old")
    args = ["samples", "--metadata", made / "m.jsonl", "--images", made / "img", "--pairs", made / "pairs", "--out", made / "out"]
    assert run(*args) == 0 and "3 samples" in capsys.readouterr().out
    got = json.loads((made / "out" / "samples.json").read_text(encoding="utf-8"))
    assert [r["file"] for r in got] == ["a.png", "b.png", "c.png"] and got[1]["pair_with"] == "既" and got[1]["pair_role"] == "target"
    assert sorted(f.name for f in (made / "out" / "samples").iterdir()) == ["a.png", "b.png", "c.png"]
    (made / "img" / "c.png").unlink()
    assert run(*args) == 1


def test_image_files_tell_failures(spark, tmp_path):
    rows = spark.createDataFrame([("a", b"1"), ("b", None), (None, b"2"), ("x/y", b"3")], "file string, image binary")
    got = {r.file: r.error for r in sinks.image_files(rows, str(tmp_path)).collect()}
    assert got["a"] is None and got["b"] == "no image" and got[None] == "no name" and got["x/y"]
    assert [f.name for f in tmp_path.iterdir()] == ["a"]


class Answers(BaseHTTPRequestHandler):
    asked: list = []

    def do_POST(self):
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        Answers.asked.append(body)
        image = base64.b64decode(body["images"][0], validate=True)
        self.send_response(500 if body["model"] == "bad" else 200)
        self.end_headers()
        self.wfile.write(json.dumps({"response": "```\n日\n```" if image.startswith(picture.SIGN) else "?"}).encode())

    def log_message(self, *args):
        pass


def test_evaluate_resumes(spark, made, run, capsys):
    server = HTTPServer(("127.0.0.1", 0), Answers)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    (made / "models.json").write_text('[{"model": "m1", "tag": "one"}, {"model": "m2", "tag": "bad"}, {"model": "m3", "tag": "three"}]')
    args = ["evaluate", "--metadata", made / "m.jsonl", "--images", made / "img", "--models", made / "models.json", "--results", made / "res", "--host", f"http://127.0.0.1:{server.server_port}"]
    (made / "img" / "c.png").unlink()
    assert run(*args, "--keys", " m1, m2") == 0
    rows = lambda: spark.read.parquet(str(made / "res"))
    got = {(r.model, r.file): r for r in rows().collect()}
    assert len(got) == 6 and got["m1", "a.png"].acc == 1 and got["m1", "b.png"].acc == 0 and got["m1", "a.png"].error == ""
    assert "no image" in got["m1", "c.png"].error and "500" in got["m2", "a.png"].error and len(Answers.asked) == 4
    assert run(*args, "--keys", "m1") == 0 and len(Answers.asked) == 4 and rows().count() == 7
    assert run(*args, "--keys", "m3", "--limit", "1") == 0 and rows().where("model = 'm3'").count() == 1
    assert run(*args, "--keys", "m3", "--no-resume") == 0 and {r.model for r in rows().collect()} == {"m3"}
    assert run(*args, "--keys", "other") == 1
    assert run("report", "--scores", made / "res", "--pairs", made / "pairs") == 0 and "|m3   |ext |1  |" in capsys.readouterr().out
    server.shutdown()


def test_report_of_a_build(spark):
    records = spark.createDataFrame([("char", "clean", "a", "BMP", "x", "f"), ("char", "hard", "a", None, "x", "g"), ("word", "hard", None, None, "y", "g")], "tier string, difficulty string, source string, plane string, text string, font string")
    failed = spark.createDataFrame([(i, "t", "ink") for i in range(5)], "idx long, text string, error string")
    made = report.build_report(records, failed, spark.createDataFrame([("𨋢",)], "text string"), {"seed": 1}, most=2)
    assert made["stats"]["by_plane"] == {"-": 1, "BMP": 1} and made["stats"]["by_source"] == {"-": 1, "a": 2} and made["stats"]["n_failed"] == 5
    assert made["stats"]["n_distinct_texts"] == 2 and [f["idx"] for f in made["failures"]] == [0, 1] and made["unrenderable_chars"] == ["𨋢"]
    assert json.loads(report.as_json(made))["seed"] == 1
    empty = report.build_report(records.limit(0), failed.limit(0), failed.select("text").limit(0), {})
    assert empty["stats"]["n_images"] == 0 and empty["stats"]["by_tier"] == {} and "0 images" in report.card(empty, "n", "mit")


def test_cards_and_findings_of_nothing(spark):
    rows = spark.createDataFrame([("char", 1, "ExtB+", "既", "target"), ("word", 9, "BMP", "嘅", "confusable")], "tier string, n_chars int, plane string, pair_with string, pair_role string")
    assert [(r.wide, r.ext, r.pair_label) for r in browse.card(rows, ("→%s", "←%s")).collect()] == [(False, "ExtB+", "→既"), (True, None, "←嘅")]
    none = spark.createDataFrame([], "file string, text string, height int, width int, error string, ink_ratio double, contrast double")
    assert qa.findings(qa.pairing(none, none, none), none, none, None, None).collect() == []
    assert qa.total_bytes(none, "text").collect()[0].bytes == 0
    assert evals.pair_table(spark.createDataFrame([], "model string, tier string, gt string, prediction string"), spark.createDataFrame([("a", "b")], "target string, confusable string")).collect() == []
