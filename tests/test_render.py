import numpy as np
import pytest

from inkwright.operators import images, render


def glyph(seed, h=40, w=30):
    rng = np.random.default_rng(seed)
    g = np.zeros((h, w), np.uint8)
    for _ in range(4):
        y, x = rng.integers(2, h - 8), rng.integers(2, w - 8)
        g[y : y + 4, 3 : w - 3] = 255
        g[3 : h - 3, x : x + 4] = 255
    return g


POOL = {"f": {c: glyph(i) for i, c in enumerate("冇有嘅𨋢")}, "blank": {"冇": np.zeros((40, 30), np.uint8)}}


@pytest.mark.parametrize("level", list(render.LEVELS))
def test_every_level_stays_readable(level):
    done = [render.make("冇有嘅", POOL["f"], i, level, 1) for i in range(12)]
    images_ = [a for a, _ in done if a is not None]
    assert len(images_) >= 9
    assert all(a.shape[0] == 48 and a.shape[1] >= 8 and a.dtype == np.uint8 for a in images_)
    assert all(m["contrast"] >= 45 and m["ink_ratio"] >= 0.004 for a, m in done if a is not None)


def test_failures_have_reasons():
    assert "no glyph" in render.make("好", POOL["f"], 1, "clean", 1)[1]["error"]
    assert render.make("冇", POOL["blank"], 1, "clean", 1)[1]["error"] == "empty glyphs"
    assert render.make("", POOL["f"], 1, "clean", 1)[1]["error"] == "no text"


def test_parts():
    rng = images.generator(3, 4)
    flat = np.full((40, 60, 3), 200, np.uint8)
    y, x = render.field(40, 60, rng, 0.0, 0.0, 0.0)
    assert np.array_equal(render.sampled(flat, y, x), flat)
    assert np.abs(render.blocks(flat, 95).astype(int) - 200).max() <= 2
    assert render.line_height(np.zeros((96, 100, 3), np.uint8)).shape == (48, 50, 3)
    assert render.line_height(np.zeros((24, 4, 3), np.uint8)).shape == (48, 8, 3)
    for ground in (60.0, 130.0, 150.0, 250.0):
        for _ in range(20):
            assert abs(render.ink_color(ground, rng).mean() - ground) >= 85 - 19
    assert render.montage([np.zeros((48, 300, 3), np.uint8)] * 3, 2, 100).shape == (96, 200, 3)
    dy, dx = (a - b for a, b in zip(render.field(40, 60, rng, 3.0, 0.0, 0.0), np.mgrid[0:40, 0:60], strict=True))
    assert np.abs(dx).max() == pytest.approx(3.0) and np.abs(dy).max() == pytest.approx(3.0)


def test_render_does_not_depend_on_partitions(spark):
    rows = [(i, "冇有" if i % 2 else "嘅", "f" if i % 5 else "none", list(render.LEVELS)[i % 4]) for i in range(24)]
    plan = spark.createDataFrame(rows, "idx long, text string, font_key string, difficulty string")
    a, b = ({r.idx: r for r in render.render(plan, POOL, 7, n).collect()} for n in (1, 3))
    assert a == b and len(a) == 24
    assert all(a[i].error == "no font none" for i in range(0, 24, 5))
    good = [r for r in a.values() if r.error is None]
    assert good and all(len(r.pixels) == r.height * r.width * 3 for r in good)
