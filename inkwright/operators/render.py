"""Text lines from glyph bitmaps, varied and gated: one Arrow pass from plan rows to images or errors.

Fonts come as tables of glyph bitmaps, so no font or image library is needed. Distortions are one
displacement field that is sampled once, instead of an interpolation for each of them.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from inkwright.operators import images as I
from inkwright.plans.planner import with_difficulty

#: Bounds of each level's variation.
LEVELS: dict[str, dict] = {
    "clean": {"rotate": 0.5, "blur": 0.3, "noise": 2, "persp": 0.004, "elastic": 0.0, "jpeg": (92, 98), "contrast": (0.95, 1.05)},
    "light": {"rotate": 2.0, "blur": 0.8, "noise": 5, "persp": 0.012, "elastic": 1.5, "jpeg": (80, 95), "contrast": (0.85, 1.15)},
    "medium": {"rotate": 4.0, "blur": 1.4, "noise": 9, "persp": 0.025, "elastic": 3.0, "jpeg": (60, 88), "contrast": (0.70, 1.30)},
    "hard": {"rotate": 7.0, "blur": 2.2, "noise": 14, "persp": 0.045, "elastic": 5.0, "jpeg": (35, 75), "contrast": (0.55, 1.45)},
}
#: Padding, least luminance gap, gates.
PADDING, GAP, LEAST_INK, LEAST_CONTRAST = (24, 16), 85, 0.004, 45.0
Glyphs = Mapping[str, np.ndarray]


def background(h: int, w: int, rng: np.random.Generator) -> np.ndarray:
    """Paper: a light base with a tint, mostly a slope, and soft grain."""
    out = np.full((h, w, 3), float(rng.integers(170, 253))) + rng.uniform([-12, -8, -6], [6, 8, 12])
    if rng.random() < 0.7:
        slope = np.add.outer(np.linspace(-1, 1, h) * rng.uniform(-1, 1), np.linspace(-1, 1, w) * rng.uniform(-1, 1))
        out += slope[:, :, None] * rng.uniform(5, 28)
    return np.clip(out + I.blurred(rng.normal(0, 4, (h, w)), 2.0)[:, :, None], 0, 255)


def ink_color(ground: float, rng: np.random.Generator, gap: int = GAP) -> np.ndarray:
    """A colour at least gap away from the ground's luminance: dark on light over 140, else light on dark."""
    level = rng.integers(0, max(0, int(ground - gap)) + 1) if ground > 140 else rng.integers(min(255, int(ground + gap)), 256)
    return np.clip(level + rng.integers(-18, 19, 3), 0, 255).astype(float)


def draw_line(text: str, glyphs: Glyphs, rng: np.random.Generator) -> tuple[np.ndarray | None, str | None]:
    """(image, None), or (None, reason): glyphs side by side, in a third of the lines with uneven gaps."""
    lost = [c for c in text if c not in glyphs]
    if not text or lost:
        return None, "no text" if not text else f"no glyph for {''.join(lost)}"
    marks = [np.asarray(glyphs[c], float) / 255 for c in text]
    if not sum(m.any() for m in marks):
        return None, "empty glyphs"
    px, py = (max(1, int(p * rng.uniform(0.6, 1.8))) for p in PADDING)
    uneven = len(text) > 1 and rng.random() < 0.35
    gaps = [int(round(m.shape[1] * rng.uniform(-0.04, 0.08))) if uneven else 0 for m in marks]
    height = max(m.shape[0] for m in marks)
    mask = np.zeros((height + 2 * py, sum(m.shape[1] + g for m, g in zip(marks, gaps, strict=True)) + 2 * px + 8))
    x = px
    for m, g in zip(marks, gaps, strict=True):
        part = mask[py : py + m.shape[0], x : x + m.shape[1]]
        np.maximum(part, m[:, : part.shape[1]], out=part)
        x += m.shape[1] + g
    ground = background(*mask.shape, rng)
    return (ground * (1 - mask[:, :, None]) + ink_color(float(ground.mean()), rng) * mask[:, :, None]).astype(np.uint8), None


def stroke(a: np.ndarray, rng: np.random.Generator, amount: float) -> np.ndarray:
    """Thicker or thinner strokes by the least or greatest of neighbours, in six of ten images with elastic variation."""
    if amount <= 0 or rng.random() < 0.4:
        return a
    k = int(rng.integers(2, 4))
    pick = np.minimum if rng.random() < 0.5 else np.maximum
    wide = np.pad(a, ((0, k - 1), (0, k - 1), (0, 0)), mode="edge")
    out = a
    for dy in range(k):
        for dx in range(k):
            if k == 2 or (dy, dx) not in ((0, 0), (0, 2), (2, 0), (2, 2)):
                out = pick(out, wide[dy : dy + a.shape[0], dx : dx + a.shape[1]])
    return out


def homography(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The eight numbers of the projective map that takes four points a to b; the ninth is 1."""
    rows, right = [], []
    for (x, y), (u, v) in zip(a, b, strict=True):
        rows += [[x, y, 1, 0, 0, 0, -x * u, -y * u], [0, 0, 0, x, y, 1, -x * v, -y * v]]
        right += [u, v]
    return np.linalg.lstsq(np.array(rows, float), np.array(right, float), rcond=None)[0]


def field(h: int, w: int, rng: np.random.Generator, elastic: float, persp: float, degrees: float) -> tuple[np.ndarray, np.ndarray]:
    """Where each pixel comes from: a smooth random field of the strength, corners moved apart and a turn, summed up."""
    y, x = np.mgrid[0:h, 0:w].astype(float)
    dy, dx = np.zeros((h, w)), np.zeros((h, w))
    if elastic > 0:
        for d in (dx, dy):
            soft = I.blurred(rng.uniform(-1, 1, (h, w)), max(4.0, min(h, w) / 8))
            d += soft * (elastic / max(1e-6, np.abs(soft).max()))
    if persp > 0:
        corners = np.array([(0, 0), (w - 1, 0), (w - 1, h - 1), (0, h - 1)], float)
        moved = corners + rng.uniform(-1, 1, (4, 2)) * (w * persp, h * persp)
        p = homography(corners, moved)
        z = p[6] * x + p[7] * y + 1
        dx += (p[0] * x + p[1] * y + p[2]) / z - x
        dy += (p[3] * x + p[4] * y + p[5]) / z - y
    angle = np.deg2rad(rng.uniform(-degrees, degrees)) if degrees > 0 else 0.0
    if abs(angle) >= np.deg2rad(0.05):
        cy, cx = y - h / 2, x - w / 2
        dx += cx * (np.cos(angle) - 1) - cy * np.sin(angle)
        dy += cx * np.sin(angle) + cy * (np.cos(angle) - 1)
    return y + dy, x + dx


def sampled(a: np.ndarray, y: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Bilinear samples of a at real positions, edges repeated."""
    h, w = a.shape[:2]
    y, x = np.clip(y, 0, h - 1), np.clip(x, 0, w - 1)
    y0, x0 = np.minimum(y.astype(int), h - 1), np.minimum(x.astype(int), w - 1)
    y1, x1 = np.minimum(y0 + 1, h - 1), np.minimum(x0 + 1, w - 1)
    fy, fx = (y - y0)[:, :, None], (x - x0)[:, :, None]
    top = a[y0, x0] * (1 - fx) + a[y0, x1] * fx
    return np.clip(top * (1 - fy) + (a[y1, x0] * (1 - fx) + a[y1, x1] * fx) * fy + 0.5, 0, 255).astype(np.uint8)


def blur(a: np.ndarray, rng: np.random.Generator, most: float) -> np.ndarray:
    """A quarter of strongly blurred images along one axis, others by a Gaussian."""
    if most <= 0:
        return a
    if most > 0.8 and rng.random() < 0.25:
        k, axis = int(rng.choice([3, 5, 7])), int(rng.integers(0, 2))
        pad = [(0, 0)] * 3
        pad[axis] = (k // 2, k // 2)
        wide = np.pad(a.astype(float), pad, mode="edge")
        return (sum(np.take(wide, range(i, i + a.shape[axis]), axis=axis) for i in range(k)) / k).astype(np.uint8)
    sigma = rng.uniform(0, most)
    return a if sigma <= 0.05 else np.stack([I.blurred(a[:, :, c], sigma) for c in range(3)], 2).astype(np.uint8)


def blocks(a: np.ndarray, quality: int) -> np.ndarray:
    """Traces of block compression: cosine coefficients of 8 x 8 blocks rounded to steps that grow with frequency and with loss."""
    h, w = a.shape[:2]
    wide = np.pad(a.astype(float) - 128, ((0, -h % 8), (0, -w % 8), (0, 0)), mode="edge")
    k = np.arange(8)
    basis = np.sqrt(2 / 8) * np.cos((2 * k[None, :] + 1) * k[:, None] * np.pi / 16)
    basis[0] /= np.sqrt(2)
    loss = (50 / quality if quality < 50 else 2 - quality / 50) + 0.02
    step = np.maximum(1, (10 + 7 * np.add.outer(k, k)) * loss)
    # (block row, block column, channel, 8, 8), so that both transforms are matrix products
    cut = wide.reshape(wide.shape[0] // 8, 8, wide.shape[1] // 8, 8, 3).transpose(0, 2, 4, 1, 3)
    coef = basis @ cut @ basis.T
    back = basis.T @ (np.round(coef / step) * step) @ basis
    return np.clip(back.transpose(0, 3, 1, 4, 2).reshape(wide.shape)[:h, :w] + 128, 0, 255).astype(np.uint8)


def augmented(a: np.ndarray, level: str, rng: np.random.Generator) -> np.ndarray:
    """Strokes, distortion, contrast, blur, noise, block traces, in this order."""
    p = LEVELS[level]
    a = stroke(a, rng, p["elastic"])
    a = sampled(a, *field(*a.shape[:2], rng, p["elastic"], p["persp"], p["rotate"]))
    a = I.noise(blur(I.color_contrast(a, rng, p["contrast"]), rng, p["blur"]), rng, p["noise"])
    return blocks(a, int(rng.integers(p["jpeg"][0], p["jpeg"][1] + 1)))


def line_height(a: np.ndarray, height: int = 48, least_width: int = 8) -> np.ndarray:
    """At the height with the width in proportion: means of areas when shrinking, bilinear samples when growing."""
    h, w = a.shape[:2]
    if h == height:
        return a
    width = max(least_width, round(w * height / h))
    if h < height:
        y, x = np.meshgrid((np.arange(height) + 0.5) * h / height - 0.5, (np.arange(width) + 0.5) * w / width - 0.5, indexing="ij")
        return sampled(a, y, x)
    sums = np.zeros((h + 1, w + 1, 3))
    sums[1:, 1:] = a.astype(float).cumsum(0).cumsum(1)
    ys, xs = (np.arange(height + 1) * h) // height, (np.arange(width + 1) * w) // width
    y0, y1, x0, x1 = ys[:-1], np.maximum(ys[1:], ys[:-1] + 1), xs[:-1], np.maximum(xs[1:], xs[:-1] + 1)
    total = sums[y1][:, x1] - sums[y0][:, x1] - sums[y1][:, x0] + sums[y0][:, x0]
    return (total / np.multiply.outer(y1 - y0, x1 - x0)[:, :, None]).astype(np.uint8)


def grey(a: np.ndarray) -> np.ndarray:
    return a @ np.array([0.114, 0.587, 0.299])


def make(text: str, glyphs: Glyphs, index: int, level: str, seed: int) -> tuple[np.ndarray | None, dict]:
    """(image, metrics) or (None, error): draw, vary, size, then the gates for ink and contrast, the first failure reported."""
    rng = I.generator(seed, index)
    line, why = draw_line(text, glyphs, rng)
    if line is None:
        return None, {"error": why}
    out = line_height(augmented(line, level, rng))
    ink, contrast = I.ink_ratio(grey(out)), I.contrast(grey(out))
    if ink < LEAST_INK:
        return None, {"error": f"ink {ink:.4f}"}
    if contrast < LEAST_CONTRAST:
        return None, {"error": f"contrast {contrast:.0f}"}
    return out, {"ink_ratio": round(ink, 4), "contrast": round(contrast, 1), "height": out.shape[0], "width": out.shape[1]}


SCHEMA = "idx long, text string, font_key string, pixels binary, height int, width int, ink_ratio double, contrast double, error string"


def render(plan: DataFrame, fonts: Mapping[str, Glyphs], seed: int, tasks: int | None = None) -> DataFrame:
    """SCHEMA rows of plan rows (idx, text, font_key, difficulty, drawn where there is none): pixels are uint8, height x width x 3.

    A row depends on its idx and seed alone. Unknown fonts and failed gates come back with an error and no
    pixels. fonts is broadcast: a font pool of bitmaps, as large as its glyphs.
    """
    pool = plan.sparkSession.sparkContext.broadcast(dict(fonts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for idx, text, key, level in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                glyphs = pool.value.get(key)
                image, meta = (None, {"error": f"no font {key}"}) if glyphs is None else make(text or "", glyphs, idx, level, seed)
                rows.append({"idx": idx, "text": text, "font_key": key, "pixels": None if image is None else image.tobytes()} | meta)
            names = ("idx", "text", "font_key", "pixels", "height", "width", "ink_ratio", "contrast", "error")
            kinds = (pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], k) for n, k in zip(names, kinds, strict=True)], list(names))

    rows = with_difficulty(plan, str(seed), "idx").select("idx", "text", "font_key", "difficulty")
    return (rows.repartition(tasks) if tasks else rows).mapInArrow(run, SCHEMA)


def montage(cells: list[np.ndarray], columns: int, width: int, height: int = 48) -> np.ndarray:
    """A contact sheet of a bounded sample; wider cells are made smaller, not cut."""
    rows = -(-len(cells) // columns)
    sheet = np.full((rows * height, columns * width, 3), 255, np.uint8)
    for i, c in enumerate(cells):
        if c.shape[1] > width:
            c = line_height(c, max(1, c.shape[0] * width // c.shape[1]))[:, :width]
        y, x = i // columns * height, i % columns * width
        sheet[y : y + min(height, c.shape[0]), x : x + c.shape[1]] = c[:height]
    return sheet
