"""Image metrics, gates and pixel augmentations in numpy, batched over Arrow; pixels are uint8 bytes with a shape."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: the factor between seed and index of a row's generator.
STRIDE = 1_000_003


def generator(seed: int, index: int) -> np.random.Generator:
    """A row's own generator, whatever partition it is in."""
    return np.random.default_rng(seed * STRIDE + index)


def contrast(grey: np.ndarray) -> float:
    """99th less 1st percentile."""
    hi, lo = np.percentile(grey, [99, 1])
    return float(hi - lo)


def blurred(grey: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian blur by two passes of one kernel, edges mirrored."""
    r = max(1, int(3 * sigma + 0.5))
    k = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    k /= k.sum()
    out = grey.astype(np.float64)
    for axis in (0, 1):
        pad = [(0, 0), (0, 0)]
        pad[axis] = (r, r)
        wide = np.pad(out, pad, mode="reflect" if out.shape[axis] > r else "symmetric")
        n, rows = out.shape[axis], np.moveaxis(wide, axis, 0)
        total = k[0] * rows[:n]
        for i in range(1, len(k)):
            total += k[i] * rows[i : i + n]
        out = np.moveaxis(total, 0, axis)
    return out


def ink_ratio(grey: np.ndarray, threshold: float = 20.0) -> float:
    """Share of pixels that differ from their surroundings by more than the threshold."""
    sigma = max(2.0, min(grey.shape) / 6)
    return float((np.abs(grey.astype(np.float64) - blurred(grey, sigma)) > threshold).mean())


def resized(a: np.ndarray, height: int = 48, least_width: int = 8) -> np.ndarray:
    """Nearest pixels at the height, the width in proportion."""
    width = max(least_width, round(a.shape[1] * height / a.shape[0]))
    rows = np.minimum((np.arange(height) + 0.5) * a.shape[0] / height, a.shape[0] - 1).astype(int)
    cols = np.minimum((np.arange(width) + 0.5) * a.shape[1] / width, a.shape[1] - 1).astype(int)
    return a[rows][:, cols]


def color_contrast(a: np.ndarray, rng: np.random.Generator, bounds: tuple[float, float]) -> np.ndarray:
    """Contrast about mid-grey, then brightness of up to 18 levels, then gains of channels of up to 6 % about mid-grey in two rows of five."""
    out = (a.astype(np.float64) - 128) * rng.uniform(*bounds) + 128 + rng.uniform(-18, 18)
    if out.ndim == 3 and rng.random() < 0.4:
        out = (out - 128) * rng.uniform(0.94, 1.06, out.shape[2]) + 128
    return np.clip(out, 0, 255).astype(np.uint8)


def noise(a: np.ndarray, rng: np.random.Generator, level: float) -> np.ndarray:
    return a if level <= 0 else np.clip(a + rng.normal(0, level, a.shape), 0, 255).astype(np.uint8)


def grey_of(files: DataFrame) -> DataFrame:
    """files (pixels, channels, ...) with grey pixels."""

    @F.pandas_udf("binary")
    def grey(pixels: pd.Series, channels: pd.Series) -> pd.Series:
        weights = np.array([0.114, 0.587, 0.299])
        return pd.Series([p if p is None or n == 1 else (np.frombuffer(p, np.uint8).reshape(-1, 3) @ weights).astype(np.uint8).tobytes() for p, n in zip(pixels, channels, strict=True)], dtype=object)

    return files.withColumn("pixels", grey("pixels", "channels"))


def measure(images: DataFrame, seed: int | None = None, level: float = 0.0, key: str = "idx") -> DataFrame:
    """(idx, ink_ratio, contrast, error) of (idx, pixels binary, height, width): grey images; with a seed, after noise of the level. key: another name for idx, of texts if there is no seed.

    Images whose pixels don't fit their shape come back with an error and null metrics.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for idx, data, h, w in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if data is None or not h or not w or len(data) != h * w:
                    out.append((idx, None, None, "unreadable"))
                    continue
                grey = np.frombuffer(data, np.uint8).reshape(h, w)
                grey = grey if seed is None else noise(grey, generator(seed, idx), level)
                out.append((idx, round(ink_ratio(grey), 4), round(contrast(grey), 1), None))
            cols = list(zip(*out, strict=True)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (batch.schema.field(0).type, pa.float64(), pa.float64(), pa.string()), strict=True)], [key, "ink_ratio", "contrast", "error"])

    kind = images.schema[key].dataType.simpleString()
    return images.select(key, "pixels", "height", "width").mapInArrow(run, f"{key} {kind}, ink_ratio double, contrast double, error string")
