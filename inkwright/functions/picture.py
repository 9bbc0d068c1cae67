"""PNG files to pixels and back, batched over Arrow; colour pixels are blue, green, red."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, StringType, StructType

SIGN = b"\x89PNG\r\n\x1a\n"
#: Channels of the colour types.
CHANNELS = {0: 1, 2: 3, 4: 2, 6: 4}
PIXELS = StructType().add("height", IntegerType()).add("width", IntegerType()).add("channels", IntegerType()).add("pixels", BinaryType()).add("error", StringType())


def encode(a: np.ndarray) -> bytes:
    """A PNG file of uint8 pixels, height x width or height x width x 3."""
    h, w = a.shape[:2]
    lines = np.zeros((h, 1 + a[0].size), np.uint8)
    lines[:, 1:] = (a if a.ndim == 2 else a[:, :, ::-1]).reshape(h, -1)

    def chunk(tag: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + tag + body + struct.pack(">I", zlib.crc32(tag + body))

    head = struct.pack(">IIBBBBB", w, h, 8, 0 if a.ndim == 2 else 2, 0, 0, 0)
    return SIGN + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines.tobytes())) + chunk(b"IEND", b"")


def _paeth(line: np.ndarray, above: np.ndarray, step: int) -> None:
    for i in range(len(line)):
        a, b = (int(line[i - step]), int(above[i - step])) if i >= step else (0, 0)
        c = int(above[i])
        near = min((abs(c - b), 0, a), (abs(a - b), 1, c), (abs(a + c - 2 * b), 2, b))
        line[i] = (int(line[i]) + near[2]) & 255


def decode(data: bytes) -> np.ndarray:
    """Pixels of a PNG file of 8 bits a channel, without its transparency; anything else raises ValueError."""
    if data[:8] != SIGN:
        raise ValueError("no PNG file")
    at, head, body = 8, None, []
    while at + 8 <= len(data):
        size, tag = struct.unpack_from(">I4s", data, at)
        part = data[at + 8 : at + 8 + size]
        if len(part) < size:
            raise ValueError("file is cut off")
        if tag == b"IHDR":
            head = struct.unpack(">IIBBBBB", part)
        elif tag == b"IDAT":
            body.append(part)
        at += 12 + size
    if head is None or head[2] != 8 or head[3] not in CHANNELS or head[6]:
        raise ValueError("kind of PNG file that isn't read")
    w, h, n = head[0], head[1], CHANNELS[head[3]]
    try:
        raw = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8)
    except zlib.error as e:
        raise ValueError(str(e)) from e
    if raw.size != h * (1 + w * n):
        raise ValueError("file is cut off")
    lines = raw.reshape(h, 1 + w * n)
    out, above = np.zeros((h, w * n), np.uint8), np.zeros(w * n, np.uint8)
    for y in range(h):
        line, kind = lines[y, 1:].copy(), lines[y, 0]
        if kind == 1:
            line = np.add.accumulate(line.reshape(w, n), axis=0, dtype=np.uint8).reshape(-1)
        elif kind == 2:
            line += above
        elif kind == 3:
            for i in range(w * n):
                line[i] = (int(line[i]) + ((int(line[i - n]) if i >= n else 0) + int(above[i])) // 2) & 255
        elif kind == 4:
            _paeth(line, above, n)
        out[y] = above = line
    a = out.reshape(h, w, n)
    return a[:, :, 0] if n < 3 else np.ascontiguousarray(a[:, :, 2::-1])


@F.pandas_udf(BinaryType())
def _png(pixels: pd.Series, height: pd.Series, width: pd.Series) -> pd.Series:
    def one(p, h, w):
        if p is None or not h or not w or h != h or len(p) not in (h * w, 3 * h * w):
            return None
        return encode(np.frombuffer(p, np.uint8).reshape((int(h), int(w)) if len(p) == h * w else (int(h), int(w), 3)))

    return pd.Series([one(*r) for r in zip(pixels, height, width, strict=True)], dtype=object)


@F.pandas_udf(PIXELS)
def _pixels(content: pd.Series) -> pd.DataFrame:
    rows = []
    for c in content:
        try:
            a = decode(b"" if c is None else bytes(c))
            rows.append((*a.shape[:2], 1 if a.ndim == 2 else 3, a.tobytes(), None))
        except ValueError as e:
            rows.append((None, None, None, None, str(e)))
    out = pd.DataFrame(rows, columns=["height", "width", "channels", "pixels", "error"])
    return out.astype({c: "Int32" for c in ("height", "width", "channels")})


def png(pixels: Column, height: Column, width: Column) -> Column:
    """PNG files of pixels, grey or colour by their number; null where it fits neither."""
    return _png(pixels, height, width)


def pixels_of(content: Column) -> Column:
    """struct<height, width, channels, pixels, error>; what can't be read has an error and nulls."""
    return _pixels(content)
