"""Faces of font files from their bytes: code points and the weight axis, by the published table layouts."""

from __future__ import annotations

import struct

import numpy as np

#: Platform and encoding of the Unicode character maps, the fullest first.
UNICODE = ((3, 10), (0, 6), (0, 4), (3, 1), (0, 3), (0, 2), (0, 1), (0, 0))


def _tables(data: bytes, start: int) -> dict[bytes, bytes]:
    """The character map and the axes of the face that starts there."""
    out = {}
    for i in range(struct.unpack_from(">H", data, start + 4)[0]):
        tag, _, at, size = struct.unpack_from(">4sIII", data, start + 12 + 16 * i)
        if at + size > len(data):
            raise ValueError("file is cut off")
        if tag in (b"cmap", b"fvar"):
            out[tag] = data[at : at + size]
    return out


def _segments(cmap: bytes, at: int) -> list[np.ndarray]:
    """Code points of a map of segments (format 4); those of glyph 0 are missing."""
    size = struct.unpack_from(">H", cmap, at + 6)[0]
    ends, starts, deltas, offsets = (np.frombuffer(cmap, ">u2", size // 2, at + 14 + k * size + (2 if k else 0)).astype(np.int64) for k in range(4))
    out = []
    for i, (lo, hi, delta, offset) in enumerate(zip(starts, ends, deltas, offsets, strict=True)):
        codes = np.arange(lo, min(hi, 0xFFFE) + 1)
        glyphs = (codes + delta) & 0xFFFF
        if offset and len(codes):
            glyphs = np.frombuffer(cmap, ">u2", len(codes), at + 16 + 3 * size + 2 * i + offset).astype(np.int64)
            glyphs = np.where(glyphs == 0, 0, (glyphs + delta) & 0xFFFF)
        out.append(codes[glyphs != 0])
    return out


def code_points(cmap: bytes) -> list[int]:
    """Ascending code points of the fullest Unicode map; none if there is no such map. Maps of other formats than 4 and 12 raise."""
    records = {}
    for i in range(struct.unpack_from(">H", cmap, 2)[0]):
        platform, encoding, at = struct.unpack_from(">HHI", cmap, 4 + 8 * i)
        records[platform, encoding] = at
    at = next((records[k] for k in UNICODE if k in records), None)
    if at is None:
        return []
    kind = struct.unpack_from(">H", cmap, at)[0]
    if kind == 4:
        parts = _segments(cmap, at)
    elif kind == 12:
        groups = np.frombuffer(cmap, ">u4", 3 * struct.unpack_from(">I", cmap, at + 12)[0], at + 16).reshape(-1, 3).astype(np.int64)
        parts = [np.arange(lo + (glyph == 0), hi + 1) for lo, hi, glyph in groups]
    else:
        raise ValueError(f"character map of format {kind}")
    return np.unique(np.concatenate(parts)).tolist() if parts else []


def weight_axis(fvar: bytes) -> tuple[float, float] | None:
    """Least and greatest weight of a variable font."""
    at, _, n, size = struct.unpack_from(">4H", fvar, 4)
    for i in range(n):
        tag, least, _, most = struct.unpack_from(">4siii", fvar, at + i * size)
        if tag == b"wght":
            return least / 65536, most / 65536
    return None


def faces(data: bytes) -> list[tuple[int, list[int], tuple[float, float] | None]]:
    """(number, code points, weight axis or None) of each face that has code points; collections hold several faces."""
    starts = [0]
    if data[:4] == b"ttcf":
        starts = list(struct.unpack_from(f">{struct.unpack_from('>I', data, 8)[0]}I", data, 12))
    out = []
    for number, start in enumerate(starts):
        found = _tables(data, start)
        points = code_points(found[b"cmap"]) if b"cmap" in found else []
        if points:
            out.append((number, points, weight_axis(found[b"fvar"]) if b"fvar" in found else None))
    return out
