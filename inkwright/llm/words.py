"""64-bit hashes of words and word shingles, vectorised over Arrow buffers.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D, with A-Z lower-cased.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64
_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BYTE[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_STEP = 0x9E3779B97F4A7C15 | 1
_BACK = pow(_STEP, -1, 2**64)
_PLACE = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * _U(2) + _U(1)
#: Bytes of text hashed at a time; longer texts are cut at white space.
CHUNK = 1 << 18
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_STEP, _BACK)):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _powers[i] = np.multiply.accumulate(p)
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def _hash_words(buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts buf[bounds[i]:bounds[i + 1]], and each text's first word."""
    n = len(buf)
    if not n:
        return np.empty(0, np.uint64), np.zeros(len(bounds), np.int64)
    space = _SPACE[buf]
    word = ~space
    first, last = word.copy(), word.copy()
    first[1:] &= space[:-1]
    last[:-1] &= space[1:]
    inner = bounds[(bounds > 0) & (bounds < n)]
    first[inner] = word[inner]
    last[inner - 1] = word[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _grown(n)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[buf] * up[:n], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts]), np.searchsorted(starts, bounds)


def _long_text(buf: np.ndarray) -> np.ndarray:
    out, at = [], 0
    while at < len(buf):
        end = min(at + CHUNK * 8, len(buf))
        if end < len(buf):
            cut = np.flatnonzero(_SPACE[buf[at:end]])
            while not len(cut) and end < len(buf):
                end = min(end + CHUNK * 8, len(buf))
                cut = np.flatnonzero(_SPACE[buf[at:end]])
            if len(cut) and end < len(buf):
                end = at + int(cut[-1]) + 1
        out.append(_hash_words(buf[at:end], np.array([0, end - at]))[0])
        at = end
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def text_runs(column: pa.Array, most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes of the texts, each text's start and the end) for runs of rows of at most so many bytes, or one text; null: empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    if not len(column):
        return
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, np.int64)[column.offset : column.offset + len(column) + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offs, offs[row] + most, "right")) - 1)
        yield row, buf[offs[row] : offs[end]], offs[row : end + 1] - offs[row]
        row = end


def text_words(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, hashes of words, first word of each row and the end) for runs of rows; null: no words."""
    for row, part, bounds in text_runs(column, CHUNK):
        if len(bounds) == 2 and len(part) > CHUNK * 8:
            hashes = _long_text(part)
            yield row, hashes, np.array([0, len(hashes)])
        else:
            yield row, *_hash_words(part, bounds)


def text_shingles(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of k words of each row; of fewer words, one hash of them all."""
    for _, hashes, firsts in text_words(column):
        if len(hashes) >= k:
            n = len(hashes) - k + 1
            all_ = hashes[:n] * _PLACE[0]
            for i in range(1, k):
                all_ += hashes[i : i + n] * _PLACE[i]
            all_ = mix(all_)
        for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
            if b - a >= k:
                s = np.sort(all_[a : b - k + 1])
                keep = np.empty(len(s), bool)
                keep[0] = True
                np.not_equal(s[1:], s[:-1], out=keep[1:])
                yield s[keep]
            elif b > a:
                yield mix((hashes[a:b] * _PLACE[: b - a]).sum(keepdims=True) + _U(b - a) * _PLACE[-1])
            else:
                yield hashes[:0]
