"""Tables written to the shared folder, see inkwright.store, and the size of batches that Python workers get."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import lru_cache, wraps

import pyarrow as pa
from pyspark.sql import SparkSession

from inkwright.store import new_path, shared_dir, written

__all__ = ["kept", "new_path", "shared_dir", "small_batches", "trimmed", "written"]

_BYTES, _DEFAULT, _OWN = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "8388608b"


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most 8 MB in this session, unless it has a size of its own: 10,000 whole texts of some kilobytes, and what is made of them, fill a worker."""
    if spark.conf.get(_BYTES, _OWN) == _DEFAULT:
        spark.conf.set(_BYTES, _OWN)


_makers: list = []
_asked: set = set()


def kept(make: Callable) -> Callable:
    """make, whose last two results a worker keeps for its next tasks, until one that is trimmed ends without having asked for any."""
    cached = lru_cache(2)(make)
    _makers.append(cached)

    @wraps(make)
    def own(*key):
        _asked.add(cached)
        return cached(*key)

    return own


def drop_unasked() -> None:
    for cached in _makers:
        if cached not in _asked:
            cached.cache_clear()
    _asked.clear()


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, after which its worker, which waits for the next task, gives what it has freed back to the system, and of what is kept what it did not use."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        drop_unasked()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)

    return own
