"""Token ids of whole texts by local vocabulary files: the tokenizers and tiktoken libraries in Arrow batches."""

from __future__ import annotations

import base64
import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pandas import factorize
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from inkwright.llm.store import kept, new_path, small_batches, trimmed
from inkwright.llm.words import _grown, mix, text_runs

#: Different pieces whose ids are kept in a worker, and the longest in bytes; beyond it the cache starts anew.
CACHE, LONG_PIECE = 800_000, 64
#: Bytes of text cut and looked up at a time.
CHUNK = 1 << 18
_U = np.uint64
_RNG = np.random.Generator(np.random.PCG64(7))
_TABLES = _RNG.integers(1, 2**63, (2, 256), dtype=np.uint64) * _U(2) + _U(1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
#: Signs before which a run of letters ends in any case.
_SIGN = np.zeros(256, bool)
_SIGN[list(b".,;:!?*#$%&|()[]{}<>/=+-_@")] = True


def _cut(buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of pieces of the texts buf[bounds[i]:bounds[i + 1]], each text's first piece, and whether it may be cut.

    Cuts are before single spaces and newlines and between a Latin letter and a sign, where no match
    of the byte-level pattern crosses. A text with other white space, or white space at its ends or
    next to other white space, isn't cut.
    """
    n = len(buf)
    space = _SPACE[buf]
    plain = (buf == 32) | (buf == 10)
    bad = space & ~plain
    bad[1:] |= space[1:] & space[:-1]
    full = bounds[:-1][np.diff(bounds) > 0]
    bad[full] |= space[full]
    last = bounds[1:][np.diff(bounds) > 0] - 1
    bad[last] |= space[last]
    for i in np.flatnonzero((buf == 0xC2) | (buf == 0xE1) | (buf == 0xE2) | (buf == 0xE3)).tolist():
        bad[i] |= _WIDE.match(buf[i : i + 3].tobytes()) is not None
    bad |= buf == 0
    texts = np.searchsorted(bounds, np.flatnonzero(bad), "right") - 1
    ok = np.ones(len(bounds) - 1, bool)
    ok[texts] = False
    letter = _LETTER[buf]
    letter[1:] |= (buf[:-1] == 0xC3) & (buf[1:] >= 0x80) & (buf[1:] != 0x97) & (buf[1:] != 0xB7)
    first = plain
    first[1:] |= _SIGN[buf[1:]] & letter[:-1]
    first[full] = True
    starts = np.flatnonzero(first)
    ends = np.append(starts[1:], n)
    return starts, ends, np.searchsorted(starts, bounds), ok


#: White space beyond ASCII, in UTF-8.
_WIDE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")


class IdEncoder:
    """Ids of texts by a file of the tokenizers library, in few calls for each different piece.

    Where the file splits text like byte-level BPE does, texts are cut where no token crosses, each
    different piece (told apart by 128 bits of hash) is encoded once by the library, and a text's
    ids are gathered from its pieces'; other texts and files are encoded whole. The ids are the
    library's for the whole text in either case. Strings of special tokens are ordinary text.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.cuts = spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        self.spaced = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.spaced[[i for t, i in self.tokenizer.get_vocab().items() if "\u0120" in t]] = True
        self._clear()

    def _clear(self) -> None:
        self.n = 0
        self.slots = np.full(1 << 16, -1, np.int32)
        self.key, self.check = np.zeros(1 << 12, np.uint64), np.zeros(1 << 12, np.uint64)
        self.at = np.zeros((1 << 12) + 1, np.int64)
        self.flat = np.zeros(1 << 14, np.uint32)

    def plain(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, or -1: open addressing over slots alone, whose keys stand in self.key."""
        mask = _U(len(self.slots) - 1)
        out, left, at = np.full(len(keys), -1, np.int64), np.arange(len(keys)), keys & mask
        while len(left):
            there = self.slots[at]
            full = there >= 0
            hit = full & (self.key[there] == keys[left])
            out[left[hit]] = there[hit]
            on = full & ~hit
            left, at = left[on], (at[on] + _U(1)) & mask
        return out

    def _enter(self, keys: np.ndarray, slots: np.ndarray) -> None:
        mask = _U(len(self.slots) - 1)
        at = keys & mask
        while len(keys):
            free = self.slots[at] < 0
            self.slots[at[free]] = slots[free]
            mine = free & (self.slots[at] == slots)
            keys, slots, at = keys[~mine], slots[~mine], (at[~mine] + _U(1)) & mask

    def _ids(self, pieces: list[str], spaced: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number for each piece). The first pieces start with a space and are encoded together: only a piece's first id holds a space."""
        ids, sizes = [], []
        parts = [pieces[k : min(k + 256, spaced)] for k in range(0, spaced, 256)]
        for part, got in zip(parts, self.plain(["".join(p) for p in parts]), strict=True):
            firsts = np.flatnonzero(self.spaced[got])
            if len(firsts) == len(part) and firsts[0] == 0:
                ids.append(got)
                sizes.append(np.diff(firsts, append=len(got)))
            else:
                each = self.plain(part)
                ids += each
                sizes.append(np.fromiter(map(len, each), np.int64, len(each)))
        each = self.plain(pieces[spaced:])
        return np.concatenate([*ids, *each]), np.concatenate([*sizes, np.fromiter(map(len, each), np.int64, len(each))])

    def _add(self, keys: np.ndarray, checks: np.ndarray, pieces: list[str], spaced: int) -> None:
        n, m = self.n, self.n + len(pieces)
        ids, sizes = self._ids(pieces, spaced)
        while m > len(self.key):
            self.key, self.check = np.tile(self.key, 2), np.tile(self.check, 2)
            self.at = np.concatenate([self.at, self.at[1:]])
        ends = self.at[n] + np.cumsum(sizes)
        while ends[-1] > len(self.flat):
            self.flat = np.tile(self.flat, 2)
        self.flat[self.at[n] : ends[-1]] = ids
        self.at[n + 1 : m + 1], self.key[n:m], self.check[n:m], self.n = ends, keys, checks, m
        if 2 * m > len(self.slots):
            self.slots = np.full(4 * (1 << m.bit_length()), -1, np.int32)
            self._enter(self.key[:m], np.arange(m))
        else:
            self._enter(keys, np.arange(n, m))

    def _chunk(self, buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends by text) of the texts in buf."""
        starts, ends, firsts, ok = _cut(buf, bounds)
        up, down = _grown(len(buf))
        hashes = []
        for table in _TABLES:
            sums = np.empty(len(buf) + 1, np.uint64)
            sums[0] = 0
            np.cumsum(table[buf] * up[: len(buf)], out=sums[1:])
            hashes.append(mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)))
        keys, checks = hashes
        slots = self._find(keys)
        missing = np.flatnonzero(slots < 0)
        if len(missing):
            codes, new = factorize(keys[missing])
            at = np.empty(len(new), np.int64)
            at[codes[::-1]] = missing[::-1]
            use = ok[np.searchsorted(firsts, at, "right") - 1] & (ends[at] - starts[at] <= LONG_PIECE)
            at, new = at[use], new[use]
            space = buf[starts[at]] == 32
            order = np.argsort(~space, kind="stable")
            at, new = at[order], new[order]
            if len(at):
                data = buf.tobytes()
                self._add(new, checks[at], [data[a:b].decode() for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)], int(space.sum()))
                slots[missing] = self._find(keys[missing])
        lost = (slots < 0) | (self.check[slots] != checks)
        if lost.any():
            ok[np.searchsorted(firsts, np.flatnonzero(lost), "right") - 1] = False
            slots[lost] = 0
        if not ok.all():
            gone = np.repeat(~ok, np.diff(firsts))
        sizes = self.at[slots + 1] - self.at[slots]
        if not ok.all():
            sizes[gone] = 0
        upto = np.cumsum(sizes)
        total = int(upto[-1]) if len(upto) else 0
        ids = self.flat[np.repeat(self.at[slots] - (upto - sizes), sizes) + np.arange(total)]
        text_ends = np.concatenate([[0], upto])[firsts]
        if ok.all():
            return ids, text_ends[1:]
        data = buf.tobytes()
        whole = np.flatnonzero(~ok)
        found = dict(zip(whole.tolist(), self.plain([data[bounds[i] : bounds[i + 1]].decode() for i in whole]), strict=True))
        parts = [found[i] if i in found else ids[text_ends[i] : text_ends[i + 1]] for i in range(len(ok))]
        return np.concatenate(parts), np.cumsum([len(p) for p in parts])

    def __call__(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, ids, ends by row) for runs of rows of texts; null: no ids."""
        if not self.cuts:
            for row in range(0, len(column), 256):
                ids = self.plain([t or "" for t in column[row : row + 256].to_pylist()])
                yield row, np.concatenate(ids), np.cumsum([len(x) for x in ids])
            return
        for row, buf, bounds in text_runs(column, CHUNK):
            yield row, *self._chunk(buf, bounds)
            if self.n > CACHE:
                self._clear()


@kept
def encoder(path: str) -> IdEncoder:
    return IdEncoder(path)


def encoded(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(values of the first column, ids of the texts in the second with end_id after each, their bounds), few rows at a time."""
    encode = encoder(path)
    for batch in batches:
        for row, ids, ends in encode(batch.column(1)):
            bounds = np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])
            yield batch.column(0).slice(row, len(ends)), np.insert(ids, ends, end_id), bounds


def _lists(ids: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *(len(x) // 4 for x in ids)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), "<i4")))


def _encode_sorted(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for keys, ids, bounds in encoded(batches, path, end_id):
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.view(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(np.full(len(keys), part, np.int64)), pa.array(before + bounds[:-1]), pa.array(np.diff(bounds)), lists],
                ["doc_id", "part", "at", "n_ids", "ids"],
            )
            before += int(bounds[-1])

    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(3)
        ends, values = ids.offsets.to_numpy(), ids.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)
        crc = [zlib.crc32(values[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), pa.array(np.diff(ends).astype(np.int64)), pa.array(crc, pa.int64())],
            ["doc_id", "part", "at", "n_tokens", "ids_crc32"],
        )


def write_ids(docs: DataFrame, path: str, vocabulary: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> None:
    """Writes ids of every whole text and end_id as ORC files in ascending id order.

    Columns: doc_id; part, the place of the file; at, the ids before the document in its file; n_ids;
    ids, which ORC keeps run-length encoded. Files have row indexes and Bloom filters on doc_id, so
    that readers skip files, stripes and strides by min, max and filter, and read stripes in
    parallel. The order is a range partitioning: files of one range each, null ids first, equal ids
    next to each other. Null texts hold end_id alone; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    ids = rows.mapInArrow(trimmed(_encode_sorted(vocabulary, end_id)), "doc_id long, part long, at long, n_ids long, ids array<int>")
    (
        ids.write.option("compression", "zstd")
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.row.index.stride", "1000")
        .option("orc.stripe.size", str(16 << 20))
        .option("maxRecordsPerFile", 0)
        .orc(path)
    )


def read_ids(spark, path: str) -> DataFrame:
    """(doc_id, start, n_ids, ids) of files by write_ids; start: the ids of all documents before it."""
    files = spark.read.schema("doc_id long, part long, at long, n_ids long, ids array<int>").orc(path)
    base = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    # one row per file
    base = base.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    return files.join(base, "part").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_ids", "ids")


def orc_digests(docs: DataFrame, vocabulary: str, end_id: int, path: str | None = None) -> DataFrame:
    """Writes docs by write_ids, reads the files back: (doc_id, start, n_tokens, ids_crc32) per document."""
    spark = docs.sparkSession
    path = path or new_path(spark, "orc")
    write_ids(docs, path, vocabulary, end_id)
    files = spark.read.schema("doc_id long, part long, at long, n_ids long, ids array<int>").orc(path)
    rows = files.select("doc_id", "part", "at", "ids").mapInArrow(trimmed(_digests), "doc_id long, part long, at long, n_tokens long, ids_crc32 long")
    base = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    base = base.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    return rows.join(base, "part").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


#: Texts of more characters are cut at safe boundaries before they are encoded.
LONG_TEXT = 50_000


@lru_cache(2)
def rank_encoding(path: str, pattern: str):
    """A tiktoken encoding by a local rank file, without special tokens."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def safe_pieces(text: str) -> Iterator[str]:
    """text, cut before single spaces between characters that aren't white space, where no match crosses."""
    start = 0
    while len(text) - start > LONG_TEXT:
        at = text.find(" ", start + LONG_TEXT)
        while at >= 0 and (at + 1 >= len(text) or text[at + 1].isspace() or text[at - 1].isspace()):
            at = text.find(" ", at + 1)
        if at < 0:
            break
        yield text[start:at]
        start = at
    yield text[start:]


def encode_text(text: str, encoding) -> np.ndarray:
    return np.concatenate([np.asarray(encoding.encode_to_numpy(p, disallowed_special=()), "<u4") for p in safe_pieces(text)])


def _tiktoken(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = rank_encoding(path, pattern)
        for batch in batches:
            n, ids_sha, text_sha = [], [], []
            for text in batch.column(1):
                ids = encode_text(text.as_py() or "", encoding)
                n.append(len(ids))
                ids_sha.append(sha256(ids.tobytes()).hexdigest())
                text_sha.append(sha256(encoding.decode_bytes(ids.tolist())).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def _tiktoken_ids(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = rank_encoding(path, pattern)
        for batch in batches:
            ids = [encode_text(t.as_py() or "", encoding).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(ids)], ["doc_id", "ids"])

    return run


def _tiktoken_decode(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = rank_encoding(path, pattern)
        for batch in batches:
            data = [encoding.decode_bytes(x.as_py() or []) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], ["doc_id", "data"])

    return run


def bpe_encode(docs: DataFrame, ranks: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every whole text; null and empty texts: no ids. Each match of pattern is merged by itself."""
    small_batches(docs.sparkSession)
    return docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string")).mapInArrow(
        trimmed(_tiktoken_ids(ranks, pattern)), "doc_id long, ids array<int>"
    )


def bpe_decode(tokens: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """(doc_id, data binary) of (doc_id, ids): raw bytes, so ids that cut a character in two lose nothing."""
    return tokens.select("doc_id", "ids").mapInArrow(trimmed(_tiktoken_decode(ranks, pattern)), "doc_id long, data binary")


def bpe_digests(docs: DataFrame, ranks: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): bpe_encode and bpe_decode in one pass over every row, equal rows too."""
    small_batches(docs.sparkSession)
    return docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string")).mapInArrow(
        trimmed(_tiktoken(ranks, pattern)), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
