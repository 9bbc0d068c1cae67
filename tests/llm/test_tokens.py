import gc
import random
import tracemalloc
import weakref
import zlib
from hashlib import sha256

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from inkwright.llm.packing import fullest, min_bin_slack, pack
from inkwright.llm.store import trimmed
from inkwright.llm.tokens import IdEncoder, bpe_decode, bpe_digests, bpe_encode, encoder, orc_digests, rank_encoding, safe_pieces

JSON, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken")
ODD = [
    None, "", " ", "\n", "a", " a", "a ", "a  b", "a\n\nb", "a\n b", "\0", "x\0y z", "it's 'tis don't\n's", "été fin", "日本 語　x",
    "<|endoftext|> <|endoftext|>", "é ́x", "a\tb c\r\nd", "  lead", "trail\n", "x" * 5000, "3.14 ²Ⅷ", "\n\n", "🙂 🙂\n🙂", "\x1c a\x85b",
]


def plain(texts):
    t = Tokenizer.from_file(JSON)
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_cached_encoder_equals_the_library():
    rnd = random.Random(3)
    parts = ["a", "don't", " ", "\n", "é", "12", "!?", "'s", "  ", "\t", "word", " ", "'", "_x", "\0"]
    texts = [x or "" for x in ODD] + ["".join(rnd.choice(parts) for _ in range(rnd.randrange(30))) for _ in range(3000)]
    encode = IdEncoder(JSON)
    texts += ["Wörter, ÷.×. x…. «a».b c'd.e", "a-b (c) [d]: 'e' \"f\"", "straße.Next line!?\nnew 'line' 12.5% a1,b2", "end."]
    expected = plain(texts)
    for a, b in ((0, len(texts)), (0, 700), (700, 2000)):
        got = []
        for _, ids, ends in encode(pa.array(texts[a:b])):
            got += [x.tolist() for x in np.split(ids, ends[:-1])]
        assert got == expected[a:b]


def test_encoder_memory_with_many_different_words():
    """A worker's cache of over half a million pieces and what it makes of a run of texts, in bytes."""
    rnd = random.Random(5)
    words = rnd.sample(range(26**5), 540_000)
    spelt = ["".join(chr(97 + w // 26**i % 26) for i in range(5)) for w in words]
    texts = [" ".join(spelt[a : a + 500]) for a in range(0, len(spelt), 500)]
    encode = IdEncoder(JSON)
    tracemalloc.start()
    for _ in encode(pa.array(texts)):
        pass
    kept, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert encode.n > 530_000
    assert kept < 70e6 and peak < 100e6
    assert [x.tolist() for _, ids, ends in encode(pa.array(texts[:9])) for x in np.split(ids, ends[:-1])] == plain(texts[:9])


def test_a_worker_keeps_the_encoder_while_its_tasks_use_it():
    seen = []
    uses = trimmed(lambda batches: (seen.append(weakref.ref(encoder(JSON))) or b for b in batches))
    others = trimmed(iter)
    list(others([0]))
    list(uses([1]))
    list(uses([2]))
    assert seen[0]() is seen[1]() is not None
    list(others([3]))
    gc.collect()
    assert seen[0]() is None


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "?") for i, t in enumerate(texts)], "doc_id long, text string, start string")


def test_orc_round_trip(spark, tmp_path):
    df = frame(spark, ODD).repartition(5)
    rows = {r.doc_id: r for r in orc_digests(df, JSON, 2).collect()}
    start = 0
    for i, ids in enumerate(plain(ODD)):
        data = np.array([*ids, 2], "<u4").tobytes()
        assert tuple(rows[i]) == (i, start, len(ids) + 1, zlib.crc32(data))
        start += len(ids) + 1
    assert len(rows) == len(ODD)
    assert orc_digests(df.limit(0), JSON, 2).collect() == []
    again = spark.createDataFrame([(7, "a b"), (7, "a b"), (None, None)], "doc_id long, text string")
    got = sorted(tuple(r)[:3] for r in orc_digests(again, JSON, 2).collect() if r.doc_id)
    assert got == [(7, 1, 3), (7, 4, 3)]


def test_tiktoken_round_trip(spark):
    enc = rank_encoding(RANKS, P.PATTERN)
    texts = ODD + ["word and more, " * 20_000, "é" * 120_000]
    rows = {r.doc_id: r for r in bpe_digests(frame(spark, texts), RANKS, P.PATTERN).collect()}
    for i, t in enumerate(texts):
        ids = enc.encode_ordinary(t or "")
        assert rows[i].n_tokens == len(ids)
        assert rows[i].ids_sha256 == sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert rows[i].decoded_sha256 == sha256((t or "").encode()).hexdigest()
    ids = bpe_encode(frame(spark, texts), RANKS, P.PATTERN)
    back = {r.doc_id: bytes(r.data) for r in bpe_decode(ids, RANKS, P.PATTERN).collect()}
    assert back == {i: (t or "").encode() for i, t in enumerate(texts)}
    assert isinstance(enc, tiktoken.Encoding)


def test_safe_pieces_join_to_the_text():
    text = "a b  c\n d " * 30_000
    pieces = list(safe_pieces(text))
    assert len(pieces) > 3 and "".join(pieces) == text


@pytest.mark.parametrize("seed", range(30))
def test_fullest_is_the_best_sum(seed):
    rnd = random.Random(seed)
    counts = [0] + [rnd.choice((0, 0, 1, 2)) for _ in range(40)]
    room = rnd.randrange(1, 41)
    sums = {0}
    for n, c in enumerate(counts):
        for _ in range(c):
            sums |= {s + n for s in sums if s + n <= room}
    got = fullest(counts, room)
    assert sum(n * c for n, c in got) == max(sums)
    assert all(c <= counts[n] for n, c in got)


def test_min_bin_slack_places_everything():
    rnd = random.Random(1)
    counts = [0] + [rnd.randrange(50) for _ in range(128)]
    plan = min_bin_slack(counts, 128)
    placed = [0] * 129
    for bin_, times in plan:
        assert sum(n * c for n, c in bin_) <= 128
        for n, c in bin_:
            placed[n] += c * times
    assert placed == counts
    # the Martello-Toth bound: pieces over half a bin are alone, and smaller ones fill what these leave
    least = 0
    for a in range(65):
        over = sum(counts[128 - a + 1 :])
        half = [(n, counts[n]) for n in range(65, 128 - a + 1)]
        small = sum(n * counts[n] for n in range(a, 65))
        room = sum((128 - n) * c for n, c in half)
        least = max(least, over + sum(c for _, c in half) + max(0, -(-(small - room) // 128)))
    assert sum(t for _, t in plan) <= least * 1.01 + 1


def test_pack_small(spark):
    rnd = random.Random(9)
    texts = ODD + ["tok " * rnd.randrange(1, 300) for _ in range(120)] + ["tok " * 3000]
    rows = pack(frame(spark, texts), JSON, size=256, end_id=0).collect()
    whole = {i: [*ids, 0] for i, ids in enumerate(plain(texts))}
    seqs, docs = {}, {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
        docs.setdefault(r.doc_id, []).append(r)
        assert r.ids_crc32 == zlib.crc32(np.array(whole[r.doc_id][r.start : r.start + r.length], "<u4").tobytes())
    for own in seqs.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 256
    for i, ids in whole.items():
        own = sorted(docs[i], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert sum(r.length for r in own) == len(ids)
        assert all(r.length == 256 for r in own[1:]) and (len(own) > 1 or len(ids) <= 256)
    assert len(seqs) <= -(-sum(map(len, whole.values())) // 256) + 1
    assert pack(frame(spark, []), JSON).collect() == []
