import random
import re
import tracemalloc

import duckdb
import numpy as np
import pyarrow as pa
from inkwright.llm import jaccard
from inkwright.llm.jaccard import jaccard_components
from inkwright.llm.words import text_shingles

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def brute(rows, k, num, den):
    sets = {}
    for i, t in rows:
        w = WORD.findall(lower(t or ""))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
    part = {i: i for i in sets}

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and min(len(x), len(y)) * den >= max(len(x), len(y)) * num:
                both = len(x & y)
                if den * both >= num * (len(x) + len(y) - both):
                    p, q = sorted((find(a), find(b)))
                    part[q] = p
    return {i: (len(sets[i]), find(i)) for i in ids}


def same(spark, rows, k, num, den):
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, component_id string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(df, k, num, den).collect()}
    assert got == brute(rows, k, num, den)


def test_planted_near_copies_and_chains(spark):
    rnd = random.Random(5)
    vocab = [f"w{i}é" for i in range(300)]
    rows, n = [], 0
    for size in (12, 40, 200, 1200):
        base = [rnd.choice(vocab) for _ in range(size)]
        for _ in range(25):
            copy = list(base)
            for _ in range(rnd.randrange(0, max(2, size // 25))):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocab)
            rows.append((n := n + 1, rnd.choice((" ", "\n", "\t ")).join(copy)))
    passage = " ".join(rnd.choice(vocab) for _ in range(60))
    for _ in range(60):
        rows.append((n := n + 1, " ".join(rnd.choice(vocab) for _ in range(rnd.randrange(1, 30))) + " " + passage))
    rnd.shuffle(rows)
    same(spark, rows, 3, 90, 100)
    same(spark, rows, 5, 80, 100)


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "One"), (5, "one"), (6, "one two"), (7, "ONE\x0btwo"), (8, "one two three"), (9, "é"), (10, "É")]
    rows += [(11, "a b " * 400_000 + "end"), (12, "a b " * 400_000 + "end"), (13, "x" * 3_000_000)]
    same(spark, rows, 3, 90, 100)
    df = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (2, "A b c d")], "doc_id long, text string")
    got = sorted(jaccard_components(df, 3, 90, 100).collect(), key=lambda r: (r.doc_id or 0))
    assert [tuple(r) for r in got] == [(None, 2, None), (1, 2, 1), (1, 2, 1), (2, 2, 1)]
    assert jaccard_components(df.limit(0), 3, 90, 100).collect() == []


def test_op8_against_brute_force(spark):
    from inkwright.llm.queries import op8_ngram_jaccard_join

    sf = "/root/testdata/sf0.001"
    rows = duckdb.connect().sql(f"select doc_id, text from '{sf}/documents.parquet'").fetchall()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in op8_ngram_jaccard_join(spark, sf).collect()}
    assert got == brute(rows, 3, 90, 100)


def test_counting_shingles_holds_them_once():
    """Over three million shingles of one task: their counts, and the bytes that counting takes at most."""
    rnd = random.Random(4)
    words = [str(i) for i in range(3000)]
    texts = pa.array([" ".join(rnd.choices(words, k=2000)) for _ in range(1600)])
    batches = [pa.RecordBatch.from_arrays([texts[a : a + 100]], ["text"]) for a in range(0, len(texts), 100)]
    tracemalloc.start()
    (got,) = jaccard._common_counts(2)(iter(batches))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80e6
    h, n = np.unique(np.concatenate(list(text_shingles(texts, 2))), return_counts=True)
    assert got.column(0).to_numpy().view(np.uint64).tolist() == h[n > 1].tolist()
    assert got.column(1).to_numpy().tolist() == n[n > 1].tolist()
    assert len(n) < n.sum() and n.sum() > 3_000_000
    for x in ([], [3], [3, 3], [1, 2, 2, 2, 5, 9, 9]):
        h, n = jaccard._repeated(np.array(x, np.uint64))
        assert list(zip(h.tolist(), n.tolist(), strict=True)) == [(v, x.count(v)) for v in sorted({*x}) if x.count(v) > 1]
