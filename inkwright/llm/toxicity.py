"""Toxicity scores from a weighted lexicon, learnt from labelled documents and matched by Aho-Corasick."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from math import exp, log, log1p

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwright.llm.store import small_batches, trimmed, written
from inkwright.llm.words import mix, text_shingles

#: Labelled documents that a model is fitted on: those of least hash, about so many. The lexicon and
#: the calibration come from them; scores are of all documents.
LABELLED = 20_000
#: Shortest and longest stem, least toxic documents of an entry, least share of toxic documents among those
#: that hold it at equal class sizes, most entries.
STEM, LONGEST, LEAST_DOCS, LEAST_SHARE, ENTRIES = 4, 12, 3, 0.9, 5000
#: Bands and rows by which copies among labelled documents are found: of texts that share 0.8 of their shingles 99 in 100, 0.2 one in 20.
BANDS, ROWS = 6, 3
#: Phrases in which a word of the lexicon is harmless, folded like texts.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "trash collection", "clown fish", "clownfish", "class clown", "trashcan", "idiot proof", "scum line", "pond scum")
#: Letters that look like Latin ones, and digits and signs that stand for letters between letters. Fixed values.
HOMOGLYPHS = dict(zip("авекмнорстухіїјѕԁԛԝһӏαβεικνορτυχωϲıłøđ", "abekmhopctyxiijsdqwhlabeikvoptuxwcilod", strict=True))
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i"}
_MIXED = re.compile(r"[a-z]*(?:[a-z][0-9@$!]+(?=[a-z])|(?<![a-z0-9@$!])[013457@$](?=[a-z]))[a-z0-9@$!]*")
_TO_LETTERS = str.maketrans(SIGNS)


class _Folds(dict):
    """Lower case, one letter without marks for each look-alike; what is no letter, digit or sign of a word: a space."""

    def __missing__(self, code: int) -> str:
        out = ""
        for c in unicodedata.normalize("NFKD", chr(code)).lower():
            if unicodedata.combining(c):
                continue
            c = HOMOGLYPHS.get(c, c)
            out += c if c.isalnum() or c in "@$!" else " "
        if unicodedata.category(chr(code)) in ("Cf", "Mn"):
            out = ""
        self[code] = out
        return out


_folds = _Folds()


def fold(text: str) -> str:
    """text for matching: folded letters, one space before and after it; signs stay where _MIXED may read them."""
    return f" {text.translate(_folds)} "


_DROP_SIGNS = str.maketrans({c: " " for c in "@$!"})


def folded_words(text: str) -> tuple[str, list[str]]:
    """The folded text without signs, and its words in which digits and signs stand for letters, so read."""
    t = fold(text)
    mixed = [m[0].rstrip("!@$").translate(_TO_LETTERS) for m in _MIXED.finditer(t)] if _has_sign(t) else []
    return t.translate(_DROP_SIGNS) if "!" in t or "$" in t or "@" in t else t, mixed


_SIGN = re.compile(r"[0-9@$!][a-z]")


def _has_sign(t: str) -> bool:
    return _SIGN.search(t) is not None


@dataclass(frozen=True)
class Model:
    """Stems with weights, harmless words and phrases, and a logistic curve over (matched weight, density, length)."""

    lexicon: tuple[tuple[str, float], ...]
    exceptions: tuple[str, ...] = EXCEPTIONS
    curve: tuple[float, ...] = (-3.0, 1.5, 0.0)
    words: tuple[str, ...] = field(default=())


@lru_cache(4)
def automaton(model: Model):
    """Stems match where words start; a phrase or word of the exceptions takes back the stems inside it."""
    import ahocorasick

    a = ahocorasick.Automaton()
    for stem, weight in model.lexicon:
        a.add_word(" " + stem, (len(stem) + 1, weight))
    for phrase in (*model.exceptions, *model.words):
        key = f" {fold(phrase).strip()} "
        if key not in a:
            a.add_word(key, (len(key), 0.0))
    if len(a):
        a.make_automaton()
    return a


def matched(text: str, a) -> tuple[float, int]:
    """Weight of the matches outside exceptions, and the number of words."""
    t, mixed = folded_words(text)
    total = 0.0
    if len(a):
        for part in (t, f" {' '.join(mixed)} " if mixed else ""):
            hits, bars = [], []
            for end, (size, weight) in a.iter(part):
                (hits if weight else bars).append((end - size + 1, end, weight))
            if bars:  # both in order of their starts, and how far the exceptions that have begun reach
                hits.sort()
                bars.sort()
            at, reach = 0, -1
            for start, end, weight in hits:
                while at < len(bars) and bars[at][0] <= start:
                    reach = max(reach, bars[at][1])
                    at += 1
                if reach < end:
                    total += weight
    return total, t.count(" ") - 1


def features(weight: float, words: int) -> tuple[float, float]:
    """Matched weight, and the same for its text's length."""
    return log1p(weight), log1p(weight * 100 / (words + 20))


def probability(model: Model, weight: float, words: int) -> float:
    a, *b = model.curve
    z = a + sum(x * y for x, y in zip(b, features(weight, words), strict=True))
    return 1 / (1 + exp(-max(-30.0, min(30.0, z))))


def _stems(text: str) -> set[str]:
    t, mixed = folded_words(text)
    words = set(t.split())
    words.update(mixed)
    return {w[:n] for w in words if not w[0].isdigit() for n in range(STEM, min(len(w), LONGEST) + 1)}


def _count_stems(kept):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter = Counter()
        whole: Counter = Counter()
        for batch in batches:
            for t in batch.column(0):
                if t.as_py():
                    stems = _stems(t.as_py())
                    n.update(stems if kept is None else stems & kept.value[0])
                    if kept is not None:
                        words = folded_words(t.as_py())[0].split()
                        whole.update({w for w in words if any(w[:k] in kept.value[1] for k in range(STEM, len(w) + 1))})
        yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64()), pa.array([False] * len(n), pa.bool_())], ["stem", "n", "word"])
        yield pa.RecordBatch.from_arrays([pa.array(list(whole), pa.string()), pa.array(list(whole.values()), pa.int64()), pa.array([True] * len(whole), pa.bool_())], ["stem", "n", "word"])

    return run


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row with BANDS hashes of least shingles of five words in BANDS * ROWS orders."""
    odd = np.random.Generator(np.random.PCG64(17)).integers(1, 2**63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for batch in batches:
        bands = [[xxhash.xxh3_64_intdigest(np.array([mix(s * m).min() for m in own]).tobytes()) for own in odd] if len(s) else [0] * BANDS for s in text_shingles(batch.column(1), 5)]
        flat = pa.array(np.array(bands, np.uint64).view(np.int64).reshape(-1))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, BANDS, dtype=np.int32)), flat)
        yield pa.RecordBatch.from_arrays([*batch.columns, lists], ["doc_id", "text", "toxic", "bands"])


def _one_of_copies(ids: list[int], labels: list[int], bands: list[list[int]]) -> list[int]:
    """The least id of each group of rows that share a label and a band with another of the group."""
    part = list(range(len(ids)))

    def find(x: int) -> int:
        while part[x] != x:
            part[x] = part[part[x]]
            x = part[x]
        return x

    first: dict[tuple[int, int, int], int] = {}
    for row in sorted(range(len(ids)), key=ids.__getitem__):
        for at, band in enumerate(bands[row]):
            a, b = find(first.setdefault((labels[row], at, band), row)), find(row)
            if a != b:
                low, high = (a, b) if ids[a] < ids[b] else (b, a)
                part[high] = low
    return [ids[row] for row in range(len(ids)) if find(row) == row]


def _weights(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = automaton(model.value)
        for batch in batches:
            got = [matched(t.as_py() or "", a) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).cast(pa.int32()), pa.array([w for w, _ in got], pa.float64()), pa.array([n for _, n in got], pa.int64())], ["toxic", "weight", "words"]
            )

    return run


def _closed(toxic: dict[str, int]) -> dict[str, int]:
    """Stems without those that nearly always go on by one same letter, for which the longer one stands."""
    longer: dict[str, int] = {}
    for s, n in toxic.items():
        if len(s) > STEM:
            longer[s[:-1]] = max(longer.get(s[:-1], 0), n)
    return {s: n for s, n in toxic.items() if longer.get(s, 0) < 0.95 * n}


def _evidence(toxic: int, clean: int, rate: float) -> float:
    """-log of about the chance that toxic or more of the documents with a stem are, where rate of all are."""
    n = toxic + clean
    p = toxic / n
    return n * (p * log(p / rate) + ((1 - p) * log((1 - p) / (1 - rate)) if clean else 0.0)) if p > rate else 0.0


def _is_harmless(clean: int, toxic: int, n0: int, n1: int, tried: int) -> bool:
    """Whether a word is of clean documents by the tests that make a stem one of toxic documents."""
    share = (clean / n0) / (clean / n0 + (toxic + 0.5) / n1)
    return share >= LEAST_SHARE and _evidence(clean, toxic, n0 / (n0 + n1)) > log(tried) + 2


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, ...]:
    """Intercept and coefficients by Newton's method, each class weighing half; coefficients of 0 or more."""
    x = np.column_stack([np.ones(len(x)), x])
    use = list(range(x.shape[1]))
    w = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    while True:
        b = np.zeros(len(use))
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x[:, use] @ b, -30, 30)))
            h = (x[:, use] * (w * p * (1 - p))[:, None]).T @ x[:, use] + ridge * np.eye(len(use))
            step = np.linalg.solve(h, x[:, use].T @ (w * (y - p)) - ridge * b)
            b += step
            if np.abs(step).max() < 1e-8:
                break
        bad = [u for u, c in zip(use, b, strict=True) if u and c < 0]
        if not bad:
            out = np.zeros(x.shape[1])
            out[use] = b
            return tuple(map(float, out))
        use.remove(bad[0])


def fit(docs: DataFrame, labels: DataFrame, trains: Column | None = None, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """A model from the labelled documents (those of which trains, a Column over doc_id, holds).

    Stems are prefixes of folded words, kept where toxic documents outweigh the others by more than
    chance would bring about among all stems; whole words that start with a kept stem become
    exceptions where clean documents outweigh toxic ones by the same test. Of copies, near ones too, with one label one
    counts; of several texts of a doc_id the least. Several labels of a document: the greatest.
    Null labels and documents without a text teach nothing. Without labels of both classes the lexicon is empty.
    """
    small_batches(docs.sparkSession)
    own = labels.select(labels[doc_id].cast("long").alias("doc_id"), labels[label].cast("int").alias("toxic")).where("doc_id is not null and toxic is not null")
    own = own if trains is None else own.where(trains)
    own = own.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # at most LABELLED rows of two numbers
    sample = written(own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED), "labels")
    texts = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text")).where("text is not null")
    # as many rows as the sample has, each of one text
    rows = texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    rows = written(rows.mapInArrow(trimmed(_bands), "doc_id long, text string, toxic int, bands array<long>"), "labelled")
    # copies would make any word of theirs look like a mark of their label
    known = rows.select("doc_id", "toxic", "bands").collect()
    kept = _one_of_copies([r["doc_id"] for r in known], [r["toxic"] for r in known], [r["bands"] for r in known])
    kept = docs.sparkSession.createDataFrame([(i,) for i in kept], "doc_id long")
    rows = rows.join(F.broadcast(kept), "doc_id").select("text", "toxic")
    size = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n1, n0 = size.get(1, 0), size.get(0, 0)
    if not n1 or not n0:
        return Model(())
    schema = "stem string, n long, word boolean"
    least = max(LEAST_DOCS, n1 // 1000)
    toxic = rows.where("toxic = 1").select("text").mapInArrow(trimmed(_count_stems(None)), schema)
    toxic = written(toxic.groupBy("stem").agg(F.sum("n").alias("n")), "stems")
    tried = toxic.count()
    found = toxic.where(F.col("n") >= least).orderBy(F.desc("n"), "stem").limit(20 * ENTRIES).collect()
    found = _closed({r["stem"]: r["n"] for r in found})
    spark = docs.sparkSession
    clean_rows = rows.where("toxic = 0").select("text")
    clean = {r["stem"]: r["n"] for r in clean_rows.mapInArrow(trimmed(_count_stems(spark.sparkContext.broadcast((set(found), set())))), schema).groupBy("stem").agg(F.sum("n").alias("n")).collect()}
    share = lambda s: (found[s] / n1) / (found[s] / n1 + (clean.get(s, 0) + 0.5) / n0)
    kept: dict[str, float] = {}
    for s in sorted(found, key=lambda s: (len(s), s)):
        if share(s) >= LEAST_SHARE and _evidence(found[s], clean.get(s, 0), n1 / (n1 + n0)) > log(tried) + 2 and not any(s[:k] in kept for k in range(STEM, len(s))):
            kept[s] = log(share(s) / (1 - share(s)))
    kept = dict(sorted(kept.items(), key=lambda x: (-x[1], x[0]))[:ENTRIES])
    # whole words that start with a kept stem, by the documents of each class that hold them
    starts = _count_stems(spark.sparkContext.broadcast((set(), set(kept))))
    per_word = lambda part: part.mapInArrow(trimmed(starts), schema).where("word").groupBy("stem").agg(F.sum("n").alias("n"))
    in_toxic = per_word(rows.where("toxic = 1").select("text")).select("stem", F.col("n").alias("toxic"))
    words = per_word(clean_rows).join(in_toxic, "stem", "left").orderBy(F.desc("n"), "stem").limit(20 * ENTRIES).collect()
    harmless = [r["stem"] for r in words if _is_harmless(r["n"], r["toxic"] or 0, n0, n1, len(words))][:ENTRIES]
    model = Model(tuple(sorted(kept.items())), words=tuple(sorted(harmless)))
    got = rows.mapInArrow(trimmed(_weights(spark.sparkContext.broadcast(model))), "toxic int, weight double, words long").toPandas()
    x = np.array([features(w, n) for w, n in zip(got["weight"], got["words"], strict=True)])
    return Model(model.lexicon, model.exceptions, logistic(x, got["toxic"].to_numpy(float)), model.words)


def _scores(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        a = automaton(m)
        for batch in batches:
            p = [probability(m, *matched(t.as_py() or "", a)) for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(p, pa.float64())], [*batch.schema.names[:-1], "score"])

    return run


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every row, 0 to 1; null and empty texts score as texts without a match.

    Null ids and repeated rows come back each; other columns, whatever their names, are not read; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    return rows.mapInArrow(trimmed(_scores(docs.sparkSession.sparkContext.broadcast(model))), "doc_id long, score double")


def keep_clean(docs: DataFrame, model: Model, least: float = 0.5, text: str = "text") -> DataFrame:
    """The rows of docs that score below least, with their columns, whatever their names."""
    small_batches(docs.sparkSession)
    kept = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = automaton(kept.value)
        for batch in batches:
            ok = [probability(kept.value, *matched(t.as_py() or "", a)) < least for t in batch.column(at)]
            yield batch.filter(pa.array(ok, pa.bool_()))

    return docs.mapInArrow(trimmed(run), docs.schema)
