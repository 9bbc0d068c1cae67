import random
import zlib

import duckdb

from inkwright.llm.toxicity import Model, automaton, fit, fold, folded_words, keep_clean, matched, probability, score


def test_folding_and_exceptions():
    m = Model((("idiot", 2.0), ("trash", 1.5), ("lowei", 1.0)))
    a = automaton(m)
    weight = lambda t: matched(t, a)[0]
    assert weight("An IDIOT!") == 2 and weight("idiots, idiotic") == 4
    assert weight("іdіоt") == 2  # Cyrillic letters
    assert weight("ｉｄｉｏｔ ídïot") == 4
    assert weight("1d10t id!ot tr4$h") == 5.5
    assert weight("videot not-a-trasher") == 1.5
    assert weight("put it in the trash can") == 0 and weight("trash can trash") == 1.5
    assert weight("Loweißchaft") == 1
    assert weight("") == 0 and weight("10 000 $$$ !!! @") == 0
    assert fold("a​b") == " ab " and folded_words("5 apples 300")[1] == []


def test_scores_edges(spark):
    m = Model((("idiot", 2.0),), curve=(-2.0, 1.0, 1.0))
    df = spark.createDataFrame([(1, None, 2.0), (1, None, 2.0), (None, "idiot", 1.0), (3, "", 0.0), (4, "ok " * 500_000, 0.0)], "doc_id long, text string, score double")
    got = score(df, m).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert {r.doc_id for r in got if r.score >= 0.5} == {None}
    kept = keep_clean(df, m)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 1, 3, 4]
    assert score(df.limit(0), m).collect() == []
    assert fit(df, df.selectExpr("doc_id", "0 as toxic").limit(0)).lexicon == ()
    assert probability(Model(()), 0.0, 0) < 0.5


def test_learns_planted_words(spark):
    rnd = random.Random(4)
    words = ["".join(rnd.choice("aeioubcdlmnrst") for _ in range(rnd.randrange(2, 9))) for _ in range(400)]
    rows, labels = [], []
    for i in range(600):
        w = [rnd.choice(words) for _ in range(rnd.randrange(5, 200))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(1 + len(w) // 60):
                w.insert(rnd.randrange(len(w)), rnd.choice(("zugrobe", "zugrobish", "Vexklam")))
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = fit(docs, marks.where("doc_id < 300"))
    got = {r.doc_id: r.score >= 0.5 for r in score(docs, model).collect()}
    right = sum(got[i] == bool(t) for i, t in labels if i >= 300)
    assert right >= 290


def test_op1_held_out(spark):
    from inkwright.llm.queries import op1_toxicity

    sf = "/root/testdata/sf0.01"
    rows = op1_toxicity(spark, sf).collect()
    labels = dict(duckdb.connect().sql(f"select doc_id, toxic from '{sf}/labels.parquet'").fetchall())
    assert len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    own = [r for r in rows if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in own) >= 0.93 * len(own)


def test_a_few_mislabelled_documents_do_not_silence_a_word(spark):
    rnd = random.Random(7)
    words = ["".join(rnd.choice("aeioubcdlmnrst") for _ in range(rnd.randrange(3, 9))) for _ in range(400)]
    rows, labels = [], []
    for i in range(600):
        w = [rnd.choice(words) for _ in range(40)]
        bad = i % 4 == 0
        if bad:
            w.insert(rnd.randrange(len(w)), "vexklam")
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad and i % 200 != 0)))  # three toxic documents are labelled clean
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = fit(docs, marks)
    assert "vexklam" not in model.words and matched("so vexklam it is", automaton(model))[0] > 0
    got = {r.doc_id for r in score(docs, model).collect() if r.score >= 0.5}
    assert got == {i for i in range(600) if i % 4 == 0}
