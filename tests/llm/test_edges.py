"""Nulls, empty and long texts, repeated rows, empty tables and clashing names through each stage of the pipeline and through secrets and toxicity."""

import random
import time

import corpus_pipeline
import pytest
from inkwright.llm.secrets import find_secrets, redact
from inkwright.llm.toxicity import Model, automaton, matched

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node long, class string, runs string, _spans string, score double, gone_id long"
MORE = ("en", "web", 1, 7, "c", "r", "s", 0.5, 3)


def rows():
    rnd = random.Random(3)
    secret = 'token = "9233A8ECF7C5B09FE5949719B6B82BC4"'
    long_text = " ".join(rnd.choice(("alpha", "beta", "gamma", "delta")) + str(rnd.randrange(10_000)) for _ in range(60_000))
    texts = [None, "", " ", "one", secret, secret, long_text, long_text + " more", "É　\n\t", "a b c d e f g"]
    return [(i, t, *MORE) for i, t in enumerate(texts)] + [(9, "a b c d e f g", *MORE), (None, "a b c d e f g", *MORE), (None, None, *MORE)]


@pytest.mark.parametrize("at", range(4))
def test_stage_takes_any_rows(spark, at):
    name, stage = corpus_pipeline.STAGES[at]
    docs = spark.createDataFrame(rows(), SCHEMA)
    out = stage(spark, docs, SF)
    got = out.collect()
    if at < 3:
        assert out.columns == docs.columns
        assert len(got) == {"toxicity": 13, "ngram_jaccard_join": 10, "secret_scan": 13}[name]
    else:
        ids = [r.doc_id for r in got]
        assert {*ids} == {None, *range(10)} and min(r.length for r in got) >= 1
    assert stage(spark, docs.limit(0), SF).collect() == []


def test_secrets_beside_clashing_columns(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    out = redact(docs)
    assert out.columns == docs.columns
    by = {r.doc_id: r for r in out.collect() if r.doc_id is not None}
    assert "[secret]" in by[4].text and by[0].text is None and by[4].runs == "r" and by[4]._spans == "s"
    assert find_secrets(docs).columns == [*docs.columns, "base_spans", "secret_spans"]


def test_markov_models_tell_random_strings_from_names(spark):
    """Recall on random strings in plain text, and precision among long identifiers, by models fitted beside them."""
    rnd = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    words = ["request", "handler", "factory", "manager", "customer", "payment", "address", "template", "context", "builder", "session", "monitor"]
    random_ = ["".join(rnd.choice(letters) for _ in range(rnd.randrange(24, 44))) for _ in range(200)]
    names = [rnd.choice(("_", "-")).join(rnd.choice(words) for _ in range(rnd.randrange(3, 6))) for _ in range(400)]
    docs = spark.createDataFrame([(i, f"see {s} here") for i, s in enumerate([*random_, *names])], "doc_id long, text string")
    found = {r.doc_id: [s.kind for s in r.secret_spans] for r in find_secrets(docs).collect()}
    caught = sum("random" in found[i] for i in range(200))
    wrong = sum("random" in found[i] for i in range(200, 600))
    assert caught >= 190 and wrong <= 4


def test_exceptions_take_linear_time():
    model = Model((("idiot", 2.0), ("scum", 2.0)), exceptions=("pond scum",), words=("idiotic",))
    a = automaton(model)
    assert matched("idiot idiotic pond scum scum", a)[0] == 4.0
    text = "idiotic idiot pond scum " * 20_000
    began = time.process_time()
    assert matched(text, a)[0] == 40_000.0
    assert time.process_time() - began < 5
