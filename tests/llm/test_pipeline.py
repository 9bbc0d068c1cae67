import re

import duckdb

import corpus_pipeline
from inkwright.llm import toxicity

from .test_jaccard import brute
from .test_native import base

SF = "/root/testdata/sf0.001"


def test_stages_in_order_against_brute_force(spark):
    con = duckdb.connect()
    documents = con.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
    docs, seen = spark.read.parquet(f"{SF}/documents.parquet"), []
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        seen.append((name, {r.doc_id: r for r in docs.collect()} if "text" in docs.columns else docs.collect()))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    assert [n for n, _ in seen] == ["toxicity", "ngram_jaccard_join", "secret_scan", "best_fit_packing"]
    clean, unique, redacted, packed = (x for _, x in seen)
    source = spark.read.parquet(f"{SF}/documents.parquet")
    scores = toxicity.score(source, toxicity.fit(source, spark.read.parquet(f"{SF}/labels.parquet"))).collect()
    assert set(clean) == {r.doc_id for r in scores if r.score < 0.5}
    groups = brute([(i, t) for i, t in documents if i in clean], 5, 80, 100)
    assert set(unique) == {i for i, (_, c) in groups.items() if i == c}
    assert set(redacted) == set(unique)
    for i, r in redacted.items():
        assert not base(re.sub(r"\[secret\]", "", r.text)) or not base(unique[i].text)
        assert ("[secret]" in r.text) >= bool(base(unique[i].text))
        assert r.n_chars == len(r.text)
    assert {r.doc_id for r in packed} == set(redacted)
    again = corpus_pipeline.run(spark, SF)
    key = lambda rows: sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert key(again.collect()) == key(packed)
    assert len({r.sequence_id for r in packed}) <= -(-sum(r.length for r in packed) // 2048) + 1
