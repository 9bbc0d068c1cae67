import corpus_pipeline
from inkwright.llm import jaccard
from inkwright.llm.jaccard import jaccard_components, jaccard_links

from .test_jaccard import WORD, lower, same

A = "one two three four five six seven eight nine ten eleven twelve"
B = "red green blue black white grey brown pink gold silver orange violet lime"


def test_rows_of_one_id_are_documents_of_their_own(spark):
    rows = [(3, A), (5, A), (5, B), (9, B + " cyan"), (9, B + " cyan"), (None, A), (None, B), (7, ""), (7, ""), (8, None)]
    docs = spark.createDataFrame([(i, t, "en", "web", 1, "g") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, gone_id string")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert got == sorted([(3, A), (5, B), (None, A), (None, B), (7, ""), (7, ""), (8, None)], key=str)
    got = sorted(((r.doc_id, r.component_id) for r in jaccard_components(docs, 5, 80, 100).collect()), key=str)
    assert got == sorted([(3, 3), (5, 3), (5, 5), (9, 5), (9, 5), (None, None), (None, None), (7, 7), (7, 7), (8, 8)], key=str)
    assert corpus_pipeline.drop_near_duplicates(spark, docs.limit(0), "").collect() == []


def test_one_of_repeated_rows_stays(spark):
    docs = spark.createDataFrame([(1, A, "x"), (1, A, "x"), (2, A, "x")], "doc_id long, text string, lang string")
    assert [tuple(r) for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()] == [(1, A, "x")]


def test_long_lists_cut_into_parts(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SPLIT", 4)
    monkeypatch.setattr(jaccard, "HOT_ROWS", 3)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*words[: i % 50], f"edit{i}", *words[i % 50 + 1 :]])) for i in range(1, 90)]
    rows += [(100 + i, " ".join(words)) for i in range(20)] + [(200, "alone and apart from all the others of this table")]
    same(spark, rows, 3, 90, 100)
    same(spark, rows, 5, 80, 100)


def test_all_links(spark):
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*words[: i % 50], f"edit{i}", *words[i % 50 + 1 :]])) for i in range(1, 30)] + [(50, " ".join(words)), (51, " ".join(words)), (60, ""), (None, A)]
    links, members = jaccard_links(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90, 100)
    sets = {i: {tuple(w[j : j + 3]) for w in [WORD.findall(lower(t))] for j in range(len(w) - 2)} for i, t in rows if i}
    linked = {(a, b) for a in sets for b in sets if a != b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])}
    got = members.collect()
    assert {r.doc_id: r.n_links for r in got if r.doc_id} == {i: sum(a == i for a, _ in linked) for i in sets}
    node = {r.doc_id: r.node for r in got}
    assert {frozenset((r.a, r.b)) for r in links.collect()} == {frozenset((node[a], node[b])) for a, b in linked if node[a] != node[b]}
    assert node[60] is None and node[None] is None
