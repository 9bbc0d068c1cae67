import json
import random
import unicodedata
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inkwright.functions import score as S
from inkwright.functions import text as T
from inkwright.functions.text import HAN, LATIN


def column(spark, values, f, kind="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, s {kind}")
    return [r.v for r in df.select("i", f(F.col("s")).alias("v")).orderBy("i").collect()]


def test_han_boundaries(spark):
    edges = [0x3400, 0x4DBF, 0x4E00, 0x9FFF, 0xF900, 0xFAFF, 0x20000, 0x323AF]
    points = [p for e in edges for p in (e - 1, e, e + 1)]
    inside = lambda p: 0x3400 <= p <= 0x4DBF or 0x4E00 <= p <= 0x9FFF or 0xF900 <= p <= 0xFAFF or 0x20000 <= p <= 0x323AF
    assert column(spark, [chr(p) for p in points], lambda c: T.is_letter(c, HAN)) == [inside(p) for p in points]
    want = ["ExtB+" if p >= 0x20000 else "BMP" if 0x4E00 <= p <= 0x9FFF else "ExtA" if 0x3400 <= p <= 0x4DBF else "Compat" if 0xF900 <= p <= 0xFAFF else "other" for p in points]
    assert column(spark, [chr(p) for p in points], T.plane) == want
    assert column(spark, ["㗎", "𨋢"], T.code_point) == ["U+035CE", "U+282E2"]


def test_cleaning(spark):
    raw = ["a　b c", "x\ny\tz", "甲[12]乙", "see https://a.b/c?d=1 now", "  many \r\n spaces  ", "", None]
    assert column(spark, raw, T.clean_text) == ["a b c", "xyz", "甲乙", "see now", "many spaces", "", None]
    assert column(spark, ["one\n two.  three"], lambda c: T.clean_text(c, "split")) == ["one\n two. three"]
    assert column(spark, ["，你好abc！：", "、x、"], lambda c: T.keep_allowed(c, HAN)) == ["你好！", ""]


def test_predicates_one_by_one(spark):
    ok = "我哋今日去飲茶啦"
    rows = [ok, "短", "長" * 26, "我abcdefg哋", "好好好好好呀", "電話號碼係１２３４５６呀好長嘅字", "有|號嘅句子", None]
    assert column(spark, rows, lambda c: T.reject_reason(c, HAN)) == [None, "length", "length", "letters", "run", "digits", "markup", None]
    assert column(spark, rows[:2], lambda c: T.acceptable(c, HAN)) == [True, False]
    assert column(spark, [ok, ok], lambda c: T.acceptable(c, HAN, ["唔"])) == [False, False]
    assert column(spark, ["飲茶", "飲a", "一二三四五", "é"], lambda c: T.word_entry(c, HAN)) == [True, False, False, False]
    assert column(spark, ["été"], lambda c: T.word_entry(c, LATIN)) == [True]


def test_small_functions(spark):
    assert column(spark, ["Noto-Sans_TC"], T.stem) == ["notosanstc"]
    assert column(spark, ["<a href=\"x\">&"], T.escape_html) == ["&lt;a href=&quot;x&quot;&gt;&amp;"]
    assert column(spark, ["冇𨋢有"], lambda c: T.highlight(c, ["冇", "𨋢"])) == ["<b>冇</b><b>𨋢</b>有"]
    df = spark.createDataFrame([("F", 0, None), ("F", 2, 700)], "f string, i int, v int")
    assert [r[0] for r in df.select(T.font_key(F.col("f"), F.col("i"), F.col("v"))).collect()] == ["F", "F#2@700"]
    assert column(spark, [None, 0.25], T.percent, "double") == ["TBD", "0.2500"]
    assert column(spark, [7], lambda c: T.file_name(F.lit("char"), c), "int") == ["char_000007.jpg"]


OUTPUTS = [
    ("<think>a\nb</think>冇", "冇"), ("```text\n冇\n```", "冇"), ("<p>冇</P>", "冇"), ('["a", 1, {"text": "b"}, {"content": "c"}, {}]', "abc"), ('{"content":"x"}', "x"), ("[]", ""),
    ('{"text": 1', '{"text": 1'), ("The text is: 冇", "冇"), ("圖片中的文字是冇", "冇"), ("「冇」", "冇"), ("a\n\n b \r\nc", "abc"), ("", ""), (None, ""), ("  ", ""), ("[not json", "[not json"), ('{"other": 2}', '{"other": 2}'),
]


def test_postprocess(spark):
    assert column(spark, [a for a, _ in OUTPUTS], S.postprocess) == [b for _, b in OUTPUTS]


def test_normalize(spark):
    raw = ["Ａ　b", "ﬁ x", "é", None, "a\tb"]
    assert column(spark, raw, S.normalize) == ["".join(unicodedata.normalize("NFKC", x or "").split()) for x in raw]


def reference_scores(p, g):
    prev = list(range(len(g) + 1))
    for i, a in enumerate(p, 1):
        cur = [i]
        for j, b in enumerate(g, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (a != b)))
        prev = cur
    d = prev[-1]
    both = sum((Counter(p) & Counter(g)).values())
    precision, recall = both / max(1, len(p)), both / max(1, len(g))
    f1 = 0.0 if precision + recall == 0 else 2 * precision * recall / (precision + recall)
    return d, d / max(1, len(g)), min(1.0, d / max(1, len(g))), float(p == g), 1 - d / max(1, len(p), len(g)), f1


def test_scores(spark):
    rnd = random.Random(2)
    alphabet = "ab冇有𨋢é"
    pairs = [("", ""), ("a", ""), ("", "a"), ("aab", "abb"), ("冇𨋢", "有𨋢"), ("abcabc", "a")]
    pairs += [("".join(rnd.choice(alphabet) for _ in range(rnd.randrange(9))), "".join(rnd.choice(alphabet) for _ in range(rnd.randrange(9)))) for _ in range(100)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, p string, g string").withColumns(S.metrics(F.col("p"), F.col("g")))
    for r in df.collect():
        got = (r.edit_distance, r.cer, r.cer_clipped, r.acc, r.ned_sim, r.f1)
        assert got == pytest.approx(reference_scores(r.p, r.g)), (r.p, r.g)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(max_size=12).filter(lambda s: "\x00" not in s and not any(0xD800 <= ord(c) <= 0xDFFF for c in s)), min_size=2, max_size=12))
def test_metric_laws(spark, texts):
    df = spark.createDataFrame([(a, b) for a in texts for b in texts[:4]], "p string, g string").withColumns(S.metrics(F.col("p"), F.col("g")))
    for r in df.collect():
        assert 0 <= r.cer_clipped <= 1 and 0 <= r.ned_sim <= 1 and 0 <= r.f1 <= 1 + 1e-9
        assert (r.acc == 1) == (r.p == r.g) == (r.edit_distance == 0)
        assert r.edit_distance >= abs(len(r.p) - len(r.g))


def test_unwrap_keeps_text_that_is_no_json(spark):
    assert column(spark, ["plain", "[1", json.dumps(["x", ["y"]])], S.unwrap_json) == ["plain", "[1", "x"]


def test_a_cut_answer_is_scored_without_a_matrix(spark):
    import time

    long = "".join(map(chr, random.Random(1).choices(range(97, 123), k=120_000)))
    pairs = [(long[:90_000], long, 30_000, 90_000), (long, long[50_000:], 50_000, 70_000), ("", "ab", 2, 0), ("ba", "", 2, 0), ("é", "aéb", 2, 1), ("ab", "ba", 2, 2)]
    df = spark.createDataFrame([(i, *p[:2]) for i, p in enumerate(pairs)], "i int, p string, g string").withColumns(S.metrics(F.col("p"), F.col("g")))
    start = time.monotonic()
    got = df.orderBy("i").collect()
    assert time.monotonic() - start < 15
    for (p, g, d, both), r in zip(pairs, got, strict=True):
        assert r.edit_distance == d and r.f1 == pytest.approx(2 * both / (len(p) + len(g)))
