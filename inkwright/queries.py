"""Catalogue of the engine's own queries over the driver's tables, each with the SQL that DuckDB runs on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwright.functions import score as S
from inkwright.functions import text as T
from inkwright.functions.text import LATIN
from inkwright.operators import browse, charset, corpus, evals, fonts, qa
from inkwright.plans import planner

#: Letters that mark languages of the tables, their plain forms, and pairs of both. Fixed values.
MARKS = "éèçêüäößóñíáâîúÉÈÇÊÜÄÖÓÑÍ"
PLAIN = "eeceuaosoniaaiuEECEUAOONI"
PAIRS = [("é", "e"), ("è", "e"), ("ç", "c"), ("ê", "e"), ("ü", "u"), ("ä", "a"), ("ö", "o"), ("ß", "s"), ("ó", "o"), ("ñ", "n"), ("í", "i")]
FONTS = {"plain": (32, 126), "western": (32, 255), "capital": (32, 90), "letters": (65, 255)}
CORE, EXTRA, EXCLUDED, MIN_FREQ, FLOOR = "éßñ", "œ", "ê", 3, 20

_QUERIES: dict = {}
_SQL: dict[str, str] = {}


def query(sql: str | None):
    def register(f):
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; texts of fewer files than there are cores are dealt out to all, larger inputs are read as they lie."""
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    if name in ("documents", "conversations", "pages") and rows.rdd.getNumPartitions() < cores:
        return rows.repartition(cores)
    return rows


def values(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def _sql_values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(str(x) if isinstance(x, (int, float)) else "'" + x.replace("'", "''") + "'" for x in r) + ")" for r in rows)


_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_CLEAN = r"""trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(translate(text, chr(12288) || chr(160), '  '), '[\x00-\x09\x0b-\x1f\x7f]', '', 'g'), '\[\d+\]', '', 'g'), 'https?://\S+', '', 'g'), '[^\S\n]+', ' ', 'g'), ' ')"""
_GLUED = _CLEAN.replace(r"[\x00-\x09\x0b-\x1f\x7f]", r"[\x00-\x1f\x7f]").replace(r"[^\S\n]+", r"\s+")
_PIECES = rf"""pieces as (
  select source, lang, doc_id, pos, trim(regexp_replace(trim(piece, ' '), '[^{_LETTERS} ,.!?:;()''\-]', '', 'g'), ',:; .') as piece from (
    select source, lang, doc_id, unnest(parts) as piece, generate_subscripts(parts, 1) - 1 as pos from (select source, lang, doc_id, string_split_regex({_CLEAN}, '[.!?;\n]') as parts from documents)))"""
_RUN = "len(list_filter(range(1, length(piece) - 3), lambda i: substr(piece, i, 1) = substr(piece, i + 1, 1) and substr(piece, i, 1) = substr(piece, i + 2, 1) and substr(piece, i, 1) = substr(piece, i + 3, 1) and substr(piece, i, 1) = substr(piece, i + 4, 1))) = 0"
_LENGTH_OK = "length(piece) between 20 and 120"
_SHARE_OK = f"length(regexp_replace(piece, '[^{_LETTERS}]', '', 'g')) / greatest(1, length(piece)) >= 0.6"
_OK = rf"{_LENGTH_OK} and {_SHARE_OK} and {_RUN} and not regexp_matches(piece, '\d{{6,}}') and not regexp_matches(piece, '[{{}}\[\]|=<>]')"
_SENTENCES = rf"""{_PIECES}, sentences as (
  select source, piece as text, min((doc_id, pos)) as spot from pieces where {_OK} group by source, piece)"""
_CHARS = f"chars as (select lang, doc_id, unnest(string_split(text, '')) as ch from documents), freq as (select lang, ch, count(*) as freq from chars where regexp_matches(ch, '^[{_LETTERS}]$') group by lang, ch)"


@query(f"select doc_id, {_GLUED} as cleaned from documents")
def clean_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.clean_text(F.col("text"), "glue").alias("cleaned"))


@query(f"with {_PIECES} select source, piece as text, (min((doc_id, pos)))[1] as doc_id, (min((doc_id, pos)))[2] as pos from pieces where length(piece) > 0 group by source, piece")
def sentence_split(spark, sf):
    return corpus.sentences(table(spark, sf, "documents"), LATIN, strict=False)


@query(f"with {_SENTENCES} select source, text, spot[1] as doc_id, spot[2] as pos from sentences")
def acceptable_sentences(spark, sf):
    return corpus.sentences(table(spark, sf, "documents"), LATIN)


@query(
    rf"""with {_PIECES} select coalesce(case when not ({_LENGTH_OK}) then 'length' when not ({_SHARE_OK}) then 'letters' when not ({_RUN}) then 'run'
    when regexp_matches(piece, '\d{{6,}}') then 'digits' when regexp_matches(piece, '[{{}}\[\]|=<>]') then 'markup' end, 'kept') as reason, count(*) as n from pieces group by 1"""
)
def rejection_funnel(spark, sf):
    t = T.clean_text(F.col("text"), "split")
    rows = table(spark, sf, "documents").select(F.explode(F.transform(T.split_sentences(t, LATIN), lambda p: T.keep_allowed(F.trim(p), LATIN))).alias("piece"))
    return rows.select(F.coalesce(T.reject_reason(F.col("piece"), LATIN), F.lit("kept")).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


@query(f"with {_SENTENCES} select ch, count(*) as freq from (select unnest(string_split(text, '')) as ch from sentences) where regexp_matches(ch, '^[{_LETTERS}]$') group by ch")
def char_frequency(spark, sf):
    return corpus.char_frequency(corpus.sentences(table(spark, sf, "documents"), LATIN), preset=LATIN)


@query(
    """select case when unicode(ch) between 19968 and 40959 then 'BMP' when unicode(ch) between 13312 and 19903 then 'ExtA' when unicode(ch) >= 131072 then 'ExtB+'
    when unicode(ch) between 63744 and 64255 then 'Compat' else 'other' end as plane, count(distinct ch) as chars, count(*) as n from (select unnest(string_split(text, '')) as ch from documents) where ch <> '' group by 1"""
)
def plane_counts(spark, sf):
    rows = table(spark, sf, "documents").select(F.explode(T.chars(F.col("text"))).alias("ch")).groupBy("ch").agg(F.count("*").alias("n"))
    return rows.groupBy(T.plane(F.col("ch")).alias("plane")).agg(F.count("*").alias("chars"), F.sum("n").alias("n"))


def _parts(spark: SparkSession, sf: str):
    """French as the language of interest: its frequencies, and the other languages' characters above a floor as standard lists."""
    freq = corpus.char_frequency(table(spark, sf, "documents"), preset=LATIN, by=["lang"])
    own = freq.where("lang = 'fr'").select("ch", "freq")
    lists = freq.where((F.col("lang") != "fr") & (F.col("freq") >= FLOOR)).select(F.col("lang").alias("list_name"), "ch")
    standard = charset.union_lists(lists, "en")
    foreign = charset.without(charset.union_lists(lists, "de", "es"), standard)
    return own, standard, foreign, values(spark, [(c,) for c in EXCLUDED], "ch string")


_FORCED = [(c, 1, "core") for c in CORE] + [(c, 2, "ext") for c in EXTRA] + [(t, 3, "pair") for t, _ in PAIRS] + [(c, 4, "manual") for c in "ê"]
_LISTS = f"""{_CHARS}, own as (select ch, freq from freq where lang = 'fr'), lists as (select lang as list_name, ch from freq where lang <> 'fr' and freq >= {FLOOR}),
  standard as (select distinct ch from lists where list_name = 'en'), foreign_ as (select ch from lists where list_name in ('de', 'es') except select ch from standard), excluded as (select * from (values {_sql_values([(c,) for c in EXCLUDED])}) v(ch)),
  reasons as (select ch, freq, case when freq < {MIN_FREQ} then 'low_freq' when ch in (select ch from standard) then 'standard' when ch in (select ch from foreign_) then 'foreign'
    when ch in (select ch from excluded) then 'excluded' else 'kept' end as reason from own)"""
_DERIVED = f"""{_LISTS}, forced as (select * from (values {_sql_values(_FORCED)}) v(ch, ord, tag)), tags as (
  select ch, 0 as ord, 'diff' as tag from reasons where reason = 'kept' union select ch, ord, tag from forced where ch not in (select ch from excluded)),
  derived as (select t.ch, coalesce(any_value(own.freq), 0)::bigint as freq, case when unicode(t.ch) between 19968 and 40959 then 'BMP' when unicode(t.ch) between 13312 and 19903 then 'ExtA'
    when unicode(t.ch) >= 131072 then 'ExtB+' when unicode(t.ch) between 63744 and 64255 then 'Compat' else 'other' end as plane, string_agg(tag, '+' order by ord, tag) as source from tags t left join own on own.ch = t.ch group by t.ch)"""


def _derived(spark: SparkSession, sf: str) -> DataFrame:
    own, standard, foreign, excluded = _parts(spark, sf)
    return charset.derive(own, standard, foreign, excluded, values(spark, _FORCED, "ch string, ord int, tag string"), MIN_FREQ)


@query(f"with {_DERIVED} select ch, freq, plane, source from derived")
def charset_derivation(spark, sf):
    return _derived(spark, sf)


flagship = charset_derivation


@query(f"with {_LISTS} select reason, count(*) as n from reasons group by reason")
def charset_funnel(spark, sf):
    own, standard, foreign, excluded = _parts(spark, sf)
    return charset.funnel(charset.funnel_reason(own, standard, foreign, excluded, MIN_FREQ))


@query(f"with {_DERIVED} select source, count(*) as n from derived group by source")
def charset_sizes(spark, sf):
    return charset.sizes(_derived(spark, sf), "source")


@query(f"with {_DERIVED} select count(*) as n from (select ch from derived intersect select ch from freq where lang = 'es')")
def list_overlap(spark, sf):
    freq = corpus.char_frequency(table(spark, sf, "documents"), preset=LATIN, by=["lang"])
    return charset.overlap(_derived(spark, sf), freq.where("lang = 'es'"))


@query(
    f"""with {_DERIVED}, firsts as (select ch, min(doc_id) as d from (select doc_id, unnest(string_split(text, '')) as ch from documents where lang = 'fr') group by ch)
    select d.ch, printf('U+%05X', unicode(d.ch)) as codepoint, d.freq, d.plane, d.source, coalesce(x.text, '') as example from derived d left join firsts f on f.ch = d.ch left join documents x on x.doc_id = f.d"""
)
def charset_review(spark, sf):
    docs = table(spark, sf, "documents").where("lang = 'fr'").select("doc_id", F.explode(F.array_distinct(T.chars(F.col("text")))).alias("key"))
    # the least id first, and then its text once per character kept, not a text for each character of every document
    firsts = docs.groupBy("key").agg(F.min("doc_id").alias("doc_id")).join(_derived(spark, sf).select(F.col("ch").alias("key")), "key", "left_semi")
    examples = firsts.join(table(spark, sf, "documents").select("doc_id", F.col("text").alias("example")), "doc_id").select("key", "example")
    return charset.review(_derived(spark, sf), examples)


@query(f"with {_CHARS} select lang, sum(case when ch in ({', '.join(repr(c) for c in MARKS)}) then freq else 0 end)::bigint as marked, sum(freq)::bigint as total, round(marked / total, 9) as density from freq group by lang")
def marker_density(spark, sf):
    freq = corpus.char_frequency(table(spark, sf, "documents"), preset=LATIN, by=["lang"])
    rows = corpus.marker_density(freq, list(MARKS), "lang")
    return rows.withColumn("density", F.round("density", 9))


@query("select doc_id, case when d.doc_id is null then 'right' else 'left' end as side from (select distinct doc_id from documents) d full join (select distinct doc_id from labels) l using (doc_id) where d.doc_id is null or l.doc_id is null")
def symmetric_file_diff(spark, sf):
    return qa.symmetric_difference(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id")


@query(
    """with m as (select doc_id::varchar as file, max(quality)::varchar as text from labels where doc_id is not null group by doc_id), l as (select conv_id::varchar as file, min(turn)::varchar as text from conversations where conv_id is not null group by conv_id),
    d as (select distinct doc_id::varchar as file from documents where doc_id is not null)
    select file, on_disk, in_metadata, in_labels, in_metadata and in_labels and mt is distinct from lt as mismatch from (select coalesce(d.file, m.file, l.file) as file, d.file is not null as on_disk, m.file is not null as in_metadata, l.file is not null as in_labels, m.text as mt, l.text as lt
      from d full join m on d.file = m.file full join l on l.file = coalesce(d.file, m.file)) where not (on_disk and in_metadata and in_labels) or (in_metadata and in_labels and mt is distinct from lt)"""
)
def pairing_check(spark, sf):
    """Documents as files, labels as metadata and conversations as labels: three sets of ids that differ by themselves."""
    of = lambda name, key: table(spark, sf, name).where(F.col(key).isNotNull()).groupBy(F.col(key).cast("string").alias("file"))
    disk = table(spark, sf, "documents").where("doc_id is not null").select(F.col("doc_id").cast("string").alias("file"))
    metadata = of("labels", "doc_id").agg(F.max("quality").cast("string").alias("text"))
    return qa.pairing(disk, metadata, of("conversations", "conv_id").agg(F.min("turn").cast("string").alias("text")))


@query(
    """with b as (select l_partkey, max_by((l_suppkey, l_orderkey), (l_extendedprice, -(l_orderkey * 10 + l_linenumber))) as m, max(l_extendedprice) as weight, min(l_orderkey * 10 + l_linenumber) as first from lineitem group by l_partkey)
    select l_partkey, weight as l_extendedprice, m[1] as l_suppkey, first from b"""
)
def max_weight_dedup(spark, sf):
    rows = table(spark, sf, "lineitem").withColumn("ord", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return corpus.heaviest(rows, "l_partkey", "l_extendedprice", "ord", "l_suppkey").select("l_partkey", "l_extendedprice", "l_suppkey", "first")


@query("select o_custkey, arg_min(o_orderpriority, (o_orderdate, o_orderkey)) as example from orders group by o_custkey")
def example_per_key(spark, sf):
    return corpus.first_example(table(spark, sf, "orders"), "o_custkey", "o_orderpriority", ["o_orderdate", "o_orderkey"])


_PAIR_VALUES = f"pairs(target, confusable) as (values {_sql_values(PAIRS)})"


@query(
    f"""with {_CHARS}, {_PAIR_VALUES}, c as (select distinct ch from freq), back as (select confusable, min(target) as t from pairs group by confusable)
    select c.ch, coalesce(p.confusable, b.t) as pair_with, case when p.target is not null then 'target' when b.t is not null then 'confusable' end as pair_role from c left join pairs p on p.target = c.ch left join back b on b.confusable = c.ch"""
)
def pair_join(spark, sf):
    rows = corpus.char_frequency(table(spark, sf, "documents"), preset=LATIN).select("ch")
    return evals.tag_pairs(rows, values(spark, PAIRS, "target string, confusable string"), "ch")


@query(
    f"""with {_PAIR_VALUES}, n as (select ch as t, count(*) as n from (select doc_id, unnest(list_distinct(string_split(text, ''))) as ch from documents) group by ch)
    select target, confusable, coalesce(a.n, 0)::bigint as n_target, coalesce(b.n, 0)::bigint as n_confusable from pairs left join n a on a.t = target left join n b on b.t = confusable where least(coalesce(a.n, 0), coalesce(b.n, 0)) < 250"""
)
def weak_pairs(spark, sf):
    rows = table(spark, sf, "documents").select(F.explode(F.array_distinct(T.chars(F.col("text")))).alias("ch"))
    return qa.weak_pairs(values(spark, PAIRS, "target string, confusable string"), rows, "ch", 250)


_WORDS = "words as (select distinct unnest(string_split_regex(text, '[ \\n]+')) as w from documents)"
_FONT_VALUES = ", ".join(f"('{k}', {a}, {b})" for k, (a, b) in FONTS.items())


def _cmap(spark: SparkSession) -> DataFrame:
    rows = values(spark, [(k, a, b) for k, (a, b) in FONTS.items()], "font_key string, lo int, hi int")
    return rows.select("font_key", F.explode(F.sequence("lo", "hi")).alias("cp"))


def _words(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(F.explode(F.split("text", r"[ \n]+", -1)).alias("text")).where("text <> ''").distinct()


@query(
    f"""with {_WORDS}, f(font_key, lo, hi) as (values {_FONT_VALUES}) select w as text, font_key from words, f
    where w <> '' and len(list_filter(string_split(w, ''), lambda c: unicode(c) < lo or unicode(c) > hi)) = 0"""
)
def cover_join(spark, sf):
    return fonts.covering(_words(spark, sf), _cmap(spark))


@query(f"with {_WORDS} select w as text from words where w <> '' and len(list_filter(string_split(w, ''), lambda c: unicode(c) < 32 or unicode(c) > 90)) > 0 and len(list_filter(string_split(w, ''), lambda c: unicode(c) < 65 or unicode(c) > 122)) > 0")
def unrenderable(spark, sf):
    cmap = _cmap(spark).where("font_key = 'capital'").union(values(spark, [("ascii letters", c) for c in range(65, 123)], "font_key string, cp int"))
    return fonts.unrenderable(_words(spark, sf), cmap)


@query(
    f"""with {_WORDS}, f(font_key, lo, hi) as (values {_FONT_VALUES}) select w as text, font_key, array_to_string(list_filter(string_split(w, ''), lambda c: unicode(c) < lo or unicode(c) > hi), '') as missing from words, f
    where w <> ''"""
)
def missing_glyphs(spark, sf):
    maps = values(spark, [(k, list(range(a, b + 1))) for k, (a, b) in FONTS.items()], "font_key string, cmap array<int>")
    rows = _words(spark, sf).withColumn("font_key", F.explode(F.array(*map(F.lit, FONTS))))
    return fonts.missing(rows, maps).select("text", "font_key", "missing")


@query(f"select font_key, (greatest(0, least(hi, 255) - greatest(lo, 192) + 1) / 64.0)::double as coverage from (values {_FONT_VALUES}) f(font_key, lo, hi)")
def probe_coverage(spark, sf):
    return fonts.probe_coverage(_cmap(spark), list(range(192, 256)))


# Predictions of three models over conversations: accents lost, the second half lost, the truth in a fence.
_EVAL = f"""raw_eval as (select conv_id || '_' || turn as file, case role when 'user' then 'char' when 'assistant' then 'sentence' else 'word' end as tier, text as gt, m as model,
  case m when 'm_fold' then translate(text, '{MARKS}', '{PLAIN}') when 'm_cut' then substr(text, 1, length(text) // 2) else '```text' || chr(10) || text || chr(10) || '```' end as prediction_raw
  from conversations, (values ('m_fold'), ('m_cut'), ('m_wrap')) v(m)),
  eval_rows as (select *, array_to_string(list_filter(list_transform(string_split_regex(trim(regexp_replace(regexp_replace(trim(regexp_replace(regexp_replace(regexp_replace(prediction_raw, '(?s)<think>.*?</think>', '', 'g'), '```[a-zA-Z]*\\n?|```', '', 'g'),
    '(?i)</?(?:div|p|span|br|b|i|em|strong|html|body)\\s*/?>', '', 'g'), ' ' || chr(10)), '(?i)^(?:The text (?:is|reads)[:：]?|Text[:：]?)\\s*', ''), '^\\s+|\\s+$', '', 'g'), '「」『』"''`' || chr(12288) || ' '), '\\n'),
    lambda x: trim(x, ' ')), lambda x: x <> ''), '') as prediction from raw_eval),
  normal as (select *, regexp_replace(prediction, '\\s+', '', 'g') as p, regexp_replace(gt, '\\s+', '', 'g') as g from eval_rows)"""
_ONE_BYTE = "translate({0}, '" + MARKS + "', '" + "".join(chr(i) for i in (*range(1, 9), *range(14, 31))) + "')"
_SCORED = f"""{_EVAL}, dist as (select *, levenshtein({_ONE_BYTE.format("p")}, {_ONE_BYTE.format("g")})::bigint as d from normal),
  mult as (select *, list_sum(list_transform(list_distinct(string_split(p, '')), lambda c: least(length(p) - length(replace(p, c, '')), length(g) - length(replace(g, c, ''))))) as shared from dist),
  scored as (select model, file, tier, gt, prediction, d as edit_distance, round_even(d / greatest(1, length(g)), 9) as cer, round_even(least(d / greatest(1, length(g)), 1.0), 9) as cer_clipped,
    (p = g)::int::double as acc, round_even(1 - d / greatest(1, length(p), length(g)), 9) as ned_sim,
    round_even(case when coalesce(shared, 0) = 0 then 0.0 else 2.0 * (shared / greatest(1, length(p))) * (shared / greatest(1, length(g))) / (shared / greatest(1, length(p)) + shared / greatest(1, length(g))) end, 9) as f1 from mult)"""


def _raw_eval(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations").select(
        F.concat_ws("_", "conv_id", "turn").alias("file"), F.when(F.col("role") == "user", "char").when(F.col("role") == "assistant", "sentence").otherwise("word").alias("tier"), F.col("text").alias("gt")
    )
    rows = rows.withColumn("model", F.explode(F.array(*map(F.lit, ("m_fold", "m_cut", "m_wrap")))))
    cut = F.substring(F.col("gt"), F.lit(1), F.floor(F.length("gt") / 2).cast("int"))
    raw = F.when(F.col("model") == "m_fold", F.translate("gt", MARKS, PLAIN)).when(F.col("model") == "m_cut", cut).otherwise(F.concat(F.lit("```text\n"), "gt", F.lit("\n```")))
    return rows.withColumn("prediction_raw", raw)


def _scored(spark: SparkSession, sf: str, digits: int = 9) -> DataFrame:
    rows = evals.scored(_raw_eval(spark, sf))
    return rows.withColumns({m: F.bround(m, digits) for m in ("cer", *evals.MEANS) if m != "acc"})


@query(f"with {_EVAL} select model, file, prediction from eval_rows")
def postprocess_output(spark, sf):
    return _raw_eval(spark, sf).select("model", "file", S.postprocess(F.col("prediction_raw")).alias("prediction"))


@query(f"with {_SCORED} select model, file, edit_distance, cer, cer_clipped, acc, ned_sim, f1 from scored")
def score_rows(spark, sf):
    return _scored(spark, sf).select("model", "file", "edit_distance", "cer", "cer_clipped", "acc", "ned_sim", "f1")


@query(f"with {_SCORED} select model, file, f1 from scored")
def f1_multiset(spark, sf):
    return _scored(spark, sf).select("model", "file", "f1")


_MEANS_SQL = ", ".join(f"round_even(avg({m}), 4) as {m}" for m in evals.MEANS)


@query(f"with {_SCORED} select model, case when grouping(tier) = 1 then 'all' else tier end as tier, count(*) as n, {_MEANS_SQL} from scored group by grouping sets ((model), (model, tier))")
def eval_summary(spark, sf):
    return evals.report(_scored(spark, sf), digits=4)


_PAIR_CHARS = sorted({t for t, _ in PAIRS})


@query(
    f"""with {_EVAL} select model, tier, ch, sum(contains(prediction, ch)::int)::bigint as hits, sum((prediction = ch)::int)::bigint as hits_exact, count(*) as total
    from (select model, tier, prediction, unnest(list_distinct(list_filter(string_split(gt, ''), lambda c: c in ({", ".join(repr(c) for c in _PAIR_CHARS)})))) as ch from eval_rows) group by model, tier, ch"""
)
def pair_hit_table(spark, sf):
    rows = _raw_eval(spark, sf).withColumn("prediction", S.postprocess(F.col("prediction_raw")))
    return evals.pair_hits(rows, _PAIR_CHARS)


@query("select conv_id, turn, coalesce(quality::varchar, '') as quality, coalesce(toxic::varchar, '') as toxic from conversations left join labels on labels.doc_id = conversations.conv_id")
def eval_join_metadata(spark, sf):
    rows = table(spark, sf, "conversations").select("conv_id", "turn")
    return evals.with_metadata(rows, table(spark, sf, "labels").withColumnRenamed("doc_id", "conv_id"), ["quality", "toxic"], "conv_id")


_LOG = "log as (select 'm' || (event_id % 2) as model, user_id::varchar as file, case when event_type = 'error' then 'failed' else '' end as error, event_id from events)"


def _log(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.concat(F.lit("m"), F.col("event_id") % 2).alias("model"), F.col("user_id").cast("string").alias("file"), F.when(F.col("event_type") == "error", "failed").otherwise("").alias("error"), "event_id"
    )


@query(f"with {_LOG} select m as model, c_custkey::varchar as file from customer, (values ('m0'), ('m1')) v(m) where not exists (select 1 from log where log.model = m and log.file = c_custkey::varchar and error = '')")
def resume_pending(spark, sf):
    records = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("file"))
    return evals.pending(values(spark, [("m0",), ("m1",)], "model string"), records, _log(spark, sf)).select("model", "file")


@query(f"with {_LOG} select model, file, max(event_id) as event_id from log where error = '' group by model, file")
def latest_success(spark, sf):
    return evals.latest_success(_log(spark, sf), "event_id").select("model", "file", "event_id")


@query(
    """with p as (select 'lang' as field, lang as value from documents union all select 'source', source from documents), c as (select field, value, count(*) as n from p where coalesce(value, '') <> '' group by field, value)
    select field, value, n, round(n / sum(n) over (partition by field), 9) as share from c"""
)
def distribution_share(spark, sf):
    return qa.distribution(table(spark, sf, "documents"), ["lang", "source"]).withColumn("share", F.round("share", 9))


@query("select count(*) as keys, max(n) as most, min(n) as least from (select count(*) as n from documents group by source)")
def usage_extremes(spark, sf):
    return qa.extremes(table(spark, sf, "documents"), "source")


@query("select ch, count(*) as n, count(*) < 3 as rare from (select unnest(list_distinct(string_split(text, ''))) as ch from documents) where ch <> '' group by ch")
def doc_frequency_rare(spark, sf):
    return qa.document_frequency(table(spark, sf, "documents"))


@query("select lang, quantile_cont(n_chars, 0.5)::double as median from documents group by lang")
def length_median(spark, sf):
    return qa.exact_quantiles(table(spark, sf, "documents"), F.col("n_chars").cast("double"), {"median": 0.5}, ["lang"])


@query("select l_returnflag, round(quantile_cont(l_extendedprice, 0.5), 6) as median, round(quantile_cont(l_extendedprice, 0.01), 6) as p01, min(l_extendedprice) as least from lineitem group by l_returnflag")
def quantile_summary(spark, sf):
    rows = qa.quantiles(table(spark, sf, "lineitem"), F.col("l_extendedprice"), ["l_returnflag"])
    return rows.withColumns({c: F.round(c, 6) for c in ("median", "p01")})


@query(
    """with w as (select o_orderkey, o_custkey % 3 + 1 as renders, sha256('7|' || o_orderkey) as h from orders), r as (select *, coalesce(sum(renders) over (order by h, o_orderkey rows between unbounded preceding and 1 preceding), 0)::bigint as before from w)
    select o_orderkey, renders, before from r where before < 1800"""
)
def budget_cut(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", (F.col("o_custkey") % 3 + 1).alias("renders"))
    return planner.fill_budget(rows, "renders", 1800, [qa.hash_order("7", "o_orderkey"), F.col("o_orderkey")])


@query(
    """with w as (select source, doc_id, n_chars % 3 + 1 as renders, sha256('7|' || doc_id) as h from documents), r as (select *, coalesce(sum(renders) over (partition by source order by h, doc_id rows between unbounded preceding and 1 preceding), 0)::bigint as before from w)
    select source, doc_id, renders, before from r where before < 40"""
)
def source_balanced(spark, sf):
    rows = table(spark, sf, "documents").select("source", "doc_id", (F.col("n_chars") % 3 + 1).alias("renders"))
    return planner.fill_budget(rows, "renders", 40, [qa.hash_order("7", "doc_id"), F.col("doc_id")], ["source"])


@query(
    """with t as (select lang, source, doc_id, row_number() over (partition by lang, source order by sha256('5|' || doc_id), doc_id) as turn from documents),
    p as (select *, row_number() over (partition by lang order by turn, sha256('5|' || source), source) as pick from t) select lang, source, doc_id, turn, pick from p where pick <= 64"""
)
def round_robin(spark, sf):
    rows = planner.round_robin(table(spark, sf, "documents").select("lang", "source", "doc_id"), ["lang"], ["source"], "5", ["doc_id"], 64)
    return rows.select("lang", "source", "doc_id", F.col("turn").cast("long").alias("turn"), F.col("pick").cast("long").alias("pick"))


@query(
    """with j as (select distinct p_partkey, s_suppkey, s_nationkey from part join lineitem on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey),
    t as (select *, row_number() over (partition by p_partkey, s_nationkey order by sha256('3|' || p_partkey || '|' || s_suppkey), p_partkey, s_suppkey) as turn from j),
    p as (select *, row_number() over (partition by p_partkey order by turn, sha256('3|' || s_nationkey), s_nationkey) as pick from t) select p_partkey, s_suppkey, s_nationkey from p where pick <= 6"""
)
def uniform_allocation(spark, sf):
    """All parts in six suppliers each, of those that have delivered it, nations in turn."""
    items = table(spark, sf, "part").select("p_partkey")
    lines = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").alias("s_suppkey"))
    own = planner.dealt(lines, "p_partkey").distinct()
    covering = own.join(table(spark, sf, "supplier").select("s_suppkey", "s_nationkey"), "s_suppkey").select("p_partkey", "s_suppkey", "s_nationkey")
    n = items.count()
    return planner.uniform(items, covering, "p_partkey", "s_nationkey", "s_suppkey", 6 * n, n, "3").select("p_partkey", "s_suppkey", "s_nationkey")


@query(
    """with u as (select o_orderkey, concat('0x', substr(sha256('9|' || o_orderkey), 1, 13))::bigint / 4503599627370496.0 as u from orders)
    select o_orderkey, case when u < 0.25 then 'clean' when u < 0.6 then 'light' when u < 0.85 then 'medium' else 'hard' end as difficulty from u"""
)
def difficulty_draw(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", planner.draw(planner.unit("9", "o_orderkey")).alias("difficulty"))


@query("select doc_id, source from documents order by sha256('20260825|' || doc_id), doc_id limit 400")
def exact_sample(spark, sf):
    return qa.sample_exactly(table(spark, sf, "documents").select("doc_id", "source"), 400, "20260825", "doc_id")


@query(
    """with d as (select doc_id, lang, source, n_chars from documents), a as (select *, 0 as stage from (select *, row_number() over (partition by lang order by n_chars desc, doc_id) as rn from d) where rn <= 2),
    b as (select *, 1 as stage from (select *, row_number() over (partition by lang, source order by n_chars, doc_id) as rn from d where doc_id not in (select doc_id from a)) where rn <= 1),
    c as (select *, 2 as stage from (select *, row_number() over (partition by source order by sha256('1|' || doc_id), doc_id) as rn from d where doc_id not in (select doc_id from a) and doc_id not in (select doc_id from b) and n_chars < 2000) where rn <= 3)
    select doc_id, lang, source, stage from (select * from a union all select * from b union all select * from c)"""
)
def showcase_pick(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    stages: list[tuple[Column, list[str], int, list[Column]]] = [
        (F.lit(True), ["lang"], 2, [F.desc("n_chars")]),
        (F.lit(True), ["lang", "source"], 1, [F.asc("n_chars")]),
        (F.col("n_chars") < 2000, ["source"], 3, [qa.hash_order("1", "doc_id")]),
    ]
    return planner.staged_pick(rows, stages, "doc_id").select("doc_id", "lang", "source", "stage")


@query("select doc_id, row_number() over (order by source, doc_id) - 1 as idx from documents")
def dense_index(spark, sf):
    return planner.dense_index(table(spark, sf, "documents").select("source", "doc_id"), ["source", "doc_id"]).select("doc_id", "idx")


@query(f"with {_SCORED} select model, file, cer_clipped from scored where model = 'm_fold' and tier = 'sentence' and acc <> 1 and (contains(gt, 'é') or contains(prediction, 'é')) order by cer_clipped desc, file limit 60 offset 0")
def browse_filter_page(spark, sf):
    rows = browse.matching(_scored(spark, sf), model="m_fold", tier="sentence", correctness="incorrect", query="é")
    return browse.page(rows, 1, "cer_desc", ["file"]).select("model", "file", "cer_clipped")


@query("select ch, count(*) as freq from (select unnest(string_split(text, '')) as ch from documents) where ch <> '' group by ch order by freq desc, ch limit 40")
def topk_chars(spark, sf):
    return corpus.char_frequency(table(spark, sf, "documents")).orderBy(F.desc("freq"), "ch").limit(40)


@query("select case when grouping(lang) = 1 then 'all' else lang end as lang, case when grouping(source) = 1 then 'all' else source end as source, count(*) as n, count(distinct text) as texts from documents group by grouping sets ((), (lang), (source))")
def stats_report(spark, sf):
    # a 128-bit hash stands for a text, which would be shuffled once for each grouping
    rows = table(spark, sf, "documents").select("lang", "source", F.when(F.col("text").isNotNull(), F.md5(F.col("text").cast("binary"))).alias("h"))
    out = rows.groupingSets([[], ["lang"], ["source"]], "lang", "source").agg(F.grouping("lang").alias("l"), F.grouping("source").alias("s"), F.count("*").alias("n"), F.count_distinct("h").alias("texts"))
    named = lambda c, g: F.when(F.col(g) == 1, "all").otherwise(F.col(c)).alias(c)
    return out.select(named("lang", "l"), named("source", "s"), "n", "texts")


@query("select event_id, case when value / 1000 < 0.004 then 'ink' when value < 45 then 'contrast' end as error from events")
def gate_errors(spark, sf):
    return table(spark, sf, "events").select("event_id", qa.gate(F.col("value") / 1000, F.col("value")).alias("error"))


@query("select vec_id, round(quantile_cont(x, 0.99) - quantile_cont(x, 0.01), 6) as contrast from (select vec_id, unnest(embedding)::double * 128 + 128 as x from embeddings) group by vec_id")
def contrast_gate(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", F.explode("embedding").alias("x")).groupBy("vec_id")
    q = F.percentile(F.col("x").cast("double") * 128 + 128, F.array(F.lit(0.99), F.lit(0.01)))
    return rows.agg(q.alias("q")).select("vec_id", F.round(F.col("q")[0] - F.col("q")[1], 6).alias("contrast"))


@query(
    r"""select page_id, regexp_matches(url, '[{}\[\]|=<>]') as markup, length(regexp_replace('see ' || url || ' now', 'https?://\S+', '', 'g')) as without_url,
    md5(regexp_replace(html, '(?i)</?(?:div|p|span|br|b|i|em|strong|html|body)\s*/?>', '', 'g')) as stripped from pages"""
)
def url_and_markup(spark, sf):
    url = F.concat(F.lit("see "), "url", F.lit(" now"))
    return table(spark, sf, "pages").select(
        "page_id",
        (~T.no_markup(F.col("url"))).alias("markup"),
        F.length(F.regexp_replace(url, r"(?U)https?://\S+", "")).cast("long").alias("without_url"),
        F.md5(S.strip_tags(F.col("html")).cast("binary")).alias("stripped"),
    )


@query("select printf('%s_%06d.jpg', lang, doc_id) || chr(9) || replace(text, chr(10), ' ') as line from documents")
def label_tsv(spark, sf):
    name = T.file_name(F.col("lang"), F.col("doc_id"))
    return table(spark, sf, "documents").select(F.concat_ws("\t", name, F.replace("text", F.lit("\n"), F.lit(" "))).alias("line"))


@query("select doc_id, replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;') as escaped, regexp_replace(text, '([éèç])', '<b>\\1</b>', 'g') as marked from documents")
def escape_and_highlight(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.escape_html(F.col("text")).alias("escaped"), T.highlight(F.col("text"), list("éèç")).alias("marked"))


@query("select source, count(*) as files, sum(length(text))::bigint as total from documents where doc_id in (select doc_id from labels) group by source")
def export_summary(spark, sf):
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels").select("doc_id").distinct(), "doc_id", "left_semi")
    return rows.groupBy("source").agg(F.count("*").alias("files"), F.sum(F.length("text")).alias("total"))


_FACES = [("a", "Serif", "a.ttf", 0.9, 1.0, 200, 700), ("b", "Serif", "b.ttf", 0.4, 0.995, 400, 400), ("c", "Sans", "c.ttf", 0.9, 0.2, 100, 300), ("d", "Hand", "c.ttf", 0.5, 0.99, 450, 460)]
_FACE_COLUMNS = "font_key string, family string, path string, coverage_bmp double, coverage_ext double, axis_lo int, axis_hi int"
_FACES_SQL = f"faces(font_key, family, path, coverage_bmp, coverage_ext, axis_lo, axis_hi) as (values {_sql_values(_FACES)})"


@query(f"with {_FACES_SQL} select font_key, family, row_number() over (order by coverage_ext desc, coverage_bmp desc, font_key) as place from faces where coverage_bmp >= 0.5")
def usable_fonts_ranked(spark, sf):
    from pyspark.sql.window import Window

    rows = fonts.usable(values(spark, _FACES, _FACE_COLUMNS).withColumn("coverage", F.col("coverage_bmp")))
    place = F.row_number().over(Window.orderBy(F.desc("coverage_ext"), F.desc("coverage_bmp"), "font_key"))
    return rows.select("font_key", "family", place.alias("place"))


@query(f"with {_FACES_SQL}, w(v) as (values (400), (700)) select font_key, v as variation from faces left join w on v between axis_lo and axis_hi")
def weight_instances(spark, sf):
    return fonts.expand_weights(values(spark, _FACES, _FACE_COLUMNS), [400, 700]).select("font_key", "variation")


@query(f"with {_FACES_SQL} select count(distinct path) as files, count(*) as instances, count(*) filter (coverage_bmp >= 0.5) as usable, count(*) filter (coverage_ext >= 0.99) as full_ext, array_to_string(list_sort(list(distinct family)), '+') as families from faces")
def font_report(spark, sf):
    return fonts.report(values(spark, _FACES, _FACE_COLUMNS)).withColumn("families", F.array_join("families", "+"))


_WRAPPED = [
    ("think", "<think>a\nb</think>日本"), ("json", '{"text": "香港"}'), ("lead", "The text is: 香港"), ("colon", "Text：香港"), ("wide", "Ａｂ　１２"), ("ligature", "ﬁne ²"), ("half", "ｶﾞ"), ("plain", "香 港"),
]
_PLAIN = [("think", "日本", "日本"), ("json", "香港", "香港"), ("lead", "香港", "香港"), ("colon", "香港", "香港"), ("wide", "Ａｂ　１２", "Ab12"), ("ligature", "ﬁne ²", "fine2"), ("half", "ｶﾞ", "ガ"), ("plain", "香 港", "香港")]


@query(f"select * from (values {_sql_values(_PLAIN)}) v(kind, prediction, normal)")
def unwrap_and_normalize(spark, sf):
    """Reasoning blocks, JSON answers, lead-ins and NFKC, which the tables' texts don't have; SQL lists what must come out."""
    rows = values(spark, _WRAPPED, "kind string, raw string").withColumn("prediction", S.postprocess(F.col("raw")))
    return rows.select("kind", "prediction", S.normalize(F.col("prediction")).alias("normal"))


@query(f"with {_LOG} select model, count(*) as n from log where error = '' group by model")
def rows_without_errors(spark, sf):
    return evals.with_errors(_log(spark, sf), False).groupBy("model").agg(F.count("*").alias("n"))


@query("select p_partkey, p_size from part where p_size <> 48 or not (length(p_name) between 8 and 20000)")
def size_sanity(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", "p_size", F.col("p_size").alias("height"), F.length("p_name").alias("width"))
    return qa.size_faults(rows).select("p_partkey", "p_size")


@query(f"with {_SENTENCES} select distinct source from sentences")
def sources_with_sentences(spark, sf):
    docs = table(spark, sf, "documents")
    return corpus.licences(corpus.sentences(docs, LATIN), docs.select("source").distinct())


@query(None)
def benchmark_plan(spark, sf):
    """The three-tier plan over documents; hashed draws through several joins, checked in tests for its budgets and coverage."""
    from inkwright.plans import build

    docs = table(spark, sf, "documents")
    words = docs.select("source", F.explode(F.split("text", r"[ \n]+", -1)).alias("text")).where(T.word_entry(F.col("text"), LATIN)).distinct()
    cmap = values(spark, [(k, k[:4], a, b) for k, (a, b) in FONTS.items()], "font_key string, family string, lo int, hi int")
    cmap = cmap.select("font_key", "family", F.explode(F.sequence("lo", "hi")).alias("cp"))
    pairs = values(spark, PAIRS, "target string, confusable string")
    return build.build_plan(_derived(spark, sf), words, corpus.sentences(docs, LATIN), pairs, cmap)


@query(None)
def image_measures(spark, sf):
    """Ink and contrast of embeddings as grey images of 8 x 8 pixels, and the gate that fails."""
    from inkwright.operators import images

    pixel = F.transform("embedding", lambda x: F.hex(F.least(F.lit(255), F.greatest(F.lit(0), F.floor(x.cast("double") * 128 + 128))).cast("long")))
    rows = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("idx"), F.unhex(F.array_join(F.transform(pixel, lambda h: F.lpad(h, 2, "0")), "")).alias("pixels"), F.lit(8).alias("height"), F.lit(8).alias("width")
    )
    out = images.measure(rows)
    return out.withColumn("gate", qa.gate(F.col("ink_ratio"), F.col("contrast")))


def queries() -> dict:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


from inkwright import more_queries  # noqa: E402,F401  (registers its queries, for which it needs what stands above)
