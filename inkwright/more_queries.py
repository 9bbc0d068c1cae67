"""More of the catalogue: files written and read again, reports, browsing, and operators on tables of given values."""

from __future__ import annotations

import json
import struct

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from inkwright.functions import text as T
from inkwright.functions.picture import pixels_of, png
from inkwright.functions.text import HAN, LATIN
from inkwright.operators import browse, charset, corpus, evals, fonts, qa
from inkwright.plans import build, planner, report
from inkwright.queries import (
    _CHARS, _DERIVED, _GLUED, _LETTERS, _LOG, _OK, _PAIR_VALUES, _PIECES, _SCORED, _SENTENCES, FONTS, MARKS, PAIRS, PLAIN,
    _derived, _log, _raw_eval, _scored, _sql_values, _words, _WORDS, query, table, values,
)
from inkwright.sources import readers, sinks
from inkwright.store import new_path, written


def _plane(ch: str) -> str:
    return f"case when unicode({ch}) between 19968 and 40959 then 'BMP' when unicode({ch}) between 13312 and 19903 then 'ExtA' when unicode({ch}) >= 131072 then 'ExtB+' when unicode({ch}) between 63744 and 64255 then 'Compat' else 'other' end"


_TIER = "case role when 'user' then 'char' when 'assistant' then 'sentence' else 'word' end"
_UNIT = "(concat('0x', substr(sha256('9|' || conv_id || '|' || turn), 1, 13))::bigint / 4503599627370496.0)"
_LEVEL = f"case when {_UNIT} < 0.25 then 'clean' when {_UNIT} < 0.6 then 'light' when {_UNIT} < 0.85 then 'medium' else 'hard' end"
#: Records of a data set that was built: turns of conversations, with planes and pairs by their length and letters.
_RECORDS = f"""records as (select conv_id || '_' || turn as file, conv_id, turn, text, {_TIER} as tier, {_LEVEL} as difficulty, role as source, 'f' || (turn % 3) as font, length(text) as n_chars,
  case length(text) % 4 when 0 then 'BMP' when 1 then 'ExtA' when 2 then 'ExtB+' end as plane, case when contains(text, 'é') then 'e' end as pair_with,
  case when contains(text, 'é') then case when turn % 2 = 0 then 'target' else 'confusable' end end as pair_role from conversations)"""


def _records(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations").withColumn("file", F.concat_ws("_", "conv_id", "turn"))
    n = F.length("text") % 4
    marked = F.contains("text", F.lit("é"))
    return planner.with_difficulty(rows, "9", "conv_id", "turn").select(
        "file", "conv_id", "turn", "text", F.when(F.col("role") == "user", "char").when(F.col("role") == "assistant", "sentence").otherwise("word").alias("tier"), "difficulty",
        F.col("role").alias("source"), F.concat(F.lit("f"), F.col("turn") % 3).alias("font"), F.length("text").cast("long").alias("n_chars"),
        F.when(n == 0, "BMP").when(n == 1, "ExtA").when(n == 2, "ExtB+").alias("plane"), F.when(marked, "e").alias("pair_with"),
        F.when(marked, F.when(F.col("turn") % 2 == 0, "target").otherwise("confusable")).alias("pair_role"),
    )


@query(
    f"""with {_PIECES}, per as (select doc_id, count(*) as n from pieces where {_OK} group by doc_id), firsts as (select doc_id from documents order by doc_id limit 600),
    run as (select doc_id, n, coalesce(sum(n) over (order by doc_id rows between unbounded preceding and 1 preceding), 0) as before from per where doc_id in (select doc_id from firsts)) select doc_id, n from run where before < 3000"""
)
def article_caps(spark, sf):
    """Both caps of a bounded scan, which are its feature: at most 600 articles, and none after the one that reaches 3,000 sentences."""
    # texts are dealt out after the cut, so table() isn't asked for them
    docs = corpus.first_articles(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"), "doc_id", 600).repartition(spark.sparkContext.defaultParallelism)
    pieces = F.transform(T.split_sentences(T.clean_text(F.col("text"), "split"), LATIN), lambda p: T.keep_allowed(F.trim(p), LATIN))
    found = docs.select("doc_id", F.explode(pieces).alias("piece")).where(T.acceptable(F.col("piece"), LATIN))
    return corpus.capped(docs, "doc_id", 600, found, 3000).groupBy("doc_id").agg(F.count("*").alias("n"))


@query(
    rf"""with t as (select conv_id, role, {_GLUED} as t from (select conv_id, role, replace(text, ' ', '') as text from conversations)),
    p as (select role, conv_id, trim(regexp_replace(trim(replace(t, '-', ''), ' '), '[^{_LETTERS} ,.!?:;()''\-]', '', 'g'), ',:; .') as piece from t)
    select role as source, piece as text, min(conv_id) as doc_id, 0::bigint as pos from p where length(piece) > 0 group by role, piece"""
)
def utterance_join(spark, sf):
    """Words of utterances joined without a blank, hyphens taken out, each utterance a piece."""
    tokens = table(spark, sf, "conversations").withColumn("tokens", F.transform(F.split("text", " ", -1), lambda w: F.struct(w.alias("word"))))
    return corpus.sentences(corpus.join_tokens(tokens), LATIN, source="role", doc_id="conv_id", newlines="glue", split=False, strict=False)


@query(f"with {_SENTENCES} select source, count(*) as n from sentences where regexp_matches(text, '[{MARKS}]') group by source")
def sentences_with_marks(spark, sf):
    rows = corpus.sentences(table(spark, sf, "documents"), LATIN)
    return rows.where(T.acceptable(F.col("text"), LATIN, need=list(MARKS))).groupBy("source").agg(F.count("*").alias("n"))


@query("select 'documents' as source, count(*) as n, sum(length(text))::bigint as chars from documents union all select 'conversations', count(*), sum(length(text))::bigint from conversations")
def source_concatenation(spark, sf):
    rows = corpus.concatenated(documents=table(spark, sf, "documents").select("text"), conversations=table(spark, sf, "conversations").select("text"))
    return rows.groupBy("source").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))


@query(
    f"""with {_DERIVED}, x as (select distinct conv_id, turn, unnest(string_split(text, '')) as ch from conversations), h as (select conv_id, turn, string_agg(x.ch, '' order by x.ch) as canto_chars, count(*) as n_canto_chars from x join derived d on d.ch = x.ch group by conv_id, turn)
    select conv_id, turn, canto_chars, n_canto_chars, array_to_string(list_filter(string_split(text, ''), lambda c: contains('{MARKS}', c) and c <> ''), '') as in_order from conversations join h using (conv_id, turn)"""
)
def charset_hits(spark, sf):
    rows = build.with_hits(table(spark, sf, "conversations").select("conv_id", "turn", "text"), _derived(spark, sf), ["conv_id", "turn"])
    return rows.select("conv_id", "turn", "canto_chars", "n_canto_chars", F.array_join(T.in_set(F.col("text"), F.array(*map(F.lit, MARKS))), "").alias("in_order"))


@query(
    f"""with {_DERIVED}, items as (select distinct ch as text from (select unnest(string_split(text, '')) as ch from conversations) where regexp_matches(ch, '^[{_LETTERS}]$'))
    select text, coalesce(d.freq, 0) as corpus_freq, coalesce(d.source, 'counterpart') as charset_source, {_plane("text")} as plane, 'charset' as source from items left join derived d on d.ch = text"""
)
def text_attributes(spark, sf):
    items = table(spark, sf, "conversations").select(F.explode(F.array_distinct(T.chars(F.col("text")))).alias("text")).distinct()
    return build.with_attributes(items.where(T.is_letter(F.col("text"), LATIN)), _derived(spark, sf))


@query(f"with {_DERIVED}, {_PAIR_VALUES} select ch as text, 'target' as role from derived union all select distinct confusable, 'counterpart' from pairs")
def char_items(spark, sf):
    return build.char_items(_derived(spark, sf), values(spark, PAIRS, "target string, confusable string"))


@query(f"with {_CHARS} select ch as text, max(freq) as corpus_freq from freq where unicode(ch) > 127 group by ch order by corpus_freq desc, unicode(ch) limit 9")
def most_frequent_marked(spark, sf):
    """The nine most frequent letters beyond ASCII, by their frequency in the language that has most of them."""
    freq = corpus.char_frequency(table(spark, sf, "documents"), preset=LATIN, by=["lang"])
    rows = freq.select(F.col("ch").alias("text"), F.col("freq").alias("corpus_freq"), F.ascii("ch").alias("idx"))
    return build.most_frequent(rows.where("idx > 127"), 9)


@query(f"with {_RECORDS} select 'by_tier' as section, tier as key, count(*) as n from records group by tier union all select 'by_difficulty', difficulty, count(*) from records group by difficulty union all select 'by_source', source, count(*) from records group by source union all select 'images', 'all', count(*) from records union all select 'by_plane', coalesce(plane, '-'), count(*) from records where tier = 'char' group by plane union all select 'distinct', 'texts', count(distinct text) from records union all select 'distinct', 'fonts', count(distinct font) from records")
def build_counts(spark, sf):
    return report.counts(_records(spark, sf))


@query(f"""with {_RECORDS}, f as (select 'tier' as field, tier as value from records union all select 'difficulty', difficulty from records union all select 'plane', plane from records union all select 'pair', 'yes' from records where pair_with is not null)
    select field, value, count(*) as n from f where value is not null group by field, value""")
def showcase_counts(spark, sf):
    return build.showcase_counts(_records(spark, sf))


@query(f"with {_RECORDS} select file, row_number() over (order by case tier when 'char' then 1 when 'word' then 2 else 3 end, file) - 1 as place from (select * from records order by case tier when 'char' then 1 when 'word' then 2 else 3 end, file limit 200)")
def showcase_order(spark, sf):
    """The first 200 of a showcase in its order."""
    rows = build.showcase_order(_records(spark, sf)).limit(200).agg(F.collect_list("file").alias("files"))
    return rows.select(F.posexplode("files").alias("place", "file")).select("file", F.col("place").cast("long").alias("place"))


@query(f"with {_RECORDS} select file, tier = 'sentence' or n_chars > 8 as wide, case when plane in ('ExtA', 'ExtB+') then plane end as ext, case pair_role when 'target' then 'written e' when 'confusable' then 'spoken e' end as pair_label from records")
def cards(spark, sf):
    return browse.card(_records(spark, sf)).select("file", "wide", "ext", "pair_label")


_FILTERS = [("all", "all", "ext"), ("all", "all", "pair"), ("char", "clean", "all"), ("sentence", "hard", "BMP"), ("word", "all", "ExtA"), ("all", "all", "all")]


@query(f"""with {_RECORDS}, f(tier, difficulty, plane) as (values {_sql_values(_FILTERS)}) select f.tier, f.difficulty, f.plane, count(r.file) as n from f left join records r on (f.tier = 'all' or r.tier = f.tier) and (f.difficulty = 'all' or r.difficulty = f.difficulty)
    and (f.plane = 'all' or (f.plane = 'ext' and r.plane in ('ExtA', 'ExtB+')) or (f.plane = 'pair' and r.pair_with is not null) or r.plane = f.plane) group by all""")
def sample_filters(spark, sf):
    rows, out = _records(spark, sf), None
    for t, d, p in _FILTERS:
        one = browse.samples(rows, t, d, p).agg(F.count("*").alias("n")).select(F.lit(t).alias("tier"), F.lit(d).alias("difficulty"), F.lit(p).alias("plane"), "n")
        out = one if out is None else out.union(one)
    return out


_SORTS = {"default": "", "cer_desc": "cer_clipped desc,", "cer_asc": "cer_clipped,", "acc_desc": "acc desc,", "acc_asc": "acc,", "len_desc": "length(gt) desc,", "len_asc": "length(gt),"}
_SORTED_SQL = " union all ".join(f"(select '{k}' as sort, model, file, row_number() over (order by {o} model, file) as place from scored order by place limit 60)" for k, o in _SORTS.items())


@query(f"with {_SCORED} {_SORTED_SQL}")
def browse_sorts(spark, sf):
    """The first page in each of the sort orders."""
    rows = written(_scored(spark, sf).select("model", "file", "cer_clipped", "acc", F.length("gt").alias("n_chars")), "scored")
    out = None
    for order in _SORTS:
        # 60 rows
        place = F.row_number().over(Window.orderBy(*browse.ordered(rows, order, ["model", "file"]))).cast("long")
        one = browse.page(rows, 1, order, ["model", "file"]).select(F.lit(order).alias("sort"), "model", "file", place.alias("place"))
        out = one if out is None else out.unionByName(one)
    return out


@query(f"with {_SCORED}, e as (select *, contains(gt, 'é') as ext from scored), l as (select *, 'all' as label from e union all select *, tier from e union all select *, 'ext' from e where ext) select model, label as tier, count(*) as n, {', '.join(f'round_even(avg({m}), 4) as {m}' for m in evals.MEANS)} from l group by model, label")
def eval_report_ext(spark, sf):
    """Means over all, by tier and over rows of an extension, for which those with é stand."""
    return evals.report(_scored(spark, sf), digits=4, ext=F.contains("gt", F.lit("é")))


_MARKED = sorted({t for t, _ in PAIRS})
_BOTH = f"""{_RECORDS}, {_PAIR_VALUES}, base as (select conv_id, turn, text, unnest(list_distinct(list_filter(string_split(text, ''), lambda c: c in ({", ".join(repr(c) for c in _MARKED)})))) as ch from conversations),
  gts as (select 'char' as tier, ch as gt, conv_id || '_' || turn || '_' || ch as file from base union all select 'sentence', text, conv_id || '_' || turn from conversations),
  evals_ as (select m as model, tier, gt, file, case when m = 'whole' or length(file) % 3 = 0 then gt else translate(gt, '{MARKS}', '{PLAIN}') end as prediction from gts, (values ('whole'), ('some')) v(m))"""


@query(
    f"""with {_BOTH}, t as (select model, target, confusable, tier, contains(prediction, target) as hit from evals_ join pairs on (tier = 'char' and gt = target) or (tier = 'sentence' and contains(gt, target))),
    g as (select model, target, confusable, count(*) filter (tier = 'char' and hit) as char_hits, count(*) filter (tier = 'char') as char_total, count(*) filter (tier = 'sentence' and hit) as sentence_hits, count(*) filter (tier = 'sentence') as sentence_total from t group by all)
    select *, row_number() over (partition by model order by char_hits desc, target) as place from g where char_total > 0"""
)
def pair_table(spark, sf):
    """Hits of pairs among single characters, of which each turn gives its own, and in whole texts, for two models."""
    rows = table(spark, sf, "conversations").withColumn("file", F.concat_ws("_", "conv_id", "turn"))
    own = F.array_distinct(F.filter(T.chars(F.col("text")), lambda c: c.isin(_MARKED)))
    chars = rows.select(F.lit("char").alias("tier"), F.explode(own).alias("gt"), "file").withColumn("file", F.concat_ws("_", "file", "gt"))
    rows = chars.union(rows.select(F.lit("sentence"), "text", "file")).withColumn("model", F.explode(F.array(F.lit("whole"), F.lit("some"))))
    kept = (F.col("model") == "whole") | (F.length("file") % 3 == 0)
    rows = rows.withColumn("prediction", F.when(kept, F.col("gt")).otherwise(F.translate("gt", MARKS, PLAIN)))
    return evals.pair_table(rows, values(spark, PAIRS, "target string, confusable string"))


@query(f"with {_LOG}, c as (select c_custkey::varchar as file from customer order by file limit 200) select m as model, file from c, (values ('m0'), ('m2')) v(m) where not exists (select 1 from log where log.model = m and log.file = c.file and error = '')")
def pending_of_listed_models(spark, sf):
    """The first 200 records of each model that a list of keys names."""
    registry = evals.models(values(spark, [("m0",), ("m1",), ("m2",)], "model string"), " m2, m0,,")
    records = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("file"))
    return evals.pending(registry, records, _log(spark, sf), 200).select("model", "file")


@query("select m as model, count(*) as files, count(*) + count(*) filter (c_acctbal < 0) as attempts, count(*) as successes from customer, (values ('m0'), ('m1')) v(m) group by m")
def append_and_resume(spark, sf):
    """Two runs that append: the second takes up what failed in the first, accounts below zero, and nothing else."""
    path = new_path(spark, "results")
    records = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("file"), "c_acctbal")
    registry = values(spark, [("m0",), ("m1",)], "model string")
    log = values(spark, [], "model string, file string, error string")
    for error in (F.when(F.col("c_acctbal") < 0, "failed"), F.lit(None).cast("string")):
        sinks.append_results(evals.pending(registry, records, log).withColumn("error", F.coalesce(error, F.lit(""))), path)
        log = spark.read.schema("file string, c_acctbal double, error string, model string").parquet(path)
    return log.groupBy("model").agg(F.count_distinct("file").alias("files"), F.count("*").alias("attempts"), F.count_if(F.col("error") == "").alias("successes"))


@query("select printf('%s_%06d.jpg', lang, doc_id) as file, regexp_replace(text, '[\\r\\n]', ' ', 'g') as text from documents where text is not null")
def label_round_trip(spark, sf):
    path = new_path(spark, "labels")
    rows = table(spark, sf, "documents").where("text is not null")
    sinks.label_lines(rows.select(F.col("doc_id").alias("idx"), T.file_name(F.col("lang"), F.col("doc_id")).alias("file"), F.regexp_replace("text", r"[\r\n]", " ").alias("text")), path)
    return readers.label_lines(spark, path)


@query("select doc_id, text, lang, source, n_chars from documents")
def metadata_round_trip(spark, sf):
    path = new_path(spark, "metadata")
    sinks.metadata_lines(table(spark, sf, "documents").withColumns({"ok": F.lit(True), "idx": F.lit(0)}), path)
    return readers.jsonl(spark, path, "doc_id long, text string, lang string, source string, n_chars long")


@query("select conv_id, turn, role, text from conversations")
def csv_round_trip(spark, sf):
    path = new_path(spark, "csv")
    sinks.result_lines(table(spark, sf, "conversations").select("conv_id", "turn", "role", "text"), path)
    return readers.eval_csv(spark, path, "conv_id long, turn long, role string, text string")


@query("select '[' || string_agg(to_json({'n_nationkey': n_nationkey, 'n_name': n_name})::varchar, ',' order by n_nationkey) || ']' as compact, '[' || chr(10) || '  ' || string_agg(to_json({'n_nationkey': n_nationkey, 'n_name': n_name})::varchar, ',' || chr(10) || '  ' order by n_nationkey) || chr(10) || ']' as pretty from nation")
def json_export(spark, sf):
    rows = table(spark, sf, "nation")
    both = [sinks.json_array(rows, ["n_nationkey", "n_name"], [F.col("n_nationkey")], pretty) for pretty in (False, True)]
    return values(spark, [tuple(both)], "compact string, pretty string")


@query("select region.r_name as name, list_sort(list(n_name)) as nations from region join nation on n_regionkey = r_regionkey group by r_name")
def json_document_scan(spark, sf):
    """A JSON document over many lines; a second one isn't there and gives no rows."""
    path = new_path(spark, "document")
    rows = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).groupBy(F.col("r_name").alias("name")).agg(F.array_sort(F.collect_list("n_name")).alias("nations"))
    tree = json.dumps([r.asDict() for r in rows.collect()], indent=1)  # five regions
    values(spark, [(tree,)], "value string").write.text(path)
    schema = "name string, nations array<string>"
    return readers.json_document(spark, path, schema).unionByName(readers.json_document(spark, path + "-none", schema))


_REVIEW = "select ch, printf('U+%05X', unicode(ch)) as codepoint, freq::varchar as freq, plane, source, printf('%s is %d', ch, unicode(ch)) as example from derived"


@query(f"with {_DERIVED} {_REVIEW}")
def review_round_trip(spark, sf):
    """The review sheet of a character set, written under its header and read again as text."""
    path = new_path(spark, "review")
    own = _derived(spark, sf)
    sinks.review_lines(charset.review(own, own.select(F.col("ch").alias("key"), F.format_string("%s is\t%d", "ch", F.ascii("ch")).alias("example"))), path)
    return spark.read.option("header", True).option("sep", "\t").option("quote", "\u0000").schema("ch string, codepoint string, freq string, plane string, source string, example string").csv(path)


@query("select vec_id as idx, 'v' || vec_id || '.png' as file, '' as caption, 8 as height, 8 as width, 1 as channels, list_sum(list_transform(embedding, lambda x: least(255, greatest(0, floor(x::double * 128 + 128)))))::bigint as total, null::varchar as error from embeddings")
def packaged_images(spark, sf):
    """Embeddings as grey images of 8 x 8: encoded, packed with their path into Parquet, read again and decoded."""
    path = new_path(spark, "packaged")
    pixel = F.transform("embedding", lambda x: F.lpad(F.hex(F.least(F.lit(255), F.greatest(F.lit(0), F.floor(x.cast("double") * 128 + 128))).cast("long")), 2, "0"))
    rows = table(spark, sf, "embeddings").select(F.col("vec_id").alias("idx"), F.concat(F.lit("v"), "vec_id", F.lit(".png")).alias("file"), png(F.unhex(F.array_join(pixel, "")), F.lit(8), F.lit(8)).alias("png"), F.lit(None).cast("string").alias("caption"))
    sinks.packaged(rows, path, {"idx": "long", "caption": "string"}, image="png", files=1)
    back = spark.read.parquet(path).select("idx", F.col("image.path").alias("file"), "caption", pixels_of(F.col("image.bytes")).alias("i"))
    total = F.aggregate(F.sequence(F.lit(1), F.octet_length("i.pixels")), F.lit(0).cast("long"), lambda acc, n: acc + F.conv(F.hex(F.substring(F.col("i.pixels"), n, F.lit(1))), 16, 10).cast("long"))
    return back.select("idx", "file", "caption", "i.height", "i.width", "i.channels", total.alias("total"), "i.error")


@query("select count(*) as files, sum(strlen(html))::bigint as bytes from pages")
def total_bytes(spark, sf):
    return qa.total_bytes(table(spark, sf, "pages"), "html")


@query("select lang, source, doc_id, turn from (select lang, source, doc_id, row_number() over (partition by lang, source order by sha256('4|' || doc_id), doc_id) as turn from documents) order by turn, lang, source limit 64")
def contact_sheet_rows(spark, sf):
    """64 rows for a sheet of 16 x 4, buckets in turn."""
    rows = planner.buckets_in_turn(table(spark, sf, "documents").select("lang", "source", "doc_id"), ["lang", "source"], "4", ["doc_id"], 64)
    return rows.withColumn("turn", F.col("turn").cast("long"))


_ORDER_UNIT = "(concat('0x', substr(sha256('9|' || o_orderkey), 1, 13))::bigint / 4503599627370496.0)"


@query(f"select o_orderkey, case when o_orderstatus = 'O' then 'light' when {_ORDER_UNIT} < 0.25 then 'clean' when {_ORDER_UNIT} < 0.6 then 'light' when {_ORDER_UNIT} < 0.85 then 'medium' else 'hard' end as difficulty from orders")
def difficulty_default(spark, sf):
    """Difficulties that are given stay, the others are drawn."""
    rows = table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "O", "light").alias("difficulty"))
    return planner.with_difficulty(rows, "9", "o_orderkey")


@query(
    f"""with {_WORDS}, f(font_key, lo, hi) as (select * from (values {_sql_values([(k, *v) for k, v in FONTS.items()])}) v), w2 as (select w as text, ['plain', 'western', 'capital', 'letters', 'gone'][length(w) % 5 + 1] as font_key from words where w <> '')
    select text, font_key, lo, case when lo is null then 'no font ' || font_key end as error from w2 left join f using (font_key)"""
)
def plan_fonts(spark, sf):
    """Planned texts with their fonts; those of an unknown font are failures, not lost."""
    pick = F.element_at(F.array(*map(F.lit, [*FONTS, "gone"])), (F.length("text") % 5 + 1).cast("int"))
    faces = values(spark, [(k, a) for k, (a, _) in FONTS.items()], "font_key string, lo int")
    return fonts.for_plan(_words(spark, sf).withColumn("font_key", pick), faces).select("text", "font_key", "lo", "error")


_FONT_FILES = [("own/A-One.ttf", True), ("sys/Noto-Sans_HK.otf", False), ("sys/Other.ttf", False), ("own/readme.txt", True), ("sys/NOTOSANSHK.TTC", False), ("own/A-One.ttf", True)]


@query("select * from (values ('own/A-One.ttf', true), ('sys/Noto-Sans_HK.otf', false), ('sys/NOTOSANSHK.TTC', false)) v(path, own)")
def font_candidates(spark, sf):
    return fonts.candidates(values(spark, _FONT_FILES, "path string, own boolean"), ["notosanshk"])


def _font_file(lo: int, hi: int, weights: tuple[int, int] | None) -> bytes:
    """A font file of nothing but a map of code points lo to hi and, if asked for, a weight axis."""
    cmap = struct.pack(">HHHHI", 0, 1, 3, 10, 12) + struct.pack(">HHIII3I", 12, 0, 28, 0, 1, lo, hi, 1)
    parts = [(b"cmap", cmap)]
    if weights:
        parts.append((b"fvar", struct.pack(">6H", 1, 0, 16, 2, 1, 20) + struct.pack(">HH", 0, 0) + struct.pack(">4siiiHH", b"wght", weights[0] << 16, weights[0] << 16, weights[1] << 16, 0, 0)))
    head, at = struct.pack(">IHHHH", 0x10000, len(parts), 0, 0, 0), 12 + 16 * len(parts)
    for tag, body in parts:
        head += struct.pack(">4sIII", tag, 0, at, len(body))
        at += len(body)
    return head + b"".join(body for _, body in parts)


_SHARE = "greatest(0, least(hi, {1}) - greatest(lo, {0}) + 1) / ({1} - {0} + 1.0)"


@query(
    f"""with f as (select * from (values {_sql_values([(k, *v) for k, v in FONTS.items()])}) v(family, lo, hi)), w as (select f.*, v.variation from f left join (values ('letters', 400), ('letters', 700)) v(family, variation) using (family))
    select family || case when variation is null then '' else '@' || variation end as font_key, family, variation, hi - lo + 1 as n_glyphs, round({_SHARE.format(48, 86)}, 3)::double as coverage_bmp, round({_SHARE.format(232, 233)}, 3)::double as coverage_ext from w"""
)
def font_catalogue(spark, sf):
    """Instances of font files, made here from the ranges of FONTS; a broken file is left out."""
    files = [(f"dir/{k}.ttf", _font_file(a, b, (350, 750) if k == "letters" else None)) for k, (a, b) in FONTS.items()]
    faces = fonts.faces(values(spark, [*files, ("dir/broken.ttf", b"xx"), ("dir/empty.ttf", None)], "path string, content binary"))
    rows = fonts.catalogue(faces, [300, 400, 700], list(range(48, 87)), [232, 233])
    return rows.select("font_key", "family", "variation", "n_glyphs", F.round("coverage_bmp", 3).alias("coverage_bmp"), "coverage_ext")


_LEXICON_LINES = ["name: x\n...\n# note\n\n佢\tkeoi5\t50%\n佢\tkeoi6\t80%\n飲茶\tjam2 caa4\tx%\nabc\tx\n我哋今日飲\tlong\t9%", "...\n...\n佢\tkeoi7\t80%\n好\n飲茶\tother\n一a\tmixed"]
_LEXICON = [("char", "佢", "keoi6", 80.0), ("char", "好", "", 0.0), ("word", "飲茶", "jam2 caa4", 0.0)]


@query(f"select kind, word, romanisation, weight::double as weight from (values {_sql_values(_LEXICON)}) v(kind, word, romanisation, weight)")
def lexicon_entries(spark, sf):
    """Two dictionary files: headers, notes, weights, the first of equals, single characters and words of two to four."""
    paths = [new_path(spark, "lexicon") for _ in _LEXICON_LINES]
    for path, lines in zip(paths, _LEXICON_LINES, strict=True):
        values(spark, [("name: y\n" + lines if lines.startswith("...") else lines,)], "value string").write.text(path)
    single, words = corpus.lexicon(readers.lexicon(spark, paths), HAN)
    of = lambda rows, kind: rows.select(F.lit(kind).alias("kind"), "word", "romanisation", "weight")
    return of(single, "char").unionByName(of(words, "word"))


_LIST_ROWS = [("line", c) for c in "冇有嘅㐂𨋢"] + [("any", c) for c in "冇㐂𨋢"] + [("excluded", c) for c in "冇㐂𨋢佢"]


@query(f"select * from (values {_sql_values(_LIST_ROWS)}) v(kind, ch)")
def char_list_files(spark, sf):
    """A list of characters with notes by line and anywhere; exclusions are built-in ones and those of a file."""
    path = new_path(spark, "chars")
    values(spark, [("# 係 note\n冇a1。\n\n  㐂𨋢 # 有嘅\n#佢",)], "value string").write.text(path)
    own = readers.char_lines(spark, path, "any")
    of = lambda rows, kind: rows.select(F.lit(kind).alias("kind"), "ch")
    excluded = charset.exclusions(values(spark, [("佢",), ("冇",)], "ch string"), own)
    return of(readers.char_lines(spark, path), "line").union(of(own, "any")).union(of(excluded, "excluded"))


_HAN_EDGES = [(0x33FF, "other"), (0x3400, "ExtA"), (0x4DBF, "ExtA"), (0x4DC0, "other"), (0x4E00, "BMP"), (0x9FFF, "BMP"), (0xA000, "other"), (0xF900, "Compat"), (0xFAFF, "Compat"), (0xFB00, "other"), (0x1FFFF, "other"), (0x20000, "ExtB+"), (0x323AF, "ExtB+"), (0x323B0, "ExtB+")]
_NOT_HAN = (0x33FF, 0x4DC0, 0xA000, 0xFB00, 0x1FFFF, 0x323B0)


@query(f"select cp, plane, cp not in {_NOT_HAN} as han, printf('U+%05X', cp) as codepoint from (values {_sql_values(_HAN_EDGES)}) v(cp, plane)")
def han_edges(spark, sf):
    """Letters, blocks and names at both sides of every edge of the Han ranges."""
    rows = values(spark, [(cp, chr(cp)) for cp, _ in _HAN_EDGES], "cp int, ch string")
    return rows.select("cp", T.plane(F.col("ch")).alias("plane"), T.is_letter(F.col("ch"), HAN).alias("han"), T.code_point(F.col("ch")).alias("codepoint"))


_KEYS = [("Serif", 0, 0, "Serif"), ("Noto_Sans-HK", 2, 0, "Noto_Sans-HK#2"), ("Noto_Sans-HK", 0, 400, "Noto_Sans-HK@400"), ("Mix", 1, 700, "Mix#1@700")]


@query(f"select *, lower(replace(replace(family, '-', ''), '_', '')) as stem from (values {_sql_values(_KEYS)}) v(family, face, variation, font_key)")
def font_keys(spark, sf):
    rows = values(spark, [k[:3] for k in _KEYS], "family string, face int, variation int")
    return rows.select("*", T.font_key(F.col("family"), F.col("face"), F.col("variation")).alias("font_key"), T.stem(F.col("family")).alias("stem"))


_CUBE = "(o_orderkey * o_orderkey * o_orderkey)"


@query(
    f"select o_orderkey, case when {_CUBE} < 1024 then printf('%.1f B', {_CUBE}::double) when {_CUBE} < 1048576 then printf('%.1f KB', {_CUBE} / 1024.0::double) when {_CUBE} < 1073741824 then printf('%.1f MB', {_CUBE} / 1048576.0::double) when {_CUBE} < 1099511627776 then printf('%.1f GB', {_CUBE} / 1073741824.0::double) else printf('%.1f TB', {_CUBE} / 1099511627776.0::double) end as size from orders"
)
def human_sizes(spark, sf):
    """Cubes of keys as sizes; exact in 38 digits, as a long holds those of keys up to 2,097,151 only."""
    n = F.col("o_orderkey").cast("decimal(19,0)")
    return table(spark, sf, "orders").select("o_orderkey", T.human_bytes(n * n * n).alias("size"))


@query("select * from (values (1, 'TBD', 'TBD'), (2, '0.1234', '12.3%'), (3, '1.0000', '100.0%')) v(n, plain, percent)")
def percents(spark, sf):
    rows = values(spark, [(1, None), (2, 0.1234), (3, 1.0)], "n int, v double")
    return rows.select("n", T.percent(F.col("v")).alias("plain"), T.percent(F.col("v"), True).alias("percent"))


@query("select page_id, to_json({'model': 'm' || page_id, 'prompt': 'Read \"it\".', 'images': [base64(encode(html))], 'stream': false, 'options': {'temperature': 0.0::double}})::varchar as body, url as answer from pages")
def request_json(spark, sf):
    """Requests to a model server, and what is read from its answers."""
    body = evals.request(F.concat(F.lit("m"), "page_id"), 'Read "it".', F.col("html").cast("binary"), 0.0)
    reply = F.to_json(F.struct(F.lit("m").alias("model"), F.col("url").alias("response"), F.lit(True).alias("done")))
    return table(spark, sf, "pages").select("page_id", body.alias("body"), evals.answer(reply).alias("answer"))


_TREE = {"site": {"name": "ink\n", "title": "{{site.name}}: {{ page.n }}"}, "page": {"n": 3}, "old": "x"}
_TEMPLATE = "<h1>{{site.title}}</h1>{{missing}}"
_FILLED = [("value", "old", "x"), ("value", "page.n", "3"), ("value", "site.name", "ink"), ("value", "site.title", "ink: 3"), ("unused", "old", ""), ("unresolved", "missing", ""), ("page", "", "<h1>ink: 3</h1>{{missing}}")]


@query(f"select * from (values {_sql_values(_FILLED)}) v(kind, name, value)")
def template_values(spark, sf):
    """A catalogue of texts: dotted keys, values in values, keys that nothing uses, places that nothing fills."""
    flat = sinks.flattened(_TREE)
    page, unresolved = sinks.filled(_TEMPLATE, flat)
    rows = [("value", k, v) for k, v in sinks.resolved(flat).items()] + [("unused", k, "") for k in sinks.unused(flat, _TEMPLATE)]
    return values(spark, rows + [("unresolved", k, "") for k in unresolved] + [("page", "", page)], "kind string, name string, value string")


@query("select total, tier, greatest(1, round_even(size * total / 5000.0, 0))::bigint as n from (values ('char', 1200), ('word', 1800), ('sentence', 2000)) v(tier, size), (values (1), (500), (1234), (20000), (1000000)) t(total)")
def scaled_budgets(spark, sf):
    rows = [(total, tier, n) for total in (1, 500, 1234, 20000, 1000000) for tier, n in planner.scaled(planner.TIERS, total).items()]
    return values(spark, rows, "total int, tier string, n long")


@query(f"with {_BOTH} select distinct gt as ch from evals_ where tier = 'char'")
def marker_set(spark, sf):
    """The characters to mark, told by the rows of single characters that are targets."""
    rows = table(spark, sf, "conversations").select(F.explode(F.array_distinct(T.chars(F.col("text")))).alias("text"))
    return browse.markers(rows.withColumns({"tier": F.lit("char"), "role": F.when(F.col("text").isin(_MARKED), "target").otherwise("counterpart")}))
