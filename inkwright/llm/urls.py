"""URL filters: host and path rules, and a ratio of character language models for the rest, in SQL functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from inkwright.llm.store import written

#: Characters the models tell apart, all others being one more; code 0 stands before a url.
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789./-_?=&#%:"
CODES = len(ALPHABET) + 2
#: Log-likelihood ratios are whole numbers of 1 / UNIT, so that sums are exact.
UNIT = 10_000
#: First digits of the MD5 of the urls that calibrate the threshold, of those that rules judge: three in sixteen.
_FOLD = "'0', '1', '2'"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; null or without ://: empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end; null or without ://: empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest (rule, verdict) that fits, or nulls. A rule host/path fits the host, its subdomains and longer paths."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        top, _, rest = name.partition("/")
        fits = ((host == top) | host.endswith("." + top)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, F.lit(name)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def tail_of(url: Column) -> Column:
    """The characters after ://, A-Z lower-cased, ~ for those that ALPHABET doesn't hold; null or without ://: empty."""
    tail = F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit("")), _UPPER, _LOWER)
    return F.regexp_replace(tail, r"[^a-z0-9./_?=&#%:-]", "~")


def _codes(tail: Column) -> Column:
    """Codes of the characters, with two starts before them."""
    chars = F.filter(F.split(tail, ""), lambda c: c != "")
    code = lambda c: F.when(F.instr(F.lit(ALPHABET), c) > 0, F.instr(F.lit(ALPHABET), c)).otherwise(F.lit(CODES - 1))
    return F.concat(F.array(F.lit(0), F.lit(0)), F.transform(chars, code))


def _triples(codes: Column) -> Column:
    """Each character with the two before it, as one number; no characters: none."""
    at = lambda i: F.element_at(codes, i).cast("int")
    steps = F.when(F.size(codes) > 2, F.sequence(F.lit(3), F.size(codes))).otherwise(F.expr("cast(array() as array<int>)"))
    return F.transform(steps, lambda i: (at(i - 2) * CODES + at(i - 1)) * CODES + at(i))


def fit_models(labelled: DataFrame) -> DataFrame:
    """(id, llr): log-likelihood ratios, allow over block, of all CODES ** 3 triples in whole numbers of 1 / UNIT.

    labelled: codes, label 1 or 0. Both models are Markov models of variable order: the
    estimate after two characters is smoothed by that after one, that by the one without context and
    that by the uniform one, each weighted by how many different characters followed (Witten-Bell),
    so a context that wasn't seen leaves the word to the shorter one. Counts are over all urls in labelled.
    """
    spark, n = labelled.sparkSession, CODES
    counts = labelled.select("label", F.explode(_triples(F.col("codes"))).alias("id")).groupBy("id").agg(
        *(F.sum(F.when(F.col("label") == k, 1).otherwise(0)).alias(f"n{k}") for k in (0, 1))
    )
    grid = spark.range(0, n**3, 1, 1).join(counts.hint("shuffle_hash"), "id", "left").fillna(0, ["n0", "n1"])
    grid = grid.select("id", F.floor(F.col("id") / n).alias("ab"), F.floor(F.col("id") / n % n).alias("b"), (F.col("id") % n).alias("c"), "n0", "n1")
    # sums and numbers of followers for each context; one row per triple
    pairs = grid.groupBy("b", "c").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    ones = pairs.groupBy("c").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    seen = lambda col: F.sum(F.when(F.col(col) > 0, 1).otherwise(0))
    blend = lambda k, w, low: (F.col(f"n{k}") + seen(f"n{k}").over(w) * low) / (F.sum(f"n{k}").over(w) + seen(f"n{k}").over(w))
    flat = lambda k, w, low: F.when(F.sum(f"n{k}").over(w) > 0, blend(k, w, low)).otherwise(low)
    ones = ones.select("c", *(flat(k, Window.partitionBy(), F.lit(1.0 / n)).alias(f"p{k}") for k in (0, 1)))
    pairs = pairs.join(F.broadcast(ones), "c").select("b", "c", *(flat(k, Window.partitionBy("b"), F.col(f"p{k}")).alias(f"p{k}") for k in (0, 1)))
    grid = grid.join(F.broadcast(pairs), ["b", "c"]).select("id", *(flat(k, Window.partitionBy("ab"), F.col(f"p{k}")).alias(f"p{k}") for k in (0, 1)))
    return grid.select("id", F.round(F.log(F.col("p1") / F.col("p0")) * UNIT).cast("long").alias("llr"))


def score_urls(rows: DataFrame, models: DataFrame) -> DataFrame:
    """rows, which have a row_id of their own and codes, with score: the mean log-likelihood ratio of a character, 0 without characters.

    Triples meet the models' CODES ** 3 rows by a broadcast and are summed by row_id in each task first, so
    one row per url is shuffled, and no url, host or character holds a task.
    """
    keys = [c for c in rows.columns if c != "codes"]
    triples = rows.select(*keys, F.explode_outer(_triples(F.col("codes"))).alias("id"))
    sums = triples.join(F.broadcast(models), "id", "left").groupBy(*keys).agg(F.sum("llr").alias("total"), F.count("llr").alias("n"))
    score = F.when(F.col("n") > 0, F.col("total") / F.col("n") / UNIT).otherwise(F.lit(0.0))
    return sums.select(*keys, score.alias("score"))


def filter_urls(pages: DataFrame, rules: list[tuple[str, str]], page_id: str = "page_id", url: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every row of pages, by (rule, "allow" or "block") pairs.

    The longest rule that fits decides. Models of the urls that rules allowed and blocked judge the
    others by their length-normalised log-likelihood ratio: at a threshold between both classes' means,
    each as many of its standard deviations away, or higher, a url is allowed. The threshold is calibrated on the
    urls whose MD5 starts with a digit of _FOLD, which the models aren't fitted on; where either part lacks a class, on all of them, as
    the models then are too. Null urls and urls without :// have empty hosts and paths and score 0; without urls of both classes the
    threshold is 0 and all scores come from smoothing alone. Equal rows come back each; null page_ids too; other columns are not read.
    An empty table gives no rows.
    """
    u = F.col("url")
    rows = pages.select(pages[page_id].alias("page_id"), pages[url].cast("string").alias("url"))
    rows = rows.select(F.monotonically_increasing_id().alias("row_id"), "page_id", host_of(u).alias("host"), path_of(u).alias("path"), tail_of(u).alias("tail"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("by_rule", verdict).withColumn("part", F.expr(f"substr(md5(tail), 1, 1) in ({_FOLD})"))
    # written, or each triple would code its url anew
    rows = written(rows.withColumn("codes", _codes(F.col("tail")).cast("array<short>")).drop("tail"), "urls")
    labelled = rows.where("by_rule is not null").withColumn("label", F.when(F.col("by_rule") == "allow", 1).otherwise(0))
    whole = labelled.select("label", "part").distinct().count() < 4
    models = written(fit_models(labelled if whole else labelled.where(~F.col("part"))), "models")
    scored = written(score_urls(rows, models), "scored")
    judged = scored.where("by_rule is not null" if whole else "by_rule is not null and part").groupBy("by_rule")
    found = {r["by_rule"]: (r["m"], r["s"] + 1e-6) for r in judged.agg(F.avg("score").alias("m"), F.stddev_pop("score").alias("s")).collect()}
    least = 0.0
    if len(found) == 2:
        (m0, s0), (m1, s1) = found["block"], found["allow"]
        least = round((m0 * s1 + m1 * s0) / (s0 + s1), 9)
    return scored.select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("by_rule", F.when(F.col("score") >= least, F.lit("allow")).otherwise(F.lit("block"))).alias("verdict"),
        "score",
    )


def filter_sql(rules: list[tuple[str, str]]) -> str:
    """filter_urls over the table pages in DuckDB's SQL."""
    lower = f"translate({{0}}, '{_UPPER}', '{_LOWER}')"
    cases: dict[str, str] = {"rule": "", "by_rule": ""}
    for name, says in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        top, _, rest = name.partition("/")
        fits = f"(host = '{top}' or ends_with(host, '.{top}')) and starts_with(path, '/{rest}')"
        cases["rule"] += f" when {fits} then '{name}'"
        cases["by_rule"] += f" when {fits} then '{says}'"

    def flat(k: int, by: str, low: str) -> str:
        over = f"over ({by})"
        seen, total = f"sum((n{k} > 0)::int) {over}", f"sum(n{k}) {over}"
        return f"case when {total} > 0 then (n{k} + {seen} * {low}) / ({total} + {seen})::double else {low} end as p{k}"

    both = lambda f: ", ".join(f(k) for k in (0, 1))
    sums = both(lambda k: f"sum(n{k}) as n{k}")
    return f"""with hosts as (select page_id, row_number() over () as row_id, coalesce({lower.format("regexp_extract(url, '^.*?://([^/?#]*)', 1, 's')")}, '') as host,
      coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') as path, regexp_replace(coalesce({lower.format("regexp_extract(url, '^.*?://(.*)$', 1, 's')")}, ''), '[^a-z0-9./_?=&#%:-]', '~', 'gs') as tail from pages),
    urls as (select *, case{cases["rule"]} end as rule, case{cases["by_rule"]} end as by_rule from hosts),
    coded as (select *, list_concat([0, 0], list_transform(list_filter(string_split(tail, ''), lambda c: c <> ''), lambda c: case when instr('{ALPHABET}', c) > 0 then instr('{ALPHABET}', c) else {CODES - 1} end)) as codes from urls),
    parts as (select *, substr(md5(tail), 1, 1) in ({_FOLD}) as part from coded),
    whole as (select count(distinct (by_rule, part)) < 4 as whole from parts where by_rule is not null),
    triples as (select row_id, unnest(list_transform(range(1, len(codes) - 1), lambda i: (codes[i] * {CODES} + codes[i + 1]) * {CODES} + codes[i + 2])) as id from parts),
    counts as (select id, sum((by_rule = 'block')::int) as n0, sum((by_rule = 'allow')::int) as n1 from triples join parts using (row_id), whole where by_rule is not null and (whole or not part) group by id),
    grid as (select id, id // {CODES} as ab, id // {CODES} % {CODES} as b, id % {CODES} as c, coalesce(n0, 0) as n0, coalesce(n1, 0) as n1 from (select unnest(range({CODES ** 3})) as id) left join counts using (id)),
    pairs as (select b, c, {sums} from grid group by b, c), ones as (select c, {sums} from pairs group by c),
    p1 as (select c, {both(lambda k: flat(k, "", f"(1.0::double / {CODES})"))} from ones),
    p2 as (select b, c, {both(lambda k: flat(k, "partition by b", f"p1.p{k}"))} from pairs join p1 using (c)),
    p3 as (select id, {both(lambda k: flat(k, "partition by ab", f"p2.p{k}"))} from grid join p2 using (b, c)),
    models as (select id, round(ln(p1 / p0) * {UNIT})::bigint as llr from p3),
    scores as (select row_id, sum(llr)::bigint / count(*) / {UNIT}::double as score from triples join models using (id) group by row_id),
    scored as (select page_id, host, path, rule, by_rule, part, coalesce(score, 0.0) as score from parts left join scores using (row_id)),
    stats as (select avg(score) filter (by_rule = 'block') as m0, stddev_pop(score) filter (by_rule = 'block') + 1e-6 as s0, avg(score) filter (by_rule = 'allow') as m1, stddev_pop(score) filter (by_rule = 'allow') + 1e-6 as s1
      from scored, whole where by_rule is not null and (whole or part))
    select page_id, host, path, rule, coalesce(by_rule, case when score >= coalesce(round((m0 * s1 + m1 * s0) / (s0 + s1), 9), 0.0) then 'allow' else 'block' end) as verdict, score from scored, stats"""
