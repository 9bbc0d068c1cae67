import os

import duckdb
import pytest

from inkwright.llm import queries as Q

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    df, sql = Q.queries()[name](spark, SF), con.sql(Q.oracle_sql()[name])
    columns = sorted(df.columns)
    at = [sql.columns.index(c) for c in columns]
    assert sorted(sql.columns) == columns
    assert sorted(map(repr, map(tuple, df.select(columns).collect()))) == sorted(repr(tuple(r[i] for i in at)) for r in sql.fetchall())


def test_url_models_against_python(spark):
    """Verdicts and scores of urls that no rule fits, by a model written anew."""
    import hashlib
    import math
    import random
    from collections import Counter
    from fractions import Fraction

    from inkwright.llm.urls import ALPHABET, filter_urls

    rnd = random.Random(1)
    hosts = {"allow": ["good.org", "x.good.org"], "block": ["bad.net", "y.bad.net"], None: ["new.io", "other.de"]}
    stems = {"allow": ["news", "science", "books"], "block": ["casino", "poker", "xxx"], None: ["news", "casino", "books", "poker", "zz"]}
    urls = []
    for says in hosts:
        for _ in range(60):
            urls.append((says, f"https://{rnd.choice(hosts[says])}/{rnd.choice(stems[says])}/{rnd.choice(stems[says])}{rnd.randrange(99)}?Q=ü"))
    urls += [(None, "no scheme"), (None, None), (None, "http://")]
    df = spark.createDataFrame([(i, u) for i, (_, u) in enumerate(urls)], "page_id long, url string")
    got = {r.page_id: r for r in filter_urls(df, [("good.org/", "allow"), ("bad.net/", "block")]).collect()}

    tail = lambda u: "".join(c if c in ALPHABET else "~" for c in u.split("://", 1)[1].lower()) if u and "://" in u else ""
    code = lambda c: ALPHABET.find(c) + 1 or len(ALPHABET) + 1
    triples = lambda t: [tuple(v) for c in [[0, 0, *map(code, t)]] for v in zip(c, c[1:], c[2:])]
    held = lambda t: hashlib.md5(t.encode()).hexdigest()[0] in "012"
    n = len(ALPHABET) + 2
    p = {}
    for says in ("allow", "block"):
        after: list[dict] = [{}, {}, {}]
        for s, u in urls:
            if s == says and not held(tail(u)):
                for a, b, c in triples(tail(u)):
                    for at, context in enumerate(((), (b,), (a, b))):
                        after[at].setdefault(context, Counter())[c] += 1

        def chance(a, b, c, after=after):
            low = Fraction(1, n)
            for at, context in enumerate(((), (b,), (a, b))):
                seen = after[at].get(context)
                if seen:
                    low = (seen[c] + len(seen) * low) / (sum(seen.values()) + len(seen))
            return float(low)

        p[says] = chance

    def score(u):
        own = [round(math.log(p["allow"](*t) / p["block"](*t)) * 10_000) for t in triples(tail(u))]
        return sum(own) / len(own) / 10_000 if own else 0.0

    of = {says: [score(u) for s, u in urls if s == says and held(tail(u))] for says in ("allow", "block")}
    mean = {s: sum(v) / len(v) for s, v in of.items()}
    dev = {s: math.sqrt(sum((x - mean[s]) ** 2 for x in v) / len(v)) + 1e-6 for s, v in of.items()}
    least = (mean["block"] * dev["allow"] + mean["allow"] * dev["block"]) / (dev["allow"] + dev["block"])
    for i, (says, u) in enumerate(urls):
        assert abs(got[i].score - score(u)) < 1e-9
        assert got[i].verdict == (says or ("allow" if score(u) >= least else "block"))
