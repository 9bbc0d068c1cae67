"""Every query of the catalogue against its SQL in DuckDB, on the driver's smallest tables."""

import os

import duckdb
import pytest

from inkwright import queries as Q

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.sql(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    return c


def text(v):
    return None if v is None or v != v else repr(v) if isinstance(v, float) else str(v)


def ordered(rows, columns):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(text(r[i]) for i in at) for r in rows], key=str)


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    df, sql = Q.queries()[name](spark, SF), con.sql(Q.oracle_sql()[name])
    assert sorted(df.columns) == sorted(sql.columns)
    assert ordered([tuple(r) for r in df.collect()], df.columns) == ordered(sql.fetchall(), sql.columns)


def test_queries_do_not_depend_on_partitions(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("lang", "source", "doc_id")
    from inkwright.plans import planner

    plans = [planner.round_robin(rows.repartition(n), ["lang"], ["source"], "s", ["doc_id"], 20).select("doc_id", "pick") for n in (1, 7)]
    assert sorted(map(tuple, plans[0].collect())) == sorted(map(tuple, plans[1].collect()))


def test_image_measures_equal_numpy(spark):
    import numpy as np

    from inkwright.operators import images

    rows = duckdb.connect().sql(f"select vec_id, embedding from '{SF}/embeddings.parquet'").fetchall()
    got = {r.idx: (r.ink_ratio, r.contrast, r.gate) for r in Q.queries()["image_measures"](spark, SF).collect()}
    for i, v in rows:
        grey = np.clip(np.floor(np.array(v, np.float64) * 128 + 128), 0, 255).astype(np.uint8).reshape(8, 8)
        ink, contrast = round(images.ink_ratio(grey), 4), round(images.contrast(grey), 1)
        assert got[i] == (ink, contrast, "ink" if ink < 0.004 else "contrast" if contrast < 45 else None)


def test_benchmark_plan_holds_its_budgets(spark):
    plan = Q.queries()["benchmark_plan"](spark, SF).select("idx", "tier", "text", "font_key", "difficulty").collect()
    assert sorted(r.idx for r in plan) == list(range(len(plan)))
    n = {t: sum(r.tier == t for r in plan) for t in ("word", "sentence")}
    assert n["word"] <= 1800 and n["sentence"] <= 2000
    for r in plan:
        lo, hi = Q.FONTS[r.font_key]
        assert all(lo <= ord(c) <= hi for c in r.text)
