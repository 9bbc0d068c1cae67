import numpy as np
import pytest

from inkwright.llm.vectors import CapCode, near_duplicates, nearest

SCHEMA = "vec_id long, embedding array<double>, cap int"


def clustered(rng, n, d, copies):
    x = rng.standard_normal((n, d))
    near = np.concatenate([c + rng.standard_normal((m, d)) * s * np.linalg.norm(c) / np.sqrt(d) for c, (m, s) in zip(x, copies, strict=False)])
    return np.concatenate([x, near, np.repeat(x[:3], 5, axis=0)])


def frame(spark, x):
    return spark.createDataFrame([(i, v.tolist() if v is not None else None, 0) for i, v in enumerate(x)], SCHEMA)


def brute(x, least):
    u = x / np.linalg.norm(x, axis=1)[:, None]
    near = u @ u.T >= least - 1e-12
    np.fill_diagonal(near, False)
    root = np.arange(len(x))
    while True:
        new = np.minimum(root, np.where(near, root[None, :], len(x)).min(1))
        if (new == root).all():
            return near.sum(1), root
        root = new


@pytest.mark.parametrize("d", [2, 7, 64])
def test_near_duplicates_equal_brute_force(spark, d):
    rng = np.random.default_rng(d)
    x = clustered(rng, 600, d, [(40, 0.05), (700, 0.08), (30, 0.22), (60, 0.3), (5, 0.01)])
    links, root = brute(x, 0.95)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_duplicates(frame(spark, x)).collect()}
    want = {i: (int(links[i]), int(root[i]), bool(root[i] == i)) for i in range(len(x))}
    wrong = sum(got[i] != want[i] for i in want)
    assert all(got[i][0] <= want[i][0] for i in want)  # no link below the threshold
    assert sum(g[0] for g in got.values()) >= 0.999 * links.sum()
    assert wrong <= 0.02 * len(x)


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (9, [1.0, 0.0]), (9, [1.0, 0.0]), (10, [1.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows] + [(None, [1.0, 0.0], 1)], SCHEMA)
    got = sorted(tuple(r) for r in near_duplicates(df).collect() if r.vec_id)
    lone = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 10)]
    assert got == sorted([(1, 3, 1, True), (2, 3, 1, False), (9, 3, 1, False), (9, 3, 1, False), *lone])
    assert near_duplicates(df.limit(0)).collect() == []
    top = nearest(df, "vec_id >= 0", k=3).collect()
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in top if r.query_id == 1} == {(1, 1, 2, 2.0), (1, 2, 9, 1.0)}
    assert {r.query_id for r in top} == {1, 2, 9}
    assert nearest(df.limit(0), "true").collect() == []


def test_caps_list_all_filters():
    code = CapCode(12, 500, 0.95)
    x = np.random.default_rng(1).standard_normal((50, 12))
    x /= np.linalg.norm(x, axis=1)[:, None]
    found = []
    for rotation, words in code.codes:
        y, scores = x @ rotation, np.zeros((50, 1))
        for p, c in zip(code.parts, words, strict=True):
            scores = (scores[:, :, None] + (y[:, p] @ c.T)[:, None, :]).reshape(50, -1)
        found.append(scores)
    for row, ids in enumerate(code.list(x)):
        assert np.array_equal(ids, np.flatnonzero(np.concatenate([s[row] for s in found]) >= code.least))


@pytest.mark.parametrize(("dim", "n"), [(64, 10_000), (16, 3000), (6, 500)])
def test_pairs_at_the_threshold_share_filters(dim, n):
    rng = np.random.default_rng(9)
    x, y = rng.standard_normal((2, 2000, dim))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y -= (y * x).sum(1)[:, None] * x
    y = 0.95 * x + np.sqrt(1 - 0.95**2) * y / np.linalg.norm(y, axis=1)[:, None]
    code = CapCode(dim, n, 0.95)
    assert np.mean([len(np.intersect1d(a, b)) == 0 for a, b in zip(code.list(x), code.list(y), strict=True)]) < 0.01


def test_op5_on_planted_pairs(spark, tmp_path):
    """The query's links against brute force where many pairs lie around the threshold, on vectors like those of embeddings."""
    from inkwright.llm.queries import op5_embedding_near_dedup

    rng = np.random.default_rng(2)
    x = rng.standard_normal((1500, 64)).astype(np.float32)
    side = rng.standard_normal((500, 64))
    cos = rng.uniform(0.93, 0.99, (500, 1))
    base = x[:500] / np.linalg.norm(x[:500], axis=1)[:, None]
    side -= (side * base).sum(1)[:, None] * base
    near = cos * base + np.sqrt(1 - cos**2) * side / np.linalg.norm(side, axis=1)[:, None]
    rows = np.concatenate([x, near]).astype(np.float32)
    frame = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(rows)], "vec_id long, embedding array<float>, label int")
    frame.write.parquet(f"{tmp_path}/embeddings.parquet")
    links, root = brute(rows.astype(np.float64), 0.95)
    got = {r.vec_id: (r.n_links, r.component_id) for r in op5_embedding_near_dedup(spark, str(tmp_path)).collect()}
    assert links.sum() > 500
    assert all(got[i][0] <= links[i] for i in range(len(rows)))
    assert sum(n for n, _ in got.values()) >= 0.99 * links.sum()
    assert sum(got[i] != (links[i], root[i]) for i in range(len(rows))) <= 0.01 * len(rows)


def test_near_ties_are_ranked_exactly(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal(64)
    rows = np.stack([x * (1 + 1e-13 * i) for i in rng.permutation(60)])
    asks = [0, 20, 40]
    got = nearest(frame(spark, rows), "vec_id % 20 = 0").collect()
    for q in asks:
        scores = (rows * rows[q]).sum(1)
        scores[q] = -np.inf
        best = np.lexsort((np.arange(60), -scores))[:20]
        assert [r.vec_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])] == best.tolist()


def test_op7_recall_and_reads(spark):
    """The query's recall on embeddings, and that clustered data needs few reads, the fewer the more vectors there are."""
    import duckdb
    from inkwright.llm.queries import op7_nearest_neighbours
    from inkwright.llm.vectors import Forest

    sf = "/root/testdata/sf0.01"
    table = duckdb.connect().sql(f"select vec_id, embedding from '{sf}/embeddings.parquet' order by vec_id").fetchall()
    ids, x = np.array([i for i, _ in table]), np.array([v for _, v in table], np.float64)
    got: dict = {}
    for r in op7_nearest_neighbours(spark, sf).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    asks = [i for i in range(len(ids)) if ids[i] % 20 == 0]
    hits = 0
    for i in asks:
        s = x @ x[i]
        s[i] = -np.inf
        hits += len(got[ids[i]] & set(ids[np.argsort(-s)[:20]].tolist()))
    assert hits >= 0.95 * 20 * len(asks)
    rng = np.random.default_rng(7)
    centres = rng.standard_normal((400, 64))
    data = np.concatenate([centres + 0.3 * rng.standard_normal((400, 64)) for _ in range(40)])
    data = data[rng.permutation(len(data))]
    reads = [Forest(np.arange(n), data[:n], n, float(np.linalg.norm(data, axis=1).max()), 10).budget * n for n in (2000, 16_000)]
    assert reads[1] < 0.3 * 16_000 and reads[1] < 8 * reads[0]


@pytest.mark.parametrize("unit", [True, False])
def test_nearest_recall(spark, unit):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((3000, 32))
    x = x / np.linalg.norm(x, axis=1)[:, None] if unit else x * rng.uniform(0.5, 1.5, (3000, 1))
    x[50:90] = x[50]
    rows = nearest(frame(spark, x), "vec_id % 20 = 0").collect()
    asks = np.arange(0, 3000, 20)
    s = x[asks] @ x.T
    s[np.arange(len(asks)), asks] = -np.inf
    got = {}
    for r in rows:
        assert abs(r.score - x[r.query_id] @ x[r.vec_id]) < 1e-12
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    hits = 0
    for row, q in enumerate(asks):
        own = [v for _, v in sorted(got[q])]
        assert len(own) == 20 and len(set(own)) == 20
        best = np.lexsort((np.arange(3000), -s[row]))[:20]
        hits += len(set(own) & set(best.tolist()))
    assert hits >= 0.9 * 20 * len(asks)
    # of equal vectors the least ids come first, whatever rounding does
    assert not unit or [v for _, v in sorted(got[60])][:20] == list(range(50, 60)) + list(range(61, 71))
