"""Near duplicates and nearest neighbours of embeddings: spherical-cap filters and a forest of random-projection trees."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from math import ceil, log, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from inkwright.llm.components import connected_components
from inkwright.llm.store import written

#: Members of a bucket that meet in a task at once; larger buckets are cut into tiles.
TILE = 512


def _lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    flat = np.concatenate(rows) if rows else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, kind))


def _usable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, hi, lo, dim, vector) of rows; dim 0 for vectors that take no part."""
    for batch in batches:
        hi, lo, dims, out = [], [], [], []
        for v in batch.column(1):
            x = np.empty(0)
            if v.is_valid and len(v) and not v.values.null_count:
                x = np.asarray(v.values.to_numpy(zero_copy_only=False), np.float64) + 0.0
                norm = sqrt(float(x @ x)) if np.isfinite(x).all() else 0.0
                if not (norm > 0 and np.isfinite(norm)):
                    x = np.empty(0)
            both = xxhash.xxh3_128_intdigest(x.tobytes())
            hi.append(both >> 64)
            lo.append(both & (2**64 - 1))
            dims.append(len(x))
            out.append(x)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(np.array(hi, np.uint64).view(np.int64)),
                pa.array(np.array(lo, np.uint64).view(np.int64)),
                pa.array(dims, pa.int32()),
                _lists(out, pa.float64()),
            ],
            ["vec_id", "hi", "lo", "dim", "vector"],
        )


def distinct_vectors(rows: DataFrame, vec_id: str, vector: str, keep: int) -> tuple[DataFrame, DataFrame, int]:
    """(all rows with their vector's hash, usable distinct vectors with least id, count and keep least ids, dimension).

    Vectors that are null, empty, zero or hold null or non-finite components, and those of another
    length than most (of equally common lengths the least), are not usable.
    """
    rows = rows.select(rows[vec_id].cast("long").alias("vec_id"), rows[vector].cast("array<double>").alias("v"))
    rows = rows.mapInArrow(_usable, "vec_id long, hi long, lo long, dim int, vector array<double>")
    usable = rows.where("dim > 0 and vec_id is not null")
    # pre-aggregated in each task; ids beyond the least `keep` are dropped only where no result can hold them
    grouped = usable.groupBy("hi", "lo", "dim").agg(
        F.min("vec_id").alias("id"), F.count("*").alias("n"), F.any_value("vector").alias("vector")
    )
    grouped = written(grouped, "vectors")
    dims = grouped.groupBy("dim").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "dim").limit(1).collect()
    dim = dims[0]["dim"] if dims else 0
    return rows.drop("vector"), grouped.where(F.col("dim") == dim), dim


#: Product codes; least cosine pairs at which calibrate a code, and how many of those may share no filter; most codewords of a block.
CODES, PAIRS, MISSED, WORDS = 12, 500, 1, 4096


class CapCode:
    """Random product codes on the sphere: a filter is one unit vector for each block of a vector rotated for its code.

    list(x) gives all filters c of all codes with <x, c> >= alpha. There are about as many filters as would leave most of them
    without two of n random vectors; alpha is the greatest at which of PAIRS random pairs at cosine least all but MISSED share a filter.
    Codes of few blocks and several rotations keep lists about equally long: in one code of many blocks some vectors have hundreds of
    filters and others none.
    """

    def __init__(self, dim: int, n: int, least: float, seed: int = 11):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.blocks = 1 if dim < 8 else 2 if 20 * n <= WORDS**2 or dim < 24 else 3
        # in few dimensions one code of unstructured filters has lists about as long for all vectors
        self.size = 64 * dim if self.blocks == 1 else max(8, min(WORDS, ceil(((2000 if self.blocks == 3 else 20) * n) ** (1 / self.blocks))))
        self.parts = np.array_split(np.arange(dim), self.blocks)
        self.codes = []
        for _ in range(CODES if self.blocks > 1 else 1):
            rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
            words = [rng.standard_normal((self.size, len(p))) for p in self.parts]
            self.codes.append((rotation, [w / np.linalg.norm(w, axis=1)[:, None] for w in words]))
        self.least = 0.0
        self._calibrate(rng, dim, least)

    def _calibrate(self, rng: np.random.Generator, dim: int, least: float) -> None:
        x, y = rng.standard_normal((2, PAIRS, dim))
        x /= np.linalg.norm(x, axis=1)[:, None]
        y -= (y * x).sum(1)[:, None] * x
        y = least * x + sqrt(max(0.0, 1 - least * least)) * y / np.linalg.norm(y, axis=1)[:, None] if dim > 1 else x
        low, high = -sqrt(self.blocks), sqrt(self.blocks)
        steps = np.linspace(high, low, 33)
        for high, low in zip(steps[:-1], steps[1:], strict=True):  # from few filters to many, as long lists take long
            if self._missed(x, y, low) <= MISSED:
                break
        for _ in range(4):
            mid = (low + high) / 2
            low, high = (mid, high) if self._missed(x, y, mid) <= MISSED else (low, mid)
        self.least = low

    def _missed(self, x: np.ndarray, y: np.ndarray, least: float) -> int:
        self.least = least
        return sum(not np.intersect1d(a, b, assume_unique=True).size for a, b in zip(self.list(x), self.list(y), strict=True))

    def list(self, x: np.ndarray) -> list[np.ndarray]:
        """The ids of the filters of each row of x, ascending; branches that cannot reach alpha are cut first."""
        found: list[list[np.ndarray]] = [[] for _ in x]
        for at, (rotation, words) in enumerate(self.codes):
            y = x @ rotation
            scores = [y[:, p] @ c.T for p, c in zip(self.parts, words, strict=True)]
            best = np.stack([s.max(1) for s in scores], 1)
            total = best.sum(1)
            for row in np.flatnonzero(total >= self.least).tolist():
                ids, sums, rest = np.full(1, at, np.int64), np.zeros(1), total[row]
                for b, s in enumerate(scores):
                    rest -= best[row, b]
                    ok = np.flatnonzero(s[row] >= self.least - (total[row] - best[row, b]) - 1e-12)
                    sums_ = sums[:, None] + s[row][ok][None, :]
                    keep = sums_ >= self.least - rest
                    ids = (ids[:, None] * self.size + ok[None, :])[keep]
                    sums = sums_[keep]
                found[row].append(ids)
        return [np.sort(np.concatenate(ids)) if ids else np.empty(0, np.int64) for ids in found]


def _caps(code):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = code.value
        for batch in batches:
            for k in range(0, len(batch), 256):
                part = batch.slice(k, 256)
                x = part.column(2).flatten().to_numpy().reshape(len(part), -1)
                x = x / np.sqrt((x * x).sum(1))[:, None]
                scale = np.abs(x).max(1) / 32767
                short = np.rint(x / scale[:, None]).astype(np.int16)
                off = np.sqrt(((x - short * scale[:, None]) ** 2).sum(1)) + 1e-12
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([v.tobytes() for v in short], pa.binary()), pa.array(scale), pa.array(off), _lists(c.list(x), pa.int64())],
                    ["node", "n", "short", "scale", "off", "caps"],
                )

    return run


def _roots(near: np.ndarray) -> np.ndarray:
    """The least member reachable for each member of a small graph."""
    root = np.arange(len(near))
    reach = near | np.eye(len(near), dtype=bool)
    while True:
        new = np.where(reach, root[None, :], len(near)).min(1)
        new = np.minimum(new, new[new])
        if (new == root).all():
            return root
        root = new


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, pa.Table]]:
    """Runs of rows with equal first columns, across batches; each run is bounded by what dealt it."""
    held: list[pa.RecordBatch] = []
    at: tuple | None = None
    for batch in batches:
        if not len(batch):
            continue
        cols = [batch.column(i).to_numpy() for i in range(keys)]
        change = np.zeros(len(batch), bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        edges = [0, *np.flatnonzero(change).tolist(), len(batch)]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            key = tuple(c[a] for c in cols)
            if held and key != at:
                yield at, pa.Table.from_batches(held)
                held = []
            at = key
            held.append(batch.slice(a, b - a))
    if held:
        yield at, pa.Table.from_batches(held)


def _may_link(group: pa.Table, i: int, j: int, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pairs of a tile that may reach least, dots of rounded vectors, bounds of their errors)."""
    x = np.frombuffer(b"".join(group["short"].to_pylist()), np.int16).reshape(len(group), -1).astype(np.float64)
    scale, off = group["scale"].to_numpy(), group["off"].to_numpy()
    dots = (x @ x.T) * scale[:, None] * scale[None, :]
    slack = (1 + off)[:, None] * off[None, :] + (1 + off)[None, :] * off[:, None] + off[:, None] * off[None, :]
    may = dots + slack >= least
    np.fill_diagonal(may, False)
    if i != j:
        side = group["side"].to_numpy()
        may &= side[:, None] != side[None, :]
    return may, dots, slack


def _hits(least: float):
    """(cap, node) of the members of a tile that may have a link in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (cap, i, j), group in _groups(batches, 3):
            if len(group) > 1:
                who = np.flatnonzero(_may_link(group, i, j, least)[0].any(1))
                if len(who):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(who), cap)), pa.array(group["node"].to_numpy()[who])], ["cap", "node"])

    return run


def _links(least: float):
    """Links of one tile of a bucket, each in the first bucket that both vectors are in.

    Rows out: (a, b, n, 0), n more links of a, and in b a vector linked with it or null; (a, b, 0, 1): a pair
    too near the threshold to tell from rounded vectors.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (cap, i, j), group in _groups(batches, 3):
            ids, n = group["node"].to_numpy(), group["n"].to_numpy()
            if len(ids) < 2:
                continue
            may, dots, slack = _may_link(group, i, j, least)
            who = np.flatnonzero(may.any(1))
            if not len(who):
                continue
            # filters below this one, by which the first common one is known
            caps = group["caps"].combine_chunks()
            caps = caps.chunk(0) if isinstance(caps, pa.ChunkedArray) else caps
            ends, flat = caps.offsets.to_numpy(), caps.values.to_numpy()
            lower = [flat[ends[k] : ends[k + 1]] for k in who]
            lower = [own[: np.searchsorted(own, cap)] for own in lower]
            _, codes = np.unique(np.concatenate(lower), return_inverse=True)
            seen = np.zeros((len(who), int(codes.max()) + 1 if len(codes) else 1), np.float32)
            seen[np.repeat(np.arange(len(who)), [len(own) for own in lower]), codes] = 1
            may = may[np.ix_(who, who)] & (seen @ seen.T < 0.5)
            sure = may & ((dots - slack)[np.ix_(who, who)] >= least)
            ids, n = ids[who], n[who]
            more, root = (sure * n[None, :]).sum(1), _roots(sure)
            a, b = np.nonzero(np.triu(may & ~sure))
            own = np.flatnonzero(more)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([ids[own], ids[a]])),
                    pa.array(np.concatenate([ids[root[own]], ids[b]])),
                    pa.array(np.concatenate([more[own], np.zeros(len(a), np.int64)])),
                    pa.array(np.concatenate([np.zeros(len(own), np.int32), np.ones(len(a), np.int32)])),
                ],
                ["a", "b", "n", "open"],
            )

    return run


def _cosines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x, y = (batch.column(i).flatten().to_numpy().reshape(len(batch), -1) for i in (4, 5))
        cos = (x * y).sum(1) / np.sqrt((x * x).sum(1) * (y * y).sum(1)) if len(batch) else np.empty(0)
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(cos)], ["a", "b", "na", "nb", "cos"])


def tiled(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """rows(cap, node) with (i, j, side), by parts(cap, parts): buckets of more than TILE rows are cut into parts, and every two parts meet in a tile."""
    rows = rows.join(F.broadcast(parts) if parts.count() <= BROADCAST_CAPS else parts, "cap")
    rows = rows.withColumn("side", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return rows.withColumns({"i": F.least("side", "other"), "j": F.greatest("side", "other")}).drop("parts", "other")


#: Filters of more than one vector up to which their parts are broadcast (16 MB).
BROADCAST_CAPS = 250_000


def near_duplicates(rows: DataFrame, least: float = 0.95, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row: links are pairs with cosine >= least.

    Equal vectors are one node with a count. Unusable vectors (see distinct_vectors) have no links and
    are their own components; rows with a null id too, with a null component, not kept. Rows of one
    id are vectors of their own. Vectors meet in the buckets of their spherical caps, of which those of one vector are
    left out first; vectors rounded to 16 bits tell nearly all pairs from the threshold, the rest is verified in double
    precision. Of pairs at the threshold about one in 500 shares no cap. An empty table gives no rows.
    """
    spark = rows.sparkSession
    every, nodes, dim = distinct_vectors(rows, vec_id, vector, 1)
    every = written(every, "ids")
    if not dim:
        return every.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    code = spark.sparkContext.broadcast(CapCode(dim, nodes.count(), least))
    # a node is known by its hash, as equal ids may have different vectors
    known = nodes.select(F.col("hi").alias("node"), "n", "vector", "id")
    schema = "node long, n long, short binary, scale double, off double, caps array<long>"
    lists = written(known.select("node", "n", "vector").repartition("node").mapInArrow(_caps(code), schema), "caps")
    posts = lists.select("node", F.explode("caps").alias("cap"))
    parts = posts.groupBy("cap").agg(F.count("*").alias("m")).where("m > 1")
    parts = written(parts.select("cap", F.ceil(F.col("m") / TILE).cast("int").alias("parts")), "parts")

    def dealt(posts: DataFrame, *more: str) -> DataFrame:
        tiles = tiled(posts, parts).join(lists.select("node", "short", "scale", "off", *more), "node")
        tiles = tiles.select("cap", "i", "j", "side", "node", "short", "scale", "off", *more)
        return tiles.repartition("cap", "i", "j").sortWithinPartitions("cap", "i", "j")

    # most vectors have no link: only members that may have one meet again with what tells a pair's first common cap
    hits = written(dealt(posts).mapInArrow(_hits(least), "cap long, node long").distinct(), "hits")
    found = written(dealt(hits, "n", "caps").mapInArrow(_links(least), "a long, b long, n long, open int"), "links")
    x, y = (known.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("vector").alias(f"v{c}")) for c in "ab")
    unsure = found.where("open = 1").select("a", "b").join(x, "a").join(y, "b").select("a", "b", "na", "nb", "va", "vb")
    exact = unsure.mapInArrow(_cosines, "a long, b long, na long, nb long, cos double").where(F.col("cos") >= least)
    exact = written(exact, "exact")
    # rows of a pair of parts on one side only count for that side, so both of a tile's members are in its rows
    sums = found.where("open = 0").select("a", "n").union(exact.select("a", "nb")).union(exact.select("b", "na")).groupBy("a").agg(F.sum("n").alias("more"))
    edges = found.where("open = 0").select("a", "b").union(exact.select("a", "b"))
    parts = connected_components(edges)
    ids = known.select("node", "id", "n").join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least_id = ids.groupBy("component").agg(F.min("id").alias("component_id"))
    ids = ids.join(least_id, "component").join(sums.withColumnRenamed("a", "node"), "node", "left")
    ids = ids.select(F.col("node").alias("hi"), "component_id", (F.col("n") - 1 + F.coalesce("more", F.lit(0))).alias("links"))
    out = every.withColumn("hi", F.when((F.col("dim") == dim) & F.col("vec_id").isNotNull(), F.col("hi"))).join(ids, "hi", "left")
    out = out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


#: Trees; about how many vectors the smallest leaves hold and the greatest depth; vectors that trees are fitted on at most, those
#: of least hash (every vector is indexed), and how many of them calibrate the depth and how far queries search.
TREES, LEAF, DEPTH, SAMPLE, CALIBRATION = 10, 400, 10, 20_000, 200
#: Share of the nearest neighbours of the calibrating vectors that the search must come to.
RECALL = 0.975
#: Cost of bringing a query to a leaf, in products of two vectors; rows of a leaf in a task at once.
VISIT, PART = 400, 4096


class Forest:
    """Random-projection trees: a node sends a vector left or right of the sample's median along a random direction.

    Vectors are scaled by the greatest norm and given one more component that makes them unit vectors,
    so that the largest inner product with a query is the least angle. A query walks all trees from one
    priority queue, at each step into the node likeliest to hold a near neighbour, given its distances to
    the splits above, until the leaves it has come to hold budget times all vectors.

    The budget is what brings RECALL of the sample's own nearest neighbours: as many of them as the k nearest of n are in
    the sample's share of all vectors. Where data has structure that is little and falls as n grows; vectors without any need most.
    Of the depths that n allows the one of least cost is taken.
    """

    def __init__(self, ids: np.ndarray, sample: np.ndarray, n: int, norm: float, k: int, seed: int = 5):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.ids, self.sample, self.norm, self.k = ids, sample, norm, k
        leaf = max(LEAF, 4 * k)
        most = max(0, min(DEPTH, ceil(log(n / leaf, 2)), int(log(max(1, len(sample)) / 16, 2)))) if n > leaf else 0
        x = self.unit(sample)
        nodes = (1 << most) - 1
        dirs = rng.standard_normal((TREES, nodes, x.shape[1]))
        dirs /= np.linalg.norm(dirs, axis=2)[:, :, None]
        cuts, own = np.zeros((TREES, nodes)), np.zeros((TREES, len(x)), np.int64)
        for t in range(TREES):
            for node in range(nodes):
                here = np.flatnonzero(own[t] == node)
                p = x[here] @ dirs[t, node]
                cuts[t, node] = np.median(p) if len(here) else 0.0
                own[t, here] = 2 * node + 1 + (p > cuts[t, node])
            own[t] -= nodes
        tried = []
        for depth in range(min(3, most), most + 1):
            self._cut(depth, dirs, cuts, own >> (most - depth))
            self.budget = float(TREES)
            self.budget, leaves = self._needed((own >> (most - depth)) + (np.arange(TREES) << depth)[:, None], n)
            tried.append((self.budget * n + VISIT * leaves, depth, self.budget))
        _, depth, budget = min(tried)
        self._cut(depth, dirs, cuts, own >> (most - depth))
        self.budget = budget

    def _cut(self, depth: int, dirs: np.ndarray, cuts: np.ndarray, leaves: np.ndarray) -> None:
        """Trees of that depth, which are the tops of deeper ones."""
        nodes = (1 << depth) - 1
        self.depth, self.dirs, self.cuts = depth, dirs[:, :nodes], cuts[:, :nodes]
        self.share = np.stack([np.bincount(own, minlength=1 << depth) for own in leaves]) / max(1, leaves.shape[1])

    def _needed(self, leaves: np.ndarray, n: int) -> tuple[float, float]:
        """The multiple of all vectors that queries must read for RECALL of the nearest neighbours in the sample, and the leaves that hold it."""
        k = min(len(self.sample) - 1, max(1, round(self.k * len(self.sample) / n)))
        if self.depth == 0 or k < 1:
            return 1.0, 1.0
        asks = np.arange(min(CALIBRATION, len(self.sample)))
        scores = self.sample[asks] @ self.sample.T
        scores[asks, asks] = -np.inf
        near = np.argpartition(-scores, k - 1, axis=1)[:, :k]
        needed, reads = [], []
        for own, got in zip(near, self.visits(self.sample[asks]), strict=True):
            read = np.full(self.share.size, float(TREES))
            read[got] = np.cumsum(self.share.reshape(-1)[got])
            needed.append(read[leaves[:, own]].min(0))
            reads.append(np.sort(read))
        budget = float(np.quantile(np.concatenate(needed), RECALL, method="higher"))
        return budget, float(np.mean([np.searchsorted(r, budget) + 1 for r in reads]))

    def bounds(self, ids: np.ndarray, q: np.ndarray) -> np.ndarray:
        """For each query a score that its k-th nearest has at least: the sample's k-th, less what rounding may add."""
        if len(self.sample) <= self.k:
            return np.full(len(q), -np.inf)
        scores = q @ self.sample.T
        scores[ids[:, None] == self.ids[None, :]] = -np.inf
        kth = np.partition(scores, len(self.sample) - self.k, axis=1)[:, len(self.sample) - self.k]
        return kth - 1e-14 * q.shape[1] * self.norm * np.sqrt((q * q).sum(1))

    def unit(self, x: np.ndarray) -> np.ndarray:
        x = x / self.norm
        return np.column_stack([x, np.sqrt(np.maximum(0.0, 1 - (x * x).sum(1)))])

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row in each tree, numbered through all trees."""
        x, out = self.unit(x), np.empty((len(x), TREES), np.int64)
        for t in range(TREES):
            at = np.zeros(len(x), np.int64)
            side = (x @ self.dirs[t].T) > self.cuts[t] if self.depth else None
            for _ in range(self.depth):
                at = 2 * at + 1 + side[np.arange(len(x)), at]
            out[:, t] = at - ((1 << self.depth) - 1) + (t << self.depth)
        return out

    def visits(self, q: np.ndarray) -> list[list[int]]:
        """The leaves that each query row comes to, in that order."""
        q = np.column_stack([q / np.sqrt((q * q).sum(1))[:, None], np.zeros(len(q))])
        inner = (1 << self.depth) - 1
        # how many deviations right of the cut; a near neighbour shares about half of them
        far = (np.tensordot(q, self.dirs, (1, 2)) - self.cuts[None]) * sqrt(q.shape[1]) * 0.55 * 1.702
        right, left = -np.logaddexp(0, -far), -np.logaddexp(0, far)
        out = []
        for r, l in zip(right.tolist(), left.tolist(), strict=True):
            queue, got, read = [(0.0, t, 0) for t in range(TREES)], [], 0.0
            while queue and read < self.budget:
                cost, t, node = heapq.heappop(queue)
                if node >= inner:
                    got.append((t << self.depth) + node - inner)
                    read += self.share[t, node - inner]
                else:
                    heapq.heappush(queue, (cost - l[t][node], t, 2 * node + 1))
                    heapq.heappush(queue, (cost - r[t][node], t, 2 * node + 2))
            out.append(got)
        return out


def _of_sample(forest):
    """The k best of the sample for each query, so that with the others that reach its bound it has k, or all there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = forest.value
        for batch in batches:
            for r in range(0, len(batch), 512):
                part = batch.slice(r, 512)
                q, own = _matrix(part.column(1), len(part)), part.column(0).to_numpy()
                yield _rows_of_best(f.k, own, q, f.ids, f.sample, f.bounds(own, q))

    return run


def _rows_of_best(k: int, own: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, bounds: np.ndarray) -> pa.RecordBatch:
    """(query_id, vec_id, score): the k best rows of x for each query, ties to least ids, but none below its bound.

    All products are in double precision. Those of a matrix product, whose rounding depends on places, only tell which are
    computed again, one by one: the k best and all within rounding of the k-th.
    """
    scores = q @ x.T
    scores[own[:, None] == ids[None, :]] = -np.inf
    least = bounds
    if len(ids) > k:
        least = np.maximum(least, np.partition(scores, len(ids) - k, axis=1)[:, len(ids) - k])
    slack = 2e-15 * x.shape[1] * float(np.sqrt((x * x).sum(1)).max()) * np.sqrt((q * q).sum(1))
    row, col = np.nonzero((scores >= (least - slack)[:, None]) & (scores > -np.inf))
    exact = (x[col] * q[row]).sum(1)
    order = np.lexsort((ids[col], -exact, row))
    row, col, exact = row[order], col[order], exact[order]
    first = np.arange(len(row)) - np.searchsorted(row, row) < k
    return pa.RecordBatch.from_arrays([pa.array(own[row[first]]), pa.array(ids[col[first]]), pa.array(exact[first])], ["query_id", "vec_id", "score"])


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(rows, -1)


def _placed(forest, visits: bool, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = forest.value
        for batch in batches:
            for k in range(0, len(batch), 512):
                part = batch.slice(k, 512)
                x, ids = _matrix(part.column(1), len(part)), part.column(0).to_numpy()
                lists = f.visits(x) if visits else f.leaves(x).tolist()
                bound = f.bounds(ids, x) if visits else np.zeros(len(x))
                who = np.repeat(np.arange(len(part)), [len(v) for v in lists])
                own = [v.tobytes() for v in x.astype(kind)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v for got in lists for v in got], pa.int64()), pa.array(ids[who]), pa.array([own[i] for i in who], pa.binary()), pa.array(bound[who])],
                    ["leaf", "id", "own", "bound"],
                )

    return run


def _best(k: int, kind: str):
    """Rows of a leaf's part, vectors before queries: what _rows_of_best gives of all vectors of the part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, ids, x = None, [], None, None
        for batch in batches:
            cols = [batch.column(i).to_numpy() for i in range(4)]
            bounds = batch.column(5).to_numpy()
            change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols[:3]], axis=0)) + 1
            for a, b in zip([0, *change.tolist()], [*change.tolist(), len(batch)], strict=True):
                if a == b:
                    continue
                at, role = (cols[0][a], cols[1][a]), cols[2][a]
                v = np.frombuffer(b"".join(batch.column(4).slice(a, b - a).to_pylist()), kind).reshape(b - a, -1).astype(np.float64)
                own = cols[3][a:b]
                if at != key:
                    key, held, x = at, [], None
                if role == 0:
                    held.append((own, v))
                    continue
                if not held:
                    continue
                if x is None:
                    ids, x = np.concatenate([i for i, _ in held]), np.concatenate([m for _, m in held])
                for r in range(0, len(own), 256):
                    yield _rows_of_best(k, own[r : r + 256], v[r : r + 256], ids, x, bounds[a:b][r : r + 256])

    return run


def nearest(rows: DataFrame, queries: str, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of largest inner product found for each row that the SQL condition on vec_id picks.

    Every row is a candidate but the query's own id; ranks run from 1, ties to smaller ids; fewer
    candidates than k come back all. Unusable vectors (see distinct_vectors) and null ids take no part. Of
    equal vectors only the k + 1 least ids can be among a query's k nearest, so others aren't indexed.
    Every vector in the leaves that a query comes to is ranked by its original components in double
    precision. Rows of one id and vector count once. An empty table gives no rows.
    """
    spark = rows.sparkSession
    kind = "<f4" if rows.schema[vector].dataType.simpleString() == "array<float>" else "<f8"
    rows = rows.select(rows[vec_id].cast("long").alias("vec_id"), rows[vector].cast("array<double>").alias("v"))
    rows = rows.where("vec_id is not null").mapInArrow(_usable, "vec_id long, hi long, lo long, dim int, vector array<double>").where("dim > 0")
    rows = written(rows, "vectors")
    dims = rows.groupBy("dim").count().orderBy(F.desc("count"), "dim").limit(1).collect()
    rows = rows.where(F.col("dim") == (dims[0]["dim"] if dims else 0))
    first = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy("vec_id"))
    own = rows.select("hi", "lo", "vec_id").distinct().withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(256)))
    own = own.withColumn("r", first("hi", "lo", "salt")).where(F.col("r") <= k + 1)
    own = own.withColumn("r", first("hi", "lo")).where(F.col("r") <= k + 1).select("hi", "lo", "vec_id")
    index = written(rows.select("hi", "lo", "vec_id", "vector").join(own, ["hi", "lo", "vec_id"], "left_semi").dropDuplicates(["hi", "lo", "vec_id"]).select("vec_id", "vector"), "index")
    asks = rows.where(queries).dropDuplicates(["vec_id", "hi", "lo"]).select("vec_id", "vector")
    square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    size = index.agg(F.count("*").alias("n"), F.max(square).alias("m")).first()
    if not size["n"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = index.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toPandas()
    forest = spark.sparkContext.broadcast(Forest(sample["vec_id"].to_numpy(np.int64), np.stack(sample["vector"].to_list()), size["n"], sqrt(size["m"]), k))
    schema = "leaf long, id long, own binary, bound double"
    placed = written(index.repartition("vec_id").mapInArrow(_placed(forest, False, kind), schema), "leaves")
    # one row per leaf, TREES * 2 ** DEPTH at most
    parts = F.broadcast(placed.groupBy("leaf").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts")))
    members = placed.join(parts, "leaf").select("leaf", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"), F.lit(0).alias("role"), "id", "own", "bound")
    visits = asks.repartition("vec_id").mapInArrow(_placed(forest, True, kind), schema).join(parts, "leaf")
    visits = visits.select("leaf", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(1).alias("role"), "id", "own", "bound")
    meet = members.unionByName(visits).repartition("leaf", "part").sortWithinPartitions("leaf", "part", "role")
    found = "query_id long, vec_id long, score double"
    near = meet.mapInArrow(_best(k, kind), found).union(asks.repartition("vec_id").mapInArrow(_of_sample(forest), found))
    scored = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
