"""Similarity join of documents on word shingles with adaptive multi-match prefixes.

1. Shingles that many documents hold are counted over all documents; sets are ordered from rare to
   common shingles, so that passages shared by many documents stay out of the prefixes.
2. Equal sets are one node. Of a set of n shingles whose partners share at least a = ceil(t * n),
   the l-prefix is the first n - a + l in that order. Two sets that reach t share l shingles of
   their l-prefixes, for every l up to a: each document takes the l of least estimated cost (rows of
   postings read plus pairs left to verify) and its pairs need l common prefix shingles, and as many
   more as the pair's own overlap exceeds a.
3. Members of a posting list are first verified against its most central member, if they share a
   quarter of their prefix with it through such lists. What that joins needs no further pair: only pairs of different components are generated from the lists after it.
   So the links found join the same documents as all links would, while a group of m near copies
   costs m pairs a list and not m * m. Lists of shingles known to be very common are cut into parts with centres of their own.
   Parity bitmaps of the sets bound their overlap, and what cannot reach t is not paired.
4. Pairs are verified by the exact overlap of their whole shingle sets.

Equal sets are told apart from others by 64 bits of a hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from inkwright.llm.components import connected_components, merged_components
from inkwright.llm.store import small_batches, trimmed, written
from inkwright.llm.words import text_shingles

#: Shingles whose counts order the prefixes: the most common ones, in at most this many entries.
COMMON = 500_000
#: Greatest number of common prefix shingles that a pair may be asked for.
LEVELS = 6
#: Cost of verifying a pair, in rows of postings read; partners that a shingle which isn't common is taken to bring.
VERIFY_COST, RARE_PARTNERS = 20.0, 0.2
#: Pairs of one centre in a task; members of a posting list in a part of it; rows of equal sets that meet their class by a broadcast
#: of at most HOT_SETS such classes, as a class is that large only if it holds that share of all rows too.
GROUP, SPLIT, HOT_ROWS, HOT_SETS = 1000, 10_000, 1000, 1000
#: Members of a posting list up to which they meet without bitmaps.
SHORT = 16
#: Candidate documents up to which their ids are broadcast (20 MB); beyond it the join shuffles.
BROADCAST_IDS = 250_000
_CHUNK = 4_000_000
#: Columns of the parity bitmap of a set: each shingle flips one of 1,024 bits, so that sets differ by at least as many
#: shingles as bitmaps do by bits.
BITS = tuple(f"b{i}" for i in range(16))


def _repeated(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(value, times) of the values that h holds more than once; h is sorted in place."""
    h.sort()
    edges = np.flatnonzero(np.diff(h[1:] == h[:-1], prepend=False, append=False))
    return h[edges[::2]], edges[1::2] - edges[::2] + 1


def _common_counts(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(h: np.ndarray) -> pa.RecordBatch:
            h, n = _repeated(h)
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["h", "n"])

        some, held = np.empty(_CHUNK, np.uint64), 0
        for batch in batches:
            for s in text_shingles(batch.column(0), k):
                if held + len(s) > len(some):
                    some.resize(held + len(s), refcheck=False)
                some[held : held + len(s)] = s
                held += len(s)
                if held > _CHUNK:
                    yield counted(some[:held])
                    held = 0
        if held:
            yield counted(some[:held])

    return run


def common_shingles(texts: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (ascending) and document counts of the most common shingles of the one column of texts.

    Tasks count all their documents and leave out shingles they saw once.
    """
    counts = texts.mapInArrow(trimmed(_common_counts(k)), "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where("n >= 4")
    rows = counts.orderBy(F.desc("n"), "h").limit(COMMON).toArrow()
    h = rows["h"].to_numpy().view(np.uint64)
    order = np.argsort(h)
    return h[order], rows["n"].to_numpy()[order]


def _prefix(s: np.ndarray, common, num: int, den: int) -> tuple[np.ndarray, int, int]:
    """The longest prefix of a set of shingles, the level of least cost and how eccentric the set is, 0 to 255."""
    hashes, counts, near = common
    n = len(s)
    need = -(-num * n // den)
    top = min(LEVELS, need)
    light, heavy, seen = s, s[:0], counts[:0]
    maybe = np.flatnonzero(near[(s >> np.uint64(41)).astype(np.int64)])
    if len(maybe):
        at = np.searchsorted(hashes, s[maybe])
        at[at == len(hashes)] = 0
        hit = hashes[at] == s[maybe]
        if hit.any():
            heavy, seen = s[maybe[hit]], counts[at[hit]]
            order = np.lexsort((heavy, seen))
            heavy, seen = heavy[order], seen[order]
            rest = np.ones(n, bool)
            rest[maybe[hit]] = False
            light = s[rest]
    size = n - need + top
    tokens = np.concatenate([light[:size], heavy[: max(0, size - len(light))]])
    cost, level = None, 1
    for l in range(1, top + 1):
        at = n - need + l
        rows = float(seen[: max(0, at - len(light))].sum()) + RARE_PARTNERS * min(len(light), at)
        here = rows + VERIFY_COST * (rows / l)
        if cost is None or here < cost:
            cost, level = here, l
    return tokens, level, int(255 * min(len(light), size) // size)


def _hash(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes())


def _sets(k: int, num: int, den: int, common):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts = common.value
        near = np.zeros(1 << 23, bool)
        near[(hashes >> np.uint64(41)).astype(np.int64)] = True
        width = 64 * len(BITS)
        for batch in batches:
            n, node, meta, tokens, sizes, bits = [], [], [], [], [0], []
            for s in text_shingles(batch.column(1), k):
                n.append(len(s))
                odd = np.bincount((s >> np.uint64(16) & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
                bits.append(np.packbits(odd.astype(np.uint8)).view("<i8"))
                if len(s):
                    prefix, level, far = _prefix(s, (hashes, counts, near), num, den)
                    node.append(_hash(s))
                    meta.append(far << 44 | len(s) << 8 | level << 4)
                    tokens.append(prefix)
                else:
                    node.append(0)
                    meta.append(0)
                    prefix = s
                sizes.append(sizes[-1] + len(prefix))
            flat = np.concatenate(tokens).view(np.int64) if tokens else np.empty(0, np.int64)
            words = np.array(bits, np.int64).reshape(-1, len(BITS))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(np.array(n, np.int64)),
                    pa.array(np.array(node, np.uint64).view(np.int64)),
                    pa.array(np.array(meta, np.int64)),
                    pa.ListArray.from_arrays(pa.array(np.array(sizes, np.int32)), pa.array(flat)),
                    *(pa.array(words[:, i]) for i in range(len(BITS))),
                ],
                ["doc_id", "text_hash", "n", "node", "meta", "tokens", *BITS],
            )

    return run


def _arrays(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(text_shingles(batch.column(0), k))
            ends = np.cumsum([0, *map(len, sets)], dtype=np.int32)
            flat = np.concatenate(sets).view(np.int64) if sets else np.empty(0, np.int64)
            nodes = np.array([_hash(s) if len(s) else 0 for s in sets], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["node", "shingles"])

    return run


def _reaches(s: np.ndarray, c: np.ndarray, num: int, den: int) -> bool:
    at = np.searchsorted(c, s)
    at[at == len(c)] = 0
    both = int((c[at] == s).sum())
    return den * both >= num * (len(s) + len(c) - both)


def _verified(num: int, den: int):
    """Rows sorted by centre and salt, the centre's own sets first: its members that reach num / den with one of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, centres = None, []
        for batch in batches:
            a, b = [], []
            flat = batch.column(4)
            ends, values = flat.offsets.to_numpy(), flat.values.to_numpy(zero_copy_only=False).view(np.uint64)
            heads, salts, roles, ids = (batch.column(i).to_numpy() for i in range(4))
            for i in range(len(ids)):
                s = values[ends[i] : ends[i + 1]]
                if roles[i] == 0:
                    if key != (heads[i], salts[i]):
                        key, centres = (heads[i], salts[i]), []
                    if not any(np.array_equal(s, c) for c in centres):
                        centres.append(s.copy())
                elif key == (heads[i], salts[i]) and any(_reaches(s, c, num, den) for c in centres):
                    a.append(ids[i])
                    b.append(heads[i])
            yield pa.RecordBatch.from_arrays([pa.array(np.array(a, np.int64)), pa.array(np.array(b, np.int64))], ["a", "b"])

    return run


def verify_pairs(pairs: DataFrame, arrays: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) of nodes whose whole sets reach num / den. Each set is sent once for a, once per GROUP of its pairs for b."""
    per = pairs.groupBy("b").agg(F.ceil(F.count("*") / GROUP).cast("long").alias("salts"))
    members = pairs.join(per, "b").select(
        F.col("b").alias("head"), F.pmod(F.xxhash64("a"), "salts").alias("salt"), F.lit(1).alias("role"), F.col("a").alias("node")
    )
    heads = per.select(
        F.col("b").alias("head"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("role"), F.col("b").alias("node")
    )
    rows = members.unionByName(heads).join(arrays, "node").select("head", "salt", "role", "node", "shingles")
    rows = rows.repartition("head", "salt").sortWithinPartitions("head", "salt", "role")
    return rows.mapInArrow(trimmed(_verified(num, den)), "a long, b long")


def _size(meta: Column) -> Column:
    return F.shiftright(meta, 8).bitwiseAND(F.lit(2**36 - 1))


def _up(x: Column, y: int) -> Column:
    return -F.floor(-x / y)


class _Join:
    """The tables of one join of docs(doc_id, text): sets of rows, nodes and posting lists."""

    def __init__(self, docs: DataFrame, k: int, num: int, den: int):
        spark = docs.sparkSession
        small_batches(spark)
        self.docs, self.k, self.num, self.den = docs, k, num, den
        hashes, counts = common_shingles(docs.select("text"), k)
        common = spark.sparkContext.broadcast((hashes, counts))
        schema = "doc_id long, text_hash long, n long, node long, meta long, tokens array<long>, " + ", ".join(f"{b} long" for b in BITS)
        rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
        self.sets = written(rows.mapInArrow(trimmed(_sets(k, num, den, common)), schema), "sets")
        grouped = self.sets.where("n > 0 and doc_id is not null").groupBy("node")
        self.nodes = written(grouped.agg(F.min("doc_id").alias("id"), F.count("*").alias("rows")), "nodes")
        # the tokens of equal sets are equal
        posts = grouped.agg(F.any_value("meta").alias("meta"), F.any_value("tokens").alias("tokens"))
        posts = posts.select("node", "meta", F.posexplode("tokens").alias("at", "tok"))
        many = counts >= SPLIT
        posts = posts.withColumn("part", F.lit(None).cast("int"))
        self.cut = bool(many.any())
        if self.cut:  # at most COMMON rows
            hot = spark.createDataFrame(list(zip(hashes[many].view(np.int64).tolist(), (-(-counts[many] // SPLIT)).tolist(), strict=True)), "tok long, parts long")
            posts = posts.join(F.broadcast(hot), "tok", "left").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        by = Window.partitionBy("tok", "part")
        far = F.shiftright("meta", 44)
        posts = posts.withColumn("c", F.min(F.struct(far.alias("far"), F.col("node").alias("node"), _size(F.col("meta")).alias("n"))).over(by))
        posts = posts.withColumn("m", F.count("*").over(by)).where("m > 1 or part is not null")
        self.posts = written(posts.select("tok", "part", "at", "node", "meta", "c"), "posts")

    def texts_of(self, wanted: DataFrame) -> DataFrame:
        """The texts of the wanted (node): of each its least id's, which may have others besides."""
        ids = written(wanted.join(self.nodes.select("node", F.col("id").alias("doc_id")), "node").select("doc_id").distinct(), "ids")
        ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids.hint("shuffle_hash")
        return self.docs.where("doc_id is not null").join(ids, "doc_id", "left_semi").select("text")

    def verified(self, pairs: DataFrame) -> DataFrame:
        pairs = written(pairs, "pairs")
        texts = self.texts_of(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct())
        return written(verify_pairs(pairs, texts.mapInArrow(trimmed(_arrays(self.k)), "node long, shingles array<long>"), self.num, self.den), "links")

    def stars(self) -> DataFrame:
        """Pairs of a posting list's members and its centre that share a quarter of the member's prefix.

        Most of a prefix is common with the centre; what this passes over is left to the pairs between components.
        """
        n, num, den = _size(F.col("meta")), self.num, self.den
        close = F.least(n, F.col("c.n")) * den >= F.greatest(n, F.col("c.n")) * num
        own = self.posts.where("node <> c.node").where(close).groupBy(F.col("node").alias("a"), F.col("c.node").alias("b"))
        own = own.agg(F.count("*").alias("m"), F.max("meta").alias("meta"))
        own = own.where(F.col("m") * 4 > _size(F.col("meta")) - _up(_size(F.col("meta")) * num, den)).select("a", "b")
        if not self.cut:
            return own
        # one row for each part of a list that was cut
        heads = self.posts.where("part is not null").select("tok", "c").distinct()
        heads = heads.join(heads.groupBy("tok").agg(F.min("c").alias("top")), "tok").where("c.node <> top.node")
        return own.union(heads.select("c.node", "top.node")).distinct()

    def pairs(self, parts: DataFrame | None) -> DataFrame:
        """Candidate pairs (a, b) of nodes, a the smaller set; with parts(node, component) only those between components.

        Lists of more than SHORT members meet with bitmaps of their sets; shorter ones have at most SHORT rows for each of theirs without.
        """
        posts = self.posts.select("tok", "at", "node", "meta")
        if parts is not None:
            posts = posts.join(parts.withColumnRenamed("component", "own"), "node", "left").withColumn("own", F.coalesce("own", "node"))
        else:
            posts = posts.withColumn("own", F.col("node"))
        mixed = posts.groupBy("tok").agg(F.min("own").alias("lo"), F.max("own").alias("hi"), F.count("*").alias("m")).where("lo <> hi")
        posts = written(posts.join(mixed.select("tok", (F.col("m") > SHORT).alias("long")), "tok"), "mixed")
        listed = posts.where("long")
        bits = self.sets.select("node", *BITS).join(listed.select("node").distinct(), "node", "left_semi")
        listed = listed.join(bits.groupBy("node").agg(*(F.any_value(b).alias(b) for b in BITS)), "node")
        found = self._common(posts.where("not long"), ()).unionByName(self._common(listed, BITS))
        return found.groupBy("a", "b", "shared").agg(F.sum("m").alias("m")).where(F.col("m") >= F.col("shared")).select("a", "b")

    def _common(self, posts: DataFrame, bits: tuple[str, ...]) -> DataFrame:
        """(a, b, shared, m): the m prefix shingles that a and b have in common in posts, and how many they need in all."""
        num, den = self.num, self.den
        x, y = (posts.select("tok", *(F.col(c).alias(c + side) for c in ("at", "node", "meta", "own", *bits))) for side in "ab")
        n_a, n_b, level = _size(F.col("metaa")), _size(F.col("metab")), F.shiftright("metaa", 4).bitwiseAND(F.lit(15))
        # a is the smaller set, so the pair needs this much of it; fewer common shingles than `shared` up to where one of
        # both l-prefixes ends, and what follows cannot make up the overlap that the sizes ask for
        both = _up((n_a + n_b) * num, num + den)
        need_a, need_b = _up(n_a * 2 * num, num + den), _up(n_b * num, den)
        found = (
            x.join(y, "tok")
            .where((F.col("owna") != F.col("ownb")) & (F.struct(n_a, "nodea") < F.struct(n_b, "nodeb")))
            .where((n_a * den >= n_b * num) & (F.col("ata") < n_a - need_a + level) & (F.col("atb") < n_b - need_b + level))
        )
        if bits:
            differ = sum((F.bit_count(F.col(b + "a").bitwiseXOR(F.col(b + "b"))) for b in bits), F.lit(0))
            found = found.where(differ <= n_a + n_b - 2 * both)
        shared = (level + both - F.greatest(need_a, need_b)).alias("shared")
        return found.groupBy(F.col("nodea").alias("a"), F.col("nodeb").alias("b"), shared).agg(F.count("*").alias("m"))


def _joined(docs: DataFrame, k: int, num: int, den: int, doc_id: str, text: str) -> _Join:
    return _Join(docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text")), k, num, den)


def with_class(sets: DataFrame, classes: DataFrame) -> DataFrame:
    """sets with the columns that classes(node, rows, ...) has for their node, null where it has none.

    Classes of many rows meet theirs by a broadcast: there are at most HOT_SETS, as each has a HOT_SETS-th of all rows. Their rows
    and those without shingles are dealt out by other hashes in the join with the rest.
    """
    least = max(HOT_ROWS, -(-sets.count() // HOT_SETS))
    classes, more = written(classes, "classes"), [c for c in classes.columns if c not in ("node", "rows")]
    named = lambda rows, to: rows.select(F.col("node").alias(f"{to}_node"), *(F.col(c).alias(f"{to}_{c}") for c in more))
    hot, cold = F.broadcast(named(classes.where(F.col("rows") >= least), "hot")), named(classes.where(F.col("rows") < least), "cold")
    out = sets.join(hot, (F.col("n") > 0) & (F.col("node") == F.col("hot_node")), "left")
    placed = (F.col("n") == 0) | F.col("hot_node").isNotNull()
    out = out.withColumn("key", F.when(placed, F.xxhash64("doc_id", "text_hash")).otherwise(F.col("node")))
    out = out.join(cold, F.col("key") == F.col("cold_node"), "left")
    of = lambda c: F.when(F.col("n") > 0, F.when(F.col("hot_node").isNotNull(), F.col(f"hot_{c}")).otherwise(F.col(f"cold_{c}")))
    return out.select(*sets.columns, *(of(c).alias(c) for c in more))


def class_of_rows(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_hash, n, node, class, component_id) for each row of docs.

    text_hash is xxhash64 of the text. class, a number of the row's class, and component_id, the least doc_id in it,
    are null where jaccard_components says that a row has no links.
    """
    own = _joined(docs, k, num, den, doc_id, text)
    parts = connected_components(own.verified(own.stars()))
    parts = merged_components(parts, own.verified(own.pairs(parts)))
    ids = written(own.nodes.join(parts, "node", "left").withColumn("class", F.coalesce("component", "node")), "members")
    least = ids.groupBy("class").agg(F.min("id").alias("component_id"))
    rows = with_class(own.sets.select("doc_id", "text_hash", "n", "node"), ids.join(least, "class").select("node", "rows", "class", "component_id"))
    return rows.withColumns({c: F.when(F.col("doc_id").isNotNull(), F.col(c)) for c in ("class", "component_id")})


def jaccard_components(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of docs: links are pairs of rows with Jaccard >= num / den.

    Shingles are k words; a text of fewer words is one shingle. Null and empty texts, and texts of
    white space, have no shingles and no links. Rows with a null id have no links and a null
    component. Equal rows come back each; rows of one id are documents of their own, each with its text's component: the
    least id that links reach. Other columns, whatever their names, are not read. An empty table gives no rows.
    """
    rows = class_of_rows(docs, k, num, den, doc_id, text)
    return rows.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def components_sql(k: int, num: int, den: int) -> str:
    """jaccard_components over the table documents, whose doc_ids are unique, in DuckDB's SQL: all pairs that share a shingle."""
    words = " || ' ' || ".join(f"ws[i + {j}]" for j in range(k))
    return f"""with recursive words as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as ws from documents),
    shingles as (select distinct doc_id, unnest(case when len(ws) >= {k} then list_transform(range(1, len(ws) - {k} + 2), lambda i: {words}) when len(ws) > 0 then [array_to_string(ws, ' ')] else [] end) as s from words),
    sizes as (select doc_id, count(*) as n from shingles group by doc_id), sized as (select * from shingles join sizes using (doc_id)),
    links as (select a.doc_id as a, b.doc_id as b from sized a join sized b on a.s = b.s and a.doc_id < b.doc_id and least(a.n, b.n) * {den} >= greatest(a.n, b.n) * {num}
      group by a.doc_id, b.doc_id, a.n, b.n having {den} * count(*) >= {num} * (a.n + b.n - count(*))),
    steps as (select a, b from links union all select b, a from links), reach as (select a, b from steps union select reach.a, steps.b from reach join steps on steps.a = reach.b),
    least_ as (select a as doc_id, min(b) as other from reach group by a)
    select doc_id, coalesce(n, 0)::bigint as n_shingles, least(doc_id, coalesce(other, doc_id)) as component_id from words left join sizes using (doc_id) left join least_ using (doc_id)"""


def jaccard_links(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(links, members) by the multi-match join of all pairs: every link between different sets, not just those that join components.

    links(a, b): nodes, each pair once. members(doc_id, n_shingles, node, n_links) for each row of docs: its set's node (null without
    shingles or doc_id) and the number of other rows that it links with, rows of its own set included. A group of m
    sets that all link has m * (m - 1) / 2 links, so this is for tables whose groups of different texts are small.
    """
    own = _joined(docs, k, num, den, doc_id, text)
    links = own.verified(own.pairs(None)).distinct()
    rows = own.nodes.select("node", "rows")
    both = links.union(links.select("b", "a")).toDF("node", "other")
    more = both.join(rows.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.sum("rows").alias("more"))
    classes = rows.join(more, "node", "left").select("node", "rows", (F.col("rows") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"))
    members = with_class(own.sets.select("doc_id", "text_hash", "n", "node"), classes)
    linked = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    return links, members.select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(linked, F.col("node")).alias("node"), F.when(linked, F.col("n_links")).otherwise(F.lit(0)).cast("long").alias("n_links")
    )
