"""N-gram Jaccard join with R-trees over count vectors.

A text's set is its distinct word 5-grams, as 50-bit hashes.  The hashes fall
into ``GROUPS`` groups; a set's counts by group are a point, and the summed
coordinate minima of two points bound the overlap of their sets.  R-trees over
these points find the pairs whose bound allows a link, by the counts of
``COARSE`` groups of groups first; the sets themselves decide.

One tree over all points prunes nothing: unrelated texts of equal length have
nearly equal boxes.  So the points are first dealt out to trees.  With all
grams in one global order, rare ones (by a sample) first, two sets that link
share a gram among the first ``n - ceil(0.8 n) + 1`` of each.  The smallest
node with such a gram is the gram's hub, and all nodes with grams of the same
hub share a tree; so every pair that links meets in a tree.  The order only
decides how full the trees are, never which pairs are found.

Equal sets are one node.  The trees are asked in rounds.  First each node gets
its partners with the best bounds; those that link are united, so a large
group of near copies becomes one component with few links a node.  Last, all
pairs between different components whose bound allows a link are verified.
That is all that components need; an exact join asks the trees once for all
pairs and lists every link.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskfold.llm.components import components
from riskfold.llm.tables import ROW, free_name, with_row_ids, written
from riskfold.llm.text import Numbers, pieces, starts_of, utf8, words_of

WIDTH = 5
PERCENT = 80
GROUPS = 1024
COARSE = 128
#: Documents whose grams are counted for the order of rarity, the grams kept (the most frequent),
#: and the count there from which a gram counts as hot: its nodes meet in a join that Spark splits.
SAMPLE_DOCS = 8192
ORDERED_GRAMS = 200_000
HOT = 8
#: Nodes in one task's tree at most; a fuller one is joined block by block.
BLOCK = 8192
LEAF = 16
#: Rounds in which each node is tried with its best partners, and how many.
BEST_ROUNDS = 2
BEST = 3
#: Text bytes that a task turns into grams and vectors at a time.
PIECE_BYTES = 4 << 20
#: Buckets of document ids that are broadcast, to leave out most texts before a shuffle.
ID_BUCKETS = 1 << 18

BITS = 50
_MASK = np.uint64((1 << BITS) - 1)
_P = np.uint64(0x9E3779B97F4A7C15)
_Q = np.uint64(0xD6E8FEB86659FD93)
_GROUP_SHIFT = np.uint64(BITS - (GROUPS.bit_length() - 1))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * _Q
    x ^= x >> np.uint64(29)
    x *= _P
    x ^= x >> np.uint64(32)
    return x


def gram_sets(texts: list[bytes], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """The distinct grams of each text, ascending, in a row, and their number a text.

    A text of fewer than ``width`` words is one gram; without words it has none.
    """
    flat, counts = words_of(texts)
    numbers = Numbers()
    index = np.fromiter(map(numbers.__getitem__, flat), dtype=np.int64, count=len(flat))
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in numbers), dtype=np.uint64, count=len(numbers))
    words = hashes[index] if len(flat) else hashes
    starts = starts_of(counts)
    text = np.repeat(np.arange(len(texts), dtype=np.uint64), counts)
    left = np.repeat(starts[1:], counts) - np.arange(len(flat))
    at = np.flatnonzero(left >= width)
    grams = np.full(len(at), np.uint64(width), dtype=np.uint64)
    for k in range(width):
        grams = grams * _P + words[at + k]
    keys = [(text[at] << np.uint64(BITS)) | (_mixed(grams) >> np.uint64(64 - BITS))]
    for n in range(1, width):  # short texts, by their number of words
        at = starts[:-1][counts == n]
        grams = np.full(len(at), np.uint64(n), dtype=np.uint64)
        for k in range(n):
            grams = grams * _P + words[at + k]
        keys.append((text[at] << np.uint64(BITS)) | (_mixed(grams) >> np.uint64(64 - BITS)))
    keys = np.unique(np.concatenate(keys))
    sizes = np.bincount((keys >> np.uint64(BITS)).astype(np.int64), minlength=len(texts)).astype(np.int64)
    return keys & _MASK, sizes


def prefix_length(n: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Two sets that link share a gram among so many first ones of each."""
    return np.where(n > 0, n - (percent * n + 99) // 100 + 1, 0)


def signatures(grams: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums that tell different sets apart."""
    starts = starts_of(sizes)
    out = []
    for salt in (_Q, _P):
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_mixed(grams ^ salt), dtype=np.uint64)))
        out.append((total[starts[1:]] - total[starts[:-1]]).view(np.int64))
    return out[0], out[1]


def count_vectors(grams: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    text = np.repeat(np.arange(len(sizes)), sizes)
    flat = np.bincount(text * GROUPS + (grams >> _GROUP_SHIFT).astype(np.int64), minlength=len(sizes) * GROUPS)
    return flat.reshape(-1, GROUPS)


_WIDTHS = {GROUPS: "u1", 2 * GROUPS: "<u2", 4 * GROUPS: "<u4"}


def _packed(vectors: np.ndarray) -> pa.Array:
    """Vectors as binaries, with one byte a count where that suffices, else two or four."""
    top = vectors.max(axis=1, initial=0)
    kinds = np.where(top < 1 << 8, "u1", np.where(top < 1 << 16, "<u2", "<u4"))
    return pa.array([v.astype(k).tobytes() for v, k in zip(vectors, kinds)], pa.binary())


def _unpacked(column: list[bytes]) -> np.ndarray:
    if all(len(b) == GROUPS for b in column):
        return np.frombuffer(b"".join(column), dtype="u1").reshape(-1, GROUPS)
    return np.array([np.frombuffer(b, dtype=_WIDTHS[len(b)]) for b in column], dtype=np.uint32)


def _coarse(vectors: np.ndarray) -> np.ndarray:
    """The counts of each group of groups."""
    out = vectors.reshape(len(vectors), COARSE, -1).sum(axis=2, dtype=np.uint32)
    return out.astype(np.uint16) if out.max(initial=0) < 1 << 16 else out


def _bounded(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum(a, b).sum(axis=-1, dtype=np.int64)


def allowed(overlap, size_a, size_b, percent: int = PERCENT):
    """Whether sets of these sizes and this overlap (or bound on it) link."""
    return 100 * overlap >= percent * (size_a + size_b - overlap)


class RTree:
    """Sort-tile packed R-tree: entries in order of their coordinate sum, so boxes are narrow in it."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.order = np.argsort(sizes, kind="stable")
        self.points, self.sizes = points[self.order], sizes[self.order]
        self.coarse = _coarse(self.points)
        self.levels = []  # from the leaves up: largest coarse coordinates, smallest and largest sum of each node
        high, low, top = self.coarse, self.sizes, self.sizes
        while True:
            cut = np.arange(0, len(high), LEAF)
            high, low, top = np.maximum.reduceat(high, cut), np.minimum.reduceat(low, cut), np.maximum.reduceat(top, cut)
            self.levels.append((high, low, top))
            if len(high) == 1:
                break

    def leaves(self, points: np.ndarray, low: int, top: int, percent: int) -> np.ndarray:
        """Leaves that may hold an entry that links with one inside the box (largest ``points``,
        sums from ``low`` to ``top``)."""
        nodes = np.zeros(1, dtype=np.int64)
        for high, lows, tops in reversed(self.levels):
            nodes = nodes[nodes < len(high)]
            near = (100 * tops[nodes] >= percent * low) & (100 * top >= percent * lows[nodes])
            nodes = nodes[near]
            bound = np.minimum(_bounded(high[nodes], points), np.minimum(tops[nodes], top))
            nodes = nodes[allowed(bound, lows[nodes], low, percent)]
            below = (nodes[:, None] * LEAF + np.arange(LEAF)).ravel()
            if high is self.levels[0][0]:
                return below[below < len(self.points)]
            nodes = below
        return nodes

    def pairs(self, percent: int = PERCENT, group: np.ndarray | None = None, side: np.ndarray | None = None,
              best: int | None = None):
        """Pairs of entries (as given) whose bound allows a link, in different ``group`` and,
        if ``side`` is given, on different sides.

        Each pair once; with ``best``, for each entry the so many partners with
        the highest bound on the similarity.
        """
        group = None if group is None else group[self.order]
        side = None if side is None else side[self.order]
        for at in range(0, len(self.points), LEAF):
            own = np.arange(at, min(at + LEAF, len(self.points)))
            other = self.leaves(self.levels[0][0][at // LEAF], self.sizes[own[0]], self.sizes[own[-1]], percent)
            if best is None:
                other = other[other >= at]
            found_a, found_b, found_s = [], [], []
            for part in (other[i:i + 512] for i in range(0, len(other), 512)):
                sizes_a, sizes_b = self.sizes[own][:, None], self.sizes[part][None, :]
                near = (100 * sizes_a >= percent * sizes_b) & (100 * sizes_b >= percent * sizes_a)
                near &= part[None, :] > own[:, None] if best is None else part[None, :] != own[:, None]
                if group is not None:
                    near &= group[own][:, None] != group[part][None, :]
                if side is not None:
                    near &= side[own][:, None] != side[part][None, :]
                i, j = np.nonzero(near)
                a, b = own[i], part[j]
                ok = allowed(_bounded(self.coarse[a], self.coarse[b]), self.sizes[a], self.sizes[b], percent)
                a, b = a[ok], b[ok]
                bound = _bounded(self.points[a], self.points[b])
                sizes = self.sizes[a] + self.sizes[b]
                ok = allowed(bound, sizes, 0, percent)
                found_a.append(a[ok])
                found_b.append(b[ok])
                found_s.append(bound[ok] / (sizes[ok] - bound[ok]))
            if not found_a:
                continue
            a, b, s = np.concatenate(found_a), np.concatenate(found_b), np.concatenate(found_s)
            if best is not None and len(a):
                by = np.lexsort((b, -s, a))
                a, b = a[by], b[by]
                first = np.searchsorted(a, a)  # a is in order: the first of each entry
                top = np.arange(len(a)) - first < best
                a, b = a[top], b[top]
            if len(a):
                yield self.order[a], self.order[b]


def _gram_order(docs: DataFrame, sample_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """The frequent grams of a sample of documents, ascending, and their counts there.

    Bounded by ``ORDERED_GRAMS``; it only orders the grams.
    """
    total = docs.count()
    some = docs.where(F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(max(1, total // sample_docs))) == 0).select("text")

    def run(batches):
        for batch in batches:
            for part in pieces(batch, 0, PIECE_BYTES):
                grams, _ = gram_sets(utf8(part.column(0), lower=True))
                yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64))], names=["gram"])

    found = some.mapInArrow(run, "gram long").groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = found.orderBy(F.col("n").desc(), "gram").limit(ORDERED_GRAMS).toPandas()
    grams = rows["gram"].to_numpy(np.uint64)
    order = np.argsort(grams)
    return grams[order], rows["n"].to_numpy(np.int64)[order]


SETS = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("n", T.LongType(), False),
    T.StructField("sig1", T.LongType(), False), T.StructField("sig2", T.LongType(), False),
    T.StructField("prefix", T.ArrayType(T.LongType(), False), False),
    T.StructField("hot", T.ArrayType(T.LongType(), False), False), T.StructField("vector", T.BinaryType(), False),
])
_LONGS = pa.list_(pa.field("element", pa.int64(), False))


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Ragged rows of 64-bit values as an array of lists."""
    return pa.LargeListArray.from_arrays(pa.array(starts_of(sizes)), pa.array(values.view(np.int64))).cast(_LONGS)


def _described(docs: DataFrame, order, percent: int) -> DataFrame:
    """``SETS`` of each document ``id, text``."""
    held = docs.sparkSession.sparkContext.broadcast(order)

    def run(batches):
        frequent, times = held.value
        for batch in batches:
            for part in pieces(batch, 1, PIECE_BYTES):
                grams, sizes = gram_sets(utf8(part.column(1), lower=True))
                sig1, sig2 = signatures(grams, sizes)
                vectors = _packed(count_vectors(grams, sizes))
                text, seen = np.repeat(np.arange(len(sizes)), sizes), np.zeros(len(grams), dtype=np.int64)
                if len(frequent):
                    at = np.minimum(np.searchsorted(frequent, grams), len(frequent) - 1)
                    seen = np.where(frequent[at] == grams, times[at], 0)
                    # within a text ascending grams stay so, behind those that are rarer
                    by = np.argsort(text * (int(times.max()) + 1) + seen, kind="stable")
                    grams, seen = grams[by], seen[by]
                most = prefix_length(sizes, percent)
                first = np.arange(len(grams)) - np.repeat(starts_of(sizes)[:-1], sizes) < np.repeat(most, sizes)
                rare, hot = first & (seen < HOT), first & (seen >= HOT)
                count = lambda which: np.bincount(text[which], minlength=len(sizes))  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(sizes), pa.array(sig1), pa.array(sig2),
                    _lists(grams[rare], count(rare)), _lists(grams[hot], count(hot)), vectors], names=SETS.names)

    return docs.mapInArrow(run, SETS)


def _different(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different pairs, in order."""
    by = np.lexsort((b, a))
    a, b = a[by], b[by]
    new = np.ones(len(a), dtype=bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[new], b[new]


def _bucket(column: str) -> F.Column:
    return F.pmod(F.xxhash64(column), F.lit(ID_BUCKETS))


def _without(rows: DataFrame, goes: DataFrame, key: str) -> DataFrame:
    """``rows`` without those whose ``key`` is in the written table ``goes``.

    The buckets of these keys, at most ``ID_BUCKETS`` of them, are broadcast:
    rows in no such bucket stay without a shuffle.
    """
    bucket = free_name(rows, "__bucket")
    buckets = F.broadcast(goes.select(_bucket(key).alias(bucket)).distinct())
    marked, columns = rows.withColumn(bucket, _bucket(key)), [F.col(f"`{c}`") for c in rows.columns]
    sure = marked.join(buckets, bucket, "left_anti").select(*columns)
    unsure = marked.join(buckets, bucket, "left_semi").join(goes.select(key), key, "left_anti").select(*columns)
    return sure.unionByName(unsure)


def _meetings(sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """``hub, __row``: each node with the smallest node of each gram that it shares with others.

    Rows that repeat another's set are left out.  Rare grams stream by in
    order, one row in memory.  A hot gram's hub is a minimum by
    gram, joined back, and Spark splits that join.
    """
    repeated = written(sets.where("n > 0").select(ROW).join(nodes.select(ROW), ROW, "left_anti"), "join-repeated")
    first = _without(sets.select(ROW, "prefix", "hot"), repeated, ROW)
    rare = first.select(F.explode("prefix").alias("gram"), ROW).repartition("gram").sortWithinPartitions("gram", ROW)

    def stream(batches):
        last, hub = None, None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            gram, row = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            new = np.concatenate(([gram[0] != last if last is not None else True], gram[1:] != gram[:-1]))
            at = np.maximum.accumulate(np.where(new, np.arange(len(gram)), -1))
            hubs = np.where(at >= 0, row[np.maximum(at, 0)], hub if hub is not None else -1)
            last, hub = gram[-1], hubs[-1]
            a, b = _different(hubs[~new], row[~new])
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["hub", ROW])

    often = first.select(F.explode("hot").alias("gram"), ROW)
    hubs = often.groupBy("gram").agg(F.min(ROW).alias("hub"), F.max(ROW).alias("top")).where("hub < top")
    met = rare.mapInArrow(stream, f"hub long, {ROW} long").unionByName(
        often.join(hubs, "gram").where(F.col(ROW) != F.col("hub")).select("hub", ROW)).distinct()
    met = written(met, "join-met")
    return met.unionByName(met.select("hub", F.col("hub").alias(ROW)).distinct())


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs whose sets link; the sets are made anew from the texts of both nodes."""
    ends = written(pairs.select(F.col("a").alias(ROW)).unionByName(pairs.select(F.col("b").alias(ROW))).distinct(), "join-ends")
    wanted = ends.join(nodes.select(ROW, "first_id", "sig1", "sig2"), ROW)
    buckets = wanted.select(_bucket("first_id").alias("bucket")).distinct()  # at most ID_BUCKETS rows
    near = docs.withColumn("bucket", _bucket("id")).join(F.broadcast(buckets), "bucket", "left_semi").drop("bucket")
    texts = near.join(wanted, near["id"].eqNullSafe(wanted["first_id"])).select(ROW, "sig1", "sig2", "text")

    def sets(batches):
        for batch in batches:
            for part in pieces(batch, 3, PIECE_BYTES):
                grams, sizes = gram_sets(utf8(part.column(3), lower=True))
                one, two = signatures(grams, sizes)  # rows may share an id with other texts
                same = (one == part.column(1).to_numpy()) & (two == part.column(2).to_numpy())
                kept = pa.RecordBatch.from_arrays([part.column(0), _lists(grams, sizes)], names=[ROW, "grams"])
                yield kept.filter(pa.array(same))

    schema = T.StructType([T.StructField(ROW, T.LongType()), T.StructField("grams", T.ArrayType(T.LongType(), False), False)])
    have = written(texts.mapInArrow(sets, schema).dropDuplicates([ROW]), "join-sets")
    both = pairs.join(have.select(F.col(ROW).alias("a"), F.col("grams").alias("ga")), "a").join(
        have.select(F.col(ROW).alias("b"), F.col("grams").alias("gb")), "b")

    def check(batches):
        for batch in batches:
            col = lambda n: batch.column(batch.schema.get_field_index(n))
            x, y = col("ga"), col("gb")
            xs, ys = np.asarray(x.offsets), np.asarray(y.offsets)
            xv, yv = np.asarray(x.values), np.asarray(y.values)
            ok = np.zeros(batch.num_rows, dtype=bool)
            for i in range(batch.num_rows):
                a, b = xv[xs[i]:xs[i + 1]], yv[ys[i]:ys[i + 1]]
                both = np.sort(np.concatenate((a, b)))
                ok[i] = allowed(int((both[1:] == both[:-1]).sum()), len(a), len(b), percent)
            keep = pa.array(ok)
            yield pa.RecordBatch.from_arrays([col("a").filter(keep), col("b").filter(keep)], names=["a", "b"])

    return both.mapInArrow(check, "a long, b long")


def _tree_pairs(members: DataFrame, nodes: DataFrame, vectors: DataFrame, percent: int, block: int, best: int | None) -> DataFrame:
    """``hub, a, b``: pairs in the same tree but different components whose bound allows a link.

    ``members``: ``hub, __row, root``.  Trees of one component only are left
    out.  A tree of more than ``block`` nodes is dealt out as pairs of blocks,
    within ``s = t`` all pairs, else those between the two blocks.  Blocks
    stream by in order; one is held.
    """
    trees = members.groupBy("hub").agg(
        F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("size")).where("lo < hi")
    blocks = F.ceil(F.col("size") / block).cast("int")
    rows = members.join(trees.select("hub", "size"), "hub").withColumn(
        "mine", F.pmod(F.xxhash64(ROW), blocks).cast("int")
    ).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1))).join(nodes.select(ROW, "n"), ROW).join(
        vectors, ROW
    ).select(
        "hub", F.least("mine", "other").alias("s"), F.greatest("mine", "other").alias("t"), "mine",
        F.col(ROW).alias("node"), "root", "n", "vector",
    )
    dealt = rows.repartition("hub", "s", "t").sortWithinPartitions("hub", "s", "t")

    def of(hub, s, t, mine, node, root, n, vector):
        tree, node = RTree(_unpacked(vector), np.array(n)), np.array(node)
        for a, b in tree.pairs(percent, np.array(root), np.array(mine) if s != t else None, best):
            x, y = _different(np.maximum(node[a], node[b]), np.minimum(node[a], node[b]))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), hub)), pa.array(x), pa.array(y)], names=["hub", "a", "b"])

    def run(batches):
        held, key = None, None
        for batch in batches:
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
            columns = [batch.column(i).to_pylist() for i in range(3, 8)]
            edges = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
            for lo, hi in zip(edges, edges[1:]):
                if lo == hi:
                    continue
                if keys[lo] != key:
                    if held is not None:
                        yield from of(*key, *held)
                    key, held = keys[lo], [[] for _ in columns]
                for h, c in zip(held, columns):
                    h.extend(c[lo:hi])
        if held is not None:
            yield from of(*key, *held)

    return dealt.mapInArrow(run, "hub long, a long, b long")


def join_sets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT,
    sample_docs: int = SAMPLE_DOCS, block: int = BLOCK, exact: bool = False,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``documents, nodes, links`` of the join.

    Documents: ``id, n, node`` for every row (null node: no words).  Nodes: one
    for each different set, ``__row, first_id`` (its smallest id) ``, n``.
    Links: ``a, b``, verified pairs of nodes that connect all nodes that link:
    pairs inside a component found so far are not listed again.  With
    ``exact`` they are all pairs of nodes that link, each once, so a group of
    m different near copies may give m (m - 1) / 2 of them.

    Null and empty texts and those without words have empty sets, which link
    with nothing.  Null ids come after all others.  Rows may repeat.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    order = _gram_order(docs, sample_docs)
    sets = with_row_ids(_described(docs, order, percent), "join-docs")
    nodes = written(sets.where("n > 0").groupBy("n", "sig1", "sig2").agg(
        F.min("id").alias("first_id"), F.min(ROW).alias(ROW)), "join-nodes")
    members = written(_meetings(sets, nodes), "join-members")
    vectors = sets.select(ROW, "vector")
    documents = sets.select("id", "n", "sig1", "sig2").join(
        nodes.select("n", "sig1", "sig2", F.col(ROW).alias("node")), ["n", "sig1", "sig2"], "left").select("id", "n", "node")
    if exact:
        rooted = members.withColumn("root", F.col(ROW))
        met = _tree_pairs(rooted, nodes, vectors, percent, block, None).select("a", "b").distinct()
        links = written(_verified(written(met, "join-pairs"), nodes, docs, percent), "join-links")
        return documents, nodes.select(ROW, "first_id", "n"), links
    links = tried = None
    for best in (*[BEST] * BEST_ROUNDS, None):
        if links is None:
            rooted = members.withColumn("root", F.col(ROW))
        else:
            roots = components(links)
            rooted = members.join(roots, members[ROW] == roots["node"], "left").select(
                "hub", ROW, F.coalesce("root", F.col(ROW)).alias("root"))
        met = written(_tree_pairs(rooted, nodes, vectors, percent, block, best), "join-trees")
        pairs = met.select("a", "b").distinct()
        pairs = written(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), "join-pairs")
        tried = pairs if tried is None else tried.unionByName(pairs)
        more = _verified(pairs, nodes, docs, percent)
        links = written(more if links is None else links.unionByName(more), "join-links")
        if best is not None:  # who has no partner in a tree now has none later
            members = written(met.select("hub", F.col("a").alias(ROW)).unionByName(
                met.select("hub", F.col("b").alias(ROW))).distinct(), "join-members")
    return documents, nodes.select(ROW, "first_id", "n"), links


def link_counts(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``nodes`` with ``n_links``, the number of other nodes that each links with; ``links`` are those of an exact join."""
    ends = links.select(F.explode(F.array("a", "b")).alias(ROW)).groupBy(ROW).agg(F.count(F.lit(1)).alias("n_links"))
    return nodes.join(ends, ROW, "left").withColumn("n_links", F.coalesce("n_links", F.lit(0)))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``id, n_shingles, component_id`` of every row: the smallest id that its links reach."""
    documents, nodes, links = join_sets(docs, id_col, text_col, **options)
    roots = components(links)
    rooted = nodes.join(roots, nodes[ROW] == roots["node"], "left").select(
        ROW, "first_id", F.coalesce("root", F.col(ROW)).alias("root"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_node = rooted.join(least, "root").select(F.col(ROW).alias("node"), "component_id")
    return documents.join(of_node, "node", "left").select(
        "id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each group of near copies: that with the smallest id, null last; all columns are kept.

    Rows are told apart by numbers of their own, so ids may be null or repeat.
    """
    row = free_name(docs, ROW)
    rows = with_row_ids(docs, "join-rows", row)
    groups = written(near_duplicates(rows, row, text_col, **options).select(F.col("id").alias(row), "component_id"), "join-groups")
    several = groups.groupBy("component_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("component_id")
    members = groups.join(several, "component_id").join(rows.select(row, F.col(id_col).alias("__id")), row)
    stays = members.groupBy("component_id").agg(F.min(F.struct(F.col("__id").isNull(), "__id", row))[row].alias("stays"))
    goes = written(members.join(stays, "component_id").where(F.col(row) != F.col("stays")).select(row), "join-goes")
    return _without(rows, goes, row).drop(row)
