"""Prefix trie of conversations, with subtree totals by parallel tree contraction.

1. The turns are numbered within each conversation over ranges of the global
   order, so a conversation of very many turns is shared by tasks.  Each turn
   becomes a digest of role and text, and its text's bytes.
2. Each prefix gets a 127-bit rolling hash.  Such hashes compose, so a
   conversation that goes on in the next range takes one row over: the turns
   and the hash it came with.  Equal hashes of one depth are a node of the trie.
3. Subtree totals.  In rounds, *rake* takes the leaves off and adds them to
   their parents, and *compress* takes whole chains of nodes with one child
   out by pointer doubling: each keeps its sum down to the chain's end.  A
   trie of any depth is gone after a number of rounds and steps that grows
   with the logarithm of its size.
4. The contracted nodes come back in the reverse order of the rounds: a chain
   node's total is its kept sum and the total of its chain's end.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskfold.llm.tables import PART, shuffle_width, written

#: The rolling hash: ``h * BASE + digest`` modulo a prime below 2**127, from ``SEED`` on.
PRIME = 2**127 - 1
BASE = 0x5A17C3E9B4D2F08167AE35D19C84F26B
SEED = 1
#: Conversations whose numbers leave the same quotient by this share their first turns.
FAMILY = 5
MOST_SHARED = 9
#: Ids that one row of a member list holds.
CHUNK = 4096


def _bytes(h: int) -> bytes:
    return h.to_bytes(16, "big")


ROOT = _bytes(SEED)


def _ranged(df: DataFrame, order: list[Column], label: str) -> DataFrame:
    """``df`` dealt out by ranges of ``order`` and written, each row with its range ``PART``."""
    n = shuffle_width(df.sparkSession)
    return written(df.repartitionByRange(n, *order).withColumn(PART, F.spark_partition_id()), label)


def numbered(turns: DataFrame, conv: str, order: list[str], label: str) -> DataFrame:
    """``turns`` with ``no``: the place within its conversation, from 0.

    A window spans a conversation's rows of one range only.  A conversation in
    several ranges is the last of one and the first of the next ones, so the
    rows it has in earlier ranges are two numbers a range at most.
    """
    keys = [F.col(conv), *[F.col(c).asc_nulls_first() for c in order]]
    # repeated rows can be told apart by nothing else, and may be many
    rows = turns.withColumn("__tie", F.monotonically_increasing_id())
    ranged = _ranged(rows, [*keys, F.col("__tie")], label)
    edges = ranged.groupBy(PART).agg(F.min(conv).alias("lo"), F.max(conv).alias("hi"))
    at_edge = ranged.join(F.broadcast(edges), PART).where((F.col(conv) == F.col("lo")) | (F.col(conv) == F.col("hi")))
    each = at_edge.groupBy(PART, conv).agg(F.count(F.lit(1)).alias("n"))  # two rows a range at most
    earlier = Window.partitionBy(conv).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    before = each.select(PART, conv, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy(PART, conv).orderBy(*keys[1:], "__tie")
    return ranged.join(F.broadcast(before), [PART, conv], "left").select(
        *turns.columns, (F.row_number().over(within) - 1 + F.coalesce("before", F.lit(0))).alias("no"))


def shared_turns(conv: Column) -> Column:
    """How many turns a conversation takes from the first one of its family, at most."""
    return F.crc32(conv.cast("string").cast("binary")) % MOST_SHARED


def rebuilt(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``conv, part, no, digest, bytes`` of every turn of the rebuilt conversations, and all conversation ids.

    A conversation is the first turns of its family's first conversation
    (``part`` 0), then its own further turns (``part`` 1).
    """
    rows = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    said = F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    own = written(numbered(rows, "conv", ["turn", "role", "text"], "trie-turns").select(
        "conv", "no", F.unhex(F.sha2(said.cast("binary"), 256)).alias("digest"), F.octet_length("text").cast("long").alias("bytes"),
    ), "trie-digests")
    convs = written(own.select("conv").distinct(), "trie-conversations")
    family = convs.select("conv", (F.col("conv") - F.col("conv") % FAMILY).alias("of"))
    # few rows of one conversation, for the few of one family
    first = own.where((F.col("no") < MOST_SHARED) & (F.col("conv") % FAMILY == 0)).withColumnRenamed("conv", "of")
    shared = first.join(family, "of").where(F.col("no") < shared_turns(F.col("conv")))
    columns = ["conv", "no", "digest", "bytes"]
    both = shared.select(F.lit(0).alias("part"), *columns).unionByName(
        own.where(F.col("no") >= shared_turns(F.col("conv"))).select(F.lit(1).alias("part"), *columns))
    return both, convs


_LOCAL = T.StructType([
    T.StructField(PART, T.IntegerType(), False), T.StructField("conv", T.LongType(), False),
    T.StructField("place", T.LongType(), False), T.StructField("hash", T.BinaryType(), False),
    T.StructField("before", T.BinaryType(), False), T.StructField("bytes", T.LongType(), False),
    T.StructField("open", T.BooleanType(), False), T.StructField("last", T.BooleanType()),
])


def prefixes(turns: DataFrame) -> DataFrame:
    """``conv, depth, hash, parent, bytes, last`` of every prefix of conversations ``conv, part, no, digest, bytes``.

    ``hash`` of the first ``depth`` turns, ``parent`` of one turn less;
    ``last``: the conversation has no further turn.
    """
    order = ["conv", "part", "no"]
    ranged = turns.repartitionByRange(shuffle_width(turns.sparkSession), *order).sortWithinPartitions(*order)

    def local(batches):
        """Hashes within a range; ``open``: the range's first conversation, which an earlier range may have begun."""
        part, conv, place = TaskContext.get().partitionId(), None, 0
        held: list | None = None  # a row whose `last` is not known before the next one

        for batch in batches:
            out: list[list] = [[] for _ in _LOCAL]

            def put(row):
                for column, value in zip(out, row):
                    column.append(value)

            for c, digest, size in zip(*(batch.column(n).to_pylist() for n in ("conv", "digest", "bytes"))):
                if held is None:
                    conv, opened, h, place = c, True, 0, 0
                else:
                    put([*held, c != conv])
                    if c != conv:
                        conv, opened, h, place = c, False, SEED, 0
                before, place = h, place + 1
                h = (h * BASE + int.from_bytes(digest, "big")) % PRIME
                held = [part, c, place, _bytes(h), _bytes(before), size, opened]
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, _ARROW)], names=_LOCAL.names)
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip([*held, None], _ARROW)], names=_LOCAL.names)

    rows = written(ranged.mapInArrow(local, _LOCAL), "trie-hashes")
    # two rows a range: how its first conversation stands at its end there, and the range's last row
    ends = rows.groupBy(PART).agg(
        F.max(F.when(F.col("open"), F.struct("place", "conv", "hash"))).alias("first"),
        F.max(F.when(F.col("last").isNull(), F.struct("conv", "place", "hash", "open"))).alias("end")).orderBy(PART).collect()
    carry: dict[int, tuple[int, int, bool]] = {}
    conv, count, state = None, 0, SEED
    for r, following in zip(ends, [*ends[1:], None]):
        begins = r["first"]["conv"]
        came = (count, state) if begins == conv else (0, SEED)
        carry[r[PART]] = (*came, following is None or following["first"]["conv"] != r["end"]["conv"])
        conv, count, state = r["end"]["conv"], r["end"]["place"], int.from_bytes(r["end"]["hash"], "big")
        if r["end"]["open"]:
            count, state = came[0] + count, (came[1] * pow(BASE, count, PRIME) + state) % PRIME
    held = turns.sparkSession.sparkContext.broadcast(carry)  # a row a range
    schema = T.StructType([
        T.StructField("conv", T.LongType(), False), T.StructField("depth", T.LongType(), False),
        T.StructField("hash", T.BinaryType(), False), T.StructField("parent", T.BinaryType(), False),
        T.StructField("bytes", T.LongType(), False), T.StructField("last", T.BooleanType(), False),
    ])

    def whole(batches):
        part, at, power, count, state, ends = None, 0, 1, 0, SEED, False
        for batch in batches:
            p, c, place, h, before, size, opened, last = (x.to_pylist() for x in batch.columns)
            depth = []
            for i, (own, n) in enumerate(zip(opened, place)):
                if p[i] != part:
                    part, at, power = p[i], 0, 1
                    count, state, ends = held.value[part]
                if own:  # BASE to the number of the turns before, a step a turn where the rows come in order
                    power = power if n - 1 == at else power * BASE % PRIME if n - 2 == at else pow(BASE, n - 1, PRIME)
                    at = n - 1
                    h[i] = _bytes((state * power * BASE + int.from_bytes(h[i], "big")) % PRIME)
                    before[i] = _bytes((state * power + int.from_bytes(before[i], "big")) % PRIME)
                    n += count
                depth.append(n)
                if last[i] is None:
                    last[i] = ends
            columns = [c, depth, h, before, size, last]
            types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, types)], names=schema.names)

    return written(rows.mapInArrow(whole, schema), "trie-prefixes")


_ARROW = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.bool_(), pa.bool_()]


def member_digests(members: DataFrame) -> DataFrame:
    """``key, ends_sha256`` of ``key, conv``: the digest of each key's conversation ids, ascending, comma-joined.

    Ranges of (key, conversation) make strings of up to ``CHUNK`` ids, which
    then go to one task a key in order: it feeds them to the digest and keeps
    its state, never the list.  A digest is one sequence, so a key's chunks
    are the one thing here that cannot be shared.
    """
    order = ["key", "conv"]
    ranged = members.repartitionByRange(shuffle_width(members.sparkSession), *order).sortWithinPartitions(*order)

    def chunks(batches):
        key, ids = None, []
        for batch in batches:
            out = []
            for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if ids and (k != key or len(ids) == CHUNK):
                    out.append((key, ids[0], ",".join(map(str, ids))))
                    ids = []
                key = k
                ids.append(c)
            if out:
                yield _batch(out)
        if ids:
            yield _batch([(key, ids[0], ",".join(map(str, ids)))])

    def _batch(rows):
        key, first, text = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(key, pa.binary()), pa.array(first, pa.int64()), pa.array(text, pa.string())], names=["key", "first", "text"])

    def digests(batches):
        key, state, n = None, None, 0
        names = ["key", "ends_sha256"]
        for batch in batches:
            done = []
            for k, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if k != key:
                    if key is not None:
                        done.append((key, state.hexdigest()))
                    key, state, n = k, hashlib.sha256(), 0
                state.update(("," + text if n else text).encode())
                n += 1
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in zip(*done)], names=names)
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], names=names)

    strings = ranged.select(*order).mapInArrow(chunks, "key binary, first long, text string")
    dealt = strings.repartition("key").sortWithinPartitions("key", "first")
    return dealt.mapInArrow(digests, "key binary, ends_sha256 string")


def subtree_sums(nodes: DataFrame, values: list[str]) -> DataFrame:
    """``key`` and, for each of ``values``, its sum over the node and all nodes below it.

    ``nodes``: ``key, parent`` (null for a root) and the values.  Rake and
    compress alternate until no node is left; then compressed nodes come back,
    the latest round first.
    """
    extra = [f"__x_{v}" for v in values]  # what an edge carries of chain nodes taken out of it
    sums = lambda names: [F.sum(n).alias(n) for n in names]
    children = nodes.groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    state = written(nodes.join(children, "key", "left").select(
        "key", "parent", *values, *[F.lit(0).cast("long").alias(x) for x in extra], F.coalesce("n", F.lit(0)).alias("n")), "trie-state")
    done: DataFrame | None = None  # totals of raked nodes
    chains: list[DataFrame] = []  # a round's compressed nodes: key, end of the chain, kept sums
    while True:
        leaves = state.where("n = 0")
        raked = leaves.select("key", *values)
        done = raked if done is None else done.unionByName(raked)
        given = leaves.groupBy(F.col("parent").alias("key")).agg(
            F.count(F.lit(1)).alias("gone"), *[F.sum(F.col(v) + F.col(x)).alias(f"__g_{v}") for v, x in zip(values, extra)])
        rest = written(state.where("n > 0").join(given, "key", "left").select(
            "key", "parent", *[(F.col(v) + F.coalesce(f"__g_{v}", F.lit(0))).alias(v) for v in values], *extra,
            (F.col("n") - F.coalesce("gone", F.lit(0))).alias("n")), "trie-raked")
        if rest.limit(1).count() == 0:
            break
        # the one child of each chain node, with what its edge carries
        below = rest.groupBy(F.col("parent").alias("key")).agg(F.min("key").alias("next"), *sums(extra))
        unary = rest.where("n = 1 and parent is not null").select("key", *values).join(below, "key")
        links = written(unary.select("key", "next", *[(F.col(v) + F.col(x)).alias(v) for v, x in zip(values, extra)]), "trie-links")
        if links.limit(1).count() == 0:
            state = rest
            continue
        while True:  # pointer doubling: each step doubles the stretch that a node has summed up
            step = links.select(F.col("key").alias("next"), F.col("next").alias("after"), *[F.col(v).alias(f"__a_{v}") for v in values])
            joined = written(links.join(step, "next", "left").select(
                "key", F.coalesce("after", "next").alias("next"),
                *[(F.col(v) + F.coalesce(f"__a_{v}", F.lit(0))).alias(v) for v in values], F.col("after").isNotNull().alias("moved")), "trie-links")
            links = joined.drop("moved")
            if joined.where("moved").limit(1).count() == 0:
                break
        chains.append(links)
        # a chain's end takes the place of its top, whose parent is no chain node
        chained = rest.join(links, "key", "left_semi")
        tops = chained.select("key", "parent", *extra).join(
            links.select(F.col("key").alias("parent")), "parent", "left_anti").join(
            links.select("key", "next", *[F.col(v).alias(f"__a_{v}") for v in values]), "key")
        moved = tops.select(F.col("next").alias("key"), F.col("parent").alias("__parent"), *[
            (F.col(f"__a_{v}") + F.col(x)).alias(f"__n_{v}") for v, x in zip(values, extra)])
        state = written(rest.join(links.select("key"), "key", "left_anti").join(moved, "key", "left").select(
            "key", F.coalesce("__parent", "parent").alias("parent"), *values,
            *[F.coalesce(f"__n_{v}", x).alias(x) for v, x in zip(values, extra)], "n"), "trie-state")
    for links in reversed(chains):
        end = done.select(F.col("key").alias("next"), *[F.col(v).alias(f"__a_{v}") for v in values])
        back = links.join(end, "next").select("key", *[(F.col(v) + F.col(f"__a_{v}")).alias(v) for v in values])
        done = done.unionByName(written(back, "trie-expanded"))
    return done


def prefix_trie(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """A row for each node of the trie of all rebuilt conversations.

    ``conv_id`` (the smallest member) and ``depth`` name a node;
    ``parent_conv_id`` is the parent's ``conv_id``, null for the root, which has
    depth 0 and all conversations as members.  Turns are ordered by turn (null
    first), role and text; a null role or text is empty; repeated rows are
    turns of their own.  Rows without conversation id belong to no
    conversation and are left out.  Without conversations there is no node.
    Only the four named columns are read.
    """
    both, convs = rebuilt(turns, conv_col, turn_col, role_col, text_col)
    rows = prefixes(both)
    found = rows.groupBy(F.col("hash").alias("key"), "depth").agg(
        F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("parent").alias("parent"), F.min("bytes").alias("bytes"))
    root = convs.agg(F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
        F.lit(ROOT).alias("key"), F.lit(0).cast("long").alias("depth"), "conv_id", "n_convs",
        F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("bytes"))
    nodes = written(found.unionByName(root), "trie-nodes")
    n_children = nodes.groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = written(nodes.join(n_children, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie-nodes")
    sums = subtree_sums(nodes.select(
        "key", "parent", (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens")), ["n_leaves", "saved_tokens"])
    turnless = convs.join(rows.where("depth = 1").select("conv"), "conv", "left_anti")
    digests = member_digests(rows.where("last").select(F.col("hash").alias("key"), "conv").unionByName(
        turnless.select(F.lit(ROOT).alias("key"), "conv")))
    above = nodes.where("n_children > 0").select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return nodes.join(above, "parent", "left").join(sums, "key").join(digests, "key", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))
