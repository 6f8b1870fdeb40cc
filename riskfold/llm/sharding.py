"""Sharding by rendezvous hashing: DataFrame functions only.

Every record key scores every shard, ``weight / -ln(u)`` with ``u`` a hash of
key and shard in (0, 1); the best score wins.  A shard's score does not depend
on the other shards, so a new shard only takes the rows whose score it beats,
and a removed one only gives its own rows away.  Shards get rows in
proportion to their weights.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEED = 20_011
#: Slot numbers are counted in this many hash ranges a shard, so that no task
#: has to hold a whole shard.
SLOT_BUCKETS = 1024


def _hash(key: Sequence[Column], *more: Column, seed: int) -> Column:
    # a null is hashed as a value of its own, also next to other key columns
    return F.xxhash64(F.lit(seed), *[F.coalesce(k.cast("string"), F.lit("\0null")) for k in key], *more)


def rendezvous_shard(key: Sequence[Column], weights: Sequence[float], seed: int = SEED) -> Column:
    """The shard, 0 to ``len(weights) - 1``, that wins ``key``; ties go to the lower number.

    A null key is a key like any other.  A weight of 0 never wins.
    """
    if not weights or any(w < 0 for w in weights) or not any(weights):
        raise ValueError("shards need weights of at least 0, one above 0")
    each = F.array(*[F.lit(float(w)) for w in weights])

    def score(weight: Column, i: Column) -> Column:
        u = (F.shiftrightunsigned(_hash(key, i, seed=seed), 11) + 0.5) / float(2**53)
        return F.struct((weight / -F.ln(u)).alias("score"), (-i).alias("i"))

    return (-F.array_max(F.transform(each, score))["i"]).cast("int")


def with_shards(
    df: DataFrame, key: Sequence[str], weights: Sequence[float], into: str = "shard", seed: int = SEED,
) -> DataFrame:
    """``df`` with its shard number; every other column is kept.

    Needs no shuffle.  Repeated rows share a key and so a shard; an empty table
    stays empty.
    """
    return df.withColumn(into, rendezvous_shard([F.col(k) for k in key], weights, seed))


def with_slots(
    df: DataFrame, shard: str, key: Sequence[str], order: Sequence[str] = (), into: str = "slot", seed: int = SEED,
) -> DataFrame:
    """Number the rows of each shard from 0 without gaps, in (hash range, key, ``order``) order.

    The counts of the ranges need the key columns only; they are at most
    shards x ``SLOT_BUCKETS`` rows, which are broadcast.  Rows that tie in
    key and ``order`` may swap slots.
    """
    taken = {c.lower() for c in df.columns}
    bucket, first = "__bucket", "__first"
    if {bucket, first, into.lower()} & taken:
        raise ValueError(f"columns {bucket}, {first} and {into} must not exist yet")
    ranged = df.withColumn(
        bucket, F.pmod(_hash([F.col(k) for k in key], seed=seed + 1), F.lit(SLOT_BUCKETS)).cast("int")
    )
    before = Window.partitionBy(shard).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy(shard, bucket).agg(F.count(F.lit(1)).alias("__n")).select(
        shard, bucket, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias(first)
    )
    within = Window.partitionBy(shard, bucket).orderBy(*key, *order)
    return (
        ranged.join(F.broadcast(counts), [shard, bucket])
        .withColumn(into, (F.row_number().over(within) - 1 + F.col(first)).cast("long"))
        .drop(bucket, first)
        .select(*df.columns, into)
    )
