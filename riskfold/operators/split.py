"""Train/test splitting and sampling.

The default split hashes the customer id: it needs no shuffle, does not
depend on partitioning (``randomSplit`` does), keeps every statement of a
customer on one side, and has an exact SQL form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskfold.session import fresh_table

# The original's seed and training share.
DEFAULT_SEED = 42
DEFAULT_TRAIN_PCT = 80


def hash_bucket(id_col: str, seed: int = DEFAULT_SEED) -> Column:
    """0..99 from the first 32 bits of md5(id || ':' || seed)."""
    digest = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(100))


def hash_bucket_sql(id_col: str, seed: int = DEFAULT_SEED) -> str:
    """DuckDB form of :func:`hash_bucket`."""
    return f"(('0x' || substr(md5(CAST({id_col} AS VARCHAR) || ':{seed}'), 1, 8))::BIGINT % 100)"


def with_hash_split(df: DataFrame, id_col: str, train_pct: int = DEFAULT_TRAIN_PCT,
                    seed: int = DEFAULT_SEED, out: str = "split") -> DataFrame:
    return df.withColumn(
        out, F.when(hash_bucket(id_col, seed) < train_pct, "train").otherwise("test")
    )


def hash_split(df: DataFrame, id_col: str, train_pct: int = DEFAULT_TRAIN_PCT,
               seed: int = DEFAULT_SEED) -> tuple[DataFrame, DataFrame]:
    b = hash_bucket(id_col, seed)
    return df.where(b < train_pct), df.where(b >= train_pct)


def with_random_split(df: DataFrame, weights=(0.8, 0.2), seed: int = DEFAULT_SEED,
                      out: str = "split") -> DataFrame:
    """Row-level random split in one pass; the draw depends on the input's partitioning."""
    share = weights[0] / sum(weights)
    return df.withColumn(out, F.when(F.rand(seed) < share, "train").otherwise("test"))


def random_split(df: DataFrame, weights=(0.8, 0.2), seed: int = DEFAULT_SEED) -> tuple[DataFrame, DataFrame]:
    """The two parts of one draw of :func:`with_random_split`.

    The draw is written to the shared folder, once, and both parts are read
    from there: whatever becomes of the layout of ``df`` or of an executor, a
    row is in exactly one of them.
    """
    both = fresh_table(with_random_split(df, weights, seed, "__split"), "random-split")
    return (both.where(F.col("__split") == "train").drop("__split"),
            both.where(F.col("__split") == "test").drop("__split"))


def bernoulli_sample(df: DataFrame, fraction: float = 0.05, seed: int = DEFAULT_SEED) -> DataFrame:
    """Sample without replacement (for previews; metrics always run on all rows)."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def split_sizes(df: DataFrame, split_col: str = "split") -> DataFrame:
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n_rows"))
