"""A training-data pipeline over ``documents``.

Each stage works on all rows that the stage before has kept; ``run`` writes a
stage's result as Parquet into the shared folder and reads it for the next.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfold.llm import decontamination, mixing, ngram_join, quality_rules, token_output
from riskfold.llm.queries import tokenizer_file
from riskfold.llm.tables import fresh_path, free_name, written
from riskfold.sources.tables import read_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or repeat themselves go; so do null and empty texts."""
    into = free_name(docs, "__quality")
    return quality_rules.quality(docs, into=into).where(F.col(into)["kept"]).drop(into)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that 5-gram Jaccard links of 0.8 join, the one with the smallest id stays."""
    return ngram_join.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    into = free_name(docs, "__leak")
    leaks = decontamination.decontaminate(docs, read_table(spark, sf_dir, "benchmark"), into=into)
    return leaks.where(F.col(into)["n_hit"] == 0).drop(into)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources, by weight, starts them: not at all, once or twice."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token files; ``doc_id, start, n_tokens, ids_crc32`` of each document, read back from them."""
    path = fresh_path(spark, "pipeline-tokens")
    token_output.write_tokens(docs, path, tokenizer_file())
    return token_output.with_checksums(token_output.read_tokens(spark, path))


STAGES = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("tokens", tokens),
]

#: DuckDB has no tokenizer, so no SQL gives the rows of the last stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages' result over the whole ``documents`` table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
