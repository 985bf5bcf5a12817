"""A training corpus from raw documents: rules, near copies, benchmark leaks, mixture, shards.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from syncloom.llm import decontamination, jaccard_join, mixing, oracle, quality_rules, sharding
from syncloom.llm.common import Scratch, count_white_words, fresh, named

N_SHARDS = 40
MIX_CYCLE = (5.0, 2.0, 1.0)
MIX_TOTAL, MIX_EPOCHS = 1.5, 2.0


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    Null and empty texts have no words and go. Rows that repeat are judged alike and all stay or
    go; nulls in other columns and columns of any name pass through. No rows give no rows.
    """
    return quality_rules.keep_good(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that similarity links, the one with the smallest id; documents without words stay.

    Rows that repeat an id as well are told apart by nothing; the first of them by text stays. Null ids
    link like others; null texts have no words and stay. No rows give no rows.
    """
    (out,) = fresh(docs, "_similar")
    found = jaccard_join.similar(docs, out=out)
    return jaccard_join.first_of_each(found, out=out)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark's passages do not contaminate.

    Null texts have no words and stay; rows that repeat share their fate. Without benchmark items,
    or without rows, all rows stay.
    """
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.drop_contaminated(docs, items)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them.

    A null source is a source of its own. Documents without words fall on a side of the cut like
    others; a source without any words has nothing to give, and its rows go. Rows that share an id
    are taken one by one. No rows give no rows.
    """
    size = count_white_words(named("text"))
    sizes = mixing.source_sizes(docs, "source", size)
    weights = mixing.cyclic_weights(Scratch(spark, "mix").write(sizes, "sizes"), MIX_CYCLE)
    (out,) = fresh(docs, "_mix")
    mixed = mixing.mix(
        docs, weights, size=size, total=MIX_TOTAL, max_epochs=MIX_EPOCHS, out=out
    )
    return mixing.repeat_rows(mixed, out)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and their slot in it.

    Every row gets a place, copies and rows of null id, source or text among them; shards differ by one
    row at most. No rows give no rows.
    """
    return sharding.shard(docs, N_SHARDS)


STAGES = [
    ("quality_rules", good_documents),
    ("ngram_jaccard_join", one_of_each_group),
    ("benchmark_decontamination", without_benchmark),
    ("mixing", mixed_sources),
    ("sharding", shards),
]

#: DuckDB SQL for the rows of run(), all stages one after the other.
ORACLE_SQL = oracle.pipeline(N_SHARDS)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
