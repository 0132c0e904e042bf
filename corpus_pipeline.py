"""From raw documents to shards: five stages, each over all that the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as
Parquet and read again as the next one's docs. All but the last return the
columns of documents. Part of subpackage tidegate.llm, and absent with it.

Every stage takes any rows: null and empty texts, null and repeated ids, nulls
in any column, texts of any length, further columns whatever their names, and
empty tables, which give empty ones. What becomes of such rows stands with each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidegate.llm import decontam, minhash, mixing, quality, sharding
from tidegate.llm.common import Scratch, bound_batches, table

SHARDS = 24


def accept(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the co-trained classifier judges low or toxic.

    Null and empty texts are judged by their metadata; rows that repeat an id
    each by its own text. Without labels all stay.
    """
    bound_batches(spark)
    return quality.accepted(docs, table(spark, sf_dir, "labels"), Scratch(spark, "accept"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words a shingle, similarity 0.8 or more.

    Equal rows are one; a repeated id's different texts stay. Null and empty
    texts stay, one of an id; rows with a null id all stay.
    """
    bound_batches(spark)
    return minhash.minhash_dedup(docs, Scratch(spark, "deduplicate"), percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without benchmark passages; documents that are little else go whole.

    Rows without a passage, null and empty texts among them, stay as they are. An
    empty benchmark changes nothing.
    """
    bound_batches(spark)
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"), Scratch(spark, "decontaminate"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents none, once or twice, so that sources meet their weights.

    A null source is one of its own. Null and empty texts have no tokens to give
    and go. Repeated rows are rounded each on its own.
    """
    bound_batches(spark)
    return mixing.mixed_rows(docs, Scratch(spark, "mix"))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row's shard and its slot there, with its text.

    A document that is there twice has one shard and two slots; null ids share a
    shard.
    """
    bound_batches(spark)
    t = sharding.tree(SHARDS)
    return sharding.shard(docs, t, sharding.grow(t), carry=True)


STAGES = [("quality", accept), ("near_duplicates", deduplicate), ("decontamination", decontaminate), ("mixing", mix), ("sharding", shard)]

#: SQL has no co-trained classifier; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents."""
    docs = table(spark, sf_dir, "documents")
    scratch, last = Scratch(spark, "pipeline"), None
    for _, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir))
        if last is not None:
            scratch.drop(last)
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)
