"""Corpus pipeline: toxicity, exact copies, near copies, source mixture, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and
reread as the next stage's ``docs``. All but the last return the columns of ``documents``. The
labels are read from ``sf_dir`` for fitting the toxicity model only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hydroframe.llm import exact_dedup, jaccard_join, packing, pfair_mix, toxicity
from hydroframe.llm.common import documents, written
from hydroframe.sources.tables import read_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that score below 0.5 for toxicity (operator 9)."""
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for white space, the row with the smallest id (operator 7)."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of documents linked at Jaccard 0.8 on five-word shingles, one (operator 6)."""
    return jaccard_join.drop_near_copies(docs, words=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, sorted so that every prefix follows the target mixture (operator 4)."""
    return pfair_mix.in_mix_order(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in sequences of 4096 tokens (operator 8), which follow the order
    of the rows: any prefix of the sequences is mixed like that prefix of the mixture."""
    return packing.pack_in_order(docs)


STAGES = [("toxicity", drop_toxic), ("exact dedup", drop_exact_copies), ("n-gram Jaccard join", drop_near_copies),
          ("mixing sources", mix_sources), ("best-fit packing", pack_sequences)]

# The toxicity model, shingle links and the tokenizer are beyond SQL: tests hold run() against
# brute-force versions of its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's rows are written and reread."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
