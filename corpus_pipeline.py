"""The training-data pipeline: quality rules, line dedup, near-dedup, mixing, packing.

Every stage takes (spark, docs, sf_dir) and returns rows; all but the last
return the columns of ``docs``.  ``run`` writes each stage's rows as Parquet in
the folder of ``spark.checkpoint.dir`` and hands the next stage what it reads
back, so a lost executor costs a part of one stage.

An empty table passes through all stages; columns beyond doc_id, text, source
and n_chars travel along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spanloom.llm import linededup, mixing, packing, quality, simhash
from spanloom.llm.common import materialize, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.keep_quality(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier line matches go."""
    return linededup.dedup_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    return simhash.keep_first(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mix_documents(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the sequences."""
    return packing.pack_documents(docs, packing.word_tokenizer())


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_dedup),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

#: Fingerprints need XXH64 and token ids a tokenizer; neither is SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
