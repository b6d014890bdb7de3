"""A training-corpus pipeline: quality filter, exact and near deduplication, mixing and packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns a DataFrame; run() writes
each result as Parquet in the shared folder and reads it again as the next stage's documents. All stages but the last
return the columns of documents.

Defined results, in every stage: null text is empty; a document without words is accepted by the quality stage, has one
class of equal texts with all others without words, has no shingles and links with nothing, and becomes its end id alone
in packing; rows that repeat a doc_id share the decision on that doc_id, and of rows that repeat whole all stay together;
rows without doc_id are never dropped as copies; ties go to the smallest doc_id; an empty table gives an empty result; other
columns, whatever their names, are carried through all stages but the last, which returns pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilelake.llm import exact_dedup, jaccard, mixing, packing, quality
from tilelake.llm.common import documents, materialize, scratch_scope, ship

#: Share of the tokens that mixing draws.
MIX_BUDGET = 0.8
#: Bytes of known pre-tokens in a worker, twice; small, as the workers have served four stages before.
PACK_CACHE = 32 << 20


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label classifier rejects go."""
    ship(spark)
    return quality.drop_rejected(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the longest original stays."""
    ship(spark)
    return exact_dedup.drop_exact_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    ship(spark)
    return jaccard.keep_one_of_each_group(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are drawn by raked probabilities."""
    ship(spark)
    return mixing.sample_documents(docs, mixing.topic_of(F.col("text")), {"lang": mixing.LANG_TARGET}, budget=MIX_BUDGET)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in training sequences."""
    ship(spark)
    return packing.pack(docs, "word_bpe_49k.json", cache_bytes=PACK_CACHE)


STAGES = [("quality", quality_stage), ("exact", exact_stage), ("near", near_stage), ("mix", mix_stage), ("pack", pack_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        with scratch_scope(spark):  # a stage's own tables go when its result is written
            docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}", outlive=True)
    return docs


ORACLE_SQL = None
