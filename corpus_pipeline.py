"""A training-corpus pipeline: quality rules, near-duplicates, personal data, mixture, packing.

Each stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and
returns rows with the columns of documents; the last returns packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hebdo.llm import curriculum, packing, pii, quality, setsketch
from hebdo.llm.common import stash, table
from hebdo.llm.registry import pack_params


def _sized(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays (five-word shingles, similarity 0.8)."""
    found = setsketch.near_duplicates(docs, setsketch.SketchParams(shingle=5))
    gone = found.filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return _sized(pii.redact(docs)).select(*docs.columns)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and in the order, as the mixture shows them."""
    return _sized(curriculum.mixed(docs, curriculum.mix_plan(docs))).select(*docs.columns)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return packing.pack(docs, pack_params())


STAGES = [("quality rules", quality_stage), ("near-duplicates", near_dedup_stage), ("personal data", pii_stage),
          ("mixture", mix_stage), ("packing", pack_stage)]

#: Sketches, EM and packing are not expressible in SQL; tests/llm checks them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stash(docs)
    return docs
