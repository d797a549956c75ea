"""A corpus from documents to token windows: quality, near copies, personal data, source mix, packing.

Every stage takes all documents that its predecessor kept, writes its result as a table in the checkpoint
folder and hands that table on, so a lost executor repeats part of a stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from interlog.llm import minhash, mixing, packing, pii, quality
from interlog.llm.queries import PII_KEY, quality_model, tokenizer_path
from interlog.llm.shared import small_batches, table
from interlog.session import cut_lineage


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    small_batches(spark)
    model = quality_model(docs, table(spark, sf_dir, "labels"))
    name = "_quality" + "_" * max((len(c) for c in docs.columns), default=0)
    return quality.score(docs, model, name=name).where(F.col(name) >= 0.5).drop(name)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 and more."""
    small_batches(spark)
    return minhash.without_copies(docs, width=5, percent=80)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data and their lengths brought up to date."""
    out = pii.replace_entities(docs, PII_KEY)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in out.columns else out


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the source mix takes, once for each copy."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token windows."""
    small_batches(spark)
    return packing.pack(docs, tokenizer_path())


STAGES = [("quality classifier", good_quality), ("MinHash near-dedup", one_of_each), ("PII surrogates", private),
          ("source mix", mixed), ("packing", packed)]
#: No SQL: the classifier is learned and the tokenizer is a library.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name.lower().replace(" ", "_"))
    return docs
