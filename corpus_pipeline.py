"""A training corpus from raw documents: language ID, near-dedup, substring dedup, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; all but the last return
the columns of ``documents``.  A stage first deletes the intermediate tables of the stage before
it, whose result has been written by then.

Rows that share a doc_id are one document: they are kept or dropped together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from secflow.llm import language_id, near_dup, packing, suffix_dedup
from secflow.llm.common import pinned, release, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
NOISE = language_id.DIM ** -0.5     # standard deviation of the cosine of an unlike text with a prototype
#: (different trigrams, least cosine in units of NOISE), linear in between.  Text with fewer trigrams than the
#: first says too little to be rejected.  Calibrated on the labelled rows of sf0.1: none of them falls below,
#: random letters and unknown scripts stay below 6, another language mostly below 10 (from 200 trigrams on).
LIMITS = [(20, 0.0), (60, 6.0), (130, 8.0), (200, 13.0)]


def least_score(trigrams: Column) -> Column:
    """The cosine that a text with so many different trigrams must exceed."""
    limit = F.lit(LIMITS[-1][1])
    for (lo, a), (hi, b) in reversed(list(zip(LIMITS, LIMITS[1:], strict=False))):
        limit = F.when(trigrams < hi, a + (trigrams - lo) * ((b - a) / (hi - lo))).otherwise(limit)
    return limit * NOISE


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without letters, and those unlike every language; fill missing ``lang``."""
    release(spark, docs)
    found = language_id.identify(docs.select(*COLUMNS), COLUMNS)
    like = (F.col("trigrams") < LIMITS[0][0]) | (F.col("score") > least_score(F.col("trigrams")))
    known = found.filter((F.col("lang_pred") != "und") & like)
    return known.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of near duplicates."""
    release(spark, docs)
    kept = near_dup.near_duplicates(docs).filter("kept").select(F.col("doc_id").alias("kept_id"))
    return docs.select(*COLUMNS).join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")), "left_semi")


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut the byte strings that start earlier elsewhere.

    A character that loses some of its bytes goes whole.  A document left empty stays as a row.
    """
    release(spark, docs)
    cut = suffix_dedup.deduplicate(docs, with_text=True).select("doc_id", "kept_text")
    about = docs.select(F.col("doc_id").alias("about_id"), "lang", "source").dropDuplicates(["about_id"])
    return (cut.join(about, F.col("doc_id").eqNullSafe(F.col("about_id")), "left")
            .select("doc_id", F.col("kept_text").alias("text"), "lang", "source",
                    F.char_length("kept_text").cast("long").alias("n_chars")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of tokens."""
    release(spark, docs)
    return packing.pack(docs)


STAGES = [("language_id", identify_language), ("near_dedup", drop_near_duplicates),
          ("suffix_dedup", remove_repeated_passages), ("packing", pack_sequences)]

#: SQL cannot express the stages; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = pinned(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
