"""The corpus pipeline: five stages over documents, each written as Parquet and read again before the next.

Every stage but the last returns the columns of documents, with n_chars following the text. A null text passes the first
stage never (it has no words); rows may repeat, ids may be null; other columns of the input are dropped by name.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxlake.llm import linededup, neardup, packing, private, quality
from boxlake.session import table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
REST = COLUMNS[1:]
#: SQL can express neither the robust estimates nor hash-ordered components; tests compare with brute force.
ORACLE_SQL = None
#: Broadcast dropped ids up to this many bytes; beyond it, they meet the documents by a shuffle.
BROADCAST_BYTES = 32 << 20


def _measured(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the robust outlier test keep."""
    return quality.judge(docs, keep=REST).filter("kept").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that more than a tenth of their source's documents hold."""
    return _measured(linededup.drop_boilerplate(docs))


def minhash_neardup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, similarity 0.8): the one with the smallest id."""
    docs = docs.select(*COLUMNS)
    found = written(neardup.near_duplicates(docs, prints=True), "groups")
    known = found.filter("doc_id is not null")
    # Ids that repeat, usually none: their rows are told apart by fingerprint. Rows without an id link with nothing and stay.
    many = written(known.groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias("_id")), "many")
    gone = written(found.filter("not kept").select(F.col("doc_id").alias("_id")).unionByName(many).distinct(), "gone")
    left = docs.join(_small(gone), F.col("doc_id") == F.col("_id"), "left_anti").select(*COLUMNS)
    if many.isEmpty():
        return left
    several = neardup.fingerprinted(docs.join(_small(many), F.col("doc_id") == F.col("_id"), "left_semi"), name="_fp")
    stay = known.filter("kept and fp is not null").join(_small(many), F.col("doc_id") == F.col("_id"), "left_semi").select(F.col("doc_id").alias("_id"), F.col("fp").alias("_print")).distinct()
    same = (F.col("doc_id") == F.col("_id")) & (F.col("_fp") == F.col("_print"))
    # Of rows of one id and one set of shingles, copies of one document, the one that sorts first stays.
    one = several.join(stay.hint("merge"), same, "left_semi").groupBy("doc_id", "_fp").agg(F.min(F.struct(*REST)).alias("r")).select("doc_id", "r.*")
    return left.unionByName(one.select(*COLUMNS)).unionByName(several.filter("_fp is null").select(*COLUMNS))


def _small(ids: DataFrame) -> DataFrame:
    """Ids for a join: broadcast if their number allows it."""
    return F.broadcast(ids) if ids.count() * (neardup.ROW_BYTES + 8) <= BROADCAST_BYTES else ids.hint("merge")


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind in brackets."""
    return _measured(private.redact_private(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document that is left, and its place in a sequence of at most 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("minhash_neardup", minhash_neardup), ("pii", pii), ("best_fit_packing", best_fit_packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in order to the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
