"""Five stages from documents to packed training sequences.

A stage is a function of the documents that the one before returned, read or not
yet read; it removes nothing, so stages can be chained, repeated and run side by
side. run() writes each stage's result as Parquet, and removes what a stage kept
in shared storage while it worked, and the result before, once that is done. The
first four return the columns of documents; the last a row per packed piece.

In every stage: extra columns stay whatever their names (but for the last, which
leaves them out), and an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import line_dedup, minhash_dedup, mixing, packing, quality_rules
from strandline.llm.common import flag_ids, fresh, materialize, materialize_at, remove, scratch


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed rules reject go.

    Null and empty texts fail the base rules and go; repeated rows and null ids
    are judged like others; long texts are judged as a whole.
    """
    return quality_rules.keep_documents(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated line chunks go; a document of nothing else goes with them.

    Null and empty texts stay as they are. Of repeated rows the first place keeps
    its chunks. n_chars is counted anew where a text changed.
    """
    _, n_removed = line_dedup.result_names(docs)
    out = line_dedup.dedup_lines(docs).where((F.col(n_removed) == 0) | F.col("text").isNull() | (F.length("text") > 0))
    if "n_chars" in docs.columns:
        counted = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col(n_removed) > 0, counted).otherwise(F.col("n_chars")))
    return out.select(docs.columns)


def minhash_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one of the least id.

    Of rows with one doc_id one stays. Rows without doc_id, and texts without
    words, are in no group and stay.
    """
    groups = materialize(minhash_dedup.near_components(docs), "groups")
    gone = groups.where("NOT kept").select("doc_id")
    twice = groups.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id")
    (maybe,) = fresh(docs.columns, "_maybe")
    flagged = flag_ids(docs, "doc_id", gone.unionByName(twice), maybe)
    some = flagged.where(F.col(maybe)).join(gone.distinct(), "doc_id", "left_anti").dropDuplicates(["doc_id"])
    return flagged.where(~F.col(maybe)).unionByName(some).select(docs.columns)


def source_mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the order of the schedule; sources under their weight begin again, so their rows repeat.

    A null source is a source; null ids, repeated rows and null, empty or long
    texts are documents like others.
    """
    return mixing.mix_documents(docs)


def best_fit_packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset and the certificate.

    A null or empty text is the end id alone; long texts are cut into pieces;
    null ids and repeated rows are packed like others.
    """
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules_stage),
    ("line_dedup", line_dedup_stage),
    ("minhash_dedup", minhash_dedup_stage),
    ("source_mixing", source_mixing_stage),
    ("best_fit_packing", best_fit_packing_stage),
]

#: Estimation, hashing and packing aren't SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        with scratch() as made:
            docs, folder = materialize_at(stage(spark, docs, sf_dir), f"pipeline-{name}")
        for done in (set(made) | {before}) - {folder, None}:
            remove(spark, done)
        before = folder
    return STAGES[-1][1](spark, docs, sf_dir)
