"""A corpus pipeline of five stages: quality, exact dedup, near-dedup, mixing, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a frame, which is written as Parquet and read again as the docs of the
next.  All but the last return the columns of docs, so a stage can be left out or run alone.  No SQL expresses the first
stage (a fitted model), so ORACLE_SQL is None and the stages are tested one by one against brute force.

Edge cases, in every stage: null and empty texts are texts like others (equal to each other in the exact stage, linked
with nothing in the near stage); rows without an id, or that repeat one, are rows of their own, except that of rows that
repeat id and text one stays; an empty table gives an empty one; columns of any name pass through unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydroframe.llm import byte_bpe, exact_dedup, mixing, near_dedup, quality, shared

ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier accepts."""
    model = quality.train(docs, shared.table(spark, sf_dir, "labels").where(~quality.held_out()))
    scored, (_, predicted) = quality.score(docs, model), quality.score_names(docs)
    return scored.where(F.col(predicted) == 1).select(docs.columns)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts; of rows that repeat id and text, one."""
    key, kept_id, kept_key = (shared.free_name(docs, name) for name in ("key", "kept_id", "kept_key"))
    kept = exact_dedup.exact_duplicates(docs).where("kept").select(F.col("doc_id").alias(kept_id), F.col("digest").alias(kept_key)).distinct()
    keyed = docs.withColumn(key, exact_dedup.sha256(exact_dedup.normalised(F.col("text"))))
    same = (F.col(key) == F.col(kept_key)) & F.col("doc_id").eqNullSafe(F.col(kept_id))
    return keyed.join(kept.hint("merge"), same, "left_semi").dropDuplicates(["doc_id", key]).select(docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates (five words, similarity 0.8), known by id and text."""
    row, row_key = shared.free_name(docs, "row"), F.xxhash64("doc_id", "text")
    near = near_dedup.near_duplicates(docs.select(row_key.alias("doc_id"), "text"), k=5, percent=80)
    gone = near.where(~F.col("kept")).select(F.col("doc_id").alias(row)).distinct()
    return docs.withColumn(row, row_key).join(shared.sized(gone), row, "left_anti").select(docs.columns)


def _with_slots(docs: DataFrame, slot: str) -> DataFrame:
    """Documents with their slot of the mix, which is the same for the same documents whatever their order."""
    planned_id = shared.free_name(docs, "planned_id")
    plan = mixing.mix(docs).where("slot is not null").groupBy(F.col("doc_id").alias(planned_id)).agg(F.min("slot").alias(slot))
    return docs.join(plan.hint("merge"), F.col("doc_id").eqNullSafe(F.col(planned_id))).drop(planned_id)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, in the order of the slots of the mix: a source that runs dry leaves, and the others go on."""
    slot = shared.free_name(docs, "slot")
    return _with_slots(docs, slot).orderBy(slot, "doc_id").select(docs.columns)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document with its source and slot of the mix, and digests of the ids and of what they decode to.

    Files keep no order, and the mixing stage adds no column; so the slot is found again here, for whoever reads the mix.
    """
    import public_tokenizers

    slot, key = shared.free_name(docs, "slot"), shared.free_name(docs, "key")
    placed = _with_slots(docs, slot).select(F.struct("doc_id", F.col("source").cast("string").alias("source"), F.col(slot).alias("slot")).alias(key), "text")
    made = byte_bpe.round_trip(placed, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, id_col=key, keep_ids=True)
    return made.select(f"{key}.*", *[c for c in made.columns if c != key])


STAGES = [("quality", quality_stage), ("exact", exact_stage), ("near", near_stage), ("mixing", mixing_stage), ("encode", encode_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = shared.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = shared.written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
