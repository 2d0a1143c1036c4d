r"""Exact dedup as a stateful stream.

Texts are equal when they are identical after each run of white space ([\x20\x09-\x0D]) is one space.  A feed of digest,
identifier and content locator (the file a row came from) is streamed; the state, keyed by digest, kept by RocksDB on disk
and never expiring, retains the smallest identifier with its locator and the number of rows.  More feed files appended
later continue from the same checkpoint.  After the stream, groups of two and more are checked on full bytes: all texts of a digest must be
equal, byte by byte; where they are not, its rows are grouped anew by the text itself.

Edge cases: null and empty texts are equal to each other (a text of white space only is one space, not empty); a null id
counts as the smallest; rows that repeat id and text share their flags; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared

FILES_PER_BATCH, BROADCAST_ROWS, LARGE_GROUP = 24, 200_000, 1 << 16
_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    # Many small stores: no disk is allocated ahead of use.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def stream_digests(feed: str, schema, state_dir: str, updates: str, spark, files_per_batch: int = FILES_PER_BATCH) -> None:
    """Bring the state up to date with all files of the feed; each batch writes the keys it changed below `updates`."""
    was = {key: spark.conf.get(key, None) for key in _STATE}
    for key, value in _STATE.items():
        spark.conf.set(key, value)
    try:
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(feed)
        state = stream.groupBy("digest").agg(F.min(F.struct("id", "locator")).alias("keep"), F.count("*").alias("n"))
        query = (
            state.writeStream.outputMode("update").option("checkpointLocation", state_dir).trigger(availableNow=True)
            .foreachBatch(lambda df, batch: df.write.mode("overwrite").parquet(f"{updates}/batch={batch}")).start()
        )
        query.awaitTermination()
    finally:
        for key, value in was.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = sha256, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """id, keep_id, group_size, kept and digest of every row."""
    spark, root = docs.sparkSession, shared.work_dir(docs.sparkSession, "exact")
    rows = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("text"))
    keyed = rows.withColumn("digest", digest(F.col("text")))
    feed = keyed.select("id", "digest", F.input_file_name().alias("locator"))
    feed.write.parquet(f"{root}/feed")
    stream_digests(f"{root}/feed", feed.schema, f"{root}/state", f"{root}/updates", spark, files_per_batch)
    state_schema = f"digest string, keep struct<id:{feed.schema['id'].dataType.simpleString()},locator:string>, n bigint, batch bigint"
    state = spark.read.schema(state_schema).parquet(f"{root}/updates") if rows_of(spark, f"{root}/feed", feed.schema) else spark.createDataFrame([], state_schema)
    state = state.groupBy("digest").agg(F.max_by(F.struct("keep", "n"), "batch").alias("s")).select("digest", F.col("s.keep.id").alias("keep_id"), F.col("s.n").alias("group_size"))
    state = shared.written(state, "state")

    hits = state.where("group_size > 1").select("digest")
    hits = F.broadcast(hits) if hits.count() <= BROADCAST_ROWS else hits
    checked = keyed.join(hits, "digest", "left_semi").groupBy("digest").agg((F.min("text") == F.max("text")).alias("same"))
    false_hits = shared.written(checked.where(~F.col("same")).select("digest"), "false-hits")
    found = spark.read.schema(feed.schema).parquet(f"{root}/feed").select("id", "digest")
    if not false_hits.limit(1).count():
        out = _by_digest(found, state)
    else:
        other = keyed.join(false_hits, "digest", "left_semi")
        anew = other.groupBy("digest", "text").agg(F.min(F.struct("id")).alias("keep"), F.count("*").alias("group_size"))
        anew = other.join(anew, ["digest", "text"]).select("digest", "id", F.col("keep.id").alias("keep_id"), "group_size")
        out = _by_digest(found.join(false_hits, "digest", "left_anti"), state).select("digest", "id", "keep_id", "group_size").unionByName(anew)
    return out.select(F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")


def _by_digest(found: DataFrame, state: DataFrame) -> DataFrame:
    """Rows with the state of their digest; the rows of a digest that many have are dealt to many tasks."""
    large = state.where(F.col("group_size") > LARGE_GROUP).select("digest", F.lit(True).alias("large"))
    found = found.join(shared.sized(large), "digest", "left").withColumn("_salt", F.when(F.col("large"), shared.salt("id")).otherwise(0)).drop("large")
    copies = F.when(F.col("group_size") > LARGE_GROUP, F.sequence(F.lit(0), F.lit(shared.SALTS - 1))).otherwise(F.array(F.lit(0)))
    return found.join(state.withColumn("_salt", F.explode(copies)), ["digest", "_salt"]).drop("_salt")


def rows_of(spark, path: str, schema) -> int:
    return spark.read.schema(schema).parquet(path).limit(1).count()
