"""Run a streaming frame over all that is there now and give its rows as a frame."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir; where that is unset, below a temporary one, in local mode only."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = _own.setdefault(spark.sparkContext.applicationId, "file://" + tempfile.mkdtemp(prefix="hydroframe-"))
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Timers, lists of state and keys that go need the store on disk.
_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


@contextmanager
def state_on_disk(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, in so many partitions at most."""
    conf, shuffle = dict(_STORE), "spark.sql.shuffle.partitions"
    if partitions:
        conf[shuffle] = str(min(int(spark.conf.get(shuffle)), partitions))
    was = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in was.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def drain(stream: DataFrame, mode: str = "append", root: str | None = None, partitions: int | None = None) -> DataFrame:
    """Rows that the stream puts out for the files there are now; complete mode gives those of the last batch.

    With the same root a later run goes on where the one before ended, and the rows of all runs are given.  The state of a
    stream with few keys is kept in `partitions` at most: each opens a store and a worker in every batch, with rows or without.
    """
    root = root or folder(stream.sparkSession, "stream")
    schema = stream.schema

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/out" if mode == "complete" else f"{root}/out/batch={number}")

    with state_on_disk(stream.sparkSession, partitions):
        stream.writeStream.outputMode(mode).foreachBatch(save).option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(schema).parquet(f"{root}/out").select(*schema.names)
