"""Where intermediate tables go, and how Arrow batches of text are cut into small parts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a Python task works on at a time; NumPy temporaries are about 40 times as large.
PART_BYTES = 2 << 20
_own: dict[str, str] = {}


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir; where that is unset, below a temporary one, in local mode only."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        root = _own.setdefault(app, "file://" + tempfile.mkdtemp(prefix="hydroframe-"))
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts lineage and survives lost executors."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def parts(batch: pa.RecordBatch, column: int, most: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of at most `most` bytes of the given column each, a longer row alone."""
    ends = text_bytes(batch.column(column))[1]
    at, n = 0, batch.num_rows
    while at < n:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + most, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column without nulls, and where each row begins (one more entry than rows)."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    ends = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None and len(ends) else np.zeros(0, np.uint8)
    return data, ends - ends[0]


def sized(ids: DataFrame, broadcast_rows: int = 1_000_000) -> DataFrame:
    """A frame of a few plain columns, to be broadcast if its rows are at most so many, else to be merged by a shuffle."""
    return F.broadcast(ids) if ids.count() <= broadcast_rows else ids.hint("merge")


#: The rows of one key are dealt to at most so many tasks.
SALTS = 256


def salt(column: str):
    return F.pmod(F.xxhash64(column), F.lit(SALTS)).cast("int")


def salts(column: str):
    """The salts that the rows of a key have, as an aggregate for `by_key`."""
    return F.collect_set(salt(column)).alias("salts")


def by_key(rows: DataFrame, other: DataFrame, keys: list[str], column: str, how: str = "inner") -> DataFrame:
    """rows joined to the one row that `other` has for a key: a common key goes to many tasks, by a salt from a column.

    other has, for each key, `salts` of the same rows; it is copied to each salt, so at most once for a row.
    """
    copies = other.withColumn("_salt", F.explode("salts")).drop("salts")
    return rows.withColumn("_salt", salt(column)).join(copies, [*keys, "_salt"], how).drop("_salt")


def free_name(df: DataFrame, name: str) -> str:
    """The name with as many underscores before it as no column of df has, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
