"""Tables with a manifest: loads seen whole or not at all, emptied and changed files, the stream's own table."""

import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from hydroframe.sources import sinks
from hydroframe.streaming import streams
from hydroframe.streaming.run import folder


def rows_of(spark, **files):
    return spark.createDataFrame([(n, t, v) for n, own in files.items() for t, v in own], "fileName string, us bigint, v int")


def listing(spark, **changed):
    return spark.createDataFrame(list(changed.items()), "fileName string, fileChangeTime int")


def held(spark, root, schema):
    return sorted((r["fileName"], r["us"], r["v"]) for r in sinks.read_table(spark, root, schema).collect())


def test_changed_and_emptied_files(spark):
    root = folder(spark, "table")
    sinks.create_table(spark, root)
    first = rows_of(spark, a=[(1, 1), (2, 1)], b=[(1, 2)], c=[(5, 3)])
    sinks.reload_changed_files(first, listing(spark, a=10, b=10, c=10), root, "us", "one")
    sinks.create_table(spark, root)  # There is one: nothing happens.
    assert len(held(spark, root, first.schema)) == 4
    now = listing(spark, a=11, b=10, c=12, d=12)
    sinks.reload_changed_files(rows_of(spark, a=[(7, 9)], b=[(8, 8)], d=[(1, 1)]), now, root, "us", "two")
    expected = [("a", 7, 9), ("b", 1, 2), ("d", 1, 1)]
    assert held(spark, root, first.schema) == expected
    log = {r["fileName"]: (r["rows"], r["Time_st"], r["load"]) for r in sinks.manifest(spark, root).collect()}
    assert log == {"a": (1, 7, "two"), "b": (1, 1, "one"), "c": (0, None, "two"), "d": (1, 1, "two")}
    # The emptied file is done with: nothing is left to load, and no version is added.
    version = sinks.manifest(spark, root).first()["version"]
    sinks.reload_changed_files(rows_of(spark, a=[(0, 0)]), now, root, "us", "three")
    assert held(spark, root, first.schema) == expected and sinks.manifest(spark, root).first()["version"] == version


def test_a_load_broken_off_between_data_and_manifest(spark, monkeypatch):
    root = folder(spark, "table")
    sinks.create_table(spark, root)
    sinks.reload_changed_files(rows_of(spark, a=[(1, 1)]), listing(spark, a=1), root, "us", "one")
    fresh = rows_of(spark, a=[(2, 2)], b=[(3, 3)])

    def stop(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(sinks, "_write_manifest", stop)
        with pytest.raises(KeyboardInterrupt):
            sinks.reload_changed_files(fresh, listing(spark, a=2, b=2), root, "us", "two")
    assert held(spark, root, fresh.schema) == [("a", 1, 1)]
    for _ in range(2):
        sinks.reload_changed_files(fresh, listing(spark, a=2, b=2), root, "us", "two")
        assert held(spark, root, fresh.schema) == [("a", 2, 2), ("b", 3, 3)]


def test_two_loads_at_once_do_not_both_become_current(spark, monkeypatch):
    root = folder(spark, "table")
    sinks.create_table(spark, root)
    sinks.load_files(rows_of(spark, a=[(1, 1)]), listing(spark, a=1), root, "one", "us")
    monkeypatch.setattr(sinks, "_version", lambda *_: 0)
    with pytest.raises(Exception, match="(?i)exist"):
        sinks.load_files(rows_of(spark, a=[(2, 2)]), listing(spark, a=2), root, "two", "us")


def test_a_file_that_changes_after_the_stream_loaded_it(spark, tmp_path):
    schema = StructType.fromDDL("us bigint, v int")
    source, root = str(tmp_path / "in"), folder(spark, "ingest")

    def put(name, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "one"))
        part = next(f for f in os.listdir(tmp_path / "one") if f.endswith(".parquet"))
        os.makedirs(source, exist_ok=True)
        os.replace(tmp_path / "one" / part, f"{source}/{name}.parquet")

    def ingest():
        streams.stream_ingest(spark, source, schema, f"{root}/table", f"{root}/state", 1)

    wide = StructType([*schema.fields, StructField("fileName", StringType())])
    put("a", [(1, 1), (2, 1)])
    ingest()
    put("b", [(3, 3)])
    ingest()
    ingest()
    assert sorted(r["us"] for r in sinks.read_table(spark, f"{root}/table", wide).collect()) == [1, 2, 3]
    time.sleep(1.1)
    put("a", [(9, 9)])
    ingest()  # The stream has seen this file.
    files = spark.read.schema(schema).parquet(source).select("*", F.col("_metadata.file_path").alias("fileName"), F.col("_metadata.file_modification_time").alias("changed"))
    found = files.select("fileName", F.col("changed").alias("fileChangeTime")).distinct()
    sinks.reload_changed_files(files.drop("changed"), found, f"{root}/table", "us", "mend")
    assert sorted((r["us"], r["v"]) for r in sinks.read_table(spark, f"{root}/table", wide).collect()) == [(3, 3), (9, 9)]
    put("c", [(4, 4)])
    ingest()
    assert sorted(r["us"] for r in sinks.read_table(spark, f"{root}/table", wide).collect()) == [3, 4, 9]
