"""Sinks and table upkeep (S16-S26): interval text, rounded text, GPX, appends with a log, replacement by time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

#: Decimals of columns in text (fixed values).
TEXT_DIGITS = {"Vdir": 4, "inclination": 4, "Pressure": 3}


def group_files_by_cell_size(df: DataFrame, path: str, column: str = "dz_m") -> None:
    """Rows of files with one cell size go to one partition."""
    df.repartition(column).write.mode("overwrite").partitionBy(column).parquet(path)


def interval_rows(df: DataFrame, us: str, log: DataFrame, begin: str, end: str, expressions: list[str]) -> DataFrame:
    """Rows of each log interval with the expressions asked for; the log names intervals by interval_id."""
    from ..operators.joins import bucketed_intervals

    return bucketed_intervals(df, us, log, begin, end, []).selectExpr("interval_id", *expressions)


def write_intervals_text(df: DataFrame, us: str, log: DataFrame, begin: str, end: str, expressions: list[str], path: str) -> None:
    """A folder of text files for each interval."""
    rows = interval_rows(df, us, log, begin, end, expressions)
    rows.repartition("interval_id").write.mode("overwrite").partitionBy("interval_id").option("sep", "\t").option("header", True).csv(path)


def rounded_text(df: DataFrame, digits: dict[str, int] | None = None) -> DataFrame:
    """Float columns rounded as text shows them."""
    digits = TEXT_DIGITS if digits is None else digits
    return df.withColumns({c: F.round(c, n) for c, n in digits.items() if c in df.columns})


def write_text(df: DataFrame, path: str, mode: str = "ignore", digits: dict[str, int] | None = None, by: list[str] | None = None) -> None:
    """Tab-separated text, by partition if asked for; by default an existing output is left alone."""
    writer = rounded_text(df, digits).write.mode(mode).option("sep", "\t").option("header", True)
    (writer.partitionBy(*by) if by else writer).csv(path)


def unique_names(points: DataFrame, name: str, order: str) -> DataFrame:
    """A repeated name gets a letter after it: A for the second, B for the third; after Z the letters are doubled."""
    n = F.row_number().over(Window.partitionBy(name).orderBy(order)) - 2
    letters = F.repeat(F.char(65 + n % 26), (1 + F.floor(n / 26)).cast("int"))
    return points.withColumn(name, F.when(n < 0, F.col(name)).otherwise(F.concat(name, letters)))


def write_gpx(waypoints: DataFrame, tracks: DataFrame, path: str) -> None:
    """Waypoints (name, Time, Lat, Lon) and tracks (track, segment, Time, Lat, Lon) as GPX elements, a file per element kind.

    A column ele of either becomes the elevation of its points.
    """

    def point(df: DataFrame, extra: list) -> list:
        height = [F.col("ele")] if "ele" in df.columns else []
        return [F.col("Lat").alias("_lat"), F.col("Lon").alias("_lon"), *height, F.date_format("Time", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("time"), *extra]

    unique_names(waypoints, "name", "Time").select(*point(waypoints, [F.col("name")])).write.mode("overwrite").format("xml").option("rowTag", "wpt").option("rootTag", "gpx").save(f"{path}/waypoints")
    seg = tracks.groupBy("track", "segment").agg(F.array_sort(F.collect_list(F.struct(F.col("Time").alias("_order"), *point(tracks, [])))).alias("p"))
    seg = seg.withColumn("trkpt", F.transform("p", lambda x: x.dropFields("_order")))
    trk = seg.groupBy("track").agg(F.array_sort(F.collect_list(F.struct("segment", "trkpt"))).alias("s"))
    trk = trk.select(F.col("track").alias("name"), F.transform("s", lambda x: x.dropFields("segment")).alias("trkseg"))
    trk.write.mode("overwrite").format("xml").option("rowTag", "trk").option("rootTag", "gpx").save(f"{path}/tracks")


def file_log(df: DataFrame, file: str, us: str, changed: str | None = None) -> DataFrame:
    """One log row per file: start, end, rows and change time (of a column, null without one)."""
    when = F.max(changed) if changed else F.lit(None).cast("timestamp")
    return df.groupBy(F.col(file).alias("fileName")).agg(F.min(us).alias("Time_st"), F.max(us).alias("Time_en"), F.count("*").alias("rows"), when.alias("fileChangeTime"))


def append_with_log(df: DataFrame, file: str, us: str, table: str, log: str, by: list[str], changed: str | None = None) -> None:
    """Append rows, partitioned, and their log rows; `changed`, the change time of a row's file, goes to the log only."""
    (df.drop(changed) if changed else df).write.mode("append").partitionBy(*by).parquet(table)
    file_log(df, file, us, changed).write.mode("append").parquet(log)


def files_to_load(listing: DataFrame, log: DataFrame) -> DataFrame:
    """Files (fileName, fileChangeTime) that the log lacks or has with an earlier change time."""
    done = log.select("fileName", F.col("fileChangeTime").alias("_done"))
    return listing.join(done, (listing.fileName == done.fileName) & (F.col("_done") >= F.col("fileChangeTime")), "left_anti")


#: A row for each source file: the load that holds its rows, its change time, and the log of S20.
_MANIFEST = "fileName string, load string, fileChangeTime timestamp, Time_st bigint, Time_en bigint, rows bigint"


def create_table(spark: SparkSession, root: str) -> None:
    """An empty table at a folder, unless there is one.

    Rows lie in data/load=<name>, a folder for each load, which nobody sees by itself.  The files of a load become current when
    a new version of the manifest names them; a version is one file, put in its place by one rename.  So a load replaces or
    empties any number of files at once, and one that is broken off is never half seen; run again, it begins anew.
    """
    _write_manifest(spark.createDataFrame([], _MANIFEST), root, 0, "ignore")


def _write_manifest(rows: DataFrame, root: str, version: int, mode: str) -> None:
    rows.coalesce(1).write.mode(mode).parquet(f"{root}/manifest/version={version}")


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """The current manifest of a table, with its version."""
    every = spark.read.schema(f"{_MANIFEST}, version bigint").parquet(f"{root}/manifest")
    # Files of a version that is still being written are not among them, and version 0 has no rows but is there.
    version = every.select("version").agg(F.max("version")).first()[0] or 0
    return every.where(F.col("version") == version).withColumn("version", F.lit(version).cast("bigint"))


def _version(spark: SparkSession, root: str) -> int:
    return manifest(spark, root).agg(F.max("version")).first()[0] or 0


def load_files(rows: DataFrame, files: DataFrame, root: str, load: str, us: str, file: str = "fileName") -> None:
    """Rows of some files become the current rows of these files, in place of any before.

    files: fileName and fileChangeTime of all of them, also of those without rows.  load: a name that the same load has when
    it is run again; its folder is written over.
    """
    spark = rows.sparkSession
    path = f"{root}/data/load={load}"
    rows.write.mode("overwrite").parquet(path)
    held = spark.read.schema(rows.schema).parquet(path)
    log = file_log(held, file, us).drop("fileChangeTime")
    fresh = files.select("fileName", F.col("fileChangeTime").cast("timestamp").alias("fileChangeTime")).distinct().join(log, "fileName", "left")
    fresh = fresh.select("fileName", F.lit(load).alias("load"), "fileChangeTime", "Time_st", "Time_en", F.coalesce("rows", F.lit(0)).alias("rows"))
    now = manifest(spark, root)
    version = _version(spark, root)
    kept = now.drop("version").join(fresh.select("fileName"), "fileName", "left_anti")
    _write_manifest(kept.unionByName(fresh), root, version + 1, "errorifexists")


def read_table(spark: SparkSession, root: str, schema: StructType, file: str = "fileName") -> DataFrame:
    """The current rows of a table; schema: that of the rows."""
    rows = spark.read.schema(StructType([*schema.fields, StructField("load", StringType())])).parquet(f"{root}/data")
    current = manifest(spark, root).where("rows > 0").select(F.col("fileName").alias(file), "load")
    return rows.join(current, [file, "load"], "left_semi").select(*schema.names)


def reload_changed_files(fresh: DataFrame, listing: DataFrame, root: str, us: str, load: str, file: str = "fileName") -> None:
    """Load the files of a listing (fileName, fileChangeTime) that are new or changed since the manifest, from fresh rows.

    A file that has no rows left is emptied.  Nothing is written if nothing has changed.
    """
    todo = files_to_load(listing.select("fileName", F.col("fileChangeTime").cast("timestamp").alias("fileChangeTime")), manifest(fresh.sparkSession, root))
    if not todo.isEmpty():
        load_files(fresh.join(todo.select(F.col("fileName").alias(file)).distinct(), file, "left_semi"), todo, root, load, us, file)


def incremental_ingest(stored: DataFrame, listing: DataFrame, log: DataFrame, fresh: DataFrame, file: str = "fileName") -> DataFrame:
    """What the table holds after changed files are loaded again: their old rows go, their new ones (in fresh) come."""
    todo = files_to_load(listing, log).select(F.col("fileName").alias(file)).distinct()
    return stored.join(todo, file, "left_anti").unionByName(fresh.join(todo, file, "left_semi"))


def replace_from_time(stored: DataFrame, fresh: DataFrame, keys: list[str], us: str) -> DataFrame:
    """New data wins: rows of a key at or after its first new time are replaced."""
    first = fresh.groupBy(*keys).agg(F.min(us).alias("_first"))
    old = stored.join(first, keys, "left").where(F.col("_first").isNull() | (F.col(us) < F.col("_first"))).drop("_first")
    return old.unionByName(fresh)


def shorten_log(log: DataFrame, fresh: DataFrame, keys: list[str], us: str) -> DataFrame:
    """Log rows end before the first new time; those that begin after it go."""
    first = fresh.groupBy(*keys).agg(F.min(us).alias("_first"))
    held = log.join(first, keys, "left").where(F.col("_first").isNull() | (F.col("Time_st") < F.col("_first")))
    return held.withColumn("Time_en", F.when(F.col("Time_en") >= F.col("_first"), F.col("_first") - 1).otherwise(F.col("Time_en"))).drop("_first")


def older_rows(df: DataFrame, keys: list[str], us: str, limit_us: int) -> DataFrame:
    """Rows before the limit; where the limit itself occurs more than once, rows up to the last of it count as older."""
    return df.withColumn("_n", F.count_if(F.col(us) == limit_us).over(Window.partitionBy(*keys))).where((F.col(us) < limit_us) | ((F.col("_n") > 1) & (F.col(us) == limit_us))).drop("_n")


def sorted_compact_write(df: DataFrame, keys: list[str], us: str, path: str, files: int | None = None) -> None:
    """Files sorted by key and time, so scans of a time range skip most of them."""
    order = [*keys, us]
    dealt = df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)
    dealt.sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def is_sorted(df: DataFrame, keys: list[str], us: str, order: str) -> DataFrame:
    """Per key, whether times never decrease in the order of rows."""
    step = F.col(us) - F.lag(us).over(Window.partitionBy(*keys).orderBy(order))
    return df.select(*keys, step.alias("_d")).groupBy(*keys).agg((F.count_if(F.col("_d") < 0) == 0).alias("monotonic"))


def align_schema_append(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Rows of both, new columns added to the old and missing ones to the new, types those of the table."""
    kinds = {f.name: f.dataType for f in stored.schema}
    cast = fresh.select(*[F.col(c).try_cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in fresh.columns])
    return stored.unionByName(cast, allowMissingColumns=True)


def current_tables(spark: SparkSession, pattern: str) -> list[str]:
    """Names of the session's tables by a pattern."""
    import re

    return [t.name for t in spark.catalog.listTables() if re.search(pattern, t.name)]
