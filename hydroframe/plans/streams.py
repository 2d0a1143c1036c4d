"""Queries of the streaming operators; the SQL is that of the batch operator on the same rows.

Bins, intervals and bursts are read in append mode, each once, when the watermark has passed it and its state is gone.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..sources import sinks
from ..sources.series import micros, table
from ..streaming import streams
from ..streaming.run import drain, folder
from .filters import E
from .registry import register
from .stats import DAY, HOUR, rounded
from .windows import _despike_sql

_TIMED = f"(select device, us as event_id, value, row_number() over (partition by device order by us) - 1 as i, count(*) over (partition by device) as n from {E})"


def feed(spark, d, files=4):
    """The events as a stream of several files in order of time, with ts, us, device, kind and value."""
    path = folder(spark, "feed")
    df = table(spark, d, "events").select("event_id", F.col("user_id").alias("device"), F.col("event_type").alias("kind"), F.col("ts").cast("timestamp").alias("ts"), micros("ts").alias("us"), "value")
    df.repartitionByRange(files, "us").write.parquet(path)
    return path, spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(path)


def in_order(spark, d, build, flush_days: int = 0, partitions: int | None = None):
    """Rows of a stream that is stopped and started again for each quarter of the time, so times come in order.

    With flush_days a last row of nulls comes so much later: the watermark passes all windows, and append mode gives them.
    """
    path, root = folder(spark, "feed"), folder(spark, "runs")
    df = table(spark, d, "events").select("event_id", F.col("user_id").alias("device"), F.col("event_type").alias("kind"), F.col("ts").cast("timestamp").alias("ts"), micros("ts").alias("us"), "value")
    edges = [None, *df.approxQuantile("us", [0.25, 0.5, 0.75], 0.01), None]
    parts = [df.where((F.col("us") >= low if low is not None else F.lit(True)) & (F.col("us") < high if high is not None else F.lit(True))) for low, high in zip(edges[:-1], edges[1:], strict=True)]
    if flush_days:
        end = df.agg((F.max("us") + flush_days * DAY).alias("us")).select("us", F.timestamp_micros("us").alias("ts"))
        parts.append(df.limit(0).unionByName(end, allowMissingColumns=True))
    for part in parts:
        part.write.mode("append").parquet(path)
        out = drain(build(spark.readStream.schema(df.schema).parquet(path)), root=root, partitions=partitions)
    return out


@register("t01_stream_ingest", f"select count(*) as rows, min(us) as start, max(us) as end, count(*) as logged from {E}")
def t01(spark, d):
    path, stream = feed(spark, d)
    root = folder(spark, "ingest")
    streams.stream_ingest(spark, path, stream.schema, f"{root}/table", f"{root}/state", 2)
    rows = sinks.read_table(spark, f"{root}/table", StructType([*stream.schema.fields, StructField("fileName", StringType())]))
    log = sinks.manifest(spark, f"{root}/table").agg(F.sum("rows").alias("logged"))
    return rows.agg(F.count("*").alias("rows"), F.min("us").alias("start"), F.max("us").alias("end")).crossJoin(log)


@register("t02_stream_bin_mean", f"select kind, us // {HOUR} * {HOUR} as bin, count(*) as rows, round(avg(value), 6) as value from {E} group by 1, 2")
def t02(spark, d):
    return rounded(in_order(spark, d, lambda stream: streams.stream_bin_mean(stream, ["kind"], "ts", "1 hour", "2 days", ["value"]), 30))


@register("t02b_stream_centred_bin_mean", f"select kind, (us + {HOUR // 2}) // {HOUR} * {HOUR} as bin, count(*) as rows, round(avg(value), 6) as value from {E} group by 1, 2")
def t02b(spark, d):
    return rounded(in_order(spark, d, lambda stream: streams.stream_bin_mean(stream, ["kind"], "ts", "1 hour", "2 days", ["value"], "30 minutes"), 30))


@register("t03_stream_sliding", f"select kind, i * {DAY // 4} as interval_start, count(*) as rows, round(avg(value), 6) as value from {E}, unnest(range(floor((us - {DAY}) / {DAY // 4})::bigint + 1, us // {DAY // 4} + 1)) as t(i) group by 1, 2")
def t03(spark, d):
    return rounded(in_order(spark, d, lambda stream: streams.stream_sliding(stream, ["kind"], "ts", "1 day", "6 hours", "2 days", ["value"]), 30))


@register(
    "t04_stream_bursts",
    f"""with g as (select device, us, coalesce(us - lag(us) over (partition by device order by us), 0) as gap from {E}), b as (select *, sum((gap > {DAY // 2})::int) over (partition by device order by us) as b from g)
    select device, min(us) as begin, max(us) as end, count(*) as rows from b group by device, b""",
)
def t04(spark, d):
    return in_order(spark, d, lambda stream: streams.stream_bursts(stream, ["device"], "ts", "12 hours", "2 days"), 30)


@register("t05_late_rows_replace", f"select event_id, us, case when us >= 1705276800000000 then value + 1000 else value end as value from {E}")
def t05(spark, d):
    """All events come in one file, then those from a time on once more with other values; the stream is stopped in between."""
    path, root = folder(spark, "feed"), folder(spark, "replace")
    df = table(spark, d, "events").select("event_id", micros("ts").alias("us"), "value")
    save = streams.replace_from_batch(root, "us")
    for part in (df, df.where("us >= 1705276800000000").withColumn("value", F.col("value") + 1000)):
        part.write.mode("append").parquet(path)
        stream = spark.readStream.schema(df.schema).parquet(path)
        stream.writeStream.foreachBatch(save).option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start().awaitTermination()
    return streams.replaced(spark, root, df.schema, "us")


@register("t06_stream_dedup", f"select device, us // {DAY} as day from {E} group by 1, 2")
def t06(spark, d):
    stream = feed(spark, d)[1].withColumn("ts", F.date_trunc("day", "ts")).select("device", "ts")
    return drain(streams.stream_dedup(stream, ["device"], "ts", "60 days")).select("device", F.expr(f"unix_micros(ts) div {DAY}").alias("day"))


@register("t07_stream_holes", f"select * from (select device, us as start, lead(us) over (partition by device order by us) - us as size from {E}) where size > {2 * DAY}")
def t07(spark, d):
    """Gaps that have an end; open ones come with a null size."""
    out = in_order(spark, d, lambda stream: streams.stream_holes(stream, "device", "ts", "us", 2 * DAY, "2 days", 400 * DAY), 30, streams.PARTITIONS)
    return out.where("size is not null")


@register(
    "t08_stream_despike",
    f"""with a as (select device, us, value, value - lag(value) over w as b, value - lead(value) over w as a from {E} window w as (partition by device order by us))
    select device, us, value, (b is not null or a is not null) and (coalesce(b > 20, true) and coalesce(a > 20, true) or coalesce(b < -20, true) and coalesce(a < -20, true)) as spike from a where device is not null""",
)
def t08(spark, d):
    out = in_order(spark, d, lambda stream: streams.stream_spikes(stream, "device", "ts", "us", "value", 20.0, "2 days", 20 * DAY), 60, streams.PARTITIONS)
    return out.where("device is not null")


@register("t08b_stream_despike_blocks", f"select device, event_id as us, value as kept from {_despike_sql(_despike_sql(_TIMED, 1.5, 10), 2.0, 5)}")
def t08b(spark, d):
    out = in_order(spark, d, lambda stream: streams.stream_despike(stream, "device", "ts", "us", "value", [(1.5, 10), (2.0, 5)], "2 days", 400 * DAY), 900, streams.PARTITIONS)
    return out.select("device", "us", "kept")
