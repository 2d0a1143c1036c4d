"""Queries of readers and sinks: text built from the driver's tables and parsed back, and upkeep of the event table by day."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import files, loaders, ranges, sinks
from ..sources.series import events, table
from ..streaming.run import folder
from .filters import E, P, positions
from .registry import register
from .stats import DAY, HOUR


def event_text(spark, d):
    return events(spark, d).select("event_id", F.concat_ws(",", F.date_format("ts", "yyyy,M,d,H,m,s"), "device", F.format_string("%.2f", "value"), "kind").alias("line"))


@register("s02_read_delimited", f"select device as \"Dev\", us // 1000000 as time_s, round(value, 2) as value from {E}")
def s02(spark, d):
    from ..functions.times import from_fields

    path = folder(spark, "text")
    event_text(spark, d).select("line").write.text(path)
    time = from_fields(*[F.col(c) for c in ("yyyy", "mo", "dd", "HH", "mi", "SS")])
    df = files.read_delimited(spark, path, "yyyy(text),mo(text),dd(text),HH(text),mi(text),SS(text),Dev,value,,", time, {"Dev": "i8"})
    return df.select("Dev", F.unix_seconds("Time").alias("time_s"), "value")


@register("s03_expand_repeated_columns", "select vec_id, len(embedding) as n, round(embedding[10]::varchar::double, 6) as tenth from embeddings")
def s03(spark, d):
    e = table(spark, d, "embeddings").select(F.concat_ws(";", F.col("vec_id").cast("string"), F.transform("embedding", lambda x: x.cast("string"))).alias("line"))
    out = files.expand_repeated_columns(e, "line", ";", ["vec_id"], "T")
    return out.select(F.col("vec_id").cast("long").alias("vec_id"), F.size("T").cast("long").alias("n"), F.round(F.col("T")[9], 6).alias("tenth"))


@register("s04_repair_lines", f"select event_id, kind || ';' || round(value, 2)::varchar as line from (select event_id, kind, value from {E}) where event_id % 5 <> 0 and length(kind) > 4")
def s04(spark, d):
    df = events(spark, d).select("event_id", F.concat("kind", F.lit(" , "), F.regexp_replace(F.round("value", 2).cast("string"), r"^$", "")).alias("line"))
    df = df.withColumn("line", F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("#"), "line")).otherwise(F.col("line")))
    good, _ = files.repair_lines(df, "line", [(r" , ", ";")], drop="^#")
    return good.where(F.length(F.substring_index("line", ";", 1)) > 4)


@register(
    "s05_device_line_rules",
    f"select event_id, strftime(ts, '%Y,%-m,%-d,%-H,%-M,%-S') || ',1,2,3,' || printf('%.2f', value) as line from {E} union all select event_id, '2024,1,1,0,0,0,1,2,3,5.00' from {E} where event_id % 10 = 0",
)
def s05(spark, d):
    df = events(spark, d).select("event_id", F.concat(F.date_format("ts", "yyyy,M,d,H,m,s"), F.lit(",1,2,3,"), F.format_string("%.2f", "value"), F.when(F.col("event_id") % 10 == 0, "2024,1,1,0,0,0,1,2,3,5.00").otherwise("")).alias("line"))
    return files.device_line_rules(df, "line", "inclinometer_text")[0]


@register("s10_read_tracker_messages", f"select event_id as time_s, round(lat, 4) as \"Lat\", (device % 100)::int as \"n_GPS\" from {P}")
def s10(spark, d):
    p = positions(events(spark, d))
    def value(c):
        return F.regexp_replace(c, r"\.", ",")

    one = F.struct(F.lit(1).alias("i"), F.array(F.struct(F.col("event_id").alias("r"), F.lit(0).alias("s"), F.array(value(F.round("lat", 4).cast("string"))).alias("p"))).alias("p"))
    two = F.struct(F.lit(2).alias("i"), F.array(F.struct(F.col("event_id").alias("r"), F.lit(0).alias("s"), F.array((F.col("device") % 100).cast("string")).alias("p"))).alias("p"))
    messages = p.select(F.to_json(F.array(one, two)).alias("json"))
    return files.read_tracker_messages(messages, "json", {1: {"Lat": "double"}, 2: {"n_GPS": "int"}})


@register("s11_parse_position_texts", f"select event_id, case when event_id % 3 < 2 then round(lat, 4) end as lat, case when event_id % 3 < 2 then round(value, 1) end as speed, case when event_id % 3 < 2 then us // 60000000 * 60 end as time_s from {P}")
def s11(spark, d):
    p = positions(events(spark, d))
    num = lambda c, n: F.round(c, n).cast("string")
    time = F.date_format("ts", "yy/MM/dd HH:mm")
    sms = F.concat(F.lit("lat:"), num("lat", 4), F.lit(" long:"), num("lon", 4), F.lit(" speed:"), num("value", 1), F.lit(" dir:0.0\nT:"), time)
    other = F.concat(F.lit("Lat="), num("lat", 4), F.lit(",Lon="), num("lon", 4), F.lit(",V="), num("value", 1), F.lit(",C=0.0,"), time)
    text = F.when(F.col("event_id") % 3 == 0, sms).when(F.col("event_id") % 3 == 1, other).otherwise("call me")
    out = files.parse_position_texts(p.select("event_id", text.alias("text")), "text")
    return out.select("event_id", "lat", "speed", F.unix_seconds("Time").alias("time_s"))


@register("s12_cube_to_long", "select vec_id, t, y, x, round(embedding[t * 16 + y * 4 + x + 1]::double, 6) as v from embeddings, unnest(range(4)) as a(t), unnest(range(4)) as b(y), unnest(range(4)) as c(x)")
def s12(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", "embedding")
    four = F.sequence(F.lit(0), F.lit(3)).cast("array<bigint>")
    nested = F.transform(four, lambda t: F.transform(four, lambda y: F.transform(four, lambda x: F.get("embedding", (t * 16 + y * 4 + x).cast("int")))))
    one = e.select(F.transform(four, lambda t: F.struct(F.col("vec_id").alias("vec_id"), t.alias("t"))).alias("t"), four.alias("y"), four.alias("x"), nested.alias("v"))
    out = files.cube_to_long(one, ["t", "y", "x"], ["v"])
    return out.select("t.vec_id", "t.t", "y", "x", F.round(F.col("v").cast("double"), 6).alias("v"))


@register("s13_stack_profiles", "select p_size, p_brand as file, 10 + (dense_rank() over (order by p_brand) - 1) * 2.5 as x from part")
def s13(spark, d):
    return files.stack_profiles(table(spark, d, "part").select("p_size", F.col("p_brand").alias("file")), "file", 10, 2.5)


@register("s14_align_cell_blocks", "select vec_id, 20::int as n, round(embedding[1]::double, 6) as first, -32768.0 as last from embeddings where vec_id % 7 <> 0")
def s14(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", F.when(F.col("vec_id") % 7 == 0, F.array_repeat(F.lit(-32768.0), 9)).otherwise(F.slice("embedding", 1, 9).cast("array<double>")).alias("a"))
    out = files.align_cell_blocks(e, ["a"], 20)
    return out.select("vec_id", F.size("a").alias("n"), F.round(F.col("a")[0], 6).alias("first"), F.col("a")[19].alias("last"))


@register("s15_cells_to_long", "select vec_id, i::int as cell, round(embedding[i + 1]::double, 6) as \"Vabs\", round(embedding[i + 11]::double, 6) as \"Vdir\", 2 + 0.5 * i as \"Depth\" from embeddings, unnest(range(10)) as t(i) where embedding[i + 1] > -0.05")
def s15(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", F.slice("embedding", 1, 10).cast("array<double>").alias("a"), F.slice("embedding", 11, 10).cast("array<double>").alias("b"))
    out = files.cells_to_long(e, "a", "b", F.lit(2.0), F.lit(0.5), -0.05)
    return out.select("vec_id", "cell", F.round("Vabs", 6).alias("Vabs"), F.round("Vdir", 6).alias("Vdir"), "Depth")


@register("s16_group_files_by_cell_size", f"select kind as dz_m, count(*) as rows from {E} group by 1")
def s16(spark, d):
    path = folder(spark, "cells")
    sinks.group_files_by_cell_size(events(spark, d).withColumnRenamed("kind", "dz_m"), path)
    return spark.read.parquet(path).groupBy("dz_m").agg(F.count("*").alias("rows"))


@register("s17_write_intervals_text", f"select us // {DAY} as interval_id, event_id, round(value * 2, 6) as twice from {E} where us % {DAY} < {HOUR}")
def s17(spark, d):
    log = events(spark, d).select(F.expr(f"us div {DAY}").alias("interval_id")).distinct().withColumns({"Time_st": F.col("interval_id") * DAY, "Time_en": F.col("interval_id") * DAY + HOUR - 1})
    path = folder(spark, "intervals")
    sinks.write_intervals_text(events(spark, d), "us", log, "Time_st", "Time_en", ["event_id", "round(value * 2, 6) as twice"], path)
    return spark.read.schema("event_id bigint, twice double, interval_id bigint").option("sep", "\t").option("header", True).csv(path).select("interval_id", "event_id", "twice")


@register("s18_write_text", f"select event_id, round(value / 3, 3) as \"Pressure\" from {E}")
def s18(spark, d):
    path = folder(spark, "rounded")
    sinks.write_text(events(spark, d).select("event_id", (F.col("value") / 3).alias("Pressure")), path)
    return spark.read.schema("event_id bigint, Pressure double").option("sep", "\t").option("header", True).csv(path)


@register("s19_write_and_read_gpx", f"select device::varchar as track, us // {DAY} as segment, us // 1000000 as time_s, round(lat, 6) as lat, round(value, 2) as ele from {P}")
def s19(spark, d):
    """Waypoints are named by kind and a running number that up to 64 of them share: letters after a name grow with its repeats."""
    path = folder(spark, "gpx")
    p = positions(events(spark, d)).select(F.col("device").cast("string").alias("track"), F.expr(f"us div {DAY}").alias("segment"), F.col("ts").alias("Time"), F.round("lat", 6).alias("Lat"), F.col("lon").alias("Lon"), F.round("value", 2).alias("ele"), F.concat("kind", F.lit(" "), F.expr("event_id div 64")).alias("name"))
    sinks.write_gpx(p.select("name", "Time", "Lat", "Lon", "ele"), p, path)
    days = p.select("track", "segment").distinct()
    from pyspark.sql import Window

    days = days.withColumn("n", F.row_number().over(Window.partitionBy("track").orderBy("segment")) - 1)
    tracks = files.read_gpx(spark, f"{path}/tracks")["tracks"]
    return tracks.join(days.withColumnRenamed("segment", "day"), (tracks.track == days.track) & (tracks.segment == F.col("n"))).select(tracks.track, F.col("day").alias("segment"), F.unix_seconds("Time").alias("time_s"), F.col("Lat").alias("lat"), "ele")


def by_day(spark, d):
    return events(spark, d).select("event_id", "us", "value", F.concat(F.lit("day"), F.expr(f"us div {DAY}")).alias("fileName"))


_DAYS = f"(select *, 'day' || (us // {DAY}) as file from {E})"


@register("s20_append_with_log", f"select file as \"fileName\", min(us) as \"Time_st\", max(us) as \"Time_en\", count(*) as rows, max(us) // 1000 as \"fileChangeTime\" from {_DAYS} group by 1")
def s20(spark, d):
    root = folder(spark, "append")
    for half in (0, 1):
        part = by_day(spark, d).where(f"us div {DAY} % 2 = {half}").withColumn("changed", F.expr("us div 1000"))
        sinks.append_with_log(part, "fileName", "us", f"{root}/data", f"{root}/log", ["fileName"], "changed")
    return spark.read.parquet(f"{root}/log")


_CHANGED = f"select event_id, case when (us // {DAY}) % 4 = 1 then value else value + 100 end as value from {_DAYS}"


def _changed_files(spark, d):
    """What is stored (odd days), the listing, the log (every second of these days has the newer change time) and fresh rows."""
    fresh = by_day(spark, d).withColumn("value", F.col("value") + 100)
    listing = fresh.select("fileName", F.lit(200).alias("fileChangeTime")).distinct()
    stored = by_day(spark, d).where(f"us div {DAY} % 2 = 1")
    return stored.withColumn("changed", F.when(F.expr(f"us div {DAY} % 4 = 1"), 200).otherwise(100)), listing, fresh


@register("s21_incremental_ingest", _CHANGED)
def s21(spark, d):
    stored, listing, fresh = _changed_files(spark, d)
    log = stored.select("fileName", F.col("changed").alias("fileChangeTime")).distinct()
    return sinks.incremental_ingest(stored.drop("changed"), listing, log, fresh).select("event_id", "value")


@register("s21b_reload_changed_files", f"{_CHANGED} where (us // {DAY}) % 8 <> 7")
def s21b(spark, d):
    """Every eighth day's file is empty by now, so its old rows go."""
    root = folder(spark, "reload")
    stored, listing, fresh = _changed_files(spark, d)
    fresh = fresh.where(f"us div {DAY} % 8 <> 7")
    sinks.create_table(spark, root)
    sinks.load_files(stored.drop("changed"), stored.select("fileName", F.col("changed").alias("fileChangeTime")).distinct(), root, "first", "us")
    for load in ("again", "idle"):  # The second time nothing is left to load.
        sinks.reload_changed_files(fresh, listing, root, "us", load)
    return sinks.read_table(spark, root, fresh.schema).select("event_id", "value")


@register("s22_replace_from_time", f"select event_id, case when us >= f then -value else value end as value from {E} join (select device, min(us) as f from {E} where us >= 1705276800000000 group by device) using (device) union all select event_id, value from {E} where device not in (select device from {E} where us >= 1705276800000000)")
def s22(spark, d):
    df = events(spark, d).select("device", "event_id", "us", "value")
    fresh = df.where("us >= 1705276800000000").withColumn("value", -F.col("value"))
    return sinks.replace_from_time(df, fresh, ["device"], "us").select("event_id", "value")


@register("s23_older_rows", f"select event_id from {E} where us // {DAY} <= 19740")
def s23(spark, d):
    return sinks.older_rows(events(spark, d).withColumn("us", F.expr(f"us div {DAY}")), ["kind"], "us", 19740).select("event_id")


@register("s24_sorted_compact_write", f"select device, true as monotonic from {E} group by 1")
def s24(spark, d):
    path = folder(spark, "sorted")
    sinks.sorted_compact_write(events(spark, d).select("device", "us", "event_id"), ["device"], "us", path, 4)
    return sinks.is_sorted(spark.read.parquet(path), ["device"], "us", "event_id")


@register("s25_align_schema_append", f"select event_id, value, null as extra from {E} where event_id % 2 = 0 union all select event_id, value, kind from {E} where event_id % 2 = 1")
def s25(spark, d):
    df = events(spark, d)
    return sinks.align_schema_append(df.where("event_id % 2 = 0").select("event_id", "value"), df.where("event_id % 2 = 1").select(F.col("event_id").cast("string").alias("event_id"), F.col("value").cast("string").alias("value"), F.col("kind").alias("extra")))


@register("s27_find_tables", f"select event_id from {E} where regexp_matches(kind, '^(cl|vi)')")
def s27(spark, d):
    return files.find_tables(events(spark, d), "kind", "^(cl|vi)").select("event_id")


@register("s28_infer_column_types", f"with v as (select event_id::varchar as id, round(value, 2)::varchar as x, kind as k, case when event_id % 2 = 0 then (device % 100)::varchar else '' end as d from {E}) select 'id' as name, case when max(id::bigint) <= 32767 then 'smallint' else 'int' end as type, max(length(id))::int as width, 0::bigint as nulls from v union all select 'x', 'double', max(length(x))::int, 0 from v union all select 'k', 'string', max(length(k))::int, 0 from v union all select 'd', 'tinyint', max(length(d))::int, count(*) filter (d = '') from v")
def s28(spark, d):
    df = events(spark, d).select(F.col("event_id").cast("string").alias("id"), F.round("value", 2).cast("string").alias("x"), F.col("kind").alias("k"), F.when(F.col("event_id") % 2 == 0, (F.col("device") % 100).cast("string")).otherwise("").alias("d"))
    return files.infer_column_types(df, ["id", "x", "k", "d"]).drop("distinct")


@register("s29_coerce_to_type", f"select event_id, case when event_id % 11 = 0 or event_id * 7 >= 32767 then -1 else event_id * 7 end::smallint as v from {E}")
def s29(spark, d):
    df = events(spark, d).select("event_id", F.when(F.col("event_id") % 11 == 0, "bad").otherwise((F.col("event_id") * 7).cast("string")).alias("v"))
    return files.coerce_to_type(df, "v", "smallint")


@register("s30_coefficients_table", f"select x.event_id, c.k as k from {E} x asof left join (select device, us, event_id as k from {E} where kind = 'error') c on x.device = c.device and x.us >= c.us")
def s30(spark, d):
    df = events(spark, d)
    coefs = df.where("kind = 'error'").select("device", "us", F.array(F.array("event_id")).alias("Ag"))
    return files.coefficients_for(df.select("event_id", "device", "us"), coefs, ["device"], "us", ["Ag"]).select("event_id", F.col("Ag")[0][0].alias("k"))


_COEF = f"(select device, us, event_id / 10e0 as k from {E} where kind = 'error')"


@register(
    "s30b_coefficients_upkeep",
    f"""with old as {_COEF}, fresh as (select device, us, max(k) + 1 as k from old where device % 2 = 0 group by device, us), held as (select * from old where (device, us) not in (select device, us from fresh) union all select * from fresh),
    moved as (select c.device + 100000 as device, c.us, c.k from (select device, max(us) as us, arg_max(k, us) as k from held group by device) c where c.device % 3 = 0)
    select device, us, round(k * cos(radians(30)), 6) as a, round(k * sin(radians(30)), 6) as b, round(k, 6) as c from (select * from held union all select * from moved)""",
)
def s30b(spark, d):
    """Fresh matrices of even devices replace those of the same time (those of device 1 are no numbers), others are copied, all turned by 30 degrees."""
    df = events(spark, d).where("kind = 'error'")
    k, none = F.col("event_id") / 10.0, F.lit(0.0)
    matrix = lambda x: F.array(F.array(x, none, none), F.array(none, x, none), F.array(none, none, x))
    old = df.select("device", "us", matrix(k).alias("Ag"))
    fresh = df.where("device % 2 = 0 or device = 1").select("device", "us", matrix(F.when(F.col("device") == 1, F.lit(float("nan"))).otherwise(k + 1)).alias("Ag"))
    held, _ = files.save_coefficients(old, fresh, ["device"], "us", {"Ag": 2})
    last = held.where("device % 3 = 0").groupBy("device").agg(F.max("us").alias("us")).select(F.col("device").alias("source"), (F.col("device") + 100000).alias("target"), "us")
    every = held.unionByName(files.copy_coefficients(held, last, "device", "us"))
    out = files.rotate_coefficients(every, ["Ag"], "z", F.radians(F.lit(30.0)))
    return out.select("device", "us", *[F.round(F.col("Ag")[i][j], 6).alias(n) for n, i, j in (("a", 0, 0), ("b", 1, 0), ("c", 2, 2))])


@register("s31_list_source_files", f"select 'day=' || (us // {DAY}) as day, count(*)::int as rows from {E} where us // {DAY} % 7 <> 0 group by 1")
def s31(spark, d):
    path = folder(spark, "listed")
    days = events(spark, d).groupBy(F.expr(f"us div {DAY}").alias("day")).agg(F.array_join(F.collect_list(F.col("event_id").cast("string")), "\n").alias("value"))
    days.repartition("day").write.partitionBy("day").text(path)
    found = files.list_source_files(spark, path, "*.txt").where(F.regexp_extract("path", r"day=(\d+)", 1).cast("long") % 7 != 0)
    text = spark.read.text(path).groupBy(F.concat(F.lit("day="), "day").alias("day")).agg(F.count("*").cast("int").alias("rows"))
    return found.select(F.element_at(F.split("path", "/"), -2).alias("day")).join(text, "day")




@register(
    "s08_read_nmea",
    f"""with p as (select event_id, us // 1000000 as t, floor(lat) + round((lat - floor(lat)) * 60, 4) / 60 as lat, round(value, 1) as speed from {P}),
    r as (select *, row_number() over (partition by t order by event_id desc) as k, max(case when event_id % 3 = 0 then round(event_id / 10.0, 1) end) over (partition by t) as dep from p)
    select t as time_s, round(lat, 6) as "Lat", speed as "Speed", dep as "DepEcho" from r where k = 1""",
)
def s08(spark, d):
    path = folder(spark, "nmea")
    p = positions(events(spark, d))
    def ddmm(c, width):
        return F.concat(F.lpad(F.floor(c).cast("string"), width, "0"), F.format_string("%07.4f", (F.col(c) - F.floor(c)) * 60))

    rmc = F.concat(F.lit("$GPRMC,"), F.date_format("ts", "HHmmss"), F.lit(",A,"), ddmm("lat", 2), F.lit(",N,"), ddmm("lon", 3), F.lit(",E,"), F.round("value", 1).cast("string"), F.lit(",0.0,"), F.date_format("ts", "ddMMyy"), F.lit(",,*00"))
    deep = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("$SDDBT,0,f,"), F.round(F.col("event_id") / 10, 1).cast("string"), F.lit(",M,0,F*00")))
    text = F.concat_ws("\n", rmc, deep)
    # A file per day of events, its lines in order of time.
    days = p.groupBy(F.expr(f"us div {DAY}").alias("day")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("us", text.alias("line")))), lambda x: x["line"]), "\n").alias("value"))
    days.repartition("day").write.partitionBy("day").option("lineSep", "\n").text(path)
    out = files.read_nmea(spark, path)
    return out.select(F.unix_seconds("Time").alias("time_s"), F.round("Lat", 6).alias("Lat"), "Speed", "DepEcho")


@register("s01_header_schema", f"select device::smallint as device, us // 1000000 as t, value::float as value from {E}")
def s01(spark, d):
    path = folder(spark, "typed")
    events(spark, d).select(F.concat_ws(",", "device", F.expr("us div 1000000"), F.lit("skipped"), F.col("value").cast("string"))).write.text(path)
    schema, used, _ = files.header_schema("device,t,,value", {"device": "i2", "t": "i8", "value": "f4"})
    return spark.read.schema(schema).csv(path).select(*used)


@register("s06_read_zip_members", f"select 'day' || (us // {DAY}) || '.zip' as archive, 'a.csv' as member, row_number() over (partition by us // {DAY} order by us) as line_no, event_id || ',' || kind as line from {E}")
def s06(spark, d):
    path = folder(spark, "zip")

    def packed(batches):
        import io
        import zipfile

        for batch in batches:
            for name, text in zip(batch["name"], batch["text"], strict=True):
                with zipfile.ZipFile(out := io.BytesIO(), "w", zipfile.ZIP_DEFLATED) as archive:
                    archive.writestr("a.log", "left out")
                    archive.writestr("a.csv", text)
                ranges.write_bytes(f"{path}/{name}", out.getvalue())
            yield batch[["name"]]

    lines = events(spark, d).groupBy(F.expr(f"concat('day', us div {DAY}, '.zip')").alias("name")).agg(F.array_sort(F.collect_list(F.struct("us", F.concat_ws(",", "event_id", "kind").alias("line")))).alias("l"))
    lines.select("name", F.array_join(F.transform("l", lambda x: x["line"]), "\n").alias("text")).mapInPandas(packed, "name string").count()
    return files.read_zip_members(spark, path, range_bytes=4096).withColumn("archive", F.substring_index("archive", "/", -1))


@register("s07_read_gpx", f"select event_id::varchar as name, us // 1000000 as time_s, round(lat, 6) as lat, round(lon, 6) as lon from {P}")
def s07(spark, d):
    path = folder(spark, "waypoints")
    p = positions(events(spark, d))
    points = p.select(F.col("event_id").cast("string").alias("name"), F.col("ts").alias("Time"), F.col("lat").alias("Lat"), F.col("lon").alias("Lon"))
    sinks.write_gpx(points, points.select(F.col("name").alias("track"), F.lit(0).alias("segment"), "Time", "Lat", "Lon"), path)
    out = files.read_gpx(spark, f"{path}/waypoints")["waypoints"]
    return out.select("name", F.unix_seconds("Time").alias("time_s"), F.round("Lat", 6).alias("lat"), F.round("Lon", 6).alias("lon"))


@register("s09_read_framed_binary", f"select 'kind ' || kind as file, row_number() over (partition by kind order by us) - 1 as frame, event_id % 20000 as a, device::bigint as b, floor(value)::bigint as c from {E}")
def s09(spark, d):
    """A file of frames for each kind, with a byte of noise behind each, read in ranges of 4 kB."""
    def little(c):
        return F.concat(F.substring(F.lpad(F.hex(c), 4, "0"), 3, 2), F.substring(F.lpad(F.hex(c), 4, "0"), 1, 2))

    path = folder(spark, "frames")
    frame = F.concat(F.lit("FF7FFF7F"), *[little(c.cast("bigint")) for c in (F.col("event_id") % 20000, F.col("device") % 32768, F.expr("device div 32768"), F.floor("value"))])
    frames = events(spark, d).select("kind", "us", F.unhex(frame).cast("string").alias("value"))
    frames.repartition("kind").sortWithinPartitions("kind", "us").select("kind", "value").write.partitionBy("kind").text(path)
    out = files.read_framed_binary(spark, path, b"\xff\x7f\xff\x7f", ["a", "low", "high", "c"], range_bytes=4096)
    return out.withColumn("file", F.concat(F.lit("kind "), F.regexp_extract("file", "kind=([^/]*)", 1))).select("file", "frame", "a", (F.col("high").cast("long") * 32768 + F.col("low")).alias("b"), "c")


@register("s32_loader_plugin", f"select us // 1000000 as time_s, device::double as \"P\", round(value, 2) as \"Temp\", (event_id % 1000)::double as \"Cond\" from {E} where event_id % 7 <> 0")
def s32(spark, d):
    """Logger text of every event, read by the loader that a configuration's name ends with; every seventh line has no time."""
    path = folder(spark, "logger")
    time = F.when(F.col("event_id") % 7 == 0, "no time").otherwise(F.date_format("ts", "dd/MM/yyyy HH:mm:ss.SSS"))
    events(spark, d).select(F.concat_ws(";", time, "device", F.format_string("%.2f", "value"), F.col("event_id") % 1000)).write.text(path)
    return loaders.read(spark, path, "csv_CTD_IdrRedas#2", range_bytes=1 << 16).select(F.unix_seconds("Time").alias("time_s"), "P", "Temp", "Cond")


@register("s32b_loader_inclinometer", f"select event_id::double as \"Ax\", us // 1000000 as time_s, device::double as \"Battery\", round(value, 2) as \"Temp\" from {E}")
def s32b(spark, d):
    """The loader's own format, on lines of which every fifth holds two records glued together."""
    path = folder(spark, "glued")
    line = F.concat(F.date_format("ts", "yyyy,M,d,H,m,s"), F.lit(","), F.col("event_id"), F.lit(",1,2,3,4,5,"), F.col("device"), F.lit(","), F.format_string("%.2f", "value"))
    twos = events(spark, d).select(F.expr("if(event_id % 5 = 1, event_id - 1, event_id)").alias("n"), "event_id", line.alias("line"))
    twos.groupBy("n").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "line"))), lambda x: x["line"]), "").alias("line")).select("line").write.text(path)
    loaders.register(spark, "inclinometer")
    return spark.read.format("inclinometer").option("rangeBytes", 1 << 16).load(path).select("Ax", F.unix_seconds("Time").alias("time_s"), "Battery", "Temp")
