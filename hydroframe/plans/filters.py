"""Queries of the filter operators over the event series."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import filters
from ..sources.series import events, table
from .registry import register

#: Events as the SQL side sees them.
E = "(select event_id, user_id as device, event_type as kind, ts, epoch_us(ts) as us, value, props from events)"


@register("f01_filter_rows_minmax", f"select event_id, value from {E} where value > 5 and value < 20 and ts > timestamp '2024-01-05' and ts < timestamp '2024-01-20'")
def f01(spark, d):
    limits = {"min_Value": 5, "max_value": 20, "min_date": F.lit("2024-01-05").cast("timestamp"), "max_date": F.lit("2024-01-20").cast("timestamp"), "max_absent": 1}
    return filters.filter_rows_minmax(events(spark, d), limits, "ts").select("event_id", "value")


@register(
    "f02_filter_rows_logged",
    f"select device, count(*) filter (value > 5 and value < 20) as rows, count(*) filter (not (value > 5 and value < 20)) as rows_filtered, max(us) filter (value > 5 and value < 20) as last_time from {E} group by device",
)
def f02(spark, d):
    return filters.filter_rows_logged(events(spark, d), {"min_value": 5, "max_value": 20}, ["device"], "us")


@register("f03_null_outside_limits", f"select event_id, case when value > 6.55 and value < 30 then value end as value from {E}")
def f03(spark, d):
    return filters.null_outside_limits(events(spark, d), {"min_val.*": 6.55, "max_value": 30}).select("event_id", "value")


@register("f04_null_outside_limits_inclusive", f"select event_id, case when value >= 6.55 and value <= 30 then value end as value from {E}")
def f04(spark, d):
    return filters.null_outside_limits_inclusive(events(spark, d), {"min_val.*": 6.55, "max_value": 30}).select("event_id", "value")


@register(
    "f05_null_columns_by_file_name",
    f"select event_id, case when kind <> 'view' then value end as \"O2\", case when kind not in ('click', 'view') then value * 2 end as \"pH\" from {E}",
)
def f05(spark, d):
    df = events(spark, d).select("event_id", F.col("value").alias("O2"), (F.col("value") * 2).alias("pH"), F.concat(F.lit("/a-b/"), "kind", F.when(F.col("kind") == "view", "-no_Ox,pH").when(F.col("kind") == "click", "-no_pH").otherwise(""), F.lit(".csv")).alias("name"))
    return filters.null_columns_by_file_name(df, F.col("name"), ["O2", "pH"]).drop("name")


@filters.predicate("whole_even")
def whole_even(c):
    return F.floor(c) % 2 == 0


@register("f06_custom_predicate", f"select event_id, value from {E} where floor(value)::bigint % 2 = 0")
def f06(spark, d):
    return filters.custom_predicate(events(spark, d), {"value": "whole_even"}).select("event_id", "value")


@register("f07_computed_columns", f"select event_id, value + 100 as value, round(sqrt(value) + device, 6) as mixed from {E}")
def f07(spark, d):
    df = filters.computed_columns(events(spark, d), {"mixed": "round(sqrt(value) + device, 6)"}, {"value": 100})
    return df.select("event_id", "value", "mixed")


@register("f08_select_time_ranges", f"select event_id from {E} where ts between timestamp '2024-01-02' and timestamp '2024-01-03' or ts between timestamp '2024-01-10 12:00:00' and timestamp '2024-01-11'")
def f08(spark, d):
    t = [F.lit(x).cast("timestamp") for x in ("2024-01-02", "2024-01-03", "2024-01-10 12:00:00", "2024-01-11")]
    return filters.select_time_ranges(events(spark, d), "ts", [(t[0], t[1]), (t[2], t[3])]).select("event_id")


def day_spans(spark, d):
    """An interval per device: from its first purchase to three days after."""
    df = events(spark, d).where("kind = 'purchase'").groupBy("device").agg(F.min("us").alias("Time_st"))
    return df.withColumn("Time_en", F.col("Time_st") + 3 * 86_400_000_000)


_SPANS = f"(select device, min(us) as b, min(us) + 259200000000 as e from {E} where kind = 'purchase' group by device)"


@register("f09_remove_time_ranges", f"select event_id from {E} x where not exists (select 1 from {_SPANS} s where s.device = x.device and x.us > s.b and x.us < s.e)")
def f09(spark, d):
    return filters.remove_time_ranges(events(spark, d), "us", day_spans(spark, d), keys=["device"]).select("event_id")


@register("f10_edit_time_ranges", f"select event_id, case when s.b is not null then -1.0 else value end as value from {E} x left join {_SPANS} s on s.device = x.device and x.us >= s.b and x.us <= s.e")
def f10(spark, d):
    edits = day_spans(spark, d).withColumn("new_value", F.lit(-1.0))
    return filters.edit_time_ranges(events(spark, d), "us", edits, "value", keys=["device"]).select("event_id", "value")


@register("f11_per_device_settings", f"select event_id, case when device % 3 = 0 then 10.0 when device % 3 = 1 then 4.0 else 7.0 end as max_value from {E}")
def f11(spark, d):
    df = events(spark, d)
    settings = df.where("device % 3 <> 2").groupBy("device").agg(F.when(F.col("device") % 3 == 0, 10.0).alias("max_value"))
    return filters.per_device_settings(df, settings.withColumn("max_value", F.when(F.col("device") % 3 == 0, 10.0).otherwise(4.0)), "device", {"max_value": 7.0}).select("event_id", "max_value")


@register("f12_too_frequent_values", f"select event_id, count(*) over (partition by round(value)) * 100.0 / count(*) over () > 2 as too_frequent from {E}")
def f12(spark, d):
    df = events(spark, d).withColumn("value", F.round("value"))
    return filters.too_frequent_values(df, "value", 2).select("event_id", "too_frequent")


@register(
    "f13_frozen_signal",
    f"""with a as (select event_id, device, floor(value / 8) as v, row_number() over w - 1 as n, count(*) over (partition by device) as c from {E} window w as (partition by device order by us)),
    d as (select device, n, abs(lead(v) over w - v) > 0 as moved, abs(lead(v, 16) over w - v) > 0 as j16, abs(lead(v, 32) over w - v) > 0 as j32 from a window w as (partition by device order by n))
    select a.event_id, coalesce(m.moved, false) or coalesce(s.j16, false) or coalesce(t.j32, false) as works from a left join d m on m.device = a.device and m.n = greatest(a.n - 1, 0)
      left join d s on s.device = a.device and s.n = greatest(a.n - 1, 0) // 16 * 16 left join d t on t.device = a.device and t.n = greatest(a.n - 1, 0) // 32 * 32""",
)
def f13(spark, d):
    df = events(spark, d).withColumn("v", F.floor(F.col("value") / 8).cast("double"))
    return filters.frozen_signal(df, ["device"], ["us"], "v", 0.0).select("event_id", "works")


@register(
    "f14_overlaps_area_time",
    """with b as (select c_custkey, min(o_orderdate) as s, max(o_orderdate) as e, min(o_totalprice) as w, max(o_totalprice) as x from customer join orders on o_custkey = c_custkey group by 1)
    select c_custkey, w <= 90000 and x >= 50000 as overlaps, greatest(s, date '1994-01-01') < least(e, date '1995-01-01') as in_time, x > 200000 and x < 400000 as inside from b""",
)
def f14(spark, d):
    o = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min("o_orderdate").alias("s"), F.max("o_orderdate").alias("e"), F.min("o_totalprice").alias("w"), F.max("o_totalprice").alias("x"))
    zero, day = F.lit(0.0), lambda x: F.lit(x).cast("date")
    return o.select(
        "c_custkey", filters.overlaps_bbox(F.col("w"), F.col("x"), zero, zero, (50000, 90000, -1, 1)).alias("overlaps"),
        filters.overlaps_time(F.col("s"), F.col("e"), day("1994-01-01"), day("1995-01-01")).alias("in_time"), filters.position_inside(F.col("x"), zero, (200000, 400000, -1, 1)).alias("inside"),
    )


@register("f15_min_satellites", f"select event_id, (json_extract(props, '$.k')::int) % 7 as \"n_GPS\" from {E} where (json_extract(props, '$.k')::int) % 7 >= 3")
def f15(spark, d):
    df = events(spark, d).select("event_id", (F.get_json_object("props", "$.k").cast("int") % 7).alias("n_GPS"))
    return filters.min_satellites(df)


def positions(df):
    """A made-up track around 55 N 20 E from the value and id of each event."""
    return df.withColumns({"lat": 55 + F.col("value") / 1000, "lon": 20 + (F.col("event_id") % 97) / 1000})


P = f"(select *, 55 + value / 1000 as lat, 20 + (event_id % 97) / 1000 as lon from {E})"
_DIST = "sqrt(pow(radians(lon - a.olon) * 6371000 * cos(radians((a.olat + lat) / 2)), 2) + pow(radians(lat - a.olat) * 6371000, 2))"


@register(
    "f16_max_distance_from_anchor",
    f"""with p as {P}, a1 as (select device, avg(lat) as olat, avg(lon) as olon from p group by device), g as (select p.* from p join a1 a using (device) where {_DIST} <= 3000),
    a2 as (select device, avg(lat) as olat, avg(lon) as olon from g group by device) select event_id, round({_DIST}, 3) as dr from p join a2 a using (device) where {_DIST} <= 3000""",
)
def f16(spark, d):
    return filters.max_distance_from_anchor(positions(events(spark, d)), ["device"], "lat", "lon", 3000).select("event_id", F.round("dr", 3).alias("dr"))


@register("f17_burst_start_nulls", f"select event_id, case when row_number() over (partition by device, us // 86400000000 order by us) > 2 then value end as value from {E}")
def f17(spark, d):
    return filters.burst_start_nulls(events(spark, d), ["device"], "us", "value", 86_400_000_000).select("event_id", "value")
