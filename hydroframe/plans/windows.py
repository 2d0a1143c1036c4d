"""Queries of the window operators over the event series."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import windows
from ..sources.series import events
from .filters import E
from .registry import register
from .stats import DAY, HOUR, rounded

_W = "window w as (partition by device order by us)"


@register(
    "w01_single_spikes",
    f"""with a as (select event_id, value - lag(value) over w as b, value - lead(value) over w as a from {E} {_W})
    select event_id, (b is not null or a is not null) and (coalesce(b > 20, true) and coalesce(a > 20, true) or coalesce(b < -20, true) and coalesce(a < -20, true)) as spike from a""",
)
def w01(spark, d):
    return windows.single_spikes(events(spark, d), ["device"], ["us"], "value", 20.0).select("event_id", "spike")


def _despike_sql(source: str, offset: float, block: int) -> str:
    h = block // 2
    return f"""(select event_id, device, i, n, case when not (abs(value - m) > {offset} * s) or s is null then value end as value from (
      select *, case when i < {h} then max(case when i = least({h}, greatest(n - {block - h}, 0)) then m0 end) over (partition by device) when i > n - {block - h} then max(case when i = greatest(n - {block - h}, 0) then m0 end) over (partition by device) else m0 end as m,
        case when i < {h} then max(case when i = least({h}, greatest(n - {block - h}, 0)) then s0 end) over (partition by device) when i > n - {block - h} then max(case when i = greatest(n - {block - h}, 0) then s0 end) over (partition by device) else s0 end as s
      from (select *, avg(value) over b as m0, stddev_pop(value) over b as s0 from {source} window b as (partition by device order by i rows between {h} preceding and {block - h - 1} following))))"""


_NUMBERED = f"(select event_id, device, value, row_number() over (partition by device order by us) - 1 as i, count(*) over (partition by device) as n from {E})"


@register("w02_despike", f"select event_id, value from {_despike_sql(_despike_sql(_NUMBERED, 1.5, 10), 2.0, 5)}")
def w02(spark, d):
    return windows.despike(events(spark, d), ["device"], ["us"], "value", [(1.5, 10), (2.0, 5)]).select("event_id", "value")


_BACK = f"(select event_id, device, us, value, row_number() over (partition by device order by us desc) - 1 as i, count(*) over (partition by device) as n from {E})"


@register(
    "w18_despike_both_ways",
    f"""with b as (select event_id, device, value from {_despike_sql(_BACK, 1.5, 10)} where value is not null),
    c as (select event_id, device, value, row_number() over (partition by device order by event_id) - 1 as i, count(*) over (partition by device) as n from b) select event_id, value from {_despike_sql("c", 1.5, 10)} where value is not null""",
)
def w18(spark, d):
    return windows.despike_both_ways(events(spark, d), ["device"], ["us"], ["value"], [(1.5, 10)]).select("event_id", "value")


_HOLED = f"(select event_id, device, us, case when event_id % 4 <> 1 then value end as value from {E})"


def holed(spark, d):
    return events(spark, d).withColumn("value", F.when(F.col("event_id") % 4 != 1, F.col("value")))


@register(
    "w03_fill_gaps_linear",
    f"""with h as {_HOLED}, g as (select device, us, value from h where value is not null), a as (select h.*, g.us as pu, g.value as pv from h asof left join g on h.device = g.device and h.us >= g.us), b as (select a.*, g.us as nu, g.value as nv from a asof left join g on a.device = g.device and a.us <= g.us)
    select event_id, round(coalesce(value, case when pu is null then nv when nu is null then pv else pv + (nv - pv) * (us - pu) / (nu - pu) end), 6) as value from b""",
)
def w03(spark, d):
    return rounded(windows.fill_gaps_linear(holed(spark, d), ["device"], "us", ["event_id"], "value").select("event_id", "value"))


@register(
    "w04_resample_linear",
    f"""with g as (select kind, us, value from {E}), x as (select kind, unnest(range(((min(us) + {HOUR} - 1) // {HOUR} * {HOUR})::bigint, (max(us) // {HOUR} * {HOUR} + 1)::bigint, {HOUR})) as us from g group by kind),
    a as (select x.*, g.us as pu, g.value as pv from x asof left join g on x.kind = g.kind and x.us >= g.us), b as (select a.*, g.us as nu, g.value as nv from a asof left join g on a.kind = g.kind and a.us <= g.us)
    select kind, us, round(case when us - pu < 2 * {HOUR} then case when nu = pu then pv else pv + (nv - pv) * (us - pu) / (nu - pu) end end, 6) as value from b""",
)
def w04(spark, d):
    return rounded(windows.resample_linear(events(spark, d), ["kind"], "us", "value", HOUR, 2))


@register(
    "w05_true_regions",
    f"""with f as (select device, us, value > 8 as f, row_number() over (partition by device order by us) - row_number() over (partition by device, value > 8 order by us) as i from {E})
    select device, min(us) as begin, max(us) as end, count(*) as rows from f where f group by device, i""",
)
def w05(spark, d):
    return windows.true_regions(events(spark, d).withColumn("flag", F.col("value") > 8), ["device"], ["us"], "flag")


@register("w06_bursts", f"select event_id, sum((gap > {DAY // 2})::int) over (partition by device order by us)::bigint as burst from (select *, coalesce(us - lag(us) over (partition by device order by us), 0) as gap from {E})")
def w06(spark, d):
    return windows.bursts(events(spark, d), ["device"], "us", DAY // 2).select("event_id", "burst")


_SEC = f"(select event_id, kind, us // {HOUR} * 1000000 as t from {E})"


@register(
    "w09_spread_repeated_times",
    f"""with s as (select *, row_number() over (partition by kind, t order by event_id) - 1 as k, count(*) over (partition by kind, t) as n, min(t) over (partition by kind order by t range between 1 following and unbounded following) as nx from {_SEC})
    select event_id, t + round(k * coalesce(least(1000000 / 4.0, (nx - t) / n), 1000000 / 4.0))::bigint as us from s""",
)
def w09(spark, d):
    df = events(spark, d).withColumn("us", F.expr(f"us div {HOUR} * 1000000"))
    return windows.spread_repeated_times(df, ["kind"], "us", "event_id", 4.0).select("event_id", "us")


@register("w13_day_jump_correction", f"select event_id, us from {E}")
def w13(spark, d):
    # One series of all events: rows 300 to 599 of each thousand are a day ahead and come back.
    df = events(spark, d).withColumn("us", F.col("us") + F.when((F.col("event_id") % 1000).between(300, 599), DAY).otherwise(0)).withColumn("series", F.lit(1))
    return windows.day_jump_correction(df, ["series"], "event_id", "us", HOUR).select("event_id", "us")


@register(
    "w16_gaussian_moving_mean",
    f"""with n as (select event_id, kind, value, row_number() over (partition by kind order by us) as i from {E})
    select a.event_id, round(sum(b.value * exp(-0.5 * pow((b.i - a.i) / 3.0, 2))) / sum(exp(-0.5 * pow((b.i - a.i) / 3.0, 2))), 6) as value from n a join n b on a.kind = b.kind and b.i between a.i - 4 and a.i + 4 group by 1""",
)
def w16(spark, d):
    return rounded(windows.gaussian_moving_mean(events(spark, d), ["kind"], ["us"], "value", 9).select("event_id", "value"))


@register(
    "w24_mostly_bad_regions",
    f"""with n as (select event_id, kind, (value > 8)::int as f, row_number() over (partition by kind order by us) - 1 as i, count(*) over (partition by kind) as n from {E}), o as (select event_id, kind, i, n, unnest(range(-3, 4)) as k from n)
    select o.event_id, sum(b.f) >= 4 as mostly from o join n b on b.kind = o.kind and b.i = least(greatest(o.i + k, 0), o.n - 1) group by 1""",
)
def w24(spark, d):
    return windows.mostly_bad_regions(events(spark, d).withColumn("bad", F.col("value") > 8), ["kind"], ["us"], "bad", 7).select("event_id", "mostly")


@register("w28_overlapping_intervals", f"select event_id, i * {DAY // 4} as interval_start from {E}, unnest(range(floor((us - {DAY}) / {DAY // 4})::bigint + 1, us // {DAY // 4} + 1)) as t(i)")
def w28(spark, d):
    return windows.overlapping_intervals(events(spark, d), "us", DAY, 0.75).select("event_id", "interval_start")


@register(
    "w30_keep_index_after_delete",
    f"""with g as (select *, event_id % 3 = 0 as bad, sum((event_id % 3 <> 0)::int) over (partition by device order by us) - 1 as g from {E}) select event_id, case when g >= 0 then g end::bigint as good_index from g""",
)
def w30(spark, d):
    df = events(spark, d).withColumn("bad", F.col("event_id") % 3 == 0)
    return windows.keep_index_after_delete(df, ["device"], "us", ["event_id"], "bad").select("event_id", "good_index")


@register("o01_order_by_time", f"select device, us, event_id from {E}")
def o01(spark, d):
    return windows.order_by_time(events(spark, d), ["device"], "us", ["event_id"]).select("device", "us", "event_id")


@register("o02_last_n", f"select event_id from {E} order by us desc, event_id desc limit 20")
def o02(spark, d):
    return windows.last_n(events(spark, d), "us", 20, ["event_id"]).select("event_id")


#: The kinds of events, of which each is a deployment or a list.
_KINDS = ("click", "error", "purchase", "signup", "view")


@register(
    "o03_stack_deployments",
    f"""with p as (select kind, us, value::float as value, (list_position({list(_KINDS)}, kind) - 1)::int as deployment from {E}), s as (select *, us - lag(us) over (partition by deployment order by us) as st from p)
    select kind, us, value, deployment from p union all select kind, max(us) + max_by(st, us) // 2, null, deployment from s group by kind, deployment""",
)
def o03(spark, d):
    df = events(spark, d)
    return windows.stack_deployments([df.where(F.col("kind") == k) for k in _KINDS], ["kind"], "us", ["value"])


@register("o04_union_station_lists", f"select event_id, us, value from {E}")
def o04(spark, d):
    df = events(spark, d).select("event_id", "us", "value", "kind")
    return windows.union_station_lists([df.where(F.col("kind") == k).drop("kind") for k in _KINDS], "us")


@register("o05_intersect_ranges", f"select event_id, greatest(us, {HOUR} * (us // {HOUR}) + 600000000) as start, least(us + 900000000, {HOUR} * (us // {HOUR}) + 1800000000) as end from {E}")
def o05(spark, d):
    hour = F.expr(f"us div {HOUR} * {HOUR}")
    start, end = windows.intersect_ranges(F.col("us"), F.col("us") + 900_000_000, hour + 600_000_000, hour + 1_800_000_000)
    return events(spark, d).select("event_id", start.alias("start"), end.alias("end"))


@register("s26_separator_rows", f"select device, us, value from {E} union all select device, max(us) + coalesce(max_by(st, us) // 2, 1000000), null from (select *, us - lag(us) over (partition by device order by us) as st from {E}) group by device")
def s26(spark, d):
    return windows.separator_rows(events(spark, d).select("device", "us", "value"), ["device"], "us")


@register(
    "w01b_single_spikes_long_series",
    f"""with a as (select event_id, value - lag(value) over w as b, value - lead(value) over w as a from {E} window w as (order by us))
    select event_id, (b is not null or a is not null) and (coalesce(b > 20, true) and coalesce(a > 20, true) or coalesce(b < -20, true) and coalesce(a < -20, true)) as spike from a""",
)
def w01b(spark, d):
    df = events(spark, d).withColumn("series", F.lit("all"))
    return windows.single_spikes(df, ["series"], ["us", "event_id"], "value", 20.0, block_rows=256).select("event_id", "spike")


@register(
    "w16b_gaussian_mean_long_series",
    f"""with n as (select event_id, value, row_number() over (order by us) as i from {E})
    select a.event_id, round(sum(b.value * exp(-0.5 * pow((b.i - a.i) / 3.0, 2))) / sum(exp(-0.5 * pow((b.i - a.i) / 3.0, 2))), 6) as value from n a join n b on b.i between a.i - 4 and a.i + 4 group by 1""",
)
def w16b(spark, d):
    df = events(spark, d).withColumn("series", F.lit("all"))
    return rounded(windows.gaussian_moving_mean(df, ["series"], ["us", "event_id"], "value", 9, block_rows=256).select("event_id", "value"))
