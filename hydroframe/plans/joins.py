"""Queries of the joins: points are purchases, the series are views, runs are sessions of a device."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins
from ..sources.series import events, table
from .filters import E, P, day_spans, positions
from .registry import register

_V = f"(select device, us, value, event_id from {E} where kind = 'view')"
_PT = f"(select device, us, event_id from {E} where kind = 'purchase')"


def points(spark, d):
    return events(spark, d).where("kind = 'purchase'").select("event_id", "device", "us")


def views(spark, d):
    return events(spark, d).where("kind = 'view'").select("device", "us", "value")


_AROUND = f"""a as (select p.event_id, p.device, p.us, v.us as pu, v.value as pv from {_PT} p asof left join {_V} v on p.device = v.device and p.us >= v.us),
  b as (select a.*, v.us as nu, v.value as nv from a asof left join {_V} v on a.device = v.device and a.us <= v.us),
  n as (select *, case when pu is null then nu when nu is null or us - pu < nu - us then pu else nu end as near_us, case when pu is null then nv when nu is null or us - pu < nu - us then pv else nv end as near_value,
    case when nu = pu then pv when nu > pu then pv + (nv - pv) * (us - pu) / (nu - pu) end as int_value from b)"""


@register("j01_nearest_join", f"with {_AROUND} select event_id, near_us, near_value from n")
def j01(spark, d):
    return joins.nearest_join(points(spark, d), views(spark, d), ["device"], "us", ["value"]).select("event_id", "near_us", "near_value")


@register(
    "j02_nearest_or_interpolate_join",
    f"with {_AROUND}, m as (select *, max(abs(near_us - us)) over (partition by device) > 100000000000 as interpolated from n) select event_id, interpolated, round(case when interpolated then int_value else near_value end, 6) as at_value from m",
)
def j02(spark, d):
    df = joins.nearest_or_interpolate_join(points(spark, d), views(spark, d), ["device"], "us", ["value"], 100_000_000_000)
    return df.select("event_id", "interpolated", F.round("at_value", 6).alias("at_value"))


@register("j03_interpolate_join", f"with {_AROUND} select event_id, round(int_value, 6) as int_value from n")
def j03(spark, d):
    return joins.interpolate_join(points(spark, d), views(spark, d), ["device"], "us", ["value"]).select("event_id", F.round("int_value", 6).alias("int_value"))


_RUNS = f"(select device, min(us) as b, min(us) + 259200000000 as e from {E} where kind = 'purchase' group by device)"


@register("j04_interval_join", f"select event_id, s.b as \"Time_st\" from {E} x join {_RUNS} s on s.device = x.device and x.us >= s.b and x.us <= s.e")
def j04(spark, d):
    return joins.bucketed_intervals(events(spark, d), "us", day_spans(spark, d), "Time_st", "Time_en", ["device"]).select("event_id", "Time_st")


@register("j05_runs_for_points", f"select distinct r.event_id as run from {E} r join (select us from {E} where kind = 'purchase') p on r.us >= p.us and r.us < p.us + 3600000000 where r.kind = 'view'")
def j05(spark, d):
    runs = events(spark, d).where("kind = 'view'").select(F.col("event_id").alias("run"), F.col("us").alias("start"))
    return joins.runs_for_points(points(spark, d).select("us"), runs, "us", "start", 3_600_000_000).select("run")


@register("j06_asof_last_good", f"select p.event_id, v.value as last_value from {_PT} p asof left join (select * from {_V} where value > 10) v on p.device = v.device and p.us >= v.us")
def j06(spark, d):
    series = views(spark, d).withColumn("good", F.when(F.col("value") > 10, F.col("value")))
    return joins.asof_last_good(points(spark, d), series, ["device"], "us", "good", ["value"]).select("event_id", "last_value")


_SOUND = f"(select device, us, case when event_id % 4 <> 1 then value end as a, case when event_id % 3 <> 0 then event_id end as b from {E} where kind = 'view')"


@register(
    "j06b_values_at_edges",
    f"""with r as {_RUNS}, s as {_SOUND},
    x as (select r.device, r.b as begin, r.e as end, st.a as a1, st.b as b1, en.a as a2, en.b as b2 from r asof left join (select * from s where a is not null) st on st.device = r.device and r.b >= st.us
      asof left join (select * from s where a is not null) en on en.device = r.device and r.e >= en.us)
    select x.device, x.begin, coalesce(a1, (select arg_min(a, us) from s where s.device = x.device and us >= x.begin and us <= x.end and a is not null)) as a_st,
      coalesce(b1, (select arg_min(b, us) from s where s.device = x.device and us >= x.begin and us <= x.end and b is not null)) as b_st,
      coalesce(a2, (select arg_max(a, us) from s where s.device = x.device and us <= x.end and a is not null)) as a_en,
      coalesce(b2, (select arg_max(b, us) from s where s.device = x.device and us <= x.end and b is not null)) as b_en from x""",
)
def j06b(spark, d):
    runs = points(spark, d).groupBy("device").agg(F.min("us").alias("begin")).withColumn("end", F.col("begin") + 259_200_000_000)
    series = events(spark, d).where("kind = 'view'").select("device", "us", F.when(F.col("event_id") % 4 != 1, F.col("value")).alias("a"), F.when(F.col("event_id") % 3 != 0, F.col("event_id")).alias("b"))
    return joins.values_at_edges(runs, series, ["device"], "us", "begin", "end", ["a"], ["a", "b"]).drop("end")


@register(
    "j07b_fill_with_retry",
    f"""with s as (select device, us, case when event_id % 3 = 0 then null when event_id % 3 = 1 then value else -value end as value from {E} where kind = 'view'), p as {_PT},
    n as (select p.*, (select arg_min(s.value, (abs(s.us - p.us), -s.us)) from s where s.device = p.device and abs(s.us - p.us) <= 200000000000 and abs(s.us - p.us) = (select min(abs(t.us - p.us)) from s t where t.device = p.device)) as near from p)
    select event_id, coalesce(near, (select arg_min(s.value, (abs(s.us - n.us), -s.us)) from s where s.device = n.device and s.value > 0 and abs(s.us - n.us) <= 200000000000)) as value from n""",
)
def j07b(spark, d):
    """Of the other table's rows a third have no value and a third a negative one."""
    value = F.when(F.col("event_id") % 3 == 1, F.col("value")).when(F.col("event_id") % 3 == 2, -F.col("value"))
    other = events(spark, d).where("kind = 'view'").select("device", "us", value.alias("value"))
    p = points(spark, d).withColumn("value", F.lit(None).cast("double"))
    return joins.fill_from_other_tables(p, [other], "us", ["value"], 200_000_000_000, ["device"], retry=True).select("event_id", "value")


@register(
    "j07_fill_from_other_tables",
    f"""with {_AROUND} select event_id, case when event_id % 3 = 0 then 0.5 when abs(near_us - us) <= 20000000000 then near_value end as value from n""",
)
def j07(spark, d):
    p = points(spark, d).withColumn("value", F.when(F.col("event_id") % 3 == 0, 0.5))
    return joins.fill_from_other_tables(p, [views(spark, d)], "us", ["value"], 20_000_000_000, ["device"]).select("event_id", "value")


@register("j09_coordinates_or_log", f"with {_AROUND} select event_id, round(coalesce(case when event_id % 2 = 0 then 1.25 end, int_value, -5.0), 6) as value from n")
def j09(spark, d):
    p = points(spark, d).withColumn("value", F.when(F.col("event_id") % 2 == 0, 1.25))
    return joins.coordinates_or_log(p, views(spark, d), "us", ["value"], {"value": F.lit(-5.0)}, ["device"]).select("event_id", F.round("value", 6).alias("value"))


_BINS = f"(select kind, us // 3600000000 as hour, round(avg(value), 6) as value from {E} group by 1, 2)"


def hour_bins(spark, d):
    return events(spark, d).groupBy("kind", F.expr("us div 3600000000").alias("hour")).agg(F.round(F.avg("value"), 6).alias("value"))


@register("j10_wide_by_device", f"select hour, max(value) filter (kind = 'view') as value_view, max(value) filter (kind = 'click') as value_click from {_BINS} where kind in ('view', 'click') group by hour")
def j10(spark, d):
    return joins.wide_by_device(hour_bins(spark, d), "hour", "kind", ["view", "click"], ["value"])


@register("j11_device_pairs", f"select hour, a.kind as kind_1, b.kind as kind_2, a.value as value_1, b.value as value_2 from {_BINS} a join {_BINS} b using (hour) where a.kind < b.kind")
def j11(spark, d):
    return joins.device_pairs(hour_bins(spark, d), "hour", "kind", ["value"])


@register("j12_match_profiles_to_route", f"with {_AROUND} select n.event_id, v.event_id as route_point_no from n join {_V} v on v.device = n.device and v.us = n.near_us where v.event_id % 5 <> 0")
def j12(spark, d):
    route = events(spark, d).where("kind = 'view'").select("device", "us", F.col("event_id").alias("point_no"), (F.col("event_id") % 5 == 0).alias("excluded"))
    return joins.match_profiles_to_route(points(spark, d), route, "us", "device").select("event_id", "route_point_no")


@register("j13_moving_anchor", f"select x.event_id, a.lat as anchor_lat, a.lon as anchor_lon from {E} x asof left join (select us, lat, lon from {P} where kind = 'purchase') a on x.us >= a.us")
def j13(spark, d):
    """Every purchase sets the anchor."""
    anchors = positions(events(spark, d)).where("kind = 'purchase'").select("us", "lat", "lon")
    return joins.moving_anchor(events(spark, d).select("event_id", "us"), anchors, "us").select("event_id", "anchor_lat", "anchor_lon")


@register(
    "j13b_anchor_from_track",
    f"""with t as (select us, lat, lon from {P} where kind = 'purchase'), a as (select x.event_id, x.us, t.us as pu, t.lat as plat, t.lon as plon from {E} x asof left join t on x.us >= t.us),
    b as (select a.*, t.us as nu, t.lat as nlat, t.lon as nlon from a asof left join t on a.us <= t.us)
    select event_id, case when nu - pu <= 14400000000 then round(case when nu = pu then plat else plat + (nlat - plat) * (us - pu) / (nu - pu) end, 6) end as anchor_lat,
      case when nu - pu <= 14400000000 then round(case when nu = pu then plon else plon + (nlon - plon) * (us - pu) / (nu - pu) end, 6) end as anchor_lon from b""",
)
def j13b(spark, d):
    """The anchor follows the track of all purchases, but for gaps of more than four hours."""
    track = positions(events(spark, d)).where("kind = 'purchase'").select("us", "lat", "lon")
    out = joins.anchor_from_track(events(spark, d).select("event_id", "us"), track, "us", longest_gap_us=14_400_000_000)
    return out.select("event_id", F.round("anchor_lat", 6).alias("anchor_lat"), F.round("anchor_lon", 6).alias("anchor_lon"))


_GRID = "(select p_partkey, p_partkey % 60 as i, p_partkey % 99 as j from part)"


@register("j14_nearest_grid_cells", f"select x.event_id, g.p_partkey from {P} x join {_GRID} g on g.i = floor((lat - 55) / 0.001 + 0.5) and g.j = floor((lon - 20) / 0.001 + 0.5)")
def j14(spark, d):
    grid = table(spark, d, "part").select("p_partkey", (F.col("p_partkey") % 60).cast("long").alias("i"), (F.col("p_partkey") % 99).cast("long").alias("j"))
    return joins.nearest_grid_cells(positions(events(spark, d)), grid, "lat", "lon", (55, 20), 0.001).select("event_id", "p_partkey")


@register(
    "j15_nearest_point",
    f"""with n as (select o_orderkey as node, (o_totalprice / 1000)::double as x, (o_orderkey % 1000) * 0.3e0 as y from orders), p as (select event_id, value * 5 as x, (event_id % 300)::double as y from {E} where kind = 'purchase' and value is not null),
    m as (select event_id, min({{'d': sqrt(pow(n.x - p.x, 2) + pow(n.y - p.y, 2)), 'node': node}}) as m from p, n group by event_id) select event_id, m.node as node, m.d as distance from m""",
)
def j15(spark, d):
    """All purchases and all orders."""
    nodes = table(spark, d, "orders").select(F.col("o_orderkey").alias("node"), (F.col("o_totalprice") / 1000).cast("double").alias("x"), ((F.col("o_orderkey") % 1000) * F.lit(0.3)).cast("double").alias("y"))
    pts = events(spark, d).where("kind = 'purchase'").select("event_id", (F.col("value") * 5).alias("x"), ((F.col("event_id") % 300) * F.lit(1.0)).cast("double").alias("y"))
    return joins.nearest_point(pts, nodes, "x", "y", 4.0, "event_id", "node").select("event_id", "node", "distance")
