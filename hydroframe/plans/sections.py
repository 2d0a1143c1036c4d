"""Queries of sections and profiles: orders are casts, line numbers depths, quantities values."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sections
from ..sources.series import events, table
from .filters import E, P, positions
from .grouped import wavelet_sql
from .registry import register
from .stats import DAY, HOUR, rounded
from .windows import _despike_sql

_L = "(select l_orderkey as cast_id, l_orderkey // 200 as section, (l_orderkey % 200)::double as x, l_linenumber::double as z, avg(l_quantity)::double as v from lineitem group by 1, 2, 3, 4)"


def profiles(spark, d):
    li = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("cast_id"), F.col("l_linenumber").cast("double").alias("z")).agg(F.avg("l_quantity").cast("double").alias("v"))
    return li.select("cast_id", F.expr("cast_id div 200").alias("section"), (F.col("cast_id") % 200).cast("double").alias("x"), "z", "v")


@register(
    "g01_split_sections",
    f"""with u as (select device, event_id, us, lat, lon, kind = 'signup' as mark from {P} where event_id % 11 <> 0), s as (select *, sum(mark::int) over w as section, lag(lat) over w as la, lag(lon) over w as lo from u window w as (partition by device order by us)),
    a as (select device, event_id, section::bigint as section from s union all select device, event_id, section::bigint - 1 from s where mark and section > 0 and sqrt(pow(radians(lon - lo) * 6371000 * cos(radians((la + lat) / 2)), 2) + pow(radians(lat - la) * 6371000, 2)) < 3000),
    n as (select *, count(*) over (partition by device, section) as n from a) select device, event_id, section from n where n > 2""",
)
def g01(spark, d):
    p = positions(events(spark, d))
    out = sections.split_sections(p, "device", "us", F.col("kind") == "signup", F.col("event_id") % 11 == 0, "lat", "lon", 3000)
    return out.select("device", "event_id", "section")


_STEP = "sqrt(pow(radians({1} - {0}) * 6371000 * cos(radians(({2} + {3}) / 2)), 2) + pow(radians({3} - {2}) * 6371000, 2))"


@register(
    "g02_section_distance",
    f"""with a as (select *, lag(lon) over w as lo0, lag(lat) over w as la0, lead(lon) over w as lo1, lead(lat) over w as la1, cos(radians(lat)) as sc from {P} window w as (partition by device order by us)),
    b as (select *, coalesce({_STEP.format("lo0", "lon", "la0", "lat")}, 0) / 1000 as step, (coalesce(lo1, 2 * lon - lo0) - lon) * sc as dx, coalesce(la1, 2 * lat - la0) - lat as dy from a),
    c as (select *, sum(step) over (partition by device order by us) as distance, coalesce((0.002 * sc * dx + 0.001 * dy) / nullif(dx * dx + dy * dy, 0), 0) as t from b),
    e as (select *, lon + dx * t / sc as fx, lat + dy * t as fy from c)
    select event_id, round(distance, 6) as distance, round(distance + coalesce({_STEP.format("lon", "fx", "lat", "fy")} / 1000 * sign(t * (dx * dx + dy * dy)), 0), 6) as distance_en from e""",
)
def g02(spark, d):
    p = positions(events(spark, d)).withColumns({"lat_en": F.col("lat") + 0.001, "lon_en": F.col("lon") + 0.002})
    return rounded(sections.section_distance(p, ["device"], "us", "lat", "lon", "lat_en", "lon_en").select("event_id", "distance", "distance_en"))


@register("g03_last_good_in_run", f"select cast_id, max(z) filter (v > 20 and 8 - z <= 5) as last_good from {_L} group by 1")
def g03(spark, d):
    p = profiles(spark, d).withColumns({"good": F.when(F.col("v") > 20, F.col("v")), "altitude": 8 - F.col("z")})
    return sections.last_good_in_run(p, ["cast_id"], "z", "good", "altitude", 5)


_DEPTH = f"""d0 as (select event_id, device, row_number() over (partition by device order by us) - 1 as i, count(*) over (partition by device) as n, case when abs(value) + 1.5 > 0.5 and abs(value) + 1.5 < 200 then abs(value) + 1.5 end as d from {E}),
    m as (select device, i, i < n - 1 and lead(d) over w - d is null as blank, abs(lead(d) over w - d) > 0 as moved, abs(lead(d, 16) over w - d) > 0 as j16, abs(lead(d, 32) over w - d) > 0 as j32, n from d0 window w as (partition by device order by i)),
    a as (select device, count(*) filter (blank) > any_value(n) / 10 as every from m group by device),
    k as (select d0.event_id, d0.device, d0.i, d0.n, case when (every or coalesce(x.moved, false) or coalesce(y.j16, false) or coalesce(z.j32, false)) and not count(*) over (partition by d0.d) * 100.0 / count(*) over () > 5 then d0.d end as value
      from d0 join a using (device) left join m x on x.device = d0.device and x.i = greatest(d0.i - 1, 0) left join m y on y.device = d0.device and y.i = greatest(d0.i - 1, 0) // 16 * 16 left join m z on z.device = d0.device and z.i = greatest(d0.i - 1, 0) // 32 * 32),
    h as (select *, last_value(case when value is not null then {{'i': i, 'v': value}} end ignore nulls) over (partition by device order by i) as lo, first_value(case when value is not null then {{'i': i, 'v': value}} end ignore nulls) over (partition by device order by i rows between current row and unbounded following) as hi
      from {_despike_sql("k", 2.5, 11)}),
    s as (select event_id, device, i as n, case when lo is null then hi.v when hi is null or hi.i = lo.i then lo.v else lo.v + (hi.v - lo.v) * (i - lo.i) / (hi.i - lo.i) end as y from h where lo is not null or hi is not null)"""


@register("g04_clean_depth_line", f"with {_DEPTH}, {wavelet_sql('device', 3)} select e.event_id, round(r0.v, 6) as depth from {E} e left join s using (event_id) left join r0 on r0.device = s.device and r0.i = s.n")
def g04(spark, d):
    df = events(spark, d).withColumn("depth", -F.col("value"))
    return rounded(sections.clean_depth_line(df, ["device"], ["us"], "depth", 1.5, 0.5, 200, [(2.5, 11)]).select("event_id", "depth"))


@register("g05_merge_cast_depth", f"with l as (select device, event_id * 1.0 as x, value as d from {E} where kind <> 'error'), c as (select device, event_id + 0.25 as x, value + 50 as d from {E} where kind = 'error') select device, x, d as depth from l union all select device, x, d from c where not exists (select 1 from l where l.device = c.device and abs(l.x - c.x) < 0.5 and abs(l.d - c.d) <= 50 * abs(l.x - c.x) + 1)")
def g05(spark, d):
    df = events(spark, d)
    line = df.where("kind <> 'error'").select("device", (F.col("event_id") * F.lit(1.0)).alias("x"), F.col("value").alias("depth"))
    casts = df.where("kind = 'error'").select("device", (F.col("event_id") + F.lit(0.25)).alias("x"), (F.col("value") + 50).alias("depth"))
    return sections.merge_cast_depth(line, casts, ["device"], "x", "depth")


@register(
    "g06_horizon_slices",
    f"""with r as (select cast_id, z, v, l as level, avg(v) over (partition by cast_id, l) as m from {_L}, unnest([2.5, 4.0]) as t(l) where abs(z - l) <= 1.6), g as (select * from r where abs(v - m) <= 15),
    s as (select cast_id, level, max(z) filter (z <= level) as za, arg_max(v, z) filter (z <= level) as va, min(z) filter (z >= level) as zb, arg_min(v, z) filter (z >= level) as vb from g group by 1, 2)
    select cast_id, level::double as level, round(case when za = zb then va else va + (vb - va) * (level - za) / (zb - za) end, 6) as v from s where za is not null and zb is not null""",
)
def g06(spark, d):
    return rounded(sections.horizon_slices(profiles(spark, d), ["cast_id"], "z", "v", [2.5, 4.0], 1.6, 15))


@register(
    "g07_grid_section",
    f"""with m as (select section, x, z, avg(v) as v from {_L} group by 1, 2, 3), s as (select *, lead(z) over w as zn, lead(v) over w as vn from m window w as (partition by section, x order by z)),
    t as (select section, x, i / 2e0 as z, v + coalesce((i / 2e0 - z) * (vn - v) / (zn - z), 0) as v from s, lateral (select unnest(range((2 * z)::bigint, (2 * coalesce(zn, z + 0.5))::bigint)) as i) as r),
    u as (select *, lead(x) over w as xn, lead(v) over w as vn from t window w as (partition by section, z order by x)),
    g as (select section, 5e0 * i as x, z, v + coalesce((5 * i - x) * (vn - v) / (xn - x), 0) as v from u, lateral (select unnest(range(ceil(x / 5)::bigint, coalesce(ceil(xn / 5), floor(x / 5) + 1)::bigint)) as i) as r),
    d as (select section, x, max(z) as d from m group by 1, 2), e as (select *, lead(x) over w as xn, lead(d) over w as dn from d window w as (partition by section order by x)),
    b as (select section, 5e0 * i as x, d + coalesce((5 * i - x) * (dn - d) / (xn - x), 0) as d from e, lateral (select unnest(range(ceil(x / 5)::bigint, coalesce(ceil(xn / 5), floor(x / 5) + 1)::bigint)) as i) as r)
    select section, x, z, round(v, 6) as v from g join b using (section, x) where z <= d + 1e-9""",
)
def g07(spark, d):
    return rounded(sections.grid_section(profiles(spark, d), ["section"], "x", "z", "v", 5.0, 0.5))


@register(
    "g08_grid_to_point",
    f"""with g as (select p_partkey % 60 as i, p_partkey % 99 as j, avg(p_retailprice)::double as h from part group by 1, 2), p as (select event_id, (lat - 55) / 0.001 as y, (lon - 20) / 0.001 as x from {P}),
    c as (select event_id, y, x, floor(y) + a as i, floor(x) + b as j from p, unnest([0, 1]) as t(a), unnest([0, 1]) as u(b))
    select event_id, round(sum((1 - abs(y - i)) * (1 - abs(x - j)) * h) / nullif(sum((1 - abs(y - i)) * (1 - abs(x - j))), 0), 4) as h from c join g using (i, j) where (1 - abs(y - i)) * (1 - abs(x - j)) > 1e-9 group by 1""",
)
def g08(spark, d):
    grid = table(spark, d, "part").groupBy((F.col("p_partkey") % 60).cast("long").alias("i"), (F.col("p_partkey") % 99).cast("long").alias("j")).agg(F.avg("p_retailprice").cast("double").alias("h"))
    p = positions(events(spark, d))
    out = sections.grid_to_point(p, grid, "lat", "lon", (55, 20), 0.001, "h", "event_id")
    return out.select("event_id", F.round("h", 4).alias("h")).where("h is not null")


@register(
    "g09_iso_depth",
    f"""with a as (select cast_id, z, v, lag(z) over w as z0, lag(v) over w as v0 from {_L} window w as (partition by cast_id order by z)), c as (select cast_id, case when (v0 - 25.5) * (v - 25.5) < 0 then z0 + (z - z0) * (25.5 - v0) / (v - v0) when v = 25.5 then z end as c from a)
    select cast_id, count(c) as crossings, round(case when count(c) = 1 then max(c) end, 6) as iso_depth from c group by 1""",
)
def g09(spark, d):
    return rounded(sections.iso_depth(profiles(spark, d), ["cast_id"], "z", "v", 25.5))


@register("g10_pad_section_edges", f"with e as (select section, min(x) as a, max(x) as b from {_L} group by 1) select section, x, z, v from {_L} union all select section, x - 2.5, z, v from {_L} join e using (section) where x = a union all select section, x + 2.5, z, v from {_L} join e using (section) where x = b")
def g10(spark, d):
    return sections.pad_section_edges(profiles(spark, d).drop("cast_id"), ["section"], "x", "z", 2.5)


@register(
    "g10b_bottom_points",
    f"""with e as (select section, x, max(z) as z, arg_max(v, z) as v from {_L} group by 1, 2), s as (select *, lead(x) over w as x1, lead(z) over w as z1, lead(v) over w as v1 from e window w as (partition by section order by x))
    select section, round(x + k, 6) as x, round(z + (z1 - z) * k / (x1 - x), 6) as z, round(v + (v1 - v) * k / (x1 - x), 6) as v from s, unnest(range(1, ceil(x1 - x)::bigint + 1)) as t(k) where k < x1 - x""",
)
def g10b(spark, d):
    return rounded(sections.bottom_points(profiles(spark, d), ["section"], "x", "z", ["v"], 1.0))


_PLANE = f"(select event_id, device, row_number() over (partition by device order by us) - 1 as n, radians(lon) * cos(avg(radians(lat)) over (partition by device)) * 6371000 as x, radians(lat) * 6371000 as y from {P})"


@register(
    "g11_simplify_track",
    f"""with recursive p as {_PLANE}, e as (select device, min(n) as a, max(n) as b from p group by device),
    s as (select device, a, b from e where b - a > 1 union all select device, unnest([a, c]), unnest([c, b]) from (
      select device, a, b, arg_max(n, (off, -n)) as c, max(off) as off from (
        select s.device, s.a, s.b, m.n, sqrt(pow(m.x - i.x - t * (j.x - i.x), 2) + pow(m.y - i.y - t * (j.y - i.y), 2)) as off
        from s join p i on i.device = s.device and i.n = s.a join p j on j.device = s.device and j.n = s.b join p m on m.device = s.device and m.n > s.a and m.n < s.b,
        lateral (select greatest(0, least(1, ((m.x - i.x) * (j.x - i.x) + (m.y - i.y) * (j.y - i.y)) / greatest(pow(j.x - i.x, 2) + pow(j.y - i.y, 2), 1e-300))) as t) as l)
      group by device, a, b) where off > 1000),
    k as (select device, a as n from s union select device, b from s union select device, a from e union select device, b from e)
    select event_id, device from p join k using (device, n)""",
)
def g11(spark, d):
    return sections.simplify_track(positions(events(spark, d)), ["device"], "us", "lat", "lon", 1000.0).select("event_id", "device")


@register("g12_split_track_by_period", f"select event_id, dense_rank() over (partition by device order by us // {DAY}) - 1 as part from {E}")
def g12(spark, d):
    return sections.split_track_by_period(events(spark, d), ["device"], "us", DAY).select("event_id", F.col("part").cast("long").alias("part"))


@register(
    "g13_pairwise_track_distance",
    f"""with b as (select kind, (us + {HOUR // 2}) // {HOUR} * {HOUR} as bin, avg(lat) as lat, avg(lon) as lon from {P} group by 1, 2), q as (select bin, a.kind as kind_1, c.kind as kind_2, radians(c.lat - a.lat) * 6371000 as dy, radians(c.lon - a.lon) * 6371000 * cos(radians((a.lat + c.lat) / 2)) as dx from b a join b c using (bin) where a.kind < c.kind)
    select bin, kind_1, kind_2, round(sqrt(dx * dx + dy * dy), 3) as distance, round((degrees(atan2(dx, dy)) + 360) % 360, 2) as bearing from q""",
)
def g13(spark, d):
    out = sections.pairwise_track_distance(positions(events(spark, d)), "kind", "us", "lat", "lon", HOUR)
    return out.select("bin", "kind_1", "kind_2", F.round("distance", 3).alias("distance"), F.round("bearing", 2).alias("bearing"))
