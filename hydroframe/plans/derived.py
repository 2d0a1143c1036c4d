"""Queries of derived series."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import derived
from ..sources.series import events
from .filters import E, P, positions
from .joins import _PT, _V, points, views
from .registry import register
from .stats import rounded
from .windows import _HOLED


@register(
    "j08_nav_columns_for_samples",
    f"""with v as (select device, us, value as y, (us - lag(us) over w) / 1e6 as h0, (lead(us) over w - us) / 1e6 as h1, value - lag(value) over w as e0, lead(value) over w - value as e1 from {_V} window w as (partition by device order by us)),
    s as (select *, e0 / h0 as d0, e1 / h1 as d1 from v),
    m as (select device, us, y, case when d0 is null then d1 when d1 is null then d0 when d0 * d1 > 0 then 3 * (h0 + h1) / ((2 * h1 + h0) / d0 + (h1 + 2 * h0) / d1) else 0 end as m from s),
    a as (select p.event_id, p.device, p.us, m.us as pu, m.y as py, m.m as pm from {_PT} p asof left join m on p.device = m.device and p.us >= m.us),
    b as (select a.*, m.us as nu, m.y as ny, m.m as nm from a asof left join m on a.device = m.device and a.us <= m.us),
    t as (select *, (nu - pu) / 1e6 as h, (us - pu) / nullif(nu - pu, 0)::double as s from b)
    select event_id, round(case when nu = pu then py when nu > pu then py * (1 + 2 * s) * (1 - s) * (1 - s) + h * pm * s * (1 - s) * (1 - s) + ny * s * s * (3 - 2 * s) + h * nm * s * s * (s - 1) end, 6) as nav_value from t""",
)
def j08(spark, d):
    return rounded(derived.nav_columns_for_samples(points(spark, d), views(spark, d), ["device"], "us", ["value"]).select("event_id", "nav_value"))


_H = f"(select h.*, (event_id % 17) / 10.0 as y, (event_id % 13) / 10.0 as z from {_HOLED} h)"


@register(
    "m06_recover_magnetometer_x",
    f"""with h as {_H}, m as (select device, quantile_cont(sqrt(value * value + y * y + z * z), 0.5) as f from h where value is not null group by 1), g as (select device, us, value from h where value is not null),
    a as (select h.*, g.us as pu, g.value as pv from h asof left join g on h.device = g.device and h.us >= g.us), b as (select a.*, g.us as nu, g.value as nv from a asof left join g on a.device = g.device and a.us <= g.us),
    c as (select b.*, f * f - y * y - z * z as r, case when pu is null then nv when nu is null then pv else pv + (nv - pv) * (us - pu) / (nu - pu) end as i from b join m using (device))
    select event_id, round(coalesce(value, case when r >= 0 then sqrt(r) * case when i < 0 then -1 else 1 end end, i), 5) as x from c""",
)
def m06(spark, d):
    df = events(spark, d).select("event_id", "device", "us", F.when(F.col("event_id") % 4 != 1, F.col("value")).alias("x"), ((F.col("event_id") % 17) / 10).alias("y"), ((F.col("event_id") % 13) / 10).alias("z"))
    return derived.recover_magnetometer_x(df, ["device"], "us", ["event_id"], "x", "y", "z").select("event_id", F.round("x", 5).alias("x"))


_PC = f"(select event_id, device, us, value, floor(event_id / 100.0) as t, 3.5 + (event_id % 20) / 10.0 as b from {E})"


@register(
    "m07_pressure_from_counts",
    f"""with c as (select *, lag(t) over (partition by device order by us) as pt from {_PC}), g as (select device, us, t from c where pt is null or t <> pt), a as (select c.*, g.us as pu, g.t as pv from c asof left join g on c.device = g.device and c.us >= g.us),
    b as (select a.*, g.us as nu, g.t as nv from a asof left join g on a.device = g.device and a.us <= g.us), i as (select *, case when nu is null or nu = pu then pv else pv + (nv - pv) * (us - pu) / (nu - pu) end as s from b)
    select event_id, round((0.001 * value + 0.5) * value - 3 + 0.02 * s + 1.5 * least(b, 4.2) - 1, 5) as p from i""",
)
def m07(spark, d):
    df = events(spark, d).select("event_id", "device", "us", F.col("value").alias("p"), F.floor(F.col("event_id") / 100).cast("double").alias("t"), (3.5 + (F.col("event_id") % 20) / 10).alias("b"))
    out = derived.pressure_from_counts(df, ["device"], "us", ["event_id"], "p", [0.001, 0.5, -3], "t", [0.02, 0], "b", [1.5, -1], 4.2)
    return out.select("event_id", F.round("p", 5).alias("p"))


@register("m17_declination_lookup", f"select event_id, round(5 + (lat - 55) * 2 + (lon - 20) * 3 + (2020 + event_id % 7 - (2020 + (event_id % 7 >= 5)::int * 5)) * 0.1 + (event_id % 7 >= 5)::int, 6) as declination from {P}")
def m17(spark, d):
    cells = spark.range(0, 41 * 41).select(F.expr("id div 41 - 20").alias("i"), (F.col("id") % 41 - 20).alias("j"))
    grid = cells.select("i", "j", F.explode(F.array(F.lit(2020), F.lit(2025))).alias("epoch")).select("i", "j", "epoch", (5 + F.col("i") * 0.05 * 2 + F.col("j") * 0.05 * 3 + (F.col("epoch") - 2020) / 5).alias("declination"), F.lit(0.1).alias("change"))
    p = positions(events(spark, d)).withColumn("year", 2020 + F.col("event_id") % 7)
    return rounded(derived.declination_lookup(p, grid, "lat", "lon", "year", (55, 20), 0.05, "event_id"))


