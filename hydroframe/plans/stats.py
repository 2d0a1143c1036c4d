"""Queries of bins, statistics and fits.  Speed is the value, direction (event_id * 37) mod 360, devices users or kinds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins, stats
from ..sources.series import events, table
from .filters import E, P, positions
from .registry import register

HOUR, DAY = 3_600_000_000, 86_400_000_000
#: Events with a speed and a direction, u and v.
V = f"(select *, (event_id * 37) % 360 as dir, value * sin(radians((event_id * 37) % 360)) as u, value * cos(radians((event_id * 37) % 360)) as v from {E})"


def velocities(spark, d):
    df = events(spark, d).withColumn("dir", (F.col("event_id") * 37) % 360)
    a = F.radians(F.col("dir"))
    return df.withColumns({"u": F.col("value") * F.sin(a), "v": F.col("value") * F.cos(a)})


def rounded(df, digits=6):
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@register(
    "a01_bin_mean",
    f"""with b as (select device, us // {DAY} * {DAY} as bin, count(*) as rows, avg(value) as value from {E} group by 1, 2), c as (select *, avg(rows) over (partition by device) / 10 as usual from b)
    select device, bin, rows, round(value, 6) as value from c where rows > usual and value is not null""",
)
def a01(spark, d):
    return rounded(stats.bin_mean(events(spark, d), ["device"], "us", DAY, ["value"]))


@register("a02_centered_bin_mean", f"select kind, (us + {HOUR // 2}) // {HOUR} * {HOUR} as bin, round(avg(value), 6) as value from {E} group by 1, 2")
def a02(spark, d):
    return rounded(stats.centered_bin_mean(events(spark, d), ["kind"], "us", HOUR, ["value"]))


@register(
    "a03_vector_bin_mean",
    f"""with b as (select kind, us // {HOUR} * {HOUR} as bin, avg(u) as u, avg(v) as v, count(*) as rows from {V} group by 1, 2)
    select kind, bin, rows, round(u, 6) as u, round(v, 6) as v, round(sqrt(u * u + v * v), 6) as "Vabs", round(degrees(atan2(u, v)), 4) as "Vdir" from b""",
)
def a03(spark, d):
    out = stats.vector_bin_mean(velocities(spark, d), ["kind"], "us", HOUR, "value", "dir")
    return out.withColumn("Vdir", F.round("Vdir", 4)).select("kind", "bin", "rows", *[F.round(c, 6).alias(c) for c in ("u", "v", "Vabs")], "Vdir")


@register(
    "a04_record_stats",
    f"""with b as (select device, avg(u) as u, avg(v) as v, max(sqrt(u * u + v * v)) as hi, min(sqrt(u * u + v * v)) as lo from {V} group by 1)
    select device, round(u, 6) as u_mean, round(v, 6) as v_mean, round(hi, 6) as v_max, round(lo, 6) as v_min, round(sqrt(u * u + v * v), 6) as v_abs, round((degrees(atan2(u, v)) + 360) % 360, 4) as v_dir, round((hi + lo) / 2, 6) as v_mid from b""",
)
def a04(spark, d):
    out = stats.record_stats(velocities(spark, d), ["device"], "u", "v")
    return rounded(out.withColumn("v_dir", F.round("v_dir", 4)))


@register(
    "a05_vector_series_stats",
    f"""with m as (select device, avg(value) as m from {E} group by 1), b as (select device, avg(u) as u, avg(v) as v, avg(sin(radians(dir))) as s, avg(cos(radians(dir))) as c, min(value) as lo, max(value) as hi, avg(value) as mean, var_pop(value) as va,
      stddev_pop(value) as sd, skewness(value) as sk, kurtosis(value) as ku, avg(abs(value - m)) as mad, count(*) as n, min(us) as st, max(us) as en from {V} join m using (device) group by 1)
    select device, lo as min, hi as max, round(mean, 6) as mean, round(va, 4) as var, round(sd, 6) as std, round(mad, 6) as mad, n, st as start, en as end, round(sqrt(u * u + v * v), 6) as vector_abs, round((degrees(atan2(u, v)) + 360) % 360, 3) as vector_dir,
      round((degrees(atan2(s, c)) + 360) % 360, 3) as dir_mean, round(degrees(sqrt(-2 * ln(sqrt(s * s + c * c)))), 4) as dir_std, round(sk, 4) as skew, round(ku, 4) as kurt, round(sd / mean, 6) as cv, round(hi - lo, 6) as range, round((en - st) / 86400000000, 6) as days,
      round(sqrt(u * u + v * v) / mean, 6) as stability from b""",
)
def a05(spark, d):
    out = stats.vector_series_stats(velocities(spark, d), ["device"], "us", "value", "dir")
    digits = {"var": 4, "vector_dir": 3, "dir_mean": 3, "dir_std": 4, "skew": 4, "kurt": 4}
    return out.select(*[F.round(c, digits.get(c, 6)).alias(c) if t == "double" else F.col(c) for c, t in out.dtypes])


_HB = f"(select kind, us // {HOUR} as hour, avg(value) as value, (us // {HOUR} * 53 + length(kind) * 71) % 360 as dir from {E} group by 1, 2, 4)"
_PAIRS = f"(select a.kind as kind_1, b.kind as kind_2, a.value as v1, b.value as v2, radians(a.dir) as d1, radians(b.dir) as d2 from {_HB} a join {_HB} b using (hour) where a.kind < b.kind)"


def hour_pairs(spark, d):
    bins = events(spark, d).groupBy("kind", F.expr(f"us div {HOUR}").alias("hour")).agg(F.avg("value").alias("value"))
    return joins.device_pairs(bins.withColumn("dir", (F.col("hour") * 53 + F.length("kind") * 71) % 360), "hour", "kind", ["value", "dir"])


@register(
    "a06_pair_correlation",
    f"""with p as {_PAIRS}, m as (select kind_1, kind_2, atan2(avg(sin(d1)), avg(cos(d1))) as a, atan2(avg(sin(d2)), avg(cos(d2))) as b from p group by 1, 2),
    c as (select kind_1, kind_2, corr(v1, v2) as r, count(*) as n, sum(sin(d1 - a) * sin(d2 - b)) / sqrt(sum(pow(sin(d1 - a), 2)) * sum(pow(sin(d2 - b), 2))) as circular_r from p join m using (kind_1, kind_2) group by 1, 2),
    h as (select *, (pi() / 2 - asin(abs(r))) / 20000 as h from c),
    i as (select kind_1, kind_2, sum(case when k in (0, 20000) then 1 when k % 2 = 1 then 4 else 2 end * pow(greatest(cos(asin(abs(r)) + k * h), 0), n - 3)) * any_value(h) / 3 as s from h, range(20001) as t(k) group by 1, 2)
    select kind_1, kind_2, round(r, 6) as r, n, round(circular_r, 6) as circular_r, round(2 * s * exp(lgamma((n - 1) / 2) - lgamma((n - 2) / 2) - lgamma(0.5)), 6) as p from c join i using (kind_1, kind_2)""",
)
def a06(spark, d):
    return rounded(stats.pair_correlation(hour_pairs(spark, d), "kind", "value", "dir"))


@register("a07_pair_shift", f"select kind_1, kind_2, round(avg(v1 - v2), 6) as shift, round(stddev_samp(v1 - v2), 6) as std from {_PAIRS} group by 1, 2")
def a07(spark, d):
    return rounded(stats.pair_shift(hour_pairs(spark, d), "kind", "value"))


@register("a08_drop_duplicate_times", f"select device, us // {DAY} as day, max_by(event_id, event_id) as event_id from {E} group by 1, 2")
def a08(spark, d):
    return stats.drop_duplicate_times(events(spark, d).select("device", F.expr(f"us div {DAY}").alias("day"), "event_id"), ["device"], "day", "event_id")


@register("a09_one_per_second", f"select event_id from (select event_id, row_number() over (partition by kind, round_even(us / 1e9, 0) order by us, event_id) as n from {E}) where n = 1")
def a09(spark, d):
    df = events(spark, d).withColumn("us", F.col("us") / 1000)
    return stats.one_per_second(df, ["kind"], "us", "event_id").select("event_id")


@register(
    "a10_value_mode",
    f"""with c as (select device, floor(value)::bigint as v, count(*) as n, min(event_id) as first from {E} group by 1, 2), r as (select *, row_number() over (partition by device order by n desc, v) as k from c) select device, v, n, first from r where k = 1""",
)
def a10(spark, d):
    return stats.value_mode(events(spark, d).withColumn("v", F.floor("value")), ["device"], "v", "event_id")


@register("a11_mean_abs_deviation", f"with m as (select device, avg(value) as m from {E} group by 1) select device, round(avg(abs(value - m)), 6) as mad from {E} join m using (device) group by 1")
def a11(spark, d):
    return rounded(stats.mean_abs_deviation(events(spark, d), ["device"], "value"))


@register("a12_mean_per_file", f"select 'cal_' || device || '.5.csv' as file, round(avg(value), 6) as value, device + 0.5 as point from {E} group by device")
def a12(spark, d):
    df = events(spark, d).withColumn("file", F.concat(F.lit("cal_"), "device", F.lit(".5.csv")))
    return rounded(stats.mean_per_file(df, "file", ["value"]))


@register(
    "a13_depth_weighted_mean",
    """with f as (select l_orderkey, l_linenumber::double as z, avg(l_quantity)::double as y from lineitem group by 1, 2), s as (select l_orderkey, z, y, lead(z) over w as z1, lead(y) over w as y1, min(z) over (partition by l_orderkey) as z0, max(z) over (partition by l_orderkey) as zz from f window w as (partition by l_orderkey order by z)),
    g as (select l_orderkey, z0 + i * 0.1 as x, i from (select l_orderkey, min(z) as z0, max(z) as zz from f group by 1), unnest(range(0, ((zz - z0) * 10 + 1.000001)::bigint)) as t(i)),
    v as (select g.l_orderkey, i, case when s.z1 is null then s.y else s.y + (s.y1 - s.y) * (x - s.z) / (s.z1 - s.z) end as y from g asof join s on g.l_orderkey = s.l_orderkey and g.x + 1e-7 >= s.z)
    select l_orderkey, round(avg(y), 4) as mean, count(*) as steps from v group by 1""",
)
def a13(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("double").alias("z"), F.col("l_quantity").cast("double").alias("y"))
    return stats.depth_weighted_mean(li, ["l_orderkey"], "z", "y").select("l_orderkey", F.round("mean", 4).alias("mean"), F.col("steps").cast("long").alias("steps"))


_RUN = f"(select *, us // {DAY} as run from {E})"
_SUM = f"(select device, run, min(us) as \"Time_st\", max(us) as \"Time_en\", count(*) as rows, min_by(value, us) as value_st, max_by(value, us) as value_en from {_RUN} group by 1, 2)"


def day_runs(spark, d):
    return events(spark, d).withColumn("run", F.expr(f"us div {DAY}"))


@register("a14_run_summary", f"select *, lead(\"Time_st\") over (partition by device order by \"Time_st\") - \"Time_en\" as to_next from {_SUM}")
def a14(spark, d):
    return stats.run_summary(day_runs(spark, d), ["device"], "run", "us", ["value"])


@register("a15_merge_runs", f"select device, run - run % 2 as run, min(\"Time_st\") as \"Time_st\", max(\"Time_en\") as \"Time_en\", sum(rows)::bigint as rows, min_by(value_st, \"Time_st\") as value_st, max_by(value_en, \"Time_en\") as value_en from {_SUM} group by 1, 2")
def a15(spark, d):
    log = stats.run_summary(day_runs(spark, d), ["device"], "run", "us", ["value"]).drop("to_next")
    merges = log.where("run % 2 = 1").select("device", "run", (F.col("run") - 1).alias("into"))
    return stats.merge_runs(log, merges, ["device"])


@register("a16_time_holes", f"select * from (select device, us as start, lead(us) over (partition by device order by us) - us as size from {E}) where size > {2 * DAY}")
def a16(spark, d):
    return stats.time_holes(events(spark, d), ["device"], "us", 2 * DAY)


@register(
    "a16b_fill_start",
    f"""with h as (select device, us as start, lead(us) over (partition by device order by us) - us as size from {E}), m as (select max(us) as now from {E})
    select device, coalesce(min(start) filter (size > {DAY} and start >= 1704067200000000), max(start)) as fill_start from h group by 1""",
)
def a16b(spark, d):
    return stats.fill_start(events(spark, d), ["device"], "us", DAY, 30 * DAY, 1704067200000000 + 30 * DAY)


def vectors3(spark, d):
    e = table(spark, d, "embeddings")
    return e.select("label", "vec_id", *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(("ax", "ay", "az", "mx", "my", "mz"))])


_G = "(select label, vec_id, embedding[1]::double as ax, embedding[2]::double as ay, embedding[3]::double as az, embedding[4]::double as mx, embedding[5]::double as my, embedding[6]::double as mz from embeddings)"


@register(
    "a17_sphere_bin_mean",
    f"""select label, least(floor((az / sqrt(ax * ax + ay * ay + az * az) + 1) / 2 * 6), 5)::bigint as i, least(floor((atan2(ay, ax) + pi()) / (2 * pi()) * 12), 11)::bigint as j, count(*) as n, round(avg(ax), 6) as ax, round(avg(ay), 6) as ay, round(avg(az), 6) as az from {_G} group by 1, 2, 3""",
)
def a17(spark, d):
    return rounded(stats.sphere_bin_mean(vectors3(spark, d), ["label"], "ax", "ay", "az", 6))


@register("a18_ellipsoid_fit")
def a18(spark, d):
    return stats.ellipsoid_fit(vectors3(spark, d), ["label"], "mx", "my", "mz")


@register("a19_polynomial_fit", f"select device, round(regr_slope(value, event_id), 8) as slope, round(regr_intercept(value, event_id), 4) as intercept from {E} group by 1")
def a19(spark, d):
    out = stats.polynomial_fit(events(spark, d), ["device"], "event_id", "value", 1)
    return out.select("device", F.round(F.col("coefs")[0], 8).alias("slope"), F.round(F.col("coefs")[1], 4).alias("intercept"))


@register("a19b_cubic_fit")
def a19b(spark, d):
    return stats.polynomial_fit(events(spark, d).withColumn("x", F.col("us") / DAY), ["device"], "x", "value", 3)


@register("a20_angular_fit")
def a20(spark, d):
    v = velocities(spark, d).withColumn("to", (F.col("dir") + 20 + 5 * F.sin(F.radians(F.col("dir")))) % 360)
    return stats.angular_fit_apply(v, stats.angular_fit(v, ["kind"], "dir", "to"), ["kind"], "dir").select("event_id", F.round("fitted", 4).alias("fitted"))


@register(
    "a21_zeroing_rotation",
    f"""with m as (select label, avg(ax) as a, avg(ay) as b, avg(az) as c from {_G} group by 1), r as (select *, sqrt(a * a + b * b + c * c) as r from m), n as (select label, a / r as x, b / r as y, c / r as z, 1 / (1 + c / r) as k from r)
    select vec_id, round((1 - k * x * x) * ax - k * x * y * ay - x * az, 6) as ax, round(-k * x * y * ax + (1 - k * y * y) * ay - y * az, 6) as ay, round(x * ax + y * ay + z * az, 6) as az from {_G} join n using (label)""",
)
def a21(spark, d):
    v = vectors3(spark, d)
    return stats.rotate_by(v, stats.zeroing_rotation(v, ["label"], ["ax", "ay", "az"]), ["label"], ["ax", "ay", "az"]).select("vec_id", *[F.round(c, 6).alias(c) for c in ("ax", "ay", "az")])


@register("a22_azimuth_zeroing", f"select kind, round(-degrees(atan2(quantile_cont(u, 0.5), quantile_cont(v, 0.5))), 4) as azimuth_shift from {V} where value > 10 and value < 170 group by 1")
def a22(spark, d):
    return stats.azimuth_zeroing(velocities(spark, d), ["kind"], "u", "v", "value").select("kind", F.round("azimuth_shift", 4).alias("azimuth_shift"))


@register("a23_mean_anchor", f"select device, round(avg(lat), 6) as anchor_lat, round(avg(lon), 6) as anchor_lon from {P} group by 1")
def a23(spark, d):
    return rounded(stats.mean_anchor(positions(events(spark, d)), ["device"], "lat", "lon"))


@register("a24_interval_std", f"select kind, us // {HOUR} * {HOUR} as bin, round(stddev_samp(value), 6) as value_std from {E} group by 1, 2")
def a24(spark, d):
    return rounded(stats.interval_std(events(spark, d), ["kind"], "us", HOUR, ["value"]))


@register("a25_mean_speed_compare", f"with m as (select avg(sqrt(u * u + v * v)) filter (kind = 'view') as a, avg(sqrt(u * u + v * v)) filter (kind = 'click') as b from {V}) select round(a, 6) as mean_1, round(b, 6) as mean_2, round(a - b, 6) as difference from m")
def a25(spark, d):
    v = velocities(spark, d)
    return rounded(stats.mean_speed_compare(v.where("kind = 'view'"), v.where("kind = 'click'"), "u", "v"))


@register("a26_last_row_per_interval", f"select device, run, max(us) as us, max_by(value, us) as value from {_RUN} group by 1, 2")
def a26(spark, d):
    return stats.last_row_per_interval(day_runs(spark, d), ["device", "run"], "us", ["value"])

