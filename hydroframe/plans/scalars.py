"""Queries of the scalar functions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import geo, seawater, teos, times, vectors
from ..operators import joins
from ..sources.series import events
from .filters import E, P, positions
from .joins import points
from .registry import register
from .stats import _G, HOUR, rounded, vectors3, velocities



@register("m01_polar_cartesian", f"select event_id, round(value, 6) as speed, round(case when (event_id * 37) % 360 > 180 then (event_id * 37) % 360 - 360 else (event_id * 37) % 360 end::double, 4) as half, round((event_id * 37) % 360::double, 4) as whole from {E} where value > 0 and (event_id * 37) % 180 <> 0")
def m01(spark, d):
    v = velocities(spark, d).where("value > 0 and dir % 180 <> 0")
    (speed, half), (_, whole) = vectors.to_polar(F.col("u"), F.col("v")), vectors.to_polar(F.col("u"), F.col("v"), wrap=True)
    return v.select("event_id", F.round(speed, 6).alias("speed"), F.round(half, 4).alias("half"), F.round(whole, 4).alias("whole"))


@register("m02_tilt_angles", f"select vec_id, round(-atan(ax / sqrt(ay * ay + az * az)), 6) as pitch, round(atan2(ay, az), 6) as roll, round(atan2(sqrt(ax * ax + ay * ay), az), 6) as inclination from {_G}")
def m02(spark, d):
    v = vectors3(spark, d)
    return v.select("vec_id", *[F.round(c, 6).alias(n) for n, c in vectors.tilt(F.col("ax"), F.col("ay"), F.col("az")).items()])


_CAL = "1.1 * (ax - 0.01) + 0.02 * (ay + 0.02) - 0.03 * az as gx, 0.01 * (ax - 0.01) + 0.95 * (ay + 0.02) + 0.04 * az as gy, -0.02 * (ax - 0.01) + 0.03 * (ay + 0.02) + 1.05 * az as gz"


def _coefs():
    matrix = F.array(*[F.array(*map(F.lit, r)) for r in ((1.1, 0.02, -0.03), (0.01, 0.95, 0.04), (-0.02, 0.03, 1.05))])
    return matrix, F.array(F.lit(0.01), F.lit(-0.02), F.lit(0.0))


@register("m03_apply_calibration", f"with g as (select vec_id, {_CAL} from {_G}) select vec_id, round(gx, 6) as gx, round(gy * cos(0.3) - gz * sin(0.3), 6) as gy, round(gy * sin(0.3) + gz * cos(0.3), 6) as gz from g")
def m03(spark, d):
    v = vectors3(spark, d)
    g = vectors.calibrated([F.col(c) for c in ("ax", "ay", "az")], *_coefs())
    return v.select("vec_id", *[F.round(c, 6).alias(n) for n, c in zip(("gx", "gy", "gz"), vectors.rotated(*g, "x", F.lit(0.3)), strict=True)])


@register(
    "m04_speed_from_tilt",
    f"""with i as (select event_id, radians(least(value, 80)) as r from {E}), s as (select *, sqrt(sin(r) / (1.5 + 0.4 * cos(r) + 0.3 * sin(r))) as trig, sqrt(sin(radians(60)) / (1.5 + 0.4 * cos(radians(60)) + 0.3 * sin(radians(60)))) as top,
      sqrt(sin(radians(60) - 0.01) / (1.5 + 0.4 * cos(radians(60) - 0.01) + 0.3 * sin(radians(60) - 0.01))) as near from i)
    select event_id, round(case when r <= radians(60) then trig else top + (r - radians(60)) * least((top - near) / 0.01, 10) end, 6) as by_series, round((0.02 * sqrt(tan(r) / cos(r)) + 0.3) * sqrt(tan(r) / cos(r)) + 0.01, 6) as by_force from s""",
)
def m04(spark, d):
    r = F.radians(F.least(F.col("value"), F.lit(80.0)))
    series, force = (F.array(*map(F.lit, c)) for c in ((1.5, 0.4, 0.3, 0.0, 0.0, 60.0), (0.02, 0.3, 0.01)))
    return events(spark, d).select("event_id", F.round(vectors.speed_from_tilt(r, series), 6).alias("by_series"), F.round(vectors.speed_from_tilt(r, force), 6).alias("by_force"))


@register(
    "m05_flow_direction",
    f"""with g as (select vec_id, mx, my, mz, {_CAL} from {_G}) select vec_id, round(((20 - degrees(atan2((gx * my - gy * mx) * sqrt(gx * gx + gy * gy + gz * gz), mz * (gx * gx + gy * gy) - gz * (gx * mx + gy * my)))) % 360 + 360) % 360, 4) as direction from g""",
)
def m05(spark, d):
    g = vectors.calibrated([F.col(c) for c in ("ax", "ay", "az")], *_coefs())
    v = vectors3(spark, d)
    return v.select("vec_id", F.round(vectors.flow_direction(g, [F.col(c) for c in ("mx", "my", "mz")], F.lit(20.0)), 4).alias("direction"))


@register(
    "m08_displacement_bearing",
    f"""with l as (select event_id, lat, lon, lag(lat) over w as la, lag(lon) over w as lo from {P} window w as (partition by device order by us)), q as (select event_id, radians(lat - la) * 6371000 as dy, radians(lon - lo) * 6371000 * cos(radians((lat + la) / 2)) as dx from l)
    select event_id, round(dx, 3) as dx, round(dy, 3) as dy, round(sqrt(dx * dx + dy * dy), 3) as distance, round((degrees(atan2(dx, dy)) + 360) % 360, 3) as bearing from q""",
)
def m08(spark, d):
    w = Window.partitionBy("device").orderBy("us")
    p = positions(events(spark, d))
    found = geo.displacement(F.lag("lon").over(w), F.lag("lat").over(w), F.col("lon"), F.col("lat"))
    return p.select("event_id", *[F.round(c, 3).alias(n) for n, c in found.items()])


@register(
    "m09_angle_interpolation",
    f"""with v as (select device, us, (event_id * 37) % 360 as dir from {E} where kind = 'view'), p as (select event_id, device, us from {E} where kind = 'purchase'), a as (select p.*, v.us as pu, v.dir as pd from p asof left join v on p.device = v.device and p.us >= v.us),
    b as (select a.*, v.us as nu, v.dir as nd from a asof left join v on a.device = v.device and a.us <= v.us), f as (select *, (us - pu) / (nu - pu) as f from b where pu < nu)
    select event_id, round((degrees(atan2(sin(radians(pd)) + (sin(radians(nd)) - sin(radians(pd))) * f, cos(radians(pd)) + (cos(radians(nd)) - cos(radians(pd))) * f)) + 360) % 360, 3) as dir from f""",
)
def m09(spark, d):
    series = velocities(spark, d).where("kind = 'view'").select("device", "us", F.sin(F.radians("dir")).alias("s"), F.cos(F.radians("dir")).alias("c"))
    at = joins.interpolate_join(points(spark, d), series, ["device"], "us", ["s", "c"])
    angle = F.pmod(F.degrees(F.atan2("int_s", "int_c")), F.lit(360.0))
    return at.where("int_s is not null").select("event_id", F.round(angle, 3).alias("dir"))


def _poly_sql(x: str, coefs) -> str:
    return " + ".join(f"({c}) * pow({x}, {i})" for i, c in enumerate(coefs))


@register(
    "m10_seawater_properties",
    f"""with q as (select event_id, 20 + value % 15 as c, value % 20 as t, (event_id % 200)::double as p from {E}), r as (select *, t * 1.00024 as t68, c / 42.9140 as r from q),
    x as (select *, sqrt(r / ((1 + p * (2.070e-5 + p * (-6.370e-10 + p * 3.989e-15)) / (1 + 3.426e-2 * t68 + 4.464e-4 * t68 * t68 + (4.215e-1 - 3.107e-3 * t68) * r)) * ({_poly_sql("t68", seawater._C)}))) as x from r),
    s as (select *, {_poly_sql("x", seawater._A)} + (t68 - 15) / (1 + 0.0162 * (t68 - 15)) * ({_poly_sql("x", seawater._B)}) as s from x)
    select event_id, round(s, 5) as sp, round(s * 35.16504 / 35 + 0.087 * (1 - s / 35), 5) as sa, round({_poly_sql("t", seawater._PURE)} + s * ({_poly_sql("t", seawater._SALT)} + sqrt(s) * ({_poly_sql("t", seawater._SALT15)}) + s * 4.8314e-4), 4) as rho from s""",
)
def m10(spark, d):
    c, t, p = 20 + F.col("value") % 15, F.col("value") % 20, (F.col("event_id") % 200).cast("double")
    sp = seawater.practical_salinity(c, t, p)
    sa = seawater.absolute_salinity(F.col("sp"), F.lit(20.0), F.lit(55.0))
    out = events(spark, d).select("event_id", t.alias("t"), sp.alias("sp"))
    return out.select("event_id", F.round("sp", 5).alias("sp"), F.round(sa, 5).alias("sa"), F.round(seawater.density_at_surface(F.col("sp"), F.col("t")), 4).alias("rho"))


def _teos_sql(source: str) -> str:
    """Rows of source (s, t, p and more) with potential and conservative temperature, sigma0, sound speed and height."""
    e, g = teos, teos.GUESS
    flat = lambda x: {k[:2]: c for k, c in x.items() if k[2] == 0}
    at = lambda x, *v: e.nested_sql(x, list(v))
    by_y, by_z = e.derived(e.S, 1), e.derived(e.S, 2)
    out = f"""(select *, sqrt({e.SFAC} * s) as x, t * 0.025 as y, p * 1e-4 as z, s * 35 / {e.SSO} as s1 from {source})"""
    out = f"""(select *, {at(e.S, "x", "y", "z")} as part, t + p * ({g[0]} + s1 * {g[1]} + p * {g[2]} + t * ({g[3]} + s1 * {g[4]} + t * {g[5]} + p * {g[6]})) as pt0 from {out})"""
    out = f"(select *, -{e.CP0} / ((pt0 + 273.15) * (1 - 0.05 * (1 - s / {e.SSO}))) / 0.025 as slope0 from {out})"
    for n in (0, 1):
        out = f"(select *, pt{n} * 0.025 as w{n} from {out})"
        out = f"(select *, ({at(flat(e.S), 'x', f'w{n}')}) - part as off{n} from {out})"
        out = f"(select *, (2 * pt{n} - off{n} / slope{n}) * 0.0125 as u{n} from {out})"
        out = f"(select *, ({at(flat(by_y), 'x', f'u{n}')}) * 0.025 as slope{n + 1} from {out})"
        out = f"(select *, pt{n} - off{n} / slope{n + 1} as pt{n + 1} from {out})"
    out = f"(select *, pt2 * 0.025 as w2, sin(radians(55.0)) * sin(radians(55.0)) as ls from {out})"
    out = f"(select *, ({at({k[:2]: c for k, c in e.H.items()}, 'x', 'w2')}) / {e.CP0} as ct, 9.780327 * (1 + (5.2792e-3 + 2.32e-5 * ls) * ls) as g0, ({at({(i,): c for i, c in enumerate(e.STANDARD_ENTHALPY)}, 'z')}) * 1e8 as h0 from {out})"
    out = f"(select *, sqrt({e.SFAC} * s + {e.OFFSET}) as xv, ct * 0.025 as yv, {at(e.G_Z, 'x', 'y', 'z')} as v, {at(e.derived(e.G_Z, 2), 'x', 'y', 'z')} as vz, {at(by_y, 'x', 'y', 'z')} as cy, {at(by_z, 'x', 'y', 'z')} as cz from {out})"
    return f"(select *, 1 / ({at(flat(e.V), 'xv', 'yv')}) - 1000 as sigma0, v * sqrt(cy / (cz * cz - cy * vz)) as sound, -2 * h0 / (g0 + sqrt(g0 * g0 + 2 * {e.GAMMA} * g0 * h0)) as height from {out})"


@register(
    "m10b_profile_properties",
    f"""select event_id, round(pt2, 9) as theta, round(ct, 9) as ct, round(sigma0, 8) as sigma0, round(sound, 6) as sound, round(height, 8) as height
    from {_teos_sql(f"(select event_id, 5 + value % 30 as s, value % 20 as t, (event_id % 200)::double as p from {E})")}""",
)
def m10b(spark, d):
    s, t, p = F.col("s"), F.col("t"), F.col("p")
    q = events(spark, d).select("event_id", (5 + F.col("value") % 30).alias("s"), (F.col("value") % 20).alias("t"), (F.col("event_id") % 200).cast("double").alias("p"))
    q = teos.Steps(q)
    theta = teos.potential_temperature(s, t, p, q.let)
    q.frame = q.frame.withColumn("theta", theta)
    ct = teos.conservative_temperature_of_potential(s, F.col("theta"), q.let)
    q.frame = q.frame.withColumn("ct", ct)
    out = {"theta": (F.col("theta"), 9), "ct": (F.col("ct"), 9), "sigma0": (teos.sigma0(s, F.col("ct"), q.let), 8), "sound": (teos.sound_speed(s, t, p, q.let), 6), "height": (teos.height(p, F.lit(55.0), q.let), 8)}
    return q.frame.select("event_id", *[F.round(c, n).alias(k) for k, (c, n) in out.items()])


@register(
    "m11_oxygen_from_voltage",
    f"""with q as (select event_id, us, device, value % 5 as v, value % 20 as t, (event_id % 200)::double as p from {E}), x as (select *, coalesce((v - lag(v) over w) / nullif((us - lag(us) over w) / 1e6, 0), 0) as dv, ln((298.15 - t) / (273.15 + t)) as ts from q window w as (partition by device order by us)),
    o as (select *, exp({_poly_sql("ts", seawater._OX_A)} + 7.5 * ({_poly_sql("ts", seawater._OX_B)}) - 2.75915e-7 * 56.25) as sol from x)
    select event_id, round(sol, 5) as solubility, round(0.4 * (v - 0.5 + 1.5 * exp(1.9e-4 * p - 4.6e-2 * (t - 20)) * dv) * (1 + t * (-3e-3 + t * (1.5e-4 + t * -2e-6))) * sol * exp(0.036 * p / (t + 273.15)), 5) as oxygen from o""",
)
def m11(spark, d):
    w = Window.partitionBy("device").orderBy("us")
    q = events(spark, d).select("event_id", "us", "device", (F.col("value") % 5).alias("v"), (F.col("value") % 20).alias("t"), (F.col("event_id") % 200).cast("double").alias("p"))
    q = q.withColumn("dv", F.coalesce(F.try_divide(F.col("v") - F.lag("v").over(w), (F.col("us") - F.lag("us").over(w)) / 1e6), F.lit(0.0)))
    coefs = {"Soc": 0.4, "Voffset": -0.5, "tau20": 1.5, "A": -3e-3, "B": 1.5e-4, "C": -2e-6, "E": 0.036, "D1": 1.9e-4, "D2": -4.6e-2}
    s = F.lit(7.5)
    return q.select("event_id", F.round(seawater.oxygen_solubility(F.col("t"), s), 5).alias("solubility"), F.round(seawater.oxygen_from_voltage(F.col("v"), F.col("dv"), F.col("t"), s, F.col("p"), coefs), 5).alias("oxygen"))


@register("m12_old_probe_polynomials", f"select event_id, round((2e-4 * value - 0.3) * value + 5 + device, 9) as value from {E}")
def m12(spark, d):
    coefs = events(spark, d).select("device").distinct().select("device", F.array(F.lit(2e-4), F.lit(-0.3), F.lit(5.0) + F.col("device")).alias("coefs"))
    return rounded(events(spark, d).join(coefs, "device").select("event_id", seawater.probe_value(F.col("value"), F.col("coefs")).alias("value")), 9)


@register(
    "m13_coordinate_text",
    f"""select event_id, round(case when event_id % 2 = 0 then -lat else lat end, 8) as from_ddmm, round(floor(lat) + 12 / 60.0 + (event_id % 60) / 3600.0, 8) as from_dms from {P}""",
)
def m13(spark, d):
    p = positions(events(spark, d))
    minutes = (F.col("lat") - F.floor("lat")) * 60
    ddmm = F.concat(F.floor("lat").cast("string"), F.format_string("%013.10f", minutes))
    dms = F.concat(F.floor("lat").cast("string"), F.lit("°12'"), (F.col("event_id") % 60).cast("string"), F.lit("''"))
    south = F.when(F.col("event_id") % 2 == 0, "S").otherwise("N")
    return p.select("event_id", F.round(geo.signed_by_hemisphere(geo.degrees_from_ddmm(ddmm), south), 8).alias("from_ddmm"), F.round(geo.degrees_from_dms(dms), 8).alias("from_dms"))


@register("m13b_degree_minute_text", f"select event_id, floor(lat)::int || ' ' || printf('%08.5f', (lat - floor(lat)) * 60) || 'N' as text from {P}")
def m13b(spark, d):
    return positions(events(spark, d)).select("event_id", geo.degree_minute_text(F.col("lat"), "NS").alias("text"))


_FORMS = {"ctd_us": "%m/%d/%Y %H:%M:%S", "ctd_b": "%d.%m.%Y %H:%M:%S", "rock": "%Y-%m-%d %H:%M:%S", "nav_ses": "%d.%m.%Y %H%M%S"}


@register("m14_device_time_parse", f"select event_id, us // 1000000 as {', us // 1000000 as '.join(_FORMS)}, us // 1000000 as fields, case when event_id % 7 = 0 then null else us // 1000000 end as quoted from {E}")
def m14(spark, d):
    df = events(spark, d)
    spark_form = {"ctd_us": "MM/dd/yyyy HH:mm:ss", "ctd_b": "dd.MM.yyyy HH:mm:ss", "rock": "yyyy-MM-dd HH:mm:ss", "nav_ses": "dd.MM.yyyy HHmmss"}
    read = [F.unix_seconds(times.parse_device_time(k, F.date_format("ts", f))).alias(k) for k, f in spark_form.items()]
    part = [F.date_format("ts", x) for x in ("yy", "M", "d", "H", "m", "s")]
    quoted = F.when(F.col("event_id") % 7 == 0, "no time").otherwise(F.concat(F.lit('"'), F.date_format("ts", "M/d/yyyy"), F.lit('"')))
    return df.select("event_id", *read, F.unix_seconds(times.from_fields(*part)).alias("fields"), F.unix_seconds(times.parse_device_time("ctd_c", quoted, F.date_format("ts", "H:mm:ss"))).alias("quoted"))


@register("m14b_fill_bad_times", f"select event_id, last_value(case when event_id % 5 <> 2 then us end ignore nulls) over (partition by device order by event_id) as us from {E}")
def m14b(spark, d):
    df = events(spark, d).withColumn("us", F.when(F.col("event_id") % 5 != 2, F.col("us")))
    return times.fill_bad_times(df, ["device"], ["event_id"], "us").select("event_id", "us")


@register("m15_time_units", f"select event_id, us // 1000000 as from_matlab, round(2024 + (dayofyear(ts) - 1) / 366.0, 8) as year, us + {2 * HOUR} as local from {E}")
def m15(spark, d):
    df = events(spark, d)
    matlab = F.expr("us div 1000000") / 86400.0 + 719529.0
    return df.select("event_id", F.round(times.from_matlab(matlab) / 1e6).cast("long").alias("from_matlab"), F.round(times.year_fraction(F.col("ts")), 8).alias("year"), times.zone_view(F.col("us"), 2).alias("local"))


def _utm_sql() -> str:
    """The Krueger series written out for zone 34."""
    n = 1 / (2 * 298.257223563 - 1)
    radius = 6378137.0 / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    beta = [n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480]
    delta = [2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15]
    sinh, cosh = "((exp({0}) - exp(-({0}))) / 2)", "((exp({0}) + exp(-({0}))) / 2)"
    xi = "xi" + "".join(f" - {b!r} * sin({2 * j} * xi) * {cosh.format(f'{2 * j} * eta')}" for j, b in enumerate(beta, 1))
    eta = "eta" + "".join(f" - {b!r} * cos({2 * j} * xi) * {sinh.format(f'{2 * j} * eta')}" for j, b in enumerate(beta, 1))
    lat = "chi" + "".join(f" + {c!r} * sin({2 * j} * chi)" for j, c in enumerate(delta, 1))
    return f"""with a as (select event_id, (6095000.0 + (lat - 55) * 111000) / {0.9996 * radius!r} as xi, (lon - 20) * 64000 / {0.9996 * radius!r} as eta from {P}),
    b as (select event_id, {xi} as xi, {eta} as eta from a), c as (select *, asin(sin(xi) / {cosh.format("eta")}) as chi from b)
    select event_id, round(degrees({lat}), 8) as lat, round(degrees(atan2({sinh.format("eta")}, cos(xi))) + 21, 8) as lon from c"""


@register("m16_utm_inverse", _utm_sql())
def m16(spark, d):
    p = positions(events(spark, d)).withColumns({"x": 500000 + (F.col("lon") - 20) * 64000, "y": F.lit(6_095_000.0) + (F.col("lat") - 55) * 111000})
    return p.select("event_id", *[F.round(c, 8).alias(n) for n, c in geo.utm_inverse(F.col("x"), F.col("y")).items()])


@register("m18_track_direction_rule", f"select event_id, case when (event_id * 37) % 360 < 45 or (event_id * 37) % 360 > 315 then true when abs((event_id * 37) % 360 - 180) < 45 then false else (event_id * 37) % 360 > 180 end as reversed from {E}")
def m18(spark, d):
    return velocities(spark, d).select("event_id", geo.track_reversed(F.col("dir").cast("double")).alias("reversed"))


@register("m19_project_on_line", f"with v as (select event_id, ax, ay, az, mx, my, mz from (select vec_id as event_id, ax, ay, az, mx, my, mz from {_G})), t as (select *, ((my - ax) * (az - ax) + (mz - ay) * (mx - ay)) / (pow(az - ax, 2) + pow(mx - ay, 2)) as t from v) select event_id as vec_id, round(ax + (az - ax) * t, 6) as x, round(ay + (mx - ay) * t, 6) as y from t")
def m19(spark, d):
    x, y = geo.foot_on_line(*[F.col(c) for c in ("ax", "ay", "az", "mx", "my", "mz")])
    return vectors3(spark, d).select("vec_id", F.round(x, 6).alias("x"), F.round(y, 6).alias("y"))


@register("m20_grid_bbox", f"select event_id, round(floor(lat / 0.25) * 0.25 + 0.5, 6) as north, round(floor(lon / 0.25) * 0.25 - 0.25, 6) as west, round(floor(lat / 0.25) * 0.25 - 0.25, 6) as south, round(floor(lon / 0.25) * 0.25 + 0.5, 6) as east from {P}")
def m20(spark, d):
    return positions(events(spark, d)).select("event_id", *[F.round(c, 6).alias(n) for n, c in geo.grid_bbox(F.col("lat"), F.col("lon"), 0.25, 1).items()])


@register("m21_psig_to_dbar", f"select event_id, round(value * 0.6894757293168361, 6) as dbar from {E}")
def m21(spark, d):
    return events(spark, d).select("event_id", F.round(vectors.psig_to_dbar(F.col("value")), 6).alias("dbar"))


@register("m23_hour_rollover_days", f"with h as (select event_id, kind, us, us // {HOUR} % 24 as h, lag(us // {HOUR} % 24) over (partition by kind order by us) as b from {E}) select event_id, sum((b > h)::int) over (partition by kind order by us)::bigint as days from h".replace("(b > h)::int", "coalesce((b > h)::int, 0)"))
def m23(spark, d):
    df = events(spark, d).withColumn("hour", F.expr(f"us div {HOUR} % 24"))
    return times.hour_rollover_days(df, ["kind"], ["us"], "hour").select("event_id", "days")




@register(
    "m22_buoyancy_frequency",
    f"""with q as (select device, event_id, event_id % 200 + event_id / 100000.0 as p, 5 + value / 10 as s, value % 20 as t from {E}),
    h as (select *, -2 * h0 / (g0 + sqrt(g0 * g0 + 2 * {teos.GAMMA} * g0 * h0)) as height from (
      select *, ({teos.nested_sql({(i,): c for i, c in enumerate(teos.STANDARD_ENTHALPY)}, ["(p * 1e-4)"])}) * 1e8 as h0, 9.780327 * (1 + (5.2792e-3 + 2.32e-5 * ls) * ls) as g0 from (select *, sin(radians(55.0)) * sin(radians(55.0)) as ls from q))),
    m as (select event_id, s, t, p, lead(s) over w - s as ds, lead(t) over w - t as dt, lead(p) over w - p as dp, g0 * (1 - {teos.GAMMA} * (height + lead(height) over w) / 2) as g from h window w as (partition by device order by p)),
    x as (select *, sqrt({teos.SFAC} * (s + ds / 2) + {teos.OFFSET}) as x, (t + dt / 2) * 0.025 as y, (p + dp / 2) * 1e-4 as z from m),
    v as (select *, {teos.nested_sql(teos.V, ["x", "y", "z"])} as v, {teos.nested_sql(teos.derived(teos.V, 0), ["x", "y", "z"])} as vx, {teos.nested_sql(teos.derived(teos.V, 1), ["x", "y", "z"])} as vy from x)
    select event_id, round(g * g * -(vy * 0.025 * dt + vx * {teos.SFAC} / (2 * x) * ds) / (v * v * 1e4 * dp), 9) as n2 from v""",
)
def m22(spark, d):
    w = Window.partitionBy("device").orderBy("p")
    q = events(spark, d).select("device", "event_id", (F.col("event_id") % 200 + F.col("event_id") / 100000).alias("p"), (5 + F.col("value") / 10).alias("s"), (F.col("value") % 20).alias("t"))
    q = q.withColumns({f"n_{c}": F.lead(c).over(w) for c in "stp"})
    q = teos.Steps(q)
    n2 = teos.n_squared(F.col("s"), F.col("t"), F.col("p"), F.col("n_s"), F.col("n_t"), F.col("n_p"), F.lit(55.0), q.let)
    return q.frame.select("event_id", F.round(n2, 9).alias("n2"))
