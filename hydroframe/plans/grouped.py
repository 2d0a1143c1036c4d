"""Queries of operators that walk one group in order; groups are the days or bursts of a device."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import grouped, sequence, stats
from ..sources.series import events
from .filters import E
from .registry import register
from .stats import DAY, HOUR, day_runs, rounded


#: The pressure below as SQL, and its rows numbered from 0 in each block.
PRESSURE = f"(select 'probe' as device, event_id, us, value, 80 - 0.8e0 * abs(event_id % 200 - 100) + value % 1 as p, event_id // 1000 as block from {E})"
_NUMBERED = f"(select *, row_number() over (partition by block order by us) - 1 as n from {PRESSURE})"
#: Values of each kind on even hours.
_HOURS = f"""(with g as (select kind, us, value from {E}), x as (select kind, unnest(range(((min(us) + {HOUR} - 1) // {HOUR} * {HOUR})::bigint, (max(us) // {HOUR} * {HOUR} + 1)::bigint, {HOUR})) as us from g group by kind),
    a as (select x.*, g.us as pu, g.value as pv from x asof left join g on x.kind = g.kind and x.us >= g.us), b as (select a.*, g.us as nu, g.value as nv from a asof left join g on a.kind = g.kind and a.us <= g.us)
    select kind, us, case when nu = pu then pv else pv + (nv - pv) * (us - pu) / (nu - pu) end as value, row_number() over (partition by kind order by us) - 1 as n from b)"""


def _taps_sql(half: int, cutoff: float, high_pass: bool) -> str:
    """Relations t and taps (a from -half to half, w): a windowed sinc, the Bessel function by its series."""
    bessel = f"list_sum(list_transform(range(40), lambda k: pow(pow({0.1102 * 51.3}, 2) * (1 - pow(a / {half}, 2)) / 4, k) / pow(gamma(k + 1), 2)))"
    w = "case when a = 0 then 1 else 0 end - w / sum(w) over ()" if high_pass else "w / sum(w) over ()"
    return f"t as (select a, case when a = 0 then {cutoff}e0 else sin(pi() * {cutoff}e0 * a) / (pi() * a) end * {bessel} as w from range(-{half}, {half + 1}) as r(a)), taps as (select a, {w} as w from t)"


def _filtered_sql(key: str, column: str) -> str:
    """Rows of s (with n, from 0 in each key) filtered by taps, reflected at both ends."""
    at = "((s.n + a) % (2 * c - 2) + 2 * c - 2) % (2 * c - 2)"
    return f"""l as (select {key}, count(*) as c from s group by 1), m as (select s.{key}, s.n, w, case when {at} < c then {at} else 2 * c - 2 - {at} end as k from s join l using ({key}), taps),
    f as (select m.{key}, m.n, sum(w * s.{column}) as y from m join s on s.{key} = m.{key} and s.n = m.k group by 1, 2)"""


def pressure(spark, d):
    """A made-up pressure: casts of 200 events down to 80 decibars, with noise from the value."""
    phase = F.abs((F.col("event_id") % 200) - 100)
    return events(spark, d).select(F.lit("probe").alias("device"), "event_id", "us", "value", (80 - 0.8 * phase + F.col("value") % 1).alias("p"), F.expr("event_id div 1000").alias("block"))


@register(
    "w07_sampling_frequency",
    f"""with c as (select kind, us // {HOUR} as h, count(*) as n from {E} group by 1, 2), g as (select *, h - lag(h) over (partition by kind order by h) as gap, lead(h) over (partition by kind order by h) is null as last from c),
    i as (select *, gap < avg(gap) over (partition by kind) + 1 as ok from g where gap is not null), u as (select *, ok and coalesce(lag(ok) over (partition by kind order by h), true) and coalesce(lead(ok) over (partition by kind order by h), true) and not last as use from i),
    f as (select kind, n / gap as f from u where use), m as (select kind, median(f) as m, stddev_pop(f) as s from f group by 1), k as (select kind, avg(f) as f from f join m using (kind) where abs(f - m) < 3 * s group by 1), x as (select kind, (sum(n) - count(*) + 1)::bigint as n_same, 0::bigint as n_decreasing from c group by 1)
    select kind, n_same, n_decreasing, round(f / 3600, 8) as frequency from x join k using (kind)""",
)
def w07(spark, d):
    return grouped.sampling_frequency(events(spark, d), ["kind"], "us", HOUR).withColumn("frequency", F.round("frequency", 8))


_RISING = f"""recursive x as (select event_id, device, value as v, row_number() over (partition by device order by us) as n from {E} where value is not null),
    f as (select device, event_id, n, v, [v] as ends, 1 as k from x where n = 1 union all
    select x.device, x.event_id, x.n, x.v, list_concat(ends[1:j], [x.v], ends[j + 2:]), j + 1 from f join x on x.device = f.device and x.n = f.n + 1, lateral (select len(list_filter(ends, lambda e: e < x.v)) as j) as c),
    b as (select a.device, a.event_id, a.n, a.k, max(z.n) as before from f a left join f z on z.device = a.device and z.n < a.n and z.k = a.k - 1 group by 1, 2, 3, 4),
    p as (select device, event_id, before from b where (device, n) in (select device, max(n) from (select *, max(k) over (partition by device) as top from b) where k = top group by device) union all
    select b.device, b.event_id, b.before from p join b on b.device = p.device and b.n = p.before)"""


@register("w08_longest_increasing", f"with {_RISING} select e.event_id, p.event_id is not null as increasing from {E} e left join p using (event_id)")
def w08(spark, d):
    return grouped.mark_longest_increasing(events(spark, d), ["device"], ["us"], "value").select("event_id", "increasing")


_LOG = f"(select event_id, kind, n % 51 = 8 as back, 60000000 * (n // 3) as t from (select event_id, kind, row_number() over (partition by kind order by event_id) - 1 as n from {E}))"


@register(
    "w12b_correct_time_by_file",
    f"""with o as (select * from {_LOG} where not back), g as (select kind, t, count(*) as n, lead(t) over (partition by kind order by t) as later from o group by kind, t)
    select event_id, (o.t + round((row_number() over (partition by kind, o.t order by event_id) - 1) * coalesce(least(20000000e0, (later - o.t) / n), 20000000e0)))::bigint as us from o join g using (kind, t)""",
)
def w12b(spark, d):
    """Logs of three rows a minute with whole minutes, one row in 51 an hour back: inversions go, repeats are spread."""
    df = sequence.numbered(events(spark, d).select("event_id", "kind"), ["kind"], "event_id", [], 1 << 17)
    df = df.select("event_id", "kind", (F.expr("_i div 3") * 60_000_000 - F.when(F.col("_i") % 51 == 8, 3_600_000_000).otherwise(0)).alias("us"))
    return grouped.correct_time(df, ["kind"], "us", "event_id", 1 / 20, delete_inversions=True, choose=True).select("event_id", "us")


@register(
    "w10_linearize_time",
    f"""with g as (select *, us - lag(us) over (partition by device order by us, event_id) as gap from {E}), b as (select *, sum(case when gap > {2 * HOUR} then 1 else 0 end) over (partition by device order by us, event_id rows unbounded preceding) as burst from g),
    r as (select *, row_number() over w - 1 as n, coalesce(us > lag(us) over w, true) as rises, first_value(us) over w as t0 from b window w as (partition by device, burst order by us, event_id)),
    c as (select device, burst, max(n) as top, max(us) as t1, min(case when rises and n > 0 then n - 1 end) as i, max(case when rises and n > 0 then n end) as j from r group by 1, 2),
    x as (select r.*, top, t1 - t0 - {HOUR} * top as error, t1, coalesce(i, 0) as i, coalesce(j, top) as j, max(case when rises then n end) over (partition by r.device, r.burst order by n rows unbounded preceding) as up from r join c on r.device = c.device and r.burst = c.burst),
    y as (select *, max(case when n = i then us end) over (partition by device, burst) as ti, max(case when n = j then us end) over (partition by device, burst) as tj from x)
    select event_id, device, round(case when abs(error) < {4 * HOUR} then t0 + n * {HOUR} when error > 0 then us + (n - up) * {HOUR} else t0 + n * (tj - ti) / greatest(1, j - i) end)::bigint as us from y""",
)
def w10(spark, d):
    return grouped.linearize_time(events(spark, d).select("event_id", "device", "us"), ["device"], "us", "event_id", 1 / 3600)


@register(
    "w11_linearize_with_shifts",
    f"""with recursive x as (select event_id, device, us, row_number() over (partition by device order by event_id) as n from {E}),
    s as (select device, event_id, n, us, n as b, us as bt from x where n = 1 union all
    select x.device, x.event_id, x.n, case when far then x.us else line end, case when far then x.n else b end, case when far then x.us else bt end from s join x on x.device = s.device and x.n = s.n + 1,
    lateral (select bt + (x.n - b) * {2 * HOUR} as line) as a, lateral (select abs(x.us - line) > {4 * HOUR} as far) as c)
    select event_id, device, us from s""",
)
def w11(spark, d):
    return grouped.linearize_with_shifts(events(spark, d).select("event_id", "device", "us"), ["device"], "us", "event_id", 1 / 7200, 4 * HOUR)


@register("w12_correct_time", f"select event_id, us - {2 * HOUR} as us from {E} where event_id % 9 <> 4 or event_id % 500 <= 20")
def w12(spark, d):
    df = events(spark, d).select("event_id", "device", F.expr("event_id div 500").alias("block"), F.when((F.col("event_id") % 9 == 4) & (F.col("event_id") % 500 > 20), F.col("us") - 40 * DAY).otherwise(F.col("us")).alias("us"))
    return grouped.correct_time(df, ["block"], "us", "event_id", 1.0, zone_hours=2, delete_inversions=True).select("event_id", "us")


#: Rows of casts by taking out the lowest weak swing again and again: turns are places in the list ps of a stretch.
_CASTS = f"""recursive y as (select *, sum(case when gap >= {DAY} then 1 else 0 end) over (partition by block order by us) as burst from (select *, us - lag(us) over (partition by block order by us) as gap from {PRESSURE} where p is not null)),
    o as (select *, row_number() over w - 1 as n, sign(p - lag(p) over w) as s from y window w as (partition by block, burst order by us)),
    g as (select *, coalesce(last_value(case when s <> 0 then s end ignore nulls) over (partition by block, burst order by n), 0) as way from o),
    u as (select *, n > 0 and lead(way) over (partition by block, burst order by n) <> way as turn, count(*) over (partition by block, burst) as c from g),
    r as (select block, burst, list(p order by n) as ps, list(n order by n) filter (n = 0 or n = c - 1 or turn) as turns, false as done from u group by 1, 2
    union all select block, burst, ps, case when w is null then turns when w.k = 1 then turns[2:] when w.k = len(turns) - 1 then turns[:-2] else list_concat(turns[:w.k - 1], turns[w.k + 2:]) end, w is null
      from (select *, list_min(list_filter(list_transform(range(1, len(turns)), lambda k: {{'rise': abs(ps[turns[k + 1] + 1] - ps[turns[k] + 1]), 'k': k, 'steps': turns[k + 1] - turns[k]}}), lambda x: x.rise < 20 and x.steps <= 10)) as w from r where not done and len(turns) > 2)),
    f as (select block, burst, arg_min(ps, len(turns)) as ps, arg_min(turns, len(turns)) as turns from r group by 1, 2),
    t as (select block, burst, unnest(list_filter(list_transform(range(1, len(turns)), lambda k: {{'a': turns[k], 'b': turns[k + 1], 'rise': ps[turns[k + 1] + 1] - ps[turns[k] + 1]}}), lambda x: x.rise > 0 and (x.rise >= 20 or x.b - x.a > 10))) as x from f),
    q as (select block, burst, x.a as a, x.b as b, row_number() over (partition by block, burst order by x.a) - 1 as run from t),
    casts as (select o.block, o.burst, o.n, o.event_id, o.us, o.p, o.value, max(q.run)::int as run from o join q on q.block = o.block and q.burst = o.burst and o.n between q.a and q.b group by all)"""


@register("w14_extract_runs", f"with {_CASTS} select event_id, run from casts")
def w14(spark, d):
    return grouped.extract_runs(pressure(spark, d), ["device", "block"], "us", "p", 20.0, 10, DAY).select("event_id", "run")


@register(
    "w15_trim_bad_bottom",
    f"""with {_CASTS}, s as (select *, p / 10 + value / 100 as sigma, max(p) over (partition by block, burst, run) as bottom from casts), d as (select *, lead(sigma) over (partition by block, burst, run order by n) - sigma as d from s where p >= bottom - 5),
    l as (select block, burst, run, median(abs(d)) as m from d group by 1, 2, 3), e as (select d.block, d.burst, d.run, coalesce(min(n) filter (d < -3 * greatest(coalesce(m, 0), 1e-9)), arg_max(n, (sigma, -n))) as stop from d join l using (block, burst, run) group by 1, 2, 3)
    select event_id, s.block, s.run from s join e using (block, burst, run) where n <= stop""",
)
def w15(spark, d):
    casts = grouped.extract_runs(pressure(spark, d), ["device", "block"], "us", "p", 20.0, 10, DAY)
    return grouped.trim_bad_bottom(casts.withColumn("sigma", F.col("p") / 10 + F.col("value") / 100), ["device", "block", "burst", "run"], "us", "p", "sigma", 5.0).select("event_id", "block", "run")


@register(
    "w17_filter_periodic_spike",
    f"""with recursive x as (select block, event_id, n, p + case when event_id % 25 = 7 then 300 else 0 end as v from {_NUMBERED}), l as (select block, list(v order by n) as v, count(*) as c from x group by 1),
    j as (select block, c, list_transform(range(c), lambda i: abs(v[i + 1] - (v[(i - 1 + c) % c + 1] + v[(i + 1) % c + 1]) / 2)) as j from l),
    s as (select block, c, j, 7::bigint as place, 5 + list_position(j[6:10], list_max(j[6:10])) - 1 as best from j union all
    select block, c, j, next, a + list_position(j[a + 1:e], list_max(j[a + 1:e])) - 1 from s, lateral (select case when j[best + 1] > 50 then best else place end + 25 as next) as q, lateral (select greatest(next - 2, 0) as a, least(next + 3, c) as e) as r where next < c)
    select event_id, round(v, 6) as v from x where not exists (select 1 from s where s.block = x.block and best = n and s.j[best + 1] > 50)""",
)
def w17(spark, d):
    df = pressure(spark, d).withColumn("v", F.when(F.col("event_id") % 25 == 7, F.col("p") + 300).otherwise(F.col("p")))
    return rounded(grouped.filter_periodic_spike(df, ["block"], ["us"], "v", 25, 7, 2, 50.0).select("event_id", "v"))


def wavelet_sql(key: str, level: int, wavelet: str = "db4") -> str:
    """Relations that smooth s (key, n from 0, y without nulls) to r0 (key, i, v): down, soft threshold, up."""
    low = [float(x) for x in grouped.WAVELETS[wavelet]]
    taps = ", ".join(f"({j}, {x:.17e}, {(-1) ** j * low[len(low) - 1 - j]:.17e})" for j, x in enumerate(low))
    parts = [
        f"taps as (select * from (values {taps}) as t(j, lo, hi)), c as (select {key}, count(*) as c, pow(2, greatest({level}, ceil(log2(greatest(count(*), 2)))))::bigint as size from s group by 1)",
        f"x0 as (select c.{key}, k.i, s.y as v from c, lateral (select unnest(range(size)) as i) as k join s on s.{key} = c.{key} and s.n = case when k.i < c then k.i when c > size - c then 2 * (c - 1) - k.i else c - 1 end)",
    ]
    for l in range(1, level + 1):
        wide = f"(size // {2 ** (l - 1)})"
        parts.append(f"x{l} as (select c.{key}, k.i, sum(x.v * lo) as v, sum(x.v * hi) as d from c, lateral (select unnest(range(size // {2**l})) as i) as k, taps join x{l - 1} x on x.{key} = c.{key} and x.i = (2 * k.i + j) % {wide} group by 1, 2)")
    parts.append(f"q as (select x1.{key}, median(abs(d)) / 0.6745 * sqrt(2 * ln(greatest(any_value(c), 2))) as q from x1 join c using ({key}) group by 1)")
    parts.append(f"r{level} as (select {key}, i, v from x{level})")
    for l in range(level, 0, -1):
        parts.append(f"r{l - 1} as (select r.{key}, (2 * r.i + j) % (size // {2 ** (l - 1)}) as i, sum(r.v * lo + sign(d) * greatest(abs(d) - q, 0) * hi) as v from r{l} r join x{l} x on x.{key} = r.{key} and x.i = r.i join c on c.{key} = r.{key} join q on q.{key} = r.{key}, taps group by 1, 2)")
    return ", ".join(parts)


@register("w19_wavelet_smooth", f"with s as (select block, n, p as y, event_id from {_NUMBERED}), {wavelet_sql('block', 4)} select event_id, round(v, 6) as p from s join r0 on r0.block = s.block and r0.i = s.n")
def w19(spark, d):
    return rounded(grouped.smooth_per_block(pressure(spark, d), ["block"], ["us"], "p").select("event_id", "p"))


@register("w20_lag_correction", f"select event_id, round(value + 30 * coalesce((value - lag(value) over w) / ((us - lag(us) over w) / 1e6), 0), 6) as value from {E} window w as (partition by device order by us)")
def w20(spark, d):
    return rounded(grouped.lag_correction(events(spark, d), ["device"], "us", "value", 30.0).select("event_id", "value"))


@register(
    "w20b_recursive_low_pass",
    f"""with recursive x as {_NUMBERED}, s as (select block, event_id, n, p from x where n = 0 union all select x.block, x.event_id, x.n, s.p + (1 - exp(-1 / 5e0)) * (x.p - s.p) from s join x on x.block = s.block and x.n = s.n + 1)
    select event_id, round(p, 6) as p from s""",
)
def w20b(spark, d):
    return rounded(grouped.recursive_low_pass(pressure(spark, d), ["block"], "us", "p", 5.0, 1.0).select("event_id", "p"))


@register(
    "w20c_exponential_inverse",
    f"""with x as (select event_id, value, lag(value) over w as v, exp(-(us - lag(us) over w) / 1e6 / lag(3600 + 100 * abs(value)) over w) as c from {E} window w as (partition by device order by us, event_id))
    select event_id, round(coalesce((value - c * v) / nullif(1 - c, 0), value), 6) as value from x""",
)
def w20c(spark, d):
    tau = 3600 + 100 * F.abs("value")
    return rounded(grouped.exponential_inverse(events(spark, d), ["device"], "us", "value", tau).select("event_id", "value"))


@register(
    "w20d_inverse_and_low_pass",
    f"""with recursive x as (select *, lag(p) over (partition by block order by n) as before, exp(-1 / lag(2 + 0.01e0 * p) over (partition by block order by n)) as c from {_NUMBERED}),
    s as (select block, event_id, n, p from x where n = 0 union all select x.block, x.event_id, x.n, ((x.p - c * before) / (1 - c) + before + 5 * s.p) / 7 from s join x on x.block = s.block and x.n = s.n + 1)
    select event_id, round(p, 6) as p from s""",
)
def w20d(spark, d):
    tau = 2 + 0.01 * F.col("p")
    return rounded(grouped.inverse_and_low_pass(pressure(spark, d), ["block"], "us", "p", tau, 3.0, 1.0).select("event_id", "p"))


@register(
    "w21_pressure_hysteresis",
    f"""with recursive x as (select *, 1 - 0.033e0 * (exp(p / 5000) - 1) as d, exp(-(us - lag(us) over (partition by block order by n)) / 1e6 / 1450) as c from {_NUMBERED}),
    s as (select block, event_id, n, value as o, value from x where n = 0 union all select x.block, x.event_id, x.n, x.value, (x.value + s.value * c * d - s.o * c) / d from s join x on x.block = s.block and x.n = s.n + 1)
    select event_id, round(value, 6) as value from s""",
)
def w21(spark, d):
    return rounded(grouped.pressure_hysteresis(pressure(spark, d), ["block"], "us", "value", "p").select("event_id", "value"))


@register(
    "w22_fir_filter",
    f"with s as {_NUMBERED}, {_taps_sql(36, 0.1, True)}, {_filtered_sql('block', 'p')} select event_id, round(y, 6) as p from s join f on s.block = f.block and s.n = f.n",
)
def w22(spark, d):
    return rounded(grouped.fir_filter(pressure(spark, d), ["block"], ["us"], "p", grouped.kaiser_taps(0.1, 0.1, high_pass=True)).select("event_id", "p"))


@register(
    "a24b_interval_std_passed",
    f"with s as {_NUMBERED}, {_taps_sql(36, 0.1, True)}, {_filtered_sql('block', 'p')} select s.block, us // {DAY} * {DAY} as bin, round(stddev_samp(p), 6) as p_std, round(stddev_samp(y), 6) as p_passed_std from s join f on s.block = f.block and s.n = f.n group by 1, 2",
)
def a24b(spark, d):
    return rounded(stats.interval_std(pressure(spark, d), ["block"], "us", DAY, ["p"], grouped.kaiser_taps(0.1, 0.1, high_pass=True)))


@register(
    "w22b_notch_filter",
    f"""with recursive x as {_NUMBERED}, l as (select block, regr_slope(p, n) as k, regr_intercept(p, n) as h, count(*) as c from x group by 1), w as (select cos(0.2e0 * pi()) as co, sin(0.2e0 * pi()) / 60 as al),
    d as (select x.block, event_id, n, c - 1 - n as back, p - k * n - h as y, k * n + h as trend from x join l on x.block = l.block),
    a as (select block, n, y as x1, y as x2, y as y1, y as y2 from d where n = 0 union all select a.block, a.n + 1, d.y, x1, (d.y - 2 * co * x1 + x2 + 2 * co * y1 - (1 - al) * y2) / (1 + al), y1 from a join d on d.block = a.block and d.n = a.n, w),
    e as (select d.block, d.event_id, d.back, trend, a.y1 as y from d join a on a.block = d.block and a.n = d.n + 1),
    b as (select block, back as n, y as x1, y as x2, y as y1, y as y2 from e where back = 0 union all select b.block, b.n + 1, e.y, x1, (e.y - 2 * co * x1 + x2 + 2 * co * y1 - (1 - al) * y2) / (1 + al), y1 from b join e on e.block = b.block and e.back = b.n, w)
    select event_id, round(b.y1 + trend, 6) as p from e join b on b.block = e.block and b.n = e.back + 1""",
)
def w22b(spark, d):
    return rounded(grouped.notch_filter(pressure(spark, d), ["block"], ["us"], "p", 0.2).select("event_id", "p"))


@register(
    "w23_decimate",
    f"with s as {_HOURS}, {_taps_sql(29, 0.25, False)}, {_filtered_sql('kind', 'value')} select s.kind, us, round(y, 6) as value from s join f on s.kind = f.kind and s.n = f.n where us // {HOUR} % 4 = 0",
)
def w23(spark, d):
    return rounded(grouped.decimate(events(spark, d), ["kind"], "us", "value", HOUR, 4))


@register("w25_apply_per_block", f"select device, us // {DAY} as run, round(max(value) - min(value), 6) as span from {E} group by 1, 2")
def w25(spark, d):
    def span(rows):
        value = rows["value"].to_numpy()
        known = value[value == value]
        return {"device": rows["device"].iloc[:1], "run": rows["run"].iloc[:1], "span": [known.max() - known.min() if len(known) else None]}

    return rounded(grouped.apply_per_block(day_runs(spark, d), ["device", "run"], ["us"], span, "device bigint, run bigint, span double"))


@register("w26_psd_multitaper")
def w26(spark, d):
    return grouped.psd_multitaper(pressure(spark, d), ["block"], "us", "p", 1.0)


@register(
    "w27_psd_welch",
    f"""with s as {_HOURS}, c as (select kind, n, value, unnest([n // 32, n // 32 - 1]) as seg from s), g as (select *, n - 32 * seg as i, avg(value) over w as m, count(*) over w as c from c where seg >= 0 window w as (partition by kind, seg)),
    h as (select kind, seg, i, (value - m) * (0.5 - 0.5 * cos(2 * pi() * i / 64)) as y from g where c = 64), d as (select kind, seg, k, pow(sum(y * cos(2 * pi() * i * k / 64)), 2) + pow(sum(y * sin(2 * pi() * i * k / 64)), 2) as power from h, range(33) as r(k) group by 1, 2, 3)
    select kind, round(k / 64 * 1e6 / {HOUR}, 12) as freq, round(avg(power * case when k in (0, 32) then 1 else 2 end / (1e6 / {HOUR} * 24)), 2) as psd, count(*) as segments from d group by kind, k""",
)
def w27(spark, d):
    return grouped.psd_welch(events(spark, d), ["kind"], "us", "value", HOUR, 64).withColumns({"freq": F.round("freq", 12), "psd": F.round("psd", 2)})


@register(
    "w29_wavelet_scalogram",
    f"""with x as (select block, us, n, p - avg(p) over (partition by block) as y from {_NUMBERED}), k as (select scale, m, m / scale as t from (select unnest([4, 16, 64]) as scale), lateral (select unnest(range(-4 * scale, 4 * scale + 1)) as m) as r)
    select o.us, scale::double as scale, round((pow(sum(v.y * cos(6 * t) * exp(-t * t / 2)), 2) + pow(sum(v.y * sin(6 * t) * exp(-t * t / 2)), 2)) / sqrt(pi()) / scale, 3) as power
    from (select block, us, scale, t, n - m as at from x, k) as o join x as v on v.block = o.block and v.n = o.at group by o.block, o.us, scale""",
)
def w29(spark, d):
    return rounded(grouped.wavelet_scalogram(pressure(spark, d), ["block"], "us", "p", [4, 16, 64]).drop("block"), 3)
