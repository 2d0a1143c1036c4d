"""Bins, statistics and fits (A01-A26).  All are one or two aggregations with partial sums on the map side."""

from __future__ import annotations

import math
from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import to_cartesian, to_polar
from .sequence import carry


def bin_of(us: str | Column, period_us: int, centred: bool = False) -> Column:
    """Begin of the bin of a time; centred bins [t - p/2, t + p/2) are named by t."""
    t = F.col(us) if isinstance(us, str) else us
    return F.floor((t + (period_us // 2 if centred else 0)) / period_us) * period_us


def bin_mean(df: DataFrame, keys: list[str], us: str, period_us: int, columns: list[str]) -> DataFrame:
    """Means by period; bins of at most a tenth of the mean row count are dropped, then those without any value."""
    bins = df.groupBy(*keys, bin_of(us, period_us).alias("bin")).agg(F.count("*").alias("rows"), *[F.avg(c).alias(c) for c in columns])
    usual = F.avg("rows").over(Window.partitionBy(*keys)) / 10
    return bins.withColumn("_usual", usual).where((F.col("rows") > F.col("_usual")) & F.coalesce(*columns).isNotNull()).drop("_usual")


def centered_bin_mean(df: DataFrame, keys: list[str], us: str, period_us: int, columns: list[str]) -> DataFrame:
    """Means over [t - p/2, t + p/2), labelled t."""
    return df.groupBy(*keys, bin_of(us, period_us, True).alias("bin")).agg(*[F.avg(c).alias(c) for c in columns])


def vector_bin_mean(df: DataFrame, keys: list[str], us: str, period_us: int, speed: str, direction: str) -> DataFrame:
    """Mean velocity of each bin: components are averaged, never angles."""
    u, v = to_cartesian(F.col(speed), F.col(direction))
    bins = df.groupBy(*keys, bin_of(us, period_us).alias("bin")).agg(F.avg(u).alias("u"), F.avg(v).alias("v"), F.count("*").alias("rows"))
    size, angle = to_polar(F.col("u"), F.col("v"))
    return bins.withColumns({"Vabs": size, "Vdir": angle})


def record_stats(df: DataFrame, keys: list[str], u: str, v: str) -> DataFrame:
    """Mean components, speed and direction of the mean, and greatest, least and middle speed."""
    speed = F.hypot(u, v)
    out = df.groupBy(*keys).agg(F.avg(u).alias("u_mean"), F.avg(v).alias("v_mean"), F.max(speed).alias("v_max"), F.min(speed).alias("v_min"))
    size, angle = to_polar(F.col("u_mean"), F.col("v_mean"), wrap=True)
    return out.withColumns({"v_abs": size, "v_dir": angle, "v_mid": (F.col("v_max") + F.col("v_min")) / 2})


def vector_series_stats(df: DataFrame, keys: list[str], us: str, speed: str, direction: str) -> DataFrame:
    """Statistics of speed and direction per device.

    Variance and deviation are those of the population, skewness and kurtosis corrected for bias.
    """
    u, v = to_cartesian(F.col(speed), F.col(direction))
    s, a = F.col(speed), F.radians(F.col(direction))
    means = df.groupBy(*keys).agg(F.avg(s).alias("_mean"))
    held = df.join(means, keys)
    out = held.groupBy(*keys).agg(
        F.avg(u).alias("_u"), F.avg(v).alias("_v"), F.avg(F.sin(a)).alias("_s"), F.avg(F.cos(a)).alias("_c"), F.min(s).alias("min"), F.max(s).alias("max"), F.avg(s).alias("mean"),
        F.var_pop(s).alias("var"), F.stddev_pop(s).alias("std"), F.skewness(s).alias("_skew"), F.kurtosis(s).alias("_kurt"), F.avg(F.abs(s - F.col("_mean"))).alias("mad"),
        F.count(s).alias("n"), F.min(us).alias("start"), F.max(us).alias("end"),
    )
    n = F.col("n").cast("double")
    skew = F.when(n > 2, F.col("_skew") * F.sqrt(n * (n - 1)) / (n - 2))
    kurt = F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.col("_kurt") + 6))
    size, angle = to_polar(F.col("_u"), F.col("_v"), wrap=True)
    spread = F.degrees(F.sqrt(-2 * F.log(F.hypot("_s", "_c"))))
    out = out.withColumns({
        "vector_abs": size, "vector_dir": angle, "dir_mean": F.pmod(F.degrees(F.atan2("_s", "_c")), F.lit(360.0)), "dir_std": spread, "skew": skew, "kurt": kurt,
        "cv": F.try_divide(F.col("std"), F.col("mean")), "range": F.col("max") - F.col("min"), "days": (F.col("end") - F.col("start")) / 86_400_000_000, "stability": F.try_divide(size, F.col("mean")),
    })
    return out.drop("_u", "_v", "_s", "_c", "_skew", "_kurt")


def log_gamma(x: Column) -> Column:
    """Natural logarithm of the gamma function of a positive number, by Stirling's series at x + 8."""
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * F.pow(y, F.lit(3.0))) + 1 / (1260 * F.pow(y, F.lit(5.0))) - 1 / (1680 * F.pow(y, F.lit(7.0))) + 1 / (1188 * F.pow(y, F.lit(9.0)))
    shift = F.aggregate(F.sequence(F.lit(0), F.lit(7)), F.lit(0.0), lambda s, i: s + F.log(x + i))
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - shift


def incomplete_beta(x: Column, a: Column, b: Column) -> Column:
    """The regularised incomplete beta function I_x(a, b), by its continued fraction, run down as a fold.

    Beyond its mean the mirrored function is taken, where the fraction settles in about the root of the parameters.
    """
    mirrored = x > (a + 1) / (a + b + 2)
    values = F.struct(F.when(mirrored, 1 - x).otherwise(x).alias("x"), F.when(mirrored, b).otherwise(a).alias("a"), F.when(mirrored, a).otherwise(b).alias("b"), mirrored.alias("m"))

    def use(q: Column) -> Column:
        x, a, b = q["x"], q["a"], q["b"]
        ends = F.log(x) * a + F.log1p(-x) * b + log_gamma(a + b) - log_gamma(a) - log_gamma(b) - F.log(a)
        first = 1 / (1 - (a + b) * x / (a + 1))
        state = F.struct(F.lit(1.0).alias("c"), first.alias("d"), first.alias("h"))

        def half(s: Column, t: Column) -> Column:
            """One more term of the fraction."""
            c, d = 1 + t / s["c"], 1 / (1 + t * s["d"])
            return F.struct(c.alias("c"), d.alias("d"), (s["h"] * c * d).alias("h"))

        def step(s: Column, m: Column) -> Column:
            even, odd = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
            return F.transform(F.array(half(s, even)), lambda u: half(u, odd))[0]

        terms = F.transform(F.sequence(F.lit(1), (40 + 4 * F.sqrt(F.greatest(a, b))).cast("int")), lambda m: m.cast("double"))
        part = F.when(x <= 0, 0.0).otherwise(F.exp(ends) * F.aggregate(terms, state, step)["h"])
        return F.when(q["m"], 1 - part).otherwise(part)

    return F.transform(F.array(values), use)[0]


def correlation_p(r: Column, n: Column) -> Column:
    """Two-sided p of a correlation of n pairs by Student's t, null below three pairs."""
    return F.when(n > 2, incomplete_beta(F.greatest(1 - r * r, F.lit(0.0)), (n - 2) / 2.0, F.lit(0.5)))


def pair_correlation(pairs: DataFrame, device: str, speed: str, direction: str) -> DataFrame:
    """Pearson r (and p) of speeds and circular correlation of directions, where both directions exist."""
    d1, d2 = f"{device}_1", f"{device}_2"
    a, b = F.radians(F.col(f"{direction}_1")), F.radians(F.col(f"{direction}_2"))
    both = pairs.where(F.col(f"{direction}_1").isNotNull() & F.col(f"{direction}_2").isNotNull())
    means = both.groupBy(d1, d2).agg(F.atan2(F.avg(F.sin(a)), F.avg(F.cos(a))).alias("_a"), F.atan2(F.avg(F.sin(b)), F.avg(F.cos(b))).alias("_b"))
    x, y = F.sin(a - F.col("_a")), F.sin(b - F.col("_b"))
    out = both.join(means, [d1, d2]).groupBy(d1, d2).agg(F.corr(f"{speed}_1", f"{speed}_2").alias("r"), F.count("*").alias("n"), F.try_divide(F.sum(x * y), F.sqrt(F.sum(x * x) * F.sum(y * y))).alias("circular_r"))
    return out.withColumn("p", correlation_p(F.col("r"), F.col("n").cast("double")))


def pair_shift(pairs: DataFrame, device: str, column: str) -> DataFrame:
    """Mean and sample deviation of the difference of each pair."""
    difference = F.col(f"{column}_1") - F.col(f"{column}_2")
    return pairs.groupBy(f"{device}_1", f"{device}_2").agg(F.avg(difference).alias("shift"), F.stddev_samp(difference).alias("std"))


def _first(df: DataFrame, keys: list, order: list[Column]) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def drop_duplicate_times(df: DataFrame, keys: list[str], ts: str, order: str) -> DataFrame:
    """Of rows at one time the last by `order` stays."""
    return _first(df, [*keys, ts], [F.desc(order)])


def one_per_second(df: DataFrame, keys: list[str], us: str, order: str) -> DataFrame:
    """The first row of each second, times rounded to it with halves to the even second."""
    return _first(df, [*keys, F.bround(F.col(us) / 1e6)], [F.asc(us), F.asc(order)])


def value_mode(df: DataFrame, keys: list[str], column: str, order: str) -> DataFrame:
    """A10: the most frequent value, the smallest on ties, its count and its first position."""
    counts = df.where(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    return counts.groupBy(*keys).agg(F.max_by(F.struct(column, "n", "first"), F.struct("n", (-F.col(column)).alias("v"))).alias("m")).select(*keys, f"m.{column}", "m.n", "m.first")


def mean_abs_deviation(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Mean distance from the mean."""
    means = df.groupBy(*keys).agg(F.avg(column).alias("_mean"))
    return df.join(means, keys).groupBy(*keys).agg(F.avg(F.abs(F.col(column) - F.col("_mean"))).alias("mad"))


def mean_per_file(df: DataFrame, file: str, columns: list[str]) -> DataFrame:
    """Means per file, with the number its name holds."""
    number = F.regexp_replace(F.regexp_replace(F.col(file), r"\.[A-Za-z]+$", ""), r"[^\d.]", "").try_cast("double")
    return df.groupBy(file).agg(*[F.avg(c).alias(c) for c in columns]).withColumn("point", number)


def depth_weighted_mean(df: DataFrame, keys: list[str], depth: str, column: str, step: float = 0.1) -> DataFrame:
    """Mean over even steps of depth: equal depths are averaged, then the profile is interpolated linearly.

    The steps of a segment between neighbouring depths are summed in closed form, so no step becomes a row.
    """
    flat = df.where(F.col(column).isNotNull()).groupBy(*keys, depth).agg(F.avg(column).alias("_y"))
    w = Window.partitionBy(*keys).orderBy(depth)
    first = F.min(depth).over(Window.partitionBy(*keys))
    seg = flat.select(*keys, ((F.col(depth) - first) / step).alias("_x"), "_y", ((F.lead(depth).over(w) - first) / step).alias("_x1"), F.lead("_y").over(w).alias("_y1"))
    a = F.ceil(F.col("_x") - 1e-9)
    b = F.when(F.col("_x1").isNull(), F.floor(F.col("_x") + 1e-9)).otherwise(F.ceil(F.col("_x1") - 1e-9) - 1)
    n = F.greatest(b - a + 1, F.lit(0))
    slope = F.coalesce(F.try_divide(F.col("_y1") - F.col("_y"), F.col("_x1") - F.col("_x")), F.lit(0.0))
    total = n * (F.col("_y") + slope * ((a + b) / 2 - F.col("_x")))
    return seg.withColumns({"_n": n, "_t": total}).groupBy(*keys).agg((F.sum("_t") / F.sum("_n")).alias("mean"), F.sum("_n").alias("steps"))


def run_summary(df: DataFrame, keys: list[str], run: str, us: str, columns: list[str], file: str | None = None) -> DataFrame:
    """Per run its rows, times, first and last values, and the time to the next run."""
    ends = [x for c in columns for x in (F.min_by(c, us).alias(f"{c}_st"), F.max_by(c, us).alias(f"{c}_en"))]
    extra = [F.min_by(file, us).alias("file")] if file else []
    runs = df.groupBy(*keys, run).agg(F.min(us).alias("Time_st"), F.max(us).alias("Time_en"), F.count("*").alias("rows"), *ends, *extra)
    return runs.withColumn("to_next", F.lead("Time_st").over(Window.partitionBy(*keys).orderBy("Time_st", run)) - F.col("Time_en"))


def merge_runs(log: DataFrame, merges: DataFrame, keys: list[str], run: str = "run") -> DataFrame:
    """Runs named in merges (run, into) become part of another: *_en of the last, *_st of the first, rows summed."""
    named = log.join(merges, [*keys, run], "left").withColumn("_to", F.coalesce("into", run)).drop("into")
    firsts = [c for c in log.columns if c.endswith("_st")]
    lasts = [c for c in log.columns if c.endswith("_en")]
    sums = [c for c in log.columns if c.startswith("rows")]
    picked = [F.min_by(c, "Time_st").alias(c) for c in firsts] + [F.max_by(c, "Time_st").alias(c) for c in lasts] + [F.sum(c).alias(c) for c in sums]
    return named.groupBy(*keys, F.col("_to").alias(run)).agg(*picked)


def time_holes(df: DataFrame, keys: list[str], us: str, longest_us: int) -> DataFrame:
    """Gaps of more than longest_us: the time before and their size."""
    after = carry(df.select(*keys, us), keys, us, [], {"_next": F.col(us)}, backward=True, strict=True)
    return after.select(*keys, F.col(us).alias("start"), (F.col("_next") - F.col(us)).alias("size")).where(F.col("size") > longest_us)


def fill_start(df: DataFrame, keys: list[str], us: str, longest_us: int, wait_us: int, now_us: int) -> DataFrame:
    """Where to load again from: the first hole of the last wait_us, else the last time."""
    holes = time_holes(df, keys, us, longest_us).where(F.col("start") >= now_us - wait_us).groupBy(*keys).agg(F.min("start").alias("hole"))
    last = df.groupBy(*keys).agg(F.max(us).alias("last"))
    return last.join(holes, keys, "left").select(*keys, F.coalesce("hole", "last").alias("fill_start"))


def sphere_bin_mean(df: DataFrame, keys: list[str], x: str, y: str, z: str, bins: int, us: str | None = None) -> DataFrame:
    """Means of points in cells of equal area: `bins` steps of cos(polar angle) and twice as many of azimuth."""
    r = F.sqrt(F.col(x) ** 2 + F.col(y) ** 2 + F.col(z) ** 2)
    theta = F.atan2(F.col(y), F.col(x))
    i = F.least(F.floor((F.try_divide(F.col(z), r) + 1) / 2 * bins), F.lit(bins - 1))
    j = F.least(F.floor((theta + math.pi) / (2 * math.pi) * 2 * bins), F.lit(2 * bins - 1))
    first = [F.min(us).alias(us)] if us else []
    return df.groupBy(*keys, i.alias("i"), j.alias("j")).agg(F.count("*").alias("n"), *[F.avg(c).alias(c) for c in (x, y, z)], *first)


def moments(df: DataFrame, keys: list[str], terms: dict[str, Column]) -> DataFrame:
    """Sums of products of each two terms, as s_<a>_<b>."""
    names = list(terms)
    sums = [F.sum(terms[a] * terms[b]).alias(f"s_{a}_{b}") for i, a in enumerate(names) for b in names[i:]]
    return df.groupBy(*keys).agg(*sums)


def _moment_matrix(row, names: list[str]) -> np.ndarray:
    m = np.zeros((len(names), len(names)))
    for i, a in enumerate(names):
        for j, b in enumerate(names[i:], i):
            m[i, j] = m[j, i] = row[f"s_{a}_{b}"]
    return m


def ellipsoid_fit(df: DataFrame, keys: list[str], x: str, y: str, z: str) -> DataFrame:
    """Hard- and soft-iron calibration per device: A (3 x 3, rows as arrays) and C (3) so that |A (raw - C)| is 1.

    One aggregation of 55 sums of products; the algebra runs per device on its one row of sums.
    """
    import pandas as pd

    a, b, c = (F.col(i) for i in (x, y, z))
    terms = {"xx": a * a, "yy": b * b, "zz": c * c, "yz": 2 * b * c, "xz": 2 * a * c, "xy": 2 * a * b, "x": 2 * a, "y": 2 * b, "z": 2 * c, "one": F.lit(1.0)}
    names = list(terms)

    def solve(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        for batch in batches:
            out = []
            for _, row in batch.iterrows():
                matrix, bias = fit_ellipsoid(_moment_matrix(row, names))
                out.append({**{k: row[k] for k in keys}, "A": [list(r) for r in matrix], "C": list(bias)})
            yield pd.DataFrame(out, columns=[*keys, "A", "C"])

    sums = moments(df, keys, terms)
    kinds = ", ".join(f"{k} {sums.schema[k].dataType.simpleString()}" for k in keys)
    return sums.mapInPandas(solve, f"{kinds}, A array<array<double>>, C array<double>")


def fit_ellipsoid(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scale matrix and bias from the 10 x 10 sums of products, by least squares over ellipsoids (Li and Griffiths)."""
    s11, s12, s22 = sums[:6, :6], sums[:6, 6:], sums[6:, 6:]
    constraint = np.array([[-1, 1, 1, 0, 0, 0], [1, -1, 1, 0, 0, 0], [1, 1, -1, 0, 0, 0], [0, 0, 0, -4, 0, 0], [0, 0, 0, 0, -4, 0], [0, 0, 0, 0, 0, -4]], float)
    back = np.linalg.pinv(s22) @ s12.T
    values, vectors = np.linalg.eig(np.linalg.solve(constraint, s11 - s12 @ back))
    v1 = np.real(vectors[:, np.argmax(np.real(values))])
    v1 = -v1 if v1[0] < 0 else v1
    v2 = -back @ v1
    m = np.array([[v1[0], v1[5], v1[4]], [v1[5], v1[1], v1[3]], [v1[4], v1[3], v1[2]]])
    bias = -np.linalg.solve(m, v2[:3])
    w, q = np.linalg.eigh(m)
    return q @ np.diag(np.sqrt(np.maximum(w, 0))) @ q.T / math.sqrt(max(bias @ m @ bias - v2[3], 1e-300)), bias


def polynomial_fit(df: DataFrame, keys: list[str], x: str, y: str, degree: int) -> DataFrame:
    """Coefficients of the least-squares polynomial, highest power first, as an array.

    x is centred and scaled before the sums of powers are taken, and the coefficients are brought back.
    """
    import pandas as pd

    if degree == 1:
        return df.groupBy(*keys).agg(F.array(F.regr_slope(y, x), F.regr_intercept(y, x)).alias("coefs"))
    scale = df.groupBy(*keys).agg(F.avg(x).alias("_m"), F.greatest(F.stddev_pop(x), F.lit(1e-12)).alias("_s"))
    held = df.join(scale, keys) if keys else df.crossJoin(F.broadcast(scale))
    t = (F.col(x) - F.col("_m")) / F.col("_s")
    terms = {f"p{i}": t**i for i in range(degree + 1)} | {"y": F.col(y)}
    names = list(terms)
    sums = moments(held.where(F.col(x).isNotNull() & F.col(y).isNotNull()), [*keys, "_m", "_s"], terms)

    def solve(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        for batch in batches:
            out = []
            for _, row in batch.iterrows():
                m = _moment_matrix(row, names)
                own = np.linalg.lstsq(m[:-1, :-1], m[:-1, -1], rcond=None)[0]
                poly = np.polynomial.Polynomial(own)(np.polynomial.Polynomial([-row["_m"] / row["_s"], 1 / row["_s"]]))
                out.append({**{k: row[k] for k in keys}, "coefs": list(np.pad(poly.coef, (0, degree + 1 - len(poly.coef)))[::-1])})
            yield pd.DataFrame(out, columns=[*keys, "coefs"])

    kinds = "".join(f"{k} {sums.schema[k].dataType.simpleString()}, " for k in keys)
    return sums.mapInPandas(solve, f"{kinds}coefs array<double>")


def angular_fit(df: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """Least squares of sin(y) and cos(y) on 1, sin(x), cos(x), angles in degrees: fit_sin and fit_cos, 3 numbers each."""
    import pandas as pd

    a, b = F.radians(F.col(x)), F.radians(F.col(y))
    terms = {"one": F.lit(1.0), "s": F.sin(a), "c": F.cos(a), "ys": F.sin(b), "yc": F.cos(b)}
    names = list(terms)
    sums = moments(df.where(F.col(x).isNotNull() & F.col(y).isNotNull()), keys, terms)

    def solve(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        for batch in batches:
            out = []
            for _, row in batch.iterrows():
                m = _moment_matrix(row, names)
                own = np.linalg.lstsq(m[:3, :3], m[:3, 3:], rcond=None)[0]
                out.append({**{k: row[k] for k in keys}, "fit_sin": list(own[:, 0]), "fit_cos": list(own[:, 1])})
            yield pd.DataFrame(out, columns=[*keys, "fit_sin", "fit_cos"])

    kinds = ", ".join(f"{k} {sums.schema[k].dataType.simpleString()}" for k in keys)
    return sums.mapInPandas(solve, f"{kinds}, fit_sin array<double>, fit_cos array<double>")


def angular_fit_apply(df: DataFrame, fits: DataFrame, keys: list[str], x: str, out: str = "fitted") -> DataFrame:
    """The fitted angle of each row, in [0, 360)."""
    a = F.radians(F.col(x))
    part = [F.col(c)[0] + F.col(c)[1] * F.sin(a) + F.col(c)[2] * F.cos(a) for c in ("fit_sin", "fit_cos")]
    return df.join(fits, keys).withColumn(out, F.pmod(F.degrees(F.atan2(*part)), F.lit(360.0))).drop("fit_sin", "fit_cos")


def zeroing_rotation(df: DataFrame, keys: list[str], g: list[str]) -> DataFrame:
    """The rotation (3 x 3) that makes each device's mean acceleration vertical: about the axis g x z (Rodrigues)."""
    m = df.groupBy(*keys).agg(*[F.avg(c).alias(f"_{i}") for i, c in enumerate(g)])
    n = F.sqrt(F.col("_0") ** 2 + F.col("_1") ** 2 + F.col("_2") ** 2)
    x, y, z = (F.col(f"_{i}") / n for i in range(3))
    k = 1 / (1 + z)
    rows = [[1 - k * x * x, -k * x * y, -x], [-k * x * y, 1 - k * y * y, -y], [x, y, z]]
    return m.select(*keys, F.array(*[F.array(*r) for r in rows]).alias("R"))


def rotate_by(df: DataFrame, rotation: DataFrame, keys: list[str], g: list[str]) -> DataFrame:
    """Vectors of each row turned by their device's rotation."""
    held = df.join(rotation, keys)
    return held.withColumns({c: sum((F.col("R")[i][j] * F.col(g[j]) for j in (1, 2)), F.col("R")[i][0] * F.col(g[0])) for i, c in enumerate(g)}).drop("R")


def azimuth_zeroing(df: DataFrame, keys: list[str], u: str, v: str, inclination: str) -> DataFrame:
    """Minus the direction of the median velocity of rows tilted by 10 to 170 degrees."""
    use = df.where((F.col(inclination) > 10) & (F.col(inclination) < 170))
    out = use.groupBy(*keys).agg(F.percentile(u, 0.5).alias("_u"), F.percentile(v, 0.5).alias("_v"))
    return out.select(*keys, (-F.degrees(F.atan2("_u", "_v"))).alias("azimuth_shift"))


def mean_anchor(df: DataFrame, keys: list[str], lat: str, lon: str) -> DataFrame:
    """The mean position."""
    return df.groupBy(*keys).agg(F.avg(lat).alias("anchor_lat"), F.avg(lon).alias("anchor_lon"))


def interval_std(df: DataFrame, keys: list[str], us: str, period_us: int, columns: list[str], taps: np.ndarray | None = None) -> DataFrame:
    """Sample deviation of each channel in each interval; with taps (of a high-pass filter) of the filtered channel too.

    The filter runs over each group of keys as a whole, so a long series should be keyed by day or file as well.
    """
    names = {c: f"{c}_std" for c in columns}
    if taps is not None:
        from .grouped import fir_filter

        for c in columns:
            df = fir_filter(df.withColumn(f"{c}_passed", F.col(c)), keys, [us], f"{c}_passed", taps)
            names[f"{c}_passed"] = f"{c}_passed_std"
    return df.groupBy(*keys, bin_of(us, period_us).alias("bin")).agg(*[F.stddev_samp(c).alias(n) for c, n in names.items()])


def mean_speed_compare(a: DataFrame, b: DataFrame, u: str, v: str) -> DataFrame:
    """Mean speed of two sources and the difference."""
    one, two = (x.agg(F.avg(F.hypot(u, v)).alias(n)) for x, n in ((a, "mean_1"), (b, "mean_2")))
    return one.crossJoin(F.broadcast(two)).withColumn("difference", F.col("mean_1") - F.col("mean_2"))


def last_row_per_interval(df: DataFrame, keys: list[str], us: str, columns: list[str]) -> DataFrame:
    """The last row of each cast."""
    last = df.groupBy(*keys).agg(F.max_by(F.struct(us, *columns), us).alias("_r"))
    return last.select(*keys, "_r.*")
