"""Exact small cases: limits, bursts, increasing subsequences, repeated times, neighbours, casts, filters, fits."""

import time

import numpy as np
import pandas as pd
import pytest
from conftest import DATA
from pyspark.sql import functions as F

import hydroframe.plans  # noqa: F401
from hydroframe.functions import geo, seawater, times, vectors
from hydroframe.operators import filters, grouped, joins, sequence, stats, windows
from hydroframe.plans import registry

S = 1_000_000


def series(spark, **columns):
    return spark.createDataFrame(pd.DataFrame(columns).assign(k=1))


def column(df, name, order):
    return [r[name] for r in df.orderBy(order).collect()]


def test_strict_limits(spark):
    df = series(spark, hour=range(11, 19), temp=[10.0, 15, 20, 25, 30, 35, 40, 45])
    kept = filters.filter_rows_minmax(df, {"min_date": 13, "max_Temp": 40}, "hour")
    assert column(kept, "hour", "hour") == [14, 15, 16]


def test_equal_to_the_limit(spark):
    df = series(spark, v=[1.0, 2.0, 3.0])
    assert column(filters.null_outside_limits(df, {"min_v": 2.0}), "v", F.desc_nulls_last("v")) == [3.0, None, None]
    assert column(filters.null_outside_limits_inclusive(df, {"min_v": 2.0}), "v", F.desc_nulls_last("v")) == [3.0, 2.0, None]


def test_date_window_is_counted(spark):
    df = series(spark, us=[(-10 + 5 * i) * 3600 * S for i in range(20)])
    row = filters.filter_rows_logged(df, {"min_date": -1, "max_date": 24 * 3600 * S - 1}, ["k"], "us").first()
    assert (row["rows"], row["rows_filtered"], row["last_time"]) == (5, 15, 20 * 3600 * S)


@pytest.mark.parametrize(
    ("values", "expected"),
    [(range(10, 0, -1), [9]), (range(10), list(range(10))), ([3, 1, 4, 1, 5, 9, 2, 6, 5, 3, 5, 8, 9, 7, 9], [3, 6, 9, 10, 13, 14])],
)
def test_longest_increasing(values, expected):
    assert grouped.longest_increasing(np.array(list(values))).tolist() == expected


def test_even_times_of_a_stretch():
    t = np.array([0, 1, 1, 3, 4], float)
    assert grouped._line(t, 1, 1).tolist() == [0, 1, 2, 3, 4]
    lost = np.array([0, 10, 10, 20, 30], float)
    assert grouped._line(lost, 1, 1).tolist() == [0, 10, 11, 20, 30]
    fast = np.array([0, 1, 2, 3, 4], float)
    assert grouped._line(fast, 5, 1).tolist() == [0, 1, 2, 3, 4]


def test_repeated_times(spark):
    one = series(spark, n=[0, 1, 2], us=[32 * S, 32 * S, 33 * S])
    assert column(windows.spread_repeated_times(one, ["k"], "us", "n", 2.0), "us", "n") == [32 * S, 32.5 * S, 33 * S]
    ten = series(spark, n=range(8), us=[x * S for x in (32, 32, 33, 34, 34, 34, 34, 35)])
    expected = [round(x * S) for x in (32.0, 32.1, 33.0, 34.0, 34.1, 34.2, 34.3, 35.0)]
    assert column(windows.spread_repeated_times(ten, ["k"], "us", "n", 10.0), "us", "n") == expected


def test_sampling_frequency(spark):
    df = series(spark, _i=range(32), us=[31 * S, *[32 * S] * 30, 33 * S])
    row = grouped.sampling_frequency(df, ["k"], "us").first()
    assert (row["frequency"], row["n_same"], row["n_decreasing"]) == (30, 30, 0)


def test_bursts_of_hundred_rows(spark):
    df = series(spark, us=[b * 10 * S + i * 2000 for b in range(10) for i in range(100)])
    found = windows.bursts(df, ["k"], "us", S).groupBy("burst").count().orderBy("burst").collect()
    assert [(r["burst"], r["count"]) for r in found] == [(b, 100) for b in range(10)]
    assert windows.default_gap(df, ["k"], "us").first()["gap_us"] == 2000 + S


def test_gap_equal_to_the_limit_joins(spark):
    df = series(spark, us=[0, 10, 21])
    assert column(windows.bursts(df, ["k"], "us", 10), "burst", "us") == [0, 0, 1]


def test_nearest_later_on_ties_and_over_empty_buckets(spark):
    day = sequence.BUCKET_US
    right = series(spark, us=[0, 10, 5 * day], v=[1.0, 2.0, 3.0])
    left = series(spark, us=[5, 4, 2 * day, 9 * day])
    found = joins.nearest_join(left, right, ["k"], "us", ["v"])
    assert column(found, "near_v", "us") == [1.0, 2.0, 2.0, 3.0]
    assert column(joins.interpolate_join(left, right, ["k"], "us", ["v"]), "int_v", "us")[3] is None


def test_runs_for_points(spark):
    minute = 60 * S
    runs = series(spark, run=[0, 1, 2], start=[0, 2 * minute, 5 * minute])
    near = joins.runs_for_points(series(spark, us=[2 * minute + S]), runs, "us", "start")
    assert column(near, "run", "run") == [1]
    ranged = joins.runs_for_points(series(spark, us=[0, 5 * minute]), runs, "us", "start", minute)
    assert column(ranged, "run", "run") == [0, 2]


def test_interval_bounds(spark):
    rows = series(spark, us=[0, 1, 2, 3, 4])
    spans = series(spark, Time_st=[1], Time_en=[3])
    assert column(joins.bucketed_intervals(rows, "us", spans, "Time_st", "Time_en", ["k"], bucket_us=2), "us", "us") == [1, 2, 3]
    assert column(filters.remove_time_ranges(rows, "us", spans, keys=["k"]), "us", "us") == [0, 1, 3, 4]


def test_moved_index(spark):
    df = series(spark, us=range(6), bad=[True, False, True, True, False, True])
    assert column(windows.keep_index_after_delete(df, ["k"], "us", [], "bad"), "good_index", "us") == [None, 0, 0, 0, 1, 1]
    assert column(windows.keep_index_after_delete(df, ["k"], "us", [], "bad", "right"), "good_index", "us") == [0, 0, 1, 1, 1, None]


def test_casts():
    p = np.concatenate([np.linspace(0, 50, 60), np.linspace(50, 0, 60), np.linspace(0, 40, 50), np.linspace(40, 0, 50)])
    p += np.where(np.arange(len(p)) % 7 == 3, 0.5, 0)
    casts = grouped.extract_casts(p, 10, 10)
    assert len(casts) == 2
    assert all(abs(p[b] - top) < 1.5 for (_, b), top in zip(casts, (50, 40), strict=True))


def test_wavelet_and_tapers():
    rng = np.random.default_rng(0)
    clean = np.sin(np.arange(512) / 30)
    noisy = clean + rng.normal(0, 0.3, 512)
    assert np.mean((grouped.wavelet_smooth(noisy, "db4", 5) - clean) ** 2) < np.mean((noisy - clean) ** 2) / 3
    for name in grouped.WAVELETS:
        assert np.allclose(np.sum(np.array(grouped.WAVELETS[name]) ** 2), 1, atol=1e-9)
    tapers, weight = grouped.slepian(64, 2.5, 4)
    assert np.allclose(tapers @ tapers.T, np.eye(4), atol=1e-9)
    assert 0.9 < weight[0] <= 1.0001 and all(np.diff(weight) < 0)


def test_spectra_find_the_tone(spark):
    t = np.arange(1024)
    df = series(spark, us=t * S, v=np.sin(2 * np.pi * 0.125 * t))
    one = grouped.psd_multitaper(df, ["k"], "us", "v", 1.0).first()
    assert abs(one["freq"][int(np.argmax(one["psd"]))] - 0.125) < 0.004
    welch = grouped.psd_welch(df, ["k"], "us", "v", S, 128).toPandas()
    assert welch.loc[welch.psd.idxmax(), "freq"] == 0.125


def test_adaptive_weights_cut_leakage(spark):
    t, rng = np.arange(512), np.random.default_rng(3)
    df = series(spark, us=t * S, v=1e4 * np.sin(2 * np.pi * 0.0703 * t) + rng.normal(size=512))
    plain, adaptive = (np.array(grouped.psd_multitaper(df, ["k"], "us", "v", 1.0, adaptive=a).first()["psd"]) for a in (False, True))
    assert plain.argmax() == adaptive.argmax() and np.isclose(plain.max(), adaptive.max(), rtol=0.05)
    assert adaptive[45:70].mean() < 0.9 * plain[45:70].mean()
    power = rng.chisquare(2, (4, 65))
    assert np.allclose(grouped.adaptive_power(power, np.ones(4), 1.0), 2 * power.mean(axis=0))
    assert not grouped.adaptive_power(np.zeros((4, 9)), np.full(4, 0.9), 0.0).any()
    # At its end every spectrum is the mean by its own weights.
    c = np.array([0.9999, 0.99, 0.95, 0.91])
    s = grouped.adaptive_power(power, c, 3.0) / 2
    d = (s / (c[:, None] * s + (1 - c[:, None]) * 3.0)) ** 2 * c[:, None]
    assert np.allclose((d * power).sum(axis=0) / d.sum(axis=0), s, rtol=1e-6)


@pytest.mark.parametrize(("n", "half_width", "count"), [(64, 2.5, 4), (5000, 2.5, 5), (3001, 4.0, 8), (20000, 10.0, 20)])
def test_tapers_are_those_of_the_whole_eigenproblem(n, half_width, count):
    tapers, weight = grouped.slepian(n, half_width, count)
    assert np.allclose(tapers @ tapers.T, np.eye(count), atol=1e-9)
    w, i = half_width / n, np.arange(n)
    side = np.append(i[1:] * (n - i[1:]) / 2, 0)
    main = ((n - 1 - 2 * i) / 2) ** 2 * np.cos(2 * np.pi * w)
    for t in tapers:
        turned = main * t + side * np.append(t[1:], 0) + np.append(0, (side * t)[:-1])
        value = t @ turned
        assert np.abs(turned - value * t).max() < 1e-7 * n * n * np.abs(t).max()
    assert (np.diff(weight) < 1e-9).all() and weight[0] <= 1 + 1e-9
    if n <= 5000:
        lag = np.arange(1, n)
        kernel = np.concatenate([[2 * w], np.sin(2 * np.pi * w * lag) / (np.pi * lag)])
        for t, c in zip(tapers, weight, strict=True):
            assert abs(t @ (np.convolve(t, np.concatenate([kernel[:0:-1], kernel]))[n - 1 : 2 * n - 1]) - c) < 1e-9


def test_a_long_taper_takes_little_time():
    began = time.perf_counter()
    tapers, weight = grouped.slepian(100_001, 2.5, 5)
    assert time.perf_counter() - began < 3 and tapers.shape == (5, 100_001) and weight[3] > 0.9


def test_spectrum_by_its_sums(spark):
    """Each frequency by plain sums over tapers of the full eigenproblem; padding and band change where it is taken."""
    rng = np.random.default_rng(8)
    y = rng.normal(size=90).cumsum()
    df = series(spark, us=np.arange(90) * S, v=y)
    i, w = np.arange(90), 2.5 / 90
    lag = i[:, None] - i
    sinc = np.where(lag == 0, 2 * w, np.sin(2 * np.pi * w * lag) / (np.pi * np.where(lag == 0, 1, lag)))
    value, vectors = np.linalg.eigh(sinc)
    value, vectors = value[::-1][:5], vectors[:, ::-1][:, :5].T
    use = value > 0.9
    x = y - y.mean()
    for padded, size in ((False, 90), (True, 256)):
        row = grouped.psd_multitaper(df, ["k"], "us", "v", 2.0, padded=padded, band=(0.1, 1.0)).first()
        freq = np.array(row["freq"])
        k = np.round(freq * size / 2).astype(int)
        assert freq.min() >= 0.1 and freq.max() == 1.0
        each = np.abs(np.exp(-2j * np.pi * np.outer(k, i) / size) @ (vectors[use] * x).T) ** 2
        expected = 2 * (each * value[use]).sum(axis=1) / value[use].sum() / 2.0
        expected[k == size // 2] /= 2
        assert np.allclose(row["psd"], expected, rtol=1e-6)


def test_even_times_keep_what_would_move_too_far(spark):
    t = np.round(np.arange(60) * 1e6 + np.where(np.arange(60) % 3 == 1, 300_000, 0)).astype(np.int64)
    assert (grouped.even_times(t, 1e6, 1_500_000) == np.arange(60) * S).all()
    drift = np.round(np.arange(60) * 1_060_000).astype(np.int64)
    out = grouped.even_times(drift, 1e6, 1_500_000)
    assert (np.diff(out) >= 0).all() and np.abs(out - drift).max() <= 1_500_000 + S
    df = series(spark, us=np.append(t, 30 * S), n=np.arange(61))
    found = grouped.correct_time(df, ["k"], "us", "n", 1.0, delete_inversions=True, even=True).orderBy("n").toPandas()
    assert found.us.tolist() == (np.arange(60) * S).tolist()


@pytest.mark.parametrize("seed", range(3))
def test_parts_join_to_the_longest_increasing(spark, seed):
    rng = np.random.default_rng(seed)
    v = np.arange(400.0) // 2 + np.where(rng.random(400) < 0.1, rng.normal(0, 20, 400).round(), 0)
    v[rng.random(400) < 0.03] = np.nan
    if seed == 2:
        v[0] = 1e9
    df = spark.createDataFrame([(0, i, None if np.isnan(x) else float(x)) for i, x in enumerate(v)], "k int, n bigint, v double")
    known = np.flatnonzero(~np.isnan(v))
    expected = np.zeros(400, bool)
    expected[known[grouped.longest_increasing(v[known])]] = True
    for bucket in (7, 1000):
        found = grouped.mark_longest_increasing(df, ["k"], ["n"], "v", bucket=bucket).orderBy("n").toPandas().increasing
        assert (found == expected).all()
    held = v[known]
    wide = expected[known].copy()
    for i in range(len(held) - 2, -1, -1):
        wide[i] |= held[i] == held[i + 1] and wide[i + 1]
    got = grouped.mark_longest_increasing(df.where("v is not null"), ["k"], ["n"], "v", repeats=True, bucket=50).orderBy("n").toPandas().increasing
    assert (got == wide).all() and (np.diff(held[wide]) >= 0).all() and wide.sum() > expected.sum()


def test_a_long_series_is_cut_into_parts(spark):
    """Stretches that fall back are short, whatever the series' length."""
    df = spark.range(300_000).select(F.lit(1).alias("k"), F.col("id").alias("n"), (F.col("id") - F.when(F.col("id") % 1000 == 500, 20).otherwise(0)).cast("double").alias("v"))
    found = grouped.mark_longest_increasing(df, ["k"], ["n"], "v", bucket=1 << 14)
    assert found.where("increasing").count() == 300_000 - 300
    assert found.where("not increasing").selectExpr("count(*)", "min(n % 1000)", "max(n % 1000)").first()[:] == (300, 500, 500)


def test_lines_with_shifts_in_parts(spark):
    rng = np.random.default_rng(4)
    t = (np.arange(500) * 1e6 + np.cumsum(np.where(rng.random(500) < 0.05, rng.normal(0, 4e6, 500), 0)) + rng.normal(0, 2e5, 500)).round().astype(np.int64)
    line, base = np.empty(500), 0
    for i in range(500):
        line[i] = t[base] + (i - base) * 1e6
        if abs(t[i] - line[i]) > 600_000:
            base, line[i] = i, t[i]
    found = grouped.linearize_with_shifts(series(spark, us=t, n=np.arange(500)), ["k"], "us", "n", 1.0, 600_000, bucket=64).orderBy("n").toPandas()
    assert (found.us.to_numpy() == np.round(line).astype(np.int64)).all() and (line != t).any()


def test_method_by_file(spark):
    """Rising files stay; repeats are spread, laid on a line with shifts, or made even by the frequency that is found."""
    n = np.arange(120)
    parts = {"rises": n * S + n % 2 * 1000, "repeats": n // 4 * S, "falls": np.where(n == 60, 0, n * S)}
    df = spark.createDataFrame(pd.concat([pd.DataFrame({"k": k, "n": n, "us": t.astype(np.int64)}) for k, t in parts.items()]))

    def by(**how):
        out = grouped.correct_time(df, ["k"], "us", "n", choose=True, **how).orderBy("n").toPandas()
        return {k: out[out.k == k].us.to_numpy() for k in parts}

    spread = by(frequency=4.0)
    assert (spread["rises"] == parts["rises"]).all() and (spread["repeats"] == n * S // 4).all() and (spread["falls"] == n * S).all()
    shifts = by(frequency=4.0, accuracy_us=1_500_000)
    assert (shifts["repeats"] == n * S // 4).all()
    found = by(frequency=None)
    assert (found["rises"] == parts["rises"]).all() and (found["falls"] == n * S).all()
    assert (np.diff(found["repeats"]) > 0).all() and np.abs(found["repeats"] - n * S // 4).max() <= S
    assert len(by(frequency=4.0, delete_inversions=True)["falls"]) == 119


def works_by_hand(s, noise, strides=(16, 32)):
    """Row by row: each row is judged by the step to it and by the strides it lies in, counted behind a stride's first row."""
    n = len(s)
    if sum(np.isnan(s[i + 1] - s[i]) for i in range(n - 1)) > n / 10:
        return [True] * n
    out = []
    for i in range(n):
        j = max(i - 1, 0)
        good = j + 1 < n and abs(s[j + 1] - s[j]) > noise
        for k in strides:
            a, b = j // k * k, j // k * k + k
            good = good or (b < n and abs(s[b] - s[a]) > noise)
        out.append(bool(good))
    return out


@pytest.mark.parametrize("block_rows", [1 << 17, 32])
def test_frozen_signal_row_by_row(spark, block_rows):
    rng = np.random.default_rng(7)
    cases = {"step": np.repeat([0.0, 1.0], [17, 23]), "two": np.array([0.0, 0, 1, 1]), "slow": np.arange(200) * 0.04, "mixed": np.where(rng.random(150) < 0.1, 5.0, 1.0).cumsum() // 3, "one": np.array([3.0])}
    cases["holes"] = np.where(rng.random(90) < 0.3, np.nan, 1.0)
    cases["few"] = np.where(np.arange(90) % 31 == 5, np.nan, np.arange(90) // 40 * 1.0)
    rows = [(k, i, None if np.isnan(x) else float(x)) for k, v in cases.items() for i, x in enumerate(v)]
    df = spark.createDataFrame(rows, "k string, n bigint, v double")
    found = filters.frozen_signal(df, ["k"], ["n"], "v", 0.5, block_rows=block_rows).orderBy("n").toPandas()
    for k, v in cases.items():
        assert found[found.k == k].works.tolist() == works_by_hand(v, 0.5), k
    assert works_by_hand(cases["two"], 0) == [False, False, True, False]


def test_filters_pass_and_stop():
    low = grouped.kaiser_taps(0.2, 0.1)
    n = np.arange(2000)
    slow, fast = np.sin(np.pi * 0.05 * n), np.sin(np.pi * 0.6 * n)
    mid = slice(300, 1700)
    assert np.allclose(np.convolve(slow, low, "same")[mid], slow[mid], atol=0.01)
    assert np.abs(np.convolve(fast, low, "same")[mid]).max() < 0.01
    assert np.abs(grouped.notch(fast, 0.6, 30)[mid]).max() < 0.05


def test_p_of_a_correlation(spark):
    """By sums over Student's density, for few and many pairs."""
    cases = [(0.0, 5), (0.3, 3), (0.5, 4), (-0.5, 10), (0.9, 30), (0.05, 4000), (0.004, 200_000), (1.0, 9), (0.02, 2)]
    df = spark.createDataFrame([(float(r), n) for r, n in cases], "r double, n long")
    found = [x[0] for x in df.select(stats.correlation_p(F.col("r"), F.col("n").cast("double"))).collect()]
    from math import asin, exp, lgamma, pi

    for (r, n), p in zip(cases, found, strict=True):
        if n < 3:
            assert p is None
            continue
        at = np.linspace(asin(abs(r)), pi / 2, 2_000_001)
        y = np.cos(at).clip(0) ** (n - 3)
        whole = ((y[1:] + y[:-1]) / 2 * np.diff(at)).sum() if abs(r) < 1 else 0.0
        assert p == pytest.approx(2 * whole * exp(lgamma((n - 1) / 2) - lgamma((n - 2) / 2) - lgamma(0.5)), abs=1e-8)
    many = spark.range(1).select(stats.log_gamma(F.lit(0.5)), stats.log_gamma(F.lit(1e6))).first()
    assert many[0] == pytest.approx(lgamma(0.5), abs=1e-12) and many[1] == pytest.approx(lgamma(1e6), rel=1e-14)


@pytest.mark.parametrize("block_rows", [100, 1 << 17])
def test_filters_in_blocks_are_those_of_the_whole(spark, block_rows):
    rng = np.random.default_rng(3)
    y = rng.normal(size=900).cumsum()
    df = series(spark, us=np.arange(900) * S, v=y)
    taps = grouped.kaiser_taps(0.2, 0.1)
    pad = len(taps) // 2
    whole = np.convolve(np.pad(y, pad, mode="reflect"), taps, "valid")
    assert np.allclose(grouped.fir_filter(df, ["k"], ["us"], "v", taps, block_rows, 50 * S).orderBy("us").toPandas().v, whole, atol=1e-9)
    n = np.arange(900)
    trend = np.polyval(np.polyfit(n, y, 1), n)
    expected = grouped.notch(y - trend, 0.3, 5.0) + trend
    assert np.allclose(grouped.notch_filter(df, ["k"], ["us"], "v", 0.3, 5.0, block_rows, 50 * S).orderBy("us").toPandas().v, expected, atol=1e-7)


def test_ellipsoid_is_recovered():
    rng = np.random.default_rng(1)
    unit = rng.normal(size=(500, 3))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    matrix, bias = np.array([[2.0, 0.1, 0], [0.1, 1.5, 0.2], [0, 0.2, 1.0]]), np.array([3.0, -2.0, 1.0])
    raw = unit @ np.linalg.inv(matrix).T + bias
    x, y, z = raw.T
    terms = np.stack([x * x, y * y, z * z, 2 * y * z, 2 * x * z, 2 * x * y, 2 * x, 2 * y, 2 * z, np.ones(len(x))])
    found, centre = stats.fit_ellipsoid(terms @ terms.T)
    assert np.allclose(centre, bias, atol=1e-6)
    assert np.allclose(np.linalg.norm((raw - centre) @ found.T, axis=1), 1, atol=1e-6)


def test_fits_and_rotation(spark):
    x = np.linspace(-3, 5, 80)
    df = series(spark, x=x, y=2 * x**3 - x + 4)
    assert np.allclose(stats.polynomial_fit(df, ["k"], "x", "y", 3).first()["coefs"], [2, 0, -1, 4], atol=1e-6)
    g = series(spark, a=[0.3, 0.3], b=[-0.2, -0.2], c=[0.9, 0.9])
    turned = stats.rotate_by(g, stats.zeroing_rotation(g, ["k"], ["a", "b", "c"]), ["k"], ["a", "b", "c"]).first()
    assert np.allclose([turned["a"], turned["b"], turned["c"]], [0, 0, np.sqrt(0.94)], atol=1e-9)


def test_published_check_values(spark):
    row = spark.range(1).select(
        seawater.practical_salinity(F.lit(42.9140), F.lit(15 / 1.00024), F.lit(0.0)).alias("s"), seawater.density_at_surface(F.lit(35.0), F.lit(5.0)).alias("rho"),
        *[c.alias(n) for n, c in geo.utm_inverse(F.lit(500000.0), F.lit(0.0)).items()], vectors.psig_to_dbar(F.lit(1.0)).alias("dbar"),
    ).first()
    assert row["s"] == pytest.approx(35, abs=1e-6)
    assert row["rho"] == pytest.approx(1027.67547, abs=1e-4)
    assert (row["lon"], row["lat"]) == pytest.approx((21.0, 0.0), abs=1e-9)


def test_periods():
    assert [times.period_us(p) for p in ("5min", "2h", "D", "30s")] == [300 * S, 7200 * S, 86400 * S, 30 * S]


def brute_nearest(points, nodes):
    """(distance, node) of each point; rows are id, x, y."""
    ids, at = np.array([n[0] for n in nodes]), np.array([n[1:] for n in nodes], float)
    out = {}
    for i, x, y in points:
        d = np.hypot(at[:, 0] - x, at[:, 1] - y)
        out[i] = (d.min(), ids[d <= d.min() + 1e-9].min())
    return out


@pytest.mark.parametrize("cell", [0.5, 8.0])
def test_every_point_has_its_nearest_node(spark, cell):
    draw = np.random.default_rng(3)
    nodes = [(i, *map(float, p)) for i, p in enumerate(np.round(draw.normal(0, 20, (300, 2)), 1))] + [(300, 900.0, -700.0), (301, 5.0, 5.0), (302, 5.0, 5.0)]
    points = [(i, *map(float, p)) for i, p in enumerate(np.round(draw.normal(0, 60, (200, 2)), 1))] + [(200, 5000.0, 4000.0), (201, -90.0, 1e5), (202, 5.0, 5.0)]
    a, b = spark.createDataFrame([*points, (203, None, 1.0)], "p long, x double, y double"), spark.createDataFrame([*nodes, (303, None, None)], "n long, x double, y double")
    found = {r.p: r for r in joins.nearest_point(a, b, "x", "y", cell, "p", "n").collect()}
    expected = brute_nearest(points, nodes)
    assert set(found) == set(expected)
    where = {i: xy for i, *xy in nodes}
    for i, x, y in points:
        assert abs(found[i].distance - expected[i][0]) < 1e-6 and abs(np.hypot(where[found[i].n][0] - x, where[found[i].n][1] - y) - expected[i][0]) < 1e-6
    assert found[202].n == 301
    assert joins.nearest_point(a, b.limit(0), "x", "y", cell, "p", "n").count() == 0


def test_nearest_point_takes_the_whole_tables(spark):
    found = registry.queries()["j15_nearest_point"](spark, DATA).collect()
    e, o = pd.read_parquet(f"{DATA}/events.parquet"), pd.read_parquet(f"{DATA}/orders.parquet")
    e = e[(e.event_type == "purchase") & e.value.notna()]
    points = list(zip(e.event_id, e.value * 5, e.event_id % 300 * 1.0, strict=True))
    expected = brute_nearest(points, list(zip(o.o_orderkey, o.o_totalprice.astype(float) / 1000, o.o_orderkey % 1000 * 0.3, strict=True)))
    assert len(found) == len(expected) and all(abs(r.distance - expected[r.event_id][0]) < 1e-6 for r in found)


def test_every_purchase_is_a_point_and_an_anchor(spark):
    e = pd.read_parquet(f"{DATA}/events.parquet").sort_values("ts")
    bought, seen = e[e.event_type == "purchase"], e[e.event_type == "view"]
    since = seen.ts.to_numpy()[:, None] - bought.ts.to_numpy()[None, :]
    near = ((since >= np.timedelta64(0)) & (since < np.timedelta64(1, "h"))).any(axis=1)
    found = registry.queries()["j05_runs_for_points"](spark, DATA).collect()
    assert sorted(r.run for r in found) == sorted(seen.event_id[near])
    anchors = {r.event_id: r.anchor_lon for r in registry.queries()["j13_moving_anchor"](spark, DATA).collect()}
    for b in bought.itertuples():
        assert abs(anchors[b.event_id] - (20 + b.event_id % 97 / 1000)) < 1e-9


def test_filter_of_a_group_shorter_than_its_taps(spark):
    taps = grouped.kaiser_taps(0.1, 0.1)
    flat = grouped.fir_filter(series(spark, us=range(5), v=[2.0] * 5), ["k"], ["us"], "v", taps)
    assert column(flat, "v", "us") == pytest.approx([2.0] * 5)
    y = [1.0, 5.0, 2.0]
    mirrored = [y[min(i % 4, 4 - i % 4)] for i in range(-len(taps), len(taps) + 3)]
    expected = [sum(t * mirrored[i + len(taps) + j - len(taps) // 2] for j, t in enumerate(taps)) for i in range(3)]
    got = grouped.fir_filter(series(spark, us=range(3), v=y), ["k"], ["us"], "v", taps)
    assert column(got, "v", "us") == pytest.approx(expected)
