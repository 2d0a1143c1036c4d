"""Operators on ordered series that are windows or joins of windows (W01-W06, W09, W13, W16, W18, W24, W28, W30, O, S)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import _between, neighbours
from .sequence import carry, cumulated, in_row_blocks, islands, joined


#: Rows of a long series that a task works on at a time.
BLOCK_ROWS = 1 << 17


def _over(keys: list[str], order: list[str]):
    return Window.partitionBy(*keys).orderBy(*order)


def single_spikes(df: DataFrame, keys: list[str], order: list[str], column: str, max_spike: float, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """`spike`, true where the value is above or below both neighbours by more than max_spike; an end needs one."""

    def run(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
        w, c = _over(keys, order), F.col(column)
        before, after = c - F.lag(c).over(w), c - F.lead(c).over(w)
        up = F.coalesce(before > max_spike, F.lit(True)) & F.coalesce(after > max_spike, F.lit(True))
        down = F.coalesce(before < -max_spike, F.lit(True)) & F.coalesce(after < -max_spike, F.lit(True))
        return rows.withColumn("spike", c.isNotNull() & (before.isNotNull() | after.isNotNull()) & (up | down))

    return in_row_blocks(df, keys, order[0], order[1:], 1, 1, run, block_rows)


def despike(df: DataFrame, keys: list[str], order: list[str], column: str, passes: list[tuple[float, int]], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Each pass (offset, block) nulls values with |y - mean| > offset * deviation over a moving block.

    Mean and population deviation are over the values kept so far; the ends use the first and last full block.
    """
    sizes = df.groupBy(*keys).agg(F.count("*").alias("_n"))

    def run(out: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
        for offset, block in passes:
            w = _over(keys, order).rowsBetween(-(block // 2), block - block // 2 - 1)
            out = out.withColumns({"_mean": F.avg(column).over(w), "_std": F.stddev_pop(column).over(w)})
            low, high = block // 2, F.col("_n") - (block - block // 2)
            by = Window.partitionBy(*keys)
            edge = {f"_{s}{e}": F.max(F.when(F.col("_i") == at, F.col(f"_{s}"))).over(by) for s in ("mean", "std") for e, at in (("0", F.least(F.lit(low), F.greatest(high, F.lit(0)))), ("1", F.greatest(high, F.lit(0))))}
            out = out.withColumns(edge)
            mean, std = (F.when(F.col("_i") < low, F.col(f"_{s}0")).when(F.col("_i") > high, F.col(f"_{s}1")).otherwise(F.col(f"_{s}")) for s in ("mean", "std"))
            out = out.withColumn(column, F.when(~(F.abs(F.col(column) - mean) > offset * std) | std.isNull(), F.col(column)))
        return out

    # A pass sees a block to each side, and at the ends as far again to the first or last full block.
    reach = 2 * sum(block for _, block in passes)
    return in_row_blocks(joined(df, sizes, keys), keys, order[0], order[1:], reach, reach, run, max(block_rows, 2 * reach)).select(*df.columns)


def despike_both_ways(df: DataFrame, keys: list[str], order: list[str], columns: list[str], passes: list[tuple[float, int]]) -> DataFrame:
    """W02 backward, then forward, for each column in turn; rows lost in one column are gone for the next.

    The columns of `order` are numbers.
    """
    out = df
    for c in columns:
        turned = {f"_back{i}": -F.col(x) for i, x in enumerate(order)}
        back = despike(out.withColumns(turned), keys, list(turned), c, passes).drop(*turned).where(F.col(c).isNotNull())
        out = despike(back, keys, order, c, passes).where(F.col(c).isNotNull())
    return out


def fill_gaps_linear(df: DataFrame, keys: list[str], us: str, order: list[str], column: str) -> DataFrame:
    """Null values become linear in time between good ones; the ends are held constant."""
    good = F.when(F.col(column).isNotNull(), F.struct(F.col(us).alias("us"), F.col(column).alias("y")))
    held = carry(df, keys, us, order, {"_prev": good})
    held = carry(held, keys, us, order, {"_next": good}, backward=True)
    t0, t1, y0, y1 = (F.col(x) for x in ("_prev.us", "_next.us", "_prev.y", "_next.y"))
    line = F.when(t1 > t0, y0 + (y1 - y0) * (F.col(us) - t0) / (t1 - t0)).otherwise(y0)
    return held.withColumn(column, F.coalesce(F.col(column), F.when(F.col("_prev").isNull(), y1).when(F.col("_next").isNull(), y0).otherwise(line))).drop("_prev", "_next")


def resample_linear(df: DataFrame, keys: list[str], us: str, column: str, period_us: int, limit: int | None = None) -> DataFrame:
    """Values on a regular axis from each key's first time rounded up, interpolated; at most `limit` steps from the last sample."""
    bounds = df.where(F.col(column).isNotNull()).groupBy(*keys).agg(F.min(us).alias("_a"), F.max(us).alias("_b"))
    axis = bounds.select(*keys, F.explode(F.sequence(F.ceil(F.col("_a") / period_us) * period_us, F.greatest(F.floor(F.col("_b") / period_us), F.ceil(F.col("_a") / period_us)) * period_us, F.lit(period_us))).alias(us))
    found = neighbours(axis, df.where(F.col(column).isNotNull()).select(*keys, us, column), keys, us, [column])
    value = _between(us, column)
    if limit is not None:
        value = F.when(F.col(us) - F.col("prev.us") < limit * period_us, value)
    return found.select(*keys, us, value.alias(column))


def true_regions(df: DataFrame, keys: list[str], order: list[str], flag: str) -> DataFrame:
    """Begin and end (of the order column) and length of each run of true."""
    runs = islands(df, keys, order, F.col(flag)).where(F.col(flag))
    return runs.groupBy(*keys, "island").agg(F.min(order[0]).alias("begin"), F.max(order[0]).alias("end"), F.count("*").alias("rows")).drop("island")


def bursts(df: DataFrame, keys: list[str], us: str, gap_us: int) -> DataFrame:
    """`burst` (from 0): a new one begins after a gap of more than gap_us."""
    before = carry(df, keys, us, [], {"_was": F.col(us)}, strict=True)
    new = F.when(F.col(us) - F.col("_was") > gap_us, 1).otherwise(0)
    return cumulated(before, keys, us, [], {"burst": new}).drop("_was")


def default_gap(df: DataFrame, keys: list[str], us: str) -> DataFrame:
    """The gap if none is given: the smaller of the first two steps plus one second."""
    w = _over(keys, [us])
    steps = df.select(*keys, (F.lead(us).over(w) - F.col(us)).alias("_step"), F.row_number().over(w).alias("_n")).where("_n <= 2")
    return steps.groupBy(*keys).agg((F.min("_step") + 1_000_000).alias("gap_us"))


def spread_repeated_times(df: DataFrame, keys: list[str], us: str, order: str, frequency: float) -> DataFrame:
    """Equal times become increasing by 1 / frequency, in shorter steps where they would pass the next time."""
    times = df.groupBy(*keys, us).agg(F.count("*").alias("_n"))
    times = carry(times, keys, us, [], {"_later": F.col(us)}, backward=True, strict=True)
    step = F.least(F.lit(1e6 / frequency), (F.col("_later") - F.col(us)) / F.col("_n"))
    times = times.select(*keys, us, F.coalesce(step, F.lit(1e6 / frequency)).alias("_step"))
    k = F.row_number().over(Window.partitionBy(*keys, us).orderBy(order)) - 1
    return joined(df.withColumn("_k", k), times, [*keys, us]).withColumn(us, F.col(us) + F.round(F.col("_k") * F.col("_step")).cast("long")).select(*df.columns)


def day_jump_correction(df: DataFrame, keys: list[str], order: str, us: str, tolerance_us: int | None = None, bucket: int = BLOCK_ROWS) -> DataFrame:
    """Rows between a jump by a day and the next one are shifted back by a day; `order` is a number.

    A jump is a step that differs from a day (up or down) by at most the tolerance, by default ten times the greater of
    one second and the median step.  The rows from each odd jump to the next are shifted against it.
    """
    day = 86_400_000_000
    out = carry(df, keys, order, [], {"_was": F.col(us)}, strict=True, bucket_us=bucket).withColumn("_d", F.col(us) - F.col("_was"))
    if tolerance_us is None:
        usual = out.groupBy(*keys).agg(F.percentile(F.abs("_d"), 0.5).alias("_m"))
        out = joined(out, usual, keys)
        tolerance = F.greatest(F.lit(1_000_000), F.coalesce("_m", F.lit(0))) * 10
    else:
        out, tolerance = out.withColumn("_m", F.lit(0)), F.lit(tolerance_us)
    sign = F.when(F.abs(F.col("_d") - day) <= tolerance, 1).when(F.abs(F.col("_d") + day) <= tolerance, -1).otherwise(0)
    out = cumulated(out.withColumn("_sign", sign), keys, order, [], {"_nth": F.abs("_sign")}, bucket)
    out = carry(out, keys, order, [], {"_shift": F.when(F.col("_sign") != 0, F.struct("_sign", "_nth"))}, bucket_us=bucket)
    moved = F.when(F.col("_shift._nth") % 2 == 1, F.col(us) - F.col("_shift._sign") * day).otherwise(F.col(us))
    return out.withColumn(us, moved).select(*df.columns)


def gaussian_moving_mean(df: DataFrame, keys: list[str], order: list[str], column: str, window: int, std: float = 3.0, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Centred mean of `window` rows weighted by a Gaussian of rows; nulls are left out, one value is enough."""
    import math

    half = window // 2

    def run(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
        w = _over(keys, order)
        terms = [(math.exp(-0.5 * (k / std) ** 2), F.lag(column, -k).over(w) if k else F.col(column)) for k in range(-half, window - half)]
        top = reduce(lambda a, b: a + b, [F.coalesce(x * g, F.lit(0.0)) for g, x in terms])
        weight = reduce(lambda a, b: a + b, [F.when(x.isNotNull(), g).otherwise(0.0) for g, x in terms])
        return rows.withColumn(column, F.try_divide(top, weight))

    return in_row_blocks(df, keys, order[0], order[1:], half, window - half - 1, run, block_rows)


def mostly_bad_regions(df: DataFrame, keys: list[str], order: list[str], flag: str, window: int, least: int | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """`mostly`, true where more than half of a centred window (or `least` rows) is true; the ends repeat their edge."""
    least = window // 2 + 1 if least is None else least
    half, place = window // 2, F.struct(*order)
    ends = df.withColumn("_f", F.col(flag).cast("int")).groupBy(*keys).agg(F.count("*").alias("_n"), F.min_by("_f", place).alias("_first"), F.max_by("_f", place).alias("_last"))

    def run(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
        inside = F.sum(F.col(flag).cast("int")).over(_over(keys, order).rowsBetween(-half, window - half - 1))
        before = F.greatest(half - F.col("_i"), F.lit(0)) * F.col("_first")
        after = F.greatest(F.col("_i") + (window - half) - F.col("_n"), F.lit(0)) * F.col("_last")
        return rows.withColumn("mostly", inside + before + after >= least)

    return in_row_blocks(joined(df, ends, keys), keys, order[0], order[1:], half, window - half - 1, run, block_rows).select(*df.columns, "mostly")


def overlapping_intervals(df: DataFrame, us: str, length_us: int, overlap: float = 0.5, origin_us: int = 0) -> DataFrame:
    """Each row once for each interval it lies in: intervals of length_us begin every (1 - overlap) * length_us."""
    slide = round(length_us * (1 - overlap))
    last = F.floor((F.col(us) - origin_us) / slide)
    first = F.floor((F.col(us) - origin_us - length_us) / slide) + 1
    return df.withColumn("interval", F.explode(F.sequence(first, last))).withColumn("interval_start", F.col("interval") * slide + origin_us).drop("interval")


def keep_index_after_delete(df: DataFrame, keys: list[str], us: str, order: list[str], bad: str, side: str = "left") -> DataFrame:
    """`good_index`: where each row's number goes when bad rows are deleted: its own new number, or for a bad row
    that of the last good row before (left) or the next one after (right), null if there is none."""
    counted = cumulated(df, keys, us, order, {"_g": F.when(F.col(bad), 0).otherwise(1)}).withColumn("_g", F.col("_g") - 1)
    own = F.when(~F.col(bad), F.col("_g"))
    return carry(counted, keys, us, order, {"good_index": own}, backward=side == "right").drop("_g")


def order_by_time(df: DataFrame, keys: list[str], ts: str, ties: list[str]) -> DataFrame:
    """Rows by key, time and tie-breakers."""
    return df.orderBy(*keys, ts, *ties)


def last_n(df: DataFrame, ts: str, n: int = 20, ties: list[str] | None = None) -> DataFrame:
    """The last n rows by time and tie-breakers; a report, so the limit is its purpose."""
    return df.orderBy(*[F.desc(c) for c in [ts, *(ties or [])]]).limit(n)


def separator_rows(df: DataFrame, keys: list[str], us: str, frequency: float | None = None) -> DataFrame:
    """One row of nulls after each file, half a step after its last time (0.5 / frequency, else half the last step, else 1 s)."""
    w = _over(keys, [us])
    step = F.col(us) - F.lag(us).over(w)
    last = df.select(*keys, F.col(us), step.alias("_step")).groupBy(*keys).agg(F.max(us).alias("_t"), F.max_by("_step", us).alias("_s"))
    half = F.lit(round(0.5e6 / frequency)) if frequency else F.coalesce(F.floor(F.col("_s") / 2), F.lit(1_000_000))
    rows = last.select(*keys, (F.col("_t") + half).cast(df.schema[us].dataType).alias(us))
    return df.unionByName(rows, allowMissingColumns=True)


def stack_deployments(parts: list[DataFrame], keys: list[str], us: str, columns: list[str]) -> DataFrame:
    """Tables of one device one after another as single floats, each ended by a separator row."""
    cast = [p.select(*keys, us, *[F.col(c).cast("float").alias(c) for c in columns]).withColumn("deployment", F.lit(i)) for i, p in enumerate(parts)]
    return reduce(DataFrame.unionByName, [separator_rows(p, [*keys, "deployment"], us) for p in cast])


def union_station_lists(lists: list[DataFrame], ts: str) -> DataFrame:
    """All lists as one, by time."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), lists).orderBy(ts)


def intersect_ranges(start1: Column, end1: Column, start2: Column, end2: Column) -> tuple[Column, Column]:
    """The common part of two ranges; it is empty where the start is after the end."""
    return F.greatest(start1, start2), F.least(end1, end2)
