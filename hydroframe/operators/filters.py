"""Row and cell filters (F01-F17).  Every one is lazy and takes and returns a DataFrame."""

from __future__ import annotations

import math
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sequence import in_row_blocks, joined


def _limits(df: DataFrame, limits: dict[str, object], ts: str | None) -> list[tuple[str, str, object]]:
    """(column, 'min' | 'max' | 'fun', value) of the limits whose column exists; names match in any case."""
    names = {c.lower(): c for c in df.columns}
    if ts:
        names["date"] = ts
    found = []
    for key, value in limits.items():
        kind, _, column = key.partition("_")
        if kind in ("min", "max", "fun") and column.lower() in names and value is not None:
            found.append((names[column.lower()], kind, value))
    return found


def _literal(value: object) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def within_limits(df: DataFrame, limits: dict[str, object], ts: str | None = None) -> Column:
    """True where every limited column lies strictly inside its limits; a null value is outside."""
    good = F.lit(True)
    for column, kind, value in _limits(df, limits, ts):
        c = F.col(column)
        good = good & F.coalesce(value(c) if kind == "fun" else c > _literal(value) if kind == "min" else c < _literal(value), F.lit(False))
    return good


def filter_rows_minmax(df: DataFrame, limits: dict[str, object], ts: str | None = None) -> DataFrame:
    """keep rows strictly inside min_<col> / max_<col>; min_date and max_date limit the time column."""
    return df.where(within_limits(df, limits, ts))


def filter_rows_logged(df: DataFrame, limits: dict[str, object], keys: list[str], ts: str) -> DataFrame:
    """per key, how many rows F01 keeps (rows) and drops (rows_filtered), and the last time kept."""
    good = within_limits(df, limits, ts)
    return df.groupBy(*keys).agg(F.count_if(good).alias("rows"), F.count_if(~good).alias("rows_filtered"), F.max(F.when(good, F.col(ts))).alias("last_time"))


def _null_outside(df: DataFrame, limits: dict[str, float], equal_stays: bool) -> DataFrame:
    changed: dict[str, Column] = {}
    for key, value in limits.items():
        kind, _, pattern = key.partition("_")
        for column in (c for c in df.columns if re.fullmatch(pattern, c)):
            c = changed.get(column, F.col(column))
            if kind == "min":
                keep = c >= value if equal_stays else c > value
            else:
                keep = c <= value if equal_stays else c < value
            changed[column] = F.when(keep, c)
    return df.withColumns(changed)


def null_outside_limits(df: DataFrame, limits: dict[str, float]) -> DataFrame:
    """cells outside min_<regex> / max_<regex> become null; a value equal to its limit too."""
    return _null_outside(df, limits, equal_stays=False)


def null_outside_limits_inclusive(df: DataFrame, limits: dict[str, float]) -> DataFrame:
    """as F03, but a value equal to its limit stays."""
    return _null_outside(df, limits, equal_stays=True)


#: Columns that a short name in a file name stands for (fixed values).
FILE_NAME_COLUMNS = {"Ox": ("O2", "O2ppm")}


def null_columns_by_file_name(df: DataFrame, file_name: Column, columns: list[str]) -> DataFrame:
    """a file named like x-no_Ox,pH.csv has no good values in the columns named after -no_."""
    stem = F.regexp_replace(file_name, r"\.[^./]*$", "")
    named = F.split(F.regexp_extract(stem, r"-no_([^/]*)$", 1), ",")
    back = {c: short for short, own in FILE_NAME_COLUMNS.items() for c in own}
    return df.withColumns({c: F.when(~(F.array_contains(named, c) | F.array_contains(named, back.get(c, c))), F.col(c)) for c in columns})


PREDICATES: dict[str, Callable[[Column], Column]] = {}


def predicate(name: str) -> Callable:
    """register a function Column -> boolean Column under a name that settings can use."""

    def add(fn: Callable[[Column], Column]) -> Callable[[Column], Column]:
        PREDICATES[name] = fn
        return fn

    return add


def custom_predicate(df: DataFrame, uses: dict[str, str]) -> DataFrame:
    """keep rows where the registered predicate of each column holds: {column: predicate name}."""
    good = F.lit(True)
    for column, name in uses.items():
        good = good & F.coalesce(PREDICATES[name](F.col(column)), F.lit(False))
    return df.where(good)


def computed_columns(df: DataFrame, functions: dict[str, str | Column | Callable] | None = None, add: dict[str, float] | None = None) -> DataFrame:
    """<col>_fun gives a column by SQL text, a Column or a function of the frame; <col>_add shifts it."""
    made = {c: F.expr(f) if isinstance(f, str) else f(df) if callable(f) and not isinstance(f, Column) else f for c, f in (functions or {}).items()}
    out = df.withColumns(made) if made else df
    return out.withColumns({c: F.col(c) + v for c, v in (add or {}).items()}) if add else out


def in_ranges(ts: str, ranges: list[tuple]) -> Column:
    inside = F.lit(False)
    for begin, end in ranges:
        inside = inside | F.col(ts).between(_literal(begin), _literal(end))
    return inside


def select_time_ranges(df: DataFrame, ts: str, ranges: list[tuple]) -> DataFrame:
    """rows in any of the ranges, both ends included.  For many ranges join them."""
    return df.where(in_ranges(ts, ranges))


def remove_time_ranges(df: DataFrame, ts: str, intervals: DataFrame, begin: str = "Time_st", end: str = "Time_en", keys: list[str] | None = None) -> DataFrame:
    """rows outside all intervals; rows exactly at a bound stay."""
    from .joins import bucketed_intervals

    return bucketed_intervals(df, ts, intervals, begin, end, keys or [], how="left_anti", strict=True)


def edit_time_ranges(df: DataFrame, ts: str, edits: DataFrame, column: str, begin: str = "Time_st", end: str = "Time_en", value: str = "new_value", keys: list[str] | None = None, delete: bool = False) -> DataFrame:
    """set a column to the value of the interval a row lies in (both ends), or delete such rows."""
    from .joins import bucketed_intervals

    if delete:
        return bucketed_intervals(df, ts, edits, begin, end, keys or [], how="left_anti")
    held = bucketed_intervals(df, ts, edits.withColumn("_edit", F.lit(True)), begin, end, keys or [], how="left")
    return held.withColumn(column, F.when(F.col("_edit"), F.col(value)).otherwise(F.col(column))).select(*df.columns)


def per_device_settings(df: DataFrame, settings: DataFrame, device: str, defaults: dict[str, object]) -> DataFrame:
    """settings of each row's device, a default where the device or the setting is missing."""
    joined = df.join(settings, device, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def too_frequent_values(df: DataFrame, column: str, max_percent: float = 0.5) -> DataFrame:
    """`too_frequent`, true where the value's share of all rows exceeds max_percent."""
    counts = df.groupBy(column).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n").alias("_total"))
    often = counts.join(F.broadcast(total)).where(F.col("_n") * 100.0 / F.col("_total") > max_percent)
    # At most 100 / max_percent values, so the hot rows stay where they are.
    often = F.broadcast(often.select(F.col(column).alias("_value"), F.lit(True).alias("_often")))
    return df.join(often, F.col(column).eqNullSafe(F.col("_value")), "left").withColumn("too_frequent", F.coalesce("_often", F.lit(False))).select(*df.columns, "too_frequent")


def frozen_signal(df: DataFrame, keys: list[str], order: list[str], column: str, noise: float, strides: tuple[int, ...] = (16, 32), block_rows: int = 1 << 17) -> DataFrame:
    """`works`, true where the signal differs by more than noise from the row before, or over a stride of rows.

    The n-th whole stride of k rows lies between the rows n k and n k + k and stands for the rows behind the first of these,
    up to the second; an unfinished last stride is not tested.  The first row is as the second.  Where the differences
    that are null are more than a tenth of a device's rows, every row works.
    """
    def run(out: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
        w, c = Window.partitionBy(*keys).orderBy(*order), F.col(column)
        change = c - F.lag(c).over(w)
        out = out.withColumns({"_moved": F.coalesce(F.abs(change) > noise, F.lit(False)), "_blank": F.isnull(change)})
        works, at = F.when(F.col("_i") > 0, F.col("_moved")).otherwise(F.coalesce(F.lead("_moved").over(w), F.lit(False))), F.greatest(F.col("_i") - 1, F.lit(0))
        for k in strides:
            jump = F.when((F.col("_i") > 0) & (at % k == 0), F.abs(F.lead(c, k - 1).over(w) - F.lag(c).over(w)) > noise)
            out = out.withColumn(f"_jump{k}", jump)
            works = works | F.coalesce(F.max(f"_jump{k}").over(Window.partitionBy(*keys, F.floor(at / k))), F.lit(False))
        return out.withColumn("works", works)

    whole, reach = math.lcm(*strides), max(strides, default=1)
    out = in_row_blocks(df, keys, order[0], order[1:], reach, reach, run, -(-block_rows // whole) * whole)
    blank = out.groupBy(*keys).agg((F.count_if("_blank") - 1 > F.count("*") / 10).alias("_all"))
    return joined(out, blank, keys).withColumn("works", F.col("works") | F.col("_all")).select(*df.columns, "works")


def overlaps_bbox(west: Column, east: Column, south: Column, north: Column, box: tuple[float, float, float, float]) -> Column:
    """the boxes touch or overlap; box: west, east, south, north."""
    w, e, s, n = box
    return (west <= e) & (east >= w) & (south <= n) & (north >= s)


def position_inside(lon: Column, lat: Column, box: tuple[float, float, float, float]) -> Column:
    """the last position lies strictly inside the box."""
    w, e, s, n = box
    return (lon > w) & (lon < e) & (lat > s) & (lat < n)


def overlaps_time(start: Column, end: Column, begin: Column, stop: Column) -> Column:
    """the times overlap by more than a moment."""
    return F.greatest(start, begin) < F.least(end, stop)


def min_satellites(df: DataFrame, column: str = "n_GPS", least: int = 3) -> DataFrame:
    """rows with at least so many satellites; rows without a count stay out."""
    return df.where(F.col(column) >= least)


def max_distance_from_anchor(df: DataFrame, keys: list[str], lat: str, lon: str, max_dr: float) -> DataFrame:
    """F16: rows within max_dr metres of the mean position; the mean is made anew from these, and the filter repeated once."""
    from ..functions.geo import displacement

    def near(rows: DataFrame) -> DataFrame:
        anchor = rows.groupBy(*keys).agg(F.avg(lat).alias("_lat"), F.avg(lon).alias("_lon"))
        held = df.join(anchor, keys) if keys else df.crossJoin(F.broadcast(anchor))
        dr = displacement(F.col("_lon"), F.col("_lat"), F.col(lon), F.col(lat))["distance"]
        return held.withColumn("dr", dr).where(F.col("dr") <= max_dr).drop("_lat", "_lon")

    return near(near(df).select(*df.columns))


def burst_start_nulls(df: DataFrame, keys: list[str], us: str, column: str, period_us: int, first: int = 2) -> DataFrame:
    """the first samples of each period become null."""
    w = Window.partitionBy(*keys, F.floor(F.col(us) / period_us)).orderBy(us)
    return df.withColumn(column, F.when(F.row_number().over(w) > first, F.col(column)))
