"""Sections, profiles and gridding."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import displacement, foot_on_line
from .grouped import _same, apply_per_block
from .sequence import BUCKET_US, joined, numbered, settled

#: Rounds in which Spark splits long stretches of a track; what is long then goes to one task.
ROUNDS = 60


def split_sections(points: DataFrame, route: str, order: str, marker: Column, excluded: Column, lat: str, lon: str, near_m: float) -> DataFrame:
    """`section` of each route point: a new one begins at a marker; excluded points and sections of up to two points go.

    The marker point also ends the section before it if it is nearer than near_m to that section's last point.
    """
    w = Window.partitionBy(route).orderBy(order)
    used = points.where(~F.coalesce(excluded, F.lit(False))).withColumn("_mark", F.coalesce(marker, F.lit(False)))
    used = used.withColumn("section", F.sum(F.col("_mark").cast("int")).over(w))
    gap = displacement(F.lag(lon).over(w), F.lag(lat).over(w), F.col(lon), F.col(lat))["distance"]
    ends = used.withColumn("_gap", gap).where(F.col("_mark") & (F.col("section") > 0) & (F.col("_gap") < near_m)).withColumn("section", F.col("section") - 1).drop("_gap")
    every = used.unionByName(ends).drop("_mark")
    return every.withColumn("_n", F.count("*").over(Window.partitionBy(route, "section"))).where("_n > 2").drop("_n")


def section_distance(casts: DataFrame, keys: list[str], order: str, lat: str, lon: str, lat_end: str, lon_end: str) -> DataFrame:
    """Kilometres along the section at the start and the end of each cast.

    Starts are a running sum; an end is projected on the line from its start to the next (for the last cast, on the line
    from the start before), and keeps the sign of the direction.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    x0, y0 = F.col(lon), F.col(lat)
    step = displacement(F.lag(lon).over(w), F.lag(lat).over(w), x0, y0)["distance"]
    out = casts.withColumn("_step", F.coalesce(step, F.lit(0.0)) / 1000).withColumn("distance", F.sum("_step").over(w))
    ax, ay = F.coalesce(F.lead(lon).over(w), 2 * x0 - F.lag(lon).over(w)), F.coalesce(F.lead(lat).over(w), 2 * y0 - F.lag(lat).over(w))
    out = out.withColumns({"_bx": ax, "_by": ay})
    scale = F.cos(F.radians(y0))
    fx, fy = foot_on_line(x0 * scale, y0, F.col("_bx") * scale, F.col("_by"), F.col(lon_end) * scale, F.col(lat_end))
    along = displacement(x0, y0, fx / scale, fy)["distance"] / 1000
    forward = F.signum((fx - x0 * scale) * (F.col("_bx") - x0) * scale + (fy - y0) * (F.col("_by") - y0))
    return out.withColumn("distance_en", F.col("distance") + F.coalesce(along * forward, F.lit(0.0))).drop("_step", "_bx", "_by")


def last_good_in_run(df: DataFrame, keys: list[str], order: str, column: str, altitude: str | None = None, max_altitude: float | None = None) -> DataFrame:
    """Order of the last valid sample of each cast, if asked only where the bottom is near."""
    good = F.col(column).isNotNull()
    if altitude and max_altitude is not None:
        good = good & (F.col(altitude) <= max_altitude)
    return df.groupBy(*keys).agg(F.max(F.when(good, F.col(order))).alias("last_good"))


def clean_depth_line(df: DataFrame, keys: list[str], order: list[str], depth: str, offset: float, low: float, high: float, passes: list[tuple[float, int]]) -> DataFrame:
    """Soundings made positive and shifted, then without frozen, outlying, too frequent and spiky values, smoothed."""
    from .filters import frozen_signal, null_outside_limits, too_frequent_values
    from .grouped import smooth_per_block
    from .windows import despike

    out = df.withColumn(depth, F.abs(depth) + offset)
    out = null_outside_limits(out, {f"min_{depth}": low, f"max_{depth}": high})
    out = settled(frozen_signal(settled(out), keys, order, depth, 0.0))
    out = settled(too_frequent_values(out, depth, 5.0))
    out = out.withColumn(depth, F.when(F.col("works") & ~F.col("too_frequent"), F.col(depth))).drop("works", "too_frequent")
    return smooth_per_block(despike(out, keys, order, depth, passes), keys, order, depth, "db4", 3)


def merge_cast_depth(line: DataFrame, casts: DataFrame, keys: list[str], x: str, depth: str, near_km: float = 0.5, slope: float = 0.05) -> DataFrame:
    """The depth line with the bottoms of casts that have no sounding within near_km and inside the slope's cone.

    Positions are bucketed by near_km, and a cast looks into three buckets.
    """
    bucket = F.floor(F.col(x) / near_km)
    a = casts.select(*keys, F.col(x).alias("_x"), F.col(depth).alias("_d"), F.explode(F.sequence(bucket - 1, bucket + 1)).alias("_b"))
    b = line.select(*keys, F.col(x), F.col(depth), bucket.alias("_b")).where(F.col(depth).isNotNull())
    seen = (F.abs(F.col(x) - F.col("_x")) < near_km) & (F.abs(F.col(depth) - F.col("_d")) <= slope * 1000 * F.abs(F.col(x) - F.col("_x")) + 1)
    close = a.join(b, [*keys, "_b"]).where(seen).select(*keys, F.col("_x").alias(x)).distinct()
    alone = casts.select(*keys, x, depth).join(close, [*keys, x], "left_anti")
    return line.select(*keys, x, depth).unionByName(alone)


def horizon_slices(profiles: DataFrame, keys: list[str], depth: str, column: str, levels: list[float], margin: float, limit: float) -> DataFrame:
    """Value of each cast at each level: rows within the margin, those off their mean by more than limit dropped, then linear."""
    near = F.filter(F.array(*[F.lit(float(v)) for v in levels]), lambda v: F.abs(v - F.col(depth)) <= margin)
    rows = profiles.where(F.col(column).isNotNull()).select(*keys, F.col(depth).alias("_z"), F.col(column).alias("_y"), F.explode(near).alias("level"))
    by = Window.partitionBy(*keys, "level")
    # A row exactly on the limit stays, however the sum of the mean was rounded: that depends on the order of its rows.
    rows = rows.withColumn("_m", F.avg("_y").over(by)).where(F.abs(F.col("_y") - F.col("_m")) <= limit + 1e-12 * (limit + F.abs(F.col("_m"))))
    below, above = F.col("_z") <= F.col("level"), F.col("_z") >= F.col("level")
    out = rows.groupBy(*keys, "level").agg(F.max(F.when(below, F.struct("_z", "_y"))).alias("a"), F.min(F.when(above, F.struct("_z", "_y"))).alias("b"))
    between = F.col("a._y") + (F.col("b._y") - F.col("a._y")) * (F.col("level") - F.col("a._z")) / (F.col("b._z") - F.col("a._z"))
    value = F.when(F.col("b._z") == F.col("a._z"), F.col("a._y")).otherwise(between)
    return out.select(*keys, "level", value.alias(column)).where(F.col(column).isNotNull())


def grid_section(profiles: DataFrame, section: list[str], x: str, depth: str, column: str, x_step: float, z_step: float) -> DataFrame:
    """Values on a regular (x, z) grid: each cast to z levels, then linear in x between neighbouring casts.

    Below the bottom, which is linear between the casts' last depths, there are no values.
    """
    def levels(df: DataFrame, keys: list[str], at: str, value: str, step: float) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(at)
        seg = df.where(F.col(value).isNotNull()).withColumns({"_n": F.lead(at).over(w), "_v": F.lead(value).over(w)})
        last = F.coalesce("_n", at)
        first = F.ceil(F.col(at) / step - 1e-9)
        stop = F.when(F.col("_n").isNull(), F.floor(F.col(at) / step + 1e-9)).otherwise(F.ceil(last / step - 1e-9) - 1)
        cells = seg.where(first <= stop).withColumn("_i", F.explode(F.sequence(first, stop)))
        grid = F.col("_i") * step
        line = F.col(value) + F.coalesce(F.try_divide((grid - F.col(at)) * (F.col("_v") - F.col(value)), F.col("_n") - F.col(at)), F.lit(0.0))
        return cells.select(*keys, grid.alias(at), line.alias(value))

    mean = profiles.groupBy(*section, x, depth).agg(F.avg(column).alias(column))
    vertical = levels(mean, [*section, x], depth, column, z_step)
    grid = levels(vertical, [*section, depth], x, column, x_step)
    bottom = levels(mean.groupBy(*section, x).agg(F.max(depth).alias("_bottom")), section, x, "_bottom", x_step)
    return grid.join(bottom, [*section, x]).where(F.col(depth) <= F.col("_bottom") + 1e-9).drop("_bottom")


def grid_to_point(points: DataFrame, grid: DataFrame, lat: str, lon: str, origin: tuple[float, float], step: float, column: str, point_id: str) -> DataFrame:
    """Bilinear value at each point from the 2 x 2 cells around it; a missing cell leaves its weight out."""
    from .joins import nearest_grid_cells

    found = nearest_grid_cells(points, grid.where(F.col(column).isNotNull()), lat, lon, origin, step, around=True)
    y, x = (F.col(lat) - origin[0]) / step, (F.col(lon) - origin[1]) / step
    weight = (1 - F.abs(y - F.col("i"))) * (1 - F.abs(x - F.col("j")))
    out = found.withColumn("_w", weight).where(F.col("_w") > 1e-9).groupBy(point_id).agg(F.sum(F.col("_w") * F.col(column)).alias("_s"), F.sum("_w").alias("_t"))
    return out.select(point_id, F.try_divide("_s", "_t").alias(column))


def iso_depth(profiles: DataFrame, keys: list[str], depth: str, column: str, value: float, last: bool = False) -> DataFrame:
    """Depth at which a profile crosses a value; several crossings give null, or the last one if asked."""
    w = Window.partitionBy(*keys).orderBy(depth)
    a, b = F.lag(column).over(w), F.col(column)
    cross = F.when((a - value) * (b - value) < 0, F.lag(depth).over(w) + (F.col(depth) - F.lag(depth).over(w)) * (value - a) / (b - a)).when(b == value, F.col(depth))
    out = profiles.where(F.col(column).isNotNull()).withColumn("_c", cross).groupBy(*keys).agg(F.count("_c").alias("crossings"), F.max("_c").alias("_z"))
    return out.select(*keys, "crossings", (F.col("_z") if last else F.when(F.col("crossings") == 1, F.col("_z"))).alias("iso_depth"))


def pad_section_edges(profiles: DataFrame, section: list[str], x: str, depth: str, half_cell: float) -> DataFrame:
    """The first and last cast once more, half a cell outside the section's edges."""
    edge = profiles.groupBy(*section).agg(F.min(x).alias("_a"), F.max(x).alias("_b"))
    held = profiles.join(edge, section)
    left = held.where(F.col(x) == F.col("_a")).withColumn(x, F.col(x) - half_cell)
    right = held.where(F.col(x) == F.col("_b")).withColumn(x, F.col(x) + half_cell)
    return profiles.unionByName(left.drop("_a", "_b")).unionByName(right.drop("_a", "_b"))


def bottom_points(profiles: DataFrame, section: list[str], x: str, depth: str, columns: list[str], step: float) -> DataFrame:
    """Points along the bottom between the casts' last samples, linear in x, every `step`."""
    ends = profiles.groupBy(*section, x).agg(F.max_by(F.struct(depth, *columns), depth).alias("e"))
    w = Window.partitionBy(*section).orderBy(x)
    seg = ends.withColumns({"_x1": F.lead(x).over(w), "_e1": F.lead("e").over(w)}).where("_x1 is not null")
    k = F.explode(F.sequence(F.lit(1), F.greatest(F.ceil((F.col("_x1") - F.col(x)) / step) - 1, F.lit(0)).cast("int") + 1))
    cut = seg.withColumn("_k", k).withColumn("_f", F.col("_k") * step / (F.col("_x1") - F.col(x))).where("_f < 1")
    return cut.select(*section, (F.col(x) + F.col("_k") * step).alias(x), *[(F.col(f"e.{c}") + (F.col(f"_e1.{c}") - F.col(f"e.{c}")) * F.col("_f")).alias(c) for c in (depth, *columns)])


def simplify(points: np.ndarray, tolerance: float) -> np.ndarray:
    """Douglas-Peucker: which points stay so that none dropped is farther than the tolerance from the line."""
    keep = np.zeros(len(points), bool)
    keep[[0, -1]] = True
    todo = [(0, len(points) - 1)]
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        line, rel = points[b] - points[a], points[a + 1 : b] - points[a]
        t = np.clip((rel @ line) / max(line @ line, 1e-300), 0, 1)
        off = np.linalg.norm(rel - t[:, None] * line, axis=1)
        far = int(np.argmax(off))
        if off[far] > tolerance:
            keep[a + 1 + far] = True
            todo += [(a, a + 1 + far), (a + 1 + far, b)]
    return keep


def simplify_track(df: DataFrame, keys: list[str], order: str, lat: str, lon: str, tolerance_m: float, block_rows: int = 1 << 17, bucket: int = BUCKET_US) -> DataFrame:
    """Points of each track segment that its line needs within the tolerance; `order` is a number.

    Stretches of more than block_rows points are split first by Spark: in each round a stretch gives its point farthest from the
    line between its ends (partial maxima, one row a stretch), which cuts it in two, or is done, if that point is within
    the tolerance.  Smaller stretches go to tasks on their own.  The splits are those of the whole track, so are the points.
    """
    rows = numbered(df, keys, order, [], bucket)
    middle = F.radians(F.col(lat))
    means = rows.groupBy(*keys).agg(F.avg(middle).alias("_mean"), F.count("*").alias("_n"))
    rows = joined(rows, means, keys).withColumns({"_x": F.radians(F.col(lon)) * F.cos("_mean") * 6371000.0, "_y": middle * 6371000.0})
    rows = settled(rows.select(*df.columns, "_i", "_x", "_y", "_n"))
    first, last = F.col("_i") == 0, F.col("_i") == F.col("_n") - 1
    kept, small, by = [rows.where(first | last).select(*df.columns)], [], [*keys, "_s"]
    inner = rows.where(~first & ~last).drop("_n").withColumn("_s", F.lit(0).cast("bigint"))
    corner = lambda at, name: [F.max(F.when(at, F.col(c))).alias(f"_{name}{c[1:]}") for c in ("_i", "_x", "_y")]
    stretches = rows.groupBy(*keys).agg(*corner(first, "a"), *corner(last, "b")).withColumn("_s", F.lit(0).cast("bigint"))
    for number in range(ROUNDS + 1):
        stretches = settled(stretches.where("_bi - _ai > 1"))
        short = (F.col("_bi") - F.col("_ai") <= block_rows) | F.lit(number == ROUNDS)
        small.append(joined(inner, stretches.where(short), by).withColumn("_round", F.lit(number)))
        if stretches.where(~short).isEmpty():
            break
        px, py, rx, ry = F.col("_bx") - F.col("_ax"), F.col("_by") - F.col("_ay"), F.col("_x") - F.col("_ax"), F.col("_y") - F.col("_ay")
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (rx * px + ry * py) / F.greatest(px * px + py * py, F.lit(1e-300))))
        off = F.sqrt(F.pow(rx - t * px, F.lit(2.0)) + F.pow(ry - t * py, F.lit(2.0)))
        corners = [f"_{e}{c}" for e in "ab" for c in "ixy"]
        long = joined(inner, stretches.where(~short), by).withColumn("_far", F.struct(off.alias("off"), (-F.col("_i")).alias("back"), F.col("_x").alias("x"), F.col("_y").alias("y")))
        far = long.groupBy(*by).agg(F.max("_far").alias("_far"), *[F.max(c).alias(c) for c in corners]).where(F.col("_far.off") > tolerance_m)
        far = settled(far.select(*by, *corners, (-F.col("_far.back")).alias("_ci"), F.col("_far.x").alias("_cx"), F.col("_far.y").alias("_cy")))
        cut = settled(joined(long.drop("_far", *corners), far.select(*by, "_ci"), by))
        kept.append(cut.where("_i = _ci").select(*df.columns))
        inner = cut.where("_i <> _ci").withColumn("_s", F.col("_s") * 2 + (F.col("_i") > F.col("_ci")).cast("bigint")).drop("_ci")
        halves = [[F.col(f"_{e}{c}").alias(f"_{to}{c}") for e, to in zip(ends, "ab", strict=True) for c in "ixy"] for ends in ("ac", "cb")]
        stretches = far.select(*keys, (F.col("_s") * 2).alias("_s"), *halves[0]).unionByName(far.select(*keys, (F.col("_s") * 2 + 1).alias("_s"), *halves[1]))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        a, b = (part[[f"_{e}x", f"_{e}y"]].iloc[:1].to_numpy(np.float64) for e in "ab")
        return part[simplify(np.concatenate([a, part[["_x", "_y"]].to_numpy(np.float64), b]), tolerance_m)[1:-1]]

    rest = reduce(DataFrame.unionByName, small)
    found = apply_per_block(rest, ["_round", *by], ["_i"], run, _same(rest)).select(*df.columns)
    return reduce(DataFrame.unionByName, [*kept, found])


def split_track_by_period(df: DataFrame, keys: list[str], us: str, period_us: int) -> DataFrame:
    """`part`: the number of the period that a row lies in, from the first with rows."""
    period = F.floor(F.col(us) / period_us)
    return df.withColumn("_p", period).withColumn("part", F.dense_rank().over(Window.partitionBy(*keys).orderBy("_p")) - 1).drop("_p")


def pairwise_track_distance(df: DataFrame, device: str, us: str, lat: str, lon: str, period_us: int) -> DataFrame:
    """Distance and bearing between devices in each bin of their mean positions."""
    from .joins import device_pairs
    from .stats import centered_bin_mean

    pairs = device_pairs(centered_bin_mean(df, [device], us, period_us, [lat, lon]), "bin", device, [lat, lon])
    between = displacement(F.col(f"{lon}_1"), F.col(f"{lat}_1"), F.col(f"{lon}_2"), F.col(f"{lat}_2"))
    return pairs.select("bin", f"{device}_1", f"{device}_2", between["distance"].alias("distance"), between["bearing"].alias("bearing"))
