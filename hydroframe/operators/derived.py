"""Derived series that need neighbours: PCHIP navigation (J08), magnetometer recovery (M06), pressure (M07), declination."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import horner
from .joins import nearest_grid_cells, neighbours
from .windows import fill_gaps_linear


def nav_columns_for_samples(points: DataFrame, series: DataFrame, keys: list[str], us: str, columns: list[str], prefix: str = "nav_") -> DataFrame:
    """Values of the series at each point by shape-preserving cubics (PCHIP); null outside the series.

    The slope at a sample is the weighted harmonic mean of the slopes beside it, zero at a turn; at the ends it is that of
    the only interval.
    """
    w = Window.partitionBy(*keys).orderBy(us)
    t = F.col(us)
    h0, h1 = (t - F.lag(t).over(w)) / 1e6, (F.lead(t).over(w) - t) / 1e6
    held = series
    for c in columns:
        y = F.col(c)
        d0, d1 = F.try_divide(y - F.lag(y).over(w), h0), F.try_divide(F.lead(y).over(w) - y, h1)
        w1, w2 = 2 * h1 + h0, h1 + 2 * h0
        inner = F.when(d0 * d1 > 0, (w1 + w2) / (w1 / d0 + w2 / d1)).otherwise(F.lit(0.0))
        held = held.withColumn(f"_m_{c}", F.when(d0.isNull(), d1).when(d1.isNull(), d0).otherwise(inner))
    found = neighbours(points, held, keys, us, [*columns, *[f"_m_{c}" for c in columns]])
    step = (F.col("next.us") - F.col("prev.us")) / 1e6
    s = F.try_divide((t - F.col("prev.us")) / 1e6, step)

    def cubic(c: str):
        y0, y1, m0, m1 = (F.col(x) for x in (f"prev.{c}", f"next.{c}", f"prev._m_{c}", f"next._m_{c}"))
        line = y0 * (1 + 2 * s) * (1 - s) ** 2 + step * m0 * s * (1 - s) ** 2 + y1 * s * s * (3 - 2 * s) + step * m1 * s * s * (s - 1)
        return F.when(step == 0, y0).when(step > 0, line)

    return found.select(*points.columns, *[cubic(c).alias(f"{prefix}{c}") for c in columns])


def recover_magnetometer_x(df: DataFrame, keys: list[str], us: str, order: list[str], x: str, y: str, z: str) -> DataFrame:
    """A missing x from y, z and the device's median field, with the sign of x interpolated; else interpolated x itself."""
    norm = F.sqrt(F.col(x) ** 2 + F.col(y) ** 2 + F.col(z) ** 2)
    usual = df.groupBy(*keys).agg(F.percentile(norm, 0.5).alias("_field"))
    held = fill_gaps_linear(df.withColumn("_x", F.col(x)), keys, us, order, "_x").join(usual, keys)
    rest = F.col("_field") ** 2 - F.col(y) ** 2 - F.col(z) ** 2
    root = F.when(rest >= 0, F.sqrt(F.greatest(rest, F.lit(0.0))) * F.when(F.col("_x") < 0, -1).otherwise(1))
    return held.withColumn(x, F.coalesce(x, root, "_x")).drop("_x", "_field")


def pressure_from_counts(df: DataFrame, keys: list[str], us: str, order: list[str], p: str, coefs: list[float], temperature: str, t_coefs: list[float], battery: str, b_coefs: list[float], battery_min: float) -> DataFrame:
    """Polynomial of the counts plus terms of temperature and battery, highest powers first.

    Temperature is measured in steps: it is interpolated between the rows where it changes.  The battery's term is that
    of battery_min as long as the voltage is above it.
    """
    w = Window.partitionBy(*keys).orderBy(us, *order)
    change = F.when(~F.col(temperature).eqNullSafe(F.lag(temperature).over(w)), F.col(temperature))
    smooth = fill_gaps_linear(df.withColumn("_t", change), keys, us, order, "_t")
    arrays = [F.array(*[F.lit(float(c)) for c in cs]) for cs in (coefs, t_coefs, b_coefs)]
    low = F.least(F.col(battery), F.lit(float(battery_min)))
    return smooth.withColumn(p, horner(F.col(p), arrays[0]) + horner(F.col("_t"), arrays[1]) + horner(low, arrays[2])).drop("_t")


def declination_lookup(points: DataFrame, grid: DataFrame, lat: str, lon: str, year: str, origin: tuple[float, float], step: float, point_id: str) -> DataFrame:
    """Declination at each point: bilinear in a user's grid (i, j, epoch, declination, change a year) plus the yearly change.

    Of several epochs the last before the point's year is used.
    """
    # A model has a handful of epochs: one row with a list of them.
    epochs = grid.agg(F.collect_set("epoch").alias("_epochs"))
    chosen = F.array_max(F.filter("_epochs", lambda e: e <= F.col(year)))
    held = points.crossJoin(F.broadcast(epochs)).withColumn("epoch", chosen).where("epoch is not null").drop("_epochs")
    out = None
    for column in ("declination", "change"):
        keyed = held.withColumn("_key", F.struct(point_id, "epoch"))
        part = _bilinear(keyed, grid, lat, lon, origin, step, column)
        out = part if out is None else out.join(part, "_key")
    out = out.select(F.col(f"_key.{point_id}").alias(point_id), F.col("_key.epoch").alias("_epoch"), "declination", "change").join(points.select(point_id, year), point_id)
    return out.select(point_id, (F.col("declination") + F.col("change") * (F.col(year) - F.col("_epoch"))).alias("declination"))


def _bilinear(points: DataFrame, grid: DataFrame, lat: str, lon: str, origin: tuple[float, float], step: float, column: str) -> DataFrame:
    cells = grid.select("i", "j", F.col("epoch").alias("_ge"), column)
    found = nearest_grid_cells(points, cells, lat, lon, origin, step, around=True).where(F.col("_ge") == F.col("epoch"))
    y, x = (F.col(lat) - origin[0]) / step, (F.col(lon) - origin[1]) / step
    out = found.withColumn("_w", (1 - F.abs(y - F.col("i"))) * (1 - F.abs(x - F.col("j")))).where(F.col("_w") > 1e-9)
    return out.groupBy("_key").agg((F.sum(F.col("_w") * F.col(column)) / F.sum("_w")).alias(column))
