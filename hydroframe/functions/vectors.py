"""Vectors, tilt and flow as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_cartesian(speed: Column, direction: Column) -> tuple[Column, Column]:
    """U (east) and v (north) of a speed and the direction it goes to, in degrees from north."""
    return speed * F.sin(F.radians(direction)), speed * F.cos(F.radians(direction))


def to_polar(u: Column, v: Column, wrap: bool = False) -> tuple[Column, Column]:
    """Speed and direction, in (-180, 180] or, wrapped, in [0, 360)."""
    direction = F.degrees(F.atan2(u, v))
    return F.hypot(u, v), F.pmod(direction, F.lit(360.0)) if wrap else direction


def tilt(gx: Column, gy: Column, gz: Column) -> dict[str, Column]:
    """Pitch, roll and inclination (radians) of an acceleration vector."""
    return {"pitch": -F.atan(F.try_divide(gx, F.hypot(gy, gz))), "roll": F.atan2(gy, gz), "inclination": F.atan2(F.hypot(gx, gy), gz)}


def calibrated(raw: list[Column], matrix: Column, bias: Column) -> list[Column]:
    """A (raw - C) with A (3 rows of 3) and C (3) as array columns."""
    centred = [x - bias[i] for i, x in enumerate(raw)]
    return [sum((matrix[i][j] * centred[j] for j in range(1, 3)), matrix[i][0] * centred[0]) for i in range(3)]


def rotated(x: Column, y: Column, z: Column, axis: str, angle: Column) -> tuple[Column, Column, Column]:
    """A vector turned about the x, y or z axis by an angle in radians."""
    c, s = F.cos(angle), F.sin(angle)
    if axis == "x":
        return x, y * c - z * s, y * s + z * c
    if axis == "y":
        return x * c + z * s, y, z * c - x * s
    return x * c - y * s, x * s + y * c, z


def _horner(x: Column, coefs: Column) -> Column:
    """A polynomial with the highest power first, coefficients in an array column."""
    return F.aggregate(coefs, F.lit(0.0), lambda acc, c: acc * x + c)


horner = _horner


def speed_from_tilt(inclination: Column, coefs: Column, max_slope: float = 10.0) -> Column:
    """Speed by an inclination in radians.

    Up to four coefficients are a polynomial of the force sqrt(tan(inclination) / cos(inclination)).  More are a
    trigonometric series: (level, a1, b1, a2, b2, ..., last angle in degrees) gives sqrt(sin r / (level + sum of
    a cos(n r) + b sin(n r))); above the last angle the curve goes on as a line with the slope there, at most max_slope.
    """
    force = F.sqrt(F.tan(inclination) / F.cos(inclination))
    last = F.radians(F.element_at(coefs, -1))

    def series(r: Column) -> Column:
        terms = F.slice(coefs, F.lit(2), F.size(coefs) - 2)
        each = F.transform(terms, lambda c, i: c * F.when(i % 2 == 0, F.cos(r * (F.floor(i / 2) + 1))).otherwise(F.sin(r * (F.floor(i / 2) + 1))))
        return F.sqrt(F.try_divide(F.sin(r), F.aggregate(each, coefs[0], lambda acc, c: acc + c)))

    step = 0.01
    slope = F.least((series(last) - series(last - step)) / step, F.lit(max_slope))
    trig = F.when(inclination <= last, series(inclination)).otherwise(series(last) + (inclination - last) * slope)
    return F.when(F.size(coefs) <= 4, _horner(force, coefs)).otherwise(trig)


def flow_direction(g: list[Column], h: list[Column], azimuth_shift: Column) -> Column:
    """The direction a tilted logger leans to, in [0, 360), from acceleration g and magnetic field h."""
    (gx, gy, gz), (hx, hy, hz) = g, h
    length = F.sqrt(gx * gx + gy * gy + gz * gz)
    angle = F.atan2((gx * hy - gy * hx) * length, hz * (gx * gx + gy * gy) - gz * (gx * hx + gy * hy))
    return F.pmod(azimuth_shift - F.degrees(angle), F.lit(360.0))


def flow(g: list[Column], h: list[Column], azimuth_shift: Column, coefs: Column, max_g_error: float = 1.0, max_h_error: float = 0.1) -> dict[str, Column]:
    """Speed and direction; no speed where |g| is off 1 by more than its limit, direction 0 where |h| is off by its own."""
    g_length = F.sqrt(g[0] * g[0] + g[1] * g[1] + g[2] * g[2])
    h_length = F.sqrt(h[0] * h[0] + h[1] * h[1] + h[2] * h[2])
    speed = F.when(F.abs(g_length - 1) <= max_g_error, speed_from_tilt(tilt(*g)["inclination"], coefs))
    direction = F.when(F.abs(h_length - 1) < max_h_error, flow_direction(g, h, azimuth_shift)).otherwise(F.lit(0.0))
    return {"speed": speed, "direction": direction}


def psig_to_dbar(p: Column) -> Column:
    """Gauge pressure in pounds per square inch to decibars."""
    return p * 0.6894757293168361
