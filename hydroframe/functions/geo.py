"""Positions as Column expressions (M08, M13, M16, M18-M20) and coordinates as text."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6371000.0


def displacement(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> dict[str, Column]:
    """Dx, dy, distance (metres) and bearing (degrees, 0 to 360) on a local plane at the mean latitude."""
    dy = F.radians(lat2 - lat1) * EARTH_M
    dx = F.radians(lon2 - lon1) * EARTH_M * F.cos(F.radians((lat1 + lat2) / 2))
    return {"dx": dx, "dy": dy, "distance": F.hypot(dx, dy), "bearing": F.pmod(F.degrees(F.atan2(dx, dy)), F.lit(360.0))}


def degrees_from_ddmm(text: Column) -> Column:
    """5522.949219 (degrees and minutes as one number) to degrees; text that is no number gives null."""
    x = text.try_cast("double")
    whole = F.floor(F.abs(x) / 100)
    return F.signum(x) * (whole + (F.abs(x) - whole * 100) / 60)


def degrees_from_dms(text: Column) -> Column:
    """54°43'11.8'' or the like, with an optional sign or hemisphere, to degrees."""
    part = [F.regexp_extract(text, r"(\d+)\D+(\d+)\D+([\d.]+)", i).try_cast("double") for i in (1, 2, 3)]
    return (part[0] + part[1] / 60 + part[2] / 3600) * F.when(text.rlike("^\\s*-|[SWsw]"), -1).otherwise(1)


def signed_by_hemisphere(degrees: Column, hemisphere: Column) -> Column:
    """South and west are negative."""
    return F.when(F.upper(hemisphere).isin("S", "W"), -F.abs(degrees)).otherwise(degrees)


def degree_minute_text(degrees: Column, hemispheres: str) -> Column:
    """Degrees as text such as 54 43.19670N; hemispheres: 'NS' or 'EW'."""
    whole = F.floor(F.abs(degrees))
    side = F.when(degrees < 0, hemispheres[1]).otherwise(hemispheres[0])
    return F.concat(F.format_string("%d %08.5f", whole.cast("int"), (F.abs(degrees) - whole) * 60), side)


def utm_inverse(x: Column, y: Column, zone: int = 34, north: bool = True) -> dict[str, Column]:
    """Lon and lat of UTM coordinates on WGS84, by the Krueger series to the third order in n."""
    a, f, k0 = 6378137.0, 1 / 298.257223563, 0.9996
    n = f / (2 - f)
    radius = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    beta = (n / 2 - 2 / 3 * n**2 + 37 / 96 * n**3, n**2 / 48 + n**3 / 15, 17 / 480 * n**3)
    delta = (2 * n - 2 / 3 * n**2 - 2 * n**3, 7 / 3 * n**2 - 8 / 5 * n**3, 56 / 15 * n**3)
    xi = (y - (0.0 if north else 10_000_000.0)) / (k0 * radius)
    eta = (x - 500_000.0) / (k0 * radius)
    xi1, eta1 = xi, eta
    for j, b in enumerate(beta, 1):
        xi1 = xi1 - F.sin(2 * j * xi) * F.cosh(2 * j * eta) * b
        eta1 = eta1 - F.cos(2 * j * xi) * F.sinh(2 * j * eta) * b
    chi = F.asin(F.sin(xi1) / F.cosh(eta1))
    lat = chi
    for j, d in enumerate(delta, 1):
        lat = lat + F.sin(2 * j * chi) * d
    return {"lat": F.degrees(lat), "lon": F.degrees(F.atan2(F.sinh(eta1), F.cos(xi1))) + (zone * 6 - 183)}


def track_reversed(course: Column, angle: float = 45.0) -> Column:
    """Whether a section is reversed: north-going tracks (within +-angle) are, others if they go west."""
    c = F.pmod(course, F.lit(360.0))
    to_north, to_south = (c < angle) | (c > 360 - angle), F.abs(c - 180) < angle
    return F.when(to_north, True).when(to_south, False).otherwise(c > 180)


def foot_on_line(ax: Column, ay: Column, bx: Column, by: Column, px: Column, py: Column) -> tuple[Column, Column]:
    """Foot of the perpendicular from P on the line AB; A itself where A and B are one point."""
    dx, dy = bx - ax, by - ay
    t = F.coalesce(F.try_divide((px - ax) * dx + (py - ay) * dy, dx * dx + dy * dy), F.lit(0.0))
    return ax + dx * t, ay + dy * t


def grid_bbox(lat: Column, lon: Column, delta: float, extend: int = 0) -> dict[str, Column]:
    """The box of grid cells around a point, wider by `extend` cells; north and west edges first."""
    s, w = F.floor(lat / delta) * delta, F.floor(lon / delta) * delta
    return {"north": s + delta * (1 + extend), "west": w - delta * extend, "south": s - delta * extend, "east": w + delta * (1 + extend)}


RADIANS = math.pi / 180
