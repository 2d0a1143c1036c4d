"""Salinity and oxygen as Column expressions (M10-M12, W20 in part), from public polynomials; what follows from them by
TEOS-10 is in `teos`.

Practical salinity is PSS-78, density at the surface EOS-80 (UNESCO 44).  Absolute salinity
is the constant ratio 35.16504 / 35 times practical salinity, in the Baltic (9 to 30 E, 53 to 66 N) plus the Baltic formula
0.087 (1 - S / 35); an atlas of anomalies is not built in, which leaves up to 0.025 g/kg in the open ocean.  A user's own
anomaly ratio can be given as a column.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .vectors import horner

# Fixed values of PSS-78.
_A = (0.0080, -0.1692, 25.3851, 14.0941, -7.0261, 2.7081)
_B = (0.0005, -0.0056, -0.0066, -0.0375, 0.0636, -0.0144)
_C = (0.6766097, 2.00564e-2, 1.104259e-4, -6.9698e-7, 1.0031e-9)
_D = (3.426e-2, 4.464e-4, 4.215e-1, -3.107e-3)
_E = (2.070e-5, -6.370e-10, 3.989e-15)
# Fixed values of EOS-80: density of pure water, and of seawater at one atmosphere.
_PURE = (999.842594, 6.793952e-2, -9.095290e-3, 1.001685e-4, -1.120083e-6, 6.536332e-9)
_SALT = (0.824493, -4.0899e-3, 7.6438e-5, -8.2467e-7, 5.3875e-9)
_SALT15 = (-5.72466e-3, 1.0227e-4, -1.6546e-6)
_SALT2 = 4.8314e-4
# Fixed values of the oxygen solubility of Garcia and Gordon (1992), micromoles per kilogram.
_OX_A = (5.80871, 3.20291, 4.17887, 5.10006, -9.86643e-2, 3.80369)
_OX_B = (-7.01577e-3, -7.70028e-3, -1.13864e-2, -9.51519e-3)
_OX_C0 = -2.75915e-7


def _poly(x: Column, coefs: tuple[float, ...]) -> Column:
    """A polynomial with the lowest power first."""
    out = F.lit(coefs[-1])
    for c in reversed(coefs[:-1]):
        out = out * x + c
    return out


def t90_from_t68(t68: Column) -> Column:
    return t68 / 1.00024


def practical_salinity(conductivity: Column, t90: Column, p: Column) -> Column:
    """PSS-78 from conductivity in mS/cm; null where conductivity is not positive."""
    t = t90 * 1.00024
    ratio = conductivity / 42.9140
    rp = 1 + p * (_E[0] + p * (_E[1] + p * _E[2])) / (1 + _D[0] * t + _D[1] * t * t + (_D[2] + _D[3] * t) * ratio)
    x = F.sqrt(F.when(ratio > 0, ratio / (rp * _poly(t, _C))))
    return _poly(x, _A) + (t - 15) / (1 + 0.0162 * (t - 15)) * _poly(x, _B)


def absolute_salinity(sp: Column, lon: Column, lat: Column, anomaly_ratio: Column | None = None) -> Column:
    plain = sp * (35.16504 / 35)
    baltic = lon.between(9, 30) & lat.between(53, 66)
    open_sea = plain if anomaly_ratio is None else plain * (1 + F.coalesce(anomaly_ratio, F.lit(0.0)))
    return F.when(baltic, plain + 0.087 * (1 - sp / 35)).otherwise(open_sea)


def density_at_surface(s: Column, t: Column) -> Column:
    """kg/m3 at one atmosphere."""
    return _poly(t, _PURE) + s * (_poly(t, _SALT) + F.sqrt(F.greatest(s, F.lit(0.0))) * _poly(t, _SALT15) + s * _SALT2)


def oxygen_solubility(t: Column, s: Column) -> Column:
    """Micromoles per kilogram."""
    ts = F.log((298.15 - t) / (273.15 + t))
    return F.exp(_poly(ts, _OX_A) + s * _poly(ts, _OX_B) + _OX_C0 * s * s)


def oxygen_from_voltage(v: Column, dv_dt: Column, t: Column, s: Column, p: Column, coefs: dict[str, float]) -> Column:
    """Concentration by a polarographic sensor's voltage; coefs: Soc, Voffset, tau20, A, B, C, E, D1, D2."""
    tau = coefs["tau20"] * F.exp(coefs["D1"] * p + coefs["D2"] * (t - 20))
    temp = 1 + t * (coefs["A"] + t * (coefs["B"] + t * coefs["C"]))
    return coefs["Soc"] * (v + coefs["Voffset"] + tau * dv_dt) * temp * oxygen_solubility(t, s) * F.exp(coefs["E"] * p / (t + 273.15))


def percent_saturation(oxygen: Column, t: Column, s: Column) -> Column:
    return 100 * oxygen / oxygen_solubility(t, s)


def probe_value(code: Column, coefs: Column) -> Column:
    """A probe's code to its value by a polynomial, the highest power first."""
    return horner(code, coefs)
