"""Times as Column expressions: device layouts (M14), units (M15) and rollovers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def padded(parts: list[Column], width: tuple[int, ...]) -> list[Column]:
    return [F.lpad(F.trim(p.cast("string")), w, "0") for p, w in zip(parts, width, strict=True)]


def from_fields(y: Column, m: Column, d: Column, hh: Column, mm: Column, ss: Column, fraction: Column | None = None) -> Column:
    """Split fields with or without leading zeros; a year of two digits is of this century."""
    year = F.when(F.length(F.trim(y.cast("string"))) <= 2, F.concat(F.lit("20"), F.lpad(F.trim(y.cast("string")), 2, "0"))).otherwise(F.trim(y.cast("string")))
    m, d, hh, mm, ss = padded([m, d, hh, mm, ss], (2, 2, 2, 2, 2))
    text = F.concat(year, F.lit("-"), m, F.lit("-"), d, F.lit(" "), hh, F.lit(":"), mm, F.lit(":"), ss)
    if fraction is not None:
        text = F.concat(text, F.lit("."), F.rpad(F.trim(fraction.cast("string")), 6, "0"))
        return F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss.SSSSSS"))
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss"))


#: How the date and time columns of each kind of device are written (fixed values): pattern of "date time".
LAYOUTS = {
    "ctd_a": "dd-MM-yyyy HH:mm:ss[.SSSSSS][.SSSSS][.SSSS][.SSS][.SS][.S]",
    "ctd_us": "MM/dd/yyyy HH:mm:ss",
    "ctd_b": "dd.MM.yyyy HH:mm:ss",
    "rock": "yyyy-MM-dd HH:mm:ss",
    "log": "dd.MM.yyyy HH:mm:ss",
    "ctd_c": "M/d/yyyy H:mm:ss",
    "ctd_c_short": "dd.MM.yyyy H:mm",
    "nav_ses": "dd.MM.yyyy HHmmss",
    "nav_ea": "ddMMyyyy HHmmss[.SSS][.SS][.S]",
    "nav_supervisor": "yy MM dd HH mm ss",
    "nav_adcp": "yy,MM,dd,HH,mm,ss,SS",
    "redas": "d/M/yyyy HH:mm:ss",
    "iso": "yyyy-MM-dd'T'HH:mm:ss[.SSS]",
}


def parse_device_time(kind: str, date: Column, time: Column | None = None) -> Column:
    """The time in a device's own layout; text that does not fit gives null."""
    text = date if time is None else F.concat_ws(" ", date, time)
    return F.try_to_timestamp(F.regexp_replace(F.trim(text), '"', ""), F.lit(LAYOUTS[kind]))


def date_from_file_name(name: Column) -> Column:
    """The first yymmdd or yyyymmdd in a file name as yyyy-MM-dd text."""
    eight, six = F.regexp_extract(name, r"(20\d{6})", 1), F.regexp_extract(name, r"(\d{6})", 1)
    digits = F.when(eight != "", eight).when(six != "", F.concat(F.lit("20"), six))
    return F.concat_ws("-", F.substring(digits, 1, 4), F.substring(digits, 5, 2), F.substring(digits, 7, 2))


def fill_bad_times(df: DataFrame, keys: list[str], order: list[str], ts: str) -> DataFrame:
    """A time that could not be read takes the last one before it in its file."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(ts, F.last(ts, ignorenulls=True).over(w))


def from_matlab(day: Column) -> Column:
    """Matlab day numbers to microseconds since 1970."""
    return F.round((day - 719529.0) * 86400.0 * 1e6).cast("long")


def year_fraction(ts: Column) -> Column:
    """Decimal year at the start of the day."""
    days = F.when(((F.year(ts) % 4 == 0) & (F.year(ts) % 100 != 0)) | (F.year(ts) % 400 == 0), 366).otherwise(365)
    return F.year(ts) + (F.dayofyear(ts) - 1) / days


def zone_view(us: Column, hours: float) -> Column:
    """Microseconds as a clock at a fixed offset shows them."""
    return us + F.lit(round(hours * 3600e6))


#: Microseconds of the units a period may name (fixed values).
UNITS = {"us": 1, "L": 1000, "ms": 1000, "s": 10**6, "S": 10**6, "min": 60 * 10**6, "T": 60 * 10**6, "h": 3600 * 10**6, "H": 3600 * 10**6, "D": 86400 * 10**6, "W": 7 * 86400 * 10**6}


def period_us(period: str) -> int:
    """A period such as 5min, 2h or D in microseconds."""
    digits = period.rstrip("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
    return round(float(digits or 1) * UNITS[period[len(digits) :]])


def hour_rollover_days(df: DataFrame, keys: list[str], order: list[str], hour: str) -> DataFrame:
    """`days` after the first row: one more each time the hour decreases."""
    w = Window.partitionBy(*keys).orderBy(*order)
    fell = F.when(F.lag(hour).over(w) > F.col(hour), 1).otherwise(0)
    return df.withColumn("_fell", fell).withColumn("days", F.sum("_fell").over(w)).drop("_fell")
