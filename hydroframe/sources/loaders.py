"""Loader plug-ins: readers of logger files, found by name (§2.10).

A loader is a function from lines of a file (a pandas Series) to rows (a pandas frame), registered under a name with the
schema it gives.  Its files are read in byte ranges, so one large file is spread over tasks:

    @loader("probe", "Time timestamp, P double")
    def probe(lines): ...

    read(spark, folder, "csv_probe")                                      # or, after register(spark, "probe"):
    spark.read.format("probe").load(folder)

A name is that of a loader, or of a configuration that ends with it (`csv_inclin_iso_time` finds `iso_time`); what
follows a # is not part of it, and of several loaders the longest name counts.  An unknown name fails with the names there are.
A line that a loader can't read gives no row.  Every row has, behind the loader's own columns, the file and the place of its line.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .ranges import _Source, batched, lines_of, register as registered

Load = Callable[[pd.Series], pd.DataFrame]


@dataclass(frozen=True)
class Loader:
    name: str
    schema: str
    load: Load
    encoding: str = "utf-8"


_LOADERS: dict[str, Loader] = {}


def loader(name: str, schema: str, encoding: str = "utf-8") -> Callable[[Load], Load]:
    """Register a function as the loader of a name; its frame's index says which line each row is of."""

    def add(load: Load) -> Load:
        _LOADERS[name] = Loader(name, schema, load, encoding)
        return load

    return add


def names() -> list[str]:
    return sorted(_LOADERS)


def find(name: str) -> Loader:
    """The loader of a name, or of a configuration's name that ends with it."""
    plain = name.partition("#")[0]
    good = [x for x in _LOADERS if plain == x or plain.endswith(f"_{x}")]
    if not good:
        raise ValueError(f"no loader {name!r}; there are: {', '.join(names())}")
    return _LOADERS[max(good, key=len)]


def source(own: Loader) -> type[_Source]:
    """A data source whose format is the loader's name."""

    class Logger(_Source):
        @classmethod
        def name(cls) -> str:
            return own.name

        def schema(self) -> str:
            return f"{own.schema}, file string, place bigint"

        def batches(self, schema: StructType):
            arrow = to_arrow_schema(schema)

            def run(file, path, begin, end, size):
                for rows in batched(lines_of(file, begin, end, size)):
                    lines = pd.Series([r[1].decode(own.encoding, "replace") for r in rows])
                    made = own.load(lines)
                    made = made.assign(file=path, place=pd.Series([r[0] for r in rows]).loc[made.index])
                    yield pa.RecordBatch.from_pandas(made[arrow.names], arrow, preserve_index=False)

            return run

    return Logger


def register(spark: SparkSession, *which: str) -> list[str]:
    """Make loaders (all, if none is named) formats of the session."""
    return [registered(spark, source(find(x))) for x in which or names()]


def read(spark: SparkSession, path: str, name: str, range_bytes: int | None = None) -> DataFrame:
    """The rows that the loader of a name gives for the files of a path."""
    (form,) = register(spark, name)
    reader = spark.read.format(form)
    return (reader.option("rangeBytes", range_bytes) if range_bytes else reader).load(path)


def numbers(lines: pd.Series, sep: str, columns: list[str]) -> pd.DataFrame:
    """Fields of lines that have at least as many as there are columns, as text."""
    parts = lines.str.split(sep, regex=len(sep) > 1)
    parts = parts[parts.str.len() >= len(columns)]
    return pd.DataFrame([p[: len(columns)] for p in parts], index=parts.index, columns=columns)


def _with_time(fields: pd.DataFrame, time: pd.Series, values: list[str]) -> pd.DataFrame:
    """Time in UTC and values as numbers, of the rows whose time can be read."""
    out = fields[values].apply(pd.to_numeric, errors="coerce").astype("float64")
    out.insert(0, "Time", pd.to_datetime(time, errors="coerce", utc=True))
    return out[out["Time"].notna()]


def _from_parts(f: pd.DataFrame, year: pd.Series) -> pd.Series:
    """Time of number columns mo, dd, HH, mi, SS and a year, exact to the microsecond."""
    whole = f[["mo", "dd", "HH", "mi", "SS"]].apply(pd.to_numeric, errors="coerce")
    stamp = pd.to_datetime(pd.DataFrame({"year": year, "month": whole["mo"], "day": whole["dd"], "hour": whole["HH"], "minute": whole["mi"]}), errors="coerce")
    seconds = whole["SS"].where(whole["SS"].between(0, 60, inclusive="left"))
    return stamp + pd.to_timedelta((seconds * 1e6).round(), unit="us")


_FIELDS = ["Ax", "Ay", "Az", "Mx", "My", "Mz", "Battery", "Temp"]


@loader("inclinometer", "Time timestamp, " + ", ".join(f"{c} double" for c in _FIELDS))
def inclinometer(lines: pd.Series) -> pd.DataFrame:
    """`yyyy,m,d,H,M,S,Ax,Ay,Az,Mx,My,Mz,Battery,Temp`; records glued together are read one by one."""
    cut = lines.map(lambda x: re.split(r"(?<=\d\.\d{2})(?=20\d{2},)", x)).explode()
    f = numbers(cut.reset_index(drop=True), ",", ["yyyy", "mo", "dd", "HH", "mi", "SS", *_FIELDS])
    out = _with_time(f, _from_parts(f, pd.to_numeric(f["yyyy"], errors="coerce")), _FIELDS)
    return out.set_axis(cut.index[out.index], axis=0)


@loader("iso_time", "Time timestamp, P double, Temp double")
def iso_time(lines: pd.Series) -> pd.DataFrame:
    """`yy,m,d,H,M,S,ff,P,Temp`: two digits of the year and hundredths of a second apart."""
    f = numbers(lines, ",", ["yy", "mo", "dd", "HH", "mi", "SS", "ff", "P", "Temp"])
    f["SS"] = f["SS"].str.strip() + "." + f["ff"].str.strip().str.zfill(2)
    return _with_time(f, _from_parts(f, 2000 + pd.to_numeric(f["yy"], errors="coerce")), ["P", "Temp"])


@loader("IdrRedas", "Time timestamp, P double, Temp double, Cond double")
def idr_redas(lines: pd.Series) -> pd.DataFrame:
    """`d/m/yyyy HH:MM:SS` (the rest of a longer time field is not reliable), then values, by semicolons."""
    f = numbers(lines, ";", ["time", "P", "Temp", "Cond"])
    return _with_time(f, pd.to_datetime(f["time"].str[:19].str.strip(), format="%d/%m/%Y %H:%M:%S", errors="coerce"), ["P", "Temp", "Cond"])


@loader("pressure_tab", "Time timestamp, P double, Temp double")
def pressure_tab(lines: pd.Series) -> pd.DataFrame:
    """`yyyy-mm-dd HH:MM:SS<tab>P<tab>Temp`, any number of tabs."""
    f = numbers(lines, r"\t+", ["time", "P", "Temp"])
    return _with_time(f, pd.to_datetime(f["time"].str.strip(), format="%Y-%m-%d %H:%M:%S", errors="coerce"), ["P", "Temp"])
