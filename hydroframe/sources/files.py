"""Readers (S01-S16, S27-S31): logger text, GPX, NMEA, framed binary, tracker messages; all lazy, all by Spark's readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, IntegerType, LongType, ShortType, StringType, StructField, StructType

from ..operators.sequence import carry, joined, numbered, ranked
from . import ranges

#: What a suffix in a header names (fixed values).
SUFFIXES = {"text": StringType(), "time": StringType(), "float": DoubleType()}
NUMPY_TYPES = {"i1": ShortType(), "i2": ShortType(), "i4": IntegerType(), "i8": LongType(), "f4": FloatType(), "f8": DoubleType()}


def header_schema(header: str, types: dict[str, str] | None = None) -> tuple[StructType, list[str], list[str]]:
    """A header such as `yyyy(text),mm(text),,Ax,Ay,T01+` to the schema, the columns used, and those repeated.

    Names are split by commas or spaces; an empty name is a column that is skipped; a trailing + repeats the column as
    often as the line has fields.  types: names with numpy codes.
    """
    parts = [p.strip() for p in (header.split(",") if "," in header else header.split())]
    fields, used, repeated = [], [], []
    for i, part in enumerate(parts):
        plus = part.endswith("+")
        name, _, suffix = part.rstrip("+").partition("(")
        kind = SUFFIXES.get(suffix.rstrip(")"), NUMPY_TYPES.get((types or {}).get(name, "f8"), DoubleType()))
        fields.append(StructField(name or f"_skip{i}", kind))
        used += [name] if name else []
        repeated += [name] if plus else []
    return StructType(fields), used, repeated


def read_delimited(spark: SparkSession, paths: str | list[str], header: str, time: Column, types: dict[str, str] | None = None, sep: str = ",", skip_lines: int = 0, limits: tuple[str, str] | None = None) -> DataFrame:
    """Delimited text with the file it came from; `Time` by the device's rule; bad lines and times out of limits are dropped."""
    schema, used, _ = header_schema(header, types)
    text = StructType([*(StructField(f.name, StringType()) for f in schema), StructField("_bad", StringType())])
    df = spark.read.schema(text).option("sep", sep).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").csv(paths)
    typed = [F.trim(f.name).try_cast(f.dataType).alias(f.name) for f in schema if f.name in used]
    df = df.select(*typed, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("file_changed"))
    df = df.withColumn("Time", time).where(F.col("Time").isNotNull())
    return df.where(F.col("Time").between(*[F.lit(x).cast("timestamp") for x in limits])) if limits else df


def expand_repeated_columns(lines: DataFrame, line: str, sep: str, fixed: list[str], repeated: str) -> DataFrame:
    """The first fields by name and all others as one array column."""
    parts = F.split(F.col(line), sep)
    rest = F.slice(parts, F.lit(len(fixed) + 1), F.greatest(F.size(parts) - len(fixed), F.lit(0)))
    return lines.withColumns({n: parts[i] for i, n in enumerate(fixed)} | {repeated: F.transform(rest, lambda x: x.try_cast("double"))})


def repair_lines(lines: DataFrame, line: str, replace: list[tuple[str, str]], drop: str | None = None, least: int = 0) -> tuple[DataFrame, DataFrame]:
    """Lines after regex replacements, and apart from them the lines that match `drop`, are too short or null."""
    c = F.col(line)
    for pattern, new in replace:
        c = F.regexp_replace(c, pattern, new)
    bad = F.length(line) < least
    if drop:
        bad = bad | F.col(line).rlike(drop)
    mended = lines.withColumn("_bad", F.coalesce(bad, F.lit(True))).withColumn(line, c)
    return mended.where(~F.col("_bad")).drop("_bad"), mended.where("_bad").drop("_bad")


#: (pattern, replacement) rules of three loggers, lines to drop, least length (fixed values).
LINE_RULES = {
    "inclinometer_text": ([(r"(?<=\d\.\d{2})(?=20\d{2},)", "\n"), (r"\s+$", "")], r"^\D|^.{0,9}$", 20),
    "inclinometer_pressure": ([(r"\t+", "\t"), (r"\s+$", "")], r"^\D", 30),
    "ctd_terminal": ([(r"[^\x20-\x7E]", ""), (r" {2,}", " ")], r"^\s*$", 10),
}


def device_line_rules(lines: DataFrame, line: str, device: str) -> tuple[DataFrame, DataFrame]:
    """S04 with the rules of a logger; a line that holds two records glued together becomes two."""
    replace, drop, least = LINE_RULES[device]
    c = F.col(line)
    for pattern, new in replace:
        c = F.regexp_replace(c, pattern, new)
    cut = lines.withColumn(line, F.explode(F.split(c, "\n")))
    return repair_lines(cut, line, [], drop, least)


def read_zip_members(spark: SparkSession, paths: str, pattern: str = r"\.csv$", range_bytes: int = ranges.RANGE_BYTES) -> DataFrame:
    """Archive, member and line (with its number) of the text members of zip archives, streamed.

    Members are dealt to tasks by the byte range of the archive that they begin in.
    """
    name = ranges.register(spark, ranges.Members)
    return spark.read.format(name).options(pattern=pattern, rangeBytes=range_bytes).load(paths)


_POINT = "_lat double, _lon double, ele double, time string, name string, sym string, cmt string"


def read_gpx(spark: SparkSession, paths: str) -> dict[str, DataFrame]:
    """Waypoints, tracks (points by segment), segments (their first points) and routes of GPX files."""
    def xml(tag: str, schema: str) -> DataFrame:
        return spark.read.format("xml").option("rowTag", tag).schema(schema).load(paths).withColumn("file", F.input_file_name())

    def point(p: str) -> list[Column]:
        return [F.try_to_timestamp(F.col(f"{p}time")).alias("Time"), F.col(f"{p}_lat").alias("Lat"), F.col(f"{p}_lon").alias("Lon"), F.col(f"{p}ele").alias("ele"), F.col(f"{p}name").alias("name"), F.col(f"{p}sym").alias("sym")]

    waypoints = xml("wpt", _POINT).select("file", *point(""))
    track = xml("trk", f"name string, trkseg array<struct<trkpt: array<struct<{_POINT.replace(' ', ': ').replace(',:', ',')}>>>>")
    flat = track.select("file", F.col("name").alias("track"), F.posexplode("trkseg").alias("segment", "s")).select("file", "track", "segment", F.posexplode("s.trkpt").alias("point_no", "p"))
    tracks = flat.select("file", "track", "segment", "point_no", *point("p."))
    route = xml("rte", f"name string, rtept array<struct<{_POINT.replace(' ', ': ').replace(',:', ',')}>>")
    routes = route.select("file", F.col("name").alias("route"), F.posexplode("rtept").alias("point_no", "p")).select("file", "route", "point_no", *point("p."))
    return {"waypoints": waypoints, "tracks": tracks, "segments": tracks.where("point_no = 0"), "routes": routes}


def _nmea_degrees(text: Column, side: Column) -> Column:
    x = text.try_cast("double")
    whole = F.floor(x / 100)
    return (whole + (x - whole * 100) / 60) * F.when(side.isin("S", "W"), -1).otherwise(1)


def read_nmea(spark: SparkSession, paths: str, step_after: int = 15, round_seconds: bool = False) -> DataFrame:
    """One row per file and time of NMEA sentences; a sentence without a time belongs to the time before it.

    After more than `step_after` sentences without a time a row begins one second later.  A bad or missing date counts as the
    date before it in the file.  Parts of seconds are cut off, or rounded.

    Spark splits files as it does for any text.  A split passes on its last date, its last time and its number of sentences,
    so one long file is spread over tasks.
    """
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("n"), F.col("value").alias("line"))
    part = F.split(F.regexp_replace("line", r"\*.*$", ""), ",")
    kind = F.substring(part[0], 4, 3)
    get = lambda i: F.get(part, F.lit(i))
    rmc, gga, dbt = kind == "RMC", kind == "GGA", kind == "DBT"
    lines = lines.where(F.col("line").startswith("$"))
    dated = carry(lines, ["file"], "split", ["n"], {"date": F.when(rmc & F.try_to_timestamp(get(9), F.lit("ddMMyy")).isNotNull(), get(9))}, bucket_us=1)
    stamp = F.try_to_timestamp(F.concat_ws(" ", "date", F.substring(get(1), 1, 6)), F.lit("ddMMyy HHmmss"))
    if round_seconds:
        stamp = stamp + F.make_dt_interval(secs=F.round(F.coalesce(F.concat(F.lit("0"), F.substring(get(1), 7, 9)).try_cast("double"), F.lit(0.0))))
    rows = dated.select(
        "file", "split", "n", F.when(rmc | gga, stamp).alias("t"),
        F.when(rmc, _nmea_degrees(get(3), get(4))).when(gga, _nmea_degrees(get(2), get(3))).alias("Lat"), F.when(rmc, _nmea_degrees(get(5), get(6))).when(gga, _nmea_degrees(get(4), get(5))).alias("Lon"),
        F.when(rmc, get(7).try_cast("double")).alias("Speed"), F.when(rmc, get(8).try_cast("double")).alias("Course"), F.when(dbt, get(3).try_cast("double")).alias("DepEcho"),
    )
    rows = numbered(rows, ["file"], "split", ["n"], 1)
    held = carry(rows, ["file"], "split", ["n"], {"_t": F.col("t"), "_at": F.when(F.col("t").isNotNull(), F.col("_i"))}, bucket_us=1)
    time = F.col("_t") + F.make_dt_interval(secs=F.floor((F.col("_i") - F.col("_at")) / (step_after + 1)))
    place = F.struct("split", "n")
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), place)).alias(c) for c in ("Lat", "Lon", "Speed", "Course", "DepEcho")]
    return held.where("_t is not null").groupBy("file", time.alias("Time")).agg(*last)


def read_framed_binary(spark: SparkSession, paths: str, sync: bytes, columns: list[str], dtype: str = "<i2", seven_bit: bool = False, range_bytes: int = ranges.RANGE_BYTES) -> DataFrame:
    """File, frame number and numbers of framed binary files, read in byte ranges that find the frames as the whole file does."""
    name = ranges.register(spark, ranges.Frames)
    options = {"sync": sync.hex(), "columns": ",".join(columns), "dtype": dtype, "sevenBit": str(seven_bit).lower(), "rangeBytes": range_bytes}
    frames = spark.read.format(name).options(**options).load(paths)
    return numbered(frames, ["file"], "range", ["place"], 1).select("file", F.col("_i").alias("frame"), *columns)


def read_tracker_messages(messages: DataFrame, column: str, groups: dict[int, dict[str, str]]) -> DataFrame:
    """Rows by device time from messages [{i: id, p: [{r, s, p: [...]}]}]: groups gives names and types by id; ids are joined."""
    schema = "array<struct<i: bigint, p: array<struct<r: bigint, s: bigint, p: array<string>>>>>"
    flat = messages.select(F.explode(F.from_json(column, schema)).alias("m")).select("m.i", F.explode("m.p").alias("r"))
    out = None
    for number, fields in groups.items():
        values = [F.regexp_replace(F.col("r.p")[k], ",", ".").try_cast(kind).alias(name) for k, (name, kind) in enumerate(fields.items())]
        part = flat.where(F.col("i") == number).select(F.col("r.r").alias("time_s"), *values)
        out = part if out is None else out.join(part, "time_s")
    return out


#: Layouts of position texts (fixed values): named groups in order lat, lon, speed, course, time.
POSITION_TEXTS = (
    r"lat:(-?[\d.]+) long:(-?[\d.]+) speed:([\d.]+) dir:([\d.]+)\s+T:(\d\d/\d\d/\d\d \d\d:\d\d)",
    r"Lat=(-?[\d.]+),Lon=(-?[\d.]+),V=([\d.]+),C=([\d.]+),(\d\d/\d\d/\d\d \d\d:\d\d)",
)


def parse_position_texts(texts: DataFrame, column: str) -> DataFrame:
    """Lat, lon, speed, course and Time of a position message in either layout; others give nulls."""
    def field(i: int) -> Column:
        found = [F.regexp_extract(column, p, i) for p in POSITION_TEXTS]
        return F.coalesce(*[F.nullif(x, F.lit("")) for x in found])

    values = {n: field(i).try_cast("double") for i, n in enumerate(("lat", "lon", "speed", "course"), 1)}
    return texts.withColumns(values | {"Time": F.try_to_timestamp(field(5), F.lit("yy/MM/dd HH:mm"))})


def parse_key_values(texts: DataFrame, column: str, keys: list[str]) -> DataFrame:
    """Values of `key: value` lines of a mail body."""
    return texts.withColumns({k: F.nullif(F.regexp_extract(column, rf"(?m)^\s*{k}\s*:\s*(.*?)\s*$", 1), F.lit("")) for k in keys})


def cube_to_long(cube: DataFrame, axes: list[str], values: list[str]) -> DataFrame:
    """Arrays over (time, lat, lon) axes (array columns) flattened to rows; values are nested arrays."""
    t, y, x = axes
    out = cube.withColumn("_c", F.arrays_zip(*[F.col(c) for c in [t, *values]])).select("*", F.explode("_c").alias("_a"))
    out = out.select(F.col(f"_a.{t}").alias(t), F.col(y).alias("_y"), F.col(x).alias("_x"), *[F.col(f"_a.{v}").alias(v) for v in values])
    out = out.select(t, "_x", *values, F.posexplode("_y").alias("_j", y)).select(t, y, "_x", *[F.col(v)[F.col("_j")].alias(v) for v in values])
    return out.select(t, y, *values, F.posexplode("_x").alias("_i", x)).select(t, y, x, *[F.col(v)[F.col("_i")].alias(v) for v in values])


def stack_profiles(profiles: DataFrame, file: str, x_min: float, x_step: float) -> DataFrame:
    """The k-th file by name stands at x_min + k * x_step."""
    placed = ranked(profiles.select(file).distinct(), file).withColumn("x", x_min + F.col("_i") * x_step).drop("_i")
    return profiles.join(placed, file)


def align_cell_blocks(rows: DataFrame, groups: list[str], cells: int, missing: int = -32768) -> DataFrame:
    """Array groups padded to `cells` with the missing value; rows whose first group is all missing are dropped."""
    good = rows.where(F.exists(groups[0], lambda v: v != missing))
    return good.withColumns({g: F.slice(F.concat(g, F.array_repeat(F.lit(missing).cast("double"), cells)), 1, cells) for g in groups})


def cells_to_long(rows: DataFrame, speed: str, direction: str, z1: Column, dz: Column, bad: float = -32767) -> DataFrame:
    """One row per cell with Depth = z1 + dz * cell (from 0); speeds at or below `bad` are dropped."""
    keep = [c for c in rows.columns if c not in (speed, direction)]
    flat = rows.select(*keep, z1.alias("_z1"), dz.alias("_dz"), F.posexplode(F.arrays_zip(F.col(speed).alias("v"), F.col(direction).alias("d"))).alias("cell", "_c"))
    out = flat.select(*keep, "cell", F.col("_c.v").alias("Vabs"), F.col("_c.d").alias("Vdir"), (F.col("_z1") + F.col("_dz") * F.col("cell")).alias("Depth"))
    return out.where(F.col("Vabs") > bad)


#: Whole numbers, and how every text begins that Spark reads as a double; others are not tried, as each would cost an exception.
_WHOLE, _REAL = r"^[\x00-\x20\x7f]*[-+]?[0-9]+[\x00-\x20\x7f]*$", r"^[\x00-\x20\x7f]*[-+]?([.0-9]|(?i:inf|nan))"


def infer_column_types(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per text column the narrowest type that holds all values, its widest text, nulls and distinct values, in one pass."""
    aggs = []
    for c in columns:
        v = F.nullif(F.trim(c), F.lit(""))
        whole, real = F.when(v.rlike(_WHOLE), v.try_cast("bigint")), F.when(v.rlike(_REAL), v.try_cast("double"))
        aggs.append(F.struct(F.lit(c).alias("name"), F.max(F.length(v)).alias("width"), F.count_if(v.isNull()).alias("nulls"), F.count(v).alias("n"), F.count(whole).alias("ints"), F.count(real).alias("reals"), F.min(whole).alias("low"), F.max(whole).alias("high"), F.approx_count_distinct(v).alias("distinct")).alias(c))
    flat = df.agg(*aggs).select(F.explode(F.array(*columns)).alias("c")).select("c.*")
    integer = F.when(F.col("low").between(-128, 127) & F.col("high").between(-128, 127), "tinyint").when(F.col("low").between(-32768, 32767) & F.col("high").between(-32768, 32767), "smallint").when(F.col("low").between(-(2**31), 2**31 - 1) & F.col("high").between(-(2**31), 2**31 - 1), "int").otherwise("bigint")
    kind = F.when((F.col("n") > 0) & (F.col("ints") == F.col("n")), integer).when((F.col("n") > 0) & (F.col("reals") == F.col("n")), "double").otherwise("string")
    return flat.select("name", kind.alias("type"), "width", "nulls", "distinct")


#: Ranges of the integer types (fixed values); a value must lie strictly inside, so -1 can mark bad ones.
INTEGER_RANGES = {"tinyint": 2**7, "smallint": 2**15, "int": 2**31, "bigint": 2**63}


def coerce_to_type(df: DataFrame, column: str, kind: str) -> DataFrame:
    """A text column as a number; what does not parse or fit becomes -1 (integers) or null (floats)."""
    if kind not in INTEGER_RANGES:
        return df.withColumn(column, F.col(column).try_cast(kind))
    most, x = INTEGER_RANGES[kind], F.col(column).try_cast("decimal(38,0)")
    inside = (x > F.lit(-most).cast("decimal(38,0)")) & (x < F.lit(most - 1).cast("decimal(38,0)"))
    return df.withColumn(column, F.coalesce(F.when(inside, x), F.lit(-1)).cast(kind))


def find_tables(df: DataFrame, device: str, pattern: str) -> DataFrame:
    """Rows of the devices whose name matches a pattern."""
    return df.where(F.col(device).rlike(pattern))


def list_source_files(spark: SparkSession, folder: str, glob: str, bad: str | None = None, between: tuple[str, str] | None = None) -> DataFrame:
    """Path, name, change time and length of files by mask, without those marked bad, within a range of names."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(folder).select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "modificationTime", "length")
    files = files.where(~F.col("name").rlike(bad)) if bad else files
    return files.where(F.col("name").between(*between)) if between else files


def coefficients_for(rows: DataFrame, coefs: DataFrame, keys: list[str], us: str, columns: list[str]) -> DataFrame:
    """The coefficients in force at each row: the last of its device valid from a time at or before it."""
    from ..operators.joins import neighbours

    found = neighbours(rows, coefs, keys, us, columns)
    return found.select(*rows.columns, *[F.col(f"prev.{c}").alias(c) for c in columns])




def matrix_product(a: Column, b: Column) -> Column:
    """The product of two matrices (arrays of rows)."""
    columns = F.sequence(F.lit(0), F.size(b[0]) - 1)
    dot = lambda row, k: F.aggregate(F.zip_with(row, b, lambda x, other: x * F.get(other, k)), F.lit(0.0), lambda s, x: s + x)
    return F.transform(a, lambda row: F.transform(columns, lambda k: dot(row, k)))


def rotation(axis: str, angle: Column) -> Column:
    """The matrix that turns vectors about the axis x, y or z by an angle in radians."""
    c, s, one, none = F.cos(angle), F.sin(angle), F.lit(1.0), F.lit(0.0)
    rows = {"x": ((one, none, none), (none, c, -s), (none, s, c)), "y": ((c, none, s), (none, one, none), (-s, none, c)), "z": ((c, -s, none), (s, c, none), (none, none, one))}
    return F.array(*[F.array(*r) for r in rows[axis]])


def _finite(column: Column, levels: int) -> Column:
    if not levels:
        return column.isNotNull() & ~F.isnan(column) & (F.abs(column) != float("inf"))
    return column.isNotNull() & F.forall(column, lambda x: _finite(x, levels - 1))


def save_coefficients(coefs: DataFrame, fresh: DataFrame, keys: list[str], us: str, columns: dict[str, int]) -> tuple[DataFrame, DataFrame]:
    """The table with fresh rows, each in place of one of the same device and time, and apart the rows that are refused.

    columns: names with their levels of arrays (0 a number, 1 a vector, 2 a matrix).  A row with a null or non-finite value in one
    of them is refused; of several fresh rows of a device and time the greatest stays.
    """
    good = F.lit(True)
    for name, levels in columns.items():
        good = good & _finite(F.col(name), levels)
    marked = fresh.withColumn("_good", F.coalesce(good, F.lit(False)))
    values = [c for c in coefs.columns if c not in (*keys, us)]
    kept = marked.where("_good").groupBy(*keys, us).agg(F.max(F.struct(*values)).alias("_v")).select(*keys, us, "_v.*").select(*coefs.columns)
    old = joined(coefs, kept.select(*keys, us), [*keys, us], "left_anti")
    return old.unionByName(kept), marked.where("not _good").drop("_good")


def copy_coefficients(coefs: DataFrame, pairs: DataFrame, device: str, us: str) -> DataFrame:
    """Rows for other devices: pairs has source, target and the time `us` from which the last of the source's at it holds."""
    asked = pairs.select(F.col("source").alias(device), "target", us)
    values = [c for c in coefs.columns if c not in (device, us)]
    return coefficients_for(asked, coefs, [device], us, values).select(F.col("target").alias(device), us, *values)


def rotate_coefficients(coefs: DataFrame, columns: list[str], axis: str, angle: Column) -> DataFrame:
    """Matrices turned about an axis by an angle in radians: the rotation times the matrix."""
    return coefs.withColumns({c: matrix_product(rotation(axis, angle), F.col(c)) for c in columns})
