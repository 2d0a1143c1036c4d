"""Joins by time and place."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sequence import BUCKET_US, carry, settled


def neighbours(points: DataFrame, series: DataFrame, keys: list[str], us: str, columns: list[str], bucket_us: int = BUCKET_US) -> DataFrame:
    """Points with prev (at or before) and next (at or after): structs of us and columns of the series, by key."""
    own = points.columns
    packed = F.struct(F.col(us).alias("us"), *columns)
    left = points.select(F.struct(*own).alias("_point"), *keys, F.col(us).alias("_us"), F.lit(None).cast(series.select(packed.alias("x")).schema["x"].dataType).alias("_row"), F.lit(1).alias("_side"))
    right = series.where(F.col(us).isNotNull()).select(F.lit(None).cast(left.schema["_point"].dataType).alias("_point"), *keys, F.col(us).alias("_us"), packed.alias("_row"), F.lit(0).alias("_side"))
    both = right.unionByName(left)
    # Rows of the series sort before points of the same time going forward, and after them going backward.
    rank = F.struct("_side", F.col("_row.us"), *[F.col(f"_row.{c}") for c in columns])
    both = both.withColumns({"_rank": rank, "_back": F.struct((-F.col("_side")).alias("s"), *[F.col(f"_row.{c}") for c in columns])})
    found = carry(both, keys, "_us", ["_rank"], {"prev": F.col("_row")}, bucket_us=bucket_us)
    found = carry(found, keys, "_us", ["_back"], {"next": F.col("_row")}, backward=True, bucket_us=bucket_us)
    return found.where("_side = 1").select("_point.*", "prev", "next")


def _nearest(us: str) -> Column:
    """The nearer of prev and next; on equal distance the later."""
    before, after = F.col(us) - F.col("prev.us"), F.col("next.us") - F.col(us)
    return F.when(F.col("prev").isNull(), F.col("next")).when(F.col("next").isNull() | (before < after), F.col("prev")).otherwise(F.col("next"))


def nearest_join(points: DataFrame, series: DataFrame, keys: list[str], us: str, columns: list[str], tolerance_us: int | None = None, prefix: str = "near_") -> DataFrame:
    """Each point with the row of the series nearest in time, the later one if two are equally near."""
    found = neighbours(points, series, keys, us, columns).withColumn("_near", _nearest(us))
    if tolerance_us is not None:
        found = found.withColumn("_near", F.when(F.abs(F.col("_near.us") - F.col(us)) <= tolerance_us, F.col("_near")))
    return found.select(*points.columns, F.col("_near.us").alias(f"{prefix}us"), *[F.col(f"_near.{c}").alias(f"{prefix}{c}") for c in columns])


def _between(us: str, column: str) -> Column:
    t0, t1, y0, y1 = F.col("prev.us"), F.col("next.us"), F.col(f"prev.{column}"), F.col(f"next.{column}")
    return F.when(t1 == t0, y0).when(t1 > t0, y0 + (y1 - y0) * (F.col(us) - t0) / (t1 - t0))


def interpolate_join(points: DataFrame, series: DataFrame, keys: list[str], us: str, columns: list[str], prefix: str = "int_") -> DataFrame:
    """Values of the series at each point, linear in time; null outside the series."""
    found = neighbours(points, series, keys, us, columns)
    return found.select(*points.columns, *[_between(us, c).alias(f"{prefix}{c}") for c in columns])


def nearest_or_interpolate_join(points: DataFrame, series: DataFrame, keys: list[str], us: str, columns: list[str], tolerance_us: int) -> DataFrame:
    """Nearest values if all points of a key are within the tolerance, else interpolated ones for all of them."""
    found = neighbours(points, series, keys, us, columns).withColumn("_near", _nearest(us))
    far = F.max(F.abs(F.col("_near.us") - F.col(us))).alias("_far")
    worst = found.groupBy(*keys).agg(far) if keys else found.agg(far)
    found = found.join(worst, keys) if keys else found.crossJoin(F.broadcast(worst))
    out = {c: F.when(F.col("_far") <= tolerance_us, F.col(f"_near.{c}")).otherwise(_between(us, c)) for c in columns}
    return found.select(*points.columns, (F.col("_far") > tolerance_us).alias("interpolated"), *[v.alias(f"at_{c}") for c, v in out.items()])


def bucketed_intervals(rows: DataFrame, us: str, intervals: DataFrame, begin: str, end: str, keys: list[str], how: str = "inner", strict: bool = False, bucket_us: int = BUCKET_US) -> DataFrame:
    """Rows joined to the intervals they lie in, by an equality of time buckets; both ends are inside, or neither.

    An interval is copied into each bucket it touches.
    """
    over = intervals.where(F.col(begin) <= F.col(end)).withColumns({f"_k_{k}": F.col(k) for k in keys}).drop(*keys)
    over = over.withColumn("_ib", F.explode(F.sequence(F.floor(F.col(begin) / bucket_us), F.floor(F.col(end) / bucket_us))))
    inside = (F.col(us) > F.col(begin)) & (F.col(us) < F.col(end)) if strict else (F.col(us) >= F.col(begin)) & (F.col(us) <= F.col(end))
    on = (F.floor(F.col(us) / bucket_us) == F.col("_ib")) & inside
    for k in keys:
        on = on & (F.col(k) == F.col(f"_k_{k}"))
    return rows.join(over, on, how).drop("_ib", *[f"_k_{k}" for k in keys])


def runs_for_points(points: DataFrame, runs: DataFrame, us: str, begin: str, dt_us: int | None = None) -> DataFrame:
    """Runs whose start is nearest to a point, or lies in [t, t + dt); each run once."""
    if dt_us is None:
        near = nearest_join(points.select(us).distinct(), runs.withColumn(us, F.col(begin)), [], us, ["run"])
        chosen = near.select(F.col("near_run").alias("run"))
    else:
        # Of the points at or before a start the last tells: if it is too early, so are all.
        last = known_values(runs.select("run", F.col(begin).alias(us)), points.select(us).distinct(), [], us, {"_last": F.col(us)})
        chosen = last.where(F.col("_last") > F.col(us) - dt_us).select("run")
    return runs.join(chosen.where("run is not null").distinct(), "run", "left_semi")


def asof_last_good(points: DataFrame, series: DataFrame, keys: list[str], us: str, good: str, columns: list[str]) -> DataFrame:
    """Columns of the last row at or before each point in which `good` is not null."""
    found = neighbours(points, series.where(F.col(good).isNotNull()), keys, us, columns)
    return found.select(*points.columns, *[F.col(f"prev.{c}").alias(f"last_{c}") for c in columns])


def known_values(points: DataFrame, series: DataFrame, keys: list[str], us: str, values: dict[str, Column], backward: bool = False, bucket_us: int = BUCKET_US) -> DataFrame:
    """Points with, for each value of the series, the last that is not null at or before them (backward: the next at or after)."""
    packed = F.struct(*[v.alias(n) for n, v in values.items()])
    left = points.select(F.struct(*points.columns).alias("_point"), *keys, F.col(us).alias("_us"), F.lit(None).cast(series.select(packed.alias("x")).schema["x"].dataType).alias("_row"), F.lit(1).alias("_side"))
    right = series.where(F.col(us).isNotNull()).select(F.lit(None).cast(left.schema["_point"].dataType).alias("_point"), *keys, F.col(us).alias("_us"), packed.alias("_row"), F.lit(0).alias("_side"))
    both = right.unionByName(left).withColumn("_rank", F.struct((-F.col("_side") if backward else F.col("_side")).alias("s"), "_row"))
    found = carry(both, keys, "_us", ["_rank"], {n: F.col(f"_row.{n}") for n in values}, backward=backward, bucket_us=bucket_us)
    return found.where("_side = 1").select("_point.*", *values)


def values_at_edges(runs: DataFrame, series: DataFrame, keys: list[str], us: str, begin: str, end: str, good: list[str], columns: list[str]) -> DataFrame:
    """<column>_st and <column>_en of each run: of the last row at or before its edge in which all of `good` are known.

    A column that is null in that row gets its first known value inside the run for the start, and its last one at or before
    the end for the end.
    """
    whole = F.when(F.concat(*[F.array(F.col(c).isNotNull()) for c in good]) == F.array(*[F.lit(True)] * len(good)), F.struct(*columns))
    one = {f"_v_{c}": F.when(F.col(c).isNotNull(), F.struct(F.col(us).alias("us"), F.col(c).alias("v"))) for c in columns}
    first = known_values(runs.withColumn(us, F.col(begin)), series, keys, us, {"_row_st": whole})
    first = known_values(first, series, keys, us, one, backward=True)
    start = {f"{c}_st": F.coalesce(F.col(f"_row_st.{c}"), F.when(F.col(f"_v_{c}.us") <= F.col(end), F.col(f"_v_{c}.v"))) for c in columns}
    first = first.withColumns(start).select(*runs.columns, *start)
    last = known_values(first.withColumn(us, F.col(end)), series, keys, us, {"_row_en": whole, **one})
    stop = {f"{c}_en": F.coalesce(F.col(f"_row_en.{c}"), F.col(f"_v_{c}.v")) for c in columns}
    return last.withColumns(stop).select(*runs.columns, *start, *stop)


def fill_from_other_tables(points: DataFrame, tables: list[DataFrame], us: str, columns: list[str], tolerance_us: int, keys: list[str] | None = None, retry: bool = False) -> DataFrame:
    """Missing values of points are filled from the nearest row of each table in turn, within the tolerance.

    retry: what is still missing in a column is then taken from the nearest row of that table with a positive value in it.
    """
    out = points
    for other in tables:
        near = nearest_join(out, other, keys or [], us, columns, tolerance_us, prefix="_f_")
        out = near.withColumns({c: F.coalesce(c, f"_f_{c}") for c in columns}).select(*points.columns)
        for c in columns if retry else []:
            near = nearest_join(out, other.where(F.col(c) > 0), keys or [], us, [c], tolerance_us, prefix="_f_")
            out = near.withColumn(c, F.coalesce(c, f"_f_{c}")).select(*points.columns)
    return out


def coordinates_or_log(rows: DataFrame, track: DataFrame, us: str, columns: list[str], logged: dict[str, Column], keys: list[str] | None = None) -> DataFrame:
    """A null coordinate becomes its interpolation in time, else the value of the log row."""
    at = interpolate_join(rows, track, keys or [], us, columns)
    return at.withColumns({c: F.coalesce(F.col(c), F.col(f"int_{c}"), logged[c]) for c in columns}).select(*rows.columns)


def wide_by_device(bins: DataFrame, ts: str, device: str, devices: list, columns: list[str]) -> DataFrame:
    """One row per time with the columns of each device, named <column>_<device>."""
    wide = [F.max(F.when(F.col(device) == d, F.col(c))).alias(f"{c}_{d}") for d in devices for c in columns]
    return bins.where(F.col(device).isin(devices)).groupBy(ts).agg(*wide)


def device_pairs(series: DataFrame, ts: str, device: str, columns: list[str]) -> DataFrame:
    """Rows of each unordered pair of devices at the same time, as <column>_1 and <column>_2."""
    a, b = (series.select(ts, F.col(device).alias(f"{device}_{i}"), *[F.col(c).alias(f"{c}_{i}") for c in columns]) for i in (1, 2))
    return a.join(b, ts).where(F.col(f"{device}_1") < F.col(f"{device}_2"))


def match_profiles_to_route(casts: DataFrame, route: DataFrame, us: str, device: str) -> DataFrame:
    """Each cast with the nearest point of its device's route (point_no), excluded points dropped, in route order."""
    found = nearest_join(casts, route, [device], us, ["point_no", "excluded"], prefix="route_")
    return found.where(~F.coalesce("route_excluded", F.lit(False)) & F.col("route_point_no").isNotNull()).orderBy("route_point_no", us)


def moving_anchor(rows: DataFrame, anchors: DataFrame, us: str, lat: str = "lat", lon: str = "lon", keys: list[str] | None = None) -> DataFrame:
    """The anchor in force at each row: the last one set at or before it."""
    found = neighbours(rows, anchors, keys or [], us, [lat, lon])
    return found.select(*rows.columns, F.col(f"prev.{lat}").alias("anchor_lat"), F.col(f"prev.{lon}").alias("anchor_lon"))


def anchor_from_track(rows: DataFrame, track: DataFrame, us: str, lat: str = "lat", lon: str = "lon", keys: list[str] | None = None, longest_gap_us: int | None = None) -> DataFrame:
    """The anchor at each row is where another device's track was, between its points linear in time.

    Null outside the track, and inside gaps of more than longest_gap_us.
    """
    found = neighbours(rows, track, keys or [], us, [lat, lon])
    whole = F.lit(True) if longest_gap_us is None else F.col("next.us") - F.col("prev.us") <= longest_gap_us
    return found.select(*rows.columns, *[F.when(whole, _between(us, c)).alias(f"anchor_{c}") for c in (lat, lon)])


#: Rows of the grid to a task of `nearest_grid_cells`, about, and rows of one cell that points are joined to at once, at most.
GRID_ROWS, TILE_ROWS = 1 << 15, 512


def nearest_grid_cells(points: DataFrame, grid: DataFrame, lat: str, lon: str, origin: tuple[float, float], step: float, around: bool = False) -> DataFrame:
    """The grid cell (lat, lon numbered i, j from the origin) nearest to each point within half a step, or the 2 x 2 cells around it.

    A point gets every row that the grid has for its cell, so the answer may be far larger than both sides.  For the nearest
    cell both are dealt out by tiles of a cell's rows and a task gets few tiles, one after another: the same rows of the grid
    follow from point to point, and pack well in files.  The points of one cell are one task's work in each tile.
    """
    y, x = (F.col(lat) - origin[0]) / step, (F.col(lon) - origin[1]) / step
    if around:
        cells = F.explode(F.array(*[F.struct((F.floor(y) + a).alias("i"), (F.floor(x) + b).alias("j")) for a in (0, 1) for b in (0, 1)]))
        keyed = points.select("*", cells.alias("_cell")).select(*points.columns, F.col("_cell.i").alias("i"), F.col("_cell.j").alias("j"))
        return keyed.join(grid, ["i", "j"])
    keyed = points.select("*", F.floor(y + 0.5).alias("i"), F.floor(x + 0.5).alias("j"))
    place = F.row_number().over(Window.partitionBy("i", "j").orderBy(*grid.columns))
    tiles = grid.withColumn("_tile", F.floor((place - 1) / TILE_ROWS))
    crowd = grid.groupBy("i", "j").agg(F.floor((F.count("*") - 1) / TILE_ROWS).alias("_last"))
    copies = keyed.join(crowd, ["i", "j"]).withColumn("_tile", F.explode(F.sequence(F.lit(0).cast("long"), "_last"))).drop("_last")
    tasks, by = max(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(grid.count() / GRID_ROWS)), ["i", "j", "_tile"]
    return copies.repartition(tasks, *by).join(tiles.repartition(tasks, *by).hint("merge"), by).drop("_tile")


#: Nodes that a node of `nearest_point` finds in its cell on the average, at most.
NODES_PER_CELL = 8


def fitting_cell(nodes: DataFrame, x: str, y: str, cell: float) -> float:
    """A width of cells of at most `cell`, a power of two smaller, at which a node shares its cell with few others."""

    def crowd() -> float:
        each = nodes.groupBy(*[F.floor(F.col(c) / cell) for c in (x, y)]).agg(F.count("*").alias("m"))
        return each.agg(F.try_divide(F.sum(F.col("m") * F.col("m")), F.sum("m"))).first()[0] or 0

    least = cell / (1 << 40)
    while (most := crowd() / NODES_PER_CELL) > 1 and cell > least:
        # Nodes that lie evenly need one turn; others leave their cells more slowly.
        cell /= 1 << max(1, math.ceil(math.log2(most) / 2))
    return cell


def nearest_point(points: DataFrame, nodes: DataFrame, x: str, y: str, cell: float, point_id: str, node_id: str) -> DataFrame:
    """The node nearest to each point, the smaller id if two are equally near, however far it lies.

    Points and nodes at one place are looked at once.  Cells are `cell` wide, or smaller by a power of two where that leaves
    more than NODES_PER_CELL nodes together, so pairs grow with the points, not with points times nodes.  Most points find
    their node among the 3 x 3 cells around them.  For the others, boxes around the nodes of ever smaller cells
    (a quarter as wide each time) are dropped if they begin behind the end of another box of the same point.
    """
    known = F.col(x).isNotNull() & F.col(y).isNotNull() & ~F.isnan(x) & ~F.isnan(y)
    own = points.where(known).select(point_id, (F.col(x) + 0.0).alias("_x"), (F.col(y) + 0.0).alias("_y"))
    p = settled(own.groupBy("_x", "_y").agg(F.min(point_id).alias("_p")))
    n = settled(nodes.where(known).groupBy((F.col(x) + 0.0).alias(x), (F.col(y) + 0.0).alias(y)).agg(F.min(node_id).alias(node_id)))
    cell = fitting_cell(n, x, y, cell)
    n = n.withColumns({"_i": F.floor(F.col(x) / cell), "_j": F.floor(F.col(y) / cell)})

    def best(pairs: DataFrame) -> DataFrame:
        d = F.hypot(F.col(x) - F.col("_x"), F.col(y) - F.col("_y"))
        found = pairs.groupBy("_p").agg(F.min(F.struct(d.alias("d"), F.col(node_id).alias("node"))).alias("b"))
        return found.select("_p", F.col("b.node").alias(node_id), F.col("b.d").alias("distance"))

    shift = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1)])
    around = p.select("*", F.explode(shift).alias("_s")).withColumns({"_i": F.floor(F.col("_x") / cell) + F.col("_s.a"), "_j": F.floor(F.col("_y") / cell) + F.col("_s.b")})
    # A hit is proven only within one cell.
    sure = settled(best(around.join(n, ["_i", "_j"])).where(F.col("distance") <= cell))

    def boxes(level: int) -> DataFrame:
        i, j = (F.shiftright(c, 2 * level) for c in ("_i", "_j"))
        return n.groupBy(i.alias("_bi"), j.alias("_bj")).agg(F.min(x).alias("_x0"), F.max(x).alias("_x1"), F.min(y).alias("_y0"), F.max(y).alias("_y1"))

    def pruned(pairs: DataFrame) -> DataFrame:
        low = [F.greatest(F.col(f"_{c}0") - F.col(f"_{c}"), F.col(f"_{c}") - F.col(f"_{c}1"), F.lit(0.0)) for c in "xy"]
        high = [F.greatest(F.abs(F.col(f"_{c}0") - F.col(f"_{c}")), F.abs(F.col(f"_{c}") - F.col(f"_{c}1"))) for c in "xy"]
        end = F.min(F.hypot(*high)).over(Window.partitionBy("_p"))
        kept = pairs.withColumn("_end", end * (1 + 1e-9)).where(F.hypot(*low) <= F.col("_end"))
        return kept.select("_p", "_x", "_y", F.col("_bi").alias("_i"), F.col("_bj").alias("_j"))

    span = n.agg(F.greatest(F.max("_i") - F.min("_i"), F.max("_j") - F.min("_j"))).first()[0] or 0
    top = (span.bit_length() + 1) // 2
    # Four boxes at most at the top, 16 times as many at each level.
    held = pruned(p.join(sure, "_p", "left_anti").crossJoin(F.broadcast(boxes(top))))
    for level in range(top - 1, -1, -1):
        inner = boxes(level).withColumns({"_i": F.shiftright("_bi", 2), "_j": F.shiftright("_bj", 2)})
        held = pruned(held.join(F.broadcast(inner) if top - level < 4 else inner, ["_i", "_j"]))
    found = sure.unionByName(best(held.join(n, ["_i", "_j"])))
    each = own.join(p.join(found, "_p"), ["_x", "_y"]).groupBy(point_id).agg(F.min(F.struct("distance", node_id)).alias("b"))
    return each.select(point_id, f"b.{node_id}", "b.distance")
