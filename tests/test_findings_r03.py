"""Cases of the findings of round 3: odd inputs, and work that must not grow faster than the input."""

import glob

import numpy as np
import pandas as pd
import pytest
from conftest import DATA
from pyspark.sql import functions as F

from hydroframe.plans import registry


def test_s19_names_stay_short(spark, monkeypatch, tmp_path):
    """Suffixes grow with the repeats of a name, so no name may be repeated by a share of all rows."""
    from hydroframe.plans import tables

    monkeypatch.setattr(tables, "folder", lambda *_: str(tmp_path / "gpx"))
    registry.queries()["s19_write_and_read_gpx"](spark, DATA)
    text = "".join(open(f).read() for f in glob.glob(f"{tmp_path}/gpx/waypoints/part-*"))
    names = pd.Series(text.split("<name>")[1:]).str.partition("</name>")[0]
    assert len(names) == names.nunique() == spark.read.parquet(f"{DATA}/events.parquet").count()
    assert names.str.extract(r"(\d+)([A-Z]*)$")[1].str.len().max() <= 3


def test_j15_crowded_cells(spark):
    """Nodes of one cell are looked at in smaller ones, those of one place once; results are those of all pairs."""
    from hydroframe.operators import joins

    rng = np.random.default_rng(5)
    xy = np.concatenate([rng.random((4000, 2)), np.repeat(rng.random((5, 2)), 200, axis=0), [[900.0, -900.0]]])
    nodes = pd.DataFrame({"n": rng.permutation(len(xy)), "x": xy[:, 0], "y": xy[:, 1]})
    own = np.concatenate([rng.random((60, 2)), xy[4000:4300:30], [[500.0, 0.0]]])
    points = pd.DataFrame({"p": np.arange(len(own)), "x": own[:, 0], "y": own[:, 1]})
    found = joins.nearest_point(spark.createDataFrame(points), spark.createDataFrame(nodes), "x", "y", 4.0, "p", "n").orderBy("p").toPandas()
    d = np.hypot(nodes.x.to_numpy() - own[:, :1], nodes.y.to_numpy() - own[:, 1:])
    assert found.n.tolist() == [int(nodes.n[row == row.min()].min()) for row in d] and np.allclose(found.distance, d.min(axis=1))
    even = spark.createDataFrame(nodes[:4000])
    cell = joins.fitting_cell(even, "x", "y", 4.0)
    assert even.selectExpr(f"floor(x / {cell}) as i", f"floor(y / {cell}) as j").groupBy("i", "j").count().agg(F.max("count")).first()[0] < 40


def test_g06_row_on_the_limit(spark):
    """Mean and limit meet exactly; the rounded mean lies a little further off."""
    from hydroframe.operators import sections

    a, b = 2 / 3, (2 + 30 * 3) / 3
    assert max(abs(a - (a + b) / 2), abs(b - (a + b) / 2)) > 15
    df = spark.createDataFrame([(1, 2.0, a), (1, 3.0, b)], "k int, z double, v double")
    assert [r.v for r in sections.horizon_slices(df, ["k"], "z", "v", [2.5], 1.6, 15).collect()] == pytest.approx([(a + b) / 2])


def changed_events(spark, tmp_path, columns):
    """The query's folder with some columns of the events changed, and these events."""
    spark.read.parquet(f"{DATA}/events.parquet").withColumns(columns).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path), {"events": pd.read_parquet(f"{tmp_path}/events.parquet")}


def test_s09_wide_device_numbers(spark, tmp_path):
    from compare import check

    folder, tables = changed_events(spark, tmp_path, {"user_id": F.col("user_id") * 997 + 70_000})
    found = registry.queries()["s09_read_framed_binary"](spark, folder).toPandas()
    check(found, registry.oracle_sql()["s09_read_framed_binary"], DATA, tables)


def test_w12_keeps_repeated_times(spark, tmp_path):
    from compare import check

    # Three rows have one time, also where the one between went back.
    folder, tables = changed_events(spark, tmp_path, {"ts": F.expr("timestamp_seconds(1704067200 + (event_id div 3) * 7)")})
    found = registry.queries()["w12_correct_time"](spark, folder).toPandas()
    check(found, registry.oracle_sql()["w12_correct_time"], DATA, tables)


@pytest.mark.parametrize("strict", [True, False])
def test_longest_subsequence_with_repeats(strict):
    from hydroframe.operators import grouped

    found = grouped.longest_increasing(np.array([1, 2, 2, 0, 2, 3.0]), strict).tolist()
    assert len(found) == (3 if strict else 5)


def test_j05_copies_no_run_to_every_point(spark):
    """A start is compared to one point, not to all of its day."""
    from hydroframe.operators import joins

    runs = spark.range(2000).select(F.col("id").alias("run"), (F.col("id") * 1000).alias("start"))
    points = spark.range(500).select((F.col("id") * 4000 + 500).alias("us"))
    found = joins.runs_for_points(points, runs, "us", "start", 2500)
    assert sorted(r.run for r in found.collect()) == [n for n in range(2000) if n * 1000 >= 500 and (n * 1000 - 500) % 4000 < 2500]
    assert "explode" not in found._jdf.queryExecution().toString().lower()


def test_groups_across_batches(spark):
    """Groups that end with a batch, go on in the next, or fill several; nulls are a key like others."""
    from hydroframe.operators import grouped

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.range(500).selectExpr("if(id < 40, null, cast(sqrt(id) as int)) as k", "id as n")
        counted = grouped.apply_per_block(df, ["k"], ["n"], lambda r: pd.DataFrame({"rows": [len(r)], "first": [r.n.iloc[0]], "at": [r.index[-1]]}), "rows bigint, first bigint, at bigint")
        expected = df.groupBy("k").agg(F.count("*").alias("rows"), F.min("n").alias("first"), (F.count("*") - 1).alias("at")).drop("k")
        assert sorted(counted.collect()) == sorted(expected.collect())
        order = grouped.values_per_block(df, ["k"], ["n"], "n", lambda v: np.arange(len(v)), "i", "bigint")
        assert order.groupBy("k").agg(F.max("i").alias("top"), F.count_distinct("i").alias("c")).where("top + 1 <> c").count() == 0 and order.count() == 500
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def dealt(processor, rows, columns, ends_ms):
    """Rows that a processor gives for one group of keys, in batches of 40 rows; the watermark follows 5 s behind."""
    from test_streams import Clock, Handle

    handle, out, mark = Handle(), [], 0
    processor.init(handle)
    for i in range(0, len(rows), 40):
        out += list(processor.handleInputRows((7,), iter([pd.DataFrame(rows[i : i + 40], columns=columns)]), Clock(mark)))
        mark = max(mark, max(r[1] for r in rows[i : i + 40]) // 1000 - 5_000)
    assert len(handle.timers) == 1
    for mark in ends_ms:
        handle.timers.clear()
        out += list(processor.handleExpiredTimer((7,), Clock(mark), None))
    assert not handle.timers
    return pd.concat(out)


def test_t07_t08_keys_of_a_group_in_one_call():
    """Keys of a group come in one call, those without a name too, and each gets what it gets alone."""
    from hydroframe.streaming import streams

    rng = np.random.default_rng(4)
    times = np.sort(rng.choice(4000, 900, replace=False)) * 100_000
    rows = [(("a", "b", None)[int(rng.integers(0, 3))], int(t), float(v)) for t, v in zip(times, rng.normal(size=900), strict=True)]
    holes = dealt(streams._Holes("k", "us", 900_000, 10**10), [r[:2] for r in rows], ["k", "us"], [10**6, 10**8])
    passes = [(1.5, 10), (2.0, 5)]
    kept = dealt(streams._Blocks("k", "us", "v", "kept", 15, 10**10, lambda x, a, z: streams.despiked(x, a, z, passes)), rows, ["k", "us", "v"], [10**8])
    for key in ("a", "b", None):
        own = [r for r in rows if r[0] == key]
        t = [r[1] for r in own]
        of = lambda df: df[df.k.isna() if key is None else df.k == key]
        closed = of(holes).dropna(subset="size").sort_values("start")
        assert list(zip(closed.start, closed["size"], strict=True)) == [(a, b - a) for a, b in zip(t[:-1], t[1:], strict=True) if b - a > 900_000]
        assert of(holes)[of(holes)["size"].isna()].start.tolist()[-1] == t[-1]
        assert of(kept).us.tolist() == t
        np.testing.assert_array_equal(of(kept).kept.to_numpy(float), streams.despiked(np.array([r[2] for r in own]), True, True, passes))


def test_s28_tries_only_what_may_be_a_number(spark):
    """Each text that is no number would cost an exception; what is one is still found, however it is written."""
    from hydroframe.sources import files

    texts = {"a": [" 5 ", "+7", "-128", "\t9", ""], "b": ["1e3", ".5", "-Infinity", "nan", "2d"], "c": ["12", "9223372036854775808", "x1", None, "-"], "e": ["9223372036854775808", "1", "2", "3", "4"]}
    df = spark.createDataFrame(list(zip(*texts.values(), strict=True)), ", ".join(f"{c} string" for c in texts))
    found = files.infer_column_types(df, list(texts))
    assert {r["name"]: (r["type"], r["nulls"]) for r in found.collect()} == {"a": ("tinyint", 1), "b": ("double", 0), "c": ("string", 1), "e": ("double", 0)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" in plan


@pytest.mark.parametrize("name", ["m10b_profile_properties", "m22_buoyancy_frequency"])
def test_seawater_has_no_interpreted_steps(spark, name):
    """Values bound for many uses are columns of compiled selects, not variables of lambdas."""
    plan = registry.queries()[name](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan


def test_t08_t08b_series_of_a_call_together():
    """All keys of a call are looked at in one array, and each row gets what its series gets alone."""
    from test_streams import Clock, Handle

    from hydroframe.streaming import streams

    rng, passes = np.random.default_rng(8), [(1.5, 10), (2.0, 5)]
    sizes = np.array([1, 40, 0, 3, 9, 200, 11])
    values = np.where(rng.random(sizes.sum()) < 0.1, 30, 0) + rng.normal(size=sizes.sum())
    values[rng.random(len(values)) < 0.1] = np.nan
    begins, ends = rng.random(len(sizes)) < 0.5, rng.random(len(sizes)) < 0.5
    each = list(zip(np.split(values, np.cumsum(sizes)[:-1]), begins, ends, strict=True))
    for fn, more in ((streams.despiked, passes), (streams.spikes, 1.0)):
        alone = np.concatenate([fn(v, b, e, more) for v, b, e in each if len(v)])
        np.testing.assert_array_equal(fn(values, begins, ends, more, sizes=sizes), alone)
    calls = []

    def counted(x, a, z, sizes):
        calls.append(len(sizes))
        return streams.despiked(x, a, z, passes, sizes)

    rows = pd.DataFrame({"k": [f"k{n % 50}" for n in range(2000)], "us": np.arange(2000) * 1_000_000, "v": rng.normal(size=2000)})
    processor, out = streams._Blocks("k", "us", "v", "kept", 15, 10**10, counted, True), []
    processor.init(Handle())
    for part in (rows[:1500], rows[1500:]):
        out += list(processor.handleInputRows((7,), iter([part]), Clock(int(part.us.max()) // 1000)))
    out += list(processor.handleExpiredTimer((7,), Clock(10**8), None))
    assert calls == [50, 50, 50]
    found = pd.concat(out)
    for key, own in rows.groupby("k"):
        np.testing.assert_array_equal(found[found.k == key].kept.to_numpy(float), streams.despiked(own.v.to_numpy(), True, True, passes))


def test_j14_rows_of_a_cell_follow_one_another(spark, monkeypatch, tmp_path):
    """The answer is points times rows of their cells; the points of a tile of a cell are written one after another."""
    from hydroframe.operators import joins

    monkeypatch.setattr(joins, "TILE_ROWS", 32)
    points = spark.range(3000).selectExpr("id as event", "cast(id % 30 as double) as lat", "cast(id * 7 % 11 as double) as lon")
    grid = spark.range(330 * 100).selectExpr("id + (1L << 40) as cell", "id % 30 as i", "id div 30 % 11 as j")
    found = joins.nearest_grid_cells(points, grid, "lat", "lon", (0, 0), 1.0).select("event", "cell")
    found.write.parquet(f"{tmp_path}/out")
    rows = pd.concat([pd.read_parquet(f) for f in sorted(glob.glob(f"{tmp_path}/out/*.parquet"))], ignore_index=True)
    assert len(rows) == rows.drop_duplicates().shape[0] == 300_000
    n, c = rows.event, rows.cell - (1 << 40)
    assert ((c % 30 == n % 30) & (c // 30 % 11 == n * 7 % 11)).all()
    turns = (c % 330).diff().fillna(1).ne(0).sum()
    assert turns <= 330 * 4


def test_s32b_small_ranges_share_tasks(spark, tmp_path):
    """Small ranges make neither a task each nor reads of megabytes; lines are those of the file."""
    import io

    from hydroframe.sources import ranges

    tasks = ranges.planned([("a", 1 << 30), ("b", 5)], 1 << 16)
    assert len(tasks) <= ranges.TASKS + 2 and [p for t in tasks for p in t.parts][-1] == ("b", 0, 5, 5) and sum(len(t.parts) for t in tasks) == (1 << 14) + 1
    assert len(ranges.planned([("a", 200 << 30)], 1 << 16)) >= 3200
    read = []

    class Counted(io.BytesIO):
        def read(self, n=-1):
            read.append(len(data := super().read(n)))
            return data

    rng = np.random.default_rng(2)
    lines = [bytes(rng.integers(97, 123, int(n)).astype(np.uint8)) for n in [*rng.integers(0, 90, 20_000), 30_000, 5]]
    data, found = b"\n".join(lines), []
    for begin in range(0, len(data), 1 << 12):
        found += ranges.lines_of(Counted(data), begin, min(begin + (1 << 12), len(data)), len(data))
    assert [x for _, x in found] == lines and all(data[a : a + len(x)] == x for a, x in found)
    assert sum(read) < 5 * len(data)


def test_t08b_state_is_in_few_partitions(spark, monkeypatch, tmp_path):
    """What a partition of the state costs in each batch must not grow with the partitions of a shuffle."""
    from hydroframe.plans import streams as plans
    from hydroframe.streaming import streams
    from hydroframe.streaming.run import drain

    asked = []

    def told(stream, **more):
        asked.append(more.get("partitions"))
        return stream

    monkeypatch.setattr(plans, "drain", told)
    for name in ("t07_stream_holes", "t08_stream_despike", "t08b_stream_despike_blocks"):
        registry.queries()[name](spark, DATA)
    assert set(asked) == {64}
    shuffle = "spark.sql.shuffle.partitions"
    df = spark.range(1, 41).selectExpr("cast(id % 5 as string) as k", "id * 1000000 as us", "timestamp_micros(id * 1000000) as ts", "double(id % 3) as v")
    for run, (partitions, rows) in enumerate(((2, df), (3, df.withColumns({"us": F.expr("us + 100000000"), "ts": F.expr("ts + interval 100 seconds")})))):
        rows.write.mode("append").parquet(f"{tmp_path}/feed")
        stream = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/feed")
        out = drain(streams.stream_despike(stream, "k", "ts", "us", "v", [(1.5, 4)], "1 second", 10**10), root=f"{tmp_path}/run", partitions=partitions)
        # A stream that goes on has the partitions it began with.
        assert len(glob.glob(f"{tmp_path}/run/state/state/0/[0-9]*")) == 2 and spark.conf.get(shuffle) == "4", run
    # Of eight rows of each key, the watermark has passed all but the last of one key; four wait for their block.
    assert out.select("k", "us").distinct().count() == out.count() == 4 * 4 + 3
