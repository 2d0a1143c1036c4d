"""Stateful streams against their batch twins: rows late and in any order, batches of any size, silent keys, restarts."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hydroframe.operators import stats, windows
from hydroframe.streaming import streams
from hydroframe.streaming.run import drain, folder


class Handle:
    """State of one key and its timers, in memory."""

    class Value:
        def __init__(self):
            self.held = None

        def exists(self):
            return self.held is not None

        def get(self):
            return self.held

        def update(self, x):
            self.held = x

        put = update

        def clear(self):
            self.held = None

        def appendList(self, more):
            self.held = (self.held or []) + more if more or self.held else None

    def __init__(self):
        self.timers = set()
        self.getValueState = self.getListState = lambda *a: self.Value()

    def registerTimer(self, t):
        self.timers.add(t)

    def deleteTimer(self, t):
        self.timers.discard(t)

    def listTimers(self):
        return iter(list(self.timers))


class Clock:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def run(processor, batches, columns, wait_ms, more_ms=()):
    """Rows that a processor gives for batches of one key; the watermark follows the greatest time, wait_ms behind."""
    handle, out, mark = Handle(), [], 0
    processor.init(handle)
    for rows in [*batches, *more_ms]:
        if not isinstance(rows, int):
            rows = [r for r in rows if r[0] >= mark * 1000]
            out += list(processor.handleInputRows(("k",), iter([pd.DataFrame(rows, columns=columns)] if rows else []), Clock(mark)))
            mark = max([mark, *(r[0] // 1000 - wait_ms for r in rows)])
        else:
            mark = max(mark, rows)
        for t in sorted(x for x in handle.timers if x <= mark):
            handle.timers.discard(t)
            out += list(processor.handleExpiredTimer(("k",), Clock(mark), None))
    return pd.concat(out) if out else pd.DataFrame(), processor, handle


def shuffled(rows, rng, near, size):
    """Rows a little out of order, in batches of up to `size` rows."""
    order = np.argsort(np.arange(len(rows)) + rng.uniform(0, near, len(rows)), kind="stable")
    rows, out = [rows[i] for i in order], []
    while rows:
        n = int(rng.integers(1, size + 1))
        out.append(rows[:n])
        rows = rows[n:]
    return out


@pytest.mark.parametrize("size", [1, 3, 50, 1000])
@pytest.mark.parametrize("passes", [[(1.2, 2)], [(1.5, 10), (2.0, 5)], [(2.0, 64)], [(1.0, 3), (1.5, 7), (2.0, 12)]])
def test_blocks_of_any_batches_equal_the_whole(passes, size):
    rng = np.random.default_rng(size)
    for n in (1, 2, 7, 40, 300):
        values = np.where(rng.random(n) < 0.1, 30, 0) + rng.normal(size=n)
        values[rng.random(n) < 0.05] = np.nan
        rows = [(1_000_000 * (i + 1), None if np.isnan(v) else float(v)) for i, v in enumerate(values)]
        for reach, fn in ((sum(b for _, b in passes), lambda x, a, z: streams.despiked(x, a, z, passes)), (1, lambda x, a, z: streams.spikes(x, a, z, 5.0))):
            processor = streams._Blocks("k", "us", "v", "out", reach, 10_000_000_000, fn)
            found, processor, handle = run(processor, shuffled(rows, rng, 5, size), ["us", "v"], 10_000, [100_000_000])
            assert found.us.tolist() == [t for t, _ in rows]
            np.testing.assert_array_equal(found.out.to_numpy(float), fn(values, True, True).astype(float))
            assert not processor.ring.exists() and not handle.timers


def test_the_ring_stays_short():
    rng = np.random.default_rng(3)
    rows = [(1_000_000 * (i + 1), float(v)) for i, v in enumerate(rng.normal(size=2000))]
    processor, handle = streams._Blocks("k", "us", "v", "out", 16, 10**10, lambda x, a, z: streams.despiked(x, a, z, [(2.0, 16)])), Handle()
    processor.init(handle)
    for i in range(0, 2000, 10):
        list(processor.handleInputRows(("k",), iter([pd.DataFrame(rows[i : i + 10], columns=["us", "v"])]), Clock(i * 1000)))
        assert len(processor.ring.get()) <= 2 * 16 + 20 and len(handle.timers) == 1


@pytest.mark.parametrize("block", [2, 5, 64])
def test_despiked_is_the_batch_operator(spark, block):
    rng = np.random.default_rng(block)
    values = np.where(rng.random(150) < 0.1, 30, 0) + rng.normal(size=150)
    frame = spark.createDataFrame([(0, i, None if i % 19 == 4 else float(v)) for i, v in enumerate(values)], "k int, us bigint, v double")
    values[4::19] = np.nan
    found = windows.despike(frame, ["k"], ["us"], "v", [(1.5, block), (2.0, max(2, block // 2))]).orderBy("us").toPandas()
    np.testing.assert_allclose(found.v.to_numpy(float), streams.despiked(values, True, True, [(1.5, block), (2.0, max(2, block // 2))]))


def holes_by_hand(times, longest):
    times = sorted(set(times))
    return [(a, b - a) for a, b in zip(times[:-1], times[1:], strict=True) if b - a > longest]


@pytest.mark.parametrize("size", [1, 4, 200])
def test_holes_of_late_rows(size):
    rng = np.random.default_rng(size)
    times = np.cumsum(rng.choice([1, 1, 1, 7], 300)) * 1_000_000
    rows = [(int(t),) for t in times]
    found, _, _ = run(streams._Holes("k", "us", 3_000_000, 10**12), shuffled(rows, rng, 6, size), ["us"], 60_000, [10**7])
    closed = found[found["size"].notna()]
    assert [(int(a), int(b)) for a, b in zip(closed.start, closed["size"], strict=True)] == holes_by_hand(times.tolist(), 3_000_000)
    assert found[found["size"].isna()].start.tolist()[-1] == times[-1]


def test_open_holes_are_told_closed_and_forgotten():
    s = 1_000_000
    holes = streams._Holes("k", "us", 5 * s, 100 * s)
    found, holes, handle = run(holes, [[(s,)], [(20 * s,)]], ["us"], 4_000)
    assert found.empty  # 20 s lies ahead of the watermark: a row may still come in between.
    late, holes, handle = run(streams._Holes("k", "us", 5 * s, 100 * s), [[(s,)], [(20 * s,)], [(17 * s,)], [(26 * s,)]], ["us"], 4_000)
    assert late["start"].tolist() == [s] and late["size"].tolist() == [16 * s]
    late, holes, handle = run(streams._Holes("k", "us", 5 * s, 100 * s), [[(s,)]], ["us"], 4_000, [7_000])
    assert late.start.tolist() == [s] and late["size"].isna().all() and holes.final.exists()
    late, holes, handle = run(streams._Holes("k", "us", 5 * s, 100 * s), [[(s,)]], ["us"], 4_000, [7_000, 200_000])
    assert not holes.final.exists() and not holes.waiting.exists() and not handle.timers
    again, _, _ = run(streams._Holes("k", "us", 5 * s, 100 * s), [[(s,)], 7_000, [(40 * s,)]], ["us"], 4_000, [41_000])
    assert again["size"].isna().tolist() == [True, False] and again["size"].tolist()[1] == 39 * s


def test_holes_through_a_stream(spark):
    path, root, s = folder(spark, "feed"), folder(spark, "runs"), 1_000_000
    parts = [[("a", 1), ("a", 2), ("b", 1)], [("a", 30), ("b", 3), ("c", 29)], [("a", 12), ("a", 28)], [("b", 60)], [(None, 5000)]]
    for part in parts:
        df = spark.createDataFrame([(k, t * s) for k, t in part], "k string, us bigint").withColumn("ts", F.timestamp_micros("us"))
        df.write.mode("append").parquet(path)
        out = drain(streams.stream_holes(spark.readStream.schema(df.schema).parquet(path), "k", "ts", "us", 8 * s, "20 seconds", 3000 * s), root=root)
    rows = {tuple(r) for r in out.collect()}
    assert {("a", 2 * s, 10 * s), ("a", 12 * s, 16 * s), ("b", 3 * s, 57 * s)} == {r for r in rows if r[2] is not None}
    assert {("a", 30 * s, None), ("b", 60 * s, None), ("c", 29 * s, None)} <= rows
    batch = spark.createDataFrame([(k, t * s) for part in parts for k, t in part], "k string, us bigint")
    assert {tuple(r) for r in stats.time_holes(batch, ["k"], "us", 8 * s).collect()} == {r for r in rows if r[2] is not None}


def test_replaced_in_groups_of_batches(spark):
    target = folder(spark, "replace")
    rng, want = np.random.default_rng(1), {}
    save = streams.replace_from_batch(target, "us")
    for number in range(23):
        first = int(rng.integers(0, 60))
        want = {t: v for t, v in want.items() if t < first} | dict.fromkeys(range(first, first + 20), number)
        save(spark.createDataFrame([(t, number) for t in range(first, first + 20)], "us bigint, v int"), number)
    for group in (2, 3, 1000):
        out = streams.replaced(spark, target, spark.createDataFrame([], "us bigint, v int").schema, "us", group)
        assert {r["us"]: r["v"] for r in out.collect()} == want
