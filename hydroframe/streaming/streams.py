"""Incremental operators as Structured Streaming (T01-T08).  Each equals a batch operator on the same rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import BooleanType, DateType, LongType, NumericType, StringType, StructType

from ..operators.sequence import settled
from ..sources.sinks import create_table, load_files


def stream_ingest(spark: SparkSession, folder: str, schema: StructType, root: str, checkpoint: str, files_per_batch: int = 16) -> None:
    """Load new files of a folder once each into a table with a manifest (S21); restarts continue.

    A batch is a load, of the same name when it is run again, so a file is never counted twice.  A file that changes after it
    was loaded is not seen by the stream; `reload_changed_files` finds it by its change time and replaces its rows here.
    Rows hold the time in microseconds as `us`, and get their file's path as `fileName`.
    """
    create_table(spark, root)

    def save(rows: DataFrame, number: int) -> None:
        rows = settled(rows)
        files = rows.select("fileName", F.col("_changed").alias("fileChangeTime")).distinct()
        load_files(rows.drop("_changed"), files, root, f"stream-{number}", "us")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    stream = stream.select("*", F.col("_metadata.file_path").alias("fileName"), F.col("_metadata.file_modification_time").alias("_changed"))
    stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def stream_bin_mean(stream: DataFrame, keys: list[str], ts: str, period: str, late: str, columns: list[str], centred: str | None = None) -> DataFrame:
    """Means of tumbling bins, final once the watermark has passed; `centred` is half a period for centred bins."""
    window = F.window(ts, period, period, centred) if centred else F.window(ts, period)
    bins = stream.withWatermark(ts, late).groupBy(*keys, window.alias("w")).agg(F.count("*").alias("rows"), *[F.avg(c).alias(c) for c in columns])
    start = F.unix_micros("w.start")
    label = F.floor((start + F.unix_micros("w.end")) / 2).cast("long") if centred else start
    return bins.select(*keys, label.alias("bin"), "rows", *columns)


def stream_sliding(stream: DataFrame, keys: list[str], ts: str, length: str, slide: str, late: str, columns: list[str]) -> DataFrame:
    """Means of overlapping intervals."""
    bins = stream.withWatermark(ts, late).groupBy(*keys, F.window(ts, length, slide).alias("w")).agg(F.count("*").alias("rows"), *[F.avg(c).alias(c) for c in columns])
    return bins.select(*keys, F.unix_micros("w.start").alias("interval_start"), "rows", *columns)


def stream_bursts(stream: DataFrame, keys: list[str], ts: str, gap: str, late: str) -> DataFrame:
    """Bursts as sessions: begin, end (of the last row) and rows."""
    runs = stream.withWatermark(ts, late).groupBy(*keys, F.session_window(ts, gap).alias("w")).agg(F.min(ts).alias("_b"), F.max(ts).alias("_e"), F.count("*").alias("rows"))
    return runs.select(*keys, F.unix_micros("_b").alias("begin"), F.unix_micros("_e").alias("end"), "rows")


def replace_from_batch(target: str, us: str) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: rows of a batch replace what the target holds from the batch's first time on.

    Nothing is written again: each batch is appended with the time it cuts older batches at, and `replaced` applies the
    cuts when the target is read.  A batch that is run again replaces itself.
    """

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/rows/batch={number}")
        batch.agg(F.min(us).alias("cut")).where("cut is not null").write.mode("overwrite").parquet(f"{target}/cuts/batch={number}")

    return save


def replaced(spark: SparkSession, target: str, schema: StructType, us: str, group: int = 1000) -> DataFrame:
    """Rows of the target that no later batch has replaced.

    A batch's limit is the least cut of the batches after it, looked up in groups of batches and then between groups.
    """
    cuts = spark.read.schema("cut bigint, batch bigint").parquet(f"{target}/cuts").withColumn("_group", F.expr(f"batch div {group}"))

    def least(by: list[str], order: str, column: str) -> Column:
        return F.min(column).over(Window.partitionBy(*by).orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, -1))

    groups = cuts.groupBy("_group").agg(F.min("cut").alias("_least")).withColumn("_far", F.expr(f"_group div {group}"))
    # A row for each thousand batches, in groups of a thousand; what is further on is one row for each million batches.
    far = groups.groupBy("_far").agg(F.min("_least").alias("_all")).withColumn("_all", least([], "_far", "_all"))
    groups = groups.withColumn("_next", least(["_far"], "_group", "_least")).join(far, "_far").select("_group", F.least("_next", "_all").alias("_next"))
    limits = cuts.withColumn("_own", least(["_group"], "batch", "cut")).join(groups, "_group").select("batch", F.least("_own", "_next").alias("_limit"))
    rows = spark.read.schema(StructType(schema.fields).add("batch", LongType())).parquet(f"{target}/rows")
    return rows.join(limits, "batch").where(F.col("_limit").isNull() | (F.col(us) < F.col("_limit"))).select(*schema.names)


def stream_dedup(stream: DataFrame, keys: list[str], ts: str, late: str) -> DataFrame:
    """One row per key and time; the first to arrive stays (the batch operator keeps the last)."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark([*keys, ts])


#: Groups that the keys of a stateful stream are dealt to, and partitions that serve them, however many a shuffle has.
GROUPS, PARTITIONS = 1024, 64


class _Rows:
    """Rows that a group of keys holds in its state, as one Arrow table."""

    def __init__(self, handle, name: str) -> None:
        self.state = handle.getValueState(name, "rows binary")

    def exists(self) -> bool:
        return self.state.exists()

    def get(self) -> pd.DataFrame | None:
        held = self.state.get()
        return None if held is None else pa.ipc.open_stream(held[0]).read_pandas()

    def put(self, rows: pd.DataFrame) -> None:
        if rows.empty:
            self.state.clear()
            return
        batch, sink = pa.RecordBatch.from_pandas(rows, preserve_index=False), pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema) as out:
            out.write_batch(batch)
        self.state.update((sink.getvalue().to_pybytes(),))


class _Grouped(StatefulProcessor):
    """A processor of groups of keys, so what a call costs is shared by the keys of a group.

    A group has one timer, the earliest of its keys.  Rows without the key's column are all of one key, the group's own.
    """

    key: str

    def _together(self, key: tuple, rows: Iterator[pd.DataFrame], columns: list[str]) -> pd.DataFrame:
        parts = [part if self.key in part else part.assign(**{self.key: key[0]}) for part in rows]
        fresh = pd.concat(parts)[[self.key, *columns]] if parts else pd.DataFrame(columns=[self.key, *columns])
        fresh = fresh[fresh[columns[0]].notna()]
        return fresh.astype({columns[0]: np.int64})

    def _wake(self, first_us: int | None, limit_us: int) -> None:
        """Set the timer to a time, or to none, but always behind the watermark."""
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if first_us is not None:
            self.handle.registerTimer(max(-(-first_us // 1000), limit_us // 1000 + 1))

    def close(self) -> None:
        pass


class _Holes(_Grouped):
    """The last time of each key that nothing can come before any more, and the times after it."""

    def __init__(self, key: str, us: str, longest_us: int, forget_us: int) -> None:
        self.key, self.us, self.longest_us, self.forget_us = key, us, longest_us, forget_us

    def init(self, handle) -> None:
        self.handle = handle
        self.final = _Rows(handle, "final")
        self.waiting = _Rows(handle, "waiting")

    def _settled(self, fresh: pd.DataFrame | None, limit_us: int) -> Iterator[pd.DataFrame]:
        """Holes up to the watermark; sets the timer that is next."""
        finals = self.final.get()
        last = [] if finals is None else [finals.assign(old=True)]
        more = [x.assign(told=False, old=False) for x in (self.waiting.get(), fresh) if x is not None and len(x)]
        if not last and not more:
            return
        rows = pd.concat([*last, *more], ignore_index=True)
        code, names = pd.factorize(rows[self.key], use_na_sentinel=False)
        us, old, told = rows[self.us].to_numpy(np.int64), rows["old"].to_numpy(bool), rows["told"].to_numpy(bool)
        order = np.lexsort((~old, us, code))
        code, us, old, told = (x[order] for x in (code, us, old, told))
        # What comes before the last final time is late; a time counts once.
        floor = np.full(len(names), np.iinfo(np.int64).min)
        floor[code[old]] = us[old]
        again = np.concatenate([[False], (code[1:] == code[:-1]) & (us[1:] == us[:-1])])
        keep = old | ((us > floor[code]) & ~again)
        code, us, old, told = (x[keep] for x in (code, us, old, told))
        done = old | (us <= limit_us)
        k, t = code[done], us[done]
        hole = (k[1:] == k[:-1]) & (t[1:] - t[:-1] > self.longest_us)
        # Of each key: whether it has a final time, the last one, whether its open hole was told, and the first time after it.
        has, last_us, open_told, first = np.zeros(len(names), bool), np.zeros(len(names), np.int64), np.zeros(len(names), bool), np.full(len(names), np.iinfo(np.int64).max)
        ends = np.concatenate([k[1:] != k[:-1], [True]]) if len(k) else np.zeros(0, bool)
        has[k[ends]], last_us[k[ends]], open_told[k[ends]] = True, t[ends], told[done][ends]
        np.minimum.at(first, code[~done], us[~done])
        quiet = has & (first == np.iinfo(np.int64).max)
        # Nothing came for so long, and nothing can any more: a hole whose end is not known.
        silent = quiet & ~open_told & (limit_us >= last_us + self.longest_us)
        open_told = open_told | silent
        stay = has & ~(quiet & (limit_us >= last_us + self.forget_us))
        self.final.put(pd.DataFrame({self.key: np.asarray(names, object)[stay], self.us: last_us[stay], "told": open_told[stay]}))
        self.waiting.put(pd.DataFrame({self.key: np.asarray(names, object)[code[~done]], self.us: us[~done]}))
        after = np.where(quiet, last_us + np.where(open_told, self.forget_us, self.longest_us), first)[stay | ~quiet]
        self._wake(int(after.min()) if len(after) else None, limit_us)
        told_codes = np.concatenate([k[:-1][hole], np.flatnonzero(silent)])
        found = pd.DataFrame({self.key: np.asarray(names, object)[told_codes], "start": np.concatenate([t[:-1][hole], last_us[silent]])})
        yield found.assign(size=pd.array([*(t[1:] - t[:-1])[hole], *[None] * int(silent.sum())], "Int64")).astype({"start": "Int64"})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        yield from self._settled(self._together(key, rows, [self.us]), timerValues.getCurrentWatermarkInMs() * 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._settled(None, timerValues.getCurrentWatermarkInMs() * 1000)


def _by_groups(rows: DataFrame, key: str, ts: str, late: str, schema: str, processor: _Grouped, groups: int) -> DataFrame:
    """A processor on groups of keys; keys go through it as text (so rows with and without a key fit one column) and come back."""
    kind = rows.schema[key].dataType
    if not isinstance(kind, (NumericType, StringType, DateType, BooleanType)):
        raise TypeError(f"keys of a stream are numbers, texts, dates or booleans, not {kind.simpleString()}")
    rows = rows.withWatermark(ts, late).withColumn("_group", F.expr(f"pmod(xxhash64(`{key}`), {groups})")).withColumn(key, F.col(key).cast("string"))
    out = rows.groupBy("_group").transformWithStateInPandas(processor, f"`{key}` string, {schema}", "Append", "EventTime")
    return out.withColumn(key, F.col(key).cast(kind))


def stream_holes(stream: DataFrame, key: str, ts: str, us: str, longest_us: int, wait: str, forget_us: int, groups: int = GROUPS) -> DataFrame:
    """Gaps of more than longest_us as (key, start, size); rows may come in any order, `wait` late at most.

    A gap is given when the watermark has passed its end, so a late row inside the wait still closes it.  When a key has been
    silent for longest_us past the wait, the open hole is given with a null size; should the key speak again, it comes once
    more with its size.  A key that was silent for forget_us is forgotten: its state goes, and a later row begins anew.
    Keys are dealt to `groups` by their hash; a group is held in memory, and a checkpoint goes on with the same number only.
    """
    return _by_groups(stream.select(key, ts, us), key, ts, wait, "start bigint, size bigint", _Holes(key, us, longest_us, max(forget_us, longest_us)), groups)


def spikes(values: np.ndarray, begins: bool | np.ndarray, ends: bool | np.ndarray, max_spike: float, sizes: np.ndarray | None = None) -> np.ndarray:
    """W01 on series in order, one after another; sizes: the rows of each, if there are several."""
    step = np.diff(values)
    if sizes is not None:
        last = np.cumsum(sizes)[:-1] - 1
        step[last[(last >= 0) & (last < len(step))]] = np.nan
    before, after = np.full(len(values), np.nan), np.full(len(values), np.nan)
    before[1:], after[:-1] = step, -step
    up = ~(before <= max_spike) & ~(after <= max_spike)
    down = ~(before >= -max_spike) & ~(after >= -max_spike)
    return ~np.isnan(values) & ~(np.isnan(before) & np.isnan(after)) & (up | down)


def despiked(values: np.ndarray, begins: bool | np.ndarray, ends: bool | np.ndarray, passes: list[tuple[float, int]], sizes: np.ndarray | None = None) -> np.ndarray:
    """W02 on series in order, one after another: NaN where a pass finds a spike.  sizes: the rows of each, if there are
    several.  begins, ends (of each): the series' own ends, which take the first and last full block, are among the values."""
    out = values.astype(np.float64).copy()
    sizes = np.array([len(out)]) if sizes is None else np.asarray(sizes)
    series, first_row = np.repeat(np.arange(len(sizes)), sizes), np.cumsum(sizes) - sizes
    begins, ends = (np.broadcast_to(x, len(sizes))[series] for x in (begins, ends))
    i, n = np.arange(len(out)) - first_row[series], sizes[series]
    for offset, block in passes:
        half = block // 2
        # Between two series lie so many NaN that no block reaches both.
        base = half + first_row[series] + series * block
        padded = np.full(len(out) + len(sizes) * block + block, np.nan)
        padded[base + i] = out
        view = np.lib.stride_tricks.sliding_window_view(padded, block)
        some = ~np.isnan(view)
        count = some.sum(axis=1)
        mean = np.where(some, view, 0).sum(axis=1) / np.maximum(count, 1)
        std = np.sqrt(np.where(some, (view - mean[:, None]) ** 2, 0).sum(axis=1) / np.maximum(count, 1))
        mean, std = np.where(count > 0, mean, np.nan), np.where(count > 0, std, np.nan)
        high = np.maximum(n - (block - half), 0)
        at = np.where(ends & (i > high), high, i)
        at = base - half + np.where(begins & (i < half), np.minimum(half, high), at)
        with np.errstate(invalid="ignore"):
            out[np.abs(out - mean[at]) > offset * std[at]] = np.nan
    return out


class _Blocks(_Grouped):
    """A ring of the last rows of each key: those not given yet, and before them as many as their blocks look back at."""

    def __init__(self, key: str, us: str, column: str, result: str, reach: int, flush_us: int, fn: Callable[..., np.ndarray], several: bool = False) -> None:
        """fn takes values in order and whether their series begins and ends there; with `several`, those of many series and their sizes."""
        self.key, self.us, self.column, self.result, self.reach, self.flush_us, self.fn, self.several = key, us, column, result, reach, flush_us, fn, several

    def init(self, handle) -> None:
        self.handle = handle
        self.ring = _Rows(handle, "ring")
        #: Of each key of the ring: its rows, those of them that were given already, whether the series' first row has left it.
        self.place = _Rows(handle, "place")

    def _found(self, values: np.ndarray, begins: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        if self.several:
            return self.fn(values, begins, ends, sizes=sizes)
        edges = np.cumsum(sizes)
        return np.concatenate([self.fn(values[z - n : z], b, e) for z, n, b, e in zip(edges.tolist(), sizes.tolist(), begins.tolist(), ends.tolist(), strict=True)])

    def _moved(self, fresh: pd.DataFrame | None, limit_us: int) -> Iterator[pd.DataFrame]:
        """Rows of all keys that are due, as columns of all keys; sets the timer that is next."""
        place, ring = self.place.get(), self.ring.get()
        fresh = pd.DataFrame({self.key: [], self.us: np.zeros(0, np.int64), self.column: np.zeros(0)}) if fresh is None else fresh
        if place is None and fresh.empty:
            return
        held = 0 if place is None else len(place)
        code, names = pd.factorize(np.concatenate([[] if place is None else place[self.key].to_numpy(object), fresh[self.key].to_numpy(object)]).astype(object), use_na_sentinel=False)
        names, new = np.asarray(names, object), code[held:]
        rows, given, cut = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64), np.zeros(len(names), bool)
        us, values = fresh[self.us].to_numpy(np.int64), fresh[self.column].to_numpy(np.float64, na_value=np.nan)
        # What a key holds comes first; of its rows, those that were given come before those that were not.
        told = np.zeros(len(us), bool)
        if held:
            rows[:held], given[:held], cut[:held] = place["rows"], place["given"], place["cut"]
            old = np.repeat(np.arange(held), rows[:held])
            old_us, told_old = ring[self.us].to_numpy(np.int64), np.arange(len(old)) - (np.cumsum(rows) - rows)[old] < given[old]
            floor, last = np.full(len(names), np.iinfo(np.int64).min), np.full(len(names), np.iinfo(np.int64).min)
            floor[old[told_old]], last[old] = old_us[told_old], old_us
            in_time = us >= floor[new]
            quiet = np.bincount(new, minlength=len(names)) == 0
            flush, idle = quiet & (last + self.flush_us <= limit_us), quiet & (last + self.flush_us > limit_us)
            new, told = np.concatenate([old, new[in_time]]), np.concatenate([told_old, told[in_time]])
            us, values = np.concatenate([old_us, us[in_time]]), np.concatenate([ring[self.column].to_numpy(np.float64), values[in_time]])
        else:
            flush = idle = np.zeros(len(names), bool)
        order = np.lexsort((us, ~told, new))
        code, us, values = new[order], us[order], values[order]
        rows = np.bincount(code, minlength=len(names))
        starts = np.cumsum(rows) - rows
        at = np.arange(len(code)) - starts[code]
        settled = np.where(flush, rows, np.maximum(given, np.bincount(code[us <= limit_us], minlength=len(names)) - self.reach))
        settled = np.where(idle, given, settled)
        gone = np.where(idle, 0, np.where(flush, rows, np.maximum(0, settled - self.reach)))
        due, stays = settled > given, ~flush
        keep = at >= gone[code]
        self.ring.put(pd.DataFrame({self.us: us[keep], self.column: values[keep]}))
        self.place.put(pd.DataFrame({self.key: names[stays], "rows": (rows - gone)[stays], "given": (settled - gone)[stays], "cut": (cut | (gone > 0))[stays]}))
        ends = (us[starts + rows - 1] + self.flush_us)[stays]
        self._wake(int(ends.min()) if len(ends) else None, limit_us)
        if due.any():
            whole = due[code]
            found = self._found(values[whole], ~cut[due], flush[due], rows[due])
            out = ((at >= given[code]) & (at < settled[code]))[whole]
            yield pd.DataFrame({self.key: names[code[whole][out]], self.us: us[whole][out], self.column: values[whole][out], self.result: found[out]})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        yield from self._moved(self._together(key, rows, [self.us, self.column]), timerValues.getCurrentWatermarkInMs() * 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._moved(None, timerValues.getCurrentWatermarkInMs() * 1000)


def _in_blocks(stream: DataFrame, key: str, ts: str, us: str, column: str, late: str, result: str, kind: str, processor: _Blocks, groups: int) -> DataFrame:
    rows = stream.select(key, ts, us, F.col(column).cast("double").alias(column))
    return _by_groups(rows, key, ts, late, f"{us} bigint, {column} double, {result} {kind}", processor, groups)


def stream_spikes(stream: DataFrame, key: str, ts: str, us: str, column: str, max_spike: float, late: str, flush_us: int, groups: int = GROUPS) -> DataFrame:
    """W01 on a stream: (key, us, value, spike) of each row once its successor is final; as stream_despike otherwise."""
    return _in_blocks(stream, key, ts, us, column, late, "spike", "boolean", _Blocks(key, us, column, "spike", 1, flush_us, partial(spikes, max_spike=max_spike), True), groups)


def stream_despike(stream: DataFrame, key: str, ts: str, us: str, column: str, passes: list[tuple[float, int]], late: str, flush_us: int, groups: int = GROUPS) -> DataFrame:
    """W02 on a stream: (key, us, value, kept) of each row, kept null where a pass finds a spike.

    Rows may come in any order, `late` late at most.  A row is given when all that its blocks look ahead at is final; the
    state holds the rows not given yet and the last ones before them, the sum of the blocks at most.  When a key has been
    silent for flush_us, its last rows come out by the rule for the end of a series; a later row begins a new series.
    Keys are dealt to `groups` by their hash, as in stream_holes.
    """
    return _in_blocks(stream, key, ts, us, column, late, "kept", "double", _Blocks(key, us, column, "kept", sum(b for _, b in passes), flush_us, partial(despiked, passes=passes), True), groups)
