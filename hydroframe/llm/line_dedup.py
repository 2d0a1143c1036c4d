r"""Line dedup by a sharded minimal perfect hash.

A line's key is the line without white space ([\x20\x09-\x0D]) at both ends, A-Z lower-cased.  Keys are counted once per
document.  A key is known by its BLAKE2b digest of 128 bits.  All distinct digests are dealt to shards; each shard is a minimal perfect hash of its keys (levels of bit
arrays in which only keys without a collision set their bit; the rank of the bit is the index) and two compact arrays, a
32-bit fingerprint and a saturated 16-bit count for each key.  Documents send the hashes of their lines, packed per batch
and shard, to the shard they belong to and probe its arrays there; lines themselves are never joined.  What comes back
is the numbers of the lines to drop.  A task holds one shard and one batch of probes at a time.  The most common lines, at
most HOT_PARTS for each task of a shuffle, go to every task with their whole digests, so no line sends more than a part of a
task's share of probes to one place.

Edge cases: null and empty texts are one empty line; empty keys are never dropped; every row is a document of its own,
also where ids are null or repeated; a text that loses all lines is empty; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared, words

SHARD_KEYS, HOT_PARTS, LEVELS, GAMMA, FULL = 1 << 16, 8, 24, 2.0, 65535
U = np.uint64


class PerfectHash:
    """A minimal perfect hash of 64-bit keys: `index` gives each of them another number below their count.

    Keys that still collide after the last level (equal ones always do) are left over, in `rest`.
    """

    def __init__(self, sizes: list[int], bits: bytes) -> None:
        self.sizes = sizes
        self.bits = np.unpackbits(np.frombuffer(bits, np.uint8), count=sum(sizes)).astype(bool)
        self.rank = np.cumsum(self.bits) - 1

    @classmethod
    def build(cls, keys: np.ndarray) -> tuple[list[int], bytes, np.ndarray]:
        """Sizes and bits of the levels, and which keys are left over."""
        sizes, arrays, left = [], [], np.arange(len(keys))
        for level in range(LEVELS):
            if not len(left):
                break
            size = max(8, int(GAMMA * len(left)))
            place = cls.place(keys[left], level, size)
            alone = np.bincount(place, minlength=size) == 1
            sizes.append(size)
            arrays.append(alone)
            left = left[~alone[place]]
        rest = np.zeros(len(keys), bool)
        rest[left] = True
        return sizes, np.packbits(np.concatenate(arrays) if arrays else np.zeros(0, bool)).tobytes(), rest

    @staticmethod
    def place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (words.mix(keys + U((level + 1) * 0x9E3779B97F4A7C15 % 2**64)) % U(size)).astype(np.int64)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for those left over; any number for others."""
        found, left, begin = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            if not len(left):
                break
            place = self.place(keys[left], level, size) + begin
            hit = self.bits[place]
            found[left[hit]] = self.rank[place[hit]]
            left = left[~hit]
            begin += size
        return found


def lines(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row and number of each line with a key, and two hashes of the key."""
    feed = np.flatnonzero(data == 10)
    row_of_feed = np.searchsorted(ends, feed, side="right") - 1
    begin = np.concatenate([ends[:-1], feed + 1])
    row = np.concatenate([np.arange(len(ends) - 1), row_of_feed])
    order = np.lexsort((begin, row))
    begin, row = begin[order], row[order]
    end = np.append(begin[1:] - 1, ends[-1]) if len(begin) else begin
    final = np.append(row[1:] != row[:-1], True) if len(row) else np.zeros(0, bool)
    end = np.where(final, ends[row + 1], end)
    number = np.arange(len(row)) - np.searchsorted(row, row)
    ink = np.append(np.flatnonzero(~words.SPACE[data]), len(data))
    a, b = np.searchsorted(ink, begin), np.searchsorted(ink, end)
    has = b > a
    first, last = ink[a[has]], ink[b[has] - 1] + 1
    one, two = (np.ascontiguousarray(x) for x in words.digests(data, first, last, lower=True).T)
    return row[has], number[has], one, two


def line_counts(texts: DataFrame) -> DataFrame:
    """h1, h2, n_docs of every distinct key of the texts (text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in shared.parts(batch, 0):
                row, _, one, two = lines(*shared.text_bytes(part.column(0)))
                each = np.unique(np.rec.fromarrays([one, two, row.astype(np.int64)], names="a,b,r"))
                keys, count = np.unique(np.rec.fromarrays([each.a, each.b], names="a,b"), return_counts=True)
                yield pa.record_batch([pa.array(np.ascontiguousarray(keys["a"]).view(np.int64)), pa.array(np.ascontiguousarray(keys["b"]).view(np.int64)), pa.array(count.astype(np.int64))], ["h1", "h2", "n"])

    return texts.mapInArrow(run, "h1 bigint, h2 bigint, n bigint").groupBy("h1", "h2").agg(F.sum("n").alias("n_docs"))


_INDEX = "shard bigint, sizes array<bigint>, bits binary, fingerprints binary, counts binary, rest binary"


def index(counts: DataFrame, shards: int) -> DataFrame:
    """One row per shard: levels and bits of its perfect hash, fingerprints, counts, and what is left over in full."""
    import pandas as pd

    def build(keys: pd.DataFrame) -> pd.DataFrame:
        held = arrays(*(keys[c].to_numpy() for c in ("h1", "h2", "n_docs")))
        return pd.DataFrame({"shard": [keys["shard"].iloc[0]], **{name: [x] for name, x in zip(("sizes", "bits", "fingerprints", "counts", "rest"), held, strict=True)}})

    keyed = counts.withColumn("shard", F.pmod(F.col("h1"), F.lit(shards)))
    return keyed.groupBy("shard").applyInPandas(build, _INDEX)


def arrays(one: np.ndarray, two: np.ndarray, n: np.ndarray) -> tuple:
    """Sizes, bits, fingerprints, counts and rest of a shard of keys (two hashes and a count)."""
    sizes, bits, rest = PerfectHash.build(one.view(U))
    count = np.minimum(n, FULL).astype(np.uint16)
    at = PerfectHash(sizes, bits).index(one[~rest].view(U))
    fingerprints, counts = np.zeros(len(at), np.uint32), np.zeros(len(at), np.uint16)
    fingerprints[at], counts[at] = two[~rest].view(U) >> U(32), count[~rest]
    left = np.stack([one[rest], two[rest], n[rest]]).astype(np.int64).tobytes()
    return sizes, bits, fingerprints.tobytes(), counts.tobytes(), left


class Shard:
    def __init__(self, sizes, bits, fingerprints, counts, rest) -> None:
        self.hash = PerfectHash([int(x) for x in sizes], bits)
        self.fingerprints, self.counts = np.frombuffer(fingerprints, np.uint32), np.frombuffer(counts, np.uint16)
        rest = np.frombuffer(rest, np.int64).reshape(3, -1)
        self.rest = {(a, b): n for a, b, n in rest.T.tolist()}

    def lookup(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Counts of keys, 0 for keys that are not indexed."""
        at = self.hash.index(one.view(U))
        out = np.zeros(len(one), np.int64)
        good = np.flatnonzero((at >= 0) & (at < len(self.counts)))
        good = good[self.fingerprints[at[good]] == (two[good].view(U) >> U(32))]
        out[good] = self.counts[at[good]]
        if self.rest:
            out = np.array([self.rest.get(k, n) for k, n in zip(zip(one.tolist(), two.tolist(), strict=True), out.tolist(), strict=True)], np.int64)
        return out


class Common:
    """The few most common keys with their whole digests and counts: a line that is none of them is never taken for one."""

    def __init__(self, one: np.ndarray, two: np.ndarray, n: np.ndarray) -> None:
        order = np.lexsort((two, one))
        self.one, self.two, self.n = one[order], two[order], n[order]

    def lookup(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Counts of keys, 0 for those that are none of these."""
        out = np.zeros(len(one), np.int64)
        at, end = np.searchsorted(self.one, one, "left"), np.searchsorted(self.one, one, "right")
        while (left := np.flatnonzero(at < end)).size:
            same = self.two[at[left]] == two[left]
            out[left[same]] = self.n[at[left[same]]]
            at[left] = np.where(same, end[left], at[left] + 1)
        return out


_PROBE = np.dtype([("h1", "<i8"), ("h2", "<i8"), ("key", "<i8"), ("key2", "<i8"), ("line", "<i4")])
#: The shard of what is found among the most common lines: nothing is left to look up.
_FOUND = -1


def probes(keyed: DataFrame, shards: int, hot: tuple, min_docs: int) -> DataFrame:
    """shard and packed probes of every batch of (key, key2, text) rows; hot: digests and counts of the most common lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = Common(*hot)
        for batch in batches:
            for part in shared.parts(batch, 2):
                row, number, one, two = lines(*shared.text_bytes(part.column(2)))
                packed = np.zeros(len(row), _PROBE)
                packed["h1"], packed["h2"], packed["line"] = one.view(np.int64), two.view(np.int64), number
                for k, name in enumerate(("key", "key2")):
                    packed[name] = part.column(k).to_numpy()[row]
                shard = np.mod(packed["h1"], shards)
                count = common.lookup(packed["h1"].copy(), packed["h2"].copy())
                use = (count == 0) | (count >= min_docs)
                packed, shard = packed[use], np.where(count > 0, _FOUND, shard)[use]
                order = np.argsort(shard, kind="stable")
                found, begin = np.unique(shard[order], return_index=True)
                cut = np.append(begin, len(order))
                rows = [packed[order[a:b]].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
                yield pa.record_batch([pa.array(found.astype(np.int64)), pa.array(rows, pa.binary())], ["shard", "probes"])

    return keyed.mapInArrow(run, "shard bigint, probes binary")


def dropped(keyed: DataFrame, index_rows: DataFrame, shards: int, hot: tuple, min_docs: int) -> DataFrame:
    """key, key2 and line_numbers of lines whose key is in at least min_docs documents, found by probing the arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, shard = None, None
        for batch in batches:
            keys, keys2, numbers = [], [], []
            for name, probe, *held in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if probe is None:
                    now, shard = name, Shard(*held)
                    continue
                packed = np.frombuffer(probe, _PROBE)
                if name != _FOUND:
                    assert now == name, "a probe without its shard"
                    packed = packed[shard.lookup(packed["h1"].copy(), packed["h2"].copy()) >= min_docs]
                if len(packed):
                    packed = packed[np.lexsort((packed["key2"], packed["key"]))]
                    begin = np.flatnonzero(np.append(True, (packed["key"][1:] != packed["key"][:-1]) | (packed["key2"][1:] != packed["key2"][:-1])))
                    keys += packed["key"][begin].tolist()
                    keys2 += packed["key2"][begin].tolist()
                    numbers += np.split(packed["line"], begin[1:])
            yield pa.record_batch([pa.array(keys, pa.int64()), pa.array(keys2, pa.int64()), pa.array([x.tolist() for x in numbers], pa.list_(pa.int32()))], ["key", "key2", "line_numbers"])

    assert min_docs <= FULL
    held = index_rows.select("shard", F.lit(None).cast("binary").alias("probes"), "sizes", "bits", "fingerprints", "counts", "rest", F.lit(0).cast("bigint").alias("deal"))
    # What is found already goes anywhere.
    asked = probes(keyed, shards, hot, min_docs)
    asked = asked.withColumn("deal", F.when(F.col("shard") == _FOUND, F.xxhash64("probes")).otherwise(0))
    n = shared.partitions(keyed.sparkSession)
    both = held.unionByName(asked, allowMissingColumns=True).repartition(n, "shard", "deal").sortWithinPartitions("shard", "deal", F.col("probes").isNotNull()).drop("deal")
    found = both.mapInArrow(run, "key bigint, key2 bigint, line_numbers array<int>")
    return found.groupBy("key", "key2").agg(F.flatten(F.collect_list("line_numbers")).alias("line_numbers"))


def hot_lines(counts: DataFrame) -> tuple[int, tuple]:
    """How many keys there are, and digests and counts of the most common ones: of lines in more than a part of a task's share."""
    n, total = counts.agg(F.count("*"), F.coalesce(F.sum("n_docs"), F.lit(0))).first()
    limit = max(1, total // (HOT_PARTS * shared.partitions(counts.sparkSession)))
    few = counts.where(F.col("n_docs") > max(limit, 100)).toArrow()
    return n, tuple(few.column(c).to_numpy().astype(np.int64) for c in ("h1", "h2", "n_docs"))


def drop_common_lines(docs: DataFrame, min_docs: int = 10, id_col: str = "doc_id", text_col: str = "text", texts: bool = True, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """id, n_lines, n_dropped, kept_sha256 and, with texts, kept_text of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in shared.parts(batch, 1):
                found = []
                for text, numbers in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    own = text.split("\n")
                    total = len(own)
                    if numbers:
                        keep = np.ones(total, bool)
                        keep[numbers] = False
                        own = list(compress(own, keep))
                    kept = "\n".join(own)
                    found.append((total, total - len(own), hashlib.sha256(kept.encode()).hexdigest(), kept if texts else None))
                columns = [pa.array([x[i] for x in found], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string(), pa.string()))]
                yield pa.record_batch([part.column(0), *columns], ["id", "n_lines", "n_dropped", "kept_sha256", "kept_text"])

    text = shared.text_or_empty(text_col)
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(F.col(id_col), text).alias("key"), F.xxhash64(F.lit("second"), F.col(id_col), text).alias("key2"))
    counts = shared.written(line_counts(rows.select("text")), "line-counts")
    n_keys, hot = hot_lines(counts)
    # At least one shard for each task, so that probes go to all of them.
    shards = max(shared.partitions(docs.sparkSession), -(-n_keys // shard_keys))
    index_rows = shared.written(index(counts, shards), "line-index")
    gone = shared.written(dropped(rows.select("key", "key2", "text"), index_rows, shards, hot, min_docs), "dropped-lines")
    # The same plan at every size: texts meet the few numbers by a merge join.
    out = rows.join(gone.hint("merge"), ["key", "key2"], "left").select("id", "text", F.coalesce("line_numbers", F.array().cast("array<int>")).alias("line_numbers"))
    kind = rows.schema["id"].dataType.simpleString()
    out = out.mapInArrow(run, f"id {kind}, n_lines bigint, n_dropped bigint, kept_sha256 string, kept_text string").withColumnRenamed("id", id_col)
    return out if texts else out.drop("kept_text")
