"""Operators on long series give the same rows whatever the size of the blocks that tasks work on."""

import random

import pytest
from pyspark.sql import functions as F

from hydroframe.operators import filters, sequence, windows

S = 1_000_000


@pytest.fixture(scope="module")
def series(spark):
    rng = random.Random(5)
    rows = [(k, i, i * S + rng.randrange(S), rng.choice([None, 1.0, 1.0, 2.0, 9.0, 30.0])) for k in ("a", None) for i in range(400)]
    return spark.createDataFrame(rows, "k string, n bigint, us bigint, v double").cache()


def values(df, column):
    return [(r["k"], r["n"], r[column]) for r in df.select("k", "n", column).orderBy("k", "n").collect()]


CASES = {
    "spikes": ("spike", lambda df, rows: windows.single_spikes(df, ["k"], ["us"], "v", 5.0, rows)),
    "despike": ("v", lambda df, rows: windows.despike(df, ["k"], ["us"], "v", [(1.5, 10), (2.0, 5)], rows)),
    "gaussian": ("v", lambda df, rows: windows.gaussian_moving_mean(df, ["k"], ["us"], "v", 9, block_rows=rows)),
    "mostly": ("mostly", lambda df, rows: windows.mostly_bad_regions(df.withColumn("bad", F.coalesce(F.col("v") > 1, F.lit(True))), ["k"], ["us"], "bad", 7, block_rows=rows)),
    "frozen": ("works", lambda df, rows: filters.frozen_signal(df.withColumn("v", F.coalesce("v", F.lit(1.0))), ["k"], ["us"], "v", 0.0, (4, 8), rows)),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_blocks(series, name):
    column, run = CASES[name]
    whole, split = values(run(series, 1 << 17), column), values(run(series, 40), column)
    assert len(whole) == 800 and whole == split


@pytest.mark.parametrize("backward", [False, True])
@pytest.mark.parametrize("strict", [False, True])
def test_carry(series, backward, strict):
    found = values(sequence.carry(series, ["k"], "us", [], {"held": F.col("v")}, backward, strict, bucket_us=37 * S), "held")
    by_key = {k: [r["v"] for r in series.where(F.col("k").eqNullSafe(k)).orderBy("us").collect()] for k in ("a", None)}
    for k, own in by_key.items():
        own = own[::-1] if backward else own
        expected, last = [], None
        for v in own:
            now = v if v is not None else last
            expected.append(last if strict else now)
            last = now
        assert [x[2] for x in found if x[0] == k] == (expected[::-1] if backward else expected)


def test_cumulated(series):
    found = values(sequence.cumulated(series, ["k"], "us", [], {"total": F.col("v")}, 37 * S), "total")
    for k in ("a", None):
        total, expected = 0.0, []
        for r in series.where(F.col("k").eqNullSafe(k)).orderBy("us").collect():
            total += r["v"] or 0.0
            expected.append(total)
        assert [x[2] for x in found if x[0] == k] == expected
