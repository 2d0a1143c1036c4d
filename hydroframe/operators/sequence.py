"""Helpers for ordered series that keep one long series from landing in one task.

`carry` fills forward or backward over any distance: within time buckets by a window, between buckets by the one
value that each bucket passes on.  `in_row_blocks` runs operators that look a bounded number of rows around on blocks of
rows, the rows at a block's edges copied.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..streaming.run import folder

#: Width of a time bucket if none is given: one day in microseconds.
BUCKET_US = 86_400_000_000


def joined(df: DataFrame, other: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on keys of which nulls are equal to each other, as they are in a window."""
    named = other.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys], F.lit(True))
    return df.join(named, on, how).drop(*[f"_k_{k}" for k in keys])


def carry(df: DataFrame, keys: list[str], us: str, order: list[str], values: dict[str, Column], backward: bool = False, strict: bool = False, bucket_us: int = BUCKET_US) -> DataFrame:
    """Add columns: the last (or, backward, the next) non-null of each value at or before (after) the row.

    strict leaves out the row itself.  Order: us, then `order`.  Values must be struct or scalar columns.
    """
    bucket = F.floor(F.col(us) / bucket_us)
    df = df.withColumns({"_bucket": bucket, **{f"_v_{n}": v for n, v in values.items()}})
    sort = [us, *order]
    # Backward runs down the order: a frame that grows from its first row is kept up row by row, one that shrinks is not.
    turned = F.desc if backward else F.asc
    w = Window.partitionBy(*keys, "_bucket").orderBy(*[turned(c) for c in sort]).rowsBetween(Window.unboundedPreceding, -1 if strict else 0)
    inside = df.withColumns({f"_in_{n}": F.last(f"_v_{n}", ignorenulls=True).over(w) for n in values})
    place = F.struct(*sort)
    edge = F.min_by if backward else F.max_by
    passed = df.groupBy(*keys, "_bucket").agg(*[edge(f"_v_{n}", F.when(F.col(f"_v_{n}").isNotNull(), place)).alias(f"_p_{n}") for n in values])
    over = Window.partitionBy(*keys).orderBy(turned("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    passed = passed.select(*keys, "_bucket", *[F.last(f"_p_{n}", ignorenulls=True).over(over).alias(f"_c_{n}") for n in values])
    out = joined(inside, passed, [*keys, "_bucket"], "left").withColumns({n: F.coalesce(f"_in_{n}", f"_c_{n}") for n in values})
    return out.drop("_bucket", *[f"{p}{n}" for n in values for p in ("_v_", "_in_", "_c_")])


def numbered(df: DataFrame, keys: list[str], us: str, order: list[str], bucket_us: int = BUCKET_US) -> DataFrame:
    """Add `_i`, the number of each row in its key's order (us, then `order`), from 0: counted per bucket, then summed up."""
    df = df.withColumn("_bucket", F.floor(F.col(us) / bucket_us))
    own = F.row_number().over(Window.partitionBy(*keys, "_bucket").orderBy(us, *order)) - 1
    before = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    counts = df.groupBy(*keys, "_bucket").agg(F.count("*").alias("_n")).select(*keys, "_bucket", F.coalesce(before, F.lit(0)).alias("_before"))
    return joined(df, counts, [*keys, "_bucket"]).withColumn("_i", own + F.col("_before")).drop("_bucket", "_before")


def cumulated(df: DataFrame, keys: list[str], us: str, order: list[str], sums: dict[str, Column], bucket_us: int = BUCKET_US) -> DataFrame:
    """Add columns: the sum of each value over the rows up to this one, counted per bucket, then summed up."""
    df = df.withColumns({"_bucket": F.floor(F.col(us) / bucket_us), **{f"_v_{n}": v for n, v in sums.items()}})
    own = Window.partitionBy(*keys, "_bucket").orderBy(us, *order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*keys, "_bucket").agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums])
    totals = totals.select(*keys, "_bucket", *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_b_{n}") for n in sums])
    inside = df.withColumns({n: F.sum(f"_v_{n}").over(own) for n in sums})
    out = joined(inside, totals, [*keys, "_bucket"]).withColumns({n: F.coalesce(n, F.lit(0)) + F.col(f"_b_{n}") for n in sums})
    return out.drop("_bucket", *[f"{p}{n}" for n in sums for p in ("_v_", "_b_")])


def extremes(df: DataFrame, keys: list[str], us: str, order: list[str], values: dict[str, tuple[str, Column, bool]], bucket_us: int = BUCKET_US) -> DataFrame:
    """Add columns: the least or greatest of each value over all rows before this one, or after it.

    values: name to ("min" or "max", value, whether after).  Found per bucket, then from the values that each bucket passes on.
    """
    df = df.withColumns({"_bucket": F.floor(F.col(us) / bucket_us), **{f"_v_{n}": v for n, (_, v, _) in values.items()}})

    def window(by: list[str], along: list[str], after: bool):
        turned = F.desc if after else F.asc
        return Window.partitionBy(*by).orderBy(*[turned(c) for c in along]).rowsBetween(Window.unboundedPreceding, -1)

    of = {n: (F.min, F.least) if kind == "min" else (F.max, F.greatest) for n, (kind, _, _) in values.items()}
    passed = df.groupBy(*keys, "_bucket").agg(*[of[n][0](f"_v_{n}").alias(f"_p_{n}") for n in values])
    passed = passed.select(*keys, "_bucket", *[of[n][0](f"_p_{n}").over(window(keys, ["_bucket"], after)).alias(f"_b_{n}") for n, (_, _, after) in values.items()])
    inside = df.withColumns({n: of[n][0](f"_v_{n}").over(window([*keys, "_bucket"], [us, *order], after)) for n, (_, _, after) in values.items()})
    out = joined(inside, passed, [*keys, "_bucket"]).withColumns({n: of[n][1](n, f"_b_{n}") for n in values})
    return out.drop("_bucket", *[f"{p}{n}" for n in values for p in ("_v_", "_b_")])


def settled(df: DataFrame) -> DataFrame:
    """Written to the shared folder and read back: a frame that several later steps read is made once."""
    path = folder(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ranked(df: DataFrame, column: str) -> DataFrame:
    """Add `_i`, the number of each row in the order of a column of any type, from 0: by a range sort and counts per partition."""
    ordered = df.repartitionByRange(column).sortWithinPartitions(column)
    ordered = settled(ordered.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}))
    before = F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    # A row for each partition.
    counts = ordered.groupBy("_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first")).select("_part", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"))
    return ordered.join(counts, "_part").withColumn("_i", F.col("_at") + F.col("_shift")).drop("_part", "_at", "_shift")


def in_row_blocks(df: DataFrame, keys: list[str], us: str, order: list[str], before: int, after: int, fn: Callable[[DataFrame, list[str], list[str]], DataFrame], block_rows: int = 1 << 17) -> DataFrame:
    """Run an operator that looks at most `before` rows back and `after` rows ahead on blocks of one long series.

    Rows near the edge of a block are copied into the next one, the operator fn(frame, keys, order) works per block, and
    only a block's own rows are kept.  So one logger's series is spread over tasks, with the results of the whole.
    """
    rows = numbered(df, keys, us, order)
    first, last = F.floor((F.col("_i") - after) / block_rows), F.floor((F.col("_i") + before) / block_rows)
    copies = rows.withColumn("_block", F.explode(F.sequence(F.greatest(first, F.lit(0)), last)))
    done = fn(copies, [*keys, "_block"], ["_i"])
    return done.where(F.col("_block") == F.floor(F.col("_i") / block_rows)).drop("_block", "_i")


def islands(df: DataFrame, keys: list[str], order: list[str], flag: Column, bucket_us: int = BUCKET_US) -> DataFrame:
    """Add `island`: a number per key for each run of rows with the same flag; the first of `order` is a number."""
    df = carry(df, keys, order[0], order[1:], {"_was": F.struct(flag.alias("flag"))}, strict=True, bucket_us=bucket_us)
    change = F.when(F.col("_was").isNotNull() & flag.eqNullSafe(F.col("_was.flag")), 0).otherwise(1)
    return cumulated(df, keys, order[0], order[1:], {"island": change}, bucket_us).drop("_was")
