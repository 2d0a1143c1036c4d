"""Mixing sources to target weights by Pfair scheduling, in DataFrame and SQL functions only.

Documents of a source are laid out in the order of md5(id) and cut into blocks of `block_chars` characters; a document
belongs to the block in which it begins.  With a share w of all weights, block j of a source, counted from 0, is released
at floor(j / w) and has its deadline at ceil((j + 1) / w); in each slot the released block with the earliest deadline runs.
This never misses a deadline, so after any number of slots before the first source runs dry each source is less than one
block away from its target.  A source that runs dry leaves, and the others go on by their weights: every block gets a slot.

The schedule is one SQL fold over all blocks, which is sequential by definition: one task, time in proportion to blocks
times the root of the number of sources, about a hundred bytes a source and a few a block.  So that it doesn't grow without bound, blocks are larger than `block_chars` where
the characters would make more than `most_blocks` of them: then a block is that part of the corpus.  A source has one
block at least, whatever its size, and no number of sources is too large.

Prefix sums run per (source, hash bucket) with the sums of buckets added, so a hot source is spread over all tasks.

`in_mix` ends where the first source runs out of blocks; rows beyond it are returned too, with their slot.  Without given
weights, a source weighs its characters to the power `exponent`.

Edge cases: a null source is the source ''; null and empty texts have 0 characters; a null id sorts first; rows that repeat
an id are laid out one after another; with given weights, other sources have no slot and in_mix false.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import shared

BLOCK_CHARS, MOST_BLOCKS, EXPONENT = 1 << 16, 1 << 19, 0.7
#: Sources whose slots are broadcast; of more, a join by source deals them.
MOST_BROADCAST = 20_000


def weigh(sizes: DataFrame, weights: dict[str, float] | None, exponent: float) -> DataFrame:
    """source, chars and w of each source with a weight; sizes: source, chars."""
    if weights is None:
        return sizes.select("source", "chars", F.pow(F.greatest(F.col("chars"), F.lit(1)).cast("double"), F.lit(exponent)).alias("w"))
    given = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair]) if weights else F.create_map().cast("map<string,double>")
    return sizes.select("source", "chars", given[F.col("source")].cast("double").alias("w")).where("w > 0")


def schedule(weighed: DataFrame, block_chars: int) -> DataFrame:
    """source, pace (slots from one block to the next), slots (of all its blocks).

    The fold keeps the next block of each source that has one, in buckets of about the root of their number.  A bucket knows the
    earliest deadline of its released blocks and when the next of the others is released; a slot looks at every bucket, and
    into those where a block is released or runs.  Besides it keeps the blocks run and the weight of these sources, and where
    each slot went: a list of lists, as appending copies the list.
    """
    n = F.greatest(F.expr(f"(chars + {block_chars - 1}) div {block_chars}"), F.lit(1)).cast("int").alias("n")
    ordered = weighed.select("source", F.col("w").cast("double").alias("w"), n).agg(F.array_sort(F.collect_list(F.struct("source", "w", "n"))).alias("s"))
    ordered = ordered.where("size(s) > 0").select("s", F.expr("aggregate(s, 0D, (a, x) -> a + x.w)").alias("w"), F.expr("aggregate(s, 0L, (a, x) -> a + x.n)").alias("blocks"), F.expr("cast(ceil(sqrt(size(s))) as int)").alias("z"))
    step, job = 1000, "struct<deadline:double,release:double,i:int,k:int>"
    buckets = f"array<struct<best:{job},wake:double,jobs:array<{job}>>>"
    begin = f"""cast(transform(sequence(0, (size(s) - 1) div z), g -> named_struct('best', null, 'wake', -1D,
        'jobs', transform(slice(s, cast(g * z + 1 as int), z), (x, o) -> named_struct('deadline', 1 / x.w, 'release', 0D, 'i', cast(g * z + o as int), 'k', 0)))) as {buckets})"""
    # A block is released in slot t if its release is below t + 1; without ones run dry, t is the sum of blocks run.  That time never
    # falls, so a bucket's earliest deadline holds until a block in it is released or runs.
    woken = """transform(a.buckets, b -> if(b.wake < v, named_struct('best', array_min(filter(b.jobs, x -> x.release < v)),
        'wake', coalesce(array_min(transform(filter(b.jobs, x -> x.release >= v), x -> x.release)), double('infinity')), 'jobs', b.jobs), b))"""
    chosen = "coalesce(array_min(transform(c, b -> b.best)), array_min(transform(c, b -> array_min(b.jobs))))"
    after = "named_struct('deadline', (p.k + 2) / s[p.i].w, 'release', (p.k + 1) / s[p.i].w, 'i', p.i, 'k', p.k + 1)"
    left = f"""transform(c, (b, o) -> if(o = p.i div z, named_struct('best', cast(null as {job}), 'wake', -1D,
        'jobs', if(p.k + 1 >= s[p.i].n, filter(b.jobs, x -> x.i != p.i), transform(b.jobs, x -> if(x.i = p.i, {after}, x)))), b))"""
    one = f"""transform(array((a.ran + 1) / a.w), v -> transform(array({woken}), c -> transform(array({chosen}), p -> named_struct(
        'buckets', {left}, 'ran', if(p.k + 1 >= s[p.i].n, a.ran - p.k, a.ran + 1), 'w', if(p.k + 1 >= s[p.i].n, a.w - s[p.i].w, a.w), 'out', array_append(a.out, p.i)))[0])[0])[0]"""
    fold = f"""
        aggregate(sequence(0L, (blocks - 1) div {step}),
          named_struct('buckets', {begin}, 'ran', 0L, 'w', w, 'lists', cast(array() as array<array<int>>)),
          (o, c) -> transform(array(aggregate(sequence(1, cast(least({step}, blocks - c * {step}) as int)),
              named_struct('buckets', o.buckets, 'ran', o.ran, 'w', o.w, 'out', cast(array() as array<int>)), (a, t) -> {one})),
            a -> named_struct('buckets', a.buckets, 'ran', a.ran, 'w', a.w, 'lists', array_append(o.lists, a.out)))[0],
          o -> flatten(o.lists))"""
    slots = ordered.select("s", "w", F.posexplode(F.expr(fold)).alias("slot", "i"))
    slots = slots.select(F.expr("s[i].source").alias("source"), F.expr("w / s[i].w").alias("pace"), F.col("slot").cast("long").alias("slot"))
    return slots.groupBy("source").agg(F.first("pace").alias("pace"), F.sort_array(F.collect_list("slot")).alias("slots"))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, block_chars: int = BLOCK_CHARS, most_blocks: int = MOST_BLOCKS, exponent: float = EXPONENT, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """id, source, block, release, deadline, slot and in_mix of every document."""
    source = F.coalesce(F.col(source_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), source.alias("source"), F.coalesce(F.length(text_col), F.lit(0)).cast("long").alias("chars"))
    rows = shared.written(rows, "sizes")
    rows = rows.withColumn("place", F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary"))).withColumn("bucket", F.substring("place", 1, 3))
    order = Window.partitionBy("source", "bucket").orderBy("place", "id", "chars")
    within = rows.withColumn("within", F.sum("chars").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("chars"))

    sums = rows.groupBy("source", "bucket").agg(F.sum("chars").alias("chars"))
    before = F.sum("chars").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sums.select("source", "bucket", F.coalesce(before, F.lit(0)).alias("before"))
    total = sums.agg(F.sum("chars")).first()[0] or 0
    block_chars = max(block_chars, -(-total // most_blocks))
    placed = within.join(offsets, ["source", "bucket"]).withColumn("block", F.expr(f"(before + within) div {block_chars}"))

    weighed = weigh(sums.groupBy("source").agg(F.sum("chars").alias("chars")), weights, exponent)
    held = shared.written(schedule(weighed, block_chars), "schedule")
    horizon = held.agg(F.min(F.array_max("slots") + 1)).first()[0]
    # Slots are 8 bytes a block, of which there are most_blocks at most and one for each source.
    found = placed.join(shared.sized(held, MOST_BROADCAST), "source", "left")
    # Empty texts behind the last character lie in the last block.
    found = found.withColumn("block", F.coalesce(F.least("block", F.size("slots").cast("long") - 1), "block"))
    slot = F.expr("slots[cast(block as int)]")
    return found.select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "block",
        F.floor(F.col("block") * F.col("pace")).alias("release"), F.ceil((F.col("block") + 1) * F.col("pace")).alias("deadline"),
        slot.alias("slot"), F.coalesce(slot < F.lit(horizon).cast("long"), F.lit(False)).alias("in_mix"),
    )
