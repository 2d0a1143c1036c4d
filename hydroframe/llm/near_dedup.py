"""MinHash near-dedup with HyperMinHash registers.

A document is the set of its distinct shingles (4 or 5 lower-cased words).  Its sketch has 128 buckets; a bucket keeps
the least hash that fell into it as a HyperMinHash register of 16 bits, the number of leading zeros and the next ten
bits.  Empty buckets borrow from a random non-empty one (each bucket has its own fixed order to look in), so small sets
have full sketches too.  Four registers make a band; documents that share one of the 32 bands are candidates (a pair of
similarity 0.8 is missed with a probability of about 5e-8).

Documents of equal sets are one class, whose smallest id stands for it; only class representatives are compared.  A band
bucket of up to `small` members gives all its pairs.  A larger one compares its members to one pivot, the member with the
smallest share of shingles that no other document of large buckets has, which in a group of copies is the original or
nearest to it.  All members of a pivot's buckets that are now in another component make its bucket of the next turn,
which is treated alike, TURNS times at most.

A link can then still hide between a member x outside the component of its pivot and one inside, or between two of the
last turn's bucket.  For these, all buckets whose pivots are in one component are taken together and their members
compared to one of the pivots.  Let o be the shingles that x shares with it, and c the intersection that a pair needs by
its sizes.  If o < c, the two must share at least c - o shingles that the pivot lacks: they meet at one of the rarest of
these, if enough of them follow it in both (prefix and positional filter); shingles that one document alone has are left
out beforehand.  Other pairs can only be those with a document
so small that o >= c; they meet by size.  So no link between components is lost, and what a bucket gives is bounded by
what its members share beyond the pivot, not by the square of its size.  Buckets that hold a large part of all rows, and
pivots with many members, are spread over tasks.

Candidate pairs are screened by the collision-corrected Jaccard estimate, far below the threshold (`slack`, over five
standard deviations), and confirmed on full sets.  Components come from the confirmed links by rounds of hooking (each
root, and each id, takes the least grandparent among its neighbours) and jumping, between tables written to the shared
folder; their number grows with the logarithm of the longest chain.

Edge cases: null, empty and all-space texts have an empty set and are linked with nothing; texts of fewer words than a
shingle have one shingle, the whole sequence; ids must not be null (such rows are left out); rows that repeat an id are
classed by the first of their sets in order of digest; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import shared, words

BUCKETS, MANTISSA, BAND, SMALL, SLACK, LEAST_FOR_ESTIMATE = 128, 10, 4, 8, 0.25, 128
TURNS, MEMBERS_PER_TASK = 2, 32
U = np.uint64
_LOOK = np.stack([np.random.default_rng(1000 + k).permutation(BUCKETS) for k in range(BUCKETS)])


def shingle_sets(data: np.ndarray, ends: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of each distinct shingle, in order of row and hash."""
    begin, end, row = words.spans(data, ends)
    word = words.hashed(data, begin, end, lower=True)
    whole, at = words.runs(word, row, k)
    rows = row[at]
    count = np.bincount(row, minlength=len(ends) - 1)
    few = np.flatnonzero((count > 0) & (count < k))
    if len(few):
        start = np.searchsorted(row, few)
        total = np.zeros(len(few), U)
        for i in range(k - 1):
            has = count[few] > i
            total[has] += word[start[has] + i] * words.PLACES[i + 32]
        rows = np.concatenate([rows, few])
        whole = np.concatenate([whole, words.mix(total ^ count[few].astype(U))])
    order = np.lexsort((whole, rows))
    rows, whole = rows[order], whole[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (whole[1:] != whole[:-1])
    return rows[new], whole[new]


def registers(rows: np.ndarray, hashes: np.ndarray, n_rows: int) -> np.ndarray:
    """HyperMinHash sketches of n_rows sets; those of empty sets are zero."""
    bucket = (hashes >> U(57)).astype(np.int64)
    key = rows * BUCKETS + bucket
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    rest = (hashes[first] & U((1 << 57) - 1)) >> U(4)
    length = np.frexp(rest.astype(np.float64))[1]
    shift = length - 1 - MANTISSA
    high = np.where(shift >= 0, rest >> np.maximum(shift, 0).astype(U), rest << np.maximum(-shift, 0).astype(U))
    sketch = np.zeros(n_rows * BUCKETS, np.uint16)
    filled = np.zeros(n_rows * BUCKETS, bool)
    sketch[key[first]] = ((53 - length).astype(np.uint16) << np.uint16(MANTISSA)) | (high.astype(np.uint16) & np.uint16((1 << MANTISSA) - 1))
    filled[key[first]] = True
    sketch, filled = sketch.reshape(n_rows, BUCKETS), filled.reshape(n_rows, BUCKETS)
    for at in np.array_split(np.flatnonzero(~filled.all(axis=1) & filled.any(axis=1)), max(1, n_rows // 256)):
        if len(at):
            source = _LOOK[np.arange(BUCKETS), filled[at][:, _LOOK].argmax(axis=2)]
            lent = np.take_along_axis(sketch[at], source, axis=1)
            sketch[at] = np.where(filled[at], sketch[at], lent)
    return sketch


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard similarity from two sketches (rows of registers), corrected for registers that agree by chance."""
    chance = 1 / 3 / (1 << MANTISSA)
    return ((a == b).mean(axis=-1) - chance) / (1 - chance)


def sketches(rows: DataFrame, k: int) -> DataFrame:
    """id, n_shingles, set digest (d1, d2) and sketch (256 bytes) of every row of id and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in shared.parts(batch, 1):
                data, ends = shared.text_bytes(part.column(1))
                rows, hashes = shingle_sets(data, ends, k)
                n = len(ends) - 1
                digests = []
                for salt in (U(0x1234567), U(0x89ABCDE0F)):
                    total = np.zeros(n, U)
                    np.add.at(total, rows, words.mix(hashes ^ salt))
                    digests.append(pa.array(total.view(np.int64)))
                sketch = registers(rows, hashes, n)
                yield pa.record_batch([part.column(0), pa.array(np.bincount(rows, minlength=n).astype(np.int64)), *digests, pa.array([s.tobytes() for s in sketch], pa.binary())], names)

    names = ["id", "n_shingles", "d1", "d2", "sketch"]
    return rows.mapInArrow(run, "id bigint, n_shingles bigint, d1 bigint, d2 bigint, sketch binary")


def full_sets(rows: DataFrame, k: int) -> DataFrame:
    """id and its sorted distinct shingle hashes as bytes, of rows of id and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in shared.parts(batch, 1):
                data, ends = shared.text_bytes(part.column(1))
                rows, hashes = shingle_sets(data, ends, k)
                cut = np.searchsorted(rows, np.arange(len(ends)))
                yield pa.record_batch([part.column(0), pa.array([hashes[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary())], ["id", "shingles"])

    return rows.mapInArrow(run, "id bigint, shingles binary")


def buckets(reps: DataFrame) -> DataFrame:
    """band (a key), id, n_shingles and m, the members of the bucket, for buckets of two and more."""
    n = BUCKETS // BAND
    keys = F.expr(f"transform(sequence(0, {n - 1}), b -> xxhash64(b, substring(sketch, b * {2 * BAND} + 1, {2 * BAND})))")
    return counted(reps.select("id", "n_shingles", F.explode(keys).alias("band")))


def counted(bands: DataFrame) -> DataFrame:
    """bands with m, the members of the bucket, for buckets of two and more."""
    sizes = bands.groupBy("band").agg(F.count("*").alias("m"), shared.salts("id")).where("m > 1")
    return shared.by_key(bands, sizes, ["band"], "id")


def screened(pairs: DataFrame, reps: DataFrame, threshold: float, slack: float = SLACK) -> DataFrame:
    """Pairs (a, b) whose sizes and sketches allow the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(-1, BUCKETS) for k in (2, 3))
            small = np.minimum(*(batch.column(k).to_numpy() for k in (4, 5)))
            good = (small < LEAST_FOR_ESTIMATE) | (estimate(a, b) >= threshold - slack)
            yield batch.select([0, 1]).filter(pa.array(good))

    side = [reps.select(F.col("id").alias(x), F.col("sketch").alias(f"sketch_{x}"), F.col("n_shingles").alias(f"n_{x}")) for x in "ab"]
    both = pairs.join(side[0], "a").join(side[1], "b").where(F.least("n_a", "n_b") >= threshold * F.greatest("n_a", "n_b") - 1e-9)
    return both.select("a", "b", "sketch_a", "sketch_b", "n_a", "n_b").mapInArrow(run, "a bigint, b bigint")


def compared(pairs: DataFrame, sets: DataFrame, rest: bool = False) -> DataFrame:
    """a, b, n_a, n_b, common and, if asked for, rest (shingles of b that a lacks) of pairs (a, b), on full sets.

    The set of a comes first in its sorted partition and the sets it is compared to follow, one at a time in memory.  An a
    of many pairs is dealt to several tasks, its set to each of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, None
        for batch in batches:
            found = []
            for a, part, b, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = np.frombuffer(raw, U)
                if b is None:
                    now, held = (a, part), own
                elif (a, part) == now:
                    other = np.setdiff1d(own, held, assume_unique=True)
                    found.append((a, b, len(held), len(own), len(own) - len(other), other.tobytes() if rest else None))
            kinds = [*[pa.int64()] * 5, pa.binary()]
            yield pa.record_batch([pa.array([x[k] for x in found], kind) for k, kind in enumerate(kinds)], ["a", "b", "n_a", "n_b", "common", "rest"])

    n = shared.partitions(pairs.sparkSession)
    pairs = shared.written(pairs.select("a", "b"), "pairs")
    counts = pairs.groupBy("a").agg(F.count("*").alias("m")).where(F.col("m") > MEMBERS_PER_TASK)
    dealt = pairs.join(shared.sized(counts), "a", "left").select("a", "b", F.coalesce(F.pmod(F.xxhash64("b"), F.expr(f"m div {MEMBERS_PER_TASK}")), F.lit(0)).alias("part"))
    follow = dealt.join(sets.withColumnRenamed("id", "b"), "b").select("a", "part", "b", "shingles")
    lead = dealt.select("a", "part").distinct().join(sets.withColumnRenamed("id", "a"), "a").select("a", "part", F.lit(None).cast("long").alias("b"), "shingles")
    ordered = lead.unionByName(follow).repartition(n, "a", "part").sortWithinPartitions("a", "part", F.asc_nulls_first("b"))
    return ordered.mapInArrow(run, "a bigint, b bigint, n_a bigint, n_b bigint, common bigint, rest binary")


def linked(percent: int):
    return 100 * F.col("common") >= percent * (F.col("n_a") + F.col("n_b") - F.col("common"))


def level(n: Column, percent: int) -> Column:
    """Sizes that a link allows lie at most one level apart."""
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(100 / percent)) + 1e-9).cast("long")


def hidden_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of members of one pivot, in different components, that may still be linked.

    members: a (the pivot), id, label, lone (1 outside the component of the pivot), final (1 in a bucket of the last turn),
    n and o (its shingles, and those it shares with the pivot) and rest (those it does not).
    """
    members = shared.written(members.withColumn("level", level(F.col("n"), percent)), "members")
    lone = members.where("lone = 1")
    least = F.ceil(F.col("n") * percent / F.lit(100.0) - 1e-9)
    may = (F.col("label") != F.col("label_y")) & ((F.col("lone_y") == 0) | (F.col("final") + F.col("final_y") == 2))
    near = F.least("n", "n_y") * 100 >= percent * F.greatest("n", "n_y")
    around = F.explode(F.array(*[F.col("level") + i for i in (-1, 0, 1)]))
    named = [F.col(c).alias(f"{c}_y") for c in ("label", "lone", "final", "n", "o")]

    tiny = lone.where(F.col("o") >= least).select("a", "id", "label", "final", "n", "o", around.alias("level"))
    small = tiny.join(members.select("a", "level", F.col("id").alias("y"), *named), ["a", "level"])
    small = small.where(may & near & (F.col("o") * (100 + percent) >= percent * (F.col("n") + F.col("n_y")))).select("id", "y")

    # Only members of a size that some lone one of their pivot could be linked with.
    useful = lone.select("a", around.alias("level")).distinct()
    tokens = shingles_of(members.join(useful, ["a", "level"], "left_semi").select("a", "id", "label", "lone", "final", "n", "o", "rest"))
    tokens = shared.written(tokens, "rest-shingles")
    often = tokens.groupBy("a", "h").agg(F.count("*").alias("df"), F.max("lone").alias("any")).where("df > 1 and any = 1")
    by = Window.partitionBy("a", "id")
    # Of the s shared shingles of a member, `after` come after this one, the rarest first.
    tokens = tokens.join(often, ["a", "h"]).withColumn("after", F.count("*").over(by) - F.row_number().over(by.orderBy("df", "h")))
    tokens = shared.written(tokens, "shared-shingles")
    need = F.greatest(least - F.col("o"), F.lit(1))
    x = tokens.where((F.col("lone") == 1) & (F.col("after") + 1 >= need)).select("a", "h", "id", "label", "final", "n", "o", "after")
    y = tokens.select("a", "h", F.col("id").alias("y"), F.col("after").alias("after_y"), *named)
    # The first shingle that a pair shares leaves room for all it needs; at later ones it may be passed over.
    room = (F.least("o", "o_y") + 1 + F.least("after", "after_y")) * (100 + percent) >= F.lit(percent) * (F.col("n") + F.col("n_y"))
    meet = x.join(y, ["a", "h"]).where(may & near & room).select("id", "y")
    return small.unionByName(meet).select(F.least("id", "y").alias("a"), F.greatest("id", "y").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """id and label (the smallest id that can be reached) of every id of the edges (a, b).

    f is the parent of an id and g the parent of that.  Each round, an id and its parent take the least g among the id's
    neighbours if it is smaller, and the id takes its own g; it ends with the round that changes nothing.
    """
    both = shared.written(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")

    def with_parents(parents: DataFrame) -> DataFrame:
        up = parents.select(F.col("id").alias("f"), F.col("f").alias("g"))
        return shared.written(parents.join(up, "f"), "labels")

    now = with_parents(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("id"), F.least("a", "b").alias("f")))
    while True:
        near = both.join(now.select(F.col("id").alias("b"), "g"), "b").groupBy("a").agg(F.min("g").alias("low"))
        near = now.join(near.withColumnRenamed("a", "id"), "id")
        own = near.select("id", F.least("low", "g").alias("to"), F.col("f").alias("was_f"), F.col("g").alias("was_g"))
        hooked = near.where("low < g").select(F.col("f").alias("id"), F.col("low").alias("to"), F.lit(None).cast("long").alias("was_f"), F.lit(None).cast("long").alias("was_g"))
        step = own.unionByName(hooked).groupBy("id").agg(F.min("to").alias("f"), F.max("was_f").alias("was_f"), F.max("was_g").alias("was_g"))
        now = with_parents(step)
        if not now.where("f <> was_f or g <> was_g").limit(1).count():
            return now.select("id", F.col("f").alias("label"))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", small: int = SMALL, slack: float = SLACK, turns: int = TURNS) -> DataFrame:
    """id, n_shingles, component_id and kept of every document with an id."""
    threshold = percent / 100
    rows = docs.select(F.col(id_col).cast("long").alias("id"), shared.text_or_empty(text_col).alias("text")).where("id is not null")
    each = shared.written(sketches(rows, k), "sketches")
    classes = each.where("n_shingles > 0").groupBy("d1", "d2", "n_shingles").agg(F.min("id").alias("id"), F.min("sketch").alias("sketch"), shared.salts("id"))
    reps = shared.written(classes, "classes")
    bucket = shared.written(buckets(reps), "buckets")

    sets = full_sets(rows.join(shared.sized(bucket.select("id").distinct()), "id", "left_semi"), k)
    sets = shared.written(sets.groupBy("id").agg(F.max("shingles").alias("shingles")), "sets")
    dense = shared.written(shared_parts(sets.join(bucket.where(F.col("m") > small).select("id").distinct(), "id", "left_semi")), "shared-parts")

    def confirmed(pairs: DataFrame) -> DataFrame:
        return compared(screened(pairs, reps, threshold, slack), sets).where(linked(percent)).select("a", "b")

    links, labels, stars = None, None, []
    for turn in range(turns):
        few = bucket.where(F.col("m") <= small).select("band", F.col("id").alias("a"), "n_shingles")
        other = few.select("band", F.col("a").alias("b"), F.col("n_shingles").alias("n_b"))
        near = F.least("n_shingles", "n_b") >= threshold * F.greatest("n_shingles", "n_b") - 1e-9
        found = confirmed(few.join(other, "band").where((F.col("a") < F.col("b")) & near).select("a", "b").distinct())
        many = bucket.where(F.col("m") > small)
        if more := many.limit(1).count():
            best = F.min(F.struct("share", "id"))
            pivots = shared.written(many.join(dense.select("id", "share"), "id").groupBy("band").agg(best.alias("p"), shared.salts("id")), "pivots")
            members = shared.by_key(many.drop("m"), pivots.select("band", F.col("p.id").alias("a"), "salts"), ["band"], "id")
            members = shared.written(members.where("id <> a").select("a", "id", "n_shingles").distinct(), "stars")
            star = compared(members.select("a", F.col("id").alias("b")), sets).where(linked(percent)).select("a", "b")
            found = found.unionByName(star)
        found = shared.written(found, "links")
        links = found if links is None else links.unionByName(found)
        labels = components(links)
        if not more:
            break
        stars.append(members.select("a", "id", F.lit(int(turn == turns - 1)).cast("long").alias("final")))
        if turn < turns - 1:
            bucket = with_home(members, labels).where("label <> home").select(F.col("a").alias("band"), "id", "n_shingles")
            bucket = shared.written(counted(shared.written(bucket, "outside")), "buckets")
            if not bucket.limit(1).count():
                break

    if stars:
        every = stars[0]
        for more in stars[1:]:
            every = every.unionByName(more)
        hidden = _hidden(every, labels, dense, percent)
        if hidden is not None:
            more = shared.written(confirmed(hidden), "links")
            if more.limit(1).count():
                labels = components(links.unionByName(more))

    named = reps.join(labels, "id", "left").select("d1", "d2", "n_shingles", "salts", F.coalesce("label", "id").alias("class"))
    out = shared.by_key(each.drop("sketch"), named, ["d1", "d2", "n_shingles"], "id", "left")
    component = F.coalesce("class", "id")
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), (component == F.col("id")).alias("kept"))


def with_label(rows: DataFrame, labels: DataFrame, column: str, name: str) -> DataFrame:
    """rows with the label of the id in a column: the id itself if it has no link."""
    return rows.join(labels.select(F.col("id").alias(column), F.col("label").alias(name)), column, "left").withColumn(name, F.coalesce(name, column))


def with_home(members: DataFrame, labels: DataFrame) -> DataFrame:
    """members (a, a pivot, and id) with label and home, the component of the pivot; pivots are few, members of one many."""
    homes = with_label(members.select("a").distinct(), labels, "a", "home")
    return with_label(members, labels, "id", "label").join(shared.sized(homes), "a")


def _hidden(stars: DataFrame, labels: DataFrame, dense: DataFrame, percent: int) -> DataFrame | None:
    """Pairs that may be links still hidden behind the pivots, or None; stars: a (pivot), id and final of each turn."""
    stars = shared.written(with_home(stars, labels).withColumn("lone", (F.col("label") != F.col("home")).cast("long")), "homes")
    # Without a member inside, or a bucket of the last turn, all that a home has was compared to its pivots.
    homes = stars.groupBy("home").agg(F.max("lone").alias("lone"), F.min("lone").alias("inside"), F.max(F.col("lone") + F.col("final")).alias("last"))
    homes = homes.where("lone = 1 and (inside = 0 or last = 2)").select("home")
    if not homes.limit(1).count():
        return None
    stars = stars.join(shared.sized(homes), "home", "left_semi")
    best = F.min(F.struct("share", "id"))
    pivots = stars.select("home", F.col("a").alias("id")).distinct().join(dense.select("id", "share"), "id").groupBy("home").agg(best["id"].alias("a"))
    members = stars.groupBy("home", "id", "label", "lone").agg(F.max("final").alias("final")).join(shared.sized(pivots), "home").where("id <> a").drop("home")
    members = shared.written(members.join(dense.select("id", "n"), "id"), "homes")
    against = compared(members.select("a", F.col("id").alias("b")), dense.select("id", "shingles"), rest=True)
    return hidden_pairs(members.join(against.select("a", F.col("b").alias("id"), F.col("common").alias("o"), "rest"), ["a", "id"]), percent)


def shingles_of(rows: DataFrame) -> DataFrame:
    """The columns of rows but for the last, `rest`, and h: one row for each hash in it; the columns are bigint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in shared.parts(batch, len(names)):
                raw, ends = shared.text_bytes(part.column(len(names)))
                count = (ends[1:] - ends[:-1]) // 8
                yield pa.record_batch([*(pa.array(np.repeat(part.column(k).to_numpy(), count)) for k in range(len(names))), pa.array(raw.view(np.int64))], [*names, "h"])

    names = rows.columns[:-1]
    return rows.mapInArrow(run, ", ".join(f"{n} bigint" for n in [*names, "h"]))


def shared_parts(sets: DataFrame) -> DataFrame:
    """id, n (shingles), share (the part of them that no other row of sets has) and shingles (the others) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for raw, alone in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                own = np.frombuffer(raw, U)
                left = np.setdiff1d(own, np.array(alone or [], np.int64).view(U), assume_unique=True)
                found.append((len(own), 1 - len(left) / max(1, len(own)), left.tobytes()))
            yield pa.record_batch([batch.column(0), *(pa.array([x[k] for x in found], kind) for k, kind in enumerate((pa.int64(), pa.float64(), pa.binary())))], ["id", "n", "share", "shingles"])

    each = shingles_of(sets.select("id", F.col("shingles").alias("rest")))
    alone = each.groupBy("h").agg(F.count("*").alias("n"), F.min("id").alias("id")).where("n = 1")
    alone = alone.groupBy("id").agg(F.collect_list("h").alias("alone"))
    return sets.join(alone, "id", "left").select("id", "shingles", "alone").mapInArrow(run, "id bigint, n bigint, share double, shingles binary")
