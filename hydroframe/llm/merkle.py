"""Merkle manifest of a dataset, upper proofs by a butterfly exchange.

A leaf is the digest of a row; the leaves of a group, in order, are hashed in runs of `fanout` until one node, the subroot,
is left; the subroots, in order of their groups, are hashed likewise to the root.  H is lowercase hex SHA-256 of inputs
joined together, digests as hex text.

Leaves get their place by one range sort and counts per partition.  A partition of a tree is an aligned block of
fanout ** `depth` leaves, a subtree whose root one task hashes.  Then come the rounds: in round r each block sends the
node it has, its ancestor at that level, to the blocks of its aligned group whose number differs from its own in digit r
only (to the base of the fanout), so each block gets its ancestor's siblings, hashes the next ancestor itself and keeps the
siblings as its upper proof.  Every ancestor is hashed by all the blocks below it, and nothing is passed down.  At the ragged
end of a tree, where a partner does not exist, the blocks of that subtree stand in for it in turns.  Each round is a
shuffle of a row for each block and partner; there are as many as digits.  At last each block makes the proofs of its leaves.

A proof is `siblings`, one string of joined digests for each level, and `path`, how many of them stand before the node.

Edge cases: a null column is hashed as `-`, an empty text as `0:`; a null group or id sorts first; rows that repeat an id are
leaves each, ordered by their digest; a group of one leaf has no siblings (and the sum of none is H of nothing); other
columns are ignored; an empty table gives none.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import shared

FANOUT, DEPTH, HEX = 8, 4, 64
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def sha(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf(columns: list[Column]) -> Column:
    """The digest of a row: each value with its length in UTF-8 bytes before it, null as a hyphen."""
    texts = [c.cast("string") for c in columns]
    return sha(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


def joined_runs(nodes: list[str], fanout: int) -> list[str]:
    return [digest("".join(nodes[i : i + fanout])) for i in range(0, len(nodes), fanout)]


def subtree(leaves: list[str], fanout: int, depth: int, alone: bool) -> list[list[str]]:
    """The levels of a block's subtree from its leaves to its root; alone: a whole tree, which ends at one node."""
    levels = [leaves]
    while len(levels) <= depth and not (alone and len(levels[-1]) == 1):
        levels.append(joined_runs(levels[-1], fanout))
    return levels


def siblings(level: list[str], i: int, fanout: int) -> tuple[str, int]:
    """The run of node i without it, as one string, and the number of nodes before it."""
    begin = i - i % fanout
    return "".join(level[begin:i] + level[i + 1 : begin + fanout]), i - begin


def placed(rows: DataFrame, block_rows: int) -> DataFrame:
    """rows (tree, sort, leaf and others) with block, place (in the block) and blocks (of the tree); written."""
    n = shared.partitions(rows.sparkSession)
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    rows = shared.written(rows, "leaves")
    ordered = rows.repartitionByRange(n, "tree", "sort", "leaf", "row").sortWithinPartitions("tree", "sort", "leaf", "row")
    rows = shared.written(ordered.drop("row", "sort").withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}), "sorted")
    counts = rows.groupBy("tree", "part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    own = Window.partitionBy("tree")
    before = F.coalesce(F.sum("n").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # A row for each partition, and for each tree in it.
    counts = counts.select("tree", "part", (before - F.col("first")).alias("shift"), F.ceil(F.sum("n").over(own) / block_rows).alias("blocks"))
    at = F.col("at") + F.col("shift")
    out = rows.join(shared.sized(counts), ["tree", "part"])
    return out.withColumns({"block": F.floor(at / block_rows), "place": F.pmod(at, F.lit(block_rows)).cast("int")}).drop("part", "at", "shift")


def exchanged(state: DataFrame, fanout: int) -> DataFrame:
    """The rounds: tree, block, blocks and node of each block, to which siblings and path of its ancestors are added."""
    state = shared.written(state.withColumns({"siblings": F.array().cast("array<string>"), "path": F.array().cast("array<int>")}), "round")
    most, span = state.agg(F.max("blocks")).first()[0] or 0, 1
    while span < most:
        # The subtrees of this level hold `span` blocks each; block b is number b % span of subtree b div span.
        number, place, parent = F.expr(f"block div {span}"), F.expr(f"block % {span}"), F.expr(f"block div {span * fanout} * {fanout}")
        size = F.least(F.lit(span), F.col("blocks") - number * span)
        partner = F.explode(F.sequence(parent, parent + (fanout - 1))).alias("partner")
        busy, done = state.where(f"blocks > {span}"), state.where(f"blocks <= {span}")
        sent = busy.select("*", number.alias("number"), F.explode(F.sequence(place, F.lit(span - 1).cast("bigint"), size)).alias("offset"))
        sent = sent.select("*", partner).withColumn("to", F.expr(f"partner * {span} + offset")).where("to < blocks")
        own = F.when(F.col("to") == F.col("block"), F.struct("blocks", "number", "siblings", "path"))
        met = sent.groupBy("tree", "to").agg(F.first(own, ignorenulls=True).alias("own"), F.sort_array(F.collect_list(F.struct("number", "node"))).alias("run"))
        nodes = F.transform("run", lambda x: x["node"])
        others = F.transform(F.filter("run", lambda x: x["number"] != F.col("own.number")), lambda x: x["node"])
        before = F.size(F.filter("run", lambda x: x["number"] < F.col("own.number")))
        state = met.select(
            "tree", F.col("to").alias("block"), "own.blocks", sha(F.array_join(nodes, "")).alias("node"),
            F.array_append("own.siblings", F.array_join(others, "")).alias("siblings"), F.array_append("own.path", before).alias("path"),
        )
        state = shared.written(state.unionByName(done), "round")
        span *= fanout
    return state


def forest(rows: DataFrame, fanout: int = FANOUT, depth: int = DEPTH) -> tuple[DataFrame, DataFrame]:
    """Trees of leaves: rows (tree, sort, leaf and more) with their block and place, and the state of each block after the rounds.

    The node of a block in the state is the top of its tree.
    """
    rows = placed(rows, fanout**depth)

    def top(group: pd.DataFrame) -> pd.DataFrame:
        blocks = int(group["blocks"].iloc[0])
        node = subtree(group.sort_values("place")["leaf"].tolist(), fanout, depth, blocks == 1)[-1][0]
        return pd.DataFrame({"tree": [group["tree"].iloc[0]], "block": [int(group["block"].iloc[0])], "blocks": [blocks], "node": [node]})

    heads = rows.select("tree", "block", "blocks", "place", "leaf").groupBy("tree", "block").applyInPandas(top, "tree string, block bigint, blocks bigint, node string")
    return rows, exchanged(heads, fanout)


def proofs(rows: DataFrame, state: DataFrame, carried: list[str], fanout: int = FANOUT, depth: int = DEPTH) -> DataFrame:
    """carried, leaf, the columns of state but siblings, path, block and blocks, and siblings and path of every leaf of a forest."""
    kept = [c for c in state.columns if c not in ("tree", "block", "blocks", "siblings", "path")]
    fields = [rows.schema[c] for c in [*carried, "leaf"]] + [state.schema[c] for c in kept]

    def block(key, own: pd.DataFrame, upper: pd.DataFrame) -> pd.DataFrame:
        own, upper = own.sort_values("place"), upper.iloc[0]
        levels = subtree(own["leaf"].tolist(), fanout, depth, int(own["blocks"].iloc[0]) == 1)
        above, turns = list(upper["siblings"]), list(upper["path"])
        found = []
        for i in range(len(own)):
            pairs = [siblings(level, i // fanout**k, fanout) for k, level in enumerate(levels[:-1])]
            found.append(([s for s, _ in pairs] + above, [p for _, p in pairs] + turns))
        out = own[[*carried, "leaf"]].assign(**{c: upper[c] for c in kept})
        return out.assign(siblings=[s for s, _ in found], path=[p for _, p in found])

    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in fields), "siblings array<string>, path array<int>"])
    own = rows.select("tree", "block", "blocks", "place", *[c for c in [*carried, "leaf"] if c not in ("tree", "block", "blocks", "place")])
    return own.groupBy("tree", "block").cogroup(state.groupBy("tree", "block")).applyInPandas(block, schema)


def manifest(rows: DataFrame, carried: list[str], fanout: int = FANOUT, depth: int = DEPTH) -> DataFrame:
    """carried, leaf, subroot, root, siblings and path of every row; rows: grp (text or null), sort, leaf and carried columns."""
    # A null group comes first, an empty one after it.
    tree = F.coalesce(F.concat(F.lit("="), F.col("grp").cast("string")), F.lit(""))
    rows, state = forest(rows.select(tree.alias("tree"), "sort", "leaf", *carried), fanout, depth)
    tops = state.where("block = 0").select(F.lit("").alias("tree"), F.col("tree").alias("sort"), F.col("node").alias("leaf"), F.col("tree").alias("of"))
    upper = shared.written(proofs(*forest(tops, fanout, depth), ["of"], fanout, depth), "upper")
    upper = upper.select(F.col("of").alias("tree"), F.col("leaf").alias("subroot"), F.col("node").alias("root"), F.col("siblings").alias("over"), F.col("path").alias("turns"))
    state = state.drop("node").join(shared.sized(upper), "tree")
    state = state.withColumns({"siblings": F.concat("siblings", "over"), "path": F.concat("path", "turns")}).drop("over", "turns")
    return proofs(rows, state, carried, fanout, depth)


def folded(leaf: Column, siblings: Column, path: Column) -> Column:
    """The root that a leaf and its proof give."""
    steps = F.arrays_zip(siblings.alias("s"), path.alias("p"))
    return F.aggregate(steps, leaf, lambda node, x: sha(F.concat(F.substring(x["s"], F.lit(1), x["p"] * HEX), node, F.substring(x["s"], x["p"] * HEX + 1, F.length(x["s"])))))


def proof_digest(siblings: Column) -> Column:
    return sha(F.array_join(siblings, ""))
