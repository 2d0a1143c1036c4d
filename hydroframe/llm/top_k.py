"""Exact top-k search by integer inner product with a KD-tree per shard.

Vectors become floor(scale * x).  They are dealt to shards by median splits of the widest dimension, fitted on a sample of
at most SAMPLE_ROWS vectors; a leaf of these splits that holds more than a shard's rows (many equal vectors, or a table far
above the sample) is dealt on by a hash of the id.  The sample decides only where a vector lies, never what is found.  Each
shard builds a KD-tree by median splits, keeping the tight bounding box of every node.  A query walks a tree best-first:
the most that a box allows is the sum over dimensions of max(q * low, q * high), and a node is left out once it cannot beat
the kth score found so far.  Each query first walks the shard where it would lie; that shard's kth score is the bound to
beat, and the query goes on only to shards whose box allows it (an equal score still counts, for ties go to the smaller id).

Vectors that are null, or hold null or non-finite components, take no part; nor do rows with a null id.  Rows that share
an id count as one, by the smallest of their vectors.  Vectors are compared with those of the same length only.  A query
gets all others if they are fewer than k; equal scores rank by the smaller id.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import shared

SHARD_ROWS, QUERY_BLOCK, LEAF_ROWS = 1 << 14, 1 << 12, 128
#: Vectors that the splits are fitted on, of them at least so many to a leaf; boxes of shards that a task holds.
SAMPLE_ROWS, SAMPLE_LEAF, BOX_BLOCK = 1 << 16, 16, 1 << 10
KEYS = ("width", "leaf", "sub")
_EXACT = float(1 << 52)


class KDTree:
    """A KD-tree over rows of integers (held as float64 where all inner products are exact in it)."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, leaf_rows: int = LEAF_ROWS) -> None:
        order, boxes, self.children, self.ranges, self.least = np.arange(len(ids)), [], [], [], []
        todo = [(0, len(ids), None)]
        while todo:
            begin, end, parent = todo.pop()
            node, own = len(boxes), points[order[begin:end]]
            low, high = own.min(axis=0), own.max(axis=0)
            boxes.append((low, high))
            self.children.append(())
            self.ranges.append((begin, end))
            self.least.append(int(ids[order[begin:end]].min()))
            if parent is not None:
                self.children[parent] += (node,)
            if end - begin > leaf_rows and len(low) and (high > low).any():
                middle = (end - begin) // 2
                side = np.argpartition(own[:, int(np.argmax(high - low))], middle)
                order[begin:end] = order[begin:end][side]
                todo += [(begin, begin + middle, node), (begin + middle, end, node)]
        self.low, self.high = (np.array([b[k] for b in boxes]) for k in (0, 1))
        self.ids, self.points = ids[order], points[order]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The most that each query's score can be in each node."""
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T

    def search(self, own_id: int, query: np.ndarray, bound: np.ndarray, k: int, floor: float) -> list[tuple[float, int]]:
        """The k best (score, -id) of scores at or above floor, best first, but for the row with the query's own id."""
        best: list[tuple[float, int]] = []
        queue = [(-bound[0], self.least[0], 0)]
        while queue:
            most, least, node = heapq.heappop(queue)
            if -most < floor or len(best) == k and (-most, -least) < best[0]:
                if -most < floor or -most < best[0][0]:
                    break
                continue
            if self.children[node]:
                for child in self.children[node]:
                    heapq.heappush(queue, (-bound[child], self.least[child], child))
                continue
            begin, end = self.ranges[node]
            scores, ids = self.points[begin:end] @ query, self.ids[begin:end]
            good = np.flatnonzero((scores >= (best[0][0] if len(best) == k else floor)) & (ids != own_id))
            for i in good[np.lexsort((ids[good], -scores[good]))][:k]:
                item = (scores[i], -int(ids[i]))
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
        return sorted(best, reverse=True)


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    return np.array([np.asarray(v, np.int64) for v in vectors], np.int64).reshape(len(vectors), width)


def _exact(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as float64 where all inner products are exact in it."""
    largest = a.shape[-1] * float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0))
    return (a.astype(np.float64), b.astype(np.float64)) if largest < _EXACT else (a, b)


def _floors(queries: pd.DataFrame) -> np.ndarray:
    floors = queries["floor"].to_numpy(np.float64, na_value=np.nan)
    return np.where(np.isnan(floors), -np.inf, floors)


def search_shard(points: pd.DataFrame, queries: pd.DataFrame, k: int, leaf_rows: int = LEAF_ROWS) -> pd.DataFrame:
    """Hits of a block of queries in one shard: query_id, vec_id, score; at most k for a query."""
    found = []
    if len(points) and len(queries):
        width, ids = len(points["vector"].iloc[0]), points["vec_id"].to_numpy(np.int64)
        matrix, asked = _exact(_matrix(points["vector"], width), _matrix(queries["vector"], width))
        tree, floors, own = KDTree(ids, matrix, leaf_rows), _floors(queries), queries["query_id"].to_numpy(np.int64)
        for begin in range(0, len(asked), 256):
            bounds = tree.bounds(asked[begin : begin + 256])
            for i, bound in enumerate(bounds, begin):
                found += [(own[i], -identity, int(score)) for score, identity in tree.search(int(own[i]), asked[i], bound, k, floors[i])]
    return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")


def splits(sample: np.ndarray, leaves: int) -> tuple[np.ndarray, np.ndarray]:
    """Dimension and cut of each inner node of a complete binary tree, level by level; what reaches the cut goes right."""
    depth = max(0, min(leaves, len(sample) // SAMPLE_LEAF) - 1).bit_length()
    dims, cuts, members = np.zeros((1 << depth) - 1, np.int64), np.full((1 << depth) - 1, np.inf), [sample]
    for node in range(len(dims)):
        own = members[node]
        if own.size and (own.max(axis=0) > own.min(axis=0)).any():
            dims[node] = np.argmax(own.max(axis=0).astype(np.float64) - own.min(axis=0))
            x = own[:, dims[node]]
            cuts[node] = max(np.median(x), x[x > x.min()].min())
        right = own[:, dims[node]] >= cuts[node] if own.size else np.zeros(len(own), bool)
        members += [own[~right], own[right]]
    return dims, cuts


def leaf_of(matrix: np.ndarray, dims: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """The leaf that each vector falls into."""
    node, row = np.zeros(len(matrix), np.int64), np.arange(len(matrix))
    for _ in range(len(dims).bit_length()):
        node = 2 * node + 1 + (matrix[row, dims[node]] >= cuts[node])
    return node - len(dims)


def _leaf_column(vectors: DataFrame, rows: int, shard_rows: int):
    """A column of `vector` and `width` that names the leaf, by splits fitted on a bounded sample."""
    sample = vectors.sample(min(1.0, SAMPLE_ROWS / max(rows, 1)), seed=1).limit(SAMPLE_ROWS).select("width", "vector").toPandas()
    leaves = -(-rows // shard_rows)
    fitted = {int(w): splits(_matrix(own, int(w)), leaves) for w, own in sample.groupby("width")["vector"]}

    @F.pandas_udf("int")
    def leaf(vector: pd.Series) -> pd.Series:
        out, widths = np.zeros(len(vector), np.int32), vector.map(len).to_numpy(np.int64)
        for width in set(widths.tolist()) & set(fitted):
            at = np.flatnonzero(widths == width)
            out[at] = leaf_of(_matrix(vector.iloc[at], width), *fitted[width])
        return pd.Series(out)

    return leaf("vector")


def integer_vectors(vectors: DataFrame, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and vector (floor(scale * x) as integers) of the rows that take part."""
    x = F.col(vector_col)
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return vectors.where(F.col(id_col).isNotNull() & x.isNotNull() & whole).select(
        F.col(id_col).cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(v.cast("double") * scale)).alias("vector")
    )


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, shard_rows: int = SHARD_ROWS, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best among all vectors but those with its own id.

    vectors, queries: vec_id and vector (array of bigint), as integer_vectors gives them; queries are rows of vectors.
    A task holds one shard and one block of queries, or one block of boxes and one of queries, all of bounded size.
    """
    whole = vectors.groupBy("vec_id", F.size("vector").alias("width")).agg(F.min("vector").alias("vector"))
    whole = shared.written(whole, "vectors")
    leaf = _leaf_column(whole, whole.count(), shard_rows)
    sizes = shared.written(whole.groupBy("width", leaf.alias("leaf")).agg(F.ceil(F.count("*") / shard_rows).alias("subs")), "leaves")

    def placed(rows: DataFrame, id_col: str, how: str) -> DataFrame:
        sub = F.pmod(F.xxhash64(id_col), F.coalesce("subs", F.lit(1)))
        return rows.withColumn("leaf", leaf).join(shared.sized(sizes), ["width", "leaf"], how).withColumn("sub", sub).drop("subs")

    held = placed(whole, "vec_id", "inner")
    one = queries.groupBy("vec_id").agg(F.min("vector").alias("vector")).select(F.col("vec_id").alias("query_id"), "vector", F.size("vector").alias("width"))
    one = shared.written(placed(one, "query_id", "left"), "queries")

    def dealt(rows: DataFrame, seed: int, blocks) -> DataFrame:
        return rows.withColumn("block", F.pmod(F.xxhash64("query_id", F.lit(seed)), blocks))

    def copied(rows: DataFrame, blocks) -> DataFrame:
        return rows.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)))

    def walk(asked: DataFrame, how: str, visit, schema: str) -> DataFrame:
        """Each shard meets the queries that name it; it is copied only where they are more than one block."""
        counts = asked.groupBy(*KEYS).agg(F.ceil(F.count("*") / query_block).alias("blocks"))
        counts = shared.sized(shared.written(counts, "blocks"))
        points = copied(held.join(counts, [*KEYS], how), F.coalesce("blocks", F.lit(1)).cast("bigint")).drop("blocks")
        blocks = dealt(asked.join(counts, [*KEYS]), 1, F.col("blocks")).drop("blocks")
        return points.groupBy(*KEYS, "block").cogroup(blocks.groupBy(*KEYS, "block")).applyInPandas(visit, schema)

    def at_home(key, points: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        """Hits of the queries, and once for each shard a row with its box."""
        width, sub, name, block = (int(x) for x in (key[0], key[2], key[1], key[3]))
        found = search_shard(points, asked, k).assign(low=None, high=None)
        if len(points) and block == 0:
            matrix = _matrix(points["vector"], width)
            box = pd.DataFrame({"query_id": [None], "vec_id": [None], "score": [None], "low": [matrix.min(axis=0)], "high": [matrix.max(axis=0)]})
            found = pd.concat([found.astype(object), box.astype(object)], ignore_index=True)
        found = found.assign(width=width, leaf=name, sub=sub)[["query_id", "vec_id", "score", "low", "high", *KEYS]]
        return found.astype({c: "Int64" for c in ("query_id", "vec_id", "score")})

    def away(key, points: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        return search_shard(points, asked, k)

    def allowed(key, boxes: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        """Query and shard wherever the shard's box allows the query's floor, but for its home."""
        if not len(boxes) or not len(asked):
            return pd.DataFrame({c: np.zeros(0, np.int64) for c in ("query_id", *KEYS)})
        width = int(key[0])
        edges = np.concatenate([_matrix(boxes[c], width) for c in ("low", "high")])
        edges, own = _exact(edges, _matrix(asked["vector"], width))
        low, high = edges[: len(boxes)], edges[len(boxes) :]
        good = np.maximum(own, 0) @ high.T + np.minimum(own, 0) @ low.T >= _floors(asked)[:, None]
        for c in ("leaf", "sub"):
            boxes[c] = boxes[c].astype("int64")
        home = (asked["leaf"].to_numpy()[:, None] == boxes["leaf"].to_numpy()) & (asked["sub"].to_numpy()[:, None] == boxes["sub"].to_numpy())
        q, b = np.nonzero(good & ~home)
        return pd.DataFrame({"query_id": asked["query_id"].to_numpy()[q], "width": width, "leaf": boxes["leaf"].to_numpy()[b], "sub": boxes["sub"].to_numpy()[b]})

    kinds = "width int, leaf int, sub bigint"
    first = walk(one.withColumn("floor", F.lit(None).cast("double")), "left", at_home, f"query_id bigint, vec_id bigint, score bigint, low array<bigint>, high array<bigint>, {kinds}")
    first = shared.written(first, "top-k")
    hits, boxes = first.where("query_id is not null").select("query_id", "vec_id", "score"), first.where("query_id is null").select(*KEYS, "low", "high")
    kth = hits.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score").cast("double")).alias("floor"))
    asked = one.join(kth, "query_id", "left")
    query_blocks, box_blocks = (max(1, -(-n // most)) for n, most in ((one.count(), query_block), (boxes.count(), BOX_BLOCK)))
    spread = boxes.withColumn("part", F.pmod(F.xxhash64(*KEYS), F.lit(box_blocks)))
    parts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(box_blocks - 1).cast("bigint")))
    by = ("width", "part", "block")
    spread, dealt_queries = copied(spread, F.lit(query_blocks).cast("bigint")), dealt(asked, 2, F.lit(query_blocks)).withColumn("part", parts)
    pairs = shared.written(spread.groupBy(*by).cogroup(dealt_queries.groupBy(*by)).applyInPandas(allowed, f"query_id bigint, {kinds}"), "pairs")
    further = pairs.join(asked.select("query_id", "vector", "floor"), "query_id")
    found = hits.unionByName(walk(further, "inner", away, "query_id bigint, vec_id bigint, score bigint"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
