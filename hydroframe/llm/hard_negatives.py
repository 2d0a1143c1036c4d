"""Hard negatives of anchors: rows of another label that score nearly as high as the anchor's best rows of its own label.

Vectors become floor(scale * x); a score is an integer inner product.  The search prunes by length and by coordinates, in
the manner of LEMP.  Rows lie in length buckets, whose lengths differ by a tenth at most; a class of lengths with more than
`bucket_rows` rows is dealt on by a hash of the id.  A bucket keeps unit vectors and, for coordinates that are asked for, the
list of its rows in order of that coordinate.  For an anchor and the least score that still counts, the bucket's greatest
length gives the least cosine c that any row of it must reach: above 1, the bucket is left out.  Otherwise a row within the
angle acos(c) of the anchor has each coordinate f within cos(acos(q_f) +- acos(c)); these feasible ranges of the anchor's
focus coordinates (its largest) are looked up in the sorted lists and intersected, and what is left is scored exactly.

First each anchor meets the bucket it lies in, whose kth score is the least that counts elsewhere (an equal score still does:
ties go to the smaller id).  Then blocks of anchors meet the other buckets that some anchor of the block can reach.  Positives
are searched in buckets of the anchor's label, then negatives in buckets of all labels: for each positive the k best scores
within its band, so the band's upper end is part of the search.  A task holds one bucket and one block of anchors.

With N rows, A anchors, buckets of R rows and blocks of B anchors, rows and anchors that no bound leaves out are copied
N * A / B and A * N / R times: the search is exact, so the rest is the product of anchors and rows, in blocks.

Edge cases: rows with a null id, label or vector, or with null or non-finite components, take no part; rows that share an id
count as one, the least by width, label and vector; vectors of different width never meet; a negative positive score has an
empty band; an anchor without positives gives no rows; other columns are ignored; scores times 100 must fit 64 bits.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import shared
from .top_k import _exact, _matrix

BUCKET_ROWS, ANCHOR_BLOCK, FOCUS, RATIO = 1 << 14, 1 << 12, 4, 0.9
#: Room for rounding in cosines and lengths; candidates are scored exactly.
_ROOM = 1e-9
_FAR = 1 << 62
_ASKS = "array<struct<of:bigint,low:bigint,high:bigint>>"


class Bucket:
    """A length bucket with a sorted list of its rows for each coordinate that is asked for."""

    def __init__(self, matrix: np.ndarray) -> None:
        real = matrix.astype(np.float64)
        length = np.sqrt((real * real).sum(axis=1))
        self.matrix, self.top = matrix, float(length.max(initial=0))
        self.unit = real / np.where(length > 0, length, 1)[:, None]
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def sorted_list(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        if f not in self.lists:
            order = np.argsort(self.unit[:, f])
            self.lists[f] = self.unit[order, f], order
        return self.lists[f]

    def candidates(self, query: np.ndarray, least: float, focus: int = FOCUS) -> np.ndarray:
        """Rows whose inner product with the query may be `least` or more, all that are and few others."""
        real = query.astype(np.float64)
        length = float(np.sqrt(real @ real))
        if least <= 0:
            return np.arange(len(self.matrix))
        if length * self.top * (1 + _ROOM) < least:
            return np.zeros(0, np.int64)
        cosine = min(1.0, least / (length * self.top)) - _ROOM
        unit = np.clip(real / length, -1, 1)
        chosen = np.argsort(-np.abs(unit), kind="stable")[:focus]
        angle, reach = np.arccos(unit[chosen]), np.arccos(cosine)
        low, high = np.cos(np.minimum(np.pi, angle + reach)) - _ROOM, np.cos(np.maximum(0, angle - reach)) + _ROOM
        ranges = []
        for f, a, b in zip(chosen.tolist(), low, high, strict=True):
            values, order = self.sorted_list(f)
            begin, end = np.searchsorted(values, a, "left"), np.searchsorted(values, b, "right")
            ranges.append((end - begin, f, a, b, order[begin:end]))
        ranges.sort(key=lambda x: x[0])
        found = ranges[0][4]
        for _, f, a, b, _ in ranges[1:]:
            value = self.unit[found, f]
            found = found[(value >= a) & (value <= b)]
        return found

    def scores(self, query: np.ndarray, rows: np.ndarray) -> np.ndarray:
        many = 2 * len(rows) > len(self.matrix)
        return ((self.matrix @ query)[rows] if many else self.matrix[rows] @ query).astype(np.int64)


def search_bucket(points: pd.DataFrame, anchors: pd.DataFrame, k: int, different: bool, width: int) -> pd.DataFrame:
    """anchor_id, of, vec_id and score of the k best rows in each band (asks: of, low, high) of each anchor."""
    out = []
    if len(points) and len(anchors):
        matrix, asked = _exact(_matrix(points["vector"], width), _matrix(anchors["vector"], width))
        bucket, ids, labels = Bucket(matrix), points["vec_id"].to_numpy(np.int64), points["label"].to_numpy()
        for query, own, label, asks in zip(asked, anchors["anchor_id"].tolist(), anchors["label"].tolist(), anchors["asks"], strict=True):
            rows = bucket.candidates(query, min(a["low"] for a in asks))
            rows = rows[(ids[rows] != own) & ((labels[rows] != label) if different else True)]
            scores = bucket.scores(query, rows)
            order = np.lexsort((ids[rows], -scores))
            rows, down = rows[order], -scores[order]
            for a in asks:
                begin, end = np.searchsorted(down, -a["high"], side="left"), np.searchsorted(down, -a["low"], side="right")
                end = min(end, begin + k)
                out += [(own, a["of"], i, -s) for i, s in zip(ids[rows[begin:end]].tolist(), down[begin:end].tolist(), strict=True)]
    return pd.DataFrame(out, columns=["anchor_id", "of", "vec_id", "score"]).astype("int64")


def integer_rows(vectors: DataFrame, label: Column, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, label, width, vector (floor(scale * x)) and length of the rows that take part."""
    x = F.col(vector_col)
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    rows = vectors.where(F.col(id_col).isNotNull() & label.isNotNull() & x.isNotNull() & whole)
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.struct(F.size(x).alias("width"), label.alias("label"), F.transform(x, lambda v: F.floor(v.cast("double") * scale)).alias("vector")).alias("row"))
    rows = rows.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.*")
    return rows.withColumn("length", F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, v: a + v.cast("double") * v)))


def in_bands(points: DataFrame, asked: DataFrame, keys: list[str], k: int, different: bool, bucket_rows: int, anchor_block: int) -> DataFrame:
    """anchor_id, of, vec_id and score: the k best rows in each band of each anchor.

    points, asked: of integer_rows, asked with anchor_id for vec_id and asks; both are tables already written.
    """
    kind = F.coalesce(F.floor(F.log("length") / -np.log(RATIO)), F.lit(-1)).cast("int")
    bucket = [*keys, "kind", "sub"]
    points, asked = points.withColumn("kind", kind), asked.withColumn("kind", kind)
    sizes = shared.written(points.groupBy(*keys, "kind").agg(F.ceil(F.count("*") / bucket_rows).alias("subs")), "classes")

    def placed(rows: DataFrame, id_col: str) -> DataFrame:
        return rows.join(shared.sized(sizes), [*keys, "kind"]).withColumn("sub", F.pmod(F.xxhash64(id_col), F.col("subs"))).drop("subs")

    points, asked = placed(points, "vec_id"), placed(asked, "anchor_id")
    schema = "anchor_id bigint, of bigint, vec_id bigint, score bigint"
    held = list(dict.fromkeys([*bucket, "width", "vec_id", "label", "vector"]))
    sent = list(dict.fromkeys([*bucket, "width", "anchor_id", "label", "vector", "asks"]))

    def home(key, own: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        return search_bucket(own, anchors, k, different, int(key[0]))

    first = points.select(held).groupBy(*bucket).cogroup(asked.select(sent).groupBy(*bucket)).applyInPandas(home, schema)
    first = shared.written(first, "home")

    kth = first.groupBy("anchor_id", "of").agg(F.when(F.count("*") >= k, F.min("score")).alias("kth"))
    bands = asked.select("anchor_id", F.explode("asks").alias("a")).select("anchor_id", "a.*").join(kth, ["anchor_id", "of"], "left")
    bands = bands.groupBy("anchor_id").agg(F.collect_list(F.struct("of", F.greatest("low", F.coalesce("kth", "low")).alias("low"), "high")).cast(_ASKS).alias("asks"))
    blocks = asked.groupBy(*keys).agg(F.ceil(F.count("*") / anchor_block).alias("blocks"))
    asked = asked.drop("asks").join(bands, "anchor_id").join(shared.sized(blocks), keys)
    asked = asked.withColumn("block", F.pmod(F.xxhash64("anchor_id", F.lit(1)), F.col("blocks"))).drop("blocks")
    asked = shared.written(asked, "bands")

    # The least length that some anchor of a block can use.
    least = F.array_min(F.transform("asks", lambda a: a["low"]))
    reach = F.when(least <= 0, 0.0).when(F.col("length") > 0, least / F.col("length"))
    reach = asked.groupBy(*keys, "block").agg(F.min(reach).alias("reach")).where("reach is not null")
    tops = points.groupBy(*bucket).agg(F.max("length").alias("top"))
    units = tops.join(shared.sized(reach), keys).where(F.col("top") * (1 + _ROOM) >= F.col("reach")).select(*bucket, "block")
    units = shared.written(units, "units")

    def away(key, own: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        anchors = anchors[(anchors["own_kind"] != int(key[-3])) | (anchors["own_sub"] != int(key[-2]))]
        return search_bucket(own, anchors, k, different, int(key[0]))

    theirs = asked.withColumnsRenamed({"kind": "own_kind", "sub": "own_sub"}).join(units, [*keys, "block"]).select(*sent, "block", "own_kind", "own_sub")
    copies = points.join(units, bucket).select(*held, "block")
    other = copies.groupBy(*bucket, "block").cogroup(theirs.groupBy(*bucket, "block")).applyInPandas(away, schema)
    best = F.row_number().over(Window.partitionBy("anchor_id", "of").orderBy(F.desc("score"), "vec_id"))
    return first.unionByName(other).withColumn("rank", best).where(F.col("rank") <= k)


def mine(
    rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, low_percent: int = 80, high_percent: int = 100, bucket_rows: int = BUCKET_ROWS, anchor_block: int = ANCHOR_BLOCK
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    rows: of integer_rows; anchors: which of them are anchors.  An anchor's positives are its best rows of the same label;
    a positive's negatives are the best rows of other labels whose score is low_percent to high_percent of its own.
    """
    rows = shared.written(rows, "vectors")
    asked = shared.written(rows.where(anchors).withColumnRenamed("vec_id", "anchor_id"), "anchors")
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("of"), F.lit(-_FAR).alias("low"), F.lit(_FAR).alias("high"))).cast(_ASKS)
    found = shared.written(in_bands(rows, asked.withColumn("asks", whole), ["width", "label"], positives, False, bucket_rows, anchor_block), "positives")
    band = F.struct(F.col("vec_id").alias("of"), F.expr(f"(score * {low_percent} + 99) div 100").alias("low"), F.expr(f"score * {high_percent} div 100").alias("high"))
    bands = found.where("score >= 0").groupBy("anchor_id").agg(F.collect_list(band).cast(_ASKS).alias("asks"))
    again = shared.written(asked.join(bands, "anchor_id"), "asked")
    hits = in_bands(rows, again, ["width"], negatives, True, bucket_rows, anchor_block).withColumnsRenamed({"of": "positive_id", "vec_id": "negative_id", "score": "negative_score"})
    own = found.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return hits.join(own, ["anchor_id", "positive_id"]).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
