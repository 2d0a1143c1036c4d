"""Substring dedup over a compacted de Bruijn graph of words.

Edges of the graph are k-mers of words (k = 20).  A k-mer is placed by its minimiser, the least hash among its shorter
m-mers, so equal k-mers meet wherever they stand.  Consecutive k-mers of a document with the same minimiser occurrence
form a path without branches, which goes into one row (minimiser, hash of the path, document, start, length).  Paths
meet by minimiser: a path that stands earlier elsewhere as a whole has all its k-mers repeated.  Only where different
paths share a minimiser the graph may branch there; for the first occurrence of each such path the single k-mers are
compared, fetched from the document by the path's coordinates.  What is repeated comes back to its document as word
spans, and the words they cover are removed.

Within an Arrow batch a repeated path is settled at once, its words compared, so a passage that every document holds
sends one row per batch to its minimiser.  Other repeated paths are verified at their source: those that follow on each
other in both documents join to one long span, and the words at the coordinates of the span and of its source are fetched
and compared by 128-bit digests, as single k-mers are.  The 64-bit hashes only find candidates: where a span's words
differ from its source's, all k-mers under its minimisers are compared anew by their words, in every document.

Edge cases: null, empty and short texts have no k-mers and lose nothing; rows without an id are left out; rows that
repeat an id count as one document (they should hold the same text; spans end with the text) and do not remove each
other's words; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import shared, words

K, M = 20, 6
U = np.uint64


def kmers(data: np.ndarray, ends: np.ndarray, k: int = K, m: int = M):
    """Word hashes, word rows, start of each k-mer, position and hash of its minimiser, and the words with their bytes."""
    begin, end, row = words.spans(data, ends)
    word, spaced = words.hashed(data, begin, end), words.spaced(data, begin, end)
    if len(word) < k:
        none = np.zeros(0, np.int64)
        return word, row, none, none, none.astype(U), spaced
    total = np.zeros(len(word) - m + 1, U)
    for i in range(m):
        total += word[i : len(word) - m + 1 + i] * words.PLACES[i]
    mmer = words.mix(total)
    at = np.flatnonzero(row[k - 1 :] == row[: len(row) - k + 1])
    place = np.lib.stride_tricks.sliding_window_view(mmer, k - m + 1).argmin(axis=1)[at] + at
    return word, row, at, place, mmer[place], spaced


def _first_word(row: np.ndarray, n: int) -> np.ndarray:
    return np.searchsorted(row, np.arange(n))


def paths(docs: DataFrame, k: int = K, m: int = M, hash_bits: int = 64) -> DataFrame:
    """mu, h, id, start, n, again: paths of n k-mers; again where the same words stand earlier in their batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in shared.parts(batch, 1):
                word, row, at, place, least, (spaced, front, back) = kmers(*shared.text_bytes(part.column(1)), k, m)
                new = np.ones(len(at), bool)
                new[1:] = (place[1:] != place[:-1]) | (row[at[1:]] != row[at[:-1]])
                first = np.flatnonzero(new)
                n = np.diff(np.append(first, len(at)))
                begin, mu = at[first], least[first]
                h = words.sequences(word, begin, begin + n + k - 1) >> U(64 - hash_bits)
                doc = part.column(0).to_numpy()[row[begin]] if len(begin) else np.zeros(0, np.int64)
                start = begin - _first_word(row, part.num_rows)[row[begin]]
                order = np.lexsort((start, doc, h, mu))
                mu, h, doc, start, n, begin = (x[order] for x in (mu, h, doc, start, n, begin))
                same = np.zeros(len(mu), bool)
                same[1:] = (mu[1:] == mu[:-1]) & (h[1:] == h[:-1])
                group = np.maximum.accumulate(np.where(same, 0, np.arange(len(mu))))
                again = same & ((doc != doc[group]) | (start != start[group]))
                left, right = front[begin], back[begin + n + k - 2] if len(begin) else begin
                for i in np.flatnonzero(again):
                    j = group[i]
                    again[i] = spaced[left[i] : right[i]] == spaced[left[j] : right[j]]
                mu = np.where(again, words.mix(mu ^ words.mix(doc.astype(U) + start.astype(U))), mu)  # spread those
                columns = [mu.view(np.int64), h.view(np.int64), doc, start.astype(np.int32), n.astype(np.int32), again]
                yield pa.record_batch([pa.array(c) for c in columns], ["mu", "h", "id", "start", "n", "again"])

    return docs.mapInArrow(run, "mu bigint, h bigint, id bigint, start int, n int, again boolean")


def fetched(asked: DataFrame, k: int = K, m: int = M, minimisers: bool = False) -> DataFrame:
    """whole, id, start, n, d1, d2, mu: digests of the words at given coordinates, rows of id, text and spans.

    A span (start, n, whole) of n k-mers gives one row if whole, else one for each k-mer (n = 1), with its minimiser if
    wanted.  Spans end where the text does.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in shared.parts(batch, 1):
                word, row, at, _, least, (spaced, front, back) = kmers(*shared.text_bytes(part.column(1)), k, m)
                ids, first = part.column(0).to_numpy(), _first_word(row, part.num_rows + 1)
                owner, begin, end, whole = _spans(part.column(2), first, k)
                edge = np.zeros(len(word) + 1, np.int64)
                np.add.at(edge, begin[~whole], 1)
                np.add.at(edge, end[~whole], -1)
                wanted = np.cumsum(edge[:-1])[at] > 0
                at, least = at[wanted], least[wanted]
                owner, begin, end = owner[whole], begin[whole], end[whole]
                owner = np.concatenate([owner, row[at]])
                n = np.concatenate([end - begin, np.ones(len(at), np.int64)])
                begin = np.concatenate([begin, at])
                d = words.digests(spaced, front[begin], back[begin + n + k - 2] if len(begin) else begin).view(np.int64)
                mu = pa.array(np.concatenate([np.zeros(len(n) - len(at), U), least]).view(np.int64)) if minimisers else pa.nulls(len(n), pa.int64())
                columns = [np.arange(len(n)) < len(n) - len(at), ids[owner], (begin - first[owner]).astype(np.int32), n.astype(np.int32), d[:, 0], d[:, 1]]
                yield pa.record_batch([*(pa.array(c) for c in columns), mu], ["whole", "id", "start", "n", "d1", "d2", "mu"])

    return asked.mapInArrow(run, "whole boolean, id bigint, start int, n int, d1 bigint, d2 bigint, mu bigint")


def _spans(spans: pa.Array, first: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """Row, first k-mer, k-mer after the last, and `whole` of each span, cut to its row's k-mers; empty ones are left out."""
    flat = spans.flatten()
    if not len(flat):
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, bool)
    owner = np.repeat(np.arange(len(spans)), np.diff(spans.offsets.to_numpy()))
    start, n, whole = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
    begin = first[owner] + start
    end = np.minimum(begin + n.astype(np.int64), first[owner + 1] - k + 1)
    some = begin < end
    return owner[some], begin[some], end[some], whole[some].astype(bool)


def _gathered(spans: DataFrame, *more: str) -> DataFrame:
    return spans.groupBy("id").agg(F.collect_list(F.struct("start", "n", *more)).alias("spans"))


_NO_SPANS = "array<struct<start:int,n:int>>"


def _asked(docs: DataFrame, spans: DataFrame) -> DataFrame:
    return docs.join(_gathered(spans, "whole"), "id").select("id", "text", F.col("spans").cast("array<struct<start:int,n:int,whole:boolean>>"))


def _joined(found: DataFrame) -> DataFrame:
    """Spans (id, start, n, source, source_start) that follow on each other in both documents, as one."""
    line = ["id", "source", "shift"]
    order = Window.partitionBy(*line).orderBy("start")
    found = found.withColumn("shift", F.col("source_start") - F.col("start")).withColumn("end", F.col("start") + F.col("n"))
    new = F.col("start") > F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    found = found.withColumn("new", F.coalesce(new, F.lit(True))).withColumn("run", F.count_if("new").over(order))
    runs = found.groupBy(*line, "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return runs.select("id", "start", (F.col("end") - F.col("start")).alias("n"), "source", (F.col("start") + F.col("shift")).alias("source_start"))


def _verified(runs: DataFrame, digests: DataFrame) -> DataFrame:
    """id, start, n, ok: spans with a source, ok if the words at both coordinates have the same digest."""
    place, at_source = ["id", "start", "n"], ["source", "source_start", "n"]
    own = digests.select(*place, "d1", "d2").distinct()
    wanted = runs.groupBy(*at_source).agg(shared.salts("id"))
    theirs = own.select(F.col("id").alias("source"), F.col("start").alias("source_start"), "n", F.col("d1").alias("e1"), F.col("d2").alias("e2"))
    both = shared.by_key(runs.join(own, place, "left"), wanted.join(theirs, at_source, "left"), at_source, "id", "left")
    equal = F.coalesce((F.col("d1") == F.col("e1")) & (F.col("d2") == F.col("e2")), F.lit(False))
    return both.groupBy(*place, "source", "source_start").agg(F.max(equal).alias("ok")).drop("source", "source_start")


def _repeated(single: DataFrame) -> DataFrame:
    """id, start, n: k-mers whose words stand earlier too."""
    firsts = single.groupBy("d1", "d2").agg(F.min(F.struct("id", "start")).alias("first"), F.count("*").alias("c")).where("c > 1")
    return single.join(firsts, ["d1", "d2"]).where(F.struct("id", "start") > F.col("first")).select("id", "start", F.lit(1).alias("n"))


def _by_words(docs: DataFrame, failed: DataFrame, k: int, m: int) -> DataFrame:
    """id, start, n: the repeated k-mers under every minimiser that the failed spans have, compared by their words."""
    under = fetched(_asked(docs, failed.withColumn("whole", F.lit(False))), k, m, minimisers=True).select("mu").distinct()
    under = shared.written(under, "minimisers")
    every = F.array(F.struct(F.lit(0).alias("start"), F.lit(2**31 - 1).alias("n"), F.lit(False).alias("whole")))
    return _repeated(fetched(docs.select("id", "text", every), k, m, minimisers=True).join(shared.sized(under), "mu", "left_semi"))


def repeated_spans(docs: DataFrame, k: int = K, m: int = M, hash_bits: int = 64) -> DataFrame:
    """id, start, n: runs of n k-mers of a document (id, text), each of which stands earlier too.

    hash_bits is how much of a path's hash is used to find candidates; few bits only send more of them to be compared by words.
    """
    path, by_mu = Window.partitionBy("mu", "h"), Window.partitionBy("mu")
    met = paths(docs, k, m, hash_bits).repartition(shared.partitions(docs.sparkSession), "mu")
    met = met.withColumns({"first": F.min(F.struct("id", "start")).over(path), "low": F.min("h").over(by_mu), "high": F.max("h").over(by_mu)})
    later = F.col("again") | (F.struct("id", "start") > F.col("first"))
    source = [F.when(~F.col("again"), F.col("first")[x]).alias(y) for x, y in (("id", "source"), ("start", "source_start"))]
    spans = met.where(later | (F.col("low") != F.col("high"))).select("id", "start", "n", later.alias("later"), *source)
    spans = shared.written(spans, "paths")
    runs = shared.written(_joined(spans.where("later").drop("later")), "runs")
    sourced = runs.where("source is not null")
    own, theirs = sourced.select("id", "start", "n"), sourced.select(F.col("source").alias("id"), F.col("source_start").alias("start"), "n")
    spots = own.unionByName(theirs).distinct().withColumn("whole", F.lit(True))
    spots = spots.unionByName(spans.where(~F.col("later")).select("id", "start", "n", F.lit(False).alias("whole")))
    digests = shared.written(fetched(_asked(docs, spots), k, m).drop("mu"), "k-mers")
    checked = shared.written(_verified(sourced, digests.where("whole")), "verified")
    found = runs.where("source is null").select("id", "start", "n").unionByName(checked.where("ok").drop("ok"))
    found = found.unionByName(_repeated(digests.where(~F.col("whole"))))
    failed = checked.where(~F.col("ok")).drop("ok")
    return found if failed.isEmpty() else found.unionByName(_by_words(docs, failed, k, m))


def remove_repeats(docs: DataFrame, k: int = K, m: int = M, id_col: str = "doc_id", text_col: str = "text", texts: bool = True, hash_bits: int = 64) -> DataFrame:
    """id, n_words, n_removed, kept_sha256 and, with texts, kept_text (the words left, joined by one space)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in shared.parts(batch, 1):
                found = []
                for text, spans in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    own = text.encode().split()
                    total = len(own)
                    if spans:
                        edge = np.zeros(total + 1, np.int64)
                        for s in spans:
                            edge[min(s["start"], total)] += 1
                            edge[min(s["start"] + s["n"] + k - 1, total)] -= 1
                        own = list(compress(own, np.cumsum(edge[:-1]) <= 0))
                    kept = b" ".join(own)
                    found.append((total, total - len(own), hashlib.sha256(kept).hexdigest(), kept.decode() if texts else None))
                columns = [pa.array([x[i] for x in found], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string(), pa.string()))]
                yield pa.record_batch([part.column(0), *columns], ["id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), shared.text_or_empty(text_col).alias("text"))
    spans = _gathered(shared.written(repeated_spans(rows, k, m, hash_bits), "repeats"))
    out = rows.join(spans, "id", "left").select("id", "text", F.coalesce(F.col("spans").cast(_NO_SPANS), F.array().cast(_NO_SPANS)))
    out = out.mapInArrow(run, "id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept_text string")
    out = out.withColumnRenamed("id", id_col)
    return out if texts else out.drop("kept_text")
