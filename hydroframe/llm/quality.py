"""Document quality by a linear-chain conditional random field over lines.

Each line has features of its own bytes and words (kinds of characters, repeated words and characters, lengths, each as
steps), and those of the line before and after it.  The field labels every line good or bad; forward-backward gives the
marginal of each line given the whole document.  Marginals, weighted by line length, are averaged to a document, and two
numbers fitted on the training documents turn the average into a probability.  Only the text is ever an input.

Training uses at most `sample_docs` labelled documents, the first by hash of id, of at most `sample_lines` lines each and
`total_lines` in all (a bound of the sample only: some 20 MB of features, a byte each); lines take the label of their document.  Every document is scored on its whole text.

Edge cases: null and empty texts are one empty line and get a score too; a null id is scored and never held out; labels
that repeat an id count once, the smaller one; null labels are left out; without labels of both kinds every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared, words

SAMPLE_DOCS, SAMPLE_LINES, TOTAL_LINES, ROUNDS, BLOCK_LINES = 4000, 400, 200_000, 150, 1 << 13
_SHARES = (0.0, 0.02, 0.06, 0.15, 0.3, 0.5, 0.8)
_LENGTHS = (0, 1, 4, 12, 40, 120, 400)


def _kinds() -> np.ndarray:
    """For each byte value, the kinds of character it counts as."""
    table = np.zeros((256, 8), np.float32)
    for byte in range(256):
        c = chr(byte)
        table[byte] = [65 <= byte <= 90, 97 <= byte <= 122, 48 <= byte <= 57, byte >= 128, c in ".,;:'\"-()", c in "!?", c in "|#$%&*@<>{}[]\\/=+_~^", byte < 32]
    return table


_KINDS = _kinds()
N_OWN = 1 + len(_SHARES) * 13 + len(_LENGTHS) * 2


def line_features(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and weight (bytes, 1 at least) of each line, and its own features as 0 and 1."""
    feed = np.flatnonzero(data == 10)
    row = np.concatenate([np.arange(len(ends) - 1), np.searchsorted(ends, feed, side="right") - 1])
    begin = np.concatenate([ends[:-1], feed + 1])
    order = np.lexsort((begin, row))
    row, begin = row[order], begin[order]
    if not len(row):
        return row, np.zeros(0), np.zeros((0, N_OWN), np.float32)
    final = np.append(row[1:] != row[:-1], True)
    end = np.where(final, ends[row + 1], np.append(begin[1:] - 1, 0))
    size = (end - begin).astype(np.float32)
    n = len(data)

    def inside(flags: np.ndarray) -> np.ndarray:
        total = np.zeros(n + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return (total[end] - total[begin]).astype(np.float32)

    per_char = np.maximum(size, 1)
    shares = [inside(_KINDS[data, k] > 0) / per_char for k in range(8)]
    thrice = np.zeros(n, bool)
    thrice[2:] = (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2]) & ~words.SPACE[data[2:]]
    shares.append(inside(thrice) / per_char * 4)

    first, last, _ = words.spans(data, ends)
    word = words.hashed(data, first, last, lower=True)
    low, high = np.searchsorted(first, begin), np.searchsorted(first, end)
    count = (high - low).astype(np.float32)
    per_word = np.maximum(count, 1)

    def of_words(flags: np.ndarray) -> np.ndarray:
        total = np.zeros(len(word) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return (total[high] - total[low]).astype(np.float32) / per_word

    again, near = np.zeros(len(word), bool), np.zeros(len(word), bool)
    again[1:] = word[1:] == word[:-1]
    near[2:] = word[2:] == word[:-2]
    odd = np.zeros(len(word), bool)
    if len(word):
        odd = _KINDS[data[last - 1], 6] > 0
    shares += [of_words(again), of_words(near & ~again), of_words(odd), of_words(last - first == 1)]
    steps = [np.stack([s > t for t in _SHARES], axis=1) for s in shares]
    steps += [np.stack([x > t for t in _LENGTHS], axis=1) for x in (count, size / per_word)]
    return row, per_char.astype(np.float64), np.concatenate([np.ones((len(row), 1), bool), *steps], axis=1).astype(np.float32)


def with_neighbours(row: np.ndarray, own: np.ndarray) -> np.ndarray:
    before, after = np.zeros_like(own), np.zeros_like(own)
    same = row[1:] == row[:-1]
    before[1:][same], after[:-1][same] = own[:-1][same], own[1:][same]
    return np.concatenate([own, before, after], axis=1)


def marginals(emit: np.ndarray, row: np.ndarray, step: np.ndarray, need_pairs: bool = False):
    """P(good) of each line: emit is the log-odds of good by features, step[i, j] the score of state i before state j.

    With need_pairs, also the first line of each pair of neighbours and the probabilities of its two states.
    """
    n = len(row)
    head = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if n else np.zeros(0, np.int64)
    length = np.diff(np.append(head, n))
    order = np.argsort(-length, kind="stable")
    head, length = head[order], length[order]
    alpha, beta = np.zeros((n, 2)), np.zeros((n, 2))
    score = np.stack([np.zeros(n), emit], axis=1)
    active = [int(np.searchsorted(-length, -t, side="left")) for t in range(int(length[0]) if n else 0)]
    for t, k in enumerate(active):
        at = head[:k] + t
        if t:
            alpha[at] = score[at] + np.logaddexp(alpha[at - 1, :1] + step[0], alpha[at - 1, 1:] + step[1])
        else:
            alpha[at] = score[at]
    for t in range(len(active) - 2, -1, -1):
        at = head[: active[t + 1]] + t
        following = beta[at + 1] + score[at + 1]
        beta[at] = np.logaddexp(step[:, 0] + following[:, :1], step[:, 1] + following[:, 1:])
    both = alpha + beta
    good = 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -500, 500)))
    if not need_pairs:
        return good
    z = np.logaddexp(both[:, 0], both[:, 1])
    pair = np.flatnonzero(row[1:] == row[:-1])
    joint = alpha[pair][:, :, None] + step + (score[pair + 1] + beta[pair + 1])[:, None, :] - z[pair][:, None, None]
    return good, pair, np.exp(joint)


@dataclass
class Model:
    weights: np.ndarray
    step: np.ndarray
    scale: float
    shift: float

    def score(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        row, weight, own = line_features(data, ends)
        good = marginals(with_neighbours(row, own) @ self.weights, row, self.step)
        return 1 / (1 + np.exp(-(self.scale * logit(averages(row, weight, good, len(ends) - 1)) + self.shift)))


def averages(row: np.ndarray, weight: np.ndarray, good: np.ndarray, n: int) -> np.ndarray:
    """Mean of P(good) over the lines of each document, weighted by length."""
    return np.bincount(row, weight * good, n) / np.bincount(row, weight, n)


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def fit(row: np.ndarray, weight: np.ndarray, own: np.ndarray, label: np.ndarray, rounds: int = ROUNDS, penalty: float = 1e-4) -> Model:
    """Train on lines of documents 0, 1, ... with labels 0 and 1, by Adam on the conditional likelihood of documents weighted by class."""
    y, n_lines = label[row].astype(np.float64), len(row)
    # Both labels weigh alike in the sum, so the threshold lies between them whatever their shares are.
    share = np.where(label == 1, 0.5 / max(1, (label == 1).sum()), 0.5 / max(1, (label == 0).sum())) * len(label)
    part = share[row]
    weights, step = np.zeros(3 * own.shape[1]), np.zeros((2, 2))
    pair = np.flatnonzero(row[1:] == row[:-1])
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[pair].astype(int), y[pair + 1].astype(int)), part[pair])
    # Whole documents of about BLOCK_LINES lines at a time: the features of all are wide only for one block.
    cuts = np.unique(np.searchsorted(row, np.append(row[::BLOCK_LINES], len(label)))) if n_lines else np.zeros(1, int)
    blocks = [slice(i, j) for i, j in zip(cuts[:-1], cuts[1:], strict=True)]

    def emitted(at: slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A block's own features, which of its lines are of the document of the line before, and log-odds of good by all features."""
        x, same = own[at].astype(np.float64), row[at][1:] == row[at][:-1]
        here, before, after = (x @ w for w in np.split(weights, 3))
        here[1:] += np.where(same, before[:-1], 0)
        here[:-1] += np.where(same, after[1:], 0)
        return x, same, here

    moments = [np.zeros(len(weights) + 4), np.zeros(len(weights) + 4)]
    for i in range(1, rounds + 1):
        slope, turn = np.zeros(len(weights)), seen.copy()
        for at in blocks:
            x, same, emit = emitted(at)
            good, pair, states = marginals(emit, row[at], step, True)
            off = (y[at] - good) * part[at]
            slope += np.concatenate([off @ x, np.where(same, off[1:], 0) @ x[:-1], np.where(same, off[:-1], 0) @ x[1:]])
            turn -= np.tensordot(part[at][pair], states, 1)
        g = np.concatenate([slope / n_lines - penalty * weights, (turn / n_lines - penalty * step).ravel()])
        moments = [0.9 * moments[0] + 0.1 * g, 0.99 * moments[1] + 0.01 * g * g]
        move = 0.1 * (moments[0] / (1 - 0.9**i)) / (np.sqrt(moments[1] / (1 - 0.99**i)) + 1e-8)
        weights, step = weights + move[:-4], step + move[-4:].reshape(2, 2)
    z = logit(averages(row, weight, np.concatenate([marginals(emitted(at)[2], row[at], step) for at in blocks]), len(label)))
    a, b = 1.0, 0.0
    for _ in range(300):
        p = 1 / (1 + np.exp(-(a * z + b)))
        a, b = a + 0.3 * float(np.mean(share * (label - p) * z)) / 4, b + 0.3 * float(np.mean(share * (label - p)))
    return Model(weights, step, max(a, 0.05), b)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample_docs: int = SAMPLE_DOCS, sample_lines: int = SAMPLE_LINES, total_lines: int = TOTAL_LINES) -> Model | None:
    """Fit on a bounded sample; labels: id_col and label_col of the rows that may be learned from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in shared.parts(batch, 0):
                row, weight, own = line_features(*shared.text_bytes(part.column(0)))
                cut = np.searchsorted(row, np.arange(part.num_rows + 1))
                size = np.diff(cut)
                use = [i for i in range(part.num_rows) if size[i] <= sample_lines]
                packed = [[np.packbits(own[cut[i] : cut[i + 1]].astype(bool), axis=1).tobytes() for i in use], [weight[cut[i] : cut[i + 1]].tobytes() for i in use]]
                yield pa.record_batch([part.column(1).take(pa.array(use, pa.int64())), part.column(2).take(pa.array(use, pa.int64())), *(pa.array(p, pa.binary()) for p in packed)], ["label", "place", "own", "weight"])

    place = F.xxhash64(F.col("id"))
    chosen = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).cast("int").alias("label"))
    chosen = chosen.withColumn("place", place).orderBy("place", "id").limit(sample_docs)
    rows = docs.select(F.col(id_col).alias("id"), shared.text_or_empty(text_col).alias("text")).join(F.broadcast(chosen), "id")
    got = rows.select("text", "label", "place").mapInArrow(run, "label int, place bigint, own binary, weight binary").collect()
    got.sort(key=lambda r: (r["place"], r["label"], bytes(r["own"])))
    held = np.cumsum([len(r["weight"]) // 8 for r in got])
    got = got[: int(np.searchsorted(held, total_lines, side="right"))]
    if len({r["label"] for r in got}) < 2:
        return None
    weight = [np.frombuffer(r["weight"], np.float64) for r in got]
    row = np.repeat(np.arange(len(got)), [len(w) for w in weight])
    own = np.concatenate([np.unpackbits(np.frombuffer(r["own"], np.uint8).reshape(len(w), -1), axis=1, count=N_OWN) for r, w in zip(got, weight, strict=True)])
    return fit(row, np.concatenate(weight), own, np.array([r["label"] for r in got]))


def score_names(docs: DataFrame) -> tuple[str, str]:
    """Names of the score and the prediction: `score` and `predicted`, with underscores before them where docs has such columns."""
    return shared.free_name(docs, "score"), shared.free_name(docs, "predicted")


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every column of docs, then the score (0 to 1) and the prediction (1 if the score is 0.5 or more, else 0), as score_names has them."""
    score_col, predicted_col = score_names(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in shared.parts(batch, at):
                data, ends = shared.text_bytes(part.column(at).fill_null(""))
                found = model.score(data, ends) if model else np.full(part.num_rows, 0.5)
                columns = [*part.columns, pa.array(found, pa.float64()), pa.array((found >= 0.5).astype(np.int32))]
                yield pa.record_batch(columns, [*part.schema.names, score_col, predicted_col])

    at = docs.columns.index(text_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{schema}, `{score_col}` double, `{predicted_col}` int")


def held_out(id_col: str = "doc_id"):
    """Rows that labels are never learned from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))
