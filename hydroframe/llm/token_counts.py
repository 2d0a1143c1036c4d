"""Token counts of whole texts: overlap resynchronisation for huge documents.

A text of up to `long_chars` characters is encoded at once.  A longer one is encoded in chunks that overlap.  Two
neighbouring chunks are spliced at a white-space character of their overlap, from which on both give the same tokens at
the same offsets up to a later white-space character.  White space is a proven boundary: the pre-tokenizer drops it, no
special token holds any, and normalisation never joins characters across it.  Where an overlap has no such stretch, the
overlap is doubled, in the end up to a chunk twice as long, so a text without any white space is encoded whole.  A tokenizer
that keeps white space (`drops_white_space` tries it) encodes every text whole.

Edge cases: null and empty texts have 0 tokens; rows that repeat an id are counted each; null ids are kept; columns
other than the two named ones are ignored.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared

LONG_CHARS, CHUNK_CHARS, OVERLAP_CHARS = 1 << 16, 1 << 15, 512
_GAPS = frozenset(" \n\t\r")


@cache
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def splice(left: list[tuple], right: list[tuple], text: str, begin: int, end: int) -> int | None:
    """Where tokens of two chunks may be joined inside text[begin:end], or None.

    left, right: (id, start, end) of each token in each chunk, positions in the whole text.
    """
    gaps = [i for i in range(begin, end) if text[i] in _GAPS]
    if len(gaps) < 2:
        return None
    left, right = ([t for t in side if t[2] <= gaps[-1]] for side in (left, right))
    # Both end with the same tokens; what lies before these must not reach the boundary.
    same = 0
    while same < min(len(left), len(right)) and left[-1 - same] == right[-1 - same]:
        same += 1
    if not same:
        return None
    off = max([t[1] for side in (left, right) for t in side[: len(side) - same][-1:]], default=-1)
    return next((g for g in gaps[:-1] if off < g <= left[-1][1]), None)


def drops_white_space(tokenizer) -> bool:
    """Whether a tokenizer parts texts at white space and drops it, so that texts may be spliced there."""
    if any(c.isspace() for t in tokenizer.get_added_tokens_decoder().values() for c in t.content) or any(t.lstrip or t.rstrip for t in tokenizer.get_added_tokens_decoder().values()):
        return False
    for word in ("ab", "don't", "x1"):
        alone = tokenizer.encode(word, add_special_tokens=False).ids
        for gap in sorted(_GAPS):
            got = tokenizer.encode(f"{word}{gap}{word}{gap}", add_special_tokens=False)
            if got.ids != alone * 2 or any(a <= len(word) < b for a, b in got.offsets):
                return False
    return True


def count_long(text: str, encode: Callable[[str], list[tuple]], chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> int:
    """Tokens of a long text; encode gives (id, start, end) for each token of a string."""

    def tokens(begin: int, end: int) -> list[tuple]:
        return [(i, a + begin, b + begin) for i, a, b in encode(text[begin:end])]

    total, begin, size, joined = 0, 0, chunk, 0
    left, end = tokens(0, size), size
    while end < len(text):
        width, cut = overlap, None
        while width < end - begin:
            start = end - width
            right = tokens(start, start + chunk + width)
            # only what lies in the overlap is compared
            near = [t for t in left if t[2] > start]
            cut = splice(near, [t for t in right if t[1] < end], text, max(start, joined), end)
            if cut is not None:
                break
            width *= 2
        if cut is None:  # no stable boundary in this chunk: a longer one takes its place
            size *= 2
            end = begin + size
            left = tokens(begin, end)
            continue
        total += sum(joined <= t[1] < cut for t in left)
        begin, left, joined, size = start, right, cut, chunk
        end = start + chunk + width
    return total + sum(t[1] >= joined for t in left)


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048, long_chars: int = LONG_CHARS) -> DataFrame:
    """id, n_bytes, n_tokens and over_limit of every row, by a tokenizers file that each executor can open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(tokenizer_path)
        longest = long_chars if drops_white_space(tokenizer) else sys.maxsize

        def encode(text: str) -> list[tuple]:
            got = tokenizer.encode(text, add_special_tokens=False)
            return [(i, *o) for i, o in zip(got.ids, got.offsets, strict=True)]

        for batch in batches:
            for part in shared.parts(batch, 1, 1 << 19):
                texts = part.column(1).to_pylist()
                counts = [0] * len(texts)
                short = [i for i, t in enumerate(texts) if len(t) <= longest]
                for i, got in zip(short, tokenizer.encode_batch_fast([texts[i] for i in short], add_special_tokens=False), strict=True):
                    counts[i] = len(got)
                for i, t in enumerate(texts):
                    if len(t) > longest:
                        counts[i] = count_long(t, encode)
                n_bytes = shared.text_bytes(part.column(1))[1]
                yield pa.record_batch([part.column(0), pa.array(n_bytes[1:] - n_bytes[:-1]), pa.array(counts, pa.int64())], ["id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_col).alias("id"), shared.text_or_empty(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"id {kind}, n_bytes bigint, n_tokens bigint")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
