"""Hierarchical multi-length packing of token ids into sequences of several context sizes.

A document is its token ids and an end id.  Whole windows of `context` ids are cut off its front; what remains is routed to
the smallest tier (context, context / 2, ... 1) that holds it.  Tiers are packed from the longest to the shortest: a window
begins with the longest remainder of its tier, its gap takes the longest remainders that fit whole (they are of shorter
tiers), and where none fits, the shortest remainder is cut to fill it.  So every window is full.  Shorter tiers keep what
longer ones did not need, in windows of their own size; what no longer fills a window at the end of a task is cut into
powers of two.  Every sequence is a power of two long, so none is padded.

Tasks pack their own documents as they read them, in chunks of about `chunk_ids` ids and the longest document; ids are not
shuffled.  Then sequences are dealt to step groups of about `step_ids` ids: tier by tier, by their rank over all tasks
(counts per task and tier, summed up), so each group has the same number of every tier, to one, and groups differ by less
than two contexts.

Ids are those of the tokenizers library for the given file.  If the file is a plain byte-level BPE (ids in the order of the
merges, no normalizer), its vocabulary runs in tiktoken, five times as fast, with the same ids; any other file runs in the
library itself.

Edge cases: null and empty texts are the end id alone; rows that repeat an id are documents each, null ids are kept; other
columns are ignored; an empty table gives no pieces.
"""

from __future__ import annotations

import json
import os
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import shared
from .byte_bpe import PIECE_CHARS, safe_cuts

CONTEXT, CHUNK_IDS, STEP_IDS = 1024, 1 << 20, 1 << 19


def _byte_of_char() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def ranks_of(file: dict) -> dict[bytes, int] | None:
    """Ranks of a plain byte-level BPE file, None for any other: its merges must make the ids from 256 on, in order."""
    model, pre = file["model"], file.get("pre_tokenizer") or {}
    plain = not file.get("normalizer") and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
    if not plain or model.get("type", "BPE") != "BPE" or any(model.get(x) for x in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
        return None
    byte, added = _byte_of_char(), {x["content"] for x in file["added_tokens"]}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    if any(model["vocab"].get(a + b) != 256 + i for i, (a, b) in enumerate(merges)):
        return None
    words = {w: i for w, i in model["vocab"].items() if w not in added}
    if len(words) != 256 + len(merges) or any(x["lstrip"] or x["rstrip"] or x["single_word"] or x["normalized"] for x in file["added_tokens"]):
        return None
    return {bytes(byte[c] for c in w): i for w, i in words.items()}


@cache
def encoder(tokenizer_file: str, pattern: str, piece_chars: int = PIECE_CHARS) -> Callable[[str], np.ndarray]:
    """Text to ids (uint32) by a tokenizer file; pattern: the matches that a byte-level BPE encodes one by one."""
    with open(tokenizer_file, encoding="utf-8") as f:
        file = json.load(f)
    ranks = ranks_of(file)
    if ranks is None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(tokenizer_file)
        library.no_truncation()
        library.no_padding()
        return lambda text: np.array(library.encode(text, add_special_tokens=False).ids, np.uint32)
    import tiktoken

    codec = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={x["content"]: x["id"] for x in file["added_tokens"]})
    # Special strings hold no white space, so cuts before it leave them whole.
    whole = any(c.isspace() for x in file["added_tokens"] for c in x["content"])
    return lambda text: np.array([i for piece in ([text] if whole else safe_cuts(text, piece_chars)) for i in codec.encode(piece, allowed_special="all")], np.uint32)


class Packer:
    """Packs lengths of documents; `pieces` gets (document, start, length, sequence, offset, tier, rank in the tier)."""

    def __init__(self, context: int = CONTEXT) -> None:
        self.context, self.shelves, self.filled, self.held = context, [[] for _ in range(context + 1)], 0, 0
        self.pieces, self.sequences, self.ranks = [], 0, Counter()

    def put(self, length: int, doc: int, start: int) -> None:
        if length:
            self.shelves[length].append((doc, start))
            self.filled |= 1 << length
            self.held += length

    def take(self, length: int) -> tuple[int, int]:
        doc, start = self.shelves[length].pop()
        if not self.shelves[length]:
            self.filled ^= 1 << length
        self.held -= length
        return doc, start

    def emit(self, window: list[tuple[int, int, int]]) -> None:
        tier, offset = sum(x[2] for x in window), 0
        for doc, start, length in window:
            self.pieces.append((doc, start, length, self.sequences, offset, tier, self.ranks[tier]))
            offset += length
        self.sequences += 1
        self.ranks[tier] += 1

    def add(self, doc: int, length: int) -> None:
        whole = length - length % self.context
        for start in range(0, whole, self.context):
            self.emit([(doc, start, self.context)])
        self.put(length - whole, doc, whole)

    def window(self, size: int) -> tuple[list[tuple[int, int, int]], int]:
        """Pieces for a window, longest first, and the gap that is left when nothing more is held."""
        found, gap = [], size
        while gap and self.filled:
            length = (self.filled & ((2 << gap) - 1)).bit_length() - 1
            if length > 0:
                doc, start = self.take(length)
            else:
                above = self.filled >> gap
                least = gap + (above & -above).bit_length() - 1
                doc, start = self.take(least)
                self.put(least - gap, doc, start + gap)
                length = gap
            found.append((doc, start, length))
            gap -= length
        return found, gap

    def pack(self, final: bool, most_held: int = CHUNK_IDS // 2) -> None:
        """Windows of the longest tier, and of shorter ones at the end or when more than most_held ids wait for gaps."""
        size = self.context
        while size and (final or size == self.context or self.held > most_held):
            while self.filled >> (size // 2 + 1):
                found, gap = self.window(size)
                if gap and not final:
                    for doc, start, length in found:
                        self.put(length, doc, start)
                    return
                for part in _powers(found) if gap else [found]:
                    self.emit(part)
            size //= 2


def _powers(window: list[tuple[int, int, int]]) -> Iterator[list[tuple[int, int, int]]]:
    """The pieces of a window cut into windows whose sizes are its powers of two, the largest first."""
    rest, total = list(reversed(window)), sum(x[2] for x in window)
    while total:
        size, part = 1 << (total.bit_length() - 1), []
        total -= size
        while size:
            doc, start, length = rest.pop()
            if length > size:
                rest.append((doc, start + size, length - size))
                length = size
            part.append((doc, start, length))
            size -= length
        yield part


def pieces(docs: DataFrame, tokenizer_file: str, pattern: str, context: int = CONTEXT, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False, chunk_ids: int = CHUNK_IDS) -> DataFrame:
    """id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier, task, tier_rank and, with keep_ids, ids of every piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer, task = encoder(tokenizer_file, pattern), Packer(context), TaskContext.get().partitionId()
        held: dict[int, tuple] = {}
        count = waiting = 0

        def flushed(final: bool) -> pa.RecordBatch:
            packer.pack(final, chunk_ids // 2)
            made, packer.pieces = packer.pieces, []
            own = [held[p[0]] for p in made]
            cut = [ids[p[1] : p[1] + p[2]] for p, (_, ids) in zip(made, own, strict=True)]
            doc, start, length, sequence, offset, tier, rank = zip(*made, strict=True) if made else [()] * 7
            columns = [
                pa.array([x[0] for x in own], kind), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array([zlib.crc32(x) for x in cut], pa.int64()),
                pa.array([len(x[1]) for x in own], pa.int64()), pa.array([(task << 33) + x for x in sequence], pa.int64()), pa.array(offset, pa.int64()),
                pa.array(tier, pa.int32()), pa.array([task] * len(made), pa.int32()), pa.array(rank, pa.int64()),
            ]
            waits = {d for shelf in packer.shelves for d, _ in shelf}
            for d in [d for d in held if d not in waits]:
                del held[d]
            if keep_ids:
                columns.append(pa.array([x.astype(np.int32) for x in cut], pa.list_(pa.int32())))
            return pa.record_batch(columns, names)

        kind = None
        for batch in batches:
            kind = batch.column(0).type
            for part in shared.parts(batch, 1):
                for name, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    ids = np.append(encode(text), np.uint32(end_id)).astype("<u4")
                    held[count] = (name, ids)
                    packer.add(count, len(ids))
                    count, waiting = count + 1, waiting + len(ids)
                    if waiting >= chunk_ids:
                        waiting = 0
                        yield flushed(False)
        if kind is not None:
            yield flushed(True)

    assert context & (context - 1) == 0, "a context is a power of two"
    rows = docs.select(F.col(id_col).alias("id"), shared.text_or_empty(text_col).alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, tier int, task int, tier_rank bigint"
    schema += ", ids array<int>" if keep_ids else ""
    names = [x.split(" ")[0] for x in schema.split(", ")]
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def in_steps(packed: DataFrame, step_ids: int = STEP_IDS) -> DataFrame:
    """Pieces with `step`, the step group of their sequence, in place of task and tier_rank; packed must be a written table."""
    counts = packed.where("offset = 0").groupBy("task", "tier").agg(F.count("*").alias("n"))
    by_tier = Window.partitionBy("tier")
    before = F.sum("n").over(by_tier.orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    # A row for each task and tier.
    counts = counts.select("task", "tier", F.coalesce(before, F.lit(0)).alias("before"), F.sum("n").over(by_tier).alias("of_tier"))
    total = counts.select("tier", "of_tier").distinct().agg(F.sum(F.col("tier") * F.col("of_tier"))).first()[0] or 0
    steps = max(1, -(-total // step_ids))
    step = F.expr(f"(before + tier_rank) * {steps} div of_tier").alias("step")
    return packed.join(shared.sized(counts), ["task", "tier"]).select(*[c for c in packed.columns if c not in ("task", "tier_rank")], step)


def pack(docs: DataFrame, tokenizer_file: str, pattern: str, context: int = CONTEXT, end_id: int = 0, step_ids: int = STEP_IDS, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False, chunk_ids: int = CHUNK_IDS) -> DataFrame:
    """id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier, step and, with keep_ids, ids of every piece."""
    return in_steps(shared.written(pieces(docs, tokenizer_file, pattern, context, end_id, id_col, text_col, keep_ids, chunk_ids), "packed"), step_ids)
