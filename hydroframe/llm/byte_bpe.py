"""Byte-level BPE: encoding by a rank file with tiktoken, and raw-byte decoding.

Texts longer than `piece_chars` are cut before regex matching, at safe boundaries only: before a space or line feed that
follows a character other than white space.  No match of the pattern crosses such a place (white space may only open a
match or fill it), and none looks beyond it, so the cut text gives the same ids.  A stretch without such a place stays
whole.

Edge cases: null and empty texts give no ids and decode to no bytes; repeated and null ids are kept; other columns are
ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared

PIECE_CHARS = 1 << 16


@cache
def encoding(rank_file: str, pattern: str):
    import tiktoken

    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def safe_cuts(text: str, most: int = PIECE_CHARS) -> Iterator[str]:
    """Pieces of a text of about `most` characters, cut at safe boundaries only."""
    at = 0
    while len(text) - at > most:
        to = at + most
        while to < len(text) and not (text[to] in " \n" and not text[to - 1].isspace()):
            to += 1
        yield text[at:to]
        at = to
    yield text[at:]


def _mapped(docs: DataFrame, id_col: str, text_col: str, schema: str, rank_file: str, pattern: str, row, piece_chars: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoding(rank_file, pattern)
        for batch in batches:
            for part in shared.parts(batch, 1):
                found = [row(codec, safe_cuts(text, piece_chars)) for text in part.column(1).to_pylist()]
                columns = [pa.array(list(x), kind) for x, (_, kind) in zip(zip(*found, strict=True), fields, strict=True)]
                yield pa.record_batch([part.column(0), *columns], ["id", *(name for name, _ in fields)])

    arrow = {"bigint": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32()), "binary": pa.binary()}
    fields = [(name, arrow[kind]) for name, kind in (x.split(" ") for x in schema.split(", "))]
    rows = docs.select(F.col(id_col).alias("id"), shared.text_or_empty(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, {schema}").withColumnRenamed("id", id_col)


def encode(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", piece_chars: int = PIECE_CHARS) -> DataFrame:
    """id, n_tokens and ids (an array) of every row."""

    def row(codec, pieces):
        ids = [i for piece in pieces for i in codec.encode_ordinary(piece)]
        return len(ids), ids

    return _mapped(docs, id_col, text_col, "n_tokens bigint, ids array<int>", rank_file, pattern, row, piece_chars)


def decode(encoded: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id and bytes (raw, which need not be UTF-8) of every row of ids; null counts as no ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoding(rank_file, pattern)
        for batch in batches:
            decoded = [codec.decode_bytes(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(decoded, pa.binary())], ["id", "bytes"])

    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, bytes binary").withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", piece_chars: int = PIECE_CHARS, keep_ids: bool = False) -> DataFrame:
    """Encode and decode in one pass: id, n_tokens, ids_sha256, decoded_sha256 and, with keep_ids, ids (an array)."""

    def row(codec, pieces):
        n, every, ids_hash, bytes_hash = 0, [], hashlib.sha256(), hashlib.sha256()
        for piece in pieces:
            ids = codec.encode_ordinary(piece)
            if ids:
                ids_hash.update((" " * (n > 0) + str(ids)[1:-1].replace(",", "")).encode())
                bytes_hash.update(codec.decode_bytes(ids))
                n += len(ids)
                if keep_ids:
                    every += ids
        return n, ids_hash.hexdigest(), bytes_hash.hexdigest(), *([every] if keep_ids else [])

    more = ", ids array<int>" if keep_ids else ""
    return _mapped(docs, id_col, text_col, f"n_tokens bigint, ids_sha256 string, decoded_sha256 string{more}", rank_file, pattern, row, piece_chars)
