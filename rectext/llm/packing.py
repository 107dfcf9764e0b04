"""Packing by power-of-two decomposition.

A document of n tokens is cut into pieces whose lengths are powers of two: as
many of the sequence length as fit, then one for each binary digit of the
rest, longest first. Pieces of equal length share a bucket, and each piece is
a whole sequence of its bucket, so batches of one bucket need no padding and
no sequence crosses documents.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rectext.llm.common import map_rows
from rectext.llm.words_bpe import encoder

SEQUENCE = 4096
END = 2

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary")


def cuts(n: int, longest: int = SEQUENCE) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of ``n`` tokens; ``longest`` is a power of two."""
    out, start = [], 0
    while n - start >= longest:
        out.append((start, longest))
        start += longest
    while n > start:
        length = 1 << ((n - start).bit_length() - 1)
        out.append((start, length))
        start += length
    return out


def pack(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
         longest: int = SEQUENCE, end: int = END, with_ids: bool = True) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset`` (and the piece's ``ids``, little-endian unsigned
    32-bit). ``length`` is the bucket. A null or empty text has only the end
    id, one piece of length 1. Sequences are numbered by task and row, so a
    task that is run again gives the same numbers; equal rows and null ids
    are packed like any other, and other columns are not read."""
    if longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def start():
        coder = encoder(tokenizer)
        tail = end.to_bytes(4, "little")

        def f(ids, texts):
            rows = []
            for i, b in zip(ids, coder.encode_all([raw.decode() if raw else "" for raw in texts])):
                b += tail
                n = len(b) // 4
                for s, k in cuts(n, longest):
                    piece = b[4 * s:4 * (s + k)]
                    rows.append((i, s, k, zlib.crc32(piece), n, piece if with_ids else None))
            return dict(zip(names, map(list, zip(*rows))))

        return f

    pieces = map_rows(docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")), SCHEMA, start)
    out = pieces.withColumns({"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})
    return out if with_ids else out.drop("ids")


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Sequences as Parquet, one folder per length (at most 13)."""
    pieces.hint("rebalance").withColumn("bucket", F.col("length")).write.partitionBy("bucket").mode("overwrite").parquet(path)
