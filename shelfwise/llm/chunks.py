"""Chunks of documents that ask owners of hash ranges about the hashes they hold.

A *chunk* is a bounded set of whole documents, a *bucket* is a bounded range of hashes. A chunk
sends each bucket the sorted distinct hashes that fall into it, and the bucket answers with one
bit per hash. The order of both is the order of the hashes, so an answer can be read again after
a recomputation, whatever order the rows then have. A hash that stands in very many documents is
sent once by each chunk, and no message holds more than a chunk's share of a bucket.

The documents are dealt to their chunks by one shuffle, which the later steps reuse.
"""

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from shelfwise.session import parallelism

CHUNK_BYTES = 4 << 20
BUCKET_BYTES = 16 << 20
#: The least bytes of text per message between a chunk and a bucket, on average.
MESSAGE_BYTES = 1000

MESSAGE = "bucket int, chunk long, kind int, body binary"
#: Stands for a missing id, so that it comes after every other.
NO_ID = np.iinfo(np.int64).max


class Grid(NamedTuple):
    chunks: int
    buckets: int


def grid_for(size: int, width: int) -> Grid:
    """Numbers of chunks and buckets for ``size`` bytes of text.

    Chunks and buckets keep their usual bytes until there would be too many small messages; from
    there on both grow with the square root of the input.
    """
    usual = CHUNK_BYTES * BUCKET_BYTES
    growth = max(1.0, (MESSAGE_BYTES * size / usual) ** 0.5)
    return Grid(
        max(2 * width, int(size / (CHUNK_BYTES * growth)) + 1),
        max(2 * width, int(size / (BUCKET_BYTES * growth)) + 1),
    )


def plan_grid(docs: DataFrame, text: str = "text") -> Grid:
    size = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    return grid_for(size, parallelism(docs.sparkSession))


def chunked(docs: DataFrame, grid: Grid) -> DataFrame:
    """Columns chunk, doc_id, text and rest (a struct of all columns).

    Rows of one id share a chunk; rows without an id share one if their texts are equal.
    """
    key = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    return docs.select(
        F.pmod(key, F.lit(grid.chunks)).cast("long").alias("chunk"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("rest"),
    )


def restored(result: DataFrame, columns: list[str], added: list[str]) -> DataFrame:
    """The documents' columns in their order, then the added ones; equal names are replaced."""
    given = [
        F.col("text") if c == "text" else F.col("rest").getField(c).alias(c)
        for c in columns
        if c not in added
    ]
    return result.select(*given, *added)


def ids(table: pa.Table) -> np.ndarray:
    return table.column("doc_id").combine_chunks().fill_null(NO_ID).to_numpy(zero_copy_only=False)


def bucket_slices(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins in the sorted ``hashes``, and the end."""
    owner = ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    return np.searchsorted(owner, np.arange(buckets + 1, dtype=np.uint64))


def messages(chunk: int, slices: np.ndarray, kind: int, *columns: np.ndarray) -> pa.Table:
    """One row per bucket that gets something: the bytes of its slice of each column."""
    full = np.flatnonzero(np.diff(slices))
    bodies = [b"".join(c[slices[k] : slices[k + 1]].tobytes() for c in columns) for k in full]
    return message_table(full, [chunk] * len(full), kind, bodies)


def message_table(buckets, chunks, kind, bodies) -> pa.Table:
    return pa.table(
        {
            "bucket": pa.array(np.asarray(buckets, np.int32), pa.int32()),
            "chunk": pa.array(np.asarray(chunks, np.int64), pa.int64()),
            "kind": pa.array([kind] * len(bodies), pa.int32()),
            "body": pa.array(bodies, pa.binary()),
        }
    )


def of_kind(table: pa.Table, kind: int) -> tuple[list[int], list[int], list[bytes]]:
    """Buckets, chunks and bodies of the messages of one kind."""
    picked = table.filter(pc.equal(table.column("kind"), kind))
    return tuple(picked.column(c).to_pylist() for c in ("bucket", "chunk", "body"))


def read_bits(replies: pa.Table, kind: int, slices: np.ndarray) -> np.ndarray:
    """The answers to everything a chunk sent, in its order."""
    out = np.zeros(int(slices[-1]), bool)
    buckets, _, bodies = of_kind(replies, kind)
    for bucket, body in zip(buckets, bodies):
        a, b = slices[bucket], slices[bucket + 1]
        out[a:b] = np.unpackbits(np.frombuffer(body, np.uint8), count=int(b - a)).astype(bool)
    return out
