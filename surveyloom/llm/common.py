"""What the corpus operators share: row keys, tables in the shared folder, byte columns inside tasks."""

from __future__ import annotations

import ctypes
import hashlib

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.holding import settle, shared_folder

__all__ = ["settle", "shared_folder", "table", "keyed", "held_out", "same_row", "texts_of", "sha256_hex", "word_bytes", "give_back", "pieces", "parts_for"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, tag, text): only the two columns that an operator reads, so others cannot clash.

    ``tag`` tells rows apart that share an id (or have none) but not their text.
    """
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("tag"), text.alias("text"))


def same_row(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["tag"] == right["tag"])


def held_out(id_col: Column, modulus: int, remainder: int) -> Column:
    """crc32 of the id as text, modulo; rows without id count as not held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def sha256_hex(data) -> str:
    return hashlib.sha256(data).hexdigest()


def word_bytes(keep) -> bytes:
    """Translation table: A-Z to lower case, bytes outside ``keep`` to spaces."""
    lower = bytes(range(256)).lower()
    return bytes(lower[b] if keep(lower[b]) else 32 for b in range(256))


def give_back() -> None:
    """Freed memory goes back to the system; a worker that is used again would keep the peak of every earlier stage."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def pieces(batch: pa.RecordBatch, limit: int, column: str | int = "text"):
    """A batch in runs of rows with about ``limit`` bytes of text, at least one row each; what they left is given back at the end."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, size in enumerate(sizes.tolist()):
        total += size
        if total >= limit or i == len(sizes) - 1:
            yield batch.slice(start, i + 1 - start)
            start, total = i + 1, 0
    give_back()


def parts_for(amount: int | None, per_part: int, spark: SparkSession) -> int:
    """Partitions of ``per_part`` each, at least as many as the session's shuffles have."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(amount or 0) // per_part))
