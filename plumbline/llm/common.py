"""Helpers shared by the operators: held-out splits, settled tables, words, Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.session import settle  # noqa: F401  (written to spark.checkpoint.dir and read back)

BLANKS = "\x20\x09-\x0d"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_names(docs: DataFrame, *names: str) -> list[str]:
    """``names``, lengthened where ``docs`` has a column of that name (in any case)."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def id_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id written as text, modulo ``divisor``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def bytes_of(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column, null as empty."""
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]


def words_of(text: bytes) -> list[bytes]:
    """Words between the blanks 0x20 and 0x09 to 0x0D, lower-cased A to Z only."""
    return text.lower().split()


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int) -> Iterator[pa.RecordBatch]:
    """The rows of all batches in pieces of about ``most`` text bytes, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        piece = np.cumsum(_lengths(batch.column(text)).astype(np.int64)) // most
        cuts = np.flatnonzero(np.diff(piece)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            if b > a:
                yield batch.slice(int(a), int(b - a))


def _lengths(column: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def split_column(column: str) -> Column:
    """Words of a text column, counted without keeping them."""
    return F.regexp_count(F.coalesce(F.col(column), F.lit("")), F.lit(f"[^{re.escape(' ')}\\x09-\\x0D]+"))
