"""What several operators of this folder share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def keyed_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id`` as a long and ``text`` as UTF-8 bytes, empty where it is null; nothing else."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"),
    )


def remainder(column: Column, modulus: int) -> Column:
    """crc32 of a value's text modulo ``modulus``; a null counts as the empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


def byte_strings(column: pa.Array) -> list[bytes]:
    """An Arrow binary column as Python bytes, nulls as empty."""
    return [value or b"" for value in column.to_pylist()]


def list_slices(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of an Arrow list column, without a Python object per element."""
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False), offsets


def thinned(key: Column, wanted: int, count: Column | int) -> Column:
    """A condition that keeps about ``wanted`` of ``count`` rows, all if there are fewer, by a hash.

    Unlike sorting by the hash, it needs no task that meets rows of all others.
    """
    total = F.lit(count) if isinstance(count, int) else count
    share = F.lit(float(wanted)) / F.greatest(F.lit(1.0), total.cast("double"))
    return F.pmod(key, F.lit(1 << 30)) < share * float(1 << 30)
