"""Derived row columns: hash keys and validity."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerloom.functions.names import ref


def hash_key(columns: Sequence[str], null_safe: bool = False) -> Column:
    """SHA-256, in hex, of the key columns as text joined by ``||``.

    That encoding skips NULLs and does not escape the delimiter, so different keys can share a
    hash. ``null_safe`` prefixes every value with its length and marks NULLs, which cannot collide.
    """
    if not null_safe:
        return F.sha2(F.concat_ws("||", *[ref(name) for name in columns]), 256)
    texts = [ref(name).cast("string") for name in columns]
    parts = [F.coalesce(F.concat(F.length(t), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def with_hash_key(
    df: DataFrame, columns: Sequence[str], name: str = "pk_hash", null_safe: bool = False
) -> DataFrame:
    """Add the hash key of ``columns`` as column ``name``."""
    return df.withColumn(name, hash_key(columns, null_safe))


def with_validity(
    df: DataFrame,
    as_of: datetime.date | None = None,
    flag: str = "valid_flag",
    start: str = "valid_from",
    end: str = "valid_until",
) -> DataFrame:
    """Stamp every row as the open version valid from ``as_of`` (default: today)."""
    opened = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    return df.withColumns({flag: F.lit(True), start: opened, end: F.lit(None).cast("date")})
