"""Datasets stored in a columnar or other self-describing format."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from tellerloom.specs import SPECS


def read_stored(
    spark: SparkSession,
    base_uri: str,
    names: Iterable[str] = tuple(SPECS),
    format: str = "parquet",
) -> dict[str, DataFrame]:
    """Read one folder per dataset under ``base_uri``, by name.

    Columns come with the types they were stored with; ``conform`` casts what differs.
    """
    base = base_uri.rstrip("/")
    return {name: spark.read.format(format).load(f"{base}/{name}") for name in names}
