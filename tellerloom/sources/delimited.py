"""Delimited text files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from tellerloom.specs import SPECS, DatasetSpec


def read_delimited(spark: SparkSession, uri: str, sep: str = ",", **options: str) -> DataFrame:
    """Read delimited files with a header line, every column as text.

    ``uri`` is any path Spark can open: object store, HDFS or local; a file, folder or pattern. A file
    whose header differs from the others' fails the read, as its columns would else be taken for
    theirs; ``enforceSchema="true"`` takes them so.
    """
    settings = {"header": "true", "sep": sep, "enforceSchema": "false", **options}
    return spark.read.options(**settings).csv(uri)


def read_dataset(spark: SparkSession, base_uri: str, spec: DatasetSpec) -> DataFrame:
    """Read one dataset from its declared file under ``base_uri``."""
    return read_delimited(spark, f"{base_uri.rstrip('/')}/{spec.path}", spec.sep)


def read_datasets(
    spark: SparkSession, base_uri: str, specs: Iterable[DatasetSpec] = tuple(SPECS.values())
) -> dict[str, DataFrame]:
    """Read every declared dataset, by name."""
    return {spec.name: read_dataset(spark, base_uri, spec) for spec in specs}
