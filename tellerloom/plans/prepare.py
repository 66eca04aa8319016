"""From a raw source to a prepared dataset: typed, complete, distinct, keyed and versioned."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from tellerloom.functions.keys import with_hash_key, with_validity
from tellerloom.operators.clean import conform, dedup, drop_incomplete
from tellerloom.specs import SPECS, DatasetSpec

T = TypeVar("T")


def cleaned(raw: DataFrame, spec: DatasetSpec, extra: str = "keep") -> DataFrame:
    """Conform to the declared schema, drop incomplete rows, then full-row duplicates."""
    return dedup(drop_incomplete(conform(raw, spec, extra), spec.required))


def prepare(
    raw: DataFrame,
    spec: DatasetSpec,
    as_of: datetime.date | None = None,
    extra: str = "keep",
    null_safe_key: bool = False,
) -> DataFrame:
    """The prepared dataset, with hash key and validity columns."""
    keyed = with_hash_key(cleaned(raw, spec, extra), spec.key, spec.key_column, null_safe_key)
    return with_validity(keyed, as_of)


def prepare_all(
    raw: Mapping[str, DataFrame],
    as_of: datetime.date | None = None,
    specs: Mapping[str, DatasetSpec] = SPECS,
) -> dict[str, DataFrame]:
    """Every dataset prepared, by name."""
    return {name: prepare(raw[name], spec, as_of) for name, spec in specs.items()}


def side_by_side(spark: SparkSession, jobs: Iterable[Callable[[], T]]) -> list[T]:
    """Run independent Spark jobs at the same time, so one job's last tasks do not idle the cluster.

    The first failure cancels the others, by a tag their Spark jobs carry, and is raised.
    """
    jobs = list(jobs)
    context, tag = spark.sparkContext, f"side-by-side-{uuid.uuid4().hex}"

    def tagged(job: Callable[[], T]) -> T:
        context.addJobTag(tag)
        try:
            return job()
        finally:
            context.removeJobTag(tag)

    with ThreadPoolExecutor(max_workers=max(1, len(jobs))) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(lambda j=j: tagged(j))) for j in jobs]
        ended, running = wait(started, return_when=FIRST_EXCEPTION)
        failed = [job for job in started if job in ended and job.exception()]
        # A job that is between two Spark jobs starts the next one only to see it cancelled too.
        while failed and running:
            context.cancelJobsWithTag(tag)
            _, running = wait(running, timeout=0.5)
    for job in failed:
        job.result()
    return [job.result() for job in started]
