"""Times the headline queries on one machine and prints one JSON line.

``BENCH_SF_DIR`` names the folder of tables, ``BENCH_CPUS`` the number of task slots. Every run
builds its DataFrames anew, so nothing is reused from the run before, and writes all rows to a sink
that keeps none. The reported time of a query is the median of its runs after two warm-ups.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import time

from pyspark.sql import DataFrame, SparkSession

from tellerloom import operators as ops
from tellerloom import plans, standin
from tellerloom.queries import AS_OF, QUERIES
from tellerloom.sinks import FileSink
from tellerloom.sources import read_datasets
from tellerloom.specs import SPECS
from tellerloom.staging import Staging, drop_staged

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
RUNS = int(os.environ.get("BENCH_RUNS", "5"))
WARM_UPS = 2

TIMED_QUERIES = [
    "mart_country_gender_account",
    "mart_country_department_payment",
    "distribution_by_country",
    "distribution_of_country_totals",
    "joined_detail",
    "joined_country_gender_account",
    "joined_distribution",
    "joined_distribution_exact",
    "hot_customer_country_gender_account",
    "hot_customer_distribution",
    "prepared_transactions",
    "dedup_latest",
    "unmatched_transactions",
]


def drained(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def three_marts(spark: SparkSession) -> None:
    """The three marts of the stand-in, from shared rollups."""
    with Staging(spark) as staging:
        for build in plans.marts(standin.datasets(spark, FOLDER), staging).values():
            drained(build())


def three_marts_joined(spark: SparkSession) -> None:
    """The three marts from one kept joined table, quantiles estimated."""
    columns = [*plans.MART_DIMS, "CustomerID", "Montant"]
    joined = ops.enrich(*standin.datasets(spark, FOLDER).values(), columns=columns).persist()
    drained(ops.country_gender_account(joined))
    drained(ops.country_department_payment(joined))
    drained(ops.distribution(joined))
    joined.unpersist(blocking=True)


def session() -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def main() -> None:
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")

    files = Staging(spark).root
    for name, df in standin.datasets(spark, FOLDER).items():
        spec = SPECS[name]
        sink = FileSink(files, "csv", {"header": "true", "sep": spec.sep})
        sink.save(df, spec.path, "overwrite")

    def batch_job(spark: SparkSession) -> None:
        sources = read_datasets(spark, files)
        plans.run_pipeline(spark, sources, FileSink(Staging(spark).root), AS_OF)

    jobs = {name: lambda s, q=QUERIES[name]: drained(q(s, FOLDER)) for name in TIMED_QUERIES}
    jobs["three_marts"] = three_marts
    jobs["three_marts_joined"] = three_marts_joined
    jobs["batch_job_from_files"] = batch_job

    seconds = {}
    for name, job in jobs.items():
        taken = []
        for _ in range(WARM_UPS + RUNS):
            started = time.perf_counter()
            job(spark)
            taken.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(taken[WARM_UPS:]), 3)
    drop_staged()
    spark.stop()

    scale = re.search(r"sf([\d.]+)", FOLDER)
    print(json.dumps({
        "metric": "sum of the median query times",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale.group(1)) if scale else FOLDER,
        "cpus": int(CPUS),
    }))


if __name__ == "__main__":
    main()
