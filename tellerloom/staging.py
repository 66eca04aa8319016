"""Intermediate tables in the cluster's shared folder.

A staged table cuts the lineage at files every executor can read, so losing executors later costs a
re-read and not a recomputation. It also gives the optimizer the true size of what was written.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from tellerloom.counting import counted

_local_folders: dict[str, str] = {}
_in_place: list[Staging] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="tellerloom-")
    return _local_folders[app]


class Staging:
    """The staged tables of one run, under a folder of their own.

    They are left in place for the lazy results that still read them. ``drop``, or leaving a
    ``with`` block, removes them; the end of the process removes what is left.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/tellerloom/{uuid.uuid4().hex}"
        files, path = self._place()
        files.mkdirs(path)
        files.deleteOnExit(path)
        _in_place.append(self)

    def _place(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def table(self, df: DataFrame, label: str) -> DataFrame:
        """Write ``df`` once and return a scan of what was written."""
        path = f"{self.root}/{label}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def measured(self, df: DataFrame, label: str, *measures: Column) -> tuple[DataFrame, dict]:
        """A staged table, and aggregates over its rows taken while they are written."""
        written = Observation(label)
        table = self.table(df.observe(written, *measures), label)
        return table, written.get

    def counted(self, df: DataFrame, label: str) -> tuple[DataFrame, int]:
        """A staged table and its number of rows."""
        observed, rows = counted(df, label)
        return self.table(observed, label), rows.get["rows"]

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *failure: object) -> None:
        self.drop()

    def drop(self) -> None:
        """Remove this run's tables; call it once nothing reads them any more."""
        files, path = self._place()
        files.delete(path, True)
        if self in _in_place:
            _in_place.remove(self)


def drop_staged() -> None:
    """Remove every staged table this process has left in place, before its session stops."""
    for staging in list(_in_place):
        staging.drop()

