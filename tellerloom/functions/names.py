"""Column names as references, and case rules."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def ref(name: str) -> Column:
    """A column by its exact name, also when it holds a dot, blank or backtick."""
    return F.col("`" + name.replace("`", "``") + "`")


def folding(spark: SparkSession) -> Callable[[str], str]:
    """How the session compares names: as they are, or without case."""
    return str if spark.conf.get("spark.sql.caseSensitive") == "true" else str.lower


def matching(df: DataFrame, name: str) -> list[str]:
    """The columns of ``df`` that ``name`` refers to in its session."""
    fold = folding(df.sparkSession)
    return [column for column in df.columns if fold(column) == fold(name)]


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with as many underscores before it as it takes to be no column of ``df``."""
    while matching(df, wanted):
        wanted = f"_{wanted}"
    return wanted


def owners(frames: dict[str, DataFrame], names: Iterable[str]) -> dict[str, str]:
    """The one frame each name belongs to; unknown and ambiguous names raise."""
    found = {}
    for name in names:
        holding = [label for label, frame in frames.items() if matching(frame, name)]
        if len(holding) != 1:
            where = f"in {' and '.join(holding)}" if holding else "in none of the inputs"
            raise ValueError(f"column {name!r} is {where}")
        found[name] = holding[0]
    return found
