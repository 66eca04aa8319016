"""Conforming to a declared schema, dropping incomplete rows, removing duplicates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from tellerloom.functions.casts import lenient_cast
from tellerloom.functions.names import folding, free_name, matching, ref
from tellerloom.specs import DatasetSpec


def conform(df: DataFrame, spec: DatasetSpec, extra: str = "keep") -> DataFrame:
    """Cast the declared columns, under their declared spelling, in one projection.

    Undeclared columns stay where they are with ``extra="keep"``. With ``extra="drop"`` the result
    has exactly the declared columns in declared order.
    """
    if extra not in ("keep", "drop"):
        raise ValueError(f"extra must be 'keep' or 'drop', not {extra!r}")
    for field in spec.schema:
        hits = matching(df, field.name)
        if len(hits) != 1:
            problem = "missing" if not hits else "ambiguous"
            raise ValueError(f"{spec.name}: column {field.name!r} is {problem} in {df.columns}")

    fold = folding(df.sparkSession)
    declared = {fold(field.name): field for field in spec.schema}
    typed = {}
    for found in df.schema:
        field = declared.get(fold(found.name))
        if field is None:
            typed[found.name] = ref(found.name)
        else:
            cast = lenient_cast(ref(found.name), found.dataType, field.dataType)
            typed[field.name] = cast.alias(field.name)
    names = typed if extra == "keep" else spec.schema.names
    return df.select(*[typed[name] for name in names])


def is_complete(df: DataFrame, required: Sequence[str] | str | None = None) -> Column:
    """True where no required column (default: any column) is NULL or NaN.

    Written as plain null tests so that a columnar source can be given the filter.
    """
    if isinstance(required, str):
        required = [required]
    fields = df.select(*[ref(n) for n in (df.columns if required is None else required)]).schema
    tests = [ref(field.name).isNotNull() for field in fields]
    tests += [
        ~F.isnan(ref(field.name))
        for field in fields
        if isinstance(field.dataType, (DoubleType, FloatType))
    ]
    return reduce(and_, tests, F.lit(True))


def drop_incomplete(df: DataFrame, required: Sequence[str] | str | None = None) -> DataFrame:
    """Drop rows in which a required column (default: any column) is NULL or NaN."""
    return df.where(is_complete(df, required))


def dedup(
    df: DataFrame,
    subset: Sequence[str] | None = None,
    order_by: Sequence[Column] | None = None,
) -> DataFrame:
    """Remove duplicate rows, or keep one row per value of ``subset``.

    Which row stays for a subset is arbitrary, unless ``order_by`` ranks them: then the first one
    does, ties going to the smallest remaining columns, so that the result is the same every run.
    """
    if subset is None:
        return df.dropDuplicates()
    if order_by is None:
        return df.dropDuplicates(list(subset))
    kept = {column for name in subset for column in matching(df, name)}
    rest = [ref(name) for name in df.columns if name not in kept]
    ranked = Window.partitionBy(*[ref(name) for name in subset]).orderBy(*order_by, *rest)
    position = free_name(df, "_position")
    numbered = df.withColumn(position, F.row_number().over(ranked))
    return numbered.where(ref(position) == 1).drop(position)
