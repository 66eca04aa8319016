"""What preparation and joining did to the rows: nothing gets lost without a number for it."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerloom.functions.names import free_name, matching, ref
from tellerloom.operators.clean import conform, is_complete
from tellerloom.operators.factored import Rollups, fan_out, rollups
from tellerloom.specs import ACCOUNTS, MASTER, SPECS, TRANSACTIONS, DatasetSpec


def _long(one_row: DataFrame, dataset: str) -> DataFrame:
    """A row of measures as one row per measure."""
    pairs = [
        F.struct(F.lit(name).alias("measure"), ref(name).cast("double").alias("value"))
        for name in one_row.columns
    ]
    exploded = one_row.select(F.explode(F.array(*pairs)).alias("pair"))
    return exploded.select(F.lit(dataset).alias("dataset"), "pair.measure", "pair.value")


LOST = "_lost"


def typed_with_losses(raw: DataFrame, spec: DatasetSpec) -> DataFrame:
    """The conformed rows, and in ``_lost`` which columns of another type had a value and lost it.

    Stored once, it serves the preparation (without ``_lost``) and the quality report, so that a
    source is parsed once. A source may not have a column ``_lost`` of its own.
    """
    if matching(raw, LOST):
        raise ValueError(f"{spec.name}: column {LOST!r} is taken by the report")
    before = free_name(raw, "_raw")
    typed = conform(raw.withColumn(before, F.struct(*[ref(name) for name in raw.columns])), spec)
    raw_types = {field.name: field.dataType for field in raw.schema}
    lost = []
    for field in spec.schema:
        source = matching(raw, field.name)[0]
        if raw_types[source] != field.dataType:
            gone = F.col(before)[source].isNotNull() & ref(field.name).isNull()
            lost.append(gone.alias(field.name))
    # A struct needs a field, also where every column has its type already.
    return typed.withColumn(LOST, F.struct(*lost, F.lit(False).alias("_"))).drop(before)


def source_quality(source: DataFrame, spec: DatasetSpec) -> DataFrame:
    """One row, in one scan: rows read, values that did not parse, rows with a required gap.

    ``source`` is raw, or what ``typed_with_losses`` made of it.
    """
    typed = source if LOST in source.columns else typed_with_losses(source, spec)
    lost = [name for name in typed.schema[LOST].dataType.names if name != "_"]
    failed = [F.count_if(F.col(LOST)[name]).alias(f"unparsed_{name}") for name in lost]
    required = spec.required
    if required is None:
        required = [name for name in typed.columns if name != LOST]
    incomplete = F.count_if(~is_complete(typed, required)).alias("rows_incomplete")
    return typed.agg(F.count(F.lit(1)).alias("rows_read"), *failed, incomplete)


def prepared_quality(prepared: DataFrame, spec: DatasetSpec) -> DataFrame:
    """One row: rows kept, and rows whose hash key another kept row already has."""
    rows = F.count(F.lit(1))
    # The hash as bytes is half as long as in hex, and every row's hash is shuffled here.
    keys = F.count_distinct(F.unhex(ref(spec.key_column)))
    return prepared.agg(rows.alias("rows_kept"), (rows - keys).alias("repeated_keys"))


def quality_report(
    raw: Mapping[str, DataFrame],
    prepared: Mapping[str, DataFrame],
    specs: Mapping[str, DatasetSpec] = SPECS,
    rolled: Rollups | None = None,
) -> DataFrame:
    """All measures as rows of dataset, measure, value. ``raw`` may be typed as for ``source_quality``.

    Rows read, minus the incomplete, minus the kept, are the full-row duplicates removed. The joined
    table's size and fan-out come from per-customer counts, without joining the rows.
    """
    parts = [_long(source_quality(raw[name], spec), name) for name, spec in specs.items()]
    parts += [_long(prepared_quality(prepared[name], spec), name) for name, spec in specs.items()]
    if rolled is None:
        rolled = rollups(*[prepared[s.name] for s in (TRANSACTIONS, ACCOUNTS, MASTER)], dims=())
    parts.append(_long(fan_out(rolled), "joined"))
    return reduce(DataFrame.unionByName, parts)
