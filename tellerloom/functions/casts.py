"""Text-to-type casts in which a malformed value becomes NULL and never fails the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType, StringType

# An optional sign, digits, a point and a fraction: read as the whole number before the point.
_FRACTION = r"^[\s\p{Cntrl}]*(?<sign>[+-]?)(?<whole>\d*)\.\d*[\s\p{Cntrl}]*$"


def lenient_cast(column: Column, source: DataType, target: DataType) -> Column:
    """Cast ``column`` from ``source`` to ``target``; what does not parse is NULL.

    Text cast to a whole number keeps the part before the point: ``3.7`` is 3 and ``.5`` is 0.
    """
    if source == target:
        return column
    if isinstance(source, StringType) and isinstance(target, IntegralType):
        column = F.regexp_replace(column, _FRACTION, "${sign}0${whole}")
    return column.try_cast(target)


def money(column: Column, exact: bool) -> Column:
    """The amount to add up: as it is, or in whole cents so that sums do not depend on order.

    An amount that is no number of cents fails the job, whatever the session's mode: one that is not
    a number, has more than sixteen digits before the point, or parts of a cent beyond what floating
    point makes of cents.
    """
    if not exact:
        return column
    cents = column.try_cast("decimal(18,2)")
    amount = column.cast("double")
    noise = F.greatest(F.lit(1e-6), F.abs(amount) * 1e-15)
    lost = cents.isNull() | (F.abs(amount - cents.cast("double")) > noise)
    message = F.concat(F.lit("not an amount in whole cents: "), column.cast("string"))
    return F.when(column.isNotNull() & lost, F.raise_error(message)).otherwise(cents)
