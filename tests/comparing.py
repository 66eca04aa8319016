"""Compare results as sets of rows, whatever their order."""

import datetime
import math


def plain(value):
    """A value both engines write the same way."""
    if value is None or isinstance(value, (bool, str)):
        return value
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows(columns, records):
    """Rows with their columns in name order, sorted."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in records), key=repr)


def spark_rows(df):
    return sorted(df.columns), rows(df.columns, [tuple(r) for r in df.collect()])
