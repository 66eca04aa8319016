"""Operators on DataFrames."""

from tellerloom.operators.clean import conform, dedup, drop_incomplete, is_complete
from tellerloom.operators.distribution import (
    distribution,
    flatten_quantiles,
    sketch_size,
    totals_distribution,
    weighted_distribution,
)
from tellerloom.operators.enrich import enrich, unmatched
from tellerloom.operators.factored import (
    factored_distribution,
    factored_mart,
    factored_totals_distribution,
    fan_out,
    rollups,
)
from tellerloom.operators.marts import (
    COUNTRY_DEPARTMENT_PAYMENT,
    COUNTRY_GENDER_ACCOUNT,
    country_department_payment,
    country_gender_account,
    segment_mart,
)
from tellerloom.operators.quality import quality_report

__all__ = [
    "COUNTRY_DEPARTMENT_PAYMENT", "COUNTRY_GENDER_ACCOUNT", "conform",
    "country_department_payment", "country_gender_account", "dedup", "distribution",
    "drop_incomplete", "enrich", "factored_distribution", "factored_mart",
    "factored_totals_distribution", "fan_out", "flatten_quantiles", "is_complete",
    "quality_report", "rollups", "segment_mart", "sketch_size", "totals_distribution", "unmatched",
    "weighted_distribution",
]
