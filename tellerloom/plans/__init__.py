"""Compositions: per-dataset preparation and the batch job."""

from tellerloom.plans.batch import (
    MART_DIMS,
    described,
    marts,
    prepared_tables,
    preview,
    run_pipeline,
    stage_enrich,
    stage_marts,
    stage_prepare,
    stage_prepare_checked,
    stage_quality,
)
from tellerloom.plans.prepare import cleaned, prepare, prepare_all

__all__ = [
    "MART_DIMS", "cleaned", "described", "marts", "prepare", "prepare_all", "prepared_tables", "preview",
    "run_pipeline", "stage_enrich", "stage_marts", "stage_prepare", "stage_prepare_checked",
    "stage_quality",
]
