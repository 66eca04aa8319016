import datetime
import time

import pytest
from pyspark.sql import functions as F

from tellerloom import standin
from tellerloom.operators import quality_report
from tellerloom.plans import (
    described, prepare, prepared_tables, preview, run_pipeline, stage_enrich, stage_marts, stage_prepare,
    stage_prepare_checked, stage_quality,
)
from tellerloom.plans.prepare import side_by_side
from tellerloom.sinks import FileSink, write_table
from tellerloom.sources import read_datasets
from tellerloom.specs import SPECS
from tellerloom.staging import shared_folder
from tests.samples import collected

FOLDER = "/root/testdata/sf0.001"
DAY = datetime.date(2025, 8, 28)
ROWS = {
    "df_agg_country_gender_account": 45, "df_agg_country_department_payment": 125,
    "df_stats_transact": 5,
}


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("files"))
    for name, df in standin.datasets(spark, FOLDER).items():
        spec = SPECS[name]
        write_table(df, FileSink(base, "csv", {"header": "true", "sep": spec.sep}), spec.path)
    return base


def staged_files(spark):
    import os
    root = f"{shared_folder(spark)}/tellerloom"
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def test_whole_job_from_files(spark, files, tmp_path):
    before = staged_files(spark)
    sink = FileSink(str(tmp_path))
    assert run_pipeline(spark, read_datasets(spark, files), sink, DAY) == ROWS
    stats = spark.read.parquet(sink.uri("df_stats_transact"))
    assert stats.columns == ["Country", "moyenne", "mediane", "quantiles"]
    assert stats.where(F.col("mediane") != F.col("quantiles")[1]).count() == 0
    assert staged_files(spark) == before


def test_store_keeps_prepared_datasets_and_gives_the_same_marts(spark, files, tmp_path, capsys):
    sources = read_datasets(spark, files)
    store, sink, direct = str(tmp_path / "store"), FileSink(str(tmp_path / "a")), FileSink(str(tmp_path / "b"))
    options = {"exact_money": True, "as_array": False}
    assert run_pipeline(spark, sources, sink, DAY, store=store, previews=1, **options) == ROWS
    assert "nb_clients" in capsys.readouterr().out
    run_pipeline(spark, sources, direct, DAY, **options)
    for table in ROWS:
        stored = collected(spark.read.parquet(sink.uri(table)))
        assert stored == collected(spark.read.parquet(direct.uri(table)))
    prepared = prepared_tables(spark, store)
    assert prepared["transactions"].columns[-4:] == [
        "transaction_pk", "valid_flag", "valid_from", "valid_until"
    ]
    assert prepared["info_global"].where(F.col("valid_from") == F.lit(DAY)).count() == 150


def test_stages_can_be_repeated(spark, files, tmp_path):
    sources = read_datasets(spark, files)
    store, sink = str(tmp_path / "store"), FileSink(str(tmp_path / "marts"))
    for _ in range(2):
        counts = stage_prepare(spark, sources, store, DAY)
        assert counts["transactions"] == 1500 and counts["info_global"] == 150
        assert stage_enrich(spark, store) == 4404
        assert stage_marts(spark, store, sink) == ROWS
    joined = spark.read.parquet(f"{store}/joined")
    assert len(joined.columns) == 32
    totals = joined.agg(F.sum(F.col("Montant").cast("decimal(18,2)"))).first()[0]
    for table in list(ROWS)[:2]:
        mart = spark.read.parquet(sink.uri(table))
        assert mart.agg(F.sum("total_montant")).first()[0] == pytest.approx(float(totals))


def measures(report):
    return {(r["dataset"], r["measure"]): r["value"] for r in report.collect()}


def test_quality_report_accounts_for_every_row(spark, files, tmp_path):
    sources = read_datasets(spark, files)
    raw = sources["transactions"]
    spoiled = raw.withColumn(
        "Montant", F.when(F.col("MoyenPaiement") == "1-URGENT", "n/a").otherwise(F.col("Montant"))
    )
    sources = {**sources, "transactions": spoiled.unionByName(spoiled)}
    stage_prepare(spark, sources, str(tmp_path), DAY)
    got = measures(stage_quality(spark, sources, str(tmp_path)))
    urgent = raw.where("MoyenPaiement = '1-URGENT'").count()
    tx = {m: v for (d, m), v in got.items() if d == "transactions"}
    assert tx == {
        "rows_read": 3000, "unparsed_Montant": 2 * urgent, "unparsed_DateTransaction": 0,
        "rows_incomplete": 2 * urgent, "rows_kept": 1500 - urgent, "repeated_keys": 0,
    }
    assert got["joined", "transactions"] == 1500 - urgent and got["joined", "unmatched"] == 0
    assert 1 < got["joined", "fan_out"] <= 3


def test_quality_report_finds_repeated_keys(spark):
    raw = standin.datasets(spark, FOLDER)
    raw["info_global"] = raw["info_global"].unionByName(raw["info_global"].withColumn("City", F.lit("X")))
    prepared = {name: prepare(df, SPECS[name], DAY) for name, df in raw.items()}
    got = measures(quality_report(raw, prepared))
    assert got["info_global", "rows_kept"] == 300 and got["info_global", "repeated_keys"] == 150


def test_described_columns_of_any_name(spark):
    df = spark.createDataFrame([(1, None, 2.0), (None, None, 3.0)], "rows int, `a.b` string, n0 double")
    assert [tuple(r) for r in described(df).collect()] == [
        (1, "rows", "int", 1, 1), (2, "a.b", "string", 0, 2), (3, "n0", "double", 2, 0),
    ]
    assert [r.filled for r in described(df.limit(0)).collect()] == [0, 0, 0]


def test_preview(spark, capsys):
    preview(spark.range(3), 2)
    printed = capsys.readouterr().out
    assert "id: long" in printed and "only showing top 2 rows" in printed


def test_a_failure_cancels_the_jobs_beside_it(spark):
    def fail():
        time.sleep(1)
        raise ValueError("first")

    def long():
        slow = F.udf(lambda x: time.sleep(60) or x, "long")
        return spark.range(0, 2, 1, 2).select(slow("id")).collect()

    began = time.time()
    with pytest.raises(ValueError, match="first"):
        side_by_side(spark, [long, fail, long])
    assert time.time() - began < 40


def test_jobs_side_by_side(spark):
    assert side_by_side(spark, [lambda n=n: spark.range(n).count() for n in (1, 2, 3)]) == [1, 2, 3]
    assert side_by_side(spark, []) == []

    def fail():
        raise RuntimeError("broken job")

    with pytest.raises(RuntimeError, match="broken job"):
        side_by_side(spark, [fail, lambda: spark.range(1).count()])


def test_prepared_and_checked_from_one_parse(spark, tmp_path, monkeypatch):
    """The report with the first stage is that of the raw sources, which are read once."""
    raw = {
        name: df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
        for name, df in standin.datasets(spark, FOLDER).items()
    }
    broken = F.when(F.col("MoyenPaiement") == "2-HIGH", "x").otherwise(F.col("Montant"))
    raw["transactions"] = raw["transactions"].withColumn("Montant", broken)
    stores = [str(tmp_path / name) for name in ("one", "two")]
    report = stage_prepare_checked(spark, raw, stores[0], DAY)
    stage_prepare(spark, raw, stores[1], DAY)
    assert collected(report) == collected(stage_quality(spark, raw, stores[1]))
    for name, table in prepared_tables(spark, stores[0]).items():
        assert collected(table) == collected(prepared_tables(spark, stores[1])[name])
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert "orders.parquet" not in plan and "o_orderkey" not in plan
