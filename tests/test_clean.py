import datetime
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampType,
)

from tellerloom.functions.casts import lenient_cast
from tellerloom.operators import conform, dedup, drop_incomplete
from tellerloom.operators.quality import typed_with_losses
from tellerloom.plans import prepare
from tellerloom.sources import read_delimited
from tellerloom.specs import ACCOUNTS, SPECS, DatasetSpec, UnknownDataset, dataset_spec


def cast(spark, texts, target):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    return [r[0] for r in df.select(lenient_cast(F.col("text"), StringType(), target)).collect()]


def test_int_casts_keep_the_whole_part(spark):
    given = {
        "3.7": 3, " 7 ": 7, "-2.9": -2, "3.": 3, ".5": 0, "-.5": 0, ".": 0, "+4": 4, "+4.9": 4,
        "\t8.25\n": 8, "007": 7, "2147483647.9": 2147483647,
        "": None, "99999999999": None, "1e3": None, "abc": None, "NaN": None, "1_0": None,
        "0x1": None, "7a": None, "3.7x": None, "1.2.3": None, "2147483648": None, "-": None,
        "1 .5": None, "+-1.0": None, "5\n.0": None,
    }
    assert dict(zip(given, cast(spark, given, IntegerType()))) == given
    assert cast(spark, [None], IntegerType()) == [None]
    assert cast(spark, ["99999999999.5"], LongType()) == [99999999999]


def test_double_casts(spark):
    plain, nan, *broken = cast(spark, ["1.5", "NaN", "abc", "1,5", ""], DoubleType())
    assert plain == 1.5 and math.isnan(nan) and broken == [None] * 3


def test_timestamp_and_date_casts(spark):
    stamps = cast(spark, ["2024-01-02", "2024-01-03T01:02:03Z", "bad", "2024-13-01"], TimestampType())
    assert stamps[0] == datetime.datetime(2024, 1, 2)
    assert stamps[1] == datetime.datetime(2024, 1, 3, 1, 2, 3)
    assert stamps[2:] == [None, None]
    dates = cast(spark, ["2025-8-3", "28/08/2025", "8/3/1970"], DateType())
    assert dates == [datetime.date(2025, 8, 3), None, None]


def raw_accounts(spark):
    return spark.createDataFrame(
        [("x", "A1", "1", "checking", "2024-02-30"), ("y", "A2", "2", "savings", "2024-02-29")],
        "`a note.` string, ACCOUNT_NUMBER string, customerid string, account_type string, "
        "creation_date string",
    )


def test_conform_keeps_extras_in_place_under_declared_spelling(spark):
    df = conform(raw_accounts(spark), ACCOUNTS)
    assert df.columns == [
        "a note.", "account_number", "customerid", "account_type", "creation_date"
    ]
    assert [r["creation_date"] for r in df.collect()] == [None, datetime.date(2024, 2, 29)]


def test_conform_can_drop_extras(spark):
    assert conform(raw_accounts(spark), ACCOUNTS, extra="drop").schema == ACCOUNTS.schema
    with pytest.raises(ValueError, match="extra"):
        conform(raw_accounts(spark), ACCOUNTS, extra="ignore")


def test_conform_names_missing_and_ambiguous_columns(spark):
    with pytest.raises(ValueError, match="'account_type' is missing"):
        conform(raw_accounts(spark).drop("account_type"), ACCOUNTS)
    doubled = raw_accounts(spark).select("*", F.lit("z").alias("CustomerID"))
    with pytest.raises(ValueError, match="'customerid' is ambiguous"):
        conform(doubled, ACCOUNTS)


def test_conform_follows_the_sessions_case_rule(spark):
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        with pytest.raises(ValueError, match="'account_number' is missing"):
            conform(raw_accounts(spark), ACCOUNTS)
        spelled = raw_accounts(spark).withColumnRenamed("ACCOUNT_NUMBER", "account_number")
        both = spelled.withColumn("Customerid", F.lit("z"))
        assert conform(both, ACCOUNTS).columns == [*spelled.columns, "Customerid"]
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_conform_is_one_projection(spark):
    plan = conform(raw_accounts(spark), ACCOUNTS)._jdf.queryExecution().analyzed().toString()
    assert plan.count("Project") == 1


def test_registry(spark):
    assert dataset_spec("transactions").sep == ";"
    assert list(SPECS) == ["transactions", "comptes_bancaires", "info_global"]
    assert [len(s.schema) for s in SPECS.values()] == [7, 4, 23]
    for kind in (ValueError, KeyError, UnknownDataset):
        with pytest.raises(kind, match="no dataset named 'accounts'"):
            dataset_spec("accounts")


def gaps(spark):
    nan = float("nan")
    return spark.createDataFrame(
        [(1.0, "a"), (nan, "b"), (None, "c"), (2.0, None)], "`my.amount` double, name string"
    )


def test_drop_incomplete(spark):
    assert [tuple(r) for r in drop_incomplete(gaps(spark)).collect()] == [(1.0, "a")]
    for required in (["NAME"], "name"):
        kept = drop_incomplete(gaps(spark), required)
        assert sorted(r["name"] for r in kept.collect()) == ["a", "b", "c"]
    assert drop_incomplete(gaps(spark), []).count() == 4


def test_drop_incomplete_equals_dropna(spark):
    df = gaps(spark).withColumnRenamed("my.amount", "amount")
    for required in (None, ["amount"], ["name"]):
        ours = drop_incomplete(df, required).collect()
        theirs = df.dropna(subset=required).collect()
        assert sorted(map(repr, ours)) == sorted(map(repr, theirs))


def test_null_tests_reach_a_columnar_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    gaps(spark).withColumnRenamed("my.amount", "amount").write.parquet(path)
    kept = drop_incomplete(spark.read.parquet(path))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(amount)" in plan and "IsNotNull(name)" in plan


def test_dedup_rows(spark):
    pairs = spark.createDataFrame([(1, None), (1, None), (0, None)], "a int, b string")
    assert dedup(pairs).count() == 2
    nan = float("nan")
    doubles = spark.createDataFrame([(nan,), (nan,), (0.0,), (-0.0,)], "x double")
    assert dedup(doubles).count() == 2
    assert dedup(dedup(pairs)).count() == 2


def test_dedup_subset(spark):
    df = spark.createDataFrame(
        [("c1", 1, "x"), ("c1", 3, "z"), ("c1", 3, "y"), ("c2", 2, None), (None, 1, "q"), (None, 0, "r")],
        "k string, day int, v string",
    )
    rows = {tuple(r) for r in dedup(df, ["k"]).collect()}
    assert len(rows) == 3 and rows <= {tuple(r) for r in df.collect()}
    latest = dedup(df, ["K"], [F.col("day").desc()])
    assert latest.columns == df.columns
    assert {tuple(r) for r in latest.collect()} == {("c1", 3, "y"), ("c2", 2, None), (None, 1, "q")}


def test_dedup_latest_limits_each_key_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS day")
    plan = dedup(df, ["k"], [F.col("day").desc()])._jdf.queryExecution().executedPlan().toString()
    before = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before


def write(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_delimited_rows(spark, tmp_path):
    uri = write(tmp_path, "t.csv", 'a,b\n1,\n"x,y",z\n1,2,3\n4\n')
    df = read_delimited(spark, uri)
    assert dict(df.dtypes) == {"a": "string", "b": "string"}
    assert [tuple(r) for r in df.collect()] == [("1", None), ("x,y", "z"), ("1", "2"), ("4", None)]


def test_delimited_to_prepared(spark, tmp_path):
    uri = write(
        tmp_path, "transactions.csv",
        "TransactionID;CustomerID;Montant;DateTransaction;MoyenPaiement;BICsender;BICreceiver\n"
        "T1;7;10.5;2024-01-02 03:04:05;card;AAA;BBB\n"
        "T1;7;10.50;2024-01-02T03:04:05;card;AAA;BBB\n"
        "T2;7;1,5;2024-01-02;card;AAA;BBB\n"
        "T3;7;NaN;2024-01-02;card;AAA;BBB\n"
        "T4;;3;2024-01-02;card;AAA;BBB\n"
        "T5;8;3;2024-01-02;card;AAA\n"
        'T6;8;4;2024-01-02;"ca;rd";AAA;BBB\n',
    )
    spec = dataset_spec("transactions")
    day = datetime.date(2025, 8, 28)
    rows = {r["TransactionID"]: r for r in prepare(read_delimited(spark, uri, ";"), spec, day).collect()}
    assert sorted(rows) == ["T1", "T6"]
    assert rows["T6"]["MoyenPaiement"] == "ca;rd"
    assert (rows["T1"]["valid_flag"], rows["T1"]["valid_from"], rows["T1"]["valid_until"]) == (
        True, day, None
    )
    assert len(rows["T1"]["transaction_pk"]) == 64


def test_an_empty_extra_column_empties_the_result(spark):
    extra = raw_accounts(spark).withColumn("nothing", F.lit(None).cast("string"))
    assert prepare(extra, ACCOUNTS).count() == 0
    assert prepare(extra, ACCOUNTS, extra="drop").count() == 1


def test_null_rules(spark):
    master = SPECS["info_global"]
    assert master.required == ("NationalID", "Number")
    assert master.requiring().required is None
    schema = StructType([StructField("k", StringType()), StructField("v", StringType())])
    spec = DatasetSpec("pairs", schema, ("k",), "pk", "pairs.csv", required=("k",))
    raw = spark.createDataFrame([("a", None), (None, "b"), ("c", "d")], schema)
    assert {r["k"] for r in prepare(raw, spec).collect()} == {"a", "c"}
    assert {r["k"] for r in prepare(raw, spec.requiring()).collect()} == {"c"}


def test_ranked_dedup_keeps_a_column_called_position(spark):
    df = spark.createDataFrame([(1, 5, 10), (1, 6, 20), (2, 7, 30)], "k int, _position int, __position int")
    rows = dedup(df, ["k"], [F.col("_position").desc()]).collect()
    assert sorted(map(tuple, rows)) == [(1, 6, 20), (2, 7, 30)]
    assert rows[0].asDict().keys() == {"k", "_position", "__position"}


def test_quality_keeps_a_column_called_raw_and_refuses_its_own(spark):
    columns = [F.lit(None).cast("string").alias(f.name) for f in ACCOUNTS.schema]
    df = spark.range(1).select(*columns, F.lit("kept").alias("_raw"))
    typed = typed_with_losses(df.withColumn("creation_date", F.lit("28/08/2025")), ACCOUNTS)
    row = typed.first()
    assert row["_raw"] == "kept" and row["_lost"]["creation_date"] is True
    with pytest.raises(ValueError, match="_lost"):
        typed_with_losses(df.withColumn("_lost", F.lit(1)), ACCOUNTS)
