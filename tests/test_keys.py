import datetime
import hashlib

from pyspark.sql import functions as F

from tellerloom.functions import hash_key, with_hash_key, with_validity


def hashes(spark, pairs, null_safe=False):
    df = spark.createDataFrame(pairs, "a string, b string")
    return [r[0] for r in df.select(hash_key(["a", "b"], null_safe)).collect()]


def test_hash_of_text_and_number(spark):
    df = spark.createDataFrame([("N1", 7)], "NationalID string, Number int")
    expected = "fe6a3829332e6ebf29b56b7113ef57a9003135af9e0d1123f116e94ef2830205"
    assert with_hash_key(df, ["NationalID", "Number"]).first()["pk_hash"] == expected
    assert expected == hashlib.sha256(b"N1||7").hexdigest()


def test_default_encoding_skips_nulls_and_does_not_escape(spark):
    first, second, third, fourth, empty = hashes(
        spark, [("a", None), (None, "a"), ("a||b", "c"), ("a", "b||c"), (None, None)]
    )
    assert first == second and third == fourth
    assert empty == hashlib.sha256(b"").hexdigest()


def test_null_safe_encoding_tells_keys_apart(spark):
    pairs = [
        ("a", None), (None, "a"), ("a||b", "c"), ("a", "b||c"), (None, None), ("", ""), ("-", None),
        (None, "-"), ("1:a", "b"), ("a", "1:b"), ("", None),
    ]
    assert len(set(hashes(spark, pairs, null_safe=True))) == len(pairs)


def test_validity(spark):
    df = with_validity(spark.range(1), datetime.date(2025, 8, 28), "open", "since", "till")
    assert df.dtypes[1:] == [("open", "boolean"), ("since", "date"), ("till", "date")]
    assert tuple(df.first())[1:] == (True, datetime.date(2025, 8, 28), None)


def test_validity_defaults_to_today(spark):
    df = with_validity(spark.range(1))
    assert df.where(F.col("valid_from") == F.current_date()).count() == 1
