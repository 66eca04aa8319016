"""Files and tables are written and read; for databases, what Spark is asked to do is checked."""

from unittest import mock

import pytest
from pyspark.sql import DataFrameWriter, SparkSession

from tellerloom import staging as staging_module
from tellerloom.counting import counted
from tellerloom.session import MIB, configure, s3a_options, scale_options
from tellerloom.sinks import CatalogSink, FileSink, JdbcSink, write_table
from tellerloom.sources import Database, postgres, read_delimited, read_table
from tellerloom.staging import Staging, shared_folder

PG = postgres("db.example", "bank", "me", "secret")


def test_postgres_address():
    assert PG.url == "jdbc:postgresql://db.example:5432/bank"
    assert postgres("h", "d", "u", "p", port="6000").url == "jdbc:postgresql://h:6000/d"
    assert PG.properties() == {
        "user": "me", "password": "secret", "driver": "org.postgresql.Driver"
    }
    assert "secret" not in repr(PG)
    assert Database("jdbc:x:y", options={"fetchsize": "1000"}).properties() == {"fetchsize": "1000"}


def test_table_scans():
    spark = mock.Mock()
    jdbc = spark.read.jdbc
    read_table(spark, PG, "marts")
    properties = {"fetchsize": "10000", **PG.properties()}
    jdbc.assert_called_with(PG.url, "marts", properties=properties)
    read_table(spark, PG, "marts", "id", 0, 1000, 8)
    jdbc.assert_called_with(
        PG.url, "marts", column="id", lowerBound=0, upperBound=1000, numPartitions=8,
        properties=properties,
    )
    read_table(spark, PG, "marts", predicates=["a = 1", "a = 2"])
    jdbc.assert_called_with(
        PG.url, "marts", predicates=["a = 1", "a = 2"], properties=properties
    )
    own = Database("jdbc:x:y", options={"fetchsize": "50"})
    read_table(spark, own, "marts")
    jdbc.assert_called_with("jdbc:x:y", "marts", properties={"fetchsize": "50"})
    with pytest.raises(ValueError, match="needs column"):
        read_table(spark, PG, "marts", "id", partitions=8)
    with pytest.raises(ValueError, match="not both"):
        read_table(spark, PG, "marts", "id", predicates=["a = 1"])


def test_database_writes(spark):
    """The rows go to the database from a few partitions, and are counted on the way."""
    asked = {}

    def jdbc(writer, url, table, mode, properties):
        asked.update(url=url, table=table, mode=mode, properties=properties)
        asked["partitions"] = writer._df.rdd.getNumPartitions()
        writer._df.write.format("noop").mode("overwrite").save()

    with mock.patch.object(DataFrameWriter, "jdbc", jdbc):
        rows = write_table(spark.range(100, numPartitions=6), JdbcSink(PG, connections=3), "marts")
    assert rows == 100
    assert asked == {
        "url": PG.url, "table": "marts", "mode": "overwrite", "partitions": 3,
        "properties": {**PG.properties(), "batchsize": "10000"},
    }


def test_file_modes(spark, tmp_path):
    sink = FileSink(str(tmp_path))
    assert write_table(spark.range(5), sink, "t") == 5
    assert write_table(spark.range(3), sink, "t") == 3
    assert write_table(spark.range(4), sink, "t", "append") == 4
    assert spark.read.parquet(sink.uri("t")).count() == 7
    assert write_table(spark.range(0), sink, "empty") == 0
    with pytest.raises(Exception, match="already exists"):
        write_table(spark.range(1), sink, "t", "error")
    csv = FileSink(str(tmp_path), "csv", {"header": "true", "sep": ";"})
    assert write_table(spark.range(2), csv, "c") == 2
    assert spark.read.csv(csv.uri("c"), header=True, sep=";").columns == ["id"]


def test_folders_of_files_must_have_one_header(spark, tmp_path):
    for folder, second in (("same", "x,y\n3,4\n"), ("mixed", "y,x\n20,10\n")):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "a.csv").write_text("x,y\n1,2\n")
        (tmp_path / folder / "b.csv").write_text(second)
    rows = read_delimited(spark, str(tmp_path / "same")).collect()
    assert sorted((r.x, r.y) for r in rows) == [("1", "2"), ("3", "4")]
    with pytest.raises(Exception, match="header"):
        read_delimited(spark, str(tmp_path / "mixed")).collect()


def test_catalog_tables(spark):
    sink = CatalogSink()
    assert write_table(spark.range(5), sink, "rows_of_a_test") == 5
    assert write_table(spark.range(2), sink, "rows_of_a_test", "append") == 2
    assert spark.table("rows_of_a_test").count() == 7
    spark.sql("CREATE DATABASE IF NOT EXISTS marts_of_a_test")
    assert write_table(spark.range(1), CatalogSink("marts_of_a_test"), "t") == 1
    assert spark.table("marts_of_a_test.t").count() == 1


def test_failures_are_logged_and_raised(spark, tmp_path, caplog):
    broken = spark.range(3).selectExpr("raise_error('no') AS x")
    with pytest.raises(Exception, match="no"):
        write_table(broken, FileSink(str(tmp_path)), "t")
    assert "writing t failed" in caplog.text


def test_staged_tables(spark):
    staging = Staging(spark)
    table = staging.table(spark.range(5), "five")
    assert table.count() == 5 and staging.root.startswith(shared_folder(spark))
    staging.drop()
    with pytest.raises(Exception):
        spark.read.parquet(staging.root).count()


def test_everything_staged_can_be_dropped(spark, monkeypatch):
    monkeypatch.setattr(staging_module, "_in_place", [])
    kept = [Staging(spark) for _ in range(2)]
    tables = [staging.table(spark.range(5), "five") for staging in kept]
    assert [table.count() for table in tables] == [5, 5]
    staging_module.drop_staged()
    for staging in kept:
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            spark.read.parquet(staging.root)
    assert staging_module._in_place == []


def test_shared_folder_must_be_named_on_a_cluster():
    session = mock.Mock(spec=SparkSession)
    session.conf.get.return_value = None
    session.sparkContext.master = "yarn"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session)
    session.conf.get.return_value = "hdfs://shared/"
    assert shared_folder(session) == "hdfs://shared"


def test_session_options():
    options = s3a_options("key", "secret")
    assert options["spark.hadoop.fs.s3a.endpoint"] == "s3.amazonaws.com"
    scale = scale_options(100 * 1024**2 * MIB, cores=8000, checkpoint_dir="s3a://shared/tmp")
    partitions = int(scale["spark.sql.shuffle.partitions"])
    assert partitions == 40960
    assert 100 * 1024**2 * MIB / partitions**2 >= 64 * 1024
    assert int(scale["spark.sql.files.maxPartitionBytes"]) == 256 * MIB
    assert scale_options(1024 * 256 * MIB, 8, "x")["spark.sql.shuffle.partitions"] == "1024"
    assert scale_options(0, 8, "x")["spark.sql.shuffle.partitions"] == "16"
    builder = mock.Mock()
    builder.config.return_value = builder
    assert configure(builder, options, scale) is builder
    assert builder.config.call_count == len(options) + len(scale)


def test_rows_are_counted_by_the_action_that_runs_anyway(spark):
    df, rows = counted(spark.range(12), "twelve")
    assert len(df.collect()) == 12
    assert rows.get["rows"] == 12
