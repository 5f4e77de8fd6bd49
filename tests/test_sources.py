from __future__ import annotations

from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tallyworks.schemas import CORRUPT_COLUMN, SALES_COLUMNS
from tallyworks.settings import session_settings
from tallyworks.sources import files, scratch, tables

HEADER = ",".join(SALES_COLUMNS)


@pytest.fixture
def csv(tmp_path):
    def write(*lines, header=HEADER, name="in.csv"):
        path = tmp_path / name
        path.write_text("\n".join([header, *lines]) + "\n")
        return str(path)

    return write


def test_scan_reads_text_and_empty_fields_as_null(spark, csv):
    df = files.read_sales(spark, csv('1,A, 5 ,01/05/2023,East,,"",USD'))
    assert df.dtypes == [(c, "string") for c in SALES_COLUMNS]
    row = df.first()
    assert (row["SaleAmount"], row["CustomerID"], row["Discount"]) == (" 5 ", None, None)


def test_reordered_header_raises(spark, csv):
    swapped = HEADER.replace("OrderID,ProductID", "ProductID,OrderID")
    with pytest.raises(Exception, match="CSV header does not conform"):
        files.read_sales(spark, csv("1,A,5,01/05/2023,East,C,0,USD", header=swapped)).collect()


def test_missing_path_raises(spark, tmp_path):
    with pytest.raises(AnalysisException):
        files.read_sales(spark, str(tmp_path / "none.csv"))


def test_malformed_rows_are_kept_or_rejected(spark, csv):
    lines = ["1,A,5,01/05/2023,East,C,0,USD", "2,A,5", "3,A,5,01/05/2023,East,C,0,USD,more"]
    path = csv(*lines)
    kept = files.read_sales(spark, path)
    assert [(r["OrderID"], r["Currency"]) for r in kept.orderBy("OrderID").collect()] == [("1", "USD"), ("2", None), ("3", "USD")]
    rejecting = files.read_sales(spark, path, "reject")
    assert rejecting.count() == 3
    # The same rows are marked whichever columns a query needs.
    for wanted in (["OrderID"], ["OrderID", "Currency"], list(SALES_COLUMNS)):
        sound = rejecting.filter(F.col(CORRUPT_COLUMN).isNull()).select(*wanted)
        assert [r["OrderID"] for r in sound.collect()] == ["1"]
    marked = files.malformed_rows(rejecting)
    assert sorted(r["RawLine"] for r in marked.collect()) == lines[1:]
    with pytest.raises(ValueError):
        files.read_sales(spark, path, "ignore")


def test_inputs_are_checked_by_metadata(sales, products):
    good = products(("A", "Ant", "x"))
    files.check_inputs(sales({}), good)
    with pytest.raises(files.SchemaMismatch, match="Region.*ProductName"):
        files.check_inputs(sales({}).drop("Region"), good.drop("ProductName"))


def test_csv_sink_round_trip(spark, sales, tmp_path):
    path = str(tmp_path / "out")
    files.write_csv(sales({}, {"OrderID": "2", "Region": "a,b\"c"}), path)
    files.write_csv(sales({}, {"OrderID": "2", "Region": "a,b\"c"}), path)
    back = files.read_sales(spark, path)
    assert sorted(r["Region"] for r in back.collect()) == ["East", 'a,b"c']


def test_json_summary(spark, tmp_path):
    path = str(tmp_path / "summary")
    files.write_json_summary(spark.createDataFrame([("a", 1), ("b", 2)], "Metric string, Value bigint"), path)
    assert spark.read.json(path).count() == 2
    assert len(list((tmp_path / "summary").glob("*.json"))) == 1


def test_scratch_is_the_folder_the_session_names(spark):
    named = spark.conf.get(scratch.SETTING, None)
    first, second = scratch.new_folder(spark, "x"), scratch.new_folder(spark, "x")
    assert first != second
    if named:
        assert first.startswith(named.rstrip("/") + "/")


def test_catalog_tables(spark, sales):
    tables.create_target_tables(spark)
    tables.create_target_tables(spark)
    for name, layout in tables.LAYOUTS.items():
        assert tables.table_exists(spark, name) and not tables.view_exists(spark, name)
        described = [(r["COLUMN_NAME"], r["DATA_TYPE"]) for r in tables.table_schema(spark, name).collect()]
        assert described == list(layout)
    df = sales({}).select("OrderID", "Region")
    with pytest.raises(AnalysisException):
        tables.load_table(df, "SalesData", "fail")
    tables.load_table(df, "load_modes", "fail")
    tables.load_table(df, "load_modes", "append")
    tables.load_table(df, "load_modes")
    assert spark.table("load_modes").count() == 3
    tables.load_table(df, "load_modes", "replace")
    assert spark.table("load_modes").count() == 1
    tables.truncate_table(spark, "load_modes")
    assert spark.table("load_modes").count() == 0
    df.createOrReplaceTempView("some_view")
    assert tables.view_exists(spark, "some_view") and not tables.view_exists(spark, "nothing")
    for name in ("load_modes", *tables.LAYOUTS):
        tables.drop_table(spark, name)
        assert not tables.table_exists(spark, name)
    tables.drop_table(spark, "load_modes")


def test_database_reads_are_split_and_writes_bounded():
    """The options alone: no database is started here."""
    split = tables.Split("id", "1", "1000", 8)
    options = tables.jdbc_read_options("jdbc:x", "SELECT id FROM t", split)
    assert options["dbtable"] == "(SELECT id FROM t) q" and "query" not in options
    assert (options["partitionColumn"], options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("id", "1", "1000", "8")
    with pytest.raises(ValueError, match="one task"):
        tables.jdbc_read_options("jdbc:x", "SELECT 1")
    assert "numPartitions" not in tables.jdbc_read_options("jdbc:x", "SELECT 1", one_task=True)
    assert tables.jdbc_write_options("jdbc:x", "t", 500, 4) == {"url": "jdbc:x", "dbtable": "t", "batchsize": "500", "numPartitions": "4"}


def test_parameterised_sql(spark, sales):
    df = sales({"OrderID": "1"}, {"OrderID": "2", "Region": "West"})
    got = tables.run_sql(spark, "SELECT OrderID FROM {orders} WHERE Region = :region", {"region": "West"}, orders=df)
    assert [r[0] for r in got.collect()] == ["2"]


def test_projections_keep_nulls_and_order(spark, sales):
    log = tables.error_table(spark.range(1).select(*[F.lit(None).alias(c) for c, _ in tables.ERROR_TABLE]))
    assert [(f.name, f.dataType.simpleString()) for f in log.schema] == list(tables.ERROR_TABLE)
    assert all(value is None for value in log.first())
    summary = tables.loading_summary(sales({}, {}), sales({}), sales({}).limit(0))
    assert {r["TableName"]: r["RowCount"] for r in summary.collect()} == {
        "SalesData": 2,
        "ErrorLogging": 1,
        "CurrencyConversionLog": 0,
    }
    assert [r["OrderID"] for r in tables.preview(sales(*[{"OrderID": str(i)} for i in range(9)]), ["OrderID"]).collect()] == list("01234")


def test_cluster_without_a_shared_folder_is_refused():
    def session(master, settings):
        context = SimpleNamespace(master=master, applicationId="app-1")
        return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: settings.get(key, default)))

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.shared_folder(session("spark://host:7077", {}))
    named = {"spark.checkpoint.dir": "hdfs://name/checkpoints/"}
    assert scratch.new_folder(session("yarn", named), "load").startswith("hdfs://name/checkpoints/tallyworks/app-1/load-")
    assert scratch.shared_folder(session("local[2]", {}))


def test_settings_follow_the_input_size(spark):
    small, large = session_settings(10**9, 8), session_settings(100 * 10**12, 4000)
    assert int(small["spark.sql.shuffle.partitions"]) == 8
    assert int(large["spark.sql.shuffle.partitions"]) == 745_059
    assert large["spark.sql.files.maxPartitionBytes"] == small["spark.sql.files.maxPartitionBytes"]
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        assert spark.range(1000).repartition(3).groupBy((F.col("id") % 7).alias("k")).count().count() == 7
    finally:
        for name in small:
            if name != "spark.sql.session.timeZone":
                spark.conf.unset(name)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
