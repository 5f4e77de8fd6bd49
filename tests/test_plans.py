"""Plans and skew: what Spark does with the operators, not only what they return."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tallyworks.operators import clean as C
from tallyworks.operators import enrich as E
from tallyworks.plans import oracle, registry
from tallyworks.schemas import SALES_COLUMNS

from .conftest import RUN_TS

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df):
    """Rows and the plan as it ran."""
    rows = df.collect()
    return rows, plan(df)


def test_no_query_leaves_the_jvm_or_crosses(spark):
    for name, query in registry.queries().items():
        text = plan(query(spark, SF))
        for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert node not in text, (name, node)


def test_queries_and_sql_have_the_same_keys():
    assert set(registry.queries()) == set(oracle.oracle_sql())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[:4] == ["Region", "Category", "TotalOrders", "TotalSales"] and df.count() > 0


def test_reports_read_only_their_columns(spark):
    text = plan(registry.queries()["q02_monthly"](spark, SF))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",") if not c.endswith(")")} == {"SaleAmount", "OrderDate"}
    assert "PushedFilters: [IsNotNull(SaleAmount)]" in text


def test_accepted_and_rejected_filters_reach_the_scan(spark):
    tagged = registry.tagged(spark, SF)
    assert f"IsNull({C.CHECK})" in plan(C.accepted(tagged))
    assert f"IsNotNull({C.CHECK})" in plan(C.rejects(tagged, RUN_TS))


def test_duplicates_are_thinned_before_the_shuffle(spark, sales):
    text = plan(C.remove_duplicates(C.accepted(C.tag_rows(sales({})))))
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text and "Final" in text
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_profile_repeats_no_row_and_reads_a_column_once(spark):
    text = plan(registry.queries()["data_profile"](spark, SF))
    assert "Expand" not in text and "SortAggregate" not in text
    read = [set(re.findall(r"\w+(?=:string)", s)) & set(SALES_COLUMNS) for s in re.findall(r"ReadSchema: (\S+)", text)]
    assert sorted(len(r) for r in read) == [0, 1, 1, 4]
    assert sum(map(len, read)) == len(set().union(*read)) == 6


def test_rates_are_aggregated_by_hash(spark):
    text = plan(registry.queries()["resolve_rates"](spark, SF))
    assert text.count("HashAggregate") == 2 and "Sort" not in text


def test_recent_activity_reads_recent_months_only(spark):
    text = plan(registry.queries()["q13_recent"](spark, SF))
    filters = re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", text)
    assert len(filters) == 3 and all("Month" in f for f in filters)
    assert any("OrderMonth" in f and ">= 2001-07-01" in f for f in filters)


def test_no_query_over_the_loaded_rows_removes_duplicates_again(spark):
    for name in ("sales_table", "finalize", "export_rows", "conversion_log", "enrich_metrics"):
        assert "Window" not in plan(registry.queries()[name](spark, SF)), name


def test_small_sides_are_broadcast_and_large_ones_are_not(spark):
    text = plan(registry.sales(spark, SF))
    assert text.count("BroadcastHashJoin") == 2
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(registry.sales(spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Products are sorted and merged; the rates, at most one per currency, still go to every task.
    assert text.count("SortMergeJoin") == 1 and text.count("BroadcastHashJoin") == 1


@pytest.fixture
def skewed(spark):
    """A third of all rows share one order and product."""
    n = 30000
    hot = F.col("id") % 3 == 0
    text = {
        "OrderID": F.when(hot, "hot").otherwise(F.col("id").cast("string")),
        "ProductID": F.when(hot, "P0").otherwise(F.concat(F.lit("P"), (F.col("id") % 50).cast("string"))),
        "SaleAmount": ((F.col("id") * 7919) % 1000).cast("string"),
        "OrderDate": F.lit("01/05/2023"),
        "Region": F.lit("East"),
        "CustomerID": F.when(hot, "hot").otherwise(F.col("id").cast("string")),
        "Discount": F.lit("0.1"),
        "Currency": F.lit("EUR"),
    }
    return spark.range(n).repartition(8).select(*[value.alias(name) for name, value in text.items()]), n


def test_hot_duplicate_key(skewed):
    df, n = skewed
    kept = C.clean(C.tag_rows(df))
    assert kept.count() == n - n // 3 + 1
    assert kept.filter("OrderID = 'hot'").first()["SaleAmount"] == 0


def test_hot_product_is_split_when_the_product_table_is_large(spark, skewed):
    df, n = skewed
    goods = spark.range(50).select(
        F.concat(F.lit("P"), F.col("id").cast("string")).alias("ProductID"),
        F.lit("name").alias("ProductName"),
        F.lit("kind").alias("Category"),
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        joined = E.product_lookup(df, goods).filter(F.col("ProductName").isNotNull()).select("OrderID", "ProductName")
        rows, text = executed(joined)
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert len(rows) == n
    assert "SortMergeJoin(skew=true)" in text


def test_generated_methods_stay_small_enough_to_be_compiled(spark, capsys):
    """The JVM leaves methods above 8000 bytes of code to the interpreter."""
    tagged, fresh = registry.tagged(spark, SF), C.tag_rows(registry.raw(spark, SF), registry.SPEC)
    frames = {
        "tag": fresh,
        "accepted": C.accepted(fresh),
        "clean": C.clean(tagged, registry.SPEC),
        "rejects": C.rejects(tagged, RUN_TS, registry.SPEC),
        "sales": registry.sales(spark, SF),
    }
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for name, df in frames.items():
            df.explain("codegen")
            sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
            assert sizes and max(sizes) < 8000, (name, sizes)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
