"""Target tables by batch and month, loaded keys, identifiers, the rate cache, mergeable profiles, runs taken up again."""

from __future__ import annotations

import re
from datetime import datetime, timedelta
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyworks import settings
from tallyworks.operators import enrich as E
from tallyworks.operators import ids, profile
from tallyworks.operators import metrics as M
from tallyworks.operators.rate_cache import RateCache
from tallyworks.plans import analytics, pipeline, registry
from tallyworks.schemas import SALES_COLUMNS, SALES_TABLE, CleaningSpec
from tallyworks.sources import hadoop, tables, targets
from tallyworks.sources.loaded_keys import LoadedKeys
from tallyworks.sources.versions import VersionedTable

from .conftest import RUN_TS


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def sales_rows(spark, count, first=0, months=12):
    """Rows of SalesData, order by order, dates dealt over months."""
    rows = spark.range(first, first + count)
    values = {name: F.lit(None) for name, _ in SALES_TABLE} | {
        "OrderID": F.col("id").cast("string"),
        "ProductID": F.lit("A"),
        "SaleAmount": F.lit(1),
        "OrderDate": F.add_months(F.lit(datetime(2023, 1, 5)), (F.col("id") % months).cast("int")),
        "Region": F.lit("East"),
    }
    return rows.select(*[values[name].cast(kind).alias(name) for name, kind in SALES_TABLE])


@pytest.fixture(params=["folder", "catalog"])
def target(request, spark, tmp_path):
    if request.param == "folder":
        yield targets.FolderTarget(str(tmp_path / "tables"))
    else:
        spark.sql("CREATE DATABASE batches")
        yield targets.CatalogTarget("batches")
        spark.sql("DROP DATABASE batches CASCADE")


# --- layout -----------------------------------------------------------------------------


def test_months_are_few_files_and_recent_rows_read_recent_months(spark, target):
    table = target.load(sales_rows(spark, 4000).repartition(16), "SalesData").table
    place = target.place(spark, "SalesData").removeprefix("file:")
    files = list(Path(place).rglob("*.parquet"))
    assert len(files) == 12 and {f.parent.name for f in files} == {f"OrderMonth=2023-{m:02d}-01" for m in range(1, 13)}
    recent = targets.since(table, "OrderDate", datetime(2023, 11, 3))
    assert recent.count() == 4000 // 12 * 2
    assert re.search(r"PartitionFilters: \[.*OrderMonth.*>= 2023-11-01", plan(recent))
    assert targets.since(table, "OrderDate", datetime(2023, 12, 6)).count() == 0
    assert table.select(*[n for n, _ in SALES_TABLE]).exceptAll(sales_rows(spark, 4000)).count() == 0


def test_large_month_is_split(spark, tmp_path):
    wide = sales_rows(spark, 20000, months=1).repartition(16).withColumn("ProductName", F.repeat(F.sha2("OrderID", 256), 4))
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB", "spark.sql.shuffle.partitions": "4"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        targets.FolderTarget(str(tmp_path)).load(wide, "SalesData")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list(tmp_path.rglob("*.parquet"))) > 4


def test_rows_without_a_date_and_no_rows(spark, target):
    undated = sales_rows(spark, 3).withColumn("OrderDate", F.lit(None).cast("timestamp_ntz"))
    assert target.load(undated, "SalesData").table.filter("OrderMonth is null").count() == 3
    loaded = target.load(undated.limit(0), "SalesData", measures={"n": F.count(F.lit(1))})
    assert loaded.table.count() == 0 and loaded.measured == {"n": 0}
    assert spark.read.parquet(target.place(spark, "SalesData")).count() == 0


def test_reports_do_not_depend_on_the_layout(spark, tmp_path):
    rows = sales_rows(spark, 500)
    table = targets.FolderTarget(str(tmp_path)).load(rows, "SalesData").table
    assert analytics.monthly(table).collect() == analytics.monthly(rows).collect()
    empty = rows.select(F.lit(None).cast("timestamp_ntz").alias("ErrorTimestamp"), F.lit(None).cast("timestamp_ntz").alias("ConversionTimestamp"))
    for frame in (table, rows):
        got = analytics.recent_activity(frame, empty, empty, datetime(2023, 12, 10)).first()
        assert (got["Count"], got["TotalValue"]) == (500 // 12, Decimal(500 // 12))


# --- batches ----------------------------------------------------------------------------


def test_a_batch_replaces_itself_and_nothing_else(spark, target):
    for _ in range(2):
        target.load(sales_rows(spark, 60), "SalesData", "b1")
        target.load(sales_rows(spark, 40, 100), "SalesData", "b2")
    table = target.read(spark, "SalesData")
    assert table.count() == 100 and table.select("OrderID").distinct().count() == 100
    # Months for which the batch has no rows any more go as well.
    target.load(sales_rows(spark, 5, months=2), "SalesData", "b1")
    left = target.read(spark, "SalesData")
    assert {(r["BatchID"], r["count"]) for r in left.groupBy("BatchID").count().collect()} == {("b1", 5), ("b2", 40)}
    assert left.filter("BatchID = 'b1'").select("OrderMonth").distinct().count() == 2
    assert target.load(sales_rows(spark, 7), "SalesData").table.count() == 7
    with pytest.raises(ValueError, match="batch is named"):
        target.load(sales_rows(spark, 1), "SalesData", "a/b")


def test_loaded_keys_are_not_shuffled(spark, sales, tmp_path):
    keys = LoadedKeys(spark, str(tmp_path / "keys"), buckets=8)
    first = sales(*[{"OrderID": str(i), "ProductID": "A"} for i in range(50)])
    keys.add(first, "b1")
    second = sales(*[{"OrderID": str(i), "ProductID": "A"} for i in range(40, 70)], {"OrderID": None}, {"OrderID": "1", "ProductID": "B"})
    new = keys.new_rows(second, "b2")
    assert sorted(r["OrderID"] or "" for r in new.collect()) == sorted(["", "1", *map(str, range(50, 70))])
    assert new.columns == second.columns
    # A batch that is loaded again meets the keys of others only.
    assert keys.new_rows(first, "b1").count() == 50 and keys.new_rows(first, "b2").count() == 0
    keys.add(first.limit(3), "b1")
    assert spark.table(keys.table).count() == 3 and keys.new_rows(first, "b3").count() == 47
    text = plan(keys.new_rows(second, "b2"))
    loaded = text[text.rindex("Sort [OrderID") :]
    assert text.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" in text
    assert "Bucketed: true" in loaded and "Exchange" not in loaded
    # Another session finds the keys in the folder.
    tables.drop_table(spark, keys.table)
    assert LoadedKeys(spark, str(tmp_path / "keys"), buckets=8).new_rows(first, "b3").count() == 47


LINES = "1,A,100.00,01/03/2024,North,C1,0.1,USD\n2,B,20.05,03/05/2024,South,C1,0,EUR\n3,B,,03-03-2024,South,C2,,EUR\n4,C,5,,East,C3,0.2,GBP\n"
MORE = "2,B,99,03/05/2024,South,C1,0,EUR\n5,B,7,03-04-2024,South,C2,,GBP\n6,C,5,,East,C3,0.2,GBP\n7,C,5,,East,C3,0.2,GBP\n"


@pytest.fixture
def inputs(spark, tmp_path, quotes):
    """Writes sales lines, products and rates as files and runs the pipeline over them."""
    rates = quotes(("EUR", "USD", "1.1", "API", datetime(2024, 1, 1)), ("GBP", "USD", "1.25", "fallback", datetime(2024, 1, 1)))
    rates.write.parquet(str(tmp_path / "rates"))

    def go(lines, run, on_malformed="keep", products="A,Ant,x\nB,Bear,y\n", run_ts=RUN_TS, rates=None, **options):
        texts = {"sales.csv": ",".join(SALES_COLUMNS) + "\n" + lines, "products.csv": "ProductID,ProductName,Category\n" + products}
        for name, text in texts.items():
            # A file that is written again is a changed input.
            if not (tmp_path / name).exists() or (tmp_path / name).read_text() != text:
                (tmp_path / name).write_text(text)
        known = spark.read.parquet(str(tmp_path / "rates")) if rates is None else rates
        settings = pipeline.Options(run_ts, CleaningSpec(max_rejection_rate=0.9), **options)
        paths = [str(tmp_path / name) for name in ("sales.csv", "products.csv")]
        return pipeline.run_files(spark, *paths, known, str(tmp_path / run), settings, on_malformed)

    return go


def measured(result):
    return {(stage, metric): value for stage, metric, value in result.lines}


@pytest.mark.parametrize("catalog", [False, True])
def test_runs_of_batches(spark, inputs, tmp_path, catalog):
    where = {"database": "runs"} if catalog else {"tables": str(tmp_path / "tables")}
    if catalog:
        spark.sql("CREATE DATABASE runs")
    try:
        inputs(LINES, "r1", batch="b1", **where)
        second = inputs(MORE, "r2", batch="b2", **where)
        got = measured(second)
        # Order 2 was loaded by the first batch.
        assert got["cleaning", "already_loaded"] == 1 and got["cleaning", "duplicates_removed"] == 0
        assert got["enrichment", "initial_records"] == got["loading", "sales_records_loaded"] == 1
        for _ in range(2):
            state = {
                name: {(r["BatchID"], r["count"]) for r in second.table(spark, name).groupBy("BatchID").count().collect()}
                for name in tables.LAYOUTS
            }
            assert state["SalesData"] == {("b1", 3), ("b2", 1)} and state["ErrorLogging"] == {("b1", 1), ("b2", 2)}
            errors = sorted(r["ErrorID"] for r in second.table(spark, "ErrorLogging").collect())
            logs = sorted(r["LogID"] for r in second.table(spark, "CurrencyConversionLog").collect())
            assert errors == [1, 2, 3] and logs == [1, 2]
            second = inputs(MORE, "r2", batch="b2", **where)
        row = second.table(spark, "SalesData").filter("OrderID = '2'").first()
        assert row["SaleAmount"] == Decimal("22.10")
    finally:
        if catalog:
            spark.sql("DROP DATABASE runs CASCADE")


# --- identifiers and defaults -----------------------------------------------------------


def test_ids_have_no_gaps(spark, tmp_path):
    rows = spark.range(0, 5000, 1, 7).filter("id % 3 > 0 and id not between 1000 and 2500").withColumn("row", ids.row_number_of_write())
    rows.write.parquet(str(tmp_path / "rows"))
    written = spark.read.parquet(str(tmp_path / "rows"))
    numbered = ids.with_ids(written, "Number", "row", 100)
    got = [(r["Number"], r["id"]) for r in numbered.orderBy("Number").collect()]
    assert [n for n, _ in got] == list(range(101, 101 + written.count())) and [i for _, i in got] == sorted(i for _, i in got)
    assert numbered.columns == ["Number", "id"] and ids.with_ids(written.limit(0), "Number", "row").count() == 0
    # Rows are neither shuffled nor sorted: the only exchanges are those of the counts.
    assert "hashpartitioning(id" not in plan(numbered) and "SortMergeJoin" not in plan(numbered)


def test_defaults_are_in_the_schema_and_fill_columns(spark):
    tables.create_target_tables(spark)
    try:
        described = {r["COLUMN_NAME"]: r["COLUMN_DEFAULT"] for r in tables.table_schema(spark, "ErrorLogging").collect()}
        assert described.pop("ErrorTimestamp") == "localtimestamp()" and set(described.values()) == {None}
        spark.sql("INSERT INTO ErrorLogging (OrderID, ErrorType) VALUES ('1', 'x')")
        row = spark.table("ErrorLogging").first()
        assert row["OrderID"] == "1" and row["ErrorTimestamp"] is not None and row["RawData"] is None
    finally:
        for name in tables.LAYOUTS:
            tables.drop_table(spark, name)


def test_malformed_products_become_rejects(spark, inputs):
    products = "A,Ant,x\nB,Bear\nB,Bear,y,more\nC,Cow,z\n"
    result = inputs(LINES, "out", "reject", products)
    got = measured(result)
    assert got["ingestion", "product_records"] == 2 and got["cleaning", "malformed_products"] == 2
    errors = result.table(spark, "ErrorLogging").orderBy("ErrorID").collect()
    assert [r["ErrorID"] for r in errors] == [1, 2, 3]
    assert [(r["OrderID"], r["ProductID"], r["ErrorMessage"]) for r in errors[1:]] == [
        (None, "B", "Wrong number of fields: B,Bear"),
        (None, "B", "Wrong number of fields: B,Bear,y,more"),
    ]
    assert got["cleaning", "rejected_records"] == 1 and got["loading", "error_records_loaded"] == 3
    kept = measured(inputs(LINES, "kept", "keep", products))
    assert kept["ingestion", "product_records"] == 4 and ("cleaning", "malformed_products") not in kept


# --- rates ------------------------------------------------------------------------------


def test_packed_quotes_order_as_their_parts_do(spark, quotes):
    moments = [None, datetime(1, 1, 1), datetime(1969, 12, 31, 23, 59, 59, 999999), datetime(1970, 1, 1), datetime(2024, 2, 29, 12, 0, 0, 1), datetime(9999, 12, 31, 23, 59, 59)]
    rates = ["0.000001", "1.000000", "9999.999999"]
    rows = [(f"{rank}", "USD", rate, "API", ts) for rank in range(3) for ts in moments for rate in rates]
    df = quotes(*rows).withColumn("p", E.pack_quote(F.col("from_currency").cast("int"), F.col("ts"), F.col("rate")))
    back = E.unpack_quote(F.col("p"))
    got = df.orderBy("p").select(*[c.alias(n) for c, n in zip(back, ("rank", "ts", "rate"))]).collect()
    want = sorted(((int(a), ts or datetime.min - timedelta(0), ts is not None, -Decimal(r), ts) for a, _, r, _, ts in rows), key=lambda x: (x[0], x[2], x[1], x[3]))
    assert [(r["rank"], r["ts"], r["rate"]) for r in got] == [(w[0], w[4], -w[3]) for w in want]


def test_rate_cache_between_runs(spark, inputs, quotes, tmp_path):
    cache = str(tmp_path / "cache")

    def resolved(run, run_ts, rates):
        result = inputs(LINES, run, run_ts=run_ts, rates=rates, rate_cache=cache)
        rows = spark.read.parquet(result.path("staging/rates")).collect()
        return {r["from_currency"]: (r["source"], r["rate"]) for r in rows}

    first = quotes(("EUR", "USD", "1.1", "API", RUN_TS), ("GBP", "USD", "1.25", "fallback", RUN_TS))
    later = quotes(("EUR", "USD", "1.3", "API", RUN_TS + timedelta(minutes=20)))
    assert resolved("r1", RUN_TS, first) == {"EUR": ("API", Decimal("1.1")), "GBP": ("fallback", Decimal("1.25"))}
    # Within the hour the rate of the first run is used; a fallback rate was not remembered.
    assert resolved("r2", RUN_TS + timedelta(minutes=59), later) == {"EUR": ("cache", Decimal("1.1"))}
    # A hit does not make it younger: after the hour the API is asked again, and remembered.
    assert resolved("r3", RUN_TS + timedelta(minutes=60), later) == {"EUR": ("API", Decimal("1.3"))}
    assert resolved("r4", RUN_TS + timedelta(minutes=61), quotes()) == {"EUR": ("cache", Decimal("1.3"))}
    assert RateCache(spark, cache).quotes().count() == 1


def test_versions(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), "a int")
    assert table.read().count() == 0 and table.versions() == []
    for n in range(1, 5):
        table.replace(table.read().unionByName(spark.range(1).select(F.lit(n).alias("a"))), files=1)
    assert sorted(r["a"] for r in table.read().collect()) == [1, 2, 3, 4] and table.versions() == [3, 4]
    # A version that was not finished is not seen, and its number is used again.
    (tmp_path / "t" / "v000000005").mkdir()
    assert table.versions() == [3, 4] and table.replace(table.read().limit(1)).count() == 1 and table.versions() == [4, 5]


# --- profile ----------------------------------------------------------------------------


def test_profiles_of_batches_merge_exactly(spark, sales, products, tmp_path):
    def batch(first, count, region):
        rows = sales({}).crossJoin(spark.range(first, first + count))
        return rows.withColumns({"ProductID": F.when(F.col("id") % 10 > 0, F.concat(F.lit("P"), "id")), "Region": F.lit(region)}).drop("id")

    parts = {"b1": batch(0, 40_000, "East"), "b2": batch(30_000, 40_000, "West"), "b3": batch(0, 10, None)}
    goods = products(("A", "Ant", "x"))
    store = profile.ProfileStore(spark, str(tmp_path / "profile"))
    for _ in range(2):
        for name, df in parts.items():
            lines = M.data_profile(df, goods)
            plain = lines.filter(~F.col("Metric").isin(*M.DISTINCT.values()))
            store.add(name, plain, profile.column_values(df, M.DISTINCT))
    together = parts["b1"].unionByName(parts["b2"]).unionByName(parts["b3"])
    want = {r["Metric"]: r["Value"] for r in M.data_profile(together, goods).collect()} | {"product_records": 3}
    got = {r["Metric"]: r["Value"] for r in store.profile(list(parts)).collect()}
    assert got == want and want["unique_products"] == 63_001 and want["unique_regions"] == 3
    codes = store.codes.read().groupBy("Metric").agg(F.count("Code").alias("n"), F.max("Code").alias("last"), F.count_distinct("Code").alias("d")).collect()
    assert all(r["n"] == r["d"] == r["last"] + 1 for r in codes)
    bits = spark.read.parquet(str(tmp_path / "profile/parts/b1")).filter("Bits is not null")
    assert bits.count() == 5 and bits.agg(F.max(F.octet_length("Bits"))).first()[0] == 4096


# --- runs taken up again ----------------------------------------------------------------


@pytest.mark.parametrize("on_malformed", ["keep", "reject"])
def test_a_failed_run_goes_on_from_the_last_stage(spark, inputs, monkeypatch, on_malformed):
    def broken(*_):
        raise RuntimeError("no space")

    with monkeypatch.context() as patch:
        patch.setattr(tables, "loading_summary", broken)
        with pytest.raises(RuntimeError, match="no space"):
            inputs(LINES, "out", on_malformed, resume=True)
    with monkeypatch.context() as patch:
        for step in ("tag_rows", "clean", "rejects"):
            patch.setattr(pipeline.cleaning, step, broken)
        patch.setattr(pipeline.enrichment, "enrich", broken)
        got = measured(inputs(LINES, "out", on_malformed, resume=True))
    fresh = measured(inputs(LINES, "fresh", on_malformed))
    resumed = {stage for stage, metric in got if metric == "resumed"}
    assert resumed == {"ingestion", "cleaning", "enrichment"}
    clock = set(pipeline.CLOCK_METRICS)
    assert {k: v for k, v in got.items() if k[1] not in clock | {"resumed"}} == {k: v for k, v in fresh.items() if k[1] not in clock}


def test_changed_inputs_or_options_are_not_skipped(spark, inputs, quotes, tmp_path):
    def resumed(lines=LINES, **options):
        got = measured(inputs(lines, "out", resume=True, **options))
        return {stage for stage, metric in got if metric == "resumed"}, got["loading", "sales_records_loaded"]

    everything = {"ingestion", "cleaning", "enrichment", "loading"}
    assert resumed() == (set(), 3) and resumed()[0] == everything
    assert resumed(LINES + MORE) == (set(), 4)
    assert resumed(LINES + MORE, lookup_products=False)[0] == set()
    # A run without the option leaves nothing to be taken for its own later, and frames that are not files have no state.
    inputs(LINES + MORE, "out", lookup_products=False)
    assert resumed(LINES + MORE, lookup_products=False)[0] == set()
    assert resumed(LINES + MORE, rates=quotes())[0] == resumed(LINES + MORE, rates=quotes())[0] == set()


def test_session_copies_follow_the_tables(spark, tmp_path):
    place = tmp_path / "sf"
    for name in registry.driver_tables.TABLES:
        spark.range(3).write.parquet(str(place / f"{name}.parquet"))
    built = []
    count = lambda: registry.once("test", spark, str(place), lambda: built.append(1) or len(built))
    assert [count(), count()] == [1, 1]
    spark.range(9).write.mode("overwrite").parquet(str(place / "part.parquet"))
    assert [count(), count()] == [2, 2]


def test_a_query_has_only_the_parts_written_that_it_reads(spark, sales, products, quotes, tmp_path, monkeypatch):
    goods, rates = products(("A", "n", "c")), quotes(("EUR", "USD", "2", "API", datetime(2024, 1, 1)))
    rows = sales({}, {"OrderID": "2", "Currency": "EUR"}, {"OrderID": "3"}, {"OrderID": "4", "Region": "no"})
    options = pipeline.Options(RUN_TS, CleaningSpec(max_rejection_rate=0.5))
    inputs = lambda *_: (rows, goods, rates, str(tmp_path / "parts"), options)
    monkeypatch.setattr(registry, "run_inputs", inputs)
    monkeypatch.setattr(registry.driver_tables, "rate_quotes", lambda *_: rates)
    here = lambda: sorted(p.relative_to(tmp_path / "parts").as_posix() for p in (tmp_path / "parts").glob("*/*") if p.is_dir())
    place = str(tmp_path / "none")
    assert registry.convert_strict(spark, place).count() == 3 and here() == ["staging/tagged"]
    sold = registry.loaded(spark, place, "SalesData")
    assert {"SalesData/BatchID=full", "staging/cleaned", "staging/rates"} <= set(here())
    assert not (tmp_path / "parts/ErrorLogging").exists() and not list((tmp_path / "parts").glob("*_csv"))
    # The tables are those of a whole run, which queries then read if there is one.
    whole = pipeline.run_pipeline(rows, goods, rates, str(tmp_path / "whole"), options)
    for name in registry.ALL_TABLES:
        got, want = registry.loaded(spark, place, name), whole.table(spark, name)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count()
    assert sold.count() == 3
    parts = pipeline.Parts(*inputs()[:3], str(tmp_path / "late"), pipeline.Options(RUN_TS, CleaningSpec(max_rejection_rate=0.1)))
    with pytest.raises(Exception, match="(?i)reject"):
        parts.need("tagged")


def test_rejects_of_one_run_are_not_brought_together_by_month(spark, sales, products, quotes, tmp_path, monkeypatch):
    hints, hint = [], type(spark.range(1)).hint
    monkeypatch.setattr(type(spark.range(1)), "hint", lambda self, name, *by: hints.append((name, by)) or hint(self, name, *by))
    rows = sales({}, *[{"OrderID": str(i), "Region": "no"} for i in range(9)])
    options = pipeline.Options(RUN_TS, CleaningSpec(max_rejection_rate=1.0))
    run = pipeline.Parts(rows, products(("A", "n", "c")), quotes(), str(tmp_path), options).need("errors")
    assert hints == []
    errors = run.table(spark, "ErrorLogging")
    assert sorted(r["ErrorID"] for r in errors.collect()) == list(range(1, 10))
    assert [r[0] for r in errors.select("ErrorMonth").distinct().collect()] == [RUN_TS.date().replace(day=1)]


def test_rows_in_the_buckets_of_the_keys_are_not_shuffled(spark, sales, tmp_path):
    keys = LoadedKeys(spark, str(tmp_path / "keys"), buckets=8)
    rows = sales(*[{"OrderID": str(i), "ProductID": "A"} for i in range(60)], {"OrderID": None}, {"OrderID": "1", "ProductID": None})
    lying = keys.in_buckets(rows, str(tmp_path / "rows"))
    # No other batch has keys: nothing is joined.
    assert "Join" not in plan(keys.new_rows(lying, "b1")) and keys.new_rows(lying, "b1").count() == 62
    keys.add(lying.filter("OrderID < '3'"), "b1")
    assert "Join" not in plan(keys.new_rows(lying, "b1"))
    new = keys.new_rows(lying, "b2")
    assert "Exchange" not in plan(new) and "SortMergeJoin" in plan(new)
    want = [r for r in rows.collect() if r["OrderID"] is None or r["ProductID"] is None or not r["OrderID"] < "3"]
    assert sorted(map(str, new.collect())) == sorted(map(str, want)) and new.columns == rows.columns


def test_tables_are_derived_in_parts_that_do_not_grow(spark, tmp_path, monkeypatch):
    small, large = (settings.bounded_settings(size * settings.MEGABYTE, 4) for size in (100, 6000))
    parts = "spark.sql.shuffle.partitions"
    assert int(large[parts]) == 60 * int(small[parts]) and {**large, parts: ""} == {**small, parts: ""}
    seen, before = [], {name: spark.conf.get(name, None) for name in small}
    rows = spark.createDataFrame([], ", ".join(f"{c} string" for c in SALES_COLUMNS))
    derive = lambda *_: seen.append({name: spark.conf.get(name) for name in small}) or rows
    monkeypatch.setattr(registry.driver_tables, "raw_sales", derive)
    registry.raw(spark, str(tmp_path / "none"))
    assert seen == [settings.bounded_settings(0, spark.sparkContext.defaultParallelism)]
    assert {name: spark.conf.get(name, None) for name in small} == before


def test_state_of_inputs(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "t"))
    read = lambda: spark.read.parquet(str(tmp_path / "t"))
    first = hadoop.state_of_inputs(read())
    assert first and first == hadoop.state_of_inputs(read()) != hadoop.state_of_inputs(read().filter("id > 1"))
    spark.range(10).write.mode("append").parquet(str(tmp_path / "t"))
    assert hadoop.state_of_inputs(read()) != first and hadoop.state_of_inputs(spark.createDataFrame([(1,)], "a int")) is None


# --- external database ------------------------------------------------------------------


def test_swap_of_a_staged_batch(spark, monkeypatch):
    """The statements as text: no database is started here."""
    sent, ran = [], []
    monkeypatch.setattr(tables, "load_jdbc", lambda df, *rest: sent.append((df, rest)))
    tables.load_jdbc_batch(spark.range(10).withColumnRenamed("id", "OrderID"), "jdbc:x", "Sales", "BatchID", "b7", ran.extend, 500, 4)
    (staged, rest), = sent
    assert rest == ("jdbc:x", "Sales_staging_b7", "replace", 500, 4) and staged.columns == ["OrderID", "BatchID", "LoadRow"]
    assert staged.select("LoadRow").distinct().count() == 10
    assert ran[0] == "BEGIN TRANSACTION" and ran[3] == "COMMIT" and ran[1] == "DELETE FROM Sales WHERE BatchID = 'b7'"
    assert ran[4] == "DROP TABLE Sales_staging_b7"
    # The inner query, run here, takes one of each repeated row.
    staged.unionByName(staged.limit(4)).createOrReplaceTempView("Sales_staging_b7")
    taken = spark.sql(ran[2][ran[2].index("SELECT") :])
    assert taken.columns == ["OrderID", "BatchID"] and taken.count() == taken.distinct().count() == 10
