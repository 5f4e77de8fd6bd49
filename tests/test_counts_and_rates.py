from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyworks.operators import enrich as E
from tallyworks.plans import pipeline
from tallyworks.schemas import CleaningSpec

TS = datetime(2024, 1, 1, 12)


def yen(spark, *quotes):
    rows = spark.createDataFrame([(Decimal("100"), "JPY")], "SaleAmount decimal(18,6), Currency string")
    schema = "from_currency string, to_currency string, rate decimal(10,6), source string, ts timestamp"
    return rows, spark.createDataFrame([("JPY", "USD", Decimal(r), "API", ts) for r, ts in quotes], schema)


def test_any_currency_with_a_known_rate_is_converted(spark):
    rows, rates = yen(spark, ("0.007", TS))
    got = E.convert_currency(rows, rates).first()
    assert (float(got["SaleAmount"]), float(got["ExchangeRate"]), got["RateSource"]) == (0.7, 0.007, "API")
    assert float(E.convert_strict(rows, rates).first()["ConvertedAmount"]) == 0.7


def test_unresolved_quotes_do_not_repeat_rows(spark):
    rows, rates = yen(spark, ("0.007", TS), ("0.008", datetime(2024, 1, 2)), ("0.009", None))
    got = E.convert_currency(rows, rates).collect()
    assert [float(r["ExchangeRate"]) for r in got] == [0.008]


@pytest.mark.parametrize("remove", [True, False])
@pytest.mark.parametrize("repeated", [True, False])
def test_counts_obey_the_switch(spark, sales, products, quotes, tmp_path, remove, repeated):
    raw = sales({}, {}, {"OrderID": "2"})
    spec = CleaningSpec(remove_duplicates=remove)
    rows = 2 if remove else 3
    cleaned, _, counts = pipeline.clean_sales(raw, TS, spec)
    counts = counts.first()
    assert cleaned.count() == rows
    assert (counts["final_records"], counts["duplicates_removed"]) == (rows, 3 - rows)
    known = products(*[("A", "a", "x")] * (2 if repeated else 1))
    run = pipeline.run_pipeline(raw, known, quotes(("EUR", "USD", "1.1", "API", TS)), str(tmp_path), pipeline.Options(TS, spec))
    lines = {(x[0], x[1]): x[2] for x in spark.read.schema(pipeline.METRIC_SCHEMA).json(run.path("metrics")).filter(F.col("metric") != "duration_seconds").collect()}
    assert lines["cleaning", "final_records"] == rows
    assert lines["cleaning", "duplicates_removed"] == 3 - rows
    assert lines["enrichment", "initial_records"] == rows
