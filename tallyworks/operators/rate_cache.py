"""Exchange rates that one run resolves and the next may use while they are fresh."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.functions.dates import timestamp_literal
from tallyworks.operators.enrich import pack_quote, unpack_quote
from tallyworks.sources.versions import VersionedTable

SCHEMA = "from_currency string, to_currency string, rate decimal(10,6), ts timestamp_ntz"


class RateCache:
    """One row per currency pair: the last rate that came from the API, and when a run took it."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.table = VersionedTable(spark, folder, SCHEMA)

    def quotes(self) -> DataFrame:
        """The remembered rates as quotes; whether they are fresh is for ``resolve_rates`` to say."""
        rows = self.table.read()
        return rows.select("from_currency", "to_currency", "rate", F.lit("cache").alias("source"), "ts")

    def merge(self, resolved: DataFrame, as_of: datetime, ttl: timedelta) -> DataFrame:
        """Take in the rates that a run has just got from the API; a newer rate of a pair replaces the older one.

        Rates past their time go, so the table holds at most one row per pair in use. Rates that came from
        the cache keep the time at which they entered it, and fallback rates are not remembered.
        """
        now = timestamp_literal(as_of)
        expired = now - F.expr(f"INTERVAL '{int(ttl.total_seconds())}' SECOND")
        got = resolved.filter("source = 'API'").select("from_currency", "to_currency", "rate", now.alias("ts"))
        best = F.max(pack_quote(F.lit(0), F.col("ts"), F.col("rate"))).alias("best")
        rows = self.table.read().filter(F.col("ts") > expired).unionByName(got).groupBy("from_currency", "to_currency").agg(best)
        _, ts, rate = unpack_quote(F.col("best"))
        return self.table.replace(rows.select("from_currency", "to_currency", rate.alias("rate"), ts.alias("ts")), files=1)
