"""The stages as lazy steps, and the whole run with each wide result written once.

A run replaces the target tables, or loads them as a named batch: the batch takes the place of what it loaded before,
rows that other batches have loaded are left out, and all other rows stay. A run that failed can be
taken up again: stages that are finished with the same inputs and options are not repeated.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from datetime import datetime, timedelta
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks import settings
from tallyworks.functions.dates import timestamp_literal
from tallyworks.operators import clean as cleaning
from tallyworks.operators import enrich as enrichment
from tallyworks.operators import ids, metrics
from tallyworks.operators.rate_cache import RateCache
from tallyworks.plans.manifest import Manifest, chained, inputs_state
from tallyworks.schemas import BATCH_COLUMN, CORRUPT_COLUMN, ID_COLUMNS, TARGET_CURRENCY, CleaningSpec
from tallyworks.sources import files, hadoop, tables
from tallyworks.sources.loaded_keys import LoadedKeys
from tallyworks.sources.targets import FULL, CatalogTarget, FolderTarget, last_id, other_batches

METRIC_SCHEMA = "stage string, metric string, value double, error string"
# Lines that differ from run to run.
CLOCK_METRICS = ("duration_seconds", "start_time", "end_time")


# --- stages -----------------------------------------------------------------------------


def ingest(
    spark: SparkSession, sales_path: str, products_path: str, on_malformed: str = "keep"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sales, products, profile) of two CSV files; raises if a column is missing.

    With ``reject`` malformed rows are marked: cleaning turns those of the sales into rejects, and those of
    the products go to ``cleaning.product_rejects``.
    """
    sales = files.read_sales(spark, sales_path, on_malformed)
    products = files.read_products(spark, products_path, on_malformed)
    files.check_inputs(sales, products)
    return sales, products, metrics.data_profile(sales, products)


def clean_sales(
    raw: DataFrame, run_ts: datetime, spec: CleaningSpec = CleaningSpec()
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(cleaned, rejected, metrics) of raw rows."""
    tagged = cleaning.tag_rows(raw, spec)
    rejected = cleaning.rejects(tagged, run_ts, spec)
    return cleaning.clean(tagged, spec), rejected, metrics.clean_metrics(
        tagged, spec.duplicate_keys, spec.remove_duplicates
    )


def enrich_sales(
    cleaned: DataFrame,
    products: DataFrame | None,
    rates: DataFrame | None,
    run_ts: datetime,
    spec: CleaningSpec = CleaningSpec(),
) -> tuple[DataFrame, DataFrame]:
    """(final rows, metrics) of cleaned rows; ``None`` switches a step off."""
    enriched = enrichment.enrich(cleaned, products, rates, run_ts)
    return enrichment.finalize(enriched), metrics.enrich_metrics(cleaned, enriched)


def load_all(
    final: DataFrame, rejected: DataFrame, logs: DataFrame, write: Callable[[DataFrame, str], DataFrame]
) -> DataFrame:
    """Refresh the three target tables and count their rows."""
    sales = write(tables.sales_table(final), "SalesData")
    errors = write(tables.error_table(rejected), "ErrorLogging")
    return tables.loading_summary(sales, errors, write(metrics.conversion_log_table(logs), "CurrencyConversionLog"))


# --- the whole run ----------------------------------------------------------------------


@dataclass(frozen=True)
class Options:
    """Parameters of a run; ``run_ts`` stands for the present time everywhere.

    The target tables lie in the folder ``tables`` (by default the run's own) or in the catalog's ``database``.
    Without ``batch`` they are refreshed in full; with it, the run loads that batch. ``rate_cache`` is a folder of
    rates that runs share. With ``resume`` finished stages are not repeated.
    """

    run_ts: datetime
    spec: CleaningSpec = CleaningSpec()
    ttl: timedelta = timedelta(hours=1)
    as_of: datetime | None = None
    lookup_products: bool = True
    convert_amounts: bool = True
    export_csv: bool = True
    database: str | None = None
    tables: str | None = None
    batch: str | None = None
    rate_cache: str | None = None
    resume: bool = False


@dataclass
class Run:
    """Where a run writes its results and what it has measured."""

    folder: str
    database: str | None = None
    tables: str | None = None
    batch: str | None = None
    lines: list[tuple[str, str, float]] = field(default_factory=list)
    errors: dict[str, str] = field(default_factory=dict)

    @property
    def target(self) -> FolderTarget:
        return CatalogTarget(self.database) if self.database else FolderTarget(self.tables or self.folder)

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        """A target table, all batches."""
        return self.target.read(spark, name)

    def refresh(self, df: DataFrame, name: str, one_month: bool = False) -> DataFrame:
        """Load a target table, in full or as the run's batch."""
        return self.target.load(df, name, self.batch, one_month=one_month).table

    def record(self, stage: str, values: dict[str, Any]) -> None:
        self.lines += [(stage, name, float(value)) for name, value in values.items()]

    def timed(self, stage: str, step: Callable[..., dict[str, Any]], *args) -> None:
        """Run a step and record what it measured; a step that fails is recorded with its error and raises."""
        started = time.monotonic()
        try:
            values = step(*args)
        except Exception as error:
            self.errors[stage] = f"{type(error).__name__}: {error}"
            self.record(stage, {"success": 0, "duration_seconds": time.monotonic() - started})
            raise
        self.record(stage, {**values, "success": 1, "duration_seconds": time.monotonic() - started})

    def metrics(self, spark: SparkSession) -> DataFrame:
        """The recorded lines; the text of an error stands beside the ``success`` of its stage."""
        rows = [(s, m, v, self.errors.get(s) if m == "success" else None) for s, m, v in self.lines]
        return files.few_rows(spark, rows, METRIC_SCHEMA)


@dataclass
class State:
    """Frames and counts handed from stage to stage; ``saved`` is what the next run needs to go on from here."""

    sales: DataFrame
    products: DataFrame
    quotes: DataFrame
    options: Options
    tagged: DataFrame | None = None
    cleaned: DataFrame | None = None
    loaded: dict[str, DataFrame] = field(default_factory=dict)
    saved: dict[str, Any] = field(default_factory=dict)

    @property
    def spark(self) -> SparkSession:
        return self.sales.sparkSession


def _observed(df: DataFrame, name: str, measures: dict[str, Column]) -> tuple[DataFrame, Observation]:
    seen = Observation(name)
    return df.observe(seen, *[measure.alias(label) for label, measure in measures.items()]), seen


def _tag(run: Run, state: State) -> dict[str, int]:
    """Tag the raw rows and write them once; both the rejects and the accepted rows read this."""
    tagged = cleaning.tag_rows(state.sales, state.options.spec)
    observed, seen = _observed(tagged, "tagged", metrics.stage_counts(tagged.columns))
    state.tagged = files.write_and_read(observed, run.path("staging/tagged"))
    return dict(seen.get)


def _ingestion(run: Run, state: State) -> dict[str, Any]:
    """Tag the raw rows and profile them.

    Product lines that are marked where they are malformed are written as well, marks included.
    """
    files.check_inputs(state.sales, state.products)
    if CORRUPT_COLUMN in state.products.columns:
        state.products = files.write_and_read(state.products, run.path(MARKED_PRODUCTS))
        state.saved["products"] = state.products.schema.json()
    checked = _tag(run, state)
    profile = metrics.data_profile(state.tagged, cleaning.sound_products(state.products))
    lines = {row["Metric"]: row["Value"] for row in profile.collect()}
    summary = files.few_rows(state.spark, list(lines.items()), "Metric string, Value bigint")
    files.write_json_summary(summary, run.path("raw_data_summary"))
    state.saved |= {"checked": checked, "tagged": state.tagged.schema.json()}
    return {"records_processed": checked["initial_records"], "product_records": lines["product_records"]}


MARKED_PRODUCTS = "staging/products"


def _after_ingestion(run: Run, state: State) -> None:
    def written(name: str, place: str) -> DataFrame:
        return files.read_written(state.spark, run.path(place), T.StructType.fromJson(json.loads(state.saved[name])))

    state.tagged = written("tagged", "staging/tagged")
    if "products" in state.saved:
        state.products = written("products", MARKED_PRODUCTS)


ROW = "_row"
# Numbers of product lines, after those of all sales rows.
_PRODUCTS_AFTER = 1 << 62


def _rejected(run: Run, state: State) -> tuple[DataFrame, dict[str, int]]:
    """Error rows with their identifiers, and how many product lines are among them.

    The refused rows are written on their own first: their numbers within a task then have no gaps.
    """
    options = state.options
    refused = state.tagged.filter(F.col(cleaning.CHECK).isNotNull()).withColumn(ROW, ids.row_number_of_write())
    refused = files.write_and_read(refused, run.path("staging/refused"))
    rows, counts = cleaning.rejects(refused, options.run_ts, options.spec, [ROW]), {}
    if CORRUPT_COLUMN in state.products.columns:
        late = (ids.row_number_of_write() + F.lit(_PRODUCTS_AFTER)).alias(ROW)
        lines, seen = _observed(cleaning.product_rejects(state.products, options.run_ts, [late]), "products", {"n": F.count(F.lit(1))})
        rows = rows.unionByName(files.write_and_read(lines, run.path("staging/refused_products")))
        counts["malformed_products"] = seen.get["n"]
    name = ID_COLUMNS["ErrorLogging"]
    numbered = ids.with_ids(rows, name, ROW, _last_id(run, state, "ErrorLogging"))
    return numbered.withColumnRenamed("RejectionTimestamp", "ErrorTimestamp"), counts


def _last_id(run: Run, state: State, name: str) -> int:
    """The greatest identifier that other batches hold; a full refresh counts from the start."""
    if run.batch is None or not run.target.exists(state.spark, name):
        return 0
    return last_id(other_batches(run.table(state.spark, name), run.batch), name)


def _together(*steps: Callable[[], Any]) -> list[Any]:
    """Results of steps that do not need each other: their jobs share the cores, so that small ones fill the gaps."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [done.result() for done in [pool.submit(step) for step in steps]]


def _load_rejects(run: Run, state: State) -> dict[str, int]:
    """Load the rejects; all of a run bear the time of the run."""
    rejected, counts = _rejected(run, state)
    state.loaded["ErrorLogging"] = run.refresh(rejected, "ErrorLogging", one_month=True)
    return counts


def _write_rejects(run: Run, state: State) -> dict[str, int]:
    counts = _load_rejects(run, state)
    if state.options.export_csv:
        rows = _of_batch(run, state.loaded["ErrorLogging"]).withColumnRenamed("ErrorTimestamp", "RejectionTimestamp")
        files.write_csv(tables.rejection_rows(rows), run.path("rejected_records_csv"))
    return counts


def _write_cleaned(run: Run, state: State) -> dict[str, int]:
    """The cleaned rows, for a batch without those that other batches have loaded."""
    spec = state.options.spec
    observed, seen = _observed(cleaning.clean(state.tagged, spec), "cleaned", {"final_records": F.count(F.lit(1))})
    state.cleaned = files.write_and_read(observed, run.path("staging/cleaned"))
    values = {"final_records": seen.get["final_records"]}
    if run.batch:
        new = LoadedKeys(state.spark, _keys_folder(run, state.spark), spec.duplicate_keys).new_rows(state.cleaned, run.batch)
        observed, seen = _observed(new, "new", {"n": F.count(F.lit(1))})
        state.cleaned = files.write_and_read(observed, run.path("staging/new"))
        values["already_loaded"] = values["final_records"] - seen.get["n"]
    return values


def _cleaning(run: Run, state: State) -> dict[str, Any]:
    """Write the rejects, and the cleaned rows unless the rejection rate stops the run after the rejects are written."""
    checked, limit = state.saved["checked"], state.options.spec.max_rejection_rate
    failed, total = checked["rejected_records"], checked["initial_records"]
    steps = [lambda: _write_rejects(run, state)]
    if metrics.within_limit(failed, total, limit):
        steps.append(lambda: _write_cleaned(run, state))
    counts, *cleaned = _together(*steps)
    run.record("cleaning", {**checked, **counts, "rejection_rate": 100 * failed / total if total else 0})
    metrics.enforce_rejection_rate(failed, total, limit)
    values = cleaned[0]
    state.saved["cleaned_rows"] = values["final_records"] - values.get("already_loaded", 0)
    return {**values, "duplicates_removed": total - failed - values["final_records"]}


def _after_cleaning(run: Run, state: State) -> None:
    state.loaded["ErrorLogging"] = run.table(state.spark, "ErrorLogging")
    name = "staging/new" if run.batch else "staging/cleaned"
    state.cleaned = files.read_written(state.spark, run.path(name), cleaning.CLEANED_SCHEMA)


def _of_batch(run: Run, table: DataFrame) -> DataFrame:
    """What this run has loaded."""
    return table.filter(F.col(BATCH_COLUMN) == (run.batch or FULL))


def _keys_folder(run: Run, spark: SparkSession) -> str:
    """Beside SalesData, wherever that lies."""
    run.target.prepare(spark, "SalesData", False)
    return f"{run.target.place(spark, 'SalesData')}_keys"


# Flags that the enriched rows carry to the tasks which write them, to be counted there.
_WITH_PRODUCT, _CONVERTED, _LOGGED = "_with_product", "_converted", "_logged"


def _flags(columns: Sequence[str]) -> dict[str, Column]:
    """What is counted of a row: before final formatting, as that hides missing amounts."""
    flags = {}
    if "ProductName" in columns:
        flags[_WITH_PRODUCT] = F.col("ProductName").isNotNull()
    if "OriginalCurrency" in columns:
        flags[_CONVERTED] = enrichment.is_converted()
        flags[_LOGGED] = F.when(enrichment.is_converted() & F.col("RateSource").isNotNull(), F.col("OriginalCurrency"))
    return flags


def _counts(flags: Iterable[str], spec: CleaningSpec) -> dict[str, Column]:
    """Aggregates over the flags; converted rows per accepted currency, a closed set."""
    counts = {"final_records": F.count(F.lit(1))}
    if _WITH_PRODUCT in flags:
        counts["product_enriched_records"] = F.count_if(F.col(_WITH_PRODUCT))
    if _CONVERTED in flags:
        counts["currency_converted_records"] = F.count_if(F.col(_CONVERTED))
        counts |= {f"in_{c}": F.count_if(F.col(_LOGGED) == c) for c in spec.currencies if c != TARGET_CURRENCY}
    return counts


def _conversion_log(rates: DataFrame, converted: dict[str, int], run_ts: datetime, start: int) -> DataFrame:
    """One line per currency that was converted, with its identifier; at most one per accepted currency."""
    rows = [(start + i, currency, n) for i, (currency, n) in enumerate(((c, n) for c, n in sorted(converted.items()) if n), 1)]
    name = ID_COLUMNS["CurrencyConversionLog"]
    counts = files.few_rows(rates.sparkSession, rows, f"{name} bigint, FromCurrency string, RecordCount bigint")
    return rates.join(F.broadcast(counts), rates["from_currency"] == counts["FromCurrency"]).select(
        name,
        "FromCurrency",
        F.col("to_currency").alias("ToCurrency"),
        F.col("rate").alias("ExchangeRate"),
        F.col("source").alias("Source"),
        "RecordCount",
        timestamp_literal(run_ts).alias("ConversionTimestamp"),
    )


def _rates(run: Run, state: State) -> DataFrame:
    """The rates of this run, written once; what came from the API is remembered for the next one."""
    options, quotes = state.options, state.quotes
    as_of = options.as_of or options.run_ts
    cache = RateCache(state.spark, options.rate_cache) if options.rate_cache else None
    if cache:
        quotes = quotes.unionByName(cache.quotes())
    resolved = enrichment.resolve_rates(quotes, as_of, options.ttl, TARGET_CURRENCY, options.spec.currencies)
    rates = files.write_and_read(resolved, run.path("staging/rates"))
    if cache:
        cache.merge(rates, as_of, options.ttl)
    return rates


def _load_sales(run: Run, state: State, rates: DataFrame) -> dict[str, int]:
    """Enrich and load the cleaned rows in one pass, counting on the way."""
    options, spec = state.options, state.options.spec
    if options.convert_amounts:
        enrichment.check_amounts_fit(rates, max(abs(spec.amount_min), abs(spec.amount_max)))
    enriched = enrichment.enrich(
        state.cleaned,
        cleaning.sound_products(state.products) if options.lookup_products else None,
        rates if options.convert_amounts else None,
        options.run_ts,
    )
    flags = _flags(enriched.columns)
    final = enrichment.finalize(enriched.withColumns(flags))
    sales = run.target.load(final, "SalesData", run.batch, _counts(flags, spec))
    state.loaded["SalesData"] = sales.table
    counts = sales.measured
    converted = {c.removeprefix("in_"): counts.pop(c) for c in list(counts) if c.startswith("in_")}
    log = _conversion_log(rates, converted, options.run_ts, _last_id(run, state, "CurrencyConversionLog"))
    state.loaded["CurrencyConversionLog"] = run.refresh(log, "CurrencyConversionLog")
    if run.batch:
        keys = LoadedKeys(state.spark, _keys_folder(run, state.spark), spec.duplicate_keys)
        keys.add(_of_batch(run, sales.table), run.batch)
    return counts


def _enrichment(run: Run, state: State) -> dict[str, Any]:
    options, counts = state.options, _load_sales(run, state, _rates(run, state))
    values = {
        "initial_records": state.saved["cleaned_rows"],
        **counts,
        "product_enrichment_enabled": options.lookup_products,
        "currency_conversion_enabled": options.convert_amounts,
    }
    summary = files.few_rows(state.spark, [(name, float(value)) for name, value in values.items()], "metric string, value double")
    files.write_json_summary(summary, run.path("enrichment_summary"))
    return values


def _after_enrichment(run: Run, state: State) -> None:
    for name in ("SalesData", "CurrencyConversionLog"):
        state.loaded[name] = run.table(state.spark, name)


def _loading(run: Run, state: State) -> dict[str, Any]:
    """Export the enriched rows of this run and count what the tables hold of it."""
    loaded = {name: _of_batch(run, table) for name, table in state.loaded.items()}
    summary = tables.loading_summary(loaded["SalesData"], loaded["ErrorLogging"], loaded["CurrencyConversionLog"])

    def export() -> None:
        if state.options.export_csv:
            files.write_csv(enrichment.export_rows(loaded["SalesData"]), run.path("cleaned_sales_csv"))

    lines, _ = _together(summary.collect, export)
    counts = {row["TableName"]: row["RowCount"] for row in lines}
    return {
        "sales_records_loaded": counts["SalesData"],
        "error_records_loaded": counts["ErrorLogging"],
        "conversion_logs_loaded": counts["CurrencyConversionLog"],
    }


# Each stage, and how a later run takes up what it left.
STAGES = (
    ("ingestion", _ingestion, _after_ingestion),
    ("cleaning", _cleaning, _after_cleaning),
    ("enrichment", _enrichment, _after_enrichment),
    ("loading", _loading, lambda run, state: None),
)


class Parts:
    """A run of which only those parts are written that are asked for, each once, by the steps of the whole run.

    Who needs one table alone has no exports, profile or other tables made. The rejection rate stops it as it does a whole run.
    """

    NEEDS = {"tagged": (), "errors": ("tagged",), "cleaned": ("tagged",), "rates": (), "sales": ("cleaned", "rates")}

    def __init__(self, sales: DataFrame, products: DataFrame, quotes: DataFrame, folder: str, options: Options) -> None:
        self.run = Run(folder.rstrip("/"), options.database, options.tables, options.batch)
        self.state = State(sales, products, quotes, options)
        self.done: dict[str, Any] = {}

    def need(self, *names: str) -> Run:
        for name in names:
            if name not in self.done:
                self.need(*self.NEEDS[name])
                self.done[name] = getattr(self, f"_{name}")()
        return self.run

    def _tagged(self) -> None:
        files.check_inputs(self.state.sales, self.state.products)
        checked = _tag(self.run, self.state)
        limit = self.state.options.spec.max_rejection_rate
        metrics.enforce_rejection_rate(checked["rejected_records"], checked["initial_records"], limit)

    def _errors(self) -> dict[str, int]:
        return _load_rejects(self.run, self.state)

    def _cleaned(self) -> dict[str, int]:
        return _write_cleaned(self.run, self.state)

    def _rates(self) -> DataFrame:
        return _rates(self.run, self.state)

    def _sales(self) -> dict[str, int]:
        return _load_sales(self.run, self.state, self.done["rates"])


def _resumable(stage: str, step, take_up, run: Run, state: State, manifest: Manifest, fingerprint: str) -> dict[str, Any]:
    """A stage of a run that may be taken up again: not repeated if it is finished with this fingerprint."""
    found = manifest.saved(stage, fingerprint) if state.options.resume else None
    if found is not None:
        run.record(stage, found["recorded"])
        state.saved |= found["state"]
        take_up(run, state)
        return {**found["values"], "resumed": 1}
    manifest.begin(stage)
    known = len(run.lines)
    values = step(run, state)
    recorded = {name: value for s, name, value in run.lines[known:] if s == stage}
    manifest.finish(stage, fingerprint, {"values": values, "recorded": recorded, "state": state.saved})
    return values


def run_pipeline(
    sales: DataFrame, products: DataFrame, quotes: DataFrame, folder: str, options: Options
) -> Run:
    """Run all stages and return the metrics; ``folder`` must be shared storage.

    The counts come from observations on the final stage of a write, where a repeated
    task is counted once, so nothing is computed twice for its metrics. Any failed step
    raises, after the metrics so far have been written. A run that is to be taken up again needs inputs that
    come from files, so that it can be told whether they are the same.
    """
    run = Run(folder.rstrip("/"), options.database, options.tables, options.batch)
    state = State(sales, products, quotes, options)
    manifest, fingerprint = Manifest(sales.sparkSession, run.folder), None
    if options.resume:
        inputs = inputs_state(sales, products, quotes)
        fingerprint = inputs and chained(inputs, replace(options, resume=False))
    if fingerprint is None:
        manifest.clear()
    finished, started = False, time.time()
    try:
        for stage, step, take_up in STAGES:
            if fingerprint is None:
                run.timed(stage, step, run, state)
            else:
                fingerprint = chained(fingerprint, stage)
                run.timed(stage, _resumable, stage, step, take_up, run, state, manifest, fingerprint)
        finished = True
    finally:
        ended = time.time()
        if finished:
            loaded = {(stage, name): value for stage, name, value in run.lines}
            run.record("pipeline", {"final_records": loaded["loading", "sales_records_loaded"]})
        run.record("pipeline", {"overall_success": finished})
        run.record("pipeline", {"start_time": started, "end_time": ended, "duration_seconds": ended - started})
        files.write_json_summary(run.metrics(sales.sparkSession), run.path("metrics"))
    return run


def run_files(
    spark: SparkSession,
    sales_path: str,
    products_path: str,
    quotes: DataFrame,
    folder: str,
    options: Options,
    on_malformed: str = "keep",
    tuned: bool = True,
) -> Run:
    """The same run over two CSV files; with ``reject`` malformed rows of both become rejects and are counted.

    While it runs, the session has the settings that fit the size of the sales file, unless ``tuned`` is off.
    """
    sales = files.read_sales(spark, sales_path, on_malformed)
    products = files.read_products(spark, products_path, on_malformed)
    if not tuned:
        return run_pipeline(sales, products, quotes, folder, options)
    fitting = settings.session_settings(hadoop.size(spark, sales_path), spark.sparkContext.defaultParallelism)
    with settings.applied(spark, fitting):
        return run_pipeline(sales, products, quotes, folder, options)
