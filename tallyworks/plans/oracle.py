"""SQL for DuckDB that gives the same rows as each registered query.

The statements share one chain of views from the given tables to the loaded ones. Decimal
averages and ratios are computed on whole numbers, so they round exactly like decimals.
"""

from __future__ import annotations

RUN_TS = "TIMESTAMP '2024-02-01 06:30:00'"
RATES_AS_OF = "TIMESTAMP '2024-01-30 12:00:00'"
CACHED_AS_OF = "TIMESTAMP '2024-01-30 12:30:00'"
ACTIVITY_AS_OF = "TIMESTAMP '2001-07-20 00:00:00'"

CHAIN = {
    "raw": """
SELECT CAST(l_orderkey AS VARCHAR) AS OrderID,
  CASE WHEN l_partkey % 50 = 7 THEN 'PX' || CAST(l_partkey AS VARCHAR) ELSE CAST(l_partkey AS VARCHAR) END AS ProductID,
  CASE WHEN l_partkey % 41 = 0 THEN NULL
       WHEN l_partkey % 43 = 0 THEN CAST(-CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR)
       WHEN l_partkey % 37 = 0 THEN CAST(-CAST(l_quantity AS DECIMAL(12,2)) AS VARCHAR)
       ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) END AS SaleAmount,
  CASE WHEN (l_orderkey + l_linenumber) % 20 = 0 THEN NULL
       WHEN (l_orderkey + l_linenumber) % 20 = 1 THEN strftime(o_orderdate, '%Y/%m/%d')
       WHEN (l_orderkey + l_linenumber) % 20 < 9 THEN strftime(o_orderdate, '%d/%m/%Y')
       WHEN (l_orderkey + l_linenumber) % 20 < 15 THEN strftime(o_orderdate, '%d-%m-%Y')
       ELSE strftime(o_orderdate, '%Y-%d-%m') END AS OrderDate,
  CASE r_name WHEN 'AFRICA' THEN 'South' WHEN 'AMERICA' THEN 'West' WHEN 'ASIA' THEN 'East' WHEN 'EUROPE' THEN 'North'
       ELSE CASE WHEN l_linenumber = 6 THEN 'east' ELSE 'East' END END AS Region,
  CASE WHEN o_custkey % 29 = 0 THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS CustomerID,
  CASE WHEN l_partkey % 31 = 0 THEN NULL ELSE CAST(CAST(abs(l_discount) AS DECIMAL(3,2)) AS VARCHAR) END AS Discount,
  CASE n_nationkey % 4 WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP'
       WHEN 3 THEN CASE WHEN l_linenumber = 7 THEN 'JPY' ELSE 'USD' END ELSE 'USD' END AS Currency
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "misfits": """
SELECT OrderID, ProductID, CASE WHEN Region = 'east' THEN part
  ELSE part || ',' || CustomerID || ',' || coalesce(Discount, '') || ',' || Currency || ',extra' END AS RawLine
FROM (SELECT *, OrderID || ',' || ProductID || ',' || coalesce(SaleAmount, '') || ',' || coalesce(OrderDate, '') || ',' || Region AS part FROM raw)
WHERE Region = 'east' OR Currency = 'JPY'""",
    "products": "SELECT CAST(p_partkey AS VARCHAR) AS ProductID, p_name AS ProductName, p_type AS Category FROM part",
    "quotes": """
SELECT CASE user_id % 5 WHEN 0 THEN 'EUR' WHEN 1 THEN 'GBP' WHEN 2 THEN 'USD' WHEN 3 THEN 'EUR' ELSE 'JPY' END AS from_currency,
  CASE WHEN event_id % 4 = 3 THEN 'GBP' ELSE 'USD' END AS to_currency,
  CAST(CASE WHEN event_type = 'error' OR (user_id % 5 = 2 AND event_id % 4 = 3) THEN 0
       ELSE CAST(value AS DECIMAL(10,2)) * CAST(0.01 AS DECIMAL(3,2)) END AS DECIMAL(10,6)) AS rate,
  CASE event_type WHEN 'purchase' THEN 'cache' WHEN 'click' THEN 'API' WHEN 'view' THEN 'API' ELSE 'fallback' END AS source,
  ts FROM events""",
    "rates": f"""
SELECT from_currency, to_currency, rate, source, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY from_currency, to_currency
    ORDER BY CASE source WHEN 'cache' THEN 1 WHEN 'API' THEN 2 ELSE 3 END, ts DESC, rate) AS pick
  FROM quotes
  WHERE rate > 0 AND from_currency <> to_currency AND ts <= {RATES_AS_OF}
    AND (source <> 'cache' OR ts > {RATES_AS_OF} - INTERVAL 1 HOUR))
WHERE pick = 1""",
    "typed": """
SELECT *, try_cast(SaleAmount AS DOUBLE) AS amount, try_cast(Discount AS DOUBLE) AS reduction,
  CAST(coalesce(try_strptime(OrderDate, '%d/%m/%Y'), try_strptime(OrderDate, '%d-%m-%Y'),
                try_strptime(OrderDate, '%Y-%d-%m')) AS DATE) AS day
FROM raw""",
    "flagged": """
SELECT *,
  coalesce(OrderID, '') = '' OR coalesce(ProductID, '') = '' OR coalesce(OrderDate, '') = '' OR coalesce(Region, '') = ''
    OR coalesce(Currency, '') = '' OR coalesce(CustomerID, '') = '' AS bad_required,
  day IS NULL AS bad_date,
  coalesce(Region NOT IN ('East', 'West', 'North', 'South'), FALSE)
    OR coalesce(Currency NOT IN ('USD', 'EUR', 'GBP'), FALSE) AS bad_enum,
  coalesce(NOT (amount BETWEEN -1000 AND 100000), FALSE) OR coalesce(NOT (reduction BETWEEN 0 AND 1), FALSE) AS bad_range,
  'Missing required fields: [' || concat_ws(', ',
    CASE WHEN coalesce(OrderID, '') = '' THEN '''OrderID''' END, CASE WHEN coalesce(ProductID, '') = '' THEN '''ProductID''' END,
    CASE WHEN coalesce(OrderDate, '') = '' THEN '''OrderDate''' END, CASE WHEN coalesce(Region, '') = '' THEN '''Region''' END,
    CASE WHEN coalesce(Currency, '') = '' THEN '''Currency''' END, CASE WHEN coalesce(CustomerID, '') = '' THEN '''CustomerID''' END)
    || ']' AS msg_required,
  'Invalid date format: ' || coalesce(OrderDate, 'None') AS msg_date,
  'Invalid enum values: ' || concat_ws('; ',
    CASE WHEN Region NOT IN ('East', 'West', 'North', 'South') THEN 'Invalid region: ' || Region END,
    CASE WHEN Currency NOT IN ('USD', 'EUR', 'GBP') THEN 'Invalid currency: ' || Currency END) AS msg_enum,
  'Invalid numeric ranges: ' || concat_ws('; ',
    CASE WHEN amount < -1000 OR amount > 100000 THEN 'SaleAmount out of range: ' || CAST(amount AS VARCHAR) END,
    CASE WHEN reduction < 0 OR reduction > 1 THEN 'Discount out of range: ' || CAST(reduction AS VARCHAR) END) AS msg_range
FROM typed""",
    "tagged": """
SELECT *, CASE WHEN bad_required THEN 'required' WHEN bad_date THEN 'date' WHEN bad_enum THEN 'enum'
               WHEN bad_range THEN 'range' END AS failed
FROM flagged""",
    "rejected": f"""
SELECT OrderID, ProductID,
  CASE failed WHEN 'required' THEN 'Missing Required Fields' WHEN 'date' THEN 'Invalid Date Format'
              WHEN 'enum' THEN 'Invalid Enum Values' ELSE 'Invalid Numeric Range' END AS ErrorType,
  CASE failed WHEN 'required' THEN msg_required WHEN 'date' THEN msg_date WHEN 'enum' THEN msg_enum ELSE msg_range END AS ErrorMessage,
  CASE failed WHEN 'required' THEN 'Required Field Validation' WHEN 'date' THEN 'Date Validation'
              WHEN 'enum' THEN 'Enum Validation' ELSE 'Numeric Validation' END AS ProcessingStage,
  {RUN_TS} AS ErrorTimestamp
FROM tagged WHERE failed IS NOT NULL""",
    "accepted": """
SELECT OrderID, ProductID, CAST(SaleAmount AS DECIMAL(27,12)) AS SaleAmount, CAST(day AS TIMESTAMP) AS OrderDate,
  Region, CustomerID, CAST(Discount AS DECIMAL(27,12)) AS Discount, Currency
FROM tagged WHERE failed IS NULL""",
    "deduped": """
SELECT * EXCLUDE (pick) FROM (
  SELECT *, row_number() OVER (PARTITION BY OrderID, ProductID ORDER BY SaleAmount NULLS FIRST, OrderDate NULLS FIRST,
    Region NULLS FIRST, CustomerID NULLS FIRST, Discount NULLS FIRST, Currency NULLS FIRST) AS pick
  FROM accepted)
WHERE pick = 1""",
    "cleaned": """
SELECT trim(OrderID) AS OrderID, trim(ProductID) AS ProductID, SaleAmount, OrderDate,
  upper(trim(Region)[1]) || lower(trim(Region)[2:]) AS Region, trim(CustomerID) AS CustomerID,
  coalesce(Discount, 0) AS Discount, trim(Currency) AS Currency
FROM deduped""",
    "matched": """
SELECT c.*, p.ProductName, p.Category FROM cleaned c LEFT JOIN products p ON c.ProductID = p.ProductID""",
    "converted": """
SELECT m.* EXCLUDE (SaleAmount, Currency), 'USD' AS Currency,
  m.SaleAmount * CASE WHEN m.Currency = 'USD' THEN CAST(1 AS DECIMAL(10,6)) ELSE coalesce(r.rate, CAST(1 AS DECIMAL(10,6))) END AS SaleAmount,
  m.SaleAmount AS OriginalSaleAmount, m.Currency AS OriginalCurrency,
  CAST(CASE WHEN m.Currency = 'USD' THEN 1 ELSE coalesce(r.rate, 1) END AS DECIMAL(10,6)) AS ExchangeRate,
  CASE WHEN m.Currency <> 'USD' THEN r.source END AS RateSource
FROM matched m LEFT JOIN rates r ON m.Currency = r.from_currency AND r.to_currency = 'USD'""",
    "sales": f"""
SELECT OrderID, ProductID, ProductName, Category,
  CAST(abs(coalesce(round(SaleAmount, 1), 0)) AS DECIMAL(18,2)) AS SaleAmount,
  CAST(abs(coalesce(OriginalSaleAmount, 0)) AS DECIMAL(18,2)) AS OriginalSaleAmount,
  OriginalCurrency, ExchangeRate, OrderDate, Region, CustomerID, CAST(Discount AS DECIMAL(3,2)) AS Discount, Currency,
  {RUN_TS} AS ProcessingTimestamp
FROM converted""",
    "logs": f"""
SELECT OriginalCurrency AS FromCurrency, Currency AS ToCurrency, ExchangeRate, {RUN_TS} AS ConversionTimestamp,
  RateSource AS Source, count(*) AS RecordCount
FROM converted WHERE OriginalCurrency <> 'USD' AND SaleAmount IS NOT NULL AND RateSource IS NOT NULL
GROUP BY ALL""",
}

# What each view of the chain reads.
READS = {
    "misfits": ["raw"],
    "rates": ["quotes"],
    "typed": ["raw"],
    "flagged": ["typed"],
    "tagged": ["flagged"],
    "rejected": ["tagged"],
    "accepted": ["tagged"],
    "deduped": ["accepted"],
    "cleaned": ["deduped"],
    "matched": ["cleaned", "products"],
    "converted": ["matched", "rates"],
    "sales": ["converted"],
    "logs": ["converted"],
}


def statement(body: str, *views: str) -> str:
    """A query over the named views, with what they are built from."""
    needed: set[str] = set()
    pending = list(views)
    while pending:
        name = pending.pop()
        needed.add(name)
        pending += READS.get(name, [])
    parts = [f"{name} AS ({CHAIN[name].strip()})" for name in CHAIN if name in needed]
    return f"WITH {', '.join(parts)}\n{body.strip()}"


def scaled(whole: str, digits: int, kind: str) -> str:
    """A whole number of units of the last decimal place as a decimal."""
    unit = f"CAST({10 ** -digits:.{digits}f} AS DECIMAL({digits + 1},{digits}))"
    return f"CAST(CAST({whole} AS DECIMAL(25,0)) * {unit} AS {kind})"


def divided(units: str, by: str, digits: int, kind: str) -> str:
    """``units / by`` of non-negative whole numbers to that many places, half up."""
    return scaled(f"(({units}) * {10 ** digits} * 2 + ({by})) // (2 * ({by}))", digits, kind)


def average(column: str, scale: int, kind: str) -> str:
    """Exact average of non-negative decimals, four places more than the column has."""
    units = f"CAST(sum({column}) * {10 ** scale} AS HUGEINT)"
    whole = f"({units} * {10 ** 4} * 2 + count({column})) // (2 * count({column}))"
    return scaled(whole, scale + 4, kind)


AVERAGE_AMOUNT = average("SaleAmount", 2, "DECIMAL(22,6)")
TOTAL = "CAST(sum(SaleAmount) AS DECIMAL(38,2))"
CENTS = "CAST(sum(SaleAmount) * 100 AS HUGEINT)"


def percent(part: str, whole: str) -> str:
    exact = divided(f"CAST({part} AS HUGEINT) * 100", f"CAST({whole} AS HUGEINT)", 4, "DECIMAL(18,4)")
    return f"CASE WHEN {whole} = 0 THEN CAST(0 AS DECIMAL(18,4)) ELSE {exact} END"


def lines(view: str, measures: dict[str, str], key: str = "Metric", value: str = "Value") -> str:
    """One line per measure, each a scalar over the view."""
    rows = [f"SELECT '{name}' AS {key}, CAST({measure} AS BIGINT) AS {value} FROM {view}" for name, measure in measures.items()]
    return "\nUNION ALL ".join(rows)


def nulls(column: str) -> str:
    return f"count(*) - count({column})"


def distinct(column: str) -> str:
    return f"count(DISTINCT {column}) + CASE WHEN count(*) > count({column}) THEN 1 ELSE 0 END"


PROFILE = {
    "sales_records": "count(*)",
    **{f"null_{c}": nulls(c) for c in ("OrderID", "ProductID")},
    "null_SaleAmount": nulls("amount"),
    **{f"null_{c}": nulls(c) for c in ("OrderDate", "Region", "Currency")},
    "unique_regions": distinct("Region"),
    "unique_currencies": distinct("Currency"),
    "unique_products": distinct("ProductID"),
}

RULES = [
    ("OrderID", "required", "OrderID is required", "coalesce(OrderID, '') = ''"),
    ("ProductID", "required", "ProductID is required", "coalesce(ProductID, '') = ''"),
    ("SaleAmount", "range", "SaleAmount must be between -1000 and 10000", "NOT (amount BETWEEN -1000 AND 10000)"),
    ("OrderDate", "date_format", "OrderDate must be in valid date format", "OrderDate IS NOT NULL AND day IS NULL"),
    (
        "Region",
        "enum",
        "Region must be one of: East, West, North, South",
        "Region NOT IN ('East', 'West', 'North', 'South')",
    ),
    ("Currency", "enum", "Currency must be one of: USD, EUR, GBP", "Currency NOT IN ('USD', 'EUR', 'GBP')"),
    ("Discount", "range", "Discount must be between 0 and 1", "NOT (reduction BETWEEN 0 AND 1)"),
]

CONTRACTS = {
    ("raw", "typed"): {
        "OrderID": "OrderID IS NULL",
        "ProductID": "ProductID IS NULL",
        "SaleAmount": "amount < -1000 OR amount > 10000",
        "Discount": "reduction < 0 OR reduction > 1",
        "Currency": "Currency NOT IN ('USD', 'EUR', 'GBP')",
        "Region": "Region NOT IN ('East', 'West', 'North', 'South')",
    },
    ("cleaned", "sales"): {
        "OrderID": "OrderID IS NULL",
        "ProductID": "ProductID IS NULL",
        "SaleAmount": "SaleAmount IS NULL OR SaleAmount < -1000 OR SaleAmount > 10000",
        "OrderDate": "OrderDate IS NULL",
        "Region": "Region IS NULL",
        "Discount": "Discount < 0 OR Discount > 1",
    },
}

STAGE_COUNTS = {
    "initial_records": "count(*)",
    "missing_required_fields": "count(*) FILTER (failed = 'required')",
    "invalid_dates": "count(*) FILTER (failed = 'date')",
    "invalid_enums": "count(*) FILTER (failed = 'enum')",
    "invalid_numeric": "count(*) FILTER (failed = 'range')",
    "rejected_records": "count(failed)",
}
DISTINCT_KEYS = "count(DISTINCT CASE WHEN failed IS NULL THEN {'o': OrderID, 'p': ProductID} END)"
DUPLICATES = f"count(*) - count(failed) - {DISTINCT_KEYS}"

ENRICH_COUNTS = {
    "product_enriched_records": "count(ProductName)",
    "currency_converted_records": "count(*) FILTER (OriginalCurrency <> 'USD' AND SaleAmount IS NOT NULL)",
    "final_records": "count(*)",
}


def _rule_report() -> str:
    rows = [
        f"SELECT '{field}' AS FieldName, '{kind}' AS RuleType, '{message}' AS ErrorMessage, count(*) AS CheckedCount, "
        f"count(*) FILTER ({broken}) AS ViolationCount FROM typed"
        for field, kind, message, broken in RULES
    ]
    return statement("\nUNION ALL ".join(rows), "typed")


def _contracts() -> str:
    rows = [
        f"SELECT '{name}' AS Contract, '{field}' AS FieldName, count(*) FILTER ({broken}) AS ViolationCount FROM {view}"
        for (name, view), fields in CONTRACTS.items()
        for field, broken in fields.items()
    ]
    return statement("\nUNION ALL ".join(rows), "typed", "sales")


def _pipeline_metrics() -> str:
    def stage(name: str, view: str, measures: dict[str, str]) -> list[str]:
        return [
            f"SELECT '{name}' AS stage, '{metric}' AS metric, CAST({measure} AS DOUBLE) AS value FROM {view}"
            for metric, measure in measures.items()
        ]

    rows = stage("ingestion", "raw", {"records_processed": "count(*)"})
    rows += stage("ingestion", "products", {"product_records": "count(*)"})
    rows += stage(
        "cleaning",
        "tagged",
        {
            **STAGE_COUNTS,
            "rejection_rate": "CAST(100 * count(failed) AS DOUBLE) / CAST(count(*) AS DOUBLE)",
            "final_records": DISTINCT_KEYS,
            "duplicates_removed": DUPLICATES,
        },
    )
    rows += stage("enrichment", "cleaned", {"initial_records": "count(*)"})
    rows += stage("enrichment", "converted", ENRICH_COUNTS)
    rows += stage("loading", "sales", {"sales_records_loaded": "count(*)"})
    rows += stage("loading", "rejected", {"error_records_loaded": "count(*)"})
    rows += stage("loading", "logs", {"conversion_logs_loaded": "count(*)"})
    for switch in ("product_enrichment_enabled", "currency_conversion_enabled"):
        rows.append(f"SELECT 'enrichment', '{switch}', CAST(1 AS DOUBLE)")
    for name in ("ingestion", "cleaning", "enrichment", "loading"):
        rows.append(f"SELECT '{name}', 'success', CAST(1 AS DOUBLE)")
    rows += stage("pipeline", "sales", {"final_records": "count(*)"})
    rows.append("SELECT 'pipeline', 'overall_success', CAST(1 AS DOUBLE)")
    return statement("\nUNION ALL ".join(rows), "raw", "products", "tagged", "sales", "rejected", "logs")


def _cached_rates() -> str:
    """The rates as of half an hour later, with those that came from the API at first as quotes of the cache."""
    later = CHAIN["rates"].replace(RATES_AS_OF, CACHED_AS_OF).replace("FROM quotes", "FROM known")
    body = f"""
SELECT * FROM ({later.strip()})"""
    known = f"SELECT * FROM quotes UNION ALL SELECT from_currency, to_currency, rate, 'cache', {RATES_AS_OF} FROM rates WHERE source = 'API'"
    return statement(body, "rates").replace("\nSELECT * FROM (", f", known AS ({known})\nSELECT * FROM (", 1)


def _operators() -> dict[str, str]:
    def check(column: str, *names: str) -> str:
        shown = ", ".join(("OrderID", "ProductID") + names)
        return statement(f"SELECT {shown}, CASE WHEN bad_{column} THEN msg_{column} END AS ErrorMessage FROM flagged", "flagged")

    return {
        "scan_sales": statement("SELECT * REPLACE (nullif(CustomerID, '') AS CustomerID) FROM raw", "raw"),
        "scan_products": statement("SELECT * FROM products", "products"),
        "malformed_rows": statement("SELECT OrderID, RawLine FROM misfits", "misfits"),
        "malformed_rejects": statement(
            f"""
SELECT OrderID, ProductID, 'Malformed Row' AS ErrorType, 'Wrong number of fields: ' || RawLine AS ErrorMessage,
  'File Ingestion' AS ProcessingStage, {RUN_TS} AS RejectionTimestamp FROM misfits""",
            "misfits",
        ),
        "export_rows": statement(
            """
SELECT * REPLACE (strftime(OrderDate, '%Y-%m-%d') AS OrderDate, strftime(ProcessingTimestamp, '%Y-%m-%d') AS ProcessingTimestamp)
FROM sales""",
            "sales",
        ),
        "safe_cast": statement("SELECT OrderID, ProductID, amount AS SaleAmount, reduction AS Discount FROM typed", "typed"),
        "check_required": check("required"),
        "parse_dates": statement("SELECT OrderID, ProductID, OrderDate, day AS ParsedOrderDate FROM typed", "typed"),
        "check_dates": check("date", "OrderDate"),
        "check_enums": check("enum", "Region", "Currency"),
        "check_ranges": check("range", "SaleAmount", "Discount"),
        "rejects": statement("SELECT * RENAME (ErrorTimestamp AS RejectionTimestamp) FROM rejected", "rejected"),
        "dedupe": statement(
            """
SELECT * REPLACE (CAST(SaleAmount AS DECIMAL(18,2)) AS SaleAmount, CAST(OrderDate AS DATE) AS OrderDate,
  CAST(Discount AS DECIMAL(3,2)) AS Discount) FROM deduped""",
            "deduped",
        ),
        "null_defaults": statement(
            """
SELECT OrderID, ProductID, amount AS SaleAmount, coalesce(nullif(CustomerID, ''), 'UNKNOWN') AS CustomerID,
  coalesce(reduction, 0) AS Discount, coalesce(Currency, 'USD') AS Currency FROM typed""",
            "typed",
        ),
        "clean_text": statement(
            "SELECT OrderID, ProductID, upper(Region[1]) || lower(Region[2:]) AS Region, CustomerID, Currency FROM raw", "raw"
        ),
        "product_lookup": statement(
            """
SELECT r.OrderID, r.ProductID, r.Region, p.ProductName, p.Category
FROM raw r LEFT JOIN products p ON r.ProductID = p.ProductID""",
            "raw",
            "products",
        ),
        "resolve_rates": statement("SELECT * FROM rates", "rates"),
        "convert_currency": statement(
            """
SELECT OrderID, ProductID, CAST(SaleAmount * ExchangeRate AS DECIMAL(28,8)) AS SaleAmount, 'USD' AS Currency,
  CAST(SaleAmount AS DECIMAL(18,2)) AS OriginalSaleAmount, Currency AS OriginalCurrency, ExchangeRate, RateSource
FROM (SELECT a.*, CAST(CASE WHEN Currency = 'USD' THEN 1 ELSE coalesce(rate, 1) END AS DECIMAL(10,6)) AS ExchangeRate,
        CASE WHEN Currency <> 'USD' THEN source END AS RateSource
      FROM accepted a LEFT JOIN rates ON Currency = from_currency AND to_currency = 'USD')""",
            "accepted",
            "rates",
        ),
        "convert_strict": statement(
            """
SELECT OrderID, ProductID, CAST(SaleAmount AS DECIMAL(28,8)) AS SaleAmount, Currency,
  CAST(SaleAmount * CASE WHEN Currency = 'GBP' THEN CAST(1 AS DECIMAL(10,6)) ELSE rate END AS DECIMAL(28,8)) AS ConvertedAmount
FROM accepted LEFT JOIN rates ON Currency = from_currency AND to_currency = 'GBP'""",
            "accepted",
            "rates",
        ),
        "finalize": statement(
            """
SELECT OrderID, ProductID, SaleAmount, OriginalSaleAmount, strftime(OrderDate, '%Y-%m-%d') AS OrderDate,
  strftime(ProcessingTimestamp, '%Y-%m-%d') AS ProcessingTimestamp FROM sales""",
            "sales",
        ),
        "check_category": statement(
            "SELECT *, Category IS NOT NULL AND Category IN ('ECONOMY', 'LARGE', 'PROMO') AS KnownCategory FROM products",
            "products",
        ),
        "rule_report": _rule_report(),
        "contract_violations": _contracts(),
        "data_profile": statement(
            lines("typed", PROFILE) + "\nUNION ALL " + lines("products", {"product_records": "count(*)"}), "typed", "products"
        ),
        "merged_profile": statement(
            lines("typed", PROFILE) + "\nUNION ALL " + lines("products", {"product_records": "count(*)"}), "typed", "products"
        ),
        "sales_batches": statement(
            """
SELECT CASE WHEN OrderDate < TIMESTAMP '1996-01-01 00:00:00' THEN 'early' ELSE 'late' END AS BatchID, count(*) AS Orders,
  CAST(sum(SaleAmount) AS DECIMAL(38,2)) AS TotalSales, CAST(date_trunc('month', min(OrderDate)) AS DATE) AS FirstMonth,
  CAST(date_trunc('month', max(OrderDate)) AS DATE) AS LastMonth
FROM sales GROUP BY 1""",
            "sales",
        ),
        "error_ids": statement(
            "SELECT count(*) AS Errors, CAST(1 AS BIGINT) AS FirstID, count(*) AS LastID, count(*) AS DistinctIDs FROM rejected", "rejected"
        ),
        "cached_rates": _cached_rates(),
        "distinct_currencies": statement("SELECT DISTINCT Currency FROM raw", "raw"),
        "clean_metrics": statement(
            "SELECT "
            + ", ".join(f"{measure} AS {name}" for name, measure in STAGE_COUNTS.items())
            + f", {DUPLICATES} AS duplicates_removed, {DISTINCT_KEYS} AS final_records, "
            + f"{percent('count(failed)', 'count(*)')} AS rejection_rate FROM tagged",
            "tagged",
        ),
        "rejection_rate": statement(
            f"""
SELECT count(*) AS TotalRecords, count(failed) AS RejectedRecords, {percent('count(failed)', 'count(*)')} AS RejectionRate,
  CAST(count(failed) AS DOUBLE) / count(*) * 100 <= 15.0 AS WithinLimit FROM tagged""",
            "tagged",
        ),
        "enrich_metrics": statement(
            lines("cleaned", {"initial_records": "count(*)"}) + "\nUNION ALL " + lines("converted", ENRICH_COUNTS),
            "cleaned",
            "converted",
        ),
        "sales_table": statement("SELECT * FROM sales", "sales"),
        "error_table": statement("SELECT * FROM rejected", "rejected"),
        "conversion_log": statement("SELECT * FROM logs", "logs"),
        "pipeline_metrics": _pipeline_metrics(),
        "loading_summary": statement(
            """
SELECT 'SalesData' AS TableName, count(*) AS RowCount FROM sales
UNION ALL SELECT 'ErrorLogging', count(*) FROM rejected
UNION ALL SELECT 'CurrencyConversionLog', count(*) FROM logs""",
            "sales",
            "rejected",
            "logs",
        ),
        "preview_top5": statement("SELECT * FROM sales ORDER BY OrderID, ProductID LIMIT 5", "sales"),
    }


def _reports() -> dict[str, str]:
    per_order = divided(CENTS, "CAST(sum(count(*)) OVER () AS HUGEINT)", 4, "DECIMAL(18,4)")
    share = divided(f"{CENTS} * 100", "CAST(sum(sum(SaleAmount)) OVER () * 100 AS HUGEINT)", 4, "DECIMAL(18,4)")
    error_rate = divided(
        "CAST((SELECT count(*) FROM rejected) AS HUGEINT) * 100", "CAST((SELECT count(*) FROM sales) AS HUGEINT)", 2, "DECIMAL(22,2)"
    )
    days = "CAST(min(OrderDate) AS DATE) AS {}, CAST(max(OrderDate) AS DATE) AS {}"
    known = "CustomerID IS NOT NULL AND CustomerID <> 'UNKNOWN'"
    bucket = """CASE WHEN Discount = 0 THEN 'No Discount' WHEN Discount <= 0.1 THEN 'Low Discount (0-10%)'
  WHEN Discount <= 0.2 THEN 'Medium Discount (10-20%)' ELSE 'High Discount (>20%)' END"""
    return {
        "q01_region_category": statement(
            f"""
SELECT Region, Category, count(*) AS TotalOrders, {TOTAL} AS TotalSales, {AVERAGE_AMOUNT} AS AverageOrderValue,
  {days.format('FirstOrderDate', 'LastOrderDate')}
FROM sales GROUP BY Region, Category ORDER BY TotalSales DESC, Region, Category""",
            "sales",
        ),
        "q02_monthly": statement(
            f"""
SELECT CAST(year(OrderDate) AS INTEGER) AS Year, CAST(month(OrderDate) AS INTEGER) AS Month, count(*) AS TotalOrders,
  {TOTAL} AS TotalSales, {AVERAGE_AMOUNT} AS AverageOrderValue
FROM sales GROUP BY 1, 2 ORDER BY 1, 2""",
            "sales",
        ),
        "q03_products": statement(
            f"""
SELECT ProductID, ProductName, Category, count(*) AS TotalOrders, {TOTAL} AS TotalSales, {AVERAGE_AMOUNT} AS AverageOrderValue
FROM sales WHERE ProductName IS NOT NULL GROUP BY ALL ORDER BY TotalSales DESC, ProductID""",
            "sales",
        ),
        "q04_currency": statement(
            f"""
SELECT OriginalCurrency, count(*) AS RecordsConverted, {average('ExchangeRate', 6, 'DECIMAL(14,10)')} AS AverageExchangeRate,
  min(ExchangeRate) AS MinExchangeRate, max(ExchangeRate) AS MaxExchangeRate,
  CAST(sum(OriginalSaleAmount) AS DECIMAL(38,2)) AS TotalOriginalAmount, {TOTAL} AS TotalConvertedAmount
FROM sales WHERE OriginalCurrency <> 'USD' GROUP BY OriginalCurrency ORDER BY RecordsConverted DESC""",
            "sales",
        ),
        "q05_errors": statement(
            """
SELECT ProcessingStage, ErrorType, count(*) AS ErrorCount, min(ErrorTimestamp) AS FirstError, max(ErrorTimestamp) AS LastError
FROM rejected GROUP BY ProcessingStage, ErrorType ORDER BY ErrorCount DESC""",
            "rejected",
        ),
        "q06_quality": statement(
            lines(
                "sales",
                {
                    "Total Records": "count(*)",
                    "Records with SaleAmount": "count(SaleAmount)",
                    "Records with Product Info": "count(ProductName)",
                    "Records with Customer Info": f"count(*) FILTER ({known})",
                },
            ),
            "sales",
        ),
        "q07_region_share": statement(
            f"""
SELECT Region, count(*) AS TotalOrders, {TOTAL} AS TotalSales, {AVERAGE_AMOUNT} AS AverageOrderValue,
  {per_order} AS SalesPercentage, {share} AS SalesShare
FROM sales GROUP BY Region ORDER BY TotalSales DESC""",
            "sales",
        ),
        "q08_discount": statement(
            f"""
SELECT {bucket} AS DiscountCategory, count(*) AS OrderCount, {TOTAL} AS TotalSales, {AVERAGE_AMOUNT} AS AverageOrderValue,
  {average('Discount', 2, 'DECIMAL(7,6)')} AS AverageDiscount
FROM sales WHERE Discount IS NOT NULL GROUP BY 1 ORDER BY TotalSales DESC""",
            "sales",
        ),
        "q09_customers": statement(
            f"""
SELECT CustomerID, count(*) AS OrderCount, {TOTAL} AS TotalSpent, {AVERAGE_AMOUNT} AS AverageOrderValue,
  {days.format('FirstOrder', 'LastOrder')}, CAST(date_diff('day', min(OrderDate), max(OrderDate)) AS INTEGER) AS CustomerLifetime
FROM sales WHERE {known} GROUP BY CustomerID HAVING count(*) > 1 ORDER BY TotalSpent DESC, CustomerID""",
            "sales",
        ),
        "q10_timeline": statement(
            """
SELECT CAST(ProcessingTimestamp AS DATE) AS ProcessingDate, count(*) AS RecordsProcessed,
  min(ProcessingTimestamp) AS FirstProcessed, max(ProcessingTimestamp) AS LastProcessed
FROM sales GROUP BY 1 ORDER BY 1 DESC""",
            "sales",
        ),
        "q11_conversions": statement(
            f"""
SELECT FromCurrency, ToCurrency, count(*) AS ConversionCount, {average('ExchangeRate', 6, 'DECIMAL(14,10)')} AS AverageRate,
  min(ConversionTimestamp) AS FirstConversion, max(ConversionTimestamp) AS LastConversion
FROM logs GROUP BY FromCurrency, ToCurrency ORDER BY ConversionCount DESC""",
            "logs",
        ),
        "q12_validation": statement(
            f"""
SELECT 'Total Records Processed' AS Metric, CAST((SELECT count(*) FROM sales) AS DECIMAL(22,2)) AS Value
UNION ALL SELECT 'Records with Errors', CAST((SELECT count(*) FROM rejected) AS DECIMAL(22,2))
UNION ALL SELECT 'Error Rate (%)', {error_rate}
UNION ALL SELECT 'Currency Conversions', CAST((SELECT count(*) FROM logs) AS DECIMAL(22,2))""",
            "sales",
            "rejected",
            "logs",
        ),
        "q13_recent": statement(
            f"""
SELECT 'Recent Sales' AS ActivityType, count(*) AS Count, {TOTAL} AS TotalValue
FROM sales WHERE OrderDate >= {ACTIVITY_AS_OF} - INTERVAL 7 DAY
UNION ALL SELECT 'Recent Errors', count(*), CAST(0 AS DECIMAL(38,2))
FROM rejected WHERE ErrorTimestamp >= {ACTIVITY_AS_OF} - INTERVAL 7 DAY
UNION ALL SELECT 'Recent Conversions', count(*), CAST(0 AS DECIMAL(38,2))
FROM logs WHERE ConversionTimestamp >= {ACTIVITY_AS_OF} - INTERVAL 7 DAY""",
            "sales",
            "rejected",
            "logs",
        ),
        "q14_category": statement(
            f"""
SELECT Category, count(*) AS TotalOrders, {TOTAL} AS TotalSales, {AVERAGE_AMOUNT} AS AverageOrderValue,
  count(DISTINCT CustomerID) AS UniqueCustomers, count(DISTINCT Region) AS RegionsServed
FROM sales WHERE Category IS NOT NULL GROUP BY Category ORDER BY TotalSales DESC""",
            "sales",
        ),
        "q15_completeness": statement(
            lines(
                "sales",
                {
                    "Complete Records": f"count(*) FILTER (SaleAmount IS NOT NULL AND ProductName IS NOT NULL AND {known})",
                    "Partial Records": "count(*) FILTER (SaleAmount IS NOT NULL AND "
                    "(ProductName IS NULL OR CustomerID IS NULL OR CustomerID = 'UNKNOWN'))",
                    "Incomplete Records": "count(*) FILTER (SaleAmount IS NULL)",
                },
                "Completeness",
                "RecordCount",
            ),
            "sales",
        ),
    }


def oracle_sql() -> dict[str, str]:
    return {**_operators(), **_reports()}
