"""For each query, the SQL DuckDB must give the same rows for.

Every statement reads the test tables alone and is written from the definition of
the operator, not from its Spark plan. Shared subqueries are spelled out as text.

The statements share the registries of metrics with the code, and the rules for means
(decimals of six places) and quantiles are the same on both sides, so a fault in those
would not show here. The golden values and brute-force comparisons of ``tests/`` hold them.
"""

from __future__ import annotations

from yearbook.operators.registry import FACT_METRICS, MONEY_METRICS, SCATTERS, STATS_METRICS


def r4(value: str) -> str:
    """Rounded to four decimals in scaled form, without negative zero."""
    return f"(round(({value}) * 10000.0, 0) / 10000.0 + 0.0)"


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


# Stand-ins -----------------------------------------------------------------------

LINES = """lines AS (
  SELECT *, CAST(l_extendedprice AS DECIMAL(12,2)) AS p, CAST(l_discount AS DECIMAL(4,2)) AS d,
         CAST(l_tax AS DECIMAL(4,2)) AS t, CAST(l_quantity AS DECIMAL(12,2)) AS q
  FROM lineitem)"""

SUMS = """CAST(sum(p) AS BIGINT) AS revenue,
  CAST(sum(p * (1 - d)) AS BIGINT) AS operating_income,
  CAST(sum(p * (1 - d - t)) AS BIGINT) AS net_income,
  CAST(sum(q) AS BIGINT) AS total_assets,
  CAST(sum(p * (d + t)) AS BIGINT) AS equity,
  CAST(sum(CASE WHEN l_returnflag <> 'R' THEN p END) AS BIGINT) AS operating_cash_flow,
  CAST(-sum(CASE WHEN l_returnflag = 'R' THEN p END) AS BIGINT) AS investing_cash_flow"""

ROE = "CASE WHEN equity <> 0 THEN " + r4("net_income::DOUBLE / equity::DOUBLE * 100") + " END AS roe_pct"

MONTH = "year(l_shipdate) * 100 + month(l_shipdate)"
YEAR = "year(l_shipdate)"


def supplier_periods(period: str = YEAR) -> str:
    return f"""{LINES},
sums AS (SELECT l_suppkey AS suppkey, CAST({period} AS BIGINT) AS fiscal_year, {SUMS} FROM lines GROUP BY 1, 2),
sp AS (SELECT *, {ROE} FROM sums)"""


DIM = """dim AS (
  SELECT s_suppkey AS suppkey, s_suppkey AS company_order, s_name AS ticker, n_name AS name, r_name AS currency
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

YOY = f"CASE WHEN prev1 <> 0 THEN {r4('(revenue::DOUBLE / prev1 - 1) * 100')} END AS revenue_yoy_pct"
MARGIN = (
    f"CASE WHEN revenue <> 0 THEN {r4('operating_income::DOUBLE / revenue * 100')} END AS operating_margin_pct"
)
FCF = "operating_cash_flow + investing_cash_flow AS free_cash_flow"
CAGR = (
    "CASE WHEN prev3 > 0 AND revenue >= 0 THEN "
    + r4("(power(revenue::DOUBLE / prev3, 1.0::DOUBLE / 3) - 1) * 100")
    + " END AS revenue_cagr_3y_pct"
)


def supplier_mart(period: str = YEAR) -> str:
    return f"""{supplier_periods(period)},
{DIM},
steps AS (
  SELECT d.company_order, d.ticker, d.name, d.currency, sp.* EXCLUDE (suppkey),
         lag(revenue, 1) OVER series AS prev1, lag(revenue, 3) OVER series AS prev3
  FROM sp JOIN dim d USING (suppkey)
  WINDOW series AS (PARTITION BY d.ticker ORDER BY fiscal_year)),
mart AS (SELECT * EXCLUDE (prev1, prev3), {YOY}, {MARGIN}, {FCF}, {CAGR} FROM steps)"""


SNAPSHOTS = """snaps AS (
  SELECT 'C' || o_custkey AS ticker, o_orderdate AS fetched, sha256(CAST(o_orderkey AS VARCHAR)) AS sha,
         o_orderkey AS orderkey, o_custkey AS custkey, o_orderpriority AS priority, o_orderstatus AS status
  FROM orders),
newest AS (
  SELECT * FROM snaps QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY fetched DESC, sha DESC) = 1)"""

STAMP = "strftime({}, '%Y-%m-%d %H:%M:%S')"
DAY = "strftime({}, '%Y-%m-%d')"

ORDER_LINES = f"""{LINES},
osums AS (
  SELECT l_orderkey AS orderkey, CAST(l_linenumber AS BIGINT) AS fiscal_year,
         min(l_shipdate) AS shipped, min(l_partkey) AS part, {SUMS}
  FROM lines GROUP BY 1, 2),
olines AS (SELECT *, {ROE} FROM osums)"""

HISTORY = f"""{SNAPSHOTS},
{ORDER_LINES},
wide AS (SELECT * FROM olines JOIN snaps USING (orderkey)),
chosen AS (SELECT * FROM wide QUALIFY rank() OVER (PARTITION BY ticker ORDER BY fetched DESC, sha DESC) = 1)"""

CUSTOMERS = """companies AS (
  SELECT CAST(c_custkey AS BIGINT) AS company_order, 'C' || c_custkey AS ticker, c_name AS name,
         'E' || lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS edinet_code, c_mktsegment AS currency
  FROM customer)"""

KNOWN_CUSTOMERS = CUSTOMERS.replace("FROM customer)", "FROM customer WHERE c_acctbal >= 0)")

CUSTOMER_YEARS = """cy AS (
  SELECT o_custkey AS custkey, year(o_orderdate) AS fiscal_year,
         CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS BIGINT) AS revenue
  FROM orders GROUP BY 1, 2)"""

CUSTOMER_LAGS = f"""{CUSTOMER_YEARS},
lagged AS (
  SELECT *, lag(revenue, 1) OVER s AS prev1, lag(revenue, 3) OVER s AS prev3
  FROM cy WINDOW s AS (PARTITION BY custkey ORDER BY fiscal_year))"""

PAIRS = """pairs AS (
  SELECT a.s_suppkey AS pair_order, 'pair-' || a.s_suppkey AS id, a.s_name AS "left", b.s_name AS "right"
  FROM supplier a JOIN supplier b ON b.s_suppkey = a.s_suppkey + 1)"""


def _facts(source: str, ids: str) -> str:
    """Long facts as a union over the metrics; nulls stay."""
    rows = [
        f"SELECT {ids}, '{m}' AS metric_name, {m}::DOUBLE AS value, "
        f"'{'JPY' if m in MONEY_METRICS else 'PERCENTAGE_POINT'}' AS unit FROM {source}"
        for m in FACT_METRICS
    ]
    return "\nUNION ALL\n".join(rows)


def _shown(metric) -> str:
    scale = " / 1000000.0::DOUBLE" if metric.kind == "money" else ""
    return f"{metric.column}::DOUBLE{scale}"


def _long(ids: str, source: str = "mart") -> str:
    """The statistics metrics as rows, money in millions."""
    return "\nUNION ALL\n".join(
        f"SELECT {ids}, '{m.id}' AS metric, {_shown(m)} AS value FROM {source}" for m in STATS_METRICS
    )


def _cells(kinds: dict[str, str], ids: str, source: str, order: str) -> str:
    rows = []
    for place, (metric, kind) in enumerate(kinds.items()):
        scale = " / 1000000.0::DOUBLE" if kind == "money" else ""
        rows.append(
            f"SELECT {ids}, {place}::BIGINT AS {order}, '{metric}' AS metric, {metric}::DOUBLE{scale} AS value FROM {source}"
        )
    return "\nUNION ALL\n".join(rows)


def _quantile(share: float) -> str:
    """Linear between the neighbours, from the nearer end, out of a sorted list."""
    place = f"({share}::DOUBLE * (len(l) - 1))"
    low, high = f"l[CAST(floor({place}) AS BIGINT) + 1]", f"l[CAST(ceil({place}) AS BIGINT) + 1]"
    part = f"({place} - floor({place}))"
    return r4(
        f"CASE WHEN {part} < 0.5 THEN {low} + ({high} - {low}) * {part} "
        f"ELSE {high} - ({high} - {low}) * (1 - {part}) END"
    )


def _describe(group: str, source: str) -> str:
    mean = "CAST(sum(CAST(value AS DECIMAL(28,6))) AS DOUBLE) / count(value)"
    return f"""SELECT {group}, "count", missing, mean, {_quantile(0.5)} AS median, stddev, "min",
  {_quantile(0.25)} AS q1, {_quantile(0.75)} AS q3, "max"
FROM (
  SELECT {group}, count(value) AS "count", count(*) - count(value) AS missing,
    CASE WHEN count(value) > 0 THEN {r4(mean)} END AS mean, {r4('stddev_samp(value)')} AS stddev,
    {r4('min(value)')} AS "min", {r4('max(value)')} AS "max",
    list(value ORDER BY value) FILTER (WHERE value IS NOT NULL) AS l
  FROM {source} GROUP BY {group})"""


def _ranked(source: str) -> str:
    return f"""SELECT fiscal_year, metric, ticker, name, {r4('value')} AS value,
  CASE WHEN value IS NOT NULL THEN
    rank() OVER (PARTITION BY fiscal_year, metric ORDER BY value DESC NULLS LAST) END AS rank
FROM {source}"""


COMMON_YEARS = """mart.fiscal_year IN (
  SELECT fiscal_year FROM mart GROUP BY 1
  HAVING count(DISTINCT ticker) = (SELECT count(DISTINCT ticker) FROM mart))"""


def _points() -> str:
    by_id = {m.id: m for m in STATS_METRICS}
    rows = [
        f"SELECT fiscal_year, ticker, name, '{s.id}' AS scatter, {r4(_shown(by_id[s.x]))} AS x, "
        f"{r4(_shown(by_id[s.y]))} AS y, '{s.x_scale}' AS scale FROM mart"
        for s in SCATTERS
    ]
    return (
        "drawn AS (\n" + "\nUNION ALL\n".join(rows) + "),\n"
        "points AS (SELECT *, CASE WHEN x IS NULL AND y IS NULL THEN 'missing_x_and_y' "
        "WHEN x IS NULL THEN 'missing_x' WHEN y IS NULL THEN 'missing_y' "
        "WHEN scale = 'log' AND x <= 0 THEN 'non_positive_x_for_log' END AS reason FROM drawn)"
    )


def _compared(metrics: list[str]) -> str:
    sides = ", ".join(f"{s}.{m} AS {n}_{m}" for s, n in (("a", "left"), ("b", "right")) for m in metrics)
    return f"""compared AS (
  SELECT p.id, p."left", p."right", a.fiscal_year, {sides}
  FROM pairs p JOIN mart a ON a.ticker = p."left"
  JOIN mart b ON b.ticker = p."right" AND b.fiscal_year = a.fiscal_year)"""


def _sided(kinds: dict[str, str], order: bool) -> str:
    rows = []
    for place, (metric, kind) in enumerate(kinds.items()):
        scale = " / 1000000.0::DOUBLE" if kind == "money" else ""
        number = f"{place}::BIGINT AS metric_order, " if order else ""
        rows.append(
            f'SELECT id, "left", "right", fiscal_year, {number}\'{metric}\' AS metric, '
            f"left_{metric}::DOUBLE{scale} AS left_value, right_{metric}::DOUBLE{scale} AS right_value FROM compared"
        )
    return "\nUNION ALL\n".join(rows)


CHARTS = {
    "profitability": ("money", (("revenue", "Revenue"), ("operating_income", "Op. income"))),
    "returns": ("percent", (("operating_margin_pct", "Op. margin"), ("roe_pct", "ROE"))),
    "cashflow": ("money", (("operating_cash_flow", "Operating CF"), ("free_cash_flow", "FCF"))),
}
PAIR_CHARTS = {"revenue": "money", "operating_margin_pct": "percent", "free_cash_flow": "money"}
PAIR_ROWS = {
    "revenue": "money",
    "operating_income": "money",
    "net_income": "money",
    "operating_margin_pct": "percent",
    "roe_pct": "percent",
    "free_cash_flow": "money",
}
CARDS = {
    "revenue": "money",
    "operating_income": "money",
    "net_income": "money",
    "operating_margin_pct": "percent",
    "roe_pct": "percent",
    "operating_cash_flow": "money",
    "free_cash_flow": "money",
}
COMPARE_CARDS = {
    "revenue": "money",
    "operating_income": "money",
    "operating_margin_pct": "percent",
    "roe_pct": "percent",
}


def _series() -> str:
    rows = []
    for chart, (kind, lines) in CHARTS.items():
        scale = " / 1000000.0::DOUBLE" if kind == "money" else ""
        for column, label in lines:
            rows.append(
                f"SELECT ticker, fiscal_year, '{chart}' AS chart, '{kind}' AS kind, '{column}' AS series, "
                f"'{label}' AS label, {column}::DOUBLE{scale} AS value FROM mart"
            )
    return "series AS (\n" + "\nUNION ALL\n".join(rows) + ")"


AXIS = """bounds AS (
  SELECT ticker, chart, min(value) AS lo, max(value) AS hi FROM series GROUP BY 1, 2),
zeroed AS (
  SELECT *, CASE WHEN lo IS NULL THEN NULL WHEN lo = 0 AND hi = 0 THEN -1.0::DOUBLE ELSE least(0.0::DOUBLE, lo) END AS bottom,
            CASE WHEN lo IS NULL THEN NULL WHEN lo = 0 AND hi = 0 THEN 1.0::DOUBLE ELSE greatest(0.0::DOUBLE, hi) END AS top
  FROM bounds),
axes AS (
  SELECT ticker, chart, lo IS NOT NULL AS has_data,
         CASE WHEN lo < 0 THEN bottom - (top - bottom) * 0.08::DOUBLE ELSE bottom END AS axis_min,
         top + (top - bottom) * 0.08::DOUBLE AS axis_max
  FROM zeroed)"""

NEWEST_MART = "fresh AS (SELECT * FROM mart QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY fiscal_year DESC) = 1)"

# Raw documents: the numbers written into the JSON text, as rows.
RAW = """raw AS (
  SELECT o.*, CAST(CAST(o_totalprice AS DECIMAL(12,2)) * 100 AS BIGINT) AS cents, i
  FROM orders o, range(0, 5) AS steps(i)),
rawrows AS (
  SELECT 'order/' || o_orderkey AS raw_file, 'C' || o_custkey AS ticker, o_orderkey, o_custkey, o_orderdate, i,
         sha256(CAST(o_orderkey AS VARCHAR)) AS sha, o_orderstatus, o_orderpriority,
         CAST(year(o_orderdate) - i AS BIGINT) AS fiscal_year,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'JGAAP' WHEN '2-HIGH' THEN 'USGAAP' ELSE 'UNKNOWN' END AS accounting_standard,
         cents * (10 - i) AS revenue,
         CASE WHEN i = 2 THEN 0 ELSE cents * 2 - i * 100 END AS operating_income,
         cents AS net_income, CAST(NULL AS BIGINT) AS total_assets, cents * 4 AS equity,
         cents + i AS operating_cash_flow, CASE WHEN i < 4 THEN -cents END AS investing_cash_flow,
         (o_orderkey % 1000) / 10.0::DOUBLE AS roe_pct,
         'S' || o_orderkey AS document_id,
         CASE WHEN i <> 1 THEN strftime(o_orderdate, '%Y-%m-%d') END AS filed_at
  FROM raw),
good AS (SELECT * FROM rawrows WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW')"""

NAMES = ", ".join(FACT_METRICS)

MART_COLUMNS = f"""c.company_order, m.ticker, c.name, c.edinet_code, c.currency, m.fiscal_year,
  CAST(NULL AS VARCHAR) AS fiscal_year_end, m.accounting_standard, m.consolidated,
  {", ".join("m." + f for f in FACT_METRICS)}"""

ORDER_MART = f"""{HISTORY},
{CUSTOMERS},
stepped AS (
  SELECT *, lag(revenue, 1) OVER s AS prev1, lag(revenue, 3) OVER s AS prev3
  FROM chosen WINDOW s AS (PARTITION BY ticker ORDER BY fiscal_year)),
derived AS (SELECT *, {YOY}, {MARGIN}, {FCF}, {CAGR} FROM stepped),
omart AS (
  SELECT c.company_order, d.ticker, c.name, c.edinet_code, c.currency, d.fiscal_year,
    CAST(NULL AS VARCHAR) AS fiscal_year_end, d.priority AS accounting_standard, d.status <> 'P' AS consolidated,
    {", ".join("d." + f for f in FACT_METRICS)},
    d.revenue_yoy_pct, d.operating_margin_pct, d.free_cash_flow, d.revenue_cagr_3y_pct,
    'D' || d.orderkey AS source_document_id, 'annual_securities_report' AS source_document_type,
    {DAY.format("d.shipped")} AS source_filed_at, 'part/' || d.part AS source_url,
    {STAMP.format("d.fetched")} AS fetched_at, d.sha AS snapshot_sha256
  FROM derived d JOIN companies c USING (ticker))"""

SOURCE_ROWS = f"""sources AS (
  SELECT custkey AS company_order, ticker, fiscal_year, 'D' || orderkey AS document_id,
    'annual_securities_report' AS document_type, {DAY.format("shipped")} AS filed_at, 'part/' || part AS url,
    {STAMP.format("fetched")} AS raw_fetched_at, sha AS raw_sha256, 'order/' || orderkey AS raw_file, orderkey
  FROM wide)"""

SOURCE_GAPS = SOURCE_ROWS.replace("FROM wide)", "FROM wide WHERE fiscal_year % 2 = 0)")

COPIES = """copies AS (
  SELECT l_orderkey AS orderkey, l_linenumber AS linenumber, sha256(l_returnflag || l_linestatus) AS digest,
    lpad(CAST(l_partkey AS VARCHAR), 12, '0') || '/' || lpad(CAST(l_suppkey AS VARCHAR), 12, '0') AS raw_file
  FROM lineitem)"""

HISTORY_IDS = f"""custkey AS company_order, ticker, fiscal_year, priority AS accounting_standard,
  status <> 'P' AS consolidated, 'D' || orderkey AS document_id, {STAMP.format("fetched")} AS raw_fetched_at,
  sha AS raw_sha256, 'order/' || orderkey AS raw_file"""


def _grouped(number: str, decimals: int) -> str:
    """Digits in groups of three; at most two decimals without trailing zeros."""
    if not decimals:
        return f"format('{{:,}}', CAST({number} AS BIGINT))"
    cents = f"CAST(round({number} * 100, 0) AS BIGINT)"
    return (
        f"format('{{:,}}', {cents} // 100) || CASE WHEN {cents} % 100 = 0 THEN '' "
        f"ELSE '.' || rtrim(lpad(CAST({cents} % 100 AS VARCHAR), 2, '0'), '0') END"
    )


def _compact(value: str) -> str:
    return (
        f"CASE WHEN abs({value}) >= 1000000 THEN format('{{:.1f}}T', {value} / 1000000.0::DOUBLE) "
        f"WHEN abs({value}) >= 1000 THEN format('{{:.1f}}B', {value} / 1000.0::DOUBLE) "
        f"ELSE format('{{:,}}', CAST(round_even({value}, 0) AS BIGINT)) END"
    )


ORACLE_SQL: dict[str, str] = {
    # Marts
    "mart_supplier_year": _with(supplier_mart()) + "SELECT * FROM mart",
    "mart_supplier_month": _with(supplier_mart(MONTH)) + "SELECT * FROM mart",
    "company_year_mart": _with(ORDER_MART) + "SELECT * FROM omart",
    "order_mart": _with(supplier_mart()) + "SELECT company_order, fiscal_year, revenue FROM mart",
    # Reshaping
    "pivot_metrics": _with(supplier_periods()) + f"SELECT suppkey, fiscal_year, {NAMES} FROM sp",
    "unpivot_facts": _with(supplier_periods()) + _facts("sp", "suppkey, fiscal_year"),
    "long_metrics": _with(supplier_mart()) + _long("ticker, fiscal_year"),
    "build_sources": _with(HISTORY, SOURCE_ROWS) + "SELECT * EXCLUDE (orderkey) FROM sources",
    "financial_history": _with(HISTORY) + _facts("wide", HISTORY_IDS),
    "filter_period": _with(supplier_periods()) + "SELECT * FROM sp WHERE fiscal_year = 1997",
    "filter_entity": _with(supplier_periods()) + "SELECT * FROM sp WHERE suppkey = 7",
    "scale_metric": """SELECT o_orderkey,
  CASE WHEN o_orderstatus = 'F' THEN c::DOUBLE / 1000000.0::DOUBLE ELSE c::DOUBLE END AS shown
FROM (SELECT *, CAST(CAST(o_totalprice AS DECIMAL(12,2)) * 100 AS BIGINT) AS c FROM orders)""",
    # Series
    "lag_metric": _with(supplier_periods())
    + """SELECT suppkey, fiscal_year, revenue, lag(revenue, 1) OVER s AS previous_revenue,
  lag(revenue, 3) OVER s AS starting_revenue
FROM sp WINDOW s AS (PARTITION BY suppkey ORDER BY fiscal_year)""",
    "lag_with_gaps": _with(CUSTOMER_LAGS)
    + "SELECT custkey, fiscal_year, revenue, prev1 AS previous, prev3 AS start FROM lagged",
    "lag_by_value": _with(CUSTOMER_YEARS)
    + """SELECT c.custkey, c.fiscal_year, c.revenue, a.revenue AS previous, b.revenue AS start
FROM cy c LEFT JOIN cy a ON a.custkey = c.custkey AND a.fiscal_year = c.fiscal_year - 1
LEFT JOIN cy b ON b.custkey = c.custkey AND b.fiscal_year = c.fiscal_year - 3""",
    "revenue_yoy": _with(CUSTOMER_LAGS) + f"SELECT custkey, fiscal_year, {YOY} FROM lagged",
    "revenue_cagr": _with(CUSTOMER_LAGS) + f"SELECT custkey, fiscal_year, {CAGR} FROM lagged",
    "operating_margin": _with(supplier_periods(MONTH)) + f"SELECT suppkey, fiscal_year, {MARGIN} FROM sp",
    "free_cash_flow": _with(supplier_periods(MONTH)) + f"SELECT suppkey, fiscal_year, {FCF} FROM sp",
    "latest_period": _with(CUSTOMER_YEARS)
    + "SELECT * FROM cy QUALIFY row_number() OVER (PARTITION BY custkey ORDER BY fiscal_year DESC) = 1",
    "segment_series": _with(
        supplier_periods(MONTH),
        """marked AS (
  SELECT suppkey, fiscal_year, investing_cash_flow,
         row_number() OVER (PARTITION BY suppkey ORDER BY fiscal_year)
         - row_number() OVER (PARTITION BY suppkey, investing_cash_flow IS NULL ORDER BY fiscal_year) AS run
  FROM sp),
runs AS (
  SELECT suppkey, min(fiscal_year) AS first_period, max(fiscal_year) AS last_period, count(*) AS points
  FROM marked WHERE investing_cash_flow IS NOT NULL GROUP BY suppkey, run HAVING count(*) >= 2)""",
    )
    + "SELECT *, row_number() OVER (PARTITION BY suppkey ORDER BY first_period) AS segment FROM runs",
    "series_position": _with(
        CUSTOMER_YEARS,
        """placed AS (
  SELECT custkey, fiscal_year, row_number() OVER (PARTITION BY custkey ORDER BY fiscal_year) - 1 AS position,
         count(*) OVER (PARTITION BY custkey) AS points FROM cy)""",
    )
    + "SELECT *, CASE WHEN points = 1 THEN 0.5::DOUBLE ELSE position::DOUBLE / (points - 1) END AS x_share FROM placed",
    # Snapshots and joins
    "distinct_snapshots": _with(HISTORY)
    + f"SELECT DISTINCT ticker, {STAMP.format('fetched')} AS raw_fetched_at, sha AS raw_sha256 FROM wide",
    "latest_snapshot": _with(SNAPSHOTS)
    + f"SELECT ticker, {STAMP.format('fetched')} AS raw_fetched_at, sha AS raw_sha256 FROM newest",
    "join_latest_facts": _with(
        HISTORY,
        "facts AS (" + _facts("chosen", "ticker, fiscal_year, 'D' || orderkey AS document_id") + ")",
    )
    + "SELECT ticker, fiscal_year, metric_name, value, document_id FROM facts",
    "join_latest_sources": _with(HISTORY, SOURCE_ROWS)
    + "SELECT s.ticker, s.fiscal_year, s.document_id, s.filed_at FROM sources s JOIN newest n USING (orderkey)",
    "join_dimension": _with(CUSTOMER_YEARS, KNOWN_CUSTOMERS)
    + """SELECT c.ticker, cy.custkey, cy.fiscal_year, cy.revenue, c.name, c.currency
FROM cy JOIN companies c ON c.ticker = 'C' || cy.custkey""",
    "join_sources_left": _with(HISTORY, SOURCE_GAPS)
    + f"""SELECT w.ticker, w.fiscal_year, {STAMP.format("w.fetched")} AS fetched_at, w.sha AS snapshot_sha256, w.revenue,
  s.document_id AS source_document_id, s.document_type AS source_document_type,
  s.filed_at AS source_filed_at, s.url AS source_url
FROM wide w JOIN newest n USING (orderkey)
LEFT JOIN sources s ON s.orderkey = w.orderkey AND s.fiscal_year = w.fiscal_year""",
    "dedupe_snapshots": _with(COPIES)
    + "SELECT orderkey, CAST(linenumber AS BIGINT) AS linenumber, digest, min(raw_file) AS raw_file FROM copies GROUP BY 1, 2, 3",
    "snapshot_conflicts": _with(COPIES)
    + """SELECT orderkey, CAST(linenumber AS BIGINT) AS linenumber, count(*) AS snapshots,
  min(digest) AS lowest_hash, max(digest) AS highest_hash
FROM copies GROUP BY 1, 2 HAVING count(DISTINCT digest) > 1""",
    "semi_known_entity": """SELECT o_custkey AS custkey, o_orderkey FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
    "anti_missing_entity": """SELECT c_custkey AS custkey, c_name FROM customer
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND year(o_orderdate) = 1996)""",
    "except_entities": """SELECT c_custkey AS custkey FROM customer
EXCEPT SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1998""",
    "flag_available": """SELECT c_custkey AS custkey, c_name,
  EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND year(o_orderdate) = 2001) AS has_financials
FROM customer""",
    "company_listing": """SELECT c_custkey AS custkey, c_name, c_acctbal,
  EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND year(o_orderdate) = 2001) AS has_financials,
  EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND year(o_orderdate) = 2000) AS has_raw,
  CASE WHEN c_acctbal >= 0 THEN 'direct' ELSE 'indirect' END AS status
FROM customer""",
    "company_totals": """SELECT CAST(sum(CASE WHEN c_mktsegment <> 'BUILDING' THEN 2 ELSE 1 END) AS BIGINT) AS target_count,
  count(*) FILTER (WHERE c_acctbal >= 0) AS direct_count,
  count(*) FILTER (WHERE c_acctbal < 0) AS indirect_count FROM customer""",
    "agg_bool_and": f"""SELECT l_suppkey, year(l_shipdate) AS fiscal_year, bool_and(l_linestatus = 'F') AS all_closed,
  max(l_returnflag) AS max_flag, {STAMP.format("max(l_shipdate)")} AS generated_at
FROM lineitem GROUP BY 1, 2""",
    # Statistics
    "common_periods": _with(supplier_periods(MONTH))
    + """SELECT fiscal_year, count(DISTINCT suppkey) AS entities FROM sp GROUP BY 1
HAVING count(DISTINCT suppkey) = (SELECT count(DISTINCT suppkey) FROM sp)""",
    "count_distinct_entities": """SELECT year(l_shipdate) AS fiscal_year, count(DISTINCT l_suppkey) AS entities
FROM lineitem GROUP BY 1""",
    "join_scalar": _with(supplier_periods(MONTH))
    + """SELECT fiscal_year, count(DISTINCT suppkey) AS entities,
  (SELECT count(DISTINCT suppkey) FROM sp) AS everyone FROM sp GROUP BY 1""",
    "default_selection": _with(supplier_periods(MONTH))
    + """SELECT max(fiscal_year) AS fiscal_year FROM (
  SELECT fiscal_year FROM sp GROUP BY 1
  HAVING count(DISTINCT suppkey) = (SELECT count(DISTINCT suppkey) FROM sp))""",
    "describe_metrics": _with(supplier_mart(MONTH), "long AS (" + _long("fiscal_year") + ")")
    + _describe("fiscal_year, metric", "long"),
    "describe_common_years": _with(
        supplier_mart(), f"shared AS (SELECT * FROM mart WHERE {COMMON_YEARS})", "long AS (" + _long("fiscal_year", "shared") + ")"
    )
    + _describe("fiscal_year, metric", "long"),
    "describe_order_prices": "WITH prices AS (SELECT o_orderstatus, o_totalprice AS value FROM orders)\n"
    + _describe("o_orderstatus", "prices"),
    "rank_metric": _with(supplier_mart(MONTH), "long AS (" + _long("fiscal_year, ticker, name") + ")") + _ranked("long"),
    "rank_order_lines": """SELECT l_returnflag, l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity AS value,
  rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity DESC) AS rank FROM lineitem""",
    "order_ranking": _with(
        supplier_mart(),
        f"shared AS (SELECT * FROM mart WHERE {COMMON_YEARS})",
        "long AS (" + _long("fiscal_year, ticker, name", "shared") + ")",
    )
    + _ranked("long"),
    "value_positions": """SELECT l_linestatus, value, ties,
  CAST(coalesce(sum(ties) OVER (PARTITION BY l_linestatus ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS less,
  CAST(sum(ties) OVER (PARTITION BY l_linestatus) AS BIGINT) AS total
FROM (SELECT l_linestatus, l_extendedprice AS value, count(*) AS ties FROM lineitem GROUP BY 1, 2)""",
    "scatter_pairs": _with(supplier_mart(MONTH), _points())
    + "SELECT fiscal_year, ticker, name, scatter, x, y FROM points WHERE reason IS NULL",
    "scatter_exclusions": _with(supplier_mart(MONTH), _points())
    + "SELECT fiscal_year, ticker, name, scatter, reason FROM points WHERE reason IS NOT NULL",
    "scatter_counts": _with(supplier_mart(MONTH), _points())
    + """SELECT fiscal_year, scatter, count(*) FILTER (WHERE reason IS NULL) AS included_count,
  count(*) FILTER (WHERE reason IS NOT NULL) AS excluded_count FROM points GROUP BY 1, 2""",
    "metric_metadata_join": _with(
        supplier_mart(),
        "long AS (" + _long("fiscal_year") + ")",
        "registry(metric_order, metric, label, english_label, unit, kind) AS (VALUES "
        + ", ".join(
            f"({i}::BIGINT, '{m.id}', '{m.label}', '{m.english_label}', '{m.unit}', '{m.kind}')"
            for i, m in enumerate(STATS_METRICS)
        )
        + ")",
        'counted AS (SELECT metric, count(value) AS "values" FROM long GROUP BY 1)',
    )
    + "SELECT * FROM counted JOIN registry USING (metric)",
    # Comparison and charts
    "compare_entities": _with(supplier_mart(), PAIRS, _compared(list(PAIR_CHARTS))) + "SELECT * FROM compared",
    "comparison_series": _with(supplier_mart(), PAIRS, _compared(list(PAIR_CHARTS))) + _sided(PAIR_CHARTS, True),
    "comparison_table": _with(supplier_mart(), PAIRS, _compared(list(PAIR_ROWS))) + _sided(PAIR_ROWS, False),
    "intersect_periods": _with(CUSTOMER_YEARS)
    + "SELECT fiscal_year FROM cy WHERE custkey = 11 INTERSECT SELECT fiscal_year FROM cy WHERE custkey = 25",
    "pair_periods": _with(supplier_mart(MONTH), PAIRS, _compared([]).replace(", \n", "\n"))
    + """SELECT p.id, p.pair_order, p."left", p."right", count(c.id) AS periods
FROM pairs p LEFT JOIN compared c USING (id) GROUP BY 1, 2, 3, 4""",
    "check_comparisons": _with(
        CUSTOMER_YEARS,
        """pairs AS (
  SELECT c_custkey AS pair_order, (CASE WHEN c_nationkey = 3 THEN 'Bad ' ELSE 'p-' END) || (c_custkey // 2) AS id,
         CASE WHEN c_nationkey <> 4 THEN c_custkey END AS l,
         CASE WHEN c_nationkey = 5 THEN c_custkey WHEN c_nationkey = 6 THEN -c_custkey ELSE c_custkey + 1 END AS r
  FROM customer),
judged AS (
  SELECT p.*, count(*) OVER (PARTITION BY id) AS uses,
         l IN (SELECT custkey FROM cy) AND r IN (SELECT custkey FROM cy) AS known,
         EXISTS (SELECT 1 FROM cy a JOIN cy b USING (fiscal_year) WHERE a.custkey = p.l AND b.custkey = p.r) AS shared
  FROM pairs p),
found AS (
  SELECT *, 'id_pattern' AS rule FROM judged WHERE id LIKE 'Bad%'
  UNION ALL SELECT *, 'id_repeated' FROM judged WHERE uses > 1
  UNION ALL SELECT *, 'sides' FROM judged WHERE l IS NULL
  UNION ALL SELECT *, 'same_entity' FROM judged WHERE l = r
  UNION ALL SELECT *, 'unknown_entity' FROM judged WHERE l <> r AND NOT known
  UNION ALL SELECT *, 'no_common_period' FROM judged WHERE l <> r AND known AND NOT shared)""",
    )
    + 'SELECT id, CAST(l AS VARCHAR) AS "left", CAST(r AS VARCHAR) AS "right", rule FROM found',
    "compare_defaults": """WITH requests AS (
  SELECT DISTINCT l_suppkey, l_linenumber,
    CASE WHEN l_linenumber > 1 THEN l_suppkey * (l_linenumber - 2) END AS l, l_linenumber * l_linenumber - 4 AS r
  FROM lineitem),
lefts AS (
  SELECT *, CASE WHEN l IN (SELECT s_suppkey FROM supplier) THEN l ELSE 0 END AS lk FROM requests),
rights AS (
  SELECT *, CASE WHEN r IN (SELECT s_suppkey FROM supplier) AND r <> lk THEN r WHEN lk <> 0 THEN 0 ELSE 1 END AS rk FROM lefts)
SELECT l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, a.s_name AS "left", b.s_name AS "right"
FROM rights JOIN supplier a ON a.s_suppkey = lk JOIN supplier b ON b.s_suppkey = rk""",
    "first_entity": "SELECT arg_max(c_name, c_acctbal) AS ticker FROM customer",
    "lookup_manifest_pair": _with(PAIRS)
    + 'SELECT id, "left", "right", pair_order AS request FROM pairs WHERE pair_order % 3 <> 0',
    "chart_series": _with(supplier_mart(), _series()) + "SELECT * FROM series",
    "axis_domain": _with(supplier_mart(MONTH), _series(), AXIS)
    + f"SELECT ticker, chart, has_data, {r4('axis_min')} AS axis_min, {r4('axis_max')} AS axis_max FROM axes",
    "axis_ticks": _with(supplier_mart(MONTH), _series(), AXIS)
    + f"""SELECT ticker, chart, tick, {r4('axis_min + (axis_max - axis_min) * tick / 4.0::DOUBLE')} AS tick_value
FROM axes, range(0, 5) AS steps(tick) WHERE has_data""",
    "latest_cards": _with(supplier_mart(), NEWEST_MART) + _cells(CARDS, "ticker, fiscal_year", "fresh", "card_order"),
    "latest_compare_cards": _with(supplier_mart(MONTH), NEWEST_MART)
    + _cells(COMPARE_CARDS, "ticker, fiscal_year", "fresh", "card_order"),
    "company_chart_manifest": "SELECT s_name AS ticker, "
    + ", ".join(f"'/charts/companies/' || replace(lower(s_name), '#', '_') || '/{c}.svg' AS {c}" for c in CHARTS)
    + " FROM supplier",
    "comparison_chart_manifest": _with(PAIRS)
    + 'SELECT id, "left", "right", '
    + ", ".join(f"'/charts/comparisons/' || id || '/{c}.svg' AS {c}" for c in PAIR_CHARTS)
    + " FROM pairs",
    # Raw JSON
    "json_tokens": """SELECT event_id, 'BIGINT' AS token, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
  true AS is_money, false AS is_text, json_extract(props, '$.absent') IS NULL AS absent FROM events""",
    "check_money_json": """SELECT CAST(l_linenumber AS BIGINT) AS l_linenumber, l_returnflag,
  count(*) FILTER (WHERE l_linenumber IN (2, 5) OR (l_linenumber = 4 AND l_quantity = floor(l_quantity))) AS money,
  count(*) FILTER (WHERE l_linenumber NOT IN (1, 3)) AS ratio,
  count(*) FILTER (WHERE l_linenumber IN (1, 2)) AS optional_text,
  count(*) FILTER (WHERE l_linenumber = 5) AS integers,
  CAST(sum(CASE WHEN l_linenumber = 4 THEN CAST(l_quantity AS DECIMAL(12,2))
                WHEN l_linenumber = 5 THEN CAST(floor(l_extendedprice) AS DECIMAL(12,2))
                WHEN l_linenumber > 5 THEN CAST(floor(l_extendedprice) AS DECIMAL(12,2)) + 0.25 END) AS DOUBLE) AS total
FROM lineitem GROUP BY 1, 2""",
    "decode_snapshots": """SELECT 'order/' || o_orderkey AS raw_file, i AS position, year(o_orderdate) - i AS fiscal_year
FROM orders, range(0, 5) AS steps(i)""",
    "check_snapshots": """SELECT 'order/' || o_orderkey AS raw_file, 'C' || o_custkey AS ticker,
  CAST(NULL AS BIGINT) AS fiscal_year, 'meta.edinet_code' AS field, 'code_match' AS rule, '"E0"' AS value
FROM orders WHERE o_orderpriority = '5-LOW'
UNION ALL
SELECT 'order/' || o_orderkey, 'C' || o_custkey, year(o_orderdate) - 3, 'revenue', 'money', '1.5'
FROM orders WHERE o_orderstatus = 'P'""",
    "snapshot_names": """SELECT 'order/' || o_orderkey AS raw_file, 'c' || o_custkey AS slug,
  strftime(o_orderdate, '%Y-%m-%dT00:00:00Z') AS fetched_at FROM orders""",
    "normalize_fields": _with(RAW)
    + f"""SELECT raw_file, fiscal_year, accounting_standard, true AS consolidated,
  {", ".join(f"{m}::DOUBLE AS {m}" for m in FACT_METRICS)}, document_id, filed_at, CAST(NULL AS VARCHAR) AS url FROM good""",
    "snapshot_mart": _with(
        RAW,
        CUSTOMERS,
        """chosen AS (
  SELECT * FROM good QUALIFY rank() OVER (PARTITION BY ticker ORDER BY o_orderdate DESC, sha DESC) = 1),
stepped AS (
  SELECT *, true AS consolidated, lag(revenue, 1) OVER s AS prev1, lag(revenue, 3) OVER s AS prev3
  FROM chosen WINDOW s AS (PARTITION BY ticker ORDER BY fiscal_year))""",
        f"m AS (SELECT *, {YOY}, {MARGIN}, {FCF}, {CAGR} FROM stepped)",
    )
    + f"""SELECT {MART_COLUMNS}, m.revenue_yoy_pct, m.operating_margin_pct, m.free_cash_flow, m.revenue_cagr_3y_pct,
  m.document_id AS source_document_id, 'annual_securities_report' AS source_document_type,
  m.filed_at AS source_filed_at, CAST(NULL AS VARCHAR) AS source_url,
  {STAMP.format("m.o_orderdate")} AS fetched_at, m.sha AS snapshot_sha256
FROM m JOIN companies c USING (ticker)""",
    "inspect_snapshots": """WITH y AS (SELECT *, year(o_orderdate) AS y FROM orders)
SELECT 'order/' || o_orderkey AS raw_file,
  concat_ws(',', y, y - 1, y - 2, y - 3, y - 4) AS fiscal_years, 'descending' AS year_order,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'JP' WHEN '2-HIGH' THEN 'US_GAAP' ELSE '' END AS accounting_standards,
  CAST(y - 4 AS VARCHAR) AS missing_cf_investing,
  concat_ws(',', y, y - 1, y - 2, y - 3, y - 4) AS missing_total_assets,
  CAST(y - 2 AS VARCHAR) AS zero_operating_income,
  concat_ws(',', y, y - 1, y - 2, y - 3, y - 4) AS missing_url FROM y""",
    "inspect_missing_zero": _with(
        supplier_periods(MONTH),
        "cells AS ("
        + "\nUNION ALL\n".join(f"SELECT suppkey, fiscal_year, '{m}' AS field, {m}::DOUBLE AS value FROM sp" for m in FACT_METRICS)
        + ")",
    )
    + """SELECT suppkey, field,
  coalesce(string_agg(CASE WHEN value IS NULL THEN CAST(fiscal_year AS VARCHAR) END, ',' ORDER BY fiscal_year), '') AS missing,
  coalesce(string_agg(CASE WHEN value = 0 THEN CAST(fiscal_year AS VARCHAR) END, ',' ORDER BY fiscal_year), '') AS zero
FROM cells WHERE value IS NULL OR value = 0 GROUP BY 1, 2""",
    "inspect_standards": """SELECT o_custkey, o_orderpriority, first_seen,
  row_number() OVER (PARTITION BY o_custkey ORDER BY first_seen) AS seen_order
FROM (SELECT o_custkey, o_orderpriority, min(o_orderkey) AS first_seen FROM orders GROUP BY 1, 2)""",
    "check_unique": """SELECT 'p_name' AS field, p_name AS value, count(*) AS occurrences FROM part GROUP BY p_name HAVING count(*) > 1
UNION ALL SELECT 'p_brand', p_brand, count(*) FROM part GROUP BY p_brand HAVING count(*) > 1
UNION ALL SELECT 'p_partkey', CAST(p_partkey AS VARCHAR), count(*) FROM part GROUP BY p_partkey HAVING count(*) > 1""",
    "check_slug_match": """SELECT s_name AS ticker, lower(s_name) AS slug, replace(lower(s_name), '#', '_') AS expected_slug
FROM supplier WHERE s_nationkey % 4 = 0""",
    "check_row_count": """SELECT 'order/' || o_orderkey AS raw_file, 'data' AS field, 'row_count' AS rule, '3' AS value
FROM orders WHERE o_orderkey % 8 = 4""",
    "check_document_rules": """SELECT 'order/' || o_orderkey AS raw_file, CASE o_orderkey % 8 WHEN 1 THEN 'decode' WHEN 2 THEN 'decode'
  WHEN 3 THEN 'period_kind' WHEN 5 THEN 'year_unique' WHEN 6 THEN 'row_object' ELSE 'root' END AS rule
FROM orders WHERE o_orderkey % 8 IN (1, 2, 3, 5, 6, 7)""",
    "check_missing_entities": _with(CUSTOMERS)
    + """SELECT company_order, ticker FROM companies
WHERE company_order NOT IN (SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1999)""",
    "company_dimension": """SELECT 'C' || c_custkey || '.T' AS ticker, c_name AS name,
  'E' || lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS edinet_code, 'JPY' AS currency,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 'indirect' ELSE 'direct' END AS status,
  CAST(c_nationkey AS VARCHAR) AS tier, 'listed' AS listing_status,
  CAST(NULL AS DOUBLE) AS avg_salary_man, CAST(NULL AS BIGINT) AS avg_salary_fiscal_year,
  'c' || c_custkey || '_t' AS slug,
  CAST(CASE WHEN c_mktsegment = 'MACHINERY' THEN 2 ELSE 1 END AS BIGINT) AS target_count, '' AS note
FROM customer""",
    "filter_direct_companies": "SELECT c_custkey AS company_order, 'direct' AS status FROM customer WHERE c_acctbal >= 0",
    "check_companies": """SELECT c_name AS ticker, 'name' AS field, 'name' AS rule FROM customer WHERE c_mktsegment = 'AUTOMOBILE'
UNION ALL SELECT c_name, 'edinet_code', 'code' FROM customer WHERE c_mktsegment = 'BUILDING'
UNION ALL SELECT c_name, 'status', 'status' FROM customer WHERE c_mktsegment = 'MACHINERY'
UNION ALL SELECT c_name, 'avg_salary_man', 'salary' FROM customer WHERE c_acctbal < 0
UNION ALL SELECT c_name, 'avg_salary_fiscal_year', 'salary_year' FROM customer WHERE c_nationkey = 3""",
    # Scalars
    "ticker_slug": """SELECT p_partkey, trim(regexp_replace(lower(p_brand), '[^a-z0-9]+', '_', 'g'), '_') AS brand_slug,
  trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g'), '_') AS name_slug, CAST(NULL AS VARCHAR) AS no_slug FROM part""",
    "normalize_standard": """SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'TOP'
  WHEN o_orderpriority = '5-LOW' THEN 'LOW' ELSE 'UNKNOWN' END AS standard FROM orders""",
    "normalize_name": "SELECT c_custkey, c_name AS name FROM customer",
    "normalize_filed_at": """SELECT o_orderkey,
  CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d') END AS filed_at FROM orders""",
    "display_formats": f"""SELECT o_orderkey, {_grouped("round(o_totalprice / 10000.0, 0)", 0)} AS millions,
  CASE WHEN o_orderstatus = 'P' THEN '—'
       ELSE ({_grouped("o_totalprice", 2)}) || CASE WHEN o_orderstatus = 'F' THEN '' ELSE '%' END END AS stat,
  'FY' || right(CAST(year(o_orderdate) AS VARCHAR), 2) AS label,
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS iso_time, strftime(o_orderdate, '%Y-%m-%d') AS iso_day,
  strftime(o_orderdate, '%Y/%m/%d') AS slash_day, strftime(o_orderdate, '%Y/%m/%d') || ' 9:00' AS japan_time
FROM orders""",
    "display_compact": f"""SELECT o_orderkey, {_compact("o_totalprice")} AS thousands,
  {_compact("(o_totalprice * -100)")} AS losses, {_compact("round(o_totalprice / 1000, 0)")} AS plain,
  CASE WHEN o_orderstatus = 'P' THEN '—' ELSE ({_grouped("o_totalprice", 2)}) || '%' END AS percent FROM orders""",
    # Documents and SQL
    "nest_periods": _with(ORDER_MART)
    + """SELECT ticker, count(*) OVER (PARTITION BY ticker) AS period_count,
  row_number() OVER (PARTITION BY ticker ORDER BY fiscal_year) - 1 AS place, fiscal_year, revenue, roe_pct,
  operating_margin_pct, source_document_id AS document_id, source_filed_at AS filed_at,
  replace(fetched_at, ' ', 'T') || 'Z' AS fetched_at FROM omart""",
    "manifest_counts": _with(ORDER_MART, SOURCE_ROWS)
    + """SELECT (SELECT count(DISTINCT orderkey) FROM wide) AS snapshot_count,
  (SELECT count(*) * 8 FROM wide) AS financial_fact_count, (SELECT count(*) FROM sources) AS source_document_count,
  (SELECT count(*) FROM omart) AS latest_company_year_count""",
    "raw_inputs": _with(HISTORY)
    + """SELECT DISTINCT ticker, 'order/' || orderkey AS raw_file, strftime(fetched, '%Y-%m-%dT%H:%M:%SZ') AS fetched_at,
  sha AS sha256 FROM wide""",
    "run_sql_views": _with(supplier_mart(), NEWEST_MART)
    + "SELECT ticker, fiscal_year, revenue, operating_margin_pct FROM fresh",
}

# Files ---------------------------------------------------------------------------

NATIONS = """nats AS (
  SELECT n_nationkey::BIGINT AS k, n_name AS ticker, lower(n_name) AS slug, n_regionkey <> 4 AS direct,
    'E' || lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS edinet_code, (SELECT max(n_nationkey) FROM nation)::BIGINT - n_nationkey AS company_order
  FROM nation),
nyears AS (
  SELECT c_nationkey::BIGINT AS k, year(o_orderdate)::BIGINT AS y, sum(c)::BIGINT AS revenue,
    sum(CASE WHEN o_orderstatus = 'F' THEN c END)::BIGINT AS operating_income,
    sum(CASE WHEN o_orderstatus = 'O' THEN c END)::BIGINT AS net_income, count(*) AS total_assets, sum(o_custkey)::BIGINT AS equity,
    sum(CASE WHEN o_orderpriority = '1-URGENT' THEN c END)::BIGINT AS operating_cash_flow,
    -sum(CASE WHEN o_orderpriority = '5-LOW' THEN c END)::BIGINT AS investing_cash_flow
  FROM (SELECT *, CAST(CAST(o_totalprice AS DECIMAL(12,2)) * 100 AS BIGINT) AS c FROM orders JOIN customer ON c_custkey = o_custkey)
  GROUP BY 1, 2),
grid AS (
  SELECT nats.*, s.i AS snap, (SELECT min(year(o_orderdate)) FROM orders)::BIGINT + 2 * s.i + p.i AS fiscal_year
  FROM nats CROSS JOIN range(0, 2) AS s(i) CROSS JOIN range(0, 5) AS p(i) WHERE nats.k <> 3),
nrows AS (
  SELECT grid.*, nyears.* EXCLUDE (k, y), CASE WHEN total_assets IS NOT NULL THEN (total_assets % 1000) / 10.0::DOUBLE END AS roe_pct,
    CASE grid.k % 3 WHEN 0 THEN 'JGAAP' WHEN 1 THEN 'IFRS' ELSE 'UNKNOWN' END AS accounting_standard,
    'N' || grid.k || '-' || fiscal_year AS document_id, (fiscal_year + 1) || '-06-30' AS filed_at
  FROM grid LEFT JOIN nyears ON nyears.k = grid.k AND nyears.y = grid.fiscal_year),
bodies AS (
  SELECT k, any_value(ticker) AS ticker, any_value(slug) AS slug, any_value(edinet_code) AS edinet_code, any_value(direct) AS direct,
    any_value(company_order) AS company_order, snap, any_value(slug) || '__financials__' || (2002 + snap) || '0115T000000Z.json' AS file_name,
    (2002 + snap) || '-01-15T00:00:00Z' AS fetched_at,
    '{"data": [' || string_agg('{"fiscal_year": ' || fiscal_year || ', "accounting_standard": '
      || CASE k % 3 WHEN 0 THEN '"JP"' WHEN 1 THEN '"IFRS"' ELSE 'null' END
      || ', "revenue": ' || coalesce(CAST(revenue AS VARCHAR), 'null') || ', "operating_income": ' || coalesce(CAST(operating_income AS VARCHAR), 'null')
      || ', "net_income": ' || coalesce(CAST(net_income AS VARCHAR), 'null') || ', "total_assets": ' || coalesce(CAST(total_assets AS VARCHAR), 'null')
      || ', "shareholders_equity": ' || coalesce(CAST(equity AS VARCHAR), 'null') || ', "cf_operating": ' || coalesce(CAST(operating_cash_flow AS VARCHAR), 'null')
      || ', "cf_investing": ' || coalesce(CAST(investing_cash_flow AS VARCHAR), 'null')
      || ', "roe_official": ' || coalesce('0.' || lpad(CAST(total_assets % 1000 AS VARCHAR), 3, '0'), 'null') || ', "doc_id": "' || document_id
      || '", "submit_date": "' || filed_at || ' 15:00", "edinet_filing_url": null}', ', ' ORDER BY fiscal_year)
      || '], "meta": {"edinet_code": "' || any_value(edinet_code) || '", "period": "annual"}}' AS body
  FROM nrows GROUP BY k, snap),
files AS (SELECT *, sha256(body) AS sha, strlen(body) AS bytes FROM bodies),
found AS (
  SELECT nrows.*, files.file_name, files.sha, (2002 + nrows.snap) || '-01-15 00:00:00' AS fetched_at
  FROM nrows JOIN files USING (k, snap) WHERE nrows.direct)"""

NATION_MART = f"""{NATIONS},
stepped AS (
  SELECT *, lag(revenue, 1) OVER s AS prev1, lag(revenue, 3) OVER s AS prev3
  FROM found WHERE snap = 1 WINDOW s AS (PARTITION BY ticker ORDER BY fiscal_year)),
mart AS (SELECT * EXCLUDE (prev1, prev3), ticker AS name, {YOY}, {MARGIN}, {FCF}, {CAGR} FROM stepped)"""

_SHOWN = "ticker, slug, edinet_code, file_name, fetched_at, sha AS sha256, bytes"

ORACLE_SQL |= {
    "scan_snapshots": _with(NATIONS) + f"SELECT {_SHOWN} FROM files WHERE direct",
    "snapshot_fingerprint": _with(NATIONS) + "SELECT k AS nation, snap AS snapshot, sha AS sha256 FROM files",
    "scan_latest_snapshots": _with(NATIONS) + f"SELECT {_SHOWN} FROM files WHERE direct AND snap = 1",
    "scan_explicit_inputs": _with(NATIONS) + f"SELECT {_SHOWN} FROM files WHERE direct AND snap = 0",
    "scan_companies": _with(NATIONS) + "SELECT company_order, ticker, edinet_code FROM nats",
    "build_dimension": _with(NATIONS)
    + """SELECT company_order, ticker, ticker AS name, edinet_code, 'JPY' AS currency,
  CASE WHEN direct THEN 'direct' ELSE 'indirect' END AS status, CAST(k AS VARCHAR) AS tier, 'listed' AS listing_status,
  k + 0.5::DOUBLE AS avg_salary_man, 2000 + k AS avg_salary_fiscal_year FROM nats""",
    "scan_fallback": _with(NATIONS) + "SELECT company_order, ticker FROM nats",
    "scan_comparisons": _with(NATIONS)
    + """SELECT pair_order, 'pair-' || pair_order AS id, ticker AS "left", following AS "right"
FROM (SELECT ticker, row_number() OVER o - 1 AS pair_order, lead(ticker) OVER o AS following FROM nats WHERE direct AND k <> 3 WINDOW o AS (ORDER BY k DESC))
WHERE following IS NOT NULL""",
    "land_raw": _with(NATIONS) + f"SELECT {_SHOWN}, (SELECT count(*) FROM files) AS landed FROM files WHERE direct",
    "scan_warehouse": _with(NATIONS)
    + "SELECT * FROM ("
    + _facts("found", "company_order, ticker, fiscal_year, accounting_standard, true AS consolidated, document_id, fetched_at AS raw_fetched_at, sha AS raw_sha256, file_name AS raw_file")
    + ")",
    "stored_sources": _with(NATIONS)
    + """SELECT company_order, ticker, fiscal_year, document_id, 'annual_securities_report' AS document_type, filed_at, CAST(NULL AS VARCHAR) AS url,
  fetched_at AS raw_fetched_at, sha AS raw_sha256, file_name AS raw_file FROM found""",
    "write_mart": _with(NATION_MART)
    + f"""SELECT company_order, ticker, name, edinet_code, 'JPY' AS currency, fiscal_year, CAST(NULL AS VARCHAR) AS fiscal_year_end, accounting_standard,
  true AS consolidated, {NAMES}, revenue_yoy_pct, operating_margin_pct, free_cash_flow, revenue_cagr_3y_pct, document_id AS source_document_id,
  'annual_securities_report' AS source_document_type, filed_at AS source_filed_at, CAST(NULL AS VARCHAR) AS source_url, fetched_at, sha AS snapshot_sha256
FROM mart""",
    "scan_mart": _with(NATION_MART) + "SELECT company_order, fiscal_year, ticker, revenue FROM mart",
    "write_company_documents": _with(NATION_MART)
    + """SELECT ticker, edinet_code, row_number() OVER (PARTITION BY ticker ORDER BY fiscal_year) - 1 AS place, fiscal_year, revenue, roe_pct, revenue_yoy_pct,
  document_id, filed_at, '2003-01-15T00:00:00Z' AS fetched_at FROM mart""",
    "write_stats_documents": _with(NATION_MART, "long AS (" + _long("ticker, fiscal_year") + ")") + _describe("fiscal_year, metric", "long"),
    "write_ranking": _with(NATION_MART, "long AS (" + _long("ticker, name, fiscal_year") + ")") + _ranked("long"),
    "write_manifest": _with(NATIONS)
    + """SELECT '1.0' AS schema_version, '2003-01-15T00:00:00Z' AS generated_at, (SELECT count(*) FROM files WHERE direct) AS snapshot_count,
  (SELECT count(*) * 8 FROM found) AS financial_fact_count, (SELECT count(*) FROM found) AS source_document_count,
  (SELECT count(*) FROM found WHERE snap = 1) AS latest_company_year_count, 'NATION_3' AS missing_ticker""",
    "write_lineage": _with(NATIONS) + "SELECT ticker, file_name AS raw_file, fetched_at, sha AS sha256 FROM files WHERE direct",
    "publish_staged": _with(NATIONS, "facts AS (" + _facts("found", "fiscal_year") + ")")
    + "SELECT metric_name, count(*) AS facts, 2::BIGINT AS number FROM facts WHERE fiscal_year >= 1998 GROUP BY metric_name",
    "export_tsv": _with(NATION_MART) + "SELECT ticker, fiscal_year, revenue, revenue_yoy_pct FROM mart",
    "match_entity_exact": "SELECT '70' AS sec_code, 'E00007' AS edinet_code FROM supplier WHERE s_suppkey = 7",
    "check_nonempty": "SELECT n_name AS ticker FROM nation",
    "check_snapshot_time": """SELECT 'order/' || o_orderkey AS raw_file, 'file_name' AS field, 'c__financials__20010230T000000Z.json' AS value
FROM orders WHERE o_orderkey % 10 = 7""",
}
