"""One query per operator, each over whole test tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from yearbook.catalog import files  # noqa: F401  (registers its queries)
from yearbook.catalog import tables as T
from yearbook.catalog.registry import QUERIES, query
from yearbook.functions import numeric, ratios, text
from yearbook.functions import variants as V
from yearbook.operators import compare, inspection, quality, ranking, reshape, series, snapshots, stats, timeseries
from yearbook.operators.registry import (
    COMPANY_CARDS,
    COMPARE_CARDS,
    COMPARISON_CHARTS,
    COMPARISON_ROWS,
    FACT_METRICS,
)
from yearbook.plans import documents, statistics, warehouse
from yearbook.plans.sql import run_sql
from yearbook import sinks
from yearbook.session import checkpoint_dir, stored
from yearbook.sources import schemas
from yearbook.sources.companies import company_entries, build_companies, filter_direct, split_targets
from yearbook.sources.snapshots import decode_snapshot, explode_periods, parse_fetched_at, parse_slug
from yearbook.sources.warehouse import register_views

__all__ = ["QUERIES"]

SNAPSHOT = ("ticker", "raw_fetched_at", "raw_sha256")


# Marts ---------------------------------------------------------------------------


@query
def mart_supplier_year(spark, sf):
    return T.supplier_mart(spark, sf)


@query
def mart_supplier_month(spark, sf):
    return T.supplier_mart(spark, sf, "month")


@query
def company_year_mart(spark, sf):
    return _order_tables(spark, sf)["company_year_metrics"]


@query
def order_mart(spark, sf):
    return warehouse.order_mart(T.supplier_mart(spark, sf)).select("company_order", "fiscal_year", "revenue")


# Reshaping -----------------------------------------------------------------------


@query
def pivot_metrics(spark, sf):
    return reshape.pivot_metrics(T.supplier_facts(spark, sf), ["suppkey", "fiscal_year"])


@query
def unpivot_facts(spark, sf):
    return T.supplier_facts(spark, sf)


@query
def long_metrics(spark, sf):
    return reshape.long_metrics(T.supplier_mart(spark, sf), ["ticker", "fiscal_year"])


@query
def build_sources(spark, sf):
    return T.order_sources(spark, sf)


@query
def financial_history(spark, sf):
    return T.order_history(spark, sf)


@query
def filter_period(spark, sf):
    return T.supplier_periods(spark, sf).filter(F.col("fiscal_year") == 1997)


@query
def filter_entity(spark, sf):
    return T.supplier_periods(spark, sf).filter(F.col("suppkey") == 7)


@query
def scale_metric(spark, sf):
    orders = T.table(spark, sf, "orders")
    kind = F.when(F.col("o_orderstatus") == "F", "money").otherwise("percent")
    cents = numeric.hundredths(F.col("o_totalprice"))
    return orders.select("o_orderkey", numeric.scale_metric(cents, kind).alias("shown"))


# Series --------------------------------------------------------------------------


@query
def lag_metric(spark, sf):
    steps = {1: "previous_revenue", 3: "starting_revenue"}
    rows = T.supplier_periods(spark, sf).select("suppkey", "fiscal_year", "revenue")
    return timeseries.lag_metric(rows, "suppkey", "fiscal_year", "revenue", steps)


@query
def lag_with_gaps(spark, sf):
    rows = T.customer_years(spark, sf)
    return timeseries.lag_metric(rows, "custkey", "fiscal_year", "revenue", {1: "previous", 3: "start"})


@query
def lag_by_value(spark, sf):
    rows = T.customer_years(spark, sf)
    return timeseries.lag_by_value(rows, "custkey", "fiscal_year", "revenue", {1: "previous", 3: "start"})


@query
def revenue_yoy(spark, sf):
    lagged = timeseries.lag_metric(T.customer_years(spark, sf), "custkey", "fiscal_year", "revenue", {1: "previous"})
    return lagged.select(
        "custkey", "fiscal_year", ratios.revenue_yoy(F.col("revenue"), F.col("previous")).alias("revenue_yoy_pct")
    )


@query
def revenue_cagr(spark, sf):
    lagged = timeseries.lag_metric(T.customer_years(spark, sf), "custkey", "fiscal_year", "revenue", {3: "start"})
    return lagged.select(
        "custkey", "fiscal_year", ratios.revenue_cagr(F.col("revenue"), F.col("start")).alias("revenue_cagr_3y_pct")
    )


@query
def operating_margin(spark, sf):
    rows = T.supplier_periods(spark, sf, "month")
    return rows.select(
        "suppkey",
        "fiscal_year",
        ratios.operating_margin(F.col("operating_income"), F.col("revenue")).alias("operating_margin_pct"),
    )


@query
def free_cash_flow(spark, sf):
    rows = T.supplier_periods(spark, sf, "month")
    flow = ratios.free_cash_flow(F.col("operating_cash_flow"), F.col("investing_cash_flow"))
    return rows.select("suppkey", "fiscal_year", flow.alias("free_cash_flow"))


@query
def latest_period(spark, sf):
    return timeseries.latest_period(T.customer_years(spark, sf), "custkey", "fiscal_year")


@query
def segment_series(spark, sf):
    rows = T.supplier_periods(spark, sf, "month")
    return timeseries.segment_series(rows, ["suppkey"], "fiscal_year", "investing_cash_flow")


@query
def series_position(spark, sf):
    rows = T.customer_years(spark, sf).select("custkey", "fiscal_year")
    return timeseries.series_position(rows, ["custkey"], "fiscal_year")


# Snapshots and joins -------------------------------------------------------------


@query
def distinct_snapshots(spark, sf):
    return snapshots.distinct_snapshots(T.order_history(spark, sf), *SNAPSHOT)


@query
def latest_snapshot(spark, sf):
    return snapshots.latest_snapshot(T.order_snapshots(spark, sf), *SNAPSHOT)


@query
def join_latest_facts(spark, sf):
    periods = T.newest_order_periods(T.order_lines(spark, sf))
    found = warehouse.latest_facts(T.order_history(spark, sf, periods), periods)
    return found.select("ticker", "fiscal_year", "metric_name", "value", "document_id")


@query
def join_latest_sources(spark, sf):
    sources = T.order_sources(spark, sf)
    latest = snapshots.latest_snapshot(T.order_snapshots(spark, sf), *SNAPSHOT)
    return snapshots.join_latest(sources, latest, *SNAPSHOT).select("ticker", "fiscal_year", "document_id", "filed_at")


@query
def join_dimension(spark, sf):
    """Facts of entities that the dimension does not hold are dropped: those in debt."""
    return warehouse.join_dimension(
        T.customer_years(spark, sf).withColumn("ticker", F.concat(F.lit("C"), F.col("custkey").cast("string"))),
        T.customer_dimension(spark, sf).filter("balance >= 0"),
        ["name", "currency"],
    )


@query
def join_sources_left(spark, sf):
    newest = T.newest_order_periods(T.order_lines(spark, sf), T.table(spark, sf, "orders"))
    rows = T.order_history(spark, sf, newest)
    periods = reshape.pivot_metrics(rows, [*SNAPSHOT, "fiscal_year"], money=["revenue"], percent=[])
    named = periods.withColumnsRenamed({"raw_fetched_at": "fetched_at", "raw_sha256": "snapshot_sha256"})
    return warehouse.join_sources(named, T.order_sources(spark, sf, gaps=True, periods=newest))


@query
def dedupe_snapshots(spark, sf):
    return snapshots.dedupe_snapshots(_line_copies(spark, sf), ["orderkey", "linenumber"], "digest", "raw_file")


@query
def snapshot_conflicts(spark, sf):
    return snapshots.snapshot_conflicts(_line_copies(spark, sf), ["orderkey", "linenumber"], "digest")


def _line_copies(spark, sf):
    """Order lines as snapshots; some keys occur twice, with equal or other contents."""
    return T.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"),
        F.col("l_linenumber").alias("linenumber"),
        F.sha2(F.concat("l_returnflag", "l_linestatus"), 256).alias("digest"),
        F.concat_ws("/", F.lpad(F.col("l_partkey").cast("string"), 12, "0"), F.lpad(F.col("l_suppkey").cast("string"), 12, "0")).alias("raw_file"),
    )


@query
def semi_known_entity(spark, sf):
    known = T.table(spark, sf, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    return snapshots.semi_known_entity(
        T.table(spark, sf, "orders").select(F.col("o_custkey").alias("custkey"), "o_orderkey"),
        known.select(F.col("c_custkey").alias("custkey")),
        "custkey",
    )


def _customers_of_year(spark, sf, year):
    return T.customer_years(spark, sf).filter(F.col("fiscal_year") == year)


@query
def anti_missing_entity(spark, sf):
    customers = T.table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"), "c_name")
    return snapshots.anti_missing_entity(customers, _customers_of_year(spark, sf, 1996), "custkey")


@query
def except_entities(spark, sf):
    customers = T.table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"))
    return snapshots.except_entities(customers, _customers_of_year(spark, sf, 1998), "custkey")


@query
def flag_available(spark, sf):
    customers = T.table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"), "c_name")
    return snapshots.flag_available(customers, _customers_of_year(spark, sf, 2001), "custkey", "has_financials")


@query
def company_listing(spark, sf):
    customers = T.table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"), "c_name", "c_acctbal")
    listed = series.company_listing(customers, _customers_of_year(spark, sf, 2001), _customers_of_year(spark, sf, 2000), "custkey")
    return listed.withColumn("status", F.when(F.col("c_acctbal") >= 0, "direct").otherwise("indirect")).orderBy("custkey")


@query
def company_totals(spark, sf):
    found = T.table(spark, sf, "customer").select(
        F.when(F.col("c_acctbal") >= 0, "direct").otherwise("indirect").alias("status"),
        split_targets(
            F.when(F.col("c_mktsegment") != "BUILDING", F.split("c_name", "#")), F.col("c_name")
        ).alias("targets"),
    )
    return series.company_totals(found)


@query
def agg_bool_and(spark, sf):
    # By flag first: a hash aggregate. The maximum over text then sorts few rows.
    flags = T.table(spark, sf, "lineitem").groupBy(
        "l_suppkey", F.year("l_shipdate").alias("fiscal_year"), "l_returnflag"
    ).agg(
        F.bool_and(F.col("l_linestatus") == "F").alias("closed"), F.max("l_shipdate").alias("shipped")
    )
    return flags.groupBy("l_suppkey", "fiscal_year").agg(
        F.bool_and("closed").alias("all_closed"),
        F.max("l_returnflag").alias("max_flag"),
        F.max("shipped").alias("generated_at"),
    )


# Statistics ----------------------------------------------------------------------


@query
def common_periods(spark, sf):
    return stats.common_periods(T.supplier_periods(spark, sf, "month"), "suppkey", "fiscal_year")


@query
def count_distinct_entities(spark, sf):
    return stats.count_distinct_entities(T.table(spark, sf, "lineitem").select(
        "l_suppkey", F.year("l_shipdate").alias("fiscal_year")), "l_suppkey", "fiscal_year")


@query
def join_scalar(spark, sf):
    months = T.supplier_periods(spark, sf, "month")
    counts = stats.count_distinct_entities(months, "suppkey", "fiscal_year")
    return counts.withColumn("everyone", stats.count_distinct_entities(months, "suppkey").scalar())


@query
def default_selection(spark, sf):
    periods = stats.common_periods(T.supplier_periods(spark, sf, "month"), "suppkey", "fiscal_year")
    return stats.default_selection(periods, "fiscal_year", requested=190001)


def _month_long(spark, sf):
    return reshape.long_metrics(
        T.stored_supplier_mart(spark, sf, "month"), ["fiscal_year", "company_order", "ticker", "name"]
    )


@query
def describe_metrics(spark, sf):
    return stats.describe_metrics(_month_long(spark, sf), statistics.GROUP)


@query
def describe_common_years(spark, sf):
    return statistics.statistics(T.stored_supplier_mart(spark, sf)).descriptive


@query
def describe_order_prices(spark, sf):
    """One group per order status, over all orders: few and very large groups."""
    prices = T.table(spark, sf, "orders").select("o_orderstatus", F.col("o_totalprice").alias("value"))
    return stats.describe_metrics(prices, ["o_orderstatus"])


@query
def rank_metric(spark, sf):
    ranked = ranking.rank_metric(_month_long(spark, sf), statistics.GROUP, "value")
    return ranked.select("fiscal_year", "metric", "rank", "ticker", "name", numeric.round4(F.col("value")).alias("value"))


@query
def rank_order_lines(spark, sf):
    """Rank of every order line by quantity within its return flag: heavy ties."""
    lines = T.table(spark, sf, "lineitem").select(
        "l_returnflag", "l_orderkey", "l_linenumber", F.col("l_quantity").alias("value")
    )
    return ranking.rank_metric(lines, ["l_returnflag"], "value")


@query
def order_ranking(spark, sf):
    mart = T.stored_supplier_mart(spark, sf)
    return ranking.order_ranking(
        statistics.statistics(mart).rankings, statistics.GROUP, "company_order"
    ).select("fiscal_year", "metric", "rank", "ticker", "name", "value")


@query
def value_positions(spark, sf):
    lines = T.table(spark, sf, "lineitem").select("l_linestatus", F.col("l_extendedprice").alias("value"))
    return ranking.value_positions(lines, ["l_linestatus"], "value")


def _month_points(spark, sf):
    return stats.scatter_points(T.supplier_mart(spark, sf, "month"), ["fiscal_year", "ticker", "name"])


@query
def scatter_pairs(spark, sf):
    return stats.scatter_pairs(_month_points(spark, sf))


@query
def scatter_exclusions(spark, sf):
    return stats.scatter_exclusions(_month_points(spark, sf))


@query
def scatter_counts(spark, sf):
    return stats.scatter_counts(_month_points(spark, sf), ["fiscal_year"])


@query
def metric_metadata_join(spark, sf):
    counts = reshape.long_metrics(T.supplier_mart(spark, sf), ["fiscal_year"]).groupBy("metric").agg(
        F.count("value").alias("values")
    )
    return statistics.metric_metadata_join(counts, statistics.metric_registry(spark))


# Comparison and charts -----------------------------------------------------------


@query
def compare_entities(spark, sf):
    return compare.compare_entities(
        T.supplier_pairs(spark, sf), T.supplier_mart(spark, sf), "ticker", "fiscal_year", list(COMPARISON_CHARTS)
    )


@query
def comparison_series(spark, sf):
    compared = compare.compare_entities(
        T.supplier_pairs(spark, sf), T.supplier_mart(spark, sf), "ticker", "fiscal_year", list(COMPARISON_CHARTS)
    )
    return compare.long_comparison(compared, "fiscal_year", COMPARISON_CHARTS)


@query
def comparison_table(spark, sf):
    compared = compare.compare_entities(
        T.supplier_pairs(spark, sf), T.supplier_mart(spark, sf), "ticker", "fiscal_year", list(COMPARISON_ROWS)
    )
    return compare.comparison_table(compared, "fiscal_year", COMPARISON_ROWS)


@query
def intersect_periods(spark, sf):
    rows = T.customer_years(spark, sf).withColumn("ticker", F.col("custkey").cast("string"))
    return compare.intersect_periods(rows, "ticker", "fiscal_year", "11", "25")


@query
def pair_periods(spark, sf):
    return compare.pair_periods(
        T.supplier_pairs(spark, sf), T.supplier_periods(spark, sf, "month").join(
            T.supplier_dimension(spark, sf), "suppkey"), "ticker", "fiscal_year"
    )


def _doubtful_pairs(spark, sf):
    """Customers paired with others of their nation number; many pairs break a rule."""
    customers = T.table(spark, sf, "customer")
    key, nation = F.col("c_custkey"), F.col("c_nationkey").cast("bigint")
    return customers.select(
        key.alias("pair_order"),
        F.concat(F.when(nation == 3, F.lit("Bad ")).otherwise(F.lit("p-")), F.floor(key / 2).cast("string")).alias("id"),
        F.when(nation != 4, key.cast("string")).alias("left"),
        F.when(nation == 5, key).when(nation == 6, -key).otherwise(key + 1).cast("string").alias("right"),
    )


@query
def check_comparisons(spark, sf):
    rows = T.customer_years(spark, sf).withColumn("ticker", F.col("custkey").cast("string"))
    return quality.check_comparisons(_doubtful_pairs(spark, sf), rows)


@query
def compare_defaults(spark, sf):
    entities = T.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("company_order"), F.col("s_name").alias("ticker"))
    name = lambda key: F.concat(F.lit("Supplier#"), F.lpad(key.cast("string"), 9, "0"))
    requests = T.table(spark, sf, "lineitem").groupBy("l_suppkey", "l_linenumber").agg(F.count("*").alias("uses")).select(
        "l_suppkey",
        "l_linenumber",
        F.when(F.col("l_linenumber") > 1, name(F.col("l_suppkey") * (F.col("l_linenumber") - 2))).alias("left"),
        name(F.col("l_linenumber") * F.col("l_linenumber") - 4).alias("right"),
    )
    return compare.compare_defaults(requests, entities, "ticker", "company_order", two=True)


@query
def first_entity(spark, sf):
    entities = T.table(spark, sf, "customer").select((-F.col("c_acctbal")).alias("company_order"), F.col("c_name").alias("ticker"))
    return compare.first_entity(entities, "ticker", "company_order")


@query
def lookup_manifest_pair(spark, sf):
    pairs = T.supplier_pairs(spark, sf).select("id", "left", "right")
    swapped = T.supplier_pairs(spark, sf).select(
        F.col("pair_order").alias("request"),
        F.when(F.col("pair_order") % 3 == 0, F.col("right")).otherwise(F.col("left")).alias("left"),
        F.when(F.col("pair_order") % 3 == 0, F.col("left")).otherwise(F.col("right")).alias("right"),
    )
    return compare.lookup_manifest_pair(pairs, swapped)


@query
def chart_series(spark, sf):
    return series.chart_series(T.supplier_mart(spark, sf), ["ticker", "fiscal_year"])


def _month_series(spark, sf):
    return series.chart_series(T.supplier_mart(spark, sf, "month"), ["ticker", "fiscal_year"])


@query
def axis_domain(spark, sf):
    domain = series.axis_domain(_month_series(spark, sf), ["ticker", "chart"])
    return domain.withColumns({c: numeric.round4(F.col(c)) for c in ("axis_min", "axis_max")})


@query
def axis_ticks(spark, sf):
    domain = series.axis_domain(_month_series(spark, sf), ["ticker", "chart"])
    ticks = series.axis_ticks(domain, ["ticker", "chart"])
    return ticks.withColumn("tick_value", numeric.round4(F.col("tick_value")))


@query
def latest_cards(spark, sf):
    return series.latest_cards(T.supplier_mart(spark, sf), "ticker", "fiscal_year", COMPANY_CARDS)


@query
def latest_compare_cards(spark, sf):
    return series.latest_cards(T.supplier_mart(spark, sf, "month"), "ticker", "fiscal_year", COMPARE_CARDS)


@query
def company_chart_manifest(spark, sf):
    companies = T.table(spark, sf, "supplier").select(F.col("s_name").alias("ticker"))
    return documents.company_chart_manifest(companies).select("ticker", "charts.*")


@query
def comparison_chart_manifest(spark, sf):
    return documents.comparison_chart_manifest(T.supplier_pairs(spark, sf)).select("id", "left", "right", "charts.*")


# Raw JSON ------------------------------------------------------------------------


@query
def json_tokens(spark, sf):
    props = V.decode_json(F.col("props"))
    k = V.field(props, "$.k")
    return T.table(spark, sf, "events").select(
        "event_id",
        V.token(k).alias("token"),
        V.as_double(k).cast("bigint").alias("k"),
        V.is_money(k).alias("is_money"),
        V.is_text(k).alias("is_text"),
        V.is_missing(V.field(props, "$.absent")).alias("absent"),
    )


@query
def check_money_json(spark, sf):
    """Numbers of a table written as JSON and judged by their tokens."""
    value = F.col("l_extendedprice")
    text_value = (
        F.when(F.col("l_linenumber") == 1, F.concat(F.lit('"'), value.cast("string"), F.lit('"')))
        .when(F.col("l_linenumber") == 2, F.lit("null"))
        .when(F.col("l_linenumber") == 3, F.lit("true"))
        .when(F.col("l_linenumber") == 4, F.col("l_quantity").cast("string"))
        .otherwise(F.concat(F.floor(value).cast("string"), F.when(F.col("l_linenumber") > 5, F.lit(".25")).otherwise(F.lit(""))))
    )
    written = V.field(V.decode_json(F.concat(F.lit('{"v": '), text_value, F.lit("}"))), "$.v")
    lines = T.table(spark, sf, "lineitem").select("l_linenumber", "l_returnflag", written.alias("token"))
    token = F.col("token")
    return lines.groupBy("l_linenumber", "l_returnflag").agg(
        F.count_if(V.is_money(token)).alias("money"),
        F.count_if(V.is_ratio(token)).alias("ratio"),
        F.count_if(V.is_optional_text(token)).alias("optional_text"),
        F.count_if(V.is_integer(token)).alias("integers"),
        F.sum(V.normalize_money(token)).cast("decimal(38,4)").alias("total"),
    )


def _checked(spark, sf):
    return quality.check_snapshots(decode_snapshot(T.raw_documents(spark, sf)))


@query
def decode_snapshots(spark, sf):
    decoded = decode_snapshot(T.raw_documents(spark, sf))
    rows = explode_periods(decoded, ["raw_file"])
    return rows.select("raw_file", "position", F.try_variant_get("row", "$.fiscal_year", "bigint").alias("fiscal_year"))


@query
def check_snapshots(spark, sf):
    return quality.list_violations(_checked(spark, sf))


@query
def snapshot_names(spark, sf):
    name = F.col("file_name")
    return T.raw_documents(spark, sf).select(
        "raw_file", parse_slug(name).alias("slug"), text.iso_utc(parse_fetched_at(name)).alias("fetched_at")
    )


@query
def normalize_fields(spark, sf):
    return warehouse.normalize_fields(quality.accepted(_checked(spark, sf))).select(
        "raw_file",
        "fiscal_year",
        "accounting_standard",
        "consolidated",
        *FACT_METRICS,
        "document_id",
        "filed_at",
        "url",
    )


@query
def snapshot_mart(spark, sf):
    """Raw JSON to mart: decode, check, accept, normalise, newest snapshot, derive."""
    periods = stored(warehouse.normalize_fields(quality.accepted(_checked(spark, sf))))
    return warehouse.build_mart(
        warehouse.build_history(periods), T.customer_dimension(spark, sf), warehouse.build_sources(periods)
    )


@query
def inspect_snapshots(spark, sf):
    report = inspection.inspect_snapshots(decode_snapshot(T.raw_documents(spark, sf)), ["raw_file"])
    listed = lambda column, name: F.array_join(F.element_at(column, F.lit(name)), ",")
    return report.select(
        "raw_file",
        F.array_join("fiscal_years", ",").alias("fiscal_years"),
        "year_order",
        F.array_join("accounting_standards", ",").alias("accounting_standards"),
        listed(F.col("missing_values"), "cf_investing").alias("missing_cf_investing"),
        listed(F.col("missing_values"), "total_assets").alias("missing_total_assets"),
        listed(F.col("zero_values"), "operating_income").alias("zero_operating_income"),
        listed(F.col("missing_source_values"), "edinet_filing_url").alias("missing_url"),
    )


@query
def inspect_missing_zero(spark, sf):
    rows = T.supplier_periods(spark, sf, "month")
    report = inspection.inspect_missing_zero(rows, "suppkey", "fiscal_year", FACT_METRICS)
    return report.select("suppkey", "field", F.array_join("missing", ",").alias("missing"), F.array_join("zero", ",").alias("zero"))


@query
def inspect_standards(spark, sf):
    orders = T.table(spark, sf, "orders")
    return inspection.inspect_standards(orders, "o_custkey", "o_orderkey", "o_orderpriority")


@query
def check_unique(spark, sf):
    return quality.check_unique(T.table(spark, sf, "part"), ["p_name", "p_partkey", "p_brand"])


@query
def check_slug_match(spark, sf):
    suppliers = T.table(spark, sf, "supplier").select(
        F.col("s_name").alias("ticker"),
        F.when(F.col("s_nationkey") % 4 == 0, F.lower("s_name")).otherwise(F.lower(F.replace("s_name", F.lit("#"), F.lit("_")))).alias("slug"),
    )
    return quality.check_slug_match(suppliers, suppliers)


def _document_violations(spark, sf):
    documents = decode_snapshot(T.raw_documents(spark, sf, shapes=True))
    return quality.list_violations(quality.check_snapshots(documents)).select("raw_file", "field", "rule", "value")


@query
def check_row_count(spark, sf):
    """Documents must hold five periods."""
    return _document_violations(spark, sf).filter("rule = 'row_count'")


@query
def check_document_rules(spark, sf):
    """Rules of documents as a whole: JSON, root, period kind, years, period objects."""
    return _document_violations(spark, sf).filter("rule in ('decode', 'root', 'period_kind', 'year_unique', 'row_object')").select("raw_file", "rule")


@query
def check_missing_entities(spark, sf):
    companies = T.customer_dimension(spark, sf).withColumn("status", F.lit("direct"))
    present = T.order_snapshots(spark, sf).filter(F.year("raw_fetched_at") == 1999)
    return quality.check_missing_entities(companies, present)


@query
def company_dimension(spark, sf):
    """Customers written as dimension entries, then read, checked and typed."""
    customers = T.table(spark, sf, "customer")
    entry = F.concat(
        F.lit('{"C'),
        F.col("c_custkey").cast("string"),
        F.lit('.T": {"name": " '),
        F.col("c_name"),
        F.lit('", "edinet_code": "E'),
        F.lpad(F.col("c_nationkey").cast("string"), 5, "0"),
        F.lit('", "tier": '),
        F.col("c_nationkey").cast("string"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit(', "status": "indirect"')).otherwise(F.lit("")),
        F.when(F.col("c_mktsegment") == "MACHINERY", F.lit(', "targets": ["a", "b"]')).otherwise(F.lit("")),
        F.lit("}}"),
    )
    built = build_companies(company_entries(customers.select(entry.alias("value"))))
    return built.select(
        "ticker", "name", "edinet_code", "currency", "status", "tier", "listing_status", "avg_salary_man",
        "avg_salary_fiscal_year", "slug", F.size("targets").alias("target_count"), "note",
    )


@query
def filter_direct_companies(spark, sf):
    customers = T.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("company_order"),
        F.when(F.col("c_acctbal") >= 0, "direct").otherwise("indirect").alias("status"),
    )
    return filter_direct(customers)


@query
def check_companies(spark, sf):
    """Dimension entries made from customers; segments decide what is wrong."""
    customers = T.dealt(T.table(spark, sf, "customer"), "c_custkey", "c_name")
    meta = F.concat(
        F.lit('{"name": "'),
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit(" ")).otherwise(F.col("c_name")),
        F.lit('", "edinet_code": "E'),
        F.lpad(F.col("c_nationkey").cast("string"), 4, "0"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("")).otherwise(F.lit("0")),
        F.lit('", "status": '),
        F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("null")).otherwise(F.lit('"direct"')),
        F.lit(', "avg_salary_man": '),
        F.when(F.col("c_acctbal") < 0, F.lit('"none"')).otherwise(F.col("c_acctbal").cast("string")),
        F.lit(', "avg_salary_fiscal_year": '),
        F.when(F.col("c_nationkey") == 3, F.lit("2024.0")).otherwise(F.lit("2024")),
        F.lit("}"),
    )
    entries = customers.select(
        F.col("c_custkey").alias("company_order"), F.col("c_name").alias("ticker"), F.try_parse_json(meta).alias("meta")
    )
    checked = quality.check_companies(entries)
    return quality.list_violations(checked, ["ticker"]).drop("fiscal_year", "value")


# Scalars -------------------------------------------------------------------------


@query
def ticker_slug(spark, sf):
    parts = T.table(spark, sf, "part")
    return parts.select(
        "p_partkey",
        text.ticker_slug(F.col("p_brand")).alias("brand_slug"),
        text.ticker_slug(F.concat(F.lit(" -"), F.col("p_name"), F.lit("!."))).alias("name_slug"),
        text.ticker_slug(F.lit("株")).alias("no_slug"),
    )


@query
def normalize_standard(spark, sf):
    codes = {"1-URGENT": "TOP", "2-HIGH": "TOP", "5-LOW": "LOW"}
    orders = T.table(spark, sf, "orders")
    return orders.select("o_orderkey", text.normalize_standard(F.col("o_orderpriority"), codes).alias("standard"))


@query
def normalize_name(spark, sf):
    """Names written full-width, then brought back to plain letters."""
    plain = "".join(chr(c) for c in range(0x21, 0x7F))
    wide = "".join(chr(c + 0xFEE0) for c in range(0x21, 0x7F))
    customers = T.table(spark, sf, "customer")
    full = F.concat(F.lit("　"), F.translate("c_name", plain, wide), F.lit(" "))
    return customers.select("c_custkey", text.normalize_name(full).alias("name"))


@query
def normalize_filed_at(spark, sf):
    orders = T.table(spark, sf, "orders")
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd")
    raw = F.when(F.col("o_orderstatus") == "F", F.concat(stamp, F.lit(" 15:00"))).otherwise(stamp)
    return orders.select("o_orderkey", text.normalize_filed_at(raw).alias("filed_at"))


@query
def display_formats(spark, sf):
    orders = T.table(spark, sf, "orders")
    price, kind = F.col("o_totalprice"), F.when(F.col("o_orderstatus") == "F", "money").otherwise("percent")
    cents = numeric.hundredths(price)
    return orders.select(
        "o_orderkey",
        text.format_millions(cents).alias("millions"),
        text.format_stat(F.when(F.col("o_orderstatus") != "P", price), kind).alias("stat"),
        text.fiscal_label(F.year("o_orderdate")).alias("label"),
        text.iso_utc(F.col("o_orderdate")).alias("iso_time"),
        text.iso_date(F.col("o_orderdate")).alias("iso_day"),
        text.format_date_slash(F.col("o_orderdate")).alias("slash_day"),
        text.to_japan_time(F.col("o_orderdate").cast("timestamp")).alias("japan_time"),
    )


@query
def display_compact(spark, sf):
    price = F.col("o_totalprice")
    return T.table(spark, sf, "orders").select(
        "o_orderkey",
        text.format_compact(price).alias("thousands"),
        text.format_compact(price * -100).alias("losses"),
        text.format_compact(F.round(price / 1000, 0)).alias("plain"),
        text.format_percent(F.when(F.col("o_orderstatus") != "P", price)).alias("percent"),
    )


# Documents and SQL ---------------------------------------------------------------


def _order_tables(spark, sf):
    """History, sources and mart over one stored table of order lines; the mart over the newest orders."""
    lines = stored(T.order_lines(spark, sf))
    periods, newest = T.as_periods(lines), T.newest_order_periods(lines)
    history, sources = T.order_history(spark, sf, periods), T.order_sources(spark, sf, periods=periods)
    found = T.order_sources(spark, sf, periods=newest)
    mart = warehouse.build_mart(T.order_history(spark, sf, newest), T.customer_dimension(spark, sf), found, found)
    return {"financial_history": history, "source_documents_history": sources, "company_year_metrics": mart}


@query
def nest_periods(spark, sf):
    nested = documents.nest_periods(_order_tables(spark, sf)["company_year_metrics"])
    flat = nested.select("ticker", F.size("periods").alias("period_count"), F.posexplode("periods").alias("place", "p"))
    return flat.select(
        "ticker",
        "period_count",
        "place",
        "p.fiscal_year",
        "p.metrics.revenue",
        "p.metrics.roe_pct",
        "p.calculated_metrics.operating_margin_pct",
        "p.source_document.document_id",
        "p.source_document.filed_at",
        "p.fetched_at",
    )


@query
def manifest_counts(spark, sf):
    return documents.manifest_counts(_order_tables(spark, sf))


@query
def raw_inputs(spark, sf):
    return documents.raw_inputs(T.order_history(spark, sf))


@query
def run_sql_views(spark, sf):
    """The mart stored as a build stores it, registered as a view, and asked in SQL."""
    folder = f"{checkpoint_dir(spark)}/yearbook-views-{uuid.uuid4().hex}"
    for name, schema in schemas.WAREHOUSE.items():
        rows = T.supplier_mart(spark, sf) if name == "company_year_metrics" else spark.createDataFrame([], schema)
        found = [c for c in StructType.fromDDL(schema).names if c not in rows.columns]
        sinks.write_table(rows.withColumns({c: F.lit(None) for c in found}).select(*StructType.fromDDL(schema).names), f"{folder}/{name}", schema)
    register_views(spark, folder)
    return run_sql(
        spark,
        """
        WITH newest AS (SELECT ticker, max(fiscal_year) AS fiscal_year FROM company_year_metrics GROUP BY ticker)
        SELECT m.ticker, m.fiscal_year, m.revenue, m.operating_margin_pct
        FROM company_year_metrics m JOIN newest USING (ticker, fiscal_year)
        ORDER BY m.ticker
        """,
    )
