"""Declared schemas of the stored tables. Writes conform to them."""

from __future__ import annotations

DIM_COMPANIES = (
    "company_order int, ticker string, name string, edinet_code string, currency string, "
    "status string, tier string, listing_status string, avg_salary_man double, "
    "avg_salary_fiscal_year int"
)

FINANCIAL_HISTORY = (
    "company_order int, ticker string, fiscal_year int, metric_name string, "
    "value decimal(38,4), unit string, accounting_standard string, consolidated boolean, "
    "document_id string, raw_fetched_at timestamp, raw_sha256 string, raw_file string"
)

SOURCE_DOCUMENTS_HISTORY = (
    "company_order int, ticker string, fiscal_year int, document_id string, "
    "document_type string, filed_at date, url string, raw_fetched_at timestamp, "
    "raw_sha256 string, raw_file string"
)

COMPANY_YEAR_METRICS = (
    "company_order int, ticker string, name string, edinet_code string, currency string, "
    "fiscal_year int, fiscal_year_end date, accounting_standard string, consolidated boolean, "
    "revenue bigint, operating_income bigint, net_income bigint, total_assets bigint, "
    "equity bigint, operating_cash_flow bigint, investing_cash_flow bigint, roe_pct double, "
    "revenue_yoy_pct double, operating_margin_pct double, free_cash_flow bigint, "
    "revenue_cagr_3y_pct double, source_document_id string, source_document_type string, "
    "source_filed_at date, source_url string, fetched_at timestamp, snapshot_sha256 string"
)

# Table name to schema, in build order.
WAREHOUSE = {
    "dim_companies": DIM_COMPANIES,
    "financial_history": FINANCIAL_HISTORY,
    "source_documents_history": SOURCE_DOCUMENTS_HISTORY,
    "company_year_metrics": COMPANY_YEAR_METRICS,
}

# View name to table name.
VIEWS = {
    "companies": "dim_companies",
    "financial_history": "financial_history",
    "source_document_history": "source_documents_history",
    "company_year_metrics": "company_year_metrics",
}

RAW_LANDING = "slug string, kind string, fetched_at timestamp, body binary"
