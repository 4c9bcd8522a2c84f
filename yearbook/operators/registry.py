"""The metric and scatter registries: small fixed tables that drive the statistics."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Metric:
    """A column to compute statistics on, and how to show it."""

    id: str
    column: str
    label: str
    english_label: str
    kind: str  # "money" is shown in millions, "percent" as it is
    unit: str


@dataclass(frozen=True)
class Scatter:
    """Two metrics plotted against each other."""

    id: str
    label: str
    description: str
    x: str
    y: str
    x_scale: str = "linear"


# Stored metrics of the long fact table and their units.
MONEY_METRICS = (
    "revenue",
    "operating_income",
    "net_income",
    "total_assets",
    "equity",
    "operating_cash_flow",
    "investing_cash_flow",
)
PERCENT_METRICS = ("roe_pct",)
FACT_METRICS = MONEY_METRICS + PERCENT_METRICS
MONEY_UNIT = "JPY"
PERCENT_UNIT = "PERCENTAGE_POINT"

# Metrics shown on the statistics page.
STATS_METRICS = (
    Metric("revenue", "revenue", "売上高", "Revenue", "money", "百万円"),
    Metric("revenue_yoy_pct", "revenue_yoy_pct", "売上高YoY", "Revenue YoY", "percent", "%"),
    Metric("operating_income", "operating_income", "営業利益", "Operating income", "money", "百万円"),
    Metric("operating_margin_pct", "operating_margin_pct", "営業利益率", "Operating margin", "percent", "%"),
    Metric("roe_pct", "roe_pct", "ROE", "ROE", "percent", "%"),
    Metric("free_cash_flow", "free_cash_flow", "FCF", "Free cash flow", "money", "百万円"),
)

# Scatter plots of the statistics page.
SCATTERS = (
    Scatter(
        "growth-profitability",
        "成長率 × 営業利益率",
        "売上高の前年比成長率と、本業の収益性を比較します。",
        "revenue_yoy_pct",
        "operating_margin_pct",
    ),
    Scatter(
        "margin-return",
        "営業利益率 × ROE",
        "本業の収益性と、株主資本に対する利益効率を比較します。",
        "operating_margin_pct",
        "roe_pct",
    ),
    Scatter(
        "scale-cash",
        "売上高 × FCF",
        "企業規模と、投資後に残るキャッシュフローを比較します。",
        "revenue",
        "free_cash_flow",
        x_scale="log",
    ),
)

# What the statistics page shows when nothing valid was asked for.
DEFAULT_RANKING = "revenue"
DEFAULT_SCATTER = "growth-profitability"

# Charts of one company, each with two series.
COMPANY_CHARTS = {
    "profitability": ("money", (("revenue", "Revenue"), ("operating_income", "Op. income"))),
    "returns": ("percent", (("operating_margin_pct", "Op. margin"), ("roe_pct", "ROE"))),
    "cashflow": ("money", (("operating_cash_flow", "Operating CF"), ("free_cash_flow", "FCF"))),
}

# Charts of a compared pair, rows of the comparison table, and cards.
COMPARISON_CHARTS = {"revenue": "money", "operating_margin_pct": "percent", "free_cash_flow": "money"}
COMPARISON_ROWS = {
    "revenue": "money",
    "operating_income": "money",
    "net_income": "money",
    "operating_margin_pct": "percent",
    "roe_pct": "percent",
    "free_cash_flow": "money",
}
COMPANY_CARDS = {
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
