"""Row-level rules over raw snapshots and dimension entries.

A rule is a column predicate. All rules of a row are evaluated in one projection
and give an array of ``(fiscal_year, field, rule, value)`` structs: no shuffle, no
second scan. Clean rows have an empty array. Only rules that compare rows with
each other (conflicts, missing or repeated entities) need a grouped job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from yearbook.errors import YearbookError
from yearbook.functions import variants as V
from yearbook.functions.text import normalize_name, stripped, ticker_slug
from yearbook.operators.compare import pair_periods
from yearbook.operators.snapshots import anti_missing_entity, flag_available, snapshot_conflicts
from yearbook.sources.schemas import DIM_COMPANIES

# Raw field behind each stored money metric. Equity comes from the
# shareholders' part, never from net assets.
MONEY_FIELDS = {
    "revenue": "revenue",
    "operating_income": "operating_income",
    "net_income": "net_income",
    "total_assets": "total_assets",
    "equity": "shareholders_equity",
    "operating_cash_flow": "cf_operating",
    "investing_cash_flow": "cf_investing",
}
RATIO_FIELDS = {"roe_pct": "roe_official"}
TEXT_FIELDS = ("doc_id", "edinet_filing_url")
SOURCE_FIELDS = ("doc_id", "submit_date", "edinet_filing_url")

# The raw contract.
ANNUAL = "annual"
PERIODS_PER_SNAPSHOT = 5
STATUSES = ("direct", "indirect")
CODE_PATTERN = r"^E[0-9]{5}\z"
PAIR_ID_PATTERN = r"^[a-z0-9][a-z0-9_-]*\z"

VIOLATION = "struct<fiscal_year:bigint,field:string,rule:string,value:string>"


def violation(rule: str, field: str, value: Column, year: Column | None = None) -> Column:
    return F.struct(
        (F.lit(None) if year is None else year).cast("bigint").alias("fiscal_year"),
        F.lit(field).alias("field"),
        F.lit(rule).alias("rule"),
        value.cast("string").alias("value"),
    )


def unless(ok: Column, broken: Column) -> Column:
    """The violation where ``ok`` is false or unknown, else null."""
    return F.when(~F.coalesce(ok, F.lit(False)), broken)


def _text(value: Column) -> Column:
    return F.to_json(value)


def data_rows(payload: Column) -> Column:
    """The period rows of a payload, in file order, as array of VARIANT."""
    return F.try_variant_get(payload, "$.data", "array<variant>")


def members(payload: Column, path: str, names: Sequence[str]) -> Column:
    """The rows of an array as structs of the named members, each a VARIANT or null where it
    is absent. A row that is no object is null. One pass over each row, whatever the number of names."""
    return F.try_variant_get(payload, path, f"array<{_members(names)}>")


def _members(names: Sequence[str]) -> str:
    return "struct<" + ", ".join(f"`{name}`: variant" for name in names) + ">"


def _snapshot_rules(n: int) -> list[Column]:
    """Rules of the document as a whole, over the columns ``check_snapshots`` prepares."""
    is_root = F.col("_document").isNotNull()
    shaped = F.col("_document.data").isNotNull() & F.col("_document.meta").isNotNull()
    years = F.array_compact(F.transform("_rows", lambda r: r["year"]))
    return [
        unless(F.col("fetched_at").isNotNull(), violation("snapshot_time", "file_name", F.col("file_name"))),
        unless(is_root, violation("decode", "payload", F.lit(None))),
        F.when(is_root, unless(shaped, violation("root", "data/meta", F.lit(None)))),
        F.when(
            shaped,
            unless(
                V.scalar_is_text(F.col("_code")) & (F.col("_code_text") == F.col("edinet_code")),
                violation("code_match", "meta.edinet_code", _text(F.col("_code.value"))),
            ),
        ),
        F.when(
            shaped,
            unless(
                V.scalar_is_text(F.col("_period")) & (F.col("_period_text") == ANNUAL),
                violation("period_kind", "meta.period", _text(F.col("_period.value"))),
            ),
        ),
        F.when(shaped, unless(F.size("_rows") == n, violation("row_count", "data", F.size("_rows")))),
        F.when(
            shaped,
            unless(
                F.size(F.array_distinct(years)) == F.size(years),
                violation("year_unique", "fiscal_year", F.to_json(years)),
            ),
        ),
    ]


CHECKED_FIELDS = (*MONEY_FIELDS.values(), *RATIO_FIELDS.values(), *TEXT_FIELDS, "fiscal_year")

# Members by rule: their names, the test of a scalar, the name of the rule.
FIELD_RULES = (
    (tuple(MONEY_FIELDS.values()), V.scalar_is_money, "money"),
    (tuple(RATIO_FIELDS.values()), V.scalar_is_ratio, "ratio"),
    (TEXT_FIELDS, V.scalar_is_optional_text, "optional_string"),
)

# What ``check_snapshots`` looks at, taken out of the payload in one pass.
DOCUMENT = f"struct<data: array<{_members(CHECKED_FIELDS)}>, meta: {_members(('edinet_code', 'period'))}>"


def _with_year(fields: Column) -> Column:
    year = fields["fiscal_year"]
    # null, and so a violation, where the stored type cannot hold it
    value = F.when(V.token(year) == "BIGINT", F.try_variant_get(year, "$", "int").cast("bigint"))
    return F.struct(value.alias("year"), fields.alias("f"))


def _is_clean(row: Column) -> Column:
    """Whether a row breaks no rule."""
    fields, clean = row["f"], row["f"].isNotNull() & row["year"].isNotNull()
    for names, check, rule in FIELD_RULES:
        for name in names:
            passed = check(V.scalar(fields[name]))
            clean = clean & (V.is_plain_money(fields[name]) | passed if rule == "money" else passed)
    return clean


def _row_rules(row: Column, position: Column) -> list[Column]:
    fields, year = row["f"], row["year"]
    whole = fields.isNotNull()
    rules = [
        unless(whole, violation("row_object", "data", _text(F.get(data_rows(F.col("payload")), position)))),
        F.when(
            whole & year.isNull(),
            violation("year_type", "fiscal_year", _text(fields["fiscal_year"])),
        ),
    ]
    for names, check, rule in FIELD_RULES:
        for name in names:
            broken = violation(rule, name, _text(fields[name]), year)
            rules.append(F.when(whole & ~check(V.scalar(fields[name])), broken))
    return rules


def check_snapshots(decoded: DataFrame, periods: int = PERIODS_PER_SNAPSHOT) -> DataFrame:
    """Add a ``violations`` array to decoded snapshots; empty means accepted.

    Expects ``payload``, ``edinet_code``, ``fetched_at`` and ``file_name``. The payload
    is read once; the rules work on the extracted parts. A period row is first asked
    whether it is clean; the violations of each rule are made for the others only.
    """
    document, meta = F.col("_document"), F.col("_document.meta")
    nothing = F.array().cast(f"array<{VIOLATION}>")
    parts = decoded.withColumn("_document", F.try_variant_get("payload", "$", DOCUMENT)).withColumns(
        {
            "_code": V.scalar(meta["edinet_code"]),
            "_code_text": F.try_variant_get(meta["edinet_code"], "$", "string"),
            "_period": V.scalar(meta["period"]),
            "_period_text": F.try_variant_get(meta["period"], "$", "string"),
            "_rows": F.transform(document["data"], _with_year),
        }
    )
    of_snapshot = F.array_compact(F.array(*_snapshot_rules(periods)))
    of_rows = F.flatten(
        F.transform("_rows", lambda r, i: F.when(_is_clean(r), nothing).otherwise(F.array_compact(F.array(*_row_rules(r, i)))))
    )
    found = F.concat(of_snapshot, F.coalesce(of_rows, nothing))
    # The one-element generator keeps a later filter on the result above it. Pushed
    # down, the filter would carry a copy of every rule and parse the JSON for each.
    return parts.select(*decoded.columns, F.explode_outer(F.array(found)).alias("violations"))


def list_violations(checked: DataFrame, keys: Sequence[str] = ("raw_file", "ticker")) -> DataFrame:
    """Quarantine rows ``(*keys, fiscal_year, field, rule, value)``."""
    # The outer form, because Spark copies the input of the plain one into a filter.
    return checked.select(*keys, F.inline_outer("violations")).filter(F.col("rule").isNotNull())


def accepted(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("violations") == 0).drop("violations")


def require_clean(violations: DataFrame, what: str, shown: int = 5) -> None:
    """Gate: raise if there is any violation. Reads at most ``shown`` rows."""
    found = violations.limit(shown).collect()
    if found:
        examples = "; ".join(str(row.asDict()) for row in found)
        raise YearbookError(f"{what}: {examples}")


def require_nonempty(df: DataFrame, what: str) -> DataFrame:
    """Gate: raise if there is no row."""
    if df.isEmpty():
        raise YearbookError(f"{what} is empty")
    return df


def check_snapshot_conflict(snapshots: DataFrame) -> DataFrame:
    """The same entity and fetch time with different contents."""
    found = snapshot_conflicts(snapshots, ["ticker", "fetched_at"], "sha256")
    return found.select(
        F.lit(None).cast("string").alias("raw_file"),
        "ticker",
        F.inline(
            F.array(
                violation("snapshot_conflict", "sha256", F.concat_ws(" / ", "lowest_hash", "highest_hash"))
            )
        ),
    )


def check_missing_entities(companies: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Direct entities without a snapshot, in dimension order."""
    direct = companies.filter(F.col("status") == "direct").select("company_order", "ticker")
    return anti_missing_entity(direct, snapshots, "ticker")


def company_rules(meta: Column, ticker: Column) -> list[Column]:
    name, code = V.field(meta, "$.name"), V.field(meta, "$.edinet_code")
    status = V.field(meta, "$.status")
    salary, salary_year = V.field(meta, "$.avg_salary_man"), V.field(meta, "$.avg_salary_fiscal_year")
    stored = StructType.fromDDL(DIM_COMPANIES)  # what the dimension can hold
    whole = V.is_object(meta)
    checks = [
        (F.length(stripped(V.as_text(name))) > 0, "name", "name", name),
        (V.as_text(code).rlike(CODE_PATTERN), "code", "edinet_code", code),
        (status.isNull() | V.as_text(status).isin(*STATUSES), "status", "status", status),
        (V.is_missing(salary) | V.fits(salary, stored["avg_salary_man"].dataType), "salary", "avg_salary_man", salary),
        (V.is_missing(salary_year) | V.fits(salary_year, stored["avg_salary_fiscal_year"].dataType), "salary_year", "avg_salary_fiscal_year", salary_year),
    ]
    return [
        unless(whole, violation("company_object", "company", _text(meta))),
        unless(ticker_slug(ticker).isNotNull(), violation("slug", "ticker", ticker)),
        *[F.when(whole, unless(ok, violation(rule, field, _text(value)))) for ok, rule, field, value in checks],
    ]


def check_companies(entries: DataFrame) -> DataFrame:
    """Add a ``violations`` array to dimension entries ``(company_order, ticker, meta)``."""
    rules = company_rules(F.col("meta"), F.col("ticker"))
    return entries.withColumn("violations", F.array_compact(F.array(*rules)))


def check_unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values that occur more than once in any of ``columns``: ``(field, value, occurrences)``.

    One job for all columns, counted before the shuffle.
    """
    typed = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    long = typed.unpivot([], list(columns), "field", "value").filter(F.col("value").isNotNull())
    return long.groupBy("field", "value").agg(F.count("*").alias("occurrences")).filter("occurrences > 1")


def check_slug_match(snapshots: DataFrame, companies: DataFrame) -> DataFrame:
    """Snapshots whose file-name slug differs from the slug of their ticker."""
    slugs = companies.select("ticker", ticker_slug(F.col("ticker")).alias("expected_slug"))
    return snapshots.join(slugs, "ticker", "left").filter(~F.col("slug").eqNullSafe(F.col("expected_slug")))


def check_comparisons(pairs: DataFrame, mart: DataFrame, entity: str = "ticker", period: str = "fiscal_year") -> DataFrame:
    """Broken pairs as ``(id, left, right, rule)``; every broken rule gives a row.

    Expects pairs from ``scan_comparisons``: ``id``, ``left`` and ``right`` are null
    where the configuration does not hold a string.
    """
    known = mart.select(entity).distinct()
    placed = pairs
    repeated = pairs.groupBy("id").agg(F.count("*").alias("uses"))
    shared = pair_periods(placed.filter("left is not null and right is not null"), mart, entity, period, "pair_order")
    shared = shared.select("pair_order", "periods")
    for side in ("left", "right"):
        placed = flag_available(placed, known.withColumnRenamed(entity, side), side, f"{side}_known")
    placed = placed.join(repeated, "id", "left").join(shared, "pair_order", "left")
    strings = F.col("left").isNotNull() & F.col("right").isNotNull()
    both_known = F.col("left_known") & F.col("right_known")
    differs = strings & (F.col("left") != F.col("right"))
    rules = F.array_compact(
        F.array(
            unless(F.col("id").rlike(PAIR_ID_PATTERN), F.lit("id_pattern")),
            F.when(F.col("uses") > 1, F.lit("id_repeated")),
            unless(strings, F.lit("sides")),
            F.when(strings & (F.col("left") == F.col("right")), F.lit("same_entity")),
            F.when(differs & ~both_known, F.lit("unknown_entity")),
            F.when(differs & both_known & (F.coalesce(F.col("periods"), F.lit(0)) == 0), F.lit("no_common_period")),
        )
    )
    return placed.select("id", "left", "right", F.explode(rules).alias("rule"))


def match_entity_exact(
    candidates: DataFrame, sec_code: str, name: str, edinet_code: str
) -> DataFrame:
    """Gate: the one search hit with this code, whose name and code agree.

    Reads at most two rows: none, one or several hits is all that matters.
    """
    shown = F.coalesce(F.nullif(F.col("name_ja"), F.lit("")), F.col("name"))
    hits = candidates.filter(F.col("sec_code") == sec_code)
    agreed = (normalize_name(shown) == name) & (F.col("edinet_code") == edinet_code)
    found = hits.select(F.coalesce(agreed, F.lit(False)).alias("agreed")).limit(2).collect()
    if len(found) != 1:
        raise YearbookError(f"code {sec_code}: {'no' if not found else 'more than one'} exact match")
    if not found[0].agreed:
        raise YearbookError(f"code {sec_code}: name or entity code differs")
    return hits
