"""Queries that write files as the outside world does, or as a build does, and read them
back through the operators.

Nations play the companies. Spark sums their orders by year into the bodies of two snapshots each,
so the work follows the orders; the files are few, as a nation has two. Region 4 has files
but files none of its own (``indirect``), and nation 3 has none at all.
"""

from __future__ import annotations

import functools
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearbook import sinks
from yearbook.catalog import tables as T
from yearbook.catalog.registry import query
from yearbook.functions.numeric import hundredths
from yearbook.functions.text import iso_utc
from yearbook.operators import quality
from yearbook.plans.build import BuildConfig, build, load_companies
from yearbook.plans.sql import run_sql
from yearbook.session import checkpoint_dir, create_exclusively, temporary
from yearbook.sources import companies as C
from yearbook.sources import snapshots as S
from yearbook.sources import warehouse as W
from yearbook.sources.schemas import RAW_LANDING

STAMPS = ("20020115T000000Z", "20030115T000000Z")
PERIODS = quality.PERIODS_PER_SNAPSHOT


def nation_bodies(spark: SparkSession, sf: str) -> DataFrame:
    """``(nation, slug, snapshot, body)``: JSON of five years, the second two years later."""
    orders = T.table(spark, sf, "orders")
    cents = hundredths(F.col("o_totalprice"))

    def where(condition, sign: int = 1):
        return F.sum(F.when(condition, cents * sign))

    placed = orders.join(T.table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    years = placed.groupBy(F.col("c_nationkey").alias("nation"), F.year("o_orderdate").alias("year")).agg(
        F.sum(cents).alias("revenue"),
        where(F.col("o_orderstatus") == "F").alias("operating_income"),
        where(F.col("o_orderstatus") == "O").alias("net_income"),
        F.count("*").alias("total_assets"),
        F.sum("o_custkey").alias("shareholders_equity"),
        where(F.col("o_orderpriority") == "1-URGENT").alias("cf_operating"),
        where(F.col("o_orderpriority") == "5-LOW", -1).alias("cf_investing"),
    )
    first = orders.agg(F.min(F.year("o_orderdate"))).scalar()
    nations = T.table(spark, sf, "nation").filter("n_nationkey <> 3").withColumn("first", first)
    grid = nations.select(
        F.col("n_nationkey").alias("nation"), F.lower("n_name").alias("slug"), "first", F.explode(F.sequence(F.lit(0), F.lit(len(STAMPS) - 1))).alias("snapshot")
    ).withColumn("year", F.explode(F.expr(f"sequence(first + 2 * snapshot, first + 2 * snapshot + {PERIODS - 1})")))
    money = ("revenue", "operating_income", "net_income", "total_assets", "shareholders_equity", "cf_operating", "cf_investing")
    standard = F.when(F.col("nation") % 3 == 0, '"JP"').when(F.col("nation") % 3 == 1, '"IFRS"').otherwise("null")
    ratio = F.concat(F.lit("0."), F.lpad((F.col("total_assets") % 1000).cast("string"), 3, "0"))
    text = F.concat(
        F.lit('{"fiscal_year": '), F.col("year").cast("string"), F.lit(', "accounting_standard": '), standard,
        *[part for name in money for part in (F.lit(f', "{name}": '), F.coalesce(F.col(name).cast("string"), F.lit("null")))],
        F.lit(', "roe_official": '), F.coalesce(ratio, F.lit("null")),
        F.lit(', "doc_id": "N'), F.col("nation").cast("string"), F.lit("-"), F.col("year").cast("string"),
        F.lit('", "submit_date": "'), (F.col("year") + 1).cast("string"), F.lit('-06-30 15:00", "edinet_filing_url": null}'),
    )
    rows = grid.join(years, ["nation", "year"], "left").withColumn("row", text)
    body = F.concat(
        F.lit('{"data": ['),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("year", "row"))), lambda r: r["row"]), ", "),
        F.lit('], "meta": {"edinet_code": "E'),
        F.lpad(F.col("nation").cast("string"), 5, "0"),
        F.lit('", "period": "annual"}}'),
    )
    return rows.groupBy("nation", "slug", "snapshot").agg(body.alias("body"))


@functools.lru_cache
def _written(spark: SparkSession, application: str, sf: str) -> str:
    """The folder of the files, written once for each application: raw snapshots, the
    company file, the pairs."""
    folder = temporary(spark, f"{checkpoint_dir(spark)}/yearbook-files-{uuid.uuid4().hex}")
    for row in nation_bodies(spark, sf).toLocalIterator():
        create_exclusively(spark, f"{folder}/raw/{row.slug}__financials__{STAMPS[row.snapshot]}.json", row.body)
    create_exclusively(spark, f"{folder}/raw/nation_0__financials__notes.json", "not a snapshot")
    nations = T.table(spark, sf, "nation").orderBy(F.desc("n_nationkey")).collect()  # a fixed small table
    entries = {
        n.n_name: {
            "name": n.n_name, "edinet_code": f"E{n.n_nationkey:05}", "status": "indirect" if n.n_regionkey == 4 else "direct",
            "tier": n.n_nationkey, "avg_salary_man": n.n_nationkey + 0.5, "avg_salary_fiscal_year": 2000 + n.n_nationkey,
        }
        for n in nations
    }
    create_exclusively(spark, f"{folder}/companies.json", json.dumps(entries))
    create_exclusively(spark, f"{folder}/blank.json", "  \n")
    direct = [n.n_name for n in nations if n.n_regionkey != 4 and n.n_nationkey != 3]
    pairs = [{"id": f"pair-{i}", "left": a, "right": b} for i, (a, b) in enumerate(zip(direct[:-1], direct[1:], strict=True))]
    create_exclusively(spark, f"{folder}/pairs.json", json.dumps({"schema_version": "1.0", "pairs": pairs}))
    return folder


def files(spark: SparkSession, sf: str) -> str:
    return _written(spark, spark.sparkContext.applicationId, sf)


@functools.lru_cache
def _published(spark: SparkSession, application: str, sf: str) -> str:
    folder = files(spark, sf)
    build(spark, BuildConfig(f"{folder}/companies.json", f"{folder}/raw", f"{folder}/warehouse", "first", f"{folder}/pairs.json", allow_missing=True))
    return W.published_path(spark, f"{folder}/warehouse")


def published(spark: SparkSession, sf: str) -> str:
    """The folder of a published build of the files; it passed ``check_complete``."""
    return _published(spark, spark.sparkContext.applicationId, sf)


def _companies(spark: SparkSession, sf: str) -> DataFrame:
    return load_companies(spark, f"{files(spark, sf)}/companies.json")


def _file_name(column: str):
    return F.element_at(F.split(column, "/"), -1)


# Sources -------------------------------------------------------------------------


def _shown(snapshots: DataFrame) -> DataFrame:
    return snapshots.select(
        "ticker", "slug", "edinet_code", "file_name", iso_utc(F.col("fetched_at")).alias("fetched_at"), "sha256", F.octet_length("content").alias("bytes")
    )


@query
def scan_snapshots(spark, sf):
    return _shown(S.scan_snapshots(spark, f"{files(spark, sf)}/raw", _companies(spark, sf)))


@query
def snapshot_fingerprint(spark, sf):
    bodies = nation_bodies(spark, sf)
    return bodies.select("nation", "snapshot", S.snapshot_fingerprint(F.col("body").cast("binary")).alias("sha256"))


@query
def scan_latest_snapshots(spark, sf):
    return _shown(S.scan_latest_snapshots(spark, f"{files(spark, sf)}/raw", _companies(spark, sf), paths_per_read=7))


@query
def scan_explicit_inputs(spark, sf):
    direct = _companies(spark, sf).filter("status = 'direct' and ticker <> 'NATION_3'").select("slug").collect()  # of a fixed small table
    paths = [f"{files(spark, sf)}/raw/{r.slug}__financials__{STAMPS[0]}.json" for r in direct]
    return _shown(S.scan_explicit_inputs(spark, paths, _companies(spark, sf)))


@query
def scan_companies(spark, sf):
    entries = C.scan_companies(spark, f"{files(spark, sf)}/companies.json")
    return entries.select("company_order", "ticker", F.variant_get("meta", "$.edinet_code", "string").alias("edinet_code"))


@query
def build_dimension(spark, sf):
    return C.build_dimension(_companies(spark, sf))


@query
def scan_fallback(spark, sf):
    folder = files(spark, sf)
    found = C.scan_fallback(spark, [f"{folder}/absent.json", f"{folder}/blank.json", f"{folder}/companies.json", f"{folder}/pairs.json"])
    return found.select("company_order", "ticker")


@query
def scan_comparisons(spark, sf):
    return C.scan_comparisons(spark, f"{files(spark, sf)}/pairs.json")


@query
def land_raw(spark, sf):
    """Both snapshots landed one after the other, and read as snapshots."""
    path = temporary(spark, f"{checkpoint_dir(spark)}/yearbook-landing-{uuid.uuid4().hex}")
    bodies = nation_bodies(spark, sf)
    for i, stamp in enumerate(STAMPS):
        at = F.to_timestamp(F.lit(stamp), S.TIME_FORMAT).alias("fetched_at")
        sinks.land_raw(bodies.filter(F.col("snapshot") == i).select("slug", F.lit("financials").alias("kind"), at, F.col("body").cast("binary").alias("body")), path)
    landed = spark.read.schema(RAW_LANDING).parquet(path).agg(F.count("*").alias("landed"))
    return _shown(S.scan_landed(spark, path, _companies(spark, sf))).withColumn("landed", landed.scalar())


# A published build ---------------------------------------------------------------


@query
def scan_warehouse(spark, sf):
    history = W.scan_warehouse(spark, published(spark, sf))["financial_history"]
    return history.withColumn("raw_file", _file_name("raw_file"))


@query
def stored_sources(spark, sf):
    return W.scan_table(spark, published(spark, sf), "source_documents_history").withColumn("raw_file", _file_name("raw_file"))


@query
def write_mart(spark, sf):
    """The stored mart and the order of its rows in files: a range of companies in each."""
    mart = W.scan_table(spark, published(spark, sf), "company_year_metrics")
    return mart


@query
def scan_mart(spark, sf):
    return W.scan_mart(spark, published(spark, sf)).select("company_order", "fiscal_year", "ticker", "revenue")


def _lines(spark, sf, name: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(f"{published(spark, sf)}/{name}")


@query
def write_company_documents(spark, sf):
    period = "struct<fiscal_year: int, metrics: struct<revenue: bigint, roe_pct: double>, calculated_metrics: struct<revenue_yoy_pct: double>, source_document: struct<document_id: string, filed_at: string>, fetched_at: string>"
    found = _lines(spark, sf, "financials", f"ticker string, edinet_code string, periods array<{period}>")
    rows = found.select("ticker", "edinet_code", F.posexplode("periods").alias("place", "p"))
    return rows.select(
        "ticker", "edinet_code", "place", "p.fiscal_year", "p.metrics.revenue", "p.metrics.roe_pct", "p.calculated_metrics.revenue_yoy_pct",
        "p.source_document.document_id", "p.source_document.filed_at", "p.fetched_at",
    )


@query
def write_stats_documents(spark, sf):
    names = ("mean", "median", "stddev", "min", "q1", "q3", "max")
    schema = "fiscal_year int, metric string, count bigint, missing bigint, " + ", ".join(f"{n} double" for n in names)
    return _lines(spark, sf, "stats_descriptive", schema)


@query
def write_ranking(spark, sf):
    return _lines(spark, sf, "stats_ranking", "fiscal_year int, metric string, ticker string, name string, rank bigint, value double")


@query
def write_manifest(spark, sf):
    counts = ("snapshot_count", "financial_fact_count", "source_document_count", "latest_company_year_count")
    manifest = _lines(spark, sf, "build_manifest", "schema_version string, generated_at string, " + ", ".join(f"{c} bigint" for c in counts))
    missing = _lines(spark, sf, "missing_tickers", "ticker string")
    return manifest.withColumn("missing_ticker", missing.agg(F.max("ticker")).scalar())


@query
def write_lineage(spark, sf):
    inputs = _lines(spark, sf, "raw_inputs", "ticker string, raw_file string, fetched_at string, sha256 string")
    return inputs.withColumn("raw_file", _file_name("raw_file"))


@query
def publish_staged(spark, sf):
    """Two builds published over the same folder: the later one is read, each has its number."""
    base = temporary(spark, f"{checkpoint_dir(spark)}/yearbook-published-{uuid.uuid4().hex}")
    history = W.scan_table(spark, published(spark, sf), "financial_history")
    for build_id, years in (("early", "fiscal_year < 1998"), ("late", "fiscal_year >= 1998")):
        counted = history.filter(years).groupBy("metric_name").agg(F.count("*").alias("facts"))
        sinks.write_table(counted, f"{base}/v={build_id}/facts", "metric_name string, facts bigint")
        sinks.check_complete(spark, f"{base}/v={build_id}", {"facts": "metric_name string, facts bigint"}, {"facts": counted.count()})
        number = sinks.publish_staged(spark, base, build_id)
    return spark.read.parquet(f"{W.published_path(spark, base)}/facts").withColumn("number", F.lit(number))


@query
def export_tsv(spark, sf):
    """SQL over the published views, written as text and read back."""
    W.register_views(spark, published(spark, sf))
    path = temporary(spark, f"{checkpoint_dir(spark)}/yearbook-tsv-{uuid.uuid4().hex}")
    sinks.export_tsv(run_sql(spark, "SELECT ticker, fiscal_year, revenue, revenue_yoy_pct FROM company_year_metrics"), path)
    return spark.read.schema("ticker string, fiscal_year bigint, revenue bigint, revenue_yoy_pct double").csv(path, sep="\t", header=True)


# Gates ---------------------------------------------------------------------------


@query
def match_entity_exact(spark, sf):
    """Suppliers as search hits; one has the code and the name, written full-width."""
    wide = str.maketrans({chr(c): chr(c + 0xFEE0) for c in range(0x21, 0x7F)})
    candidates = T.table(spark, sf, "supplier").select(
        F.lit("other").alias("name"),
        F.when(F.col("s_suppkey") == 7, F.concat(F.lit(" "), F.translate("s_name", "Suplier#", "Suplier#".translate(wide)))).otherwise(F.lit("")).alias("name_ja"),
        (F.col("s_suppkey") * 10).cast("string").alias("sec_code"),
        F.concat(F.lit("E"), F.lpad(F.col("s_suppkey").cast("string"), 5, "0")).alias("edinet_code"),
    )
    found = quality.match_entity_exact(candidates, "70", "Supplier#000000007", "E00007")
    return found.select("sec_code", "edinet_code")


@query
def check_nonempty(spark, sf):
    return quality.require_nonempty(W.scan_table(spark, published(spark, sf), "dim_companies"), "the dimension").select("ticker")


@query
def check_snapshot_time(spark, sf):
    """Documents whose file names have an impossible date, by order key."""
    documents = T.raw_documents(spark, sf).filter("file_name is not null")
    day = F.when(F.col("raw_file").endswith("7"), "20010230").otherwise("20010228")
    named = documents.withColumn("file_name", F.concat(F.lit("c__financials__"), day, F.lit("T000000Z.json")))
    decoded = S.decode_snapshot(named.withColumn("fetched_at", S.parse_fetched_at(F.col("file_name"))))
    return quality.list_violations(quality.check_snapshots(decoded)).filter("rule = 'snapshot_time'").select("raw_file", "field", "value")
