"""What the read-only SQL surface lets through, and what it refuses."""

from __future__ import annotations

import pytest

from yearbook.errors import YearbookError
from yearbook.plans.sql import run_sql
from yearbook.sources import schemas


@pytest.fixture(scope="module")
def views(spark):
    for view, table in schemas.VIEWS.items():
        spark.createDataFrame([], schemas.WAREHOUSE[table]).createOrReplaceTempView(view)
    spark.createDataFrame([(1, "A.X", 2024, 5), (1, "A.X", 2025, 7), (2, "B.X", 2025, None)], "company_order int, ticker string, fiscal_year int, revenue bigint").selectExpr(
        "*", *[f"cast(null as {f.dataType.simpleString()}) as {f.name}" for f in spark.table("company_year_metrics").schema if f.name not in ("company_order", "ticker", "fiscal_year", "revenue")]
    ).createOrReplaceTempView("company_year_metrics")
    spark.range(3).createOrReplaceTempView("secret")
    spark.range(3).createOrReplaceGlobalTempView("secret_too")
    spark.udf.register("own_function", lambda x: x)
    yield spark
    spark.catalog.dropTempView("secret")
    spark.catalog.dropGlobalTempView("secret_too")
    for view in schemas.VIEWS:
        spark.catalog.dropTempView(view)


GOOD = {
    "SELECT ticker, sum(revenue) AS r FROM company_year_metrics GROUP BY ticker": 2,
    "SELECT * FROM Company_Year_Metrics WHERE fiscal_year > 2024;": 2,
    "WITH x AS (SELECT ticker, lag(revenue) OVER (PARTITION BY ticker ORDER BY fiscal_year) AS p FROM company_year_metrics), y AS (SELECT * FROM x WHERE p IS NOT NULL) SELECT * FROM y": 1,
    "SELECT m.ticker FROM company_year_metrics m LEFT JOIN companies c USING (ticker) WHERE EXISTS (SELECT 1 FROM company_year_metrics n WHERE n.ticker = m.ticker AND n.revenue > 6)": 2,
    "SELECT ticker, y FROM company_year_metrics LATERAL VIEW explode(array(1, 2)) t AS y": 6,
    "SELECT * FROM range(3) r, LATERAL explode(array(r.id)) AS t(z)": 3,
    "SELECT transform(array(1, 2), x -> x + 1) AS a, upper('b'), `lower`('C'), round(1.25, 1), date_add(current_date(), 1), try_divide(1, 0), parse_json('1'), luhn_check('18')": 1,
    "SELECT * FROM (VALUES (1), (2)) AS t(a) UNION ALL SELECT fiscal_year FROM company_year_metrics": 5,
    "FROM company_year_metrics |> WHERE revenue > 1 |> AGGREGATE count(*) AS n GROUP BY ticker": 1,
    "SELECT * FROM (SELECT ticker, fiscal_year, revenue FROM company_year_metrics) PIVOT (max(revenue) FOR fiscal_year IN (2024, 2025))": 2,
    "TABLE companies": 0,
    "SELECT 'java_method(1)' AS text -- reflect(": 1,
    "SELECT max(revenue) FILTER (WHERE fiscal_year = 2025), percentile_cont(0.5) WITHIN GROUP (ORDER BY revenue), bool_and(consolidated) FROM company_year_metrics": 1,
}


@pytest.mark.parametrize("text", GOOD)
def test_queries_run(views, text):
    assert run_sql(views, text).count() == GOOD[text]


METHODS = [
    "SELECT java_method/**/('java.lang.System','getProperty','user.name')",
    "SELECT reflect -- x\n('java.lang.System', 'lineSeparator')",
    "SELECT try_reflect/* */('java.lang.System', 'lineSeparator')",
    "SELECT `reflect`('java.lang.System', 'lineSeparator')",
    "SELECT system.builtin.java_method('java.lang.System', 'lineSeparator')",
    "SELECT IDENTIFIER('java_' || 'method')('java.lang.System', 'lineSeparator')",
    "SELECT ticker FROM company_year_metrics WHERE 'x' = (SELECT reflect('java.lang.System', 'lineSeparator'))",
    "WITH x AS (SELECT reflect('java.lang.System', 'lineSeparator') AS a) SELECT * FROM x",
    "SELECT transform(array('lineSeparator'), m -> java_method('java.lang.System', m))",
    "SELECT count(*) FROM company_year_metrics GROUP BY reflect('java.lang.System', 'lineSeparator')",
    "SELECT * FROM VALUES (reflect('java.lang.System', 'lineSeparator')) AS t(a)",
]
RELATIONS = [
    "SELECT * FROM secret", "SELECT * FROM global_temp.secret_too", "TABLE secret", "SELECT * FROM IDENTIFIER('sec' || 'ret')",
    "SELECT * FROM companies WHERE 1 IN (SELECT id FROM secret)", "SELECT * FROM (WITH secret AS (SELECT 1 AS id) SELECT * FROM secret) JOIN secret USING (id)",
    "SELECT * FROM parquet.`/etc`", "SELECT * FROM text.`/etc/passwd`", "SELECT * FROM default.companies", "SELECT * FROM sql_keywords()",
    "SELECT own_function(1)", "SELECT spark_catalog.default.own_function(1)", "DESCRIBE secret",
]


@pytest.mark.parametrize("text", METHODS + RELATIONS)
def test_methods_and_other_relations_are_refused(views, text):
    with pytest.raises(YearbookError):
        run_sql(views, text)
