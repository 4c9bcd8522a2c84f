from __future__ import annotations

import datetime
import json

import pytest
from pyspark.sql import functions as F

from yearbook.functions import numeric, ratios, text
from yearbook.functions import variants as V
from yearbook.sources.snapshots import parse_fetched_at, parse_slug


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def money(value):
    return F.lit(value).cast("bigint")


@pytest.mark.parametrize(
    "current, previous, expected",
    [(110, 100, 10.0), (90, 100, -10.0), (50, -100, -150.0), (100, 0, None), (None, 100, None), (100, None, None), (100, 100, 0.0)],
)
def test_yoy(spark, current, previous, expected):
    assert one(spark, ratios.revenue_yoy(money(current), money(previous))) == expected


@pytest.mark.parametrize("income, revenue, expected", [(-10, 100, -10.0), (1, 3, 33.3333), (5, 0, None), (None, 5, None), (5, None, None)])
def test_margin(spark, income, revenue, expected):
    assert one(spark, ratios.operating_margin(money(income), money(revenue))) == expected


@pytest.mark.parametrize("operating, investing, expected", [(100, -30, 70), (100, 30, 130), (None, 1, None), (1, None, None)])
def test_free_cash_flow(spark, operating, investing, expected):
    assert one(spark, ratios.free_cash_flow(money(operating), money(investing))) == expected


@pytest.mark.parametrize(
    "current, start, expected",
    [(133100, 100000, 10.0), (0, 100, -100.0), (100, 0, None), (100, -1, None), (-1, 100, None), (None, 1, None), (1, None, None)],
)
def test_cagr(spark, current, start, expected):
    assert one(spark, ratios.revenue_cagr(money(current), money(start))) == expected


def test_rounding(spark):
    assert one(spark, numeric.round4(F.lit(0.00005))) == 0.0001
    assert str(one(spark, numeric.round4(F.lit(-0.00001)))) == "0.0"
    assert one(spark, numeric.whole(F.lit("2.5").cast("decimal(38,4)"))) == 3
    assert one(spark, numeric.whole(F.lit("-2.5").cast("decimal(38,4)"))) == -3


@pytest.mark.parametrize(
    "token, ok",
    [("100", True), ("100.0", True), ("1e3", True), ("null", True), ("-5", True), ("1.5", False), ('"100"', False),
     ("true", False), ("1e400", False), ("[1]", False), ("123456789012345678901", False), ("9000000000000000000", True), ("1e35", False), ("1.00001", False)],
)
def test_money_tokens(spark, token, ok):
    value = V.field(V.decode_json(F.lit('{"v": %s}' % token)), "$.v")
    assert one(spark, V.is_money(value)) is ok


@pytest.mark.parametrize("token, ok", [("2021", True), ("2021.0", False), ("true", False), ('"2021"', False), ("null", False), ("2e3", False)])
def test_integer_tokens(spark, token, ok):
    assert one(spark, V.is_integer(V.field(V.decode_json(F.lit('{"v": %s}' % token)), "$.v"))) is ok


def test_decoding(spark):
    assert one(spark, V.decode_json(F.lit("{bad")).isNull())
    assert one(spark, V.decode_json(F.unhex(F.lit("ff"))).isNull())
    assert one(spark, V.decode_json(F.lit('{"a": NaN}')).isNull())
    twice = V.as_double(V.field(V.decode_json(F.lit('{"a": 1, "a": 2}')), "$.a"))
    assert one(spark, twice) == 2.0


def test_money_is_exact(spark):
    big = V.field(V.decode_json(F.lit('{"v": 9007199254740993}')), "$.v")
    assert int(one(spark, V.normalize_money(big))) == 9007199254740993


def test_names_of_files(spark):
    good = F.lit("1111_t__financials__20260722T010203Z.json")
    assert one(spark, parse_slug(good)) == "1111_t"
    assert one(spark, text.iso_utc(parse_fetched_at(good))) == "2026-07-22T01:02:03Z"
    assert one(spark, parse_fetched_at(F.lit("1111_t__financials__20260230T000000Z.json"))) is None
    assert one(spark, parse_slug(F.lit("Bad__financials__20260722T010203Z.json"))) is None
    assert one(spark, parse_slug(F.lit("1111_t__financials__20260722.json"))) is None


@pytest.mark.parametrize("raw, slug", [("3092.T", "3092_t"), ("--A  b--", "a_b"), ("...", None)])
def test_slug(spark, raw, slug):
    assert one(spark, text.ticker_slug(F.lit(raw))) == slug


@pytest.mark.parametrize(
    "raw, code", [("JP", "JGAAP"), ("JP_GAAP", "JGAAP"), ("IFRS", "IFRS"), ("US", "USGAAP"), ("US_GAAP", "USGAAP"), ("X", "UNKNOWN"), (None, "UNKNOWN")]
)
def test_standard(spark, raw, code):
    assert one(spark, text.normalize_standard(F.lit(raw).cast("string"))) == code


def test_filed_at(spark):
    assert one(spark, text.normalize_filed_at(F.lit("2026-06-18 15:00"))) == datetime.date(2026, 6, 18)
    for bad in ("2026-06-18", "2026-06-18 15:00:01", "2026-02-30 15:00", "n/a"):
        assert one(spark, text.normalize_filed_at(F.lit(bad))) is None


def test_full_width_name(spark):
    assert one(spark, text.normalize_name(F.lit("　株式会社ＡＢＣ１２ "))) == "株式会社ABC12"


def test_display(spark):
    assert one(spark, text.format_millions(money(228373 * 10**6))) == "228,373"
    assert one(spark, text.format_millions(money(None))) == "—"
    assert one(spark, text.format_percent(F.lit(30.374))) == "30.37%"
    assert one(spark, text.format_percent(F.lit(30.0))) == "30%"
    assert one(spark, text.format_stat(F.lit(1234.5), F.lit("money"))) == "1,234.5"
    assert one(spark, text.format_compact(F.lit(2_500_000.0))) == "2.5T"
    assert one(spark, text.format_compact(F.lit(-1250.0))) == "-1.2B"
    assert one(spark, text.format_compact(F.lit(999.0))) == "999"
    assert one(spark, text.fiscal_label(F.lit(2026))) == "FY26"
    assert one(spark, text.to_japan_time(F.lit("2026-07-21 23:40:06").cast("timestamp"))) == "2026/07/22 8:40"
    assert one(spark, text.format_date_slash(F.lit(None).cast("date"))) == "—"
    assert json.loads(one(spark, F.to_json(F.struct(F.lit(1.0).alias("x")))))["x"] == 1.0


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/St_Johns"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        names = spark.createDataFrame([("a__financials__20260308T023000Z.json",), ("a__financials__20261399T000000Z.json",)], "n string")
        at = names.select(parse_fetched_at(F.col("n")).alias("at"))
        got = at.select(F.unix_seconds("at").alias("s"), text.iso_utc(F.col("at")).alias("iso"), text.utc_stamp(F.col("at")).alias("stamp")).collect()
        assert [tuple(r) for r in got] == [(1772937000, "2026-03-08T02:30:00Z", "20260308T023000Z"), (None, None, None)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_blank_names_are_stripped(spark):
    names = [" a ", "　a\t", " a\x1f", "　", "\t", "a\n"]
    got = spark.createDataFrame([(n,) for n in names], "n string").select(text.stripped(F.col("n")).alias("n")).collect()
    assert [r.n for r in got] == [n.strip() for n in names]
