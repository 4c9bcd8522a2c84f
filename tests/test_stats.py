"""Golden statistics, and the large-group operators against brute force."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from yearbook.errors import YearbookError
from yearbook.operators import compare, ranking, series, stats, timeseries
from yearbook.operators.reshape import pivot_metrics, unpivot_facts
from yearbook.plans import statistics

COLUMNS = (
    "company_order int, ticker string, name string, fiscal_year int, revenue bigint, revenue_yoy_pct double, "
    "operating_income bigint, operating_margin_pct double, roe_pct double, free_cash_flow bigint, fetched_at timestamp"
)


@pytest.fixture(scope="module")
def mart(spark):
    """2030 has five companies: a tie of three, a missing value and a negative x."""
    early = [(i, f"{c}.X", c, 2029, 10**6, 1.0, 0, 0.0, 1.0, 0, None) for i, c in enumerate("abc")]
    late = [
        (0, "a.X", "a", 2030, 4_000_000, 7.5, 400_000, 10.0, 3.0, 900_000, None),
        (1, "b.X", "b", 2030, 9_500_000, -2.0, 1_900_000, 20.0, 6.0, -700_000, None),
        (2, "c.X", "c", 2030, 4_000_000, 0.5, -80_000, -2.0, None, 100_000, None),
        (3, "d.X", "d", 2030, None, None, 600_000, None, 12.0, 250_000, None),
        (4, "e.X", "e", 2030, 4_000_000, 3.25, 0, 0.0, -1.0, None, None),
    ]
    return spark.createDataFrame(early + late, COLUMNS)


def test_golden(mart):
    found = statistics.statistics(mart)
    assert [r.fiscal_year for r in found.periods.collect()] == [2030]
    revenue = found.descriptive.filter("metric = 'revenue'").first()
    # 4, 4, 4 and 9.5 million
    assert (revenue["count"], revenue.missing, revenue.mean, revenue.median) == (4, 1, 5.375, 4.0)
    assert (revenue.stddev, revenue.q1, revenue.q3, revenue["min"], revenue["max"]) == (2.75, 4.0, 5.375, 4.0, 9.5)
    ordered = ranking.order_ranking(found.rankings.filter("metric = 'revenue'"), statistics.GROUP, "company_order")
    assert [(r.ticker, r["rank"]) for r in ordered.collect()] == [("b.X", 1), ("a.X", 2), ("c.X", 2), ("e.X", 2), ("d.X", None)]
    counts = {r.scatter: (r.included_count, r.excluded_count) for r in found.scatter_counts.collect()}
    assert counts["growth-profitability"] == (4, 1) and counts["scale-cash"] == (3, 2)
    assert {(r.scatter, r.ticker) for r in found.exclusions.collect()} >= {("growth-profitability", "d.X"), ("scale-cash", "d.X"), ("scale-cash", "e.X")}


def test_header(mart):
    row = statistics.stats_header(mart).first()
    assert (row.default_year, row.years, row.default_ranking) == (2030, [2030], "revenue")


def test_no_common_period(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "entity string, period int")
    with pytest.raises(YearbookError):
        stats.require_common_periods(stats.common_periods(rows, "entity", "period"))


def test_selection(spark):
    periods = spark.createDataFrame([(2023,), (2024,)], "p int")
    pick = lambda wanted: stats.default_selection(periods, "p", wanted).first().p
    assert (pick(2023), pick(1999), pick(None)) == (2023, 2024, 2024)


def skewed(seed: int) -> pd.DataFrame:
    """One group with most rows, one value with a third of them, nulls, signs and tiny gaps."""
    rng = np.random.default_rng(seed)
    n = 6000
    value = np.round(rng.normal(0, 10.0 ** rng.integers(-6, 9, n)), 6)
    value[: n // 3] = 100.0
    value[n // 3 : n // 2] = 100.0 + rng.integers(0, 50, n // 2 - n // 3) * 1e-6
    frame = pd.DataFrame({"id": np.arange(n), "g": np.where(rng.random(n) < 0.8, "big", rng.choice(list("abc"), n)), "value": value})
    frame["value"] = frame["value"].astype(object).where(rng.random(n) > 0.1, None)
    return frame.sample(frac=1, random_state=seed)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rank_and_quantiles_against_pandas(spark, seed):
    frame = skewed(seed)
    df = spark.createDataFrame(frame, "id bigint, g string, value double").repartition(7)
    values = frame.assign(value=pd.to_numeric(frame["value"]))
    expected = values.assign(rank=values.groupby("g")["value"].rank(method="min", ascending=False)).set_index("id")["rank"]
    got = ranking.rank_metric(df, ["g"], "value").toPandas().set_index("id")["rank"]
    assert len(got) == len(expected)
    pd.testing.assert_series_equal(got.astype(float).sort_index(), expected.sort_index(), check_names=False)

    described = stats.describe_metrics(df, ["g"]).toPandas().set_index("g")
    for group, part in values.dropna().groupby("g"):
        for name, share in stats.QUARTILES.items():
            assert described.loc[group, name] == pytest.approx(part["value"].quantile(share), abs=1e-4)


def test_ranks_do_not_depend_on_row_order(spark):
    frame = skewed(9)
    a = spark.createDataFrame(frame, "id bigint, g string, value double").repartition(3)
    b = spark.createDataFrame(frame.sort_values("id"), "id bigint, g string, value double").coalesce(1)
    rank = lambda df: sorted(map(tuple, ranking.rank_metric(df, ["g"], "value").collect()))
    assert rank(a) == rank(b)


def test_single_value_and_empty_group(spark):
    df = spark.createDataFrame([("one", 5.0), ("none", None)], "g string, value double")
    rows = {r.g: r for r in stats.describe_metrics(df, ["g"]).collect()}
    assert (rows["one"]["count"], rows["one"].median, rows["one"].stddev) == (1, 5.0, None)
    assert (rows["none"]["count"], rows["none"].missing, rows["none"].median) == (0, 1, None)


def test_approximate_quantiles(spark):
    df = spark.range(1, 1002).select(F.lit("g").alias("g"), F.col("id").cast("double").alias("value"))
    row = stats.describe_metrics(df, ["g"], approx=True).first()
    assert abs(row.median - 501) <= 1 and abs(row.q1 - 251) <= 1


def parts_of(df) -> list[int]:
    """The sizes of the ranges that are sorted by themselves."""
    return [r["count"] for r in ranking.spread_values(df, ["g"], "value").groupBy("part").count().collect()]


@pytest.mark.parametrize("low, high", [(0.0, 0.0004), (1.7e9, 1.7e9 + 500_000), (-100.04, -100.0)])
def test_values_that_lie_close_are_spread(spark, low, high):
    """The ranges that are sorted by themselves are many and even, and the places are exact."""
    n = 60_000
    df = spark.range(n).select(F.lit("g").alias("g"), (F.lit(low) + F.col("id") * F.lit((high - low) / n)).alias("value"))
    positions = ranking.value_positions(df, ["g"], "value")
    assert [r.less for r in positions.orderBy("value").select("less").collect()] == list(range(n))
    sizes = parts_of(df)
    assert len(sizes) > 20 and max(sizes) < 4 * n / len(sizes)


@pytest.mark.parametrize("far", [100.0, 1000.0, 10_000.0, 1e300])
def test_one_far_value_does_not_crowd_the_others(spark, far):
    """Half a million values within a second, and one long after."""
    n = 500_000
    close = spark.range(n).select(F.lit("g").alias("g"), (1.7e9 + F.col("id") / n).alias("value"))
    df = close.union(spark.createDataFrame([("g", 1.7e9 + far), ("h", 1.0)], close.schema))
    sizes = parts_of(df)
    assert sum(sizes) == df.select("g", "value").distinct().count() and max(sizes) < 4 * sum(sizes) / len(sizes)


def test_groups_that_span_ranges_and_null_groups(spark):
    rows = [(g, float(v)) for g, n in (("a", 5000), (None, 300), ("b", 1)) for v in range(n)] + [("c", None), ("a", None), ("a", 7.0)]
    df = spark.createDataFrame(rows, "g string, value double").repartition(5)
    got = {(r.g, r.value): (r.ties, r.less, r.total) for r in ranking.value_positions(df, ["g"], "value").collect()}
    assert len(got) == 5301 and got["a", 7.0] == (2, 7, 5001) and got["a", 8.0] == (1, 9, 5001) and got[None, 299.0] == (1, 299, 300) and got["b", 0.0] == (1, 0, 1)
    described = {r.g: (r["count"], r.missing, r["max"]) for r in stats.describe_metrics(df, ["g"]).collect()}
    assert described == {"a": (5001, 1, 4999.0), None: (300, 0, 299.0), "b": (1, 0, 0.0), "c": (0, 1, None)}


def test_not_a_number_is_missing(spark):
    nan = float("nan")
    df = spark.createDataFrame([("g", 5.0), ("g", nan), ("g", 1.0), ("g", None)], "g string, value double")
    row = stats.describe_metrics(df, ["g"]).first()
    assert (row["count"], row.missing, row.mean, row.median, row["max"]) == (2, 2, 3.0, 3.0, 5.0)
    ranks = {str(r.value): r["rank"] for r in ranking.rank_metric(df, ["g"], "value").collect()}
    assert ranks == {"5.0": 1, "1.0": 2, "nan": None, "None": None}


def test_large_and_infinite_values(spark):
    large = spark.createDataFrame([("g", 1e23), ("g", 3e23)], "g string, value double")
    assert stats.describe_metrics(large, ["g"]).first().mean == 2e23
    infinite = spark.createDataFrame([("g", float("inf")), ("g", 1.0), ("g", float("-inf"))], "g string, value double")
    assert [r.value for r in ranking.value_positions(infinite, ["g"], "value").orderBy("less").collect()] == [float("-inf"), 1.0, float("inf")]
    with pytest.raises(Exception, match="no mean"):
        stats.describe_metrics(infinite, ["g"]).collect()


def test_pivot_undoes_unpivot(spark):
    rows = [(i, y, i * 10 + y, None if i % 2 else 1.5) for i in range(4) for y in range(3)]
    wide = spark.createDataFrame(rows, "k int, y int, revenue bigint, roe_pct double")
    back = pivot_metrics(unpivot_facts(wide, ["k", "y"], ["revenue", "roe_pct"]), ["k", "y"], ["revenue"], ["roe_pct"])
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, wide.collect()), key=repr)


def test_axis(spark):
    rows = [("zero", 0.0), ("up", 10.0), ("down", -10.0), ("empty", None)]
    df = spark.createDataFrame(rows, "chart string, value double")
    got = {r.chart: (r.axis_min, r.axis_max, r.has_data) for r in series.axis_domain(df, ["chart"]).collect()}
    assert got["zero"] == (-1.0, 1.16, True)
    assert got["up"] == (0.0, 10.8, True)
    assert got["down"] == (-10.8, 0.8, True)
    assert got["empty"] == (None, None, False)
    assert series.axis_ticks(series.axis_domain(df, ["chart"]), ["chart"]).count() == 15


def test_segments(spark):
    values = [1.0, 2.0, None, 3.0, None, 4.0, 5.0, 6.0]
    df = spark.createDataFrame([("e", i, v) for i, v in enumerate(values)], "e string, p int, v double")
    got = [tuple(r) for r in timeseries.segment_series(df, ["e"], "p", "v").orderBy("segment").collect()]
    assert got == [("e", 0, 1, 2, 1), ("e", 5, 7, 3, 2)]


def test_comparison_with_one_entity(spark):
    one = spark.createDataFrame([("a", 1)], "ticker string, place int")
    asked = spark.createDataFrame([(1, "a", "a"), (2, None, None)], "id int, left string, right string")
    got = compare.compare_defaults(asked, one, "ticker", "place").orderBy("id").collect()
    assert [(r.left, r.right) for r in got] == [("a", None), ("a", None)]
    with pytest.raises(YearbookError):
        compare.require_two(one)
    two = one.union(spark.createDataFrame([("b", 2)], one.schema))
    got = compare.compare_defaults(asked, compare.require_two(two), "ticker", "place").collect()
    assert {(r.left, r.right) for r in got} == {("a", "b")}
