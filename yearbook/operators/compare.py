"""Two entities side by side, for any number of configured pairs at once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearbook.errors import YearbookError
from yearbook.functions.numeric import scale_metric


def compare_entities(
    pairs: DataFrame,
    mart: DataFrame,
    entity: str,
    period: str,
    metrics: Sequence[str],
    pair_id: str = "id",
) -> DataFrame:
    """``(id, left, right, period, left_<m>, right_<m>)`` for the periods both have.

    Both joins are equi-joins on keys that are unique in the mart, so the output
    has at most one row per pair and period. An entity that occurs in very many
    pairs is a skewed key on the pair side only, which the adaptive join splits.
    """

    def side(name: str) -> DataFrame:
        wanted = [F.col(entity).alias(name), F.col(period)]
        return mart.select(*wanted, *[F.col(m).alias(f"{name}_{m}") for m in metrics])

    left_rows = pairs.select(pair_id, "left", "right").join(side("left"), "left")
    both = left_rows.join(side("right"), ["right", period])
    ordered = [pair_id, "left", "right", period]
    return both.select(
        *ordered, *[f"left_{m}" for m in metrics], *[f"right_{m}" for m in metrics]
    )


def long_comparison(compared: DataFrame, period: str, kinds: Mapping[str, str], pair_id: str = "id") -> DataFrame:
    """``(id, left, right, period, metric, left_value, right_value)``; money in millions."""
    cells = F.array(
        *[
            F.struct(
                F.lit(place).alias("metric_order"),
                F.lit(metric).alias("metric"),
                scale_metric(F.col(f"left_{metric}"), kind).alias("left_value"),
                scale_metric(F.col(f"right_{metric}"), kind).alias("right_value"),
            )
            for place, (metric, kind) in enumerate(kinds.items())
        ]
    )
    return compared.select(pair_id, "left", "right", period, F.inline(cells))


def comparison_table(compared: DataFrame, period: str, kinds: Mapping[str, str], pair_id: str = "id") -> DataFrame:
    """Rows of the comparison page: newest period first, metrics in registry order."""
    rows = long_comparison(compared, period, kinds, pair_id)
    return rows.orderBy(pair_id, F.col(period).desc(), "metric_order").drop("metric_order")


def intersect_periods(mart: DataFrame, entity: str, period: str, left: str, right: str) -> DataFrame:
    """Periods both of two named entities have."""

    def of(name: str) -> DataFrame:
        return mart.filter(F.col(entity) == F.lit(name)).select(period)

    return of(left).intersect(of(right))


def pair_periods(pairs: DataFrame, mart: DataFrame, entity: str, period: str, pair_id: str = "id") -> DataFrame:
    """Number of common periods of every pair, zero included."""
    shared = compare_entities(pairs, mart, entity, period, [], pair_id)
    counted = shared.groupBy(pair_id).agg(F.count("*").alias("periods"))
    return pairs.join(counted, pair_id, "left").withColumn(
        "periods", F.coalesce(F.col("periods"), F.lit(0))
    )


def require_two(entities: DataFrame) -> DataFrame:
    """Gate: a comparison needs two entities. Reads two rows at most."""
    if entities.limit(2).count() < 2:
        raise YearbookError("fewer than two entities to compare")
    return entities


def compare_defaults(
    requests: DataFrame, entities: DataFrame, entity: str, order: str, *, two: bool = False
) -> DataFrame:
    """Fill in ``(left, right)`` of page requests.

    Left is the requested entity if known, else the first. Right is the requested
    one if known and not equal to left, else the first entity that is not left.
    The first two entities are one row, read as scalar subqueries. With one entity there
    is nothing to compare it with: right is null, or the job ends if ``two`` asks for the gate.
    """
    if two:
        require_two(entities)
    first_two = entities.orderBy(order).limit(2)
    first = first_two.agg(F.min_by(entity, order)).scalar()
    second = first_two.agg(F.max_by(entity, order)).scalar()
    known = entities.select(F.col(entity).alias("known"))

    def checked(df: DataFrame, name: str) -> DataFrame:
        hits = known.select(F.col("known").alias(name), F.lit(True).alias(f"{name}_known"))
        return df.join(hits, name, "left")

    resolved = checked(checked(requests, "left"), "right")
    left = F.when(F.col("left_known"), F.col("left")).otherwise(first)
    with_left = resolved.withColumn("chosen_left", left)
    usable = F.col("right_known") & (F.col("right") != F.col("chosen_left"))
    other = F.when(first != F.col("chosen_left"), first).when(second != F.col("chosen_left"), second)
    return with_left.select(
        *[c for c in requests.columns if c not in ("left", "right")],
        F.col("chosen_left").alias("left"),
        F.when(usable, F.col("right")).otherwise(other).alias("right"),
    )


def first_entity(entities: DataFrame, entity: str, order: str) -> DataFrame:
    return entities.agg(F.min_by(entity, order).alias(entity))


def lookup_manifest_pair(manifest: DataFrame, requests: DataFrame) -> DataFrame:
    """Configured pairs that match a request in both columns, in the same order."""
    return requests.join(manifest, ["left", "right"])
