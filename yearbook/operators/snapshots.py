"""Choosing among the snapshots of an entity.

A snapshot is named by (entity, fetch time, hash). The number of snapshots per
entity is not bounded, so nothing here sorts or collects an entity's rows: the
newest snapshot is a maximum, computed partly before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_snapshots(history: DataFrame, entity: str, fetched_at: str, digest: str) -> DataFrame:
    return history.select(entity, fetched_at, digest).distinct()


def latest_snapshot(history: DataFrame, entity: str, fetched_at: str, digest: str) -> DataFrame:
    """One row per entity: the newest fetch time, ties broken by the larger hash.

    History rows are first reduced to distinct snapshots by hash aggregation. A
    maximum over a struct is a sorting aggregate, which would sort the history.
    """
    newest = F.max(F.struct(F.col(fetched_at), F.col(digest)))
    return (
        distinct_snapshots(history, entity, fetched_at, digest)
        .groupBy(entity)
        .agg(newest.alias("newest"))
        .select(entity, f"newest.{fetched_at}", f"newest.{digest}")
    )


def join_latest(
    rows: DataFrame, latest: DataFrame, entity: str, fetched_at: str, digest: str
) -> DataFrame:
    """Rows of the newest snapshot only; older snapshots never fill gaps.

    The join is on all three keys, so an entity with very many snapshots is spread
    over the tasks by fetch time and hash.
    """
    return rows.join(latest, [entity, fetched_at, digest], "left_semi")


def dedupe_snapshots(
    snapshots: DataFrame, keys: Sequence[str], digest: str, order: str
) -> DataFrame:
    """One row per (keys, hash): the one with the smallest ``order`` value.

    A hash count finds the keys that occur more than once. The rows of the others stay as they
    are; only those of repeated keys go through the minimum over a struct, which sorts.
    """
    kept = [*keys, digest]
    others = [c for c in snapshots.columns if c not in kept]
    counted = snapshots.groupBy(*kept).agg(F.count("*").alias("copies")).filter("copies > 1")
    repeated = counted.select(*[F.col(c).alias(f"repeated_{c}") for c in kept])
    same = [F.col(c).eqNullSafe(F.col(f"repeated_{c}")) for c in kept]
    first = F.min_by(F.struct(*others), F.col(order))
    chosen = snapshots.join(repeated, same, "left_semi").groupBy(*kept).agg(first.alias("kept")).select(*kept, "kept.*")
    return snapshots.join(repeated, same, "left_anti").select(*kept, *others).unionByName(chosen)


def snapshot_conflicts(snapshots: DataFrame, keys: Sequence[str], digest: str) -> DataFrame:
    """Keys that occur with more than one hash."""
    return (
        snapshots.groupBy(*keys)
        .agg(
            F.count("*").alias("snapshots"),
            F.min(digest).alias("lowest_hash"),
            F.max(digest).alias("highest_hash"),
        )
        .filter(F.col("lowest_hash") != F.col("highest_hash"))
    )


def semi_known_entity(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in ``known``."""
    return rows.join(known.select(key).distinct(), key, "left_semi")


def anti_missing_entity(expected: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Expected entities without any row."""
    return expected.join(rows.select(key).distinct(), key, "left_anti")


def except_entities(expected: DataFrame, available: DataFrame, key: str) -> DataFrame:
    """Keys of ``expected`` that are not in ``available``, as a set."""
    return expected.select(key).subtract(available.select(key))


def flag_available(dimension: DataFrame, rows: DataFrame, key: str, flag: str) -> DataFrame:
    """The dimension with a flag column: does the entity have any row?"""
    present = rows.select(key).distinct().withColumn(flag, F.lit(True))
    joined = dimension.join(present, key, "left")
    return joined.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
