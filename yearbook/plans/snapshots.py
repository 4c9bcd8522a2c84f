"""Which checked snapshots are used. Shared by the build and the stream."""

from __future__ import annotations

from pyspark.sql import DataFrame

from yearbook.operators import quality as Q
from yearbook.operators.snapshots import dedupe_snapshots, snapshot_conflicts


def violations(checked: DataFrame) -> DataFrame:
    """Broken rules of single snapshots, and conflicts between them."""
    return Q.list_violations(checked).unionByName(Q.check_snapshot_conflict(checked))


def usable_snapshots(checked: DataFrame) -> DataFrame:
    """Snapshots that break no rule: one of equal ones, none of conflicting ones."""
    usable = Q.accepted(checked)
    keys = ["ticker", "fetched_at"]
    kept = (
        dedupe_snapshots(usable.select(*keys, "sha256", "raw_file"), keys, "sha256", "raw_file")
        .join(snapshot_conflicts(checked, keys, "sha256"), keys, "left_anti")
        .select("raw_file")
    )
    return usable.join(kept, "raw_file", "left_semi")
