"""Severity buckets of an asset."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bucket names, best first; the position is the rank.
BUCKETS = ("nominal", "degraded", "critical", "non_operational")

# Names of the logistics severities 0..4.
SEVERITY_NAMES = ("UNSPECIFIED", "OK", "DEGRADED", "CRITICAL", "NON_OPERATIONAL")

# Codes of the configuration status and of the lifecycle.
CM_MINOR, CM_MAJOR, CM_NMC = 2, 3, 4
LIFECYCLE_STALE, LIFECYCLE_DECOMMISSIONED = 3, 4


def severity_name(severity: Column) -> Column:
    names = F.array(*[F.lit(n) for n in SEVERITY_NAMES])
    return F.coalesce(F.get(names, severity.cast("int")), F.lit(SEVERITY_NAMES[0]))


def logistics_rank(severity: Column) -> Column:
    """0..3; anything outside 2..4 counts as nominal."""
    return F.when(severity.between(2, 4), severity - 1).otherwise(0).cast("int")


def cm_rank(status: Column, lifecycle: Column) -> Column:
    """Configuration findings never rank above degraded; a retired asset is non-operational."""
    return (
        F.when(lifecycle == LIFECYCLE_DECOMMISSIONED, 3)
        .when(status.isin(CM_MINOR, CM_MAJOR, CM_NMC) | (lifecycle == LIFECYCLE_STALE), 1)
        .otherwise(0)
        .cast("int")
    )


def worse_rank(left: Column, right: Column) -> Column:
    return F.greatest(left, right)


def bucket_name(rank: Column) -> Column:
    return F.element_at(F.array(*[F.lit(b) for b in BUCKETS]), rank + 1)
