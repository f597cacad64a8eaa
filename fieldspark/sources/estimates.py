"""The optimizer's size estimates."""

from __future__ import annotations

from pyspark.sql import DataFrame

UNKNOWN = 2**63 - 1


def estimated_bytes(df: DataFrame) -> int:
    """Estimated size of a plan's output; very large when this client cannot ask for it."""
    if not hasattr(df, "_jdf"):
        return UNKNOWN
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
