"""Length-of-stay bucketing."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from staylens.reference_data import LOS_BUCKETS, LOS_OTHER


def los_bucket(los: Column) -> Column:
    expr = None
    for label, lo, hi in LOS_BUCKETS:
        cond = los.between(lo, hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(LOS_OTHER)
