"""Rate-limit audit over the request log.

For every request: how many requests the same client sent in the trailing
window (``(t - window, t]``), and whether that exceeds the limit.

Skew: one client may send a third of all traffic, so partitioning the window
by client alone would put that client in one task. Rows are instead grouped
by (client, window-sized time bucket); each row is also copied into the next
bucket as a look-back row, so a bucket holds everything its own rows need.
The counting window then runs per (client, bucket) — groups bounded by what
one client sends in two windows — and the look-back copies are dropped.
"""

from __future__ import annotations

from collections import deque

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from staylens import reference_data as R


def rate_limit_audit(requests: DataFrame, client_col: str = "client", time_col: str = "received_at",
                     limit: int = R.RATE_LIMIT_PER_SECOND, window_us: int = 1_000_000) -> DataFrame:
    t = F.unix_micros(F.col(time_col))
    rows = (requests.withColumn("_t", t)
            .withColumn("_b", F.floor(F.col("_t") / window_us))
            .withColumn("_own", F.explode(F.array(F.lit(True), F.lit(False))))
            .withColumn("_b", F.when(F.col("_own"), F.col("_b")).otherwise(F.col("_b") + 1)))
    w = (Window.partitionBy(client_col, "_b").orderBy("_t")
         .rangeBetween(-(window_us - 1), Window.currentRow))
    counted = rows.withColumn("window_count", F.count(F.lit(1)).over(w))
    return (counted.filter("_own")
            .drop("_t", "_b", "_own")
            .withColumn("over_limit", F.col("window_count") > limit))


def segments(requests: DataFrame, window_us: int, client_col: str = "client") -> DataFrame:
    """(client, _b, _segment, _size): the time buckets of each client's log, cut where it pauses for a window or more.

    No request before such a pause can count against one after it, so segments are limited
    independently. Requests are first reduced to one row a client and window-sized bucket
    (partial aggregation, whoever the client is); two requests of one bucket are never a window
    apart, so pauses show between neighbouring buckets.
    """
    buckets = requests.groupBy(client_col, "_b").agg(F.min("_t").alias("_lo"), F.max("_t").alias("_hi"), F.count(F.lit(1)).alias("_n"))
    by_time = Window.partitionBy(client_col).orderBy("_b")
    paused = F.coalesce(F.col("_lo") - F.lag("_hi").over(by_time) >= window_us, F.lit(True))
    numbered = (buckets.withColumn("_cut", F.when(paused, F.col("_b")))
                .withColumn("_segment", F.last("_cut", ignorenulls=True).over(by_time)))
    size = F.sum("_n").over(Window.partitionBy(client_col, "_segment"))
    return numbered.select(client_col, "_b", "_segment", size.alias("_size"))


def _greedy(limit: int, window_us: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["_t", "request_id"], kind="stable")
        recent, accepted = deque(), []
        for t in rows["_t"].tolist():
            while recent and recent[0] <= t - window_us:
                recent.popleft()
            accepted.append(len(recent) < limit)
            if accepted[-1]:
                recent.append(t)
        return rows[["client", "request_id", "received_at"]].assign(accepted=accepted)
    return run


def limit_exact(requests: DataFrame, limit: int = R.RATE_LIMIT_PER_SECOND, window_us: int = 1_000_000) -> DataFrame:
    """B11, exact: a request is accepted when fewer than ``limit`` of its client's were accepted in the window before it.

    Segments of at most ``limit`` requests are accepted whole, by built-ins. Only the longer ones
    need the rule step by step; each is a group of its own, so a client that sends a third
    of the log is split at every pause of a window.
    """
    rows = (requests.select("client", "request_id", "received_at", F.unix_micros("received_at").alias("_t"))
            .withColumn("_b", F.floor(F.col("_t") / window_us)))
    cut = rows.join(segments(rows, window_us), ["client", "_b"])
    calm = cut.where(F.col("_size") <= limit).select("client", "request_id", "received_at", F.lit(True).alias("accepted"))
    busy = (cut.where(F.col("_size") > limit).groupBy("client", "_segment")
            .applyInPandas(_greedy(limit, window_us), "client string, request_id string, received_at timestamp, accepted boolean"))
    return calm.unionByName(busy)
