"""Exact request rate limiter as a stateful stream (B11, accepted-only rule).

A request is accepted when fewer than ``limit`` requests of the same client
were *accepted* in the trailing window; rejected requests do not count. The
rule is greedy and depends on arrival order, so it is evaluated per client in
time order with ``applyInPandasWithState``: the state holds only the accepted
times still inside the window (at most ``limit`` values), and each call sees
one client's requests of one micro-batch — bounded by the trigger size
(``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger``), never a client's whole
history. The batch audit in ``operators.rate_limit`` counts all arrivals.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from staylens import reference_data as R

OUTPUT_SCHEMA = "client string, request_id string, received_at timestamp, accepted boolean"
STATE_SCHEMA = "accepted_us array<long>"


def _limiter(limit: int, window_us: int):
    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        recent = deque(state.get[0] if state.exists else [])
        rows = pd.concat(list(batches), ignore_index=True)
        rows = rows.sort_values(["received_at", "request_id"], kind="stable")
        t_us = (rows["received_at"].astype("datetime64[us]").astype("int64")).to_numpy()
        accepted = []
        for t in t_us:
            while recent and recent[0] <= t - window_us:
                recent.popleft()
            ok = len(recent) < limit
            if ok:
                recent.append(int(t))
            accepted.append(ok)
        state.update((list(recent),))
        yield pd.DataFrame({"client": key[0], "request_id": rows["request_id"].to_numpy(),
                            "received_at": rows["received_at"].to_numpy(), "accepted": accepted})
    return step


def limit_requests(requests: DataFrame, limit: int = R.RATE_LIMIT_PER_SECOND,
                   window_us: int = 1_000_000) -> DataFrame:
    """Streaming frame of (client, request_id, received_at) -> per-request accept/reject."""
    return (requests.select("client", "request_id", "received_at")
            .groupBy("client")
            .applyInPandasWithState(_limiter(limit, window_us), OUTPUT_SCHEMA, STATE_SCHEMA, "append",
                                    GroupStateTimeout.NoTimeout))
