"""Runs of a document that follow one another too closely, as a keyed stream."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

MARKED = "doc_id string, seq long, ts timestamp, too_recent boolean"


def mark_recent(runs: DataFrame, tolerance: float, keep: float | None = None) -> DataFrame:
    """Streaming ``doc_id, seq, ts`` with ``too_recent``: started less than ``tolerance`` seconds
    from the last run of the document that was not.

    The last start of each document is state of the query, so it is restored from its checkpoint.
    A document's state is dropped when no run of it has arrived for ``keep`` seconds (ten times
    the tolerance and an hour at least), so that state does not grow with all documents ever
    seen. The watermark is of arrivals, so a run that is late is marked like others. Runs of
    one trigger are taken in the order of their time, then their number; those without an id
    are one document. Of one document and trigger, start times only are held together.
    """
    tolerance_us = int(tolerance * 1_000_000)
    keep_ms = int(1000 * (max(10 * tolerance, 3600) if keep is None else keep))

    def step(
        key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        # as arrays: most documents have few runs, so what counts is the cost of a call
        parts = list(chunks)
        rows = parts[0] if len(parts) == 1 else pd.concat(parts)
        times, numbers = rows["ts"].to_numpy("datetime64[us]"), rows["seq"].to_numpy()
        order = np.lexsort((numbers, times))
        times = times[order]
        last = state.get[0] if state.exists else None
        marks = []
        for at in times.astype("int64").tolist():
            near = last is not None and abs(at - last) < tolerance_us
            marks.append(near)
            if not near:
                last = at if last is None else max(last, at)
        state.update((last,))
        arrived = rows["arrived"].to_numpy("datetime64[ms]").max().astype("int64")
        state.setTimeoutTimestamp(int(arrived) + keep_ms)
        yield pd.DataFrame(
            {
                "doc_id": rows["doc_id"].to_numpy()[order], "seq": numbers[order],
                "ts": times, "too_recent": marks,
            },
            copy=False,
        )

    return (
        runs.select("doc_id", "seq", "ts", F.current_timestamp().alias("arrived"))
        .withWatermark("arrived", "1 minute")
        .groupBy("doc_id")
        .applyInPandasWithState(
            step, MARKED, "started long", "append", GroupStateTimeout.EventTimeTimeout
        )
    )
