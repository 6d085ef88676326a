"""Gap merge over a stream of segments: an extension of operators.intervals.gap_merge.

Segments of a recording come in order; an open merged segment is state, and is given out when a segment opens the next
one, or when the recording is silent for the timeout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

OUT = "recording_id string, ord long, start double, end double, speaker string"


def stream_gap_merge(segments: DataFrame, threshold: float, timeout_ms: int | None = None) -> DataFrame:
    """Merged segments, in append mode, of a stream of (recording_id, ord, start, end, speaker)."""

    def merge(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        columns = ["recording_id", "ord", "start", "end", "speaker"]
        if state.hasTimedOut:
            yield pd.DataFrame([(key[0], *state.get)], columns=columns)
            state.remove()
            return
        parts = [pd.DataFrame([state.get], columns=columns[1:])] if state.exists else []
        rows = pd.concat([*parts, *(x[columns[1:]].sort_values("ord") for x in [pd.concat(list(batches))])])
        start, end = rows["start"].to_numpy(float), rows["end"].to_numpy(float)
        first = np.flatnonzero(np.r_[True, start[1:] - end[:-1] > threshold])
        merged = rows.iloc[first].assign(end=end[np.r_[first[1:], len(rows)] - 1])
        last = merged.iloc[-1]
        state.update((int(last["ord"]), float(last["start"]), float(last["end"]), last["speaker"]))
        done = merged.iloc[:-1]
        if timeout_ms is not None:
            state.setTimeoutDuration(timeout_ms)
        if len(done):
            yield done.assign(recording_id=key[0])[columns]

    keyed = segments.selectExpr("cast(recording_id as string) recording_id", "cast(ord as long) ord", "start", "end", "speaker")
    return keyed.groupBy("recording_id").applyInPandasWithState(merge, OUT, "ord long, start double, end double, speaker string", "append", "NoTimeout" if timeout_ms is None else "ProcessingTimeTimeout")
