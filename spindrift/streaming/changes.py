"""Rate changes on a stream: the last value of each case and track is state, a change by the threshold is a row."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUTPUT = "caseid long, track string, time_sec double, before double, after double, delta double"


def stream_changes(signals: DataFrame, threshold: float) -> DataFrame:
    """Events of a stream of (caseid, time_sec, track, value); values arrive in time order from batch to batch.

    A missing value hides the changes on both its sides, as in batch.
    """

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(parts)).sort_values("time_sec", kind="stable")
        last = state.get[0] if state.exists else None
        values = rows["value"].astype(float)
        before = values.shift(1)
        before.iloc[0] = float("nan") if last is None else last
        hit = ((values - before).abs() >= threshold).to_numpy()
        end = values.iloc[-1]
        state.update((None if pd.isna(end) else float(end),))
        yield pd.DataFrame({"caseid": key[0], "track": key[1], "time_sec": rows["time_sec"][hit], "before": before[hit], "after": values[hit], "delta": (values - before)[hit]})

    return signals.groupBy("caseid", "track").applyInPandasWithState(step, OUTPUT, "last double", "append", GroupStateTimeout.NoTimeout)


def stream_windows(signals: DataFrame, late: str = "10 minutes", window: str = "5 minutes") -> DataFrame:
    """Count and mean of each track in tumbling windows of event time ``ts``, rows later than ``late`` left out."""
    return signals.withWatermark("ts", late).groupBy(F.window("ts", window), "track").agg(F.count("value").alias("n"), F.avg("value").alias("mean"))
