"""Strike smoothing in a stream: one state for each universe, the same decisions as over history."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from mdlake.operators.lineage import Smoothing

#: Rows of the stream: one resolution of a universe.
RESOLUTIONS = "universe_id string, resolved_at_ns bigint, strike_mode string, selected_expiry_ns bigint, selected_strikes array<double>"
DECISIONS = "universe_id string, resolved_at_ns bigint, applied boolean, applied_strikes array<double>"


class SmoothStrikes(StatefulProcessor):
    def __init__(self, required: int):
        self.required = required

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("smoothing", "value string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = json.loads(self.state.get()[0]) if self.state.exists() else None
        smoothing = Smoothing(self.required)
        if held:
            smoothing.pending, smoothing.count = held["pending"], held["count"]
        out = []
        for r in pd.concat(rows).sort_values("resolved_at_ns").itertuples(index=False):
            strikes = [float(x) for x in r.selected_strikes]
            expiry = int(r.selected_expiry_ns)
            ok = held is None or r.strike_mode != "oi_ranked" or smoothing.applies(held["strikes"], strikes, expiry != held["expiry"])
            if ok:
                held = {"strikes": strikes, "expiry": expiry}
            out.append((key[0], r.resolved_at_ns, ok, held["strikes"]))
        yield pd.DataFrame(out, columns=["universe_id", "resolved_at_ns", "applied", "applied_strikes"])
        self.state.update((json.dumps(held | {"pending": smoothing.pending, "count": smoothing.count}),))

    def close(self) -> None:
        pass


def smooth_strikes_stream(resolutions: DataFrame, required: int = 2) -> DataFrame:
    """Decisions for a stream of RESOLUTIONS rows; needs the RocksDB state store."""
    return resolutions.groupBy("universe_id").transformWithStateInPandas(SmoothStrikes(required), DECISIONS, "Append", "None")
