"""Alerts on the processing clock (STA2).

The event-time alert of :mod:`eventide.streaming.processors` is the same on
every replay. This one follows the clock of the machine that runs it: a rise
sets a timer ``hold`` ahead, a fall deletes it, and a timer that rings is an
alert. What it gives depends on when rows arrive.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from eventide.functions.timefn import duration_us


class RiseClockProcessor(StatefulProcessor):
    """Rows ``ev_id, v`` of a key in order of arrival (of a micro-batch: by id)."""

    def __init__(self, key_fields: Sequence[tuple[str, str]], hold_ms: int):
        self.key_fields, self.hold = list(key_fields), hold_ms

    def output_schema(self) -> str:
        return ", ".join(f"{n} {t}" for n, t in [*self.key_fields, ("armed_ms", "long"), ("alert_ms", "long"), ("value", "double")])

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "v double")
        self.timer = handle.getValueState("timer", "ms long")

    def handleInputRows(self, key, rows, timerValues):
        now = timerValues.getCurrentProcessingTimeInMs()
        last = self.last.get()[0] if self.last.exists() else None
        armed = was = self.timer.get()[0] if self.timer.exists() else None
        values = sorted((i, v) for pdf in rows for i, v in zip(pdf["ev_id"].tolist(), pdf["v"].tolist(), strict=True) if v == v)
        for _, v in values:
            if last is not None and v < last:
                armed = None
            elif last is not None and v > last and armed is None:
                armed = now + self.hold
            last = v
        if armed != was:
            if was is not None:
                self.handle.deleteTimer(was)
            if armed is not None:
                self.handle.registerTimer(armed)
                self.timer.update((armed,))
            else:
                self.timer.clear()
        if values:
            self.last.update((last,))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        ms = expiredTimerInfo.getExpiryTimeInMs()
        if self.timer.exists() and self.timer.get()[0] == ms:
            self.timer.clear()
            names = [x.split()[0] for x in self.output_schema().split(", ")]
            yield pd.DataFrame([(*key, ms - self.hold, ms, self.last.get()[0])], columns=names)

    def close(self) -> None:
        pass


def stream_rise_clock(df: DataFrame, key: str, tiebreak: str, value: str, hold: str) -> DataFrame:
    """One row per alert: the key, when the alert was armed and was due, and the
    last value. After an alert the next rise arms anew. Rows without a value say nothing."""
    from eventide.session import ship_package
    from eventide.streaming.processors import use_state_store

    ship_package(df.sparkSession)
    use_state_store(df.sparkSession)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    proc = RiseClockProcessor([(key, types[key])], duration_us(hold) // 1000)
    rows = df.select(key, F.col(tiebreak).cast("long").alias("ev_id"), F.col(value).cast("double").alias("v"))
    return rows.groupBy(key).transformWithStateInPandas(statefulProcessor=proc, outputStructType=proc.output_schema(), outputMode="Append",
                                                        timeMode="ProcessingTime")
