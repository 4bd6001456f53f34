"""Windows that stay open for late rows (STR5).

A window is sent first when the watermark reaches its end (version 1). Its state
stays for ``lateness`` more; rows that still come change it, and each
micro-batch that brings some sends it again with the next version. After that
the state goes, and a row none of whose windows is open any more comes out as
``late`` with its id and time: the side output. No row is lost: the event-time
column does not reach the stateful step, so Spark does not drop rows behind the
watermark before it.

Work is per key; state is one accumulator per key and open window, whatever the
number of rows (:class:`eventide.operators.userfn.IncrementalAggregate`).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from eventide.functions.timefn import duration_us
from eventide.operators.userfn import IncrementalAggregate


class LatenessProcessor(StatefulProcessor):
    """Rows ``ev_t, ev_id`` and the inputs of ``agg`` -> rows of
    ``output`` (``window`` or ``late``)."""

    def __init__(self, key_fields: Sequence[tuple[str, str]], agg: IncrementalAggregate, size_us: int, slide_us: int, lateness_us: int):
        if size_us % 1000 or slide_us % 1000 or lateness_us % 1000:
            raise ValueError("window size, slide and lateness are whole milliseconds")
        self.key_fields, self.agg = list(key_fields), agg
        self.size, self.slide, self.lateness = size_us, slide_us, lateness_us
        self.result_fields = [tuple(x.split()) for x in agg.output.split(", ")]

    def output_schema(self) -> str:
        own = [("output", "string"), ("window_start_us", "long"), ("window_end_us", "long"), ("version", "int"), *self.result_fields,
               ("event_id", "long"), ("t_us", "long")]
        return ", ".join(f"{n} {t}" for n, t in [*self.key_fields, *own])

    def init(self, handle) -> None:
        self.handle = handle
        self.windows = handle.getMapState("windows", "start long", f"version int, {self.agg.state}")

    def _send(self, start: int, version: int, acc: tuple) -> tuple:
        return ("window", start, start + self.size, version, *self.agg.result(acc), None, None)

    def _starts(self, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and starts of the windows that hold each time."""
        last = t // self.slide * self.slide
        n = -(-self.size // self.slide)
        starts = last[:, None] - np.arange(n) * self.slide
        row, col = np.nonzero(starts + self.size > t[:, None])
        return row, starts[row, col]

    def handleInputRows(self, key, rows, timerValues):
        wm = timerValues.getCurrentWatermarkInMs() * 1000
        out, changed = [], {}
        for pdf in rows:
            t = pdf["ev_t"].to_numpy(np.int64)
            row, starts = self._starts(t)
            open_ = starts + self.size + self.lateness > wm
            late = np.ones(len(t), bool)
            late[row[open_]] = False
            for i in np.flatnonzero(late):
                out.append(("late", None, None, None, *[None] * len(self.result_fields), int(pdf["ev_id"].iloc[i]), int(t[i])))
            row, starts = row[open_], starts[open_]
            for s in np.unique(starts).tolist():
                version, acc = changed.get(s) or self._state(s)
                if version == 0 and s + self.size <= wm and self.windows.containsKey((s,)):
                    version = 1                            # complete before these rows came; its timer is still to ring
                    out.append(self._send(s, version, acc))
                changed[s] = version, self.agg.add(acc, pdf.iloc[row[starts == s]][list(self.agg.inputs)])
        for s, (version, acc) in changed.items():
            if s + self.size <= wm:
                version += 1
                out.append(self._send(s, version, acc))
                self.handle.registerTimer((s + self.size + self.lateness) // 1000 - 1)
            else:
                self.handle.registerTimer((s + self.size) // 1000 - 1)
            self.windows.updateValue((s,), (version, *acc))
        yield from self._frame(key, out)

    def _state(self, start: int) -> tuple[int, tuple]:
        if self.windows.containsKey((start,)):
            version, *acc = self.windows.getValue((start,))
            return version, tuple(acc)
        return 0, self.agg.create()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        wm, at = timerValues.getCurrentWatermarkInMs() * 1000, (expiredTimerInfo.getExpiryTimeInMs() + 1) * 1000
        out = []
        for s in (at - self.size, at - self.size - self.lateness):
            if not self.windows.containsKey((s,)):
                continue
            version, acc = self._state(s)
            if s + self.size > wm:
                self.handle.registerTimer((s + self.size) // 1000 - 1)
                continue
            if version == 0:
                out.append(self._send(s, 1, acc))
                self.windows.updateValue((s,), (1, *acc))
            if s + self.size + self.lateness <= wm:
                self.windows.removeKey((s,))
            else:
                self.handle.registerTimer((s + self.size + self.lateness) // 1000 - 1)
        yield from self._frame(key, out)

    def _frame(self, key, out: list[tuple]):
        if out:
            names = [x.split()[0] for x in self.output_schema().split(", ")]
            yield pd.DataFrame([(*key, *o) for o in out], columns=names)

    def close(self) -> None:
        pass


def stream_window_lateness(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: str, agg: IncrementalAggregate, size: str,
                           lateness: str, slide: str | None = None) -> DataFrame:
    """``agg`` over the windows of a watermarked stream, corrected for rows up to
    ``lateness`` behind the watermark: ``output`` = ``window`` (``window_start_us,
    window_end_us, version`` and the result) or ``late`` (``event_id, t_us``).
    The last version of a window is final. ``tiebreak`` is the rows' id."""
    from eventide.session import ship_package
    from eventide.streaming.processors import use_state_store

    ship_package(df.sparkSession)
    use_state_store(df.sparkSession)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    proc = LatenessProcessor([(k, types[k]) for k in keys], agg, duration_us(size), duration_us(slide or size), duration_us(lateness))
    rows = df.select(*keys, F.unix_micros(F.col(ts)).alias("ev_t"), F.col(tiebreak).cast("long").alias("ev_id"),
                     *[c for c in agg.inputs if c not in keys])
    return rows.groupBy(*keys).transformWithStateInPandas(statefulProcessor=proc, outputStructType=proc.output_schema(), outputMode="Append",
                                                          timeMode="EventTime")
