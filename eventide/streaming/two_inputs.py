"""Two keyed inputs in one processor (UDF5).

The inputs travel as one stream with a side; their rows meet per key in event
time order on one clock, the smaller of the two watermarks. A
:class:`TwoInputProcessor` has a callback per side and one for timers, which
come in time order with the rows, and states of its own for each side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from eventide.functions.timefn import duration_us
from eventide.streaming.processors import OrderedProcessor, run_grouped

LEFT, RIGHT = 0, 1


class TwoInputProcessor(OrderedProcessor):
    """Subclasses set ``left_fields``, ``right_fields``, ``out_fields`` and define
    ``on_left`` / ``on_right`` (key, time, id, values) and ``on_timer`` (key,
    time); each returns output rows. ``at(t)`` asks for a timer; timers of a
    time come after all rows of that time."""

    left_fields: list[tuple[str, str]] = []
    right_fields: list[tuple[str, str]] = []

    def __init__(self, key_fields, ttl_ms: int | None = None):
        super().__init__(key_fields, ttl_ms)
        self.payload = [("side", "int"), *((f"l_{n}", t) for n, t in self.left_fields), *((f"r_{n}", t) for n, t in self.right_fields)]

    def init(self, handle) -> None:
        self._timers = handle.getMapState("timers", "t long", "on boolean")
        super().init(handle)

    def at(self, t_us: int) -> None:
        self._timers.updateValue((t_us,), (True,))
        self.handle.registerTimer(t_us // 1000 + 1)
        self._due.add(t_us)

    def cancel(self, t_us: int) -> None:
        self._timers.removeKey((t_us,))
        self._due.discard(t_us)

    def _load(self) -> None:
        self._due = {t for (t,) in self._timers.keys()} if self._timers.exists() else set()

    def _ring(self, key, before: int) -> list[tuple]:
        out = []
        while self._due and (t := min(self._due)) < before:
            self.cancel(t)
            out += self.on_timer(key, t)
        return out

    def process_due(self, key, due):
        self._load()
        out, left = [], len(self.left_fields)
        for t, i, side, *values in due:
            out += self._ring(key, t)
            self._expire_if_idle(t)
            out += self.on_left(key, t, i, values[:left]) if side == LEFT else self.on_right(key, t, i, values[left:])
            self._touch(t)
        return out

    def on_watermark(self, key, wm_us):
        self._load()
        return self._ring(key, wm_us)

    def on_left(self, key, t, i, values) -> list[tuple]:
        raise NotImplementedError

    def on_right(self, key, t, i, values) -> list[tuple]:
        raise NotImplementedError

    def on_timer(self, key, t) -> list[tuple]:
        return []


def run_two_inputs(left: DataFrame, right: DataFrame, keys: Sequence[str], lts: str, rts: str, lid: str, rid: str,
                   processor: TwoInputProcessor) -> DataFrame:
    """Two watermarked streams, grouped by ``keys``, through one processor; the
    columns in its ``left_fields`` and ``right_fields`` go with the rows."""
    def side(df, n, ts, tie):
        own = [F.col(c).cast(t).alias(f"l_{c}") if n == LEFT else F.lit(None).cast(t).alias(f"l_{c}") for c, t in processor.left_fields]
        own += [F.col(c).cast(t).alias(f"r_{c}") if n == RIGHT else F.lit(None).cast(t).alias(f"r_{c}") for c, t in processor.right_fields]
        return df.select(*keys, F.unix_micros(F.col(ts)).alias("ev_t"), F.col(tie).cast("long").alias("ev_id"), F.lit(n).alias("side"), *own)

    return run_grouped(side(left, LEFT, lts, lid).unionByName(side(right, RIGHT, rts, rid)), list(keys), processor)


class IntervalMatchProcessor(TwoInputProcessor):
    """``|right time - left time| <= tolerance`` on the same key (JON4/JON5): every
    pair, and each side's rows that no timer found a partner for."""

    out_fields = [("result", "string"), ("l_event_id", "long"), ("l_t_us", "long"), ("r_event_id", "long"), ("r_t_us", "long")]

    def __init__(self, key_fields, tolerance_us: int, ttl_ms: int | None = None):
        super().__init__(key_fields, ttl_ms)
        self.tolerance = tolerance_us

    def setup(self, handle):
        self.held = [self.map_state(n, "t long, id long, n long", "matched boolean") for n in ("left_rows", "right_rows")]

    def _on(self, side: int, t: int, i: int) -> list[tuple]:
        mine, other = self.held[side], self.held[1 - side]
        out, matched = [], False
        for (ot, oid, n), (known,) in list(other.iterator()) if other.exists() else []:
            if ot >= t - self.tolerance:
                pair = ((i, t), (oid, ot)) if side == LEFT else ((oid, ot), (i, t))
                out.append(("match", *pair[0], *pair[1]))
                matched = True
                if not known:
                    other.updateValue((ot, oid, n), (True,))
        n = 0
        while mine.containsKey((t, i, n)):                   # rows that repeat a time and id are rows of their own
            n += 1
        mine.updateValue((t, i, n), (matched,))
        self.at(t + self.tolerance)
        return out

    def on_left(self, key, t, i, values):
        return self._on(LEFT, t, i)

    def on_right(self, key, t, i, values):
        return self._on(RIGHT, t, i)

    def on_timer(self, key, t):
        out = []
        for side, name in ((LEFT, "left_only"), (RIGHT, "right_only")):
            held = self.held[side]
            for (rt, i, n), (matched,) in list(held.iterator()) if held.exists() else []:
                if rt + self.tolerance <= t:
                    held.removeKey((rt, i, n))
                    if not matched:
                        out.append((name, *((i, rt, None, None) if side == LEFT else (None, None, i, rt))))
        return out


def stream_match(left: DataFrame, right: DataFrame, key: str, lts: str, rts: str, lid: str, rid: str, tolerance: str) -> DataFrame:
    """Reconciliation of two streams by one processor: ``result`` = ``match``, ``left_only`` or ``right_only``."""
    types = {f.name: f.dataType.simpleString() for f in left.schema.fields}
    return run_two_inputs(left, right, [key], lts, rts, lid, rid, IntervalMatchProcessor([(key, types[key])], duration_us(tolerance)))
