"""Keyed state processors for streams (STA1-STA3, PAT1, WIN3, UDF5).

Rows of one key arrive in micro-batches in any order. :class:`OrderedProcessor`
buffers them by time slice and, when the watermark has passed them, replays
them in (event time, tie-break id) order through ``step``, so a stream gives
the same answer as the batch operator of the same name on the closed part of
the input. A batch adds a part to each slice that it has rows for, without
reading the slice; a timer reads and drops the due slices only. Work is keyed: Spark shuffles by key and each task holds the state
of its keys only (RocksDB provider, checkpointed with the query).

Input contract (see :func:`run_ordered`): key columns, ``ev_t`` (event time as
epoch microseconds), ``ev_id`` (tie-break), then the processor's payload.
(Names with a leading underscore do not survive the Arrow hand-over.)
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor


class OrderedProcessor(StatefulProcessor):
    """Event-time ordered replay of a key's rows; subclasses define ``payload``,
    ``out_fields``, ``setup``, ``step`` and optionally ``on_watermark``."""

    payload: list[tuple[str, str]] = []
    out_fields: list[tuple[str, str]] = []

    slice_us = 600_000_000       # length of a buffer slice

    def __init__(self, key_fields: Sequence[tuple[str, str]], ttl_ms: int | None = None):
        self.key_fields = list(key_fields)
        # STA4: optional time-to-live of a key's state in *event time*: the
        # state expires ``ttl_ms`` after the key's last row, is refreshed by
        # every row, and an expired value is never read. (Spark's own state TTL
        # works only in processing-time mode, which cannot order by event time.)
        self.ttl_us = ttl_ms * 1000 if ttl_ms else None
        self._states = []

    # -- schema ---------------------------------------------------------------
    def output_schema(self) -> str:
        return ", ".join(f"{n} {t}" for n, t in [*self.key_fields, *self.out_fields])

    def _cols(self) -> list[str]:
        return ["ev_t", "ev_id", *[n for n, _ in self.payload]]

    # -- StatefulProcessor API ------------------------------------------------
    def init(self, handle) -> None:
        self.handle = handle
        row = ", ".join(f"{n}: {t}" for n, t in [("ev_t", "long"), ("ev_id", "long"), *self.payload])
        self.buf = handle.getMapState("buf", "slice long, part int", f"rows array<struct<{row}>>")
        self._slices = handle.getValueState("open_slices", "slices array<struct<slice: long, parts: int, first_t: long>>")
        self._buf_timer = handle.getValueState("buf_timer", "ms long")
        self._last = handle.getValueState("last_seen", "t long")
        self.setup(handle)

    def _arm(self, first_t_us: int) -> None:
        """Keep one flush timer per key, at the earliest buffered row."""
        ms = first_t_us // 1000 + 1
        cur = self._buf_timer.get()[0] if self._buf_timer.exists() else None
        if cur is None or ms < cur:
            if cur is not None:
                self.handle.deleteTimer(cur)
            self.handle.registerTimer(ms)
            self._buf_timer.update((ms,))

    def _index(self) -> dict[int, tuple[int, int]]:
        """Parts and earliest time of the open slices: one small value a key."""
        return {s: (n, first) for s, n, first in self._slices.get()[0]} if self._slices.exists() else {}

    def _set_index(self, index: dict[int, tuple[int, int]]) -> None:
        if index:
            self._slices.update(([(s, n, first) for s, (n, first) in index.items()],))
        else:
            self._slices.clear()

    def _add(self, rows: list[tuple], index: dict[int, tuple[int, int]]) -> None:
        """One more part for every slice that has rows."""
        by_slice = {}
        for r in rows:
            by_slice.setdefault(r[0] // self.slice_us, []).append(tuple(r))
        for s, part in by_slice.items():
            n, first = index.get(s, (0, part[0][0]))
            self.buf.updateValue((s, n), (part,))
            index[s] = n + 1, min(first, *(r[0] for r in part))

    def _take(self, wm_us: int) -> list[tuple]:
        """Rows before the watermark, taken out of their slices; later slices are not read."""
        due, back, index = [], [], self._index()
        for s, (parts, first) in list(index.items()):
            if first >= wm_us:
                continue
            for n in range(parts):
                rows = [tuple(r) for r in self.buf.getValue((s, n))[0]]
                due += [r for r in rows if r[0] < wm_us]
                back += [r for r in rows if r[0] >= wm_us]
                self.buf.removeKey((s, n))
            del index[s]
        if due:
            self._add(back, index)
            self._set_index(index)
        if index:
            self._arm(min(first for _, first in index.values()))
        return sorted(due, key=lambda r: r[:2])

    def handleInputRows(self, key, rows, timerValues):
        new = []
        for pdf in rows:
            cols = [pdf[c].tolist() for c in self._cols()]
            new.extend(zip(*cols))
        if new:
            index = self._index()
            self._add(new, index)
            self._set_index(index)
            self._arm(min(r[0] for r in new))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        wm = timerValues.getCurrentWatermarkInMs() * 1000
        if self._buf_timer.exists() and self._buf_timer.get()[0] <= expiredTimerInfo.getExpiryTimeInMs():
            self._buf_timer.clear()
        due = self._take(wm)
        out = self.process_due(key, due) if due else []
        out.extend(self.on_watermark(key, wm))
        self._expire_if_idle(wm)
        if out:
            names = [n for n, _ in [*self.key_fields, *self.out_fields]]
            yield pd.DataFrame([(*key, *o) for o in out], columns=names)

    def close(self) -> None:
        pass

    # -- to override ----------------------------------------------------------
    def setup(self, handle) -> None:
        pass

    def value_state(self, name: str, schema: str):
        st = self.handle.getValueState(name, schema)
        self._states.append(st)
        return st

    def list_state(self, name: str, schema: str):
        st = self.handle.getListState(name, schema)
        self._states.append(st)
        return st

    def map_state(self, name: str, key_schema: str, schema: str):
        st = self.handle.getMapState(name, key_schema, schema)
        self._states.append(st)
        return st

    def _expire_if_idle(self, now_us: int) -> None:
        """Clear the key's state when its last row is more than the TTL before ``now_us``."""
        if self.ttl_us is not None and self._last.exists() and self._last.get()[0] + self.ttl_us < now_us:
            for st in self._states:
                st.clear()
            self._last.clear()

    def _touch(self, t_us: int) -> None:
        if self.ttl_us is not None:
            self._last.update((t_us,))
            self.handle.registerTimer((t_us + self.ttl_us) // 1000 + 1)

    def process_due(self, key, due: list[tuple]) -> list[tuple]:
        """Rows whose time the watermark has passed, in (time, id) order.
        Row by row through ``step``; subclasses may replace it with a
        vectorised form (a hot key then costs numpy work, not a Python call
        per row)."""
        out = []
        for r in due:
            self._expire_if_idle(r[0])
            out.extend(self.step(key, r))
            self._touch(r[0])
        return out

    def step(self, key, row) -> list[tuple]:
        raise NotImplementedError

    def on_watermark(self, key, wm_us: int) -> list[tuple]:
        return []


def use_state_store(spark: SparkSession) -> None:
    """State with several column families needs the RocksDB provider (it also
    serves every other stateful operator); set it if the session has another."""
    key = "spark.sql.streaming.stateStore.providerClass"
    if "RocksDB" not in (spark.conf.get(key, "") or ""):
        spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def run_ordered(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: str,
                payload: Sequence[Column], processor: OrderedProcessor, event_time: str = "") -> DataFrame:
    """Group a watermarked stream by ``keys`` and run ``processor`` on it (append
    mode). ``event_time`` names the output column (TIMESTAMP) that carries the
    event time and its watermark on, so that another stateful step can follow."""
    inp = df.select(*keys, F.unix_micros(F.col(ts)).alias("ev_t"), F.col(tiebreak).cast("long").alias("ev_id"),
                    *payload)
    return run_grouped(inp, keys, processor, event_time)


def run_grouped(inp: DataFrame, keys: Sequence[str], processor: OrderedProcessor, event_time: str = "") -> DataFrame:
    """Rows of the input contract through ``processor``."""
    from eventide.session import ship_package

    ship_package(inp.sparkSession)
    use_state_store(inp.sparkSession)
    return inp.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=processor.output_schema(),
        outputMode="Append", timeMode="EventTime", eventTimeColumnName=event_time)


def _next_second(t: np.ndarray, kind: np.ndarray, pend: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Open starts are the ``pend`` rows (earlier than every due row) followed
    by the kind-1 due rows. Returns their due-row positions (-1 for pending
    ones) and, for each, the position of the first later kind-2 due row (-1 if
    none). Due rows are in (time, id) order."""
    seconds = np.flatnonzero(kind == 2)
    cand_pos = np.r_[np.full(len(pend), -1, dtype=np.int64), np.flatnonzero(kind == 1)]
    if not len(seconds):
        return cand_pos, np.full(len(cand_pos), -1, dtype=np.int64)
    k = np.searchsorted(seconds, cand_pos, side="right")
    return cand_pos, np.where(k < len(seconds), seconds[np.minimum(k, len(seconds) - 1)], -1)


# ---------------------------------------------------------------- STA1
class ClickCapProcessor(OrderedProcessor):
    """First ``max_count + 1`` rows per key and day pass; the next raises one
    warning; the count resets with the day (``day`` = day number in the cap's
    zone). State of a finished day is dropped once the watermark passes it.

    ``carry``: more columns (name, type) of the input that the output rows keep;
    ``event_time``: name of an output column with the row's time as TIMESTAMP."""

    def __init__(self, key_fields, max_count: int, ttl_ms: int | None = None,
                 carry: Sequence[tuple[str, str]] = (), event_time: str = ""):
        super().__init__(key_fields, ttl_ms)
        self.max_count, self.event_time = max_count, event_time
        self.payload = [("day", "long"), *carry]
        self.out_fields = [("output", "string"), ("event_id", "long"), ("t_us", "long"), ("day", "long"), *carry,
                           *([(event_time, "timestamp")] if event_time else [])]

    def _row(self, output, i, t, day, more):
        at = [pd.Timestamp(t, unit="us", tz="UTC")] if self.event_time else []
        return (output, i, t, day, *more, *at)

    def setup(self, handle):
        self.st = self.value_state("cap", "day long, n long, warned boolean")

    def step(self, key, r):
        t, i, day, *more = r
        s = self.st.get() if self.st.exists() else None
        if s is None or s[0] != day:
            s = (day, 0, False)
            self.handle.registerTimer((day + 1) * 86_400_000 + 1)
        n, warned = s[1] + 1, s[2]
        out = []
        if n <= self.max_count + 1:
            out.append(self._row("pass", i, t, day, more))
        elif not warned:
            out.append(self._row("warn", i, t, day, more))
            warned = True
        self.st.update((day, n, warned))
        return out

    def process_due(self, key, due):
        if self.ttl_us is not None:
            return super().process_due(key, due)
        t, i, day = (np.array([r[c] for r in due]) for c in range(3))
        s = self.st.get() if self.st.exists() else None
        out = []
        # rows are in time order, so days form runs; each run continues or resets the count
        starts = np.flatnonzero(np.r_[True, day[1:] != day[:-1]])
        for a, b in zip(starts, np.r_[starts[1:], len(day)]):
            d = int(day[a])
            n0, warned = (s[1], s[2]) if s is not None and s[0] == d else (0, False)
            if s is None or s[0] != d:
                self.handle.registerTimer((d + 1) * 86_400_000 + 1)
            rank = n0 + np.arange(1, b - a + 1)
            keep = np.flatnonzero(rank <= self.max_count + 1) + a
            out += [self._row("pass", int(i[j]), int(t[j]), d, due[j][3:]) for j in keep.tolist()]
            over = np.flatnonzero(rank > self.max_count + 1)
            if not warned and len(over):
                j = int(over[0]) + a
                out.append(self._row("warn", int(i[j]), int(t[j]), d, due[j][3:]))
                warned = True
            s = (d, int(n0 + (b - a)), warned)
        self.st.update(s)
        return out

    def on_watermark(self, key, wm_us):
        if self.st.exists():
            day = self.st.get()[0]
            if (day + 1) * 86_400_000_000 < wm_us:
                self.st.clear()
        return []


# ---------------------------------------------------------------- STA3
class MissingFollowupProcessor(OrderedProcessor):
    """``kind`` 1 rows open a deadline ``t + within``; a later ``kind`` 2 row at
    or before the deadline settles every open one; a deadline the watermark
    passes unsettled is emitted as a timeout. ``inclusive=False`` makes the
    limit strict (``gap < within``), which is PAT6 not-followed-by."""

    payload = [("kind", "int")]
    out_fields = [("event_id", "long"), ("t_us", "long")]

    def __init__(self, key_fields, within_us: int, ttl_ms: int | None = None, inclusive: bool = True):
        super().__init__(key_fields, ttl_ms)
        self.within = within_us
        self.inclusive = inclusive

    def setup(self, handle):
        self.pend = self.list_state("pending", "t long, id long")

    def _pending(self):
        return list(self.pend.get()) if self.pend.exists() else []

    def step(self, key, r):
        t, i, kind = r
        if kind == 1:
            self.pend.appendValue((t, i))
            self.handle.registerTimer((t + self.within) // 1000 + 1)
        elif kind == 2:
            if self.inclusive:
                keep = [c for c in self._pending() if t - c[0] > self.within]
            else:
                keep = [c for c in self._pending() if t - c[0] >= self.within]
            self.pend.put(keep) if keep else self.pend.clear()
        return []

    def process_due(self, key, due):
        if self.ttl_us is not None:
            return super().process_due(key, due)
        t, i, kind = (np.asarray(c) for c in zip(*due))
        pend = self._pending()
        cand_pos, nxt = _next_second(t, kind, pend)
        ct = np.r_[np.array([c[0] for c in pend], dtype=np.int64), t[cand_pos[len(pend):]]]
        ci = np.r_[np.array([c[1] for c in pend], dtype=np.int64), i[cand_pos[len(pend):]]]
        gap = np.where(nxt >= 0, t[np.maximum(nxt, 0)] - ct, -1)
        settled = (nxt >= 0) & ((gap <= self.within) if self.inclusive else (gap < self.within))
        keep = list(zip(ct[~settled].tolist(), ci[~settled].tolist()))
        self.pend.put(keep) if keep else self.pend.clear()
        if keep:
            self.handle.registerTimer((min(c[0] for c in keep) + self.within) // 1000 + 1)
        return []

    def _expired(self, c, wm_us) -> bool:
        # every row before the watermark is processed: a deadline is final
        # once no settling row can still come (strict limit: at the deadline)
        return c[0] + self.within < wm_us if self.inclusive else c[0] + self.within <= wm_us

    def on_watermark(self, key, wm_us):
        pend = self._pending()
        expired = [c for c in pend if self._expired(c, wm_us)]
        if expired:
            rest = [c for c in pend if not self._expired(c, wm_us)]
            self.pend.put(rest) if rest else self.pend.clear()
            if rest:
                self.handle.registerTimer((min(c[0] for c in rest) + self.within) // 1000 + 1)
        return [(c[1], c[0]) for c in sorted(expired)]


# ---------------------------------------------------------------- PAT1
class ConsecutiveProcessor(OrderedProcessor):
    """Emit the last row of ``times`` consecutive rows with ``c`` true, the
    first within ``within_us`` of the last (strict); ``emit='list'`` adds the
    ids of all matched rows in order (bounded by ``times``)."""

    payload = [("c", "boolean")]

    def __init__(self, key_fields, times: int, within_us: int, ttl_ms: int | None = None, emit: str = "last"):
        super().__init__(key_fields, ttl_ms)
        self.times, self.within, self.emit = times, within_us, emit
        self.out_fields = [("first_event_id", "long"), ("first_t_us", "long"), ("event_id", "long"), ("t_us", "long"),
                           *([("event_ids", "array<long>")] if emit == "list" else [])]

    def setup(self, handle):
        self.last = self.list_state("last", "t long, id long, c boolean")

    def step(self, key, r):
        t, i, c = r
        prev = list(self.last.get()) if self.last.exists() else []
        out = []
        if (c and len(prev) == self.times - 1 and all(p[2] for p in prev)
                and t - prev[0][0] < self.within):
            out.append((prev[0][1], prev[0][0], i, t, *([[*(p[1] for p in prev), i]] if self.emit == "list" else [])))
        keep = (prev + [(t, i, bool(c))])[-(self.times - 1):]
        self.last.put(keep)
        return out

    def process_due(self, key, due):
        if self.ttl_us is not None:
            return super().process_due(key, due)
        prev = list(self.last.get()) if self.last.exists() else []
        rows = prev + [(r[0], r[1], bool(r[2])) for r in due]
        t = np.array([r[0] for r in rows], dtype=np.int64)
        ids = np.array([r[1] for r in rows], dtype=np.int64)
        c = np.array([r[2] for r in rows], dtype=np.int64)
        n, m = self.times, len(rows)
        cs = np.r_[0, np.cumsum(c)]
        j = np.arange(max(len(prev), n - 1), m)          # due rows with n-1 rows before them
        first = j - (n - 1)
        ok = (cs[j + 1] - cs[first] == n) & (t[j] - t[first] < self.within)
        out = [(int(ids[a]), int(t[a]), int(ids[b]), int(t[b]), *([ids[a:b + 1].tolist()] if self.emit == "list" else []))
               for a, b in zip(first[ok], j[ok])]
        self.last.put([(int(t[x]), int(ids[x]), bool(c[x])) for x in range(max(0, m - (n - 1)), m)])
        return out


# ---------------------------------------------------------------- AGG13
class RepeatProcessor(OrderedProcessor):
    """Every row with whether its key occurred before it."""

    def __init__(self, key_fields, ttl_ms: int | None = None, name: str = "seen_before"):
        super().__init__(key_fields, ttl_ms)
        self.out_fields = [("event_id", "long"), ("t_us", "long"), (name, "boolean")]

    def setup(self, handle):
        self.seen = self.value_state("seen", "yes boolean")

    def step(self, key, r):
        before = self.seen.exists()
        if not before:
            self.seen.update((True,))
        return [(r[1], r[0], before)]


# ---------------------------------------------------------------- WIN3
class JumpProcessor(OrderedProcessor):
    """Compare each value with the previous one of the key (``first_prev`` first)."""

    payload = [("v", "double")]
    out_fields = [("event_id", "long"), ("t_us", "long"), ("value", "double"), ("prev_value", "double"),
                  ("jumped", "boolean")]

    def __init__(self, key_fields, limit: float, first_prev: float = 0.0, ttl_ms: int | None = None):
        super().__init__(key_fields, ttl_ms)
        self.limit, self.first_prev = limit, first_prev

    def setup(self, handle):
        self.prev = self.value_state("prev", "v double")

    def step(self, key, r):
        t, i, v = r
        p = self.prev.get()[0] if self.prev.exists() else self.first_prev
        self.prev.update((v,))
        return [(i, t, v, p, abs(v - p) > self.limit)]

    def process_due(self, key, due):
        if self.ttl_us is not None:
            return super().process_due(key, due)
        t, i, v = (np.asarray(c) for c in zip(*due))
        v = v.astype(float)
        p0 = self.prev.get()[0] if self.prev.exists() else self.first_prev
        prev = np.concatenate([[p0], v[:-1]])
        jumped = np.abs(v - prev) > self.limit
        self.prev.update((float(v[-1]),))
        return list(zip(i.tolist(), t.tolist(), v.tolist(), prev.tolist(), jumped.tolist()))


# ---------------------------------------------------------------- STA2
class RisingAlertProcessor(OrderedProcessor):
    """A rise (v > prev) with no armed alert arms one at ``t + hold``; a fall
    (v < prev) disarms it; an armed alert fires once no fall came at or
    before its time. ``repeat=False`` gives one alert per run (the batch form);
    ``repeat=True`` re-arms at the next rise after an alert."""

    payload = [("v", "double")]
    out_fields = [("run_start_us", "long"), ("alert_us", "long")]

    def __init__(self, key_fields, hold_us: int, repeat: bool = False, ttl_ms: int | None = None):
        super().__init__(key_fields, ttl_ms)
        self.hold, self.repeat = hold_us, repeat

    def setup(self, handle):
        self.st = self.value_state("rise", "prev double, alert long, start long, done boolean")

    def _get(self):
        return self.st.get() if self.st.exists() else (None, None, None, False)

    def _fire(self, s, upto_us: int, inclusive: bool):
        prev, alert, start, done = s
        if alert is not None and (alert <= upto_us if inclusive else alert < upto_us):
            return (prev, None, None, not self.repeat), [(start, alert)]
        return s, []

    def step(self, key, r):
        t, i, v = r
        s, out = self._fire(self._get(), t, inclusive=False)
        prev, alert, start, done = s
        if prev is not None and v < prev:
            alert, start, done = None, None, False
        elif prev is not None and v > prev and alert is None and not done:
            alert, start = t + self.hold, t
            self.handle.registerTimer(alert // 1000 + 1)
        self.st.update((v, alert, start, done))
        return out

    def process_due(self, key, due):
        """The row rules above, jumping between events: with an alert armed,
        the first row past the alert time fires it unless a fall comes first;
        without one, the next rise arms it (the next fall re-enables a run
        that has already alerted). Work is per alert and per fall, not per row."""
        if self.ttl_us is not None:
            return super().process_due(key, due)
        t = np.array([r[0] for r in due], dtype=np.int64)
        v = np.array([r[2] for r in due], dtype=float)
        prev0, alert, start, done = self._get()
        prev = np.r_[np.nan if prev0 is None else prev0, v[:-1]]
        known = ~np.isnan(prev)
        falls = np.flatnonzero(known & (v < prev))
        rises = np.flatnonzero(known & (v > prev))
        n, pos, out = len(t), 0, []

        def after(idx, p):
            k = np.searchsorted(idx, p, side="left")
            return int(idx[k]) if k < len(idx) else None

        while pos < n:
            if alert is not None:
                j = max(int(np.searchsorted(t, alert, side="right")), pos)
                f = after(falls, pos)
                if j < n and (f is None or j <= f):
                    out.append((start, alert))
                    alert, start, done = None, None, not self.repeat
                    pos = j
                    continue
                if f is None:
                    break
                alert, start, done = None, None, False
                pos = f + 1
                continue
            f = after(falls, pos)
            if done:
                if f is None:
                    break
                done, pos = False, f + 1
                continue
            a = after(rises, pos)
            if a is None:
                break
            if f is not None and f < a:
                pos = f + 1
                continue
            alert, start = int(t[a]) + self.hold, int(t[a])
            self.handle.registerTimer(alert // 1000 + 1)
            pos = a + 1
        self.st.update((float(v[-1]), alert, start, done))
        return out

    def on_watermark(self, key, wm_us):
        s, out = self._fire(self._get(), wm_us, inclusive=False)
        if out:
            self.st.update(s)
        return out


# ---------------------------------------------------------------- PAT4
class FollowedByProcessor(OrderedProcessor):
    """``kind`` 1 rows open a partial match; a later ``kind`` 2 row within
    ``within`` (strict) completes every open one (``success``); a match whose
    limit the watermark passes is emitted as ``timeout`` (the side output)."""

    payload = [("kind", "int")]
    out_fields = [("result", "string"), ("event_id", "long"), ("t_us", "long"),
                  ("follow_event_id", "long"), ("follow_t_us", "long")]

    def __init__(self, key_fields, within_us: int, ttl_ms: int | None = None):
        super().__init__(key_fields, ttl_ms)
        self.within = within_us

    def setup(self, handle):
        self.open = self.list_state("open", "t long, id long")

    def _open(self):
        return list(self.open.get()) if self.open.exists() else []

    def step(self, key, r):
        t, i, kind = r
        out = []
        if kind == 2:
            pend = self._open()
            done = [c for c in pend if t - c[0] < self.within]
            out = [("success", c[1], c[0], i, t) for c in done]
            rest = [c for c in pend if t - c[0] >= self.within]
            if done:
                self.open.put(rest) if rest else self.open.clear()
        if kind == 1:
            self.open.appendValue((t, i))
            self.handle.registerTimer((t + self.within) // 1000 + 1)
        return out

    def process_due(self, key, due):
        if self.ttl_us is not None:
            return super().process_due(key, due)
        t, i, kind = (np.asarray(c) for c in zip(*due))
        pend = self._open()
        cand_pos, nxt = _next_second(t, kind, pend)
        ct = np.r_[np.array([c[0] for c in pend], dtype=np.int64), t[cand_pos[len(pend):]]]
        ci = np.r_[np.array([c[1] for c in pend], dtype=np.int64), i[cand_pos[len(pend):]]]
        gap = np.where(nxt >= 0, t[np.maximum(nxt, 0)] - ct, -1)
        done = (nxt >= 0) & (gap < self.within)
        out = [("success", int(a), int(b), int(i[n]), int(t[n]))
               for a, b, n in zip(ci[done], ct[done], nxt[done])]
        keep = list(zip(ct[~done].tolist(), ci[~done].tolist()))
        self.open.put(keep) if keep else self.open.clear()
        if keep:
            self.handle.registerTimer((min(c[0] for c in keep) + self.within) // 1000 + 1)
        return out

    def on_watermark(self, key, wm_us):
        pend = self._open()
        expired = [c for c in pend if c[0] + self.within <= wm_us]
        if expired:
            rest = [c for c in pend if c[0] + self.within > wm_us]
            self.open.put(rest) if rest else self.open.clear()
            if rest:
                self.handle.registerTimer((min(c[0] for c in rest) + self.within) // 1000 + 1)
        return [("timeout", c[1], c[0], None, None) for c in sorted(expired)]


# ---------------------------------------------------------------- WIN1
class OverRowsProcessor(OrderedProcessor):
    """count / avg of the value over the current row and the ``preceding``
    rows before it (analytic windows are not allowed on streams)."""

    payload = [("v", "double")]
    out_fields = [("event_id", "long"), ("t_us", "long"), ("cnt", "long"), ("avg", "double")]

    def __init__(self, key_fields, preceding: int = 2, ttl_ms: int | None = None):
        super().__init__(key_fields, ttl_ms)
        self.preceding = preceding

    def setup(self, handle):
        self.last = self.list_state("last_values", "v double")

    def step(self, key, r):
        t, i, v = r
        prev = [x[0] for x in self.last.get()] if self.last.exists() else []
        vals = [x for x in [*prev, v] if x is not None]
        keep = [*prev, v][-self.preceding:] if self.preceding else []
        self.last.put([(x,) for x in keep]) if keep else self.last.clear()
        return [(i, t, len(vals), sum(vals) / len(vals) if vals else None)]

    def process_due(self, key, due):
        if self.ttl_us is not None:
            return super().process_due(key, due)
        prev = [x[0] for x in self.last.get()] if self.last.exists() else []
        p, P = self.preceding, len(prev)
        allv = np.array([*prev, *[r[2] for r in due]], dtype=float)
        valid = ~np.isnan(allv)
        cs = np.r_[0.0, np.cumsum(np.where(valid, allv, 0.0))]
        cn = np.r_[0, np.cumsum(valid)]
        pos = np.arange(P, len(allv))
        start = np.maximum(pos - p, 0)
        cnt = cn[pos + 1] - cn[start]
        tot = cs[pos + 1] - cs[start]
        avg = np.divide(tot, cnt, out=np.full(len(tot), np.nan), where=cnt > 0)
        out = [(int(r[1]), int(r[0]), int(k), None if k == 0 else float(a))
               for r, k, a in zip(due, cnt.tolist(), avg.tolist())]
        keep = allv[-p:].tolist() if p else []
        self.last.put([(x,) for x in keep]) if keep else self.last.clear()
        return out


# ---------------------------------------------------------------- PAT5
class NextPairsProcessor(OrderedProcessor):
    """Any row followed *immediately* (next row of the key) by a row with a
    greater value within ``within`` (strict): completed pairs are ``match``;
    a start whose next row does not come within the time is ``timeout``."""

    payload = [("v", "double")]
    out_fields = [("result", "string"), ("event_id", "long"), ("t_us", "long"), ("value", "double"),
                  ("next_event_id", "long"), ("next_t_us", "long"), ("next_value", "double")]

    def __init__(self, key_fields, within_us: int, ttl_ms: int | None = None):
        super().__init__(key_fields, ttl_ms)
        self.within = within_us

    def setup(self, handle):
        self.last = self.value_state("start", "t long, id long, v double")

    def step(self, key, r):
        t, i, v = r
        out = []
        if self.last.exists():
            lt, li, lv = self.last.get()
            if t - lt < self.within:
                if v > lv:
                    out.append(("match", li, lt, lv, i, t, v))
            else:
                out.append(("timeout", li, lt, lv, None, None, None))
        self.last.update((t, i, v))
        self.handle.registerTimer((t + self.within) // 1000 + 1)
        return out

    def process_due(self, key, due):
        if self.ttl_us is not None:
            return super().process_due(key, due)
        rows = ([tuple(self.last.get())] if self.last.exists() else []) + [tuple(r) for r in due]
        t = np.array([r[0] for r in rows], dtype=np.int64)
        ids = np.array([r[1] for r in rows], dtype=np.int64)
        v = np.array([r[2] for r in rows], dtype=float)
        in_time = (t[1:] - t[:-1]) < self.within          # consecutive (start, next) pairs
        match = np.flatnonzero(in_time & (v[1:] > v[:-1]))
        late = np.flatnonzero(~in_time)
        out = [("match", int(ids[a]), int(t[a]), float(v[a]), int(ids[a + 1]), int(t[a + 1]), float(v[a + 1]))
               for a in match.tolist()]
        out += [("timeout", int(ids[a]), int(t[a]), float(v[a]), None, None, None) for a in late.tolist()]
        self.last.update((int(t[-1]), int(ids[-1]), float(v[-1])))
        self.handle.registerTimer((int(t[-1]) + self.within) // 1000 + 1)
        return out

    def on_watermark(self, key, wm_us):
        if self.last.exists():
            lt, li, lv = self.last.get()
            if lt + self.within <= wm_us:  # its next row can no longer come in time
                self.last.clear()
                return [("timeout", li, lt, lv, None, None, None)]
        return []
