"""Stream forms of the keyed rules, with the batch operators' signatures.

Each wraps :func:`eventide.streaming.processors.run_ordered`: the stream must
carry a watermark on ``ts`` (TIMESTAMP, see ``with_event_time``); ``tiebreak``
orders rows of equal time, as the batch operators' second order column does.
Key types are read from the stream's schema.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from eventide.functions.timefn import duration_us
from eventide.streaming import processors as P


def _key_fields(df: DataFrame, keys: Sequence[str]) -> list[tuple[str, str]]:
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return [(k, types[k]) for k in keys]


def stream_rate_cap(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: str, max_count: int,
                    day_tz: str = "UTC", ttl_ms: int | None = None, carry: Sequence[str] = (),
                    event_time: str = "") -> DataFrame:
    """STA1 on a stream: rows tagged ``output`` = ``pass`` / ``warn``, with the
    columns ``carry``; ``event_time`` names an output column that is the event
    time of a following step (a windowed count of the rows that passed)."""
    # instant -> UTC wall clock -> wall clock in day_tz, whatever the session zone
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col(ts).cast("timestamp_ntz"))
    local = utc if day_tz == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(day_tz), utc)
    day = F.datediff(F.to_date(local), F.lit("1970-01-01").cast("date")).cast("long").alias("day")
    proc = P.ClickCapProcessor(_key_fields(df, keys), max_count, ttl_ms, _key_fields(df, carry), event_time)
    return P.run_ordered(df, list(keys), ts, tiebreak, [day, *carry], proc, event_time)


def _kind(first: Column, second: Column) -> Column:
    return F.when(first, 1).when(second, 2).otherwise(0).alias("kind")


def stream_followed_by(df: DataFrame, key: str, ts: str, tiebreak: str, first: Column, second: Column,
                       within: str, ttl_ms: int | None = None) -> DataFrame:
    """PAT4 on a stream: ``result`` = ``success`` (with the follow row) or ``timeout``."""
    d = df.where(first | second)
    proc = P.FollowedByProcessor(_key_fields(df, [key]), duration_us(within), ttl_ms)
    return P.run_ordered(d, [key], ts, tiebreak, [_kind(first, second)], proc)


def stream_missing_followup(df: DataFrame, key: str, ts: str, tiebreak: str, first: Column, second: Column,
                            within: str, inclusive: bool = True, ttl_ms: int | None = None) -> DataFrame:
    """STA3 (``inclusive=True``) / PAT6 not-followed-by (``False``) on a stream."""
    d = df.where(first | second)
    proc = P.MissingFollowupProcessor(_key_fields(df, [key]), duration_us(within), ttl_ms, inclusive)
    return P.run_ordered(d, [key], ts, tiebreak, [_kind(first, second)], proc)


def stream_consecutive(df: DataFrame, key: str, ts: str, tiebreak: str, cond: Column, times: int = 2,
                       within: str = "1 day", ttl_ms: int | None = None, emit: str = "last") -> DataFrame:
    """PAT1/PAT2 on a stream: the first and last row of each run of ``times``;
    ``emit='list'`` adds the ids of all its rows. Behind
    :func:`eventide.streaming.late.stream_split_late` late rows go to a side output."""
    proc = P.ConsecutiveProcessor(_key_fields(df, [key]), times, duration_us(within), ttl_ms, emit)
    return P.run_ordered(df, [key], ts, tiebreak, [cond.alias("c")], proc)


def stream_jump_flag(df: DataFrame, key: str, ts: str, tiebreak: str, value: str, limit: float,
                     first_prev: float = 0.0, ttl_ms: int | None = None) -> DataFrame:
    """WIN3 on a stream."""
    proc = P.JumpProcessor(_key_fields(df, [key]), limit, first_prev, ttl_ms)
    return P.run_ordered(df, [key], ts, tiebreak, [F.col(value).cast("double").alias("v")], proc)


def stream_over_rows(df: DataFrame, key: str, ts: str, tiebreak: str, value: str, preceding: int = 2,
                     ttl_ms: int | None = None) -> DataFrame:
    """WIN1 on a stream: count / avg over the row and the ``preceding`` rows before it."""
    proc = P.OverRowsProcessor(_key_fields(df, [key]), preceding, ttl_ms)
    return P.run_ordered(df, [key], ts, tiebreak, [F.col(value).cast("double").alias("v")], proc)


def stream_next_pairs(df: DataFrame, key: str, ts: str, tiebreak: str, value: str, within: str,
                      ttl_ms: int | None = None) -> DataFrame:
    """PAT5 on a stream: ``result`` = ``match`` (next row greater, in time) or ``timeout``."""
    proc = P.NextPairsProcessor(_key_fields(df, [key]), duration_us(within), ttl_ms)
    return P.run_ordered(df, [key], ts, tiebreak, [F.col(value).cast("double").alias("v")], proc)


def stream_rising_alert(df: DataFrame, key: str, ts: str, tiebreak: str, value: str, hold: str,
                        repeat: bool = False, ttl_ms: int | None = None) -> DataFrame:
    """STA2 on a stream; ``repeat=True`` re-arms at the next rise after an alert."""
    proc = P.RisingAlertProcessor(_key_fields(df, [key]), duration_us(hold), repeat, ttl_ms)
    return P.run_ordered(df, [key], ts, tiebreak, [F.col(value).cast("double").alias("v")], proc)
