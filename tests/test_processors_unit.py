"""Vectorised and row-by-row paths of the stream processors agree (no Spark needed):
random batches of one hot key, replayed through an in-memory state handle."""

import random

import pytest

from eventide.streaming.processors import (ClickCapProcessor, ConsecutiveProcessor, FollowedByProcessor,
                                           JumpProcessor, MissingFollowupProcessor, NextPairsProcessor,
                                           OrderedProcessor, OverRowsProcessor, RisingAlertProcessor)


class _Value:
    def __init__(self):
        self.v = None

    def exists(self):
        return self.v is not None

    def get(self):
        return self.v

    def update(self, v):
        self.v = tuple(v)

    def clear(self):
        self.v = None


class _List:
    def __init__(self):
        self.v = []

    def exists(self):
        return bool(self.v)

    def get(self):
        return iter(list(self.v))

    def put(self, rows):
        self.v = [tuple(r) for r in rows]

    def appendValue(self, r):
        self.v.append(tuple(r))

    def appendList(self, rows):
        self.v.extend(tuple(r) for r in rows)

    def clear(self):
        self.v = []


class _Map:
    def __init__(self):
        self.v, self.reads = {}, 0

    def exists(self):
        return bool(self.v)

    def containsKey(self, k):
        return tuple(k) in self.v

    def getValue(self, k):
        self.reads += 1
        return self.v[tuple(k)]

    def updateValue(self, k, v):
        self.v[tuple(k)] = tuple(v)

    def removeKey(self, k):
        self.v.pop(tuple(k), None)

    def iterator(self):
        return iter(list(self.v.items()))

    def keys(self):
        return iter(list(self.v))


class _Handle:
    def getMapState(self, name, k, v, ttl=None):
        return _Map()

    def getValueState(self, name, schema, ttl=None):
        return _Value()

    def getListState(self, name, schema, ttl=None):
        return _List()

    def registerTimer(self, ms):
        pass

    def deleteTimer(self, ms):
        pass


def _rows_path(p, key, due):
    return OrderedProcessor.process_due(p, key, due)


KEY = [("k", "long")]
WITHIN = 5_000_000


def _make(kind):
    return {
        "jump": lambda: JumpProcessor(KEY, 3.0),
        "cap": lambda: ClickCapProcessor(KEY, 2),
        "unpaid": lambda: MissingFollowupProcessor(KEY, WITHIN),
        "not_followed": lambda: MissingFollowupProcessor(KEY, WITHIN, inclusive=False),
        "followed": lambda: FollowedByProcessor(KEY, WITHIN),
        "pairs2": lambda: ConsecutiveProcessor(KEY, 2, WITHIN),
        "pairs3": lambda: ConsecutiveProcessor(KEY, 3, WITHIN),
        "over": lambda: OverRowsProcessor(KEY, 2),
        "next": lambda: NextPairsProcessor(KEY, WITHIN),
        "rise": lambda: RisingAlertProcessor(KEY, WITHIN),
        "rise_repeat": lambda: RisingAlertProcessor(KEY, WITHIN, repeat=True),
    }[kind]()


def _payload(kind, rnd):
    if kind in ("jump", "over", "next"):
        return float(rnd.randint(0, 9))
    if kind in ("rise", "rise_repeat"):
        return float(rnd.choice([0, 1, 1, 2, 2, 2]))  # mostly rising or flat, some falls
    if kind == "cap":
        return None  # day, filled from t
    if kind in ("pairs2", "pairs3"):
        return rnd.random() < 0.6
    return rnd.choice([1, 2, 2])


@pytest.mark.parametrize("kind", ["jump", "cap", "unpaid", "not_followed", "followed", "pairs2", "pairs3",
                                  "over", "next", "rise", "rise_repeat"])
def test_vectorised_equals_row_by_row(kind):
    rnd = random.Random(hash(kind) % 1000)
    a, b = _make(kind), _make(kind)
    for p in (a, b):
        p.init(_Handle())
    t, out_a, out_b = 0, [], []
    for batch in range(30):
        due = []
        for _ in range(rnd.randint(0, 25)):
            t += rnd.randint(0, 3_000_000)
            pay = _payload(kind, rnd)
            if kind == "cap":
                pay = t // 86_400_000_000 + (t // 40_000_000)  # frequent day changes
            due.append((t, len(out_a) * 100 + len(due) + batch * 10_000, pay))
        if due:
            out_a += a.process_due((7,), list(due))
            out_b += _rows_path(b, (7,), list(due))
        wm = t + rnd.randint(0, 4_000_000)
        out_a += a.on_watermark((7,), wm)
        out_b += b.on_watermark((7,), wm)

    def norm(rows):
        return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in rows)
    assert norm(out_a) == norm(out_b)
    assert out_a or kind in ()


class _Timer:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms

    def getExpiryTimeInMs(self):
        return self.ms


def test_a_timer_reads_due_slices_only():
    import pandas as pd
    p = JumpProcessor([("k", "long")], 1.0)
    p.init(_Handle())
    p.slice_us = 60_000_000
    minute, rng, rows = 60_000_000, random.Random(2), []
    for part in range(5):                                   # five batches over 100 slices
        new = [(s * minute + rng.randrange(minute), part * 100 + s, float(s)) for s in range(100)]
        rows += new
        p.handleInputRows((1,), iter([pd.DataFrame(new, columns=p._cols())]), _Timer(0))
    assert p.buf.reads == 0                                 # adding rows reads no slice
    got = []
    for upto in (10, 11, 40):
        before = p.buf.reads
        for out in p.handleExpiredTimer((1,), _Timer(upto * 60_000), _Timer(upto * 60_000)):
            got += out["event_id"].tolist()
        assert p.buf.reads - before <= 5 * {10: 10, 11: 1, 40: 29}[upto]
    assert got == [r[1] for r in sorted(rows) if r[0] < 40 * minute]
    assert len(p.buf.v) == 5 * 60 and len(p._index()) == 60


def test_a_watermark_inside_a_slice_keeps_the_rest():
    import pandas as pd
    p = JumpProcessor([("k", "long")], 1.0)
    p.slice_us = 60_000_000
    p.init(_Handle())
    rows = [(t * 1_000_000, t, float(t)) for t in (5, 50, 20, 59, 61)]
    p.handleInputRows((1,), iter([pd.DataFrame(rows, columns=p._cols())]), _Timer(0))
    got = [i for ms in (30_000, 30_000, 60_000, 90_000) for out in p.handleExpiredTimer((1,), _Timer(ms), _Timer(ms)) for i in out["event_id"]]
    assert got == [5, 20, 50, 59, 61] and not p.buf.v and not p._index()
