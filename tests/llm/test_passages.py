"""Repeated passages (suffix arrays and FM-index) against brute force on every window."""
import collections
import hashlib
import random

import numpy as np
import pytest

from eventide.llm import passages, substring_dedup, suffix_dedup
from llm.fixture_docs import documents, frame, words

BIG = 2**63 - 1


def windows(rows, size):
    """Sequence -> places, as (row, start)."""
    out = collections.defaultdict(list)
    for i, r in enumerate(rows):
        w = words(r[1])
        for a in range(len(w) - size + 1):
            out[tuple(w[a:a + size])].append((i, a))
    return out


def brute_removed(rows, size):
    low = {k: min(BIG if rows[i][0] is None else rows[i][0] for i, _ in v) for k, v in windows(rows, size).items()}
    out = collections.Counter()
    for r in rows:
        w = words(r[1])
        gone = [False] * len(w)
        for a in range(len(w) - size + 1):
            if low[tuple(w[a:a + size])] < (BIG if r[0] is None else r[0]):
                gone[a:a + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[r[0], len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


def brute_repeats(rows, size):
    found = windows(rows, size)
    out = set()
    for r in rows:
        w = words(r[1])
        mask = np.zeros(len(w), bool)
        n = {}
        for a in range(len(w) - size + 1):
            v = found[tuple(w[a:a + size])]
            if len(v) > 1:
                mask[a:a + size] = True
                n[a] = len(v), min(BIG if rows[i][0] is None else rows[i][0] for i, _ in v)
        for a, b in passages.spans(mask):
            first = n[a][1]
            out.add((r[0], a, b, b - a, None if first == BIG else first, max(n[x][0] for x in range(a, b) if x in n)))
    return out


def quilt(seed, n=80, size=50):
    """Texts sewn from shared and own runs of words around the threshold, some periodic."""
    rng = random.Random(seed)
    vocab = [f"v{i}" for i in range(60)]
    runs = [[rng.choice(vocab) for _ in range(rng.choice([size - 1, size, size + 1, size * 2]))] for _ in range(8)]
    rows = []
    for i in range(n):
        w = []
        for _ in range(rng.randint(0, 5)):
            kind = rng.random()
            if kind < 0.5:
                r = rng.choice(runs)
                a = rng.randint(0, 3)
                w += r[a:len(r) - rng.randint(0, 3)]
            elif kind < 0.6:
                w += [vocab[0], vocab[1]] * rng.randint(5, size)
            else:
                w += [rng.choice(vocab) for _ in range(rng.randint(0, size))]
        rows.append((rng.choice([i, i, i * 2]), rng.choice([" ", "\n"]).join(w), None, None, 0))
    return rows


def removed(spark, rows, size=50, **kw):
    df = substring_dedup.removed_words(frame(spark, rows, **kw), min_words=size)
    return collections.Counter((r["doc_id"], r["n_words"], r["n_removed"], hashlib.sha256(r["kept_text"].encode()).hexdigest()) for r in df.collect())


def repeats(spark, rows, size=50, **kw):
    return {tuple(r) for r in suffix_dedup.repeated_passages(frame(spark, rows, **kw), min_words=size).collect()}


@pytest.mark.parametrize("rows,size", [(documents(), 50), (quilt(1), 50), (quilt(2, size=20), 20)])
def test_both_match_brute_force(spark, rows, size):
    extra = ("doc", "rid", "start", "key")
    assert removed(spark, rows, size, extra=extra) == brute_removed(rows, size)
    assert repeats(spark, rows, size, extra=extra) == brute_repeats(rows, size)


@pytest.mark.parametrize("copies,hot", [(1, 20_000), (2, 20_000), (2, 0)])
def test_rows_equal_in_id_and_text_count_once_each(spark, monkeypatch, copies, hot):
    """A row three times, and one or two copies of it under other ids."""
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(4, text, None, None, 0)] * 3 + [(9 + i, text + " more", None, None, 0) for i in range(copies - 1)] + [(None, text, None, None, 0)] * (copies - 1)
    monkeypatch.setattr(passages.judged_windows, "__defaults__", (50, hot, 500))
    got = repeats(spark, rows)
    assert got == brute_repeats(rows, 50) and {g[5] for g in got} == {len(rows)}
    assert removed(spark, rows) == brute_removed(rows, 50)


@pytest.mark.parametrize("module", [suffix_dedup, substring_dedup])
def test_hot_keys_are_compared_window_by_window(spark, module, monkeypatch):
    rows = quilt(3)
    monkeypatch.setattr(passages.judged_windows, "__defaults__", (50, 1, 500))
    if module is suffix_dedup:
        assert repeats(spark, rows) == brute_repeats(rows, 50)
    else:
        assert removed(spark, rows) == brute_removed(rows, 50)


def test_empty_table(spark):
    assert removed(spark, []) == collections.Counter() and repeats(spark, []) == set()
    short = [(1, "too short", None, None, 0), (2, None, None, None, None)]
    assert removed(spark, short) == brute_removed(short, 50) and repeats(spark, short) == set()


def test_judges_agree():
    rng = np.random.default_rng(0)
    seqs, count, anchor, key = [], [], [], rng.integers(1, 9, 6).astype(np.uint64)
    for _ in range(200):
        left, right = rng.integers(0, 5), rng.integers(6, 11)
        s = np.concatenate([rng.integers(1, 3, left), key, rng.integers(1, 3, right)]).astype(np.uint64)
        size = 10
        # windows of 10 words that hold the whole key
        lo, hi = max(0, left + 6 - size), min(left, len(s) - size)
        if lo > hi:
            continue
        seqs.append(s[lo:hi + size]), count.append(hi - lo + 1), anchor.append(left - lo)
    doc, places = rng.integers(0, 50, len(seqs)), rng.integers(1, 3, len(seqs))
    a = suffix_dedup.judge(seqs, np.array(count), np.array(anchor), doc, places, 10)
    b = substring_dedup.judge(seqs, np.array(count), np.array(anchor), doc, places, 10)
    table = collections.defaultdict(list)
    for i, s in enumerate(seqs):
        for j in range(count[i]):
            table[tuple(s[j:j + 10].tolist())].append(i)
    for i, s in enumerate(seqs):
        for j in range(count[i]):
            own = table[tuple(s[j:j + 10].tolist())]
            want = min(doc[k] for k in own), sum(places[k] for k in own)
            assert (a[0][i][j], a[1][i][j]) == want == (b[0][i][j], b[1][i][j])
