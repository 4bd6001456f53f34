"""Exact dedup and mixing against brute force; edge cases."""
import collections
import hashlib

import pytest
from pyspark.sql import functions as F

from eventide.llm import exact_dedup, mixing
from llm.fixture_docs import documents, frame, lower, words


@pytest.mark.parametrize("capacity", [1_000_000, 3])
def test_exact_dedup_matches_brute_force(spark, capacity):
    rows = documents()
    groups = collections.defaultdict(list)
    for r in rows:
        groups[lower(r[1])].append(r[0])
    want = collections.Counter()
    for r in rows:
        ids = groups[lower(r[1])]
        top = max((i for i in ids if i is not None), default=None)
        want[r[0], top, len(ids), r[0] == top, hashlib.sha256(lower(r[1]).encode()).hexdigest()] += 1
    df = exact_dedup.exact_dedup(frame(spark, extra=("key", "digest", "keep_id", "_id", "bucket")), capacity=capacity)
    assert collections.Counter(tuple(r) for r in df.collect()) == want


def test_directory_doubles_and_buckets_cover_all(spark):
    index = exact_dedup.build_index(frame(spark), capacity=3)
    sizes = {r["bucket"]: r["count"] for r in index.groupBy("bucket").count().collect()}
    assert max(sizes.values()) <= 3 and sum(sizes.values()) == index.count()


def test_chained_texts_of_one_key_stay_apart(spark):
    index = exact_dedup.build_index(frame(spark))
    assert index.where("chain > 1").count() == 0          # no 64-bit collision here
    assert index.groupBy("key", "digest").count().where("count > 1").isEmpty()


def test_keep_one_keeps_columns_and_largest_id(spark):
    df = exact_dedup.keep_one(frame(spark, extra=("key", "row", "id")))
    assert df.columns == ["doc_id", "text", "lang", "source", "n_chars", "key", "row", "id"]
    got = [(r["doc_id"], lower(r["text"])) for r in df.collect()]
    assert {t for _, t in got} == {lower(r[1]) for r in documents()}
    assert len(got) == len({t for _, t in got}) + 1       # one row is repeated, id and all


def test_empty_tables(spark):
    none = frame(spark, [])
    assert exact_dedup.exact_dedup(none).count() == 0 and exact_dedup.keep_one(none).count() == 0
    assert mixing.mix(none).count() == 0 and mixing.repeated(none).count() == 0


def water_fill(sizes, epochs=3):
    """Targets by redistributing the excess until none is left."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(epochs * sizes[s] for s in capped)
        level = left / max(1, sum(weight[s] for s in free))
        over = {s for s in free if weight[s] * level > epochs * sizes[s]}
        if not over:
            return {s: epochs * sizes[s] if s in capped else weight[s] * level for s in order}
        capped |= over


def test_mix_targets_and_taken_words(spark):
    rows = documents(n=400)
    sizes = collections.Counter()
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    want = water_fill(sizes)
    got = mixing.mix(frame(spark, rows, extra=("_size", "row", "_src", "source_size"))).collect()
    assert len(got) == len(rows)
    taken = collections.Counter()
    longest = collections.Counter()
    for r in got:
        s = r["row"]["source"]
        assert r["_size"] == len(words(r["row"]["text"])) and r["_source_size"] == sizes[s]
        assert r["_target"] == pytest.approx(want[s])
        assert 0 <= r["_reps"] <= 3
        taken[s] += r["_size"] * r["_reps"]
        longest[s] = max(longest[s], r["_size"])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= longest[s]


def test_mix_reruns_agree_whatever_the_partitions(spark):
    rows = documents(n=100)
    once, again = (sorted((r["doc_id"] or -1, r["_size"], r["_reps"]) for r in mixing.mix(frame(spark, rows, parts)).collect()) for parts in (1, 7))
    assert once == again


def test_repeated_gives_the_rows_of_the_mix(spark):
    rows = documents(n=100)
    reps = mixing.mix(frame(spark, rows)).agg(F.sum("_reps")).first()[0]
    df = mixing.repeated(frame(spark, rows, extra=("_copy",)))
    assert df.count() == reps and df.columns == ["doc_id", "text", "lang", "source", "n_chars", "_copy"]
