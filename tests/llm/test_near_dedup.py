"""Near-duplicate groups against brute force over full shingle sets."""
import collections
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from eventide.llm import near_dedup
from llm.fixture_docs import documents, frame, lower, words


def shingle_set(text):
    w = words(lower(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def brute(rows):
    sets = [shingle_set(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    low = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[find(i)] = min(low.get(find(i), r[0]), r[0])
    return collections.Counter((r[0], len(s), low.get(find(i)) if s else r[0], r[0] == (low.get(find(i)) if s else r[0]))
                               for i, (r, s) in enumerate(zip(rows, sets, strict=True)))


def near_rows(seed, groups=12, members=25):
    """Groups whose members drift away from each other, so that only chains link them."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(900)]
    rows, used = [], 0
    line = [rng.choice(vocab) for _ in range(14)]
    for g in range(groups):
        base = line * (g % 2) + [rng.choice(vocab) for _ in range(rng.choice([8, 30, 90]))]
        for _ in range(members):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 14))):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            rows.append((used * 7 % 9973, " ".join(w), "en", "s", 1))
            used += 1
    return rows


def result(df):
    return collections.Counter(tuple(r) for r in df.collect())


def test_groups_match_brute_force_on_awkward_rows(spark):
    rows = documents()
    assert result(near_dedup.near_groups(frame(spark, rows, extra=("node", "n", "key")))) == brute(rows)


@pytest.mark.parametrize("block", [512, 7])
def test_chains_match_brute_force(spark, block):
    rows = near_rows(block)
    assert result(near_dedup.near_groups(frame(spark, rows), block=block)) == brute(rows)


def test_rows_without_an_id_or_with_a_repeated_one(spark):
    """400 near copies without an id, and ids that several texts share: each row by its own set."""
    rng = random.Random(8)
    rows = [(None, *r[1:]) for r in near_rows(8, groups=10, members=40)]
    rows += [(rng.randrange(5), *r[1:]) for r in near_rows(9, groups=6, members=10)]
    assert result(near_dedup.near_groups(frame(spark, rows))) == brute(rows)


def test_texts_are_fetched_once_a_node(spark):
    """Rows that share a null id do not meet in the join for texts."""
    rows = [(None, f"text number {i} of some words", None, None, None) for i in range(300)]
    df = frame(spark, rows).selectExpr("cast(doc_id as long) as id", "text")
    info = (near_dedup._with_sets(df, 1, 5).groupBy("lo", "hi", "n").agg(F.min("id").alias("rep")).withColumn("node", F.monotonically_increasing_id()))
    texts = near_dedup._texts(df, info, 5)
    assert texts.count() == 300 and texts.select("text").distinct().count() == 300


def test_pairs_at_exactly_the_threshold(spark):
    """Hundreds of pairs with 75% and, next to them, just under it."""
    rng = random.Random(4)
    rows, want = [], []
    for g in range(150):
        # one changed word at the start and one at the end, far apart: 300 shingles shared of 400, or one less
        n = 350 + 4
        base = [f"g{g}w{i}" for i in range(n)]
        less = g % 3 == 0
        kept = base[50 + less:]                              # 300 or 299 of the 350 shingles of the first
        other = kept + [f"g{g}x{i}" for i in range(50 + less)]
        rows += [(2 * g, " ".join(base), "en", "s", 1), (2 * g + 1, " ".join(other), "en", "s", 1)]
        want.append((2 * g + 1, 2 * g + 1 if less else 2 * g))
    rng.shuffle(rows)
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_groups(frame(spark, rows)).collect()}
    sets = {r[0]: shingle_set(r[1]) for r in rows}
    assert all(100 * len(sets[i - 1] & sets[i]) >= 75 * len(sets[i - 1] | sets[i]) for i, c in want if c != i)
    assert [(i, got[i]) for i, _ in want] == want


def test_a_list_of_one_large_component_costs_its_members(spark):
    """Rows dealt for the last comparison: members of a list once per block of those outside its largest component."""
    lists = [(1, i, 0 if i < 4900 else i) for i in range(5000)]
    df = spark.createDataFrame(lists, "key long, node long, root long")
    info = df.select("node").withColumn("n", F.lit(10).cast("long")).withColumn("sig", F.lit(bytearray(8)).cast("binary"))
    out = near_dedup._blocks(df, info, 9, 75, 512)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode" in plan and out.count() == 0
    pairs = {(r["a"], r["b"]) for r in near_dedup._blocks(df.where("node >= 4880"), info, 8, 75, 7).distinct().collect()}
    small = [r for r in lists if r[1] >= 4880]
    assert pairs == {(a[1], b[1]) for a in small for b in small if a[1] < b[1] and a[2] != b[2]}


@pytest.mark.parametrize("block, span", [(512, 1 << 20), (9, 1 << 20), (512, 2000)])
def test_blocks_confirm_their_pairs_and_give_links_only(spark, block, span):
    """A group whose members are mostly just under the threshold: its pairs never become rows, and no link is lost."""
    rng = random.Random(6)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(240):
        w = list(base)
        for at in rng.sample(range(120), 2 + i % 3):
            w[at] = f"x{i}y{at}"
        rows.append((i, " ".join(w)))
    sets = [shingle_set(t) for _, t in rows]
    near = {(i, j) for j in range(240) for i in range(j) if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])}
    assert 50 < len(near) < 240 * 239 // 4

    texts = spark.createDataFrame(rows, "node long, text string").repartition(3)
    info = texts.join(spark.createDataFrame([(i, len(s)) for i, s in enumerate(sets)], "node long, n long"), "node")
    lists = texts.selectExpr("explode(array(1L, 2L)) as key", "node", "node as root")
    info = near_dedup.wide_signatures(lists, info, texts, 5, 64)
    members = near_dedup._blocks(lists, info, 0, 75, block, candidates=True, block_shingles=span)
    got = [tuple(r) for r in near_dedup._links(members, texts, 5, 75).collect()]
    assert {tuple(sorted(p)) for p in got} <= near and near_dedup._blocks(lists, info, 0, 75, block).count() > 20_000
    if (block, span) == (512, 1 << 20):
        assert members.count() <= 480 and len(got) < 240

    def groups(pairs):
        root = list(range(240))
        for a, b in pairs:
            root = [min(root[a], root[b]) if r in (root[a], root[b]) else r for r in root]
        return root

    assert groups(got) == groups(near)


def test_empty_table_and_texts_without_words(spark):
    assert near_dedup.near_groups(frame(spark, [])).count() == 0
    rows = [(1, None, None, None, None), (2, " ", None, None, 1), (None, "", None, None, 0)]
    assert result(near_dedup.near_groups(frame(spark, rows))) == brute(rows)


def test_keep_one_leaves_one_row_of_each_group(spark):
    rows = near_rows(5, groups=4)
    df = near_dedup.keep_one(frame(spark, rows, extra=("row", "_keep")))
    assert sorted(r["doc_id"] for r in df.collect()) == sorted(k[0] for k in brute(rows) if k[3])
    assert df.columns[-2:] == ["row", "_keep"]


def test_keep_one_judges_each_text_of_an_id(spark):
    a, b = "one two three four five six seven", "eight nine ten eleven twelve thirteen"
    rows = [(3, a, None, None, 1), (7, b, None, None, 1), (7, a, None, None, 1), (None, a, None, None, 1), (None, "alone in the table", None, None, 1), (9, None, None, None, 0)]
    got = near_dedup.keep_one(frame(spark, rows, extra=("n", "lo", "id")))
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str) == sorted([(3, a), (7, b), (None, "alone in the table"), (9, None)], key=str)


def test_signatures_agree_with_set_similarity():
    rng = random.Random(2)
    words_ = [f"x{i}" for i in range(4000)]
    base = [rng.choice(words_) for _ in range(800)]
    other = base[:700] + [rng.choice(words_) for _ in range(100)]
    row, h = near_dedup.shingles(pa.array([" ".join(base), " ".join(other)]))
    n, _, _ = near_dedup.set_sums(row, h, 2)
    _, sig = near_dedup.signatures(row, h, n, near_dedup.POSTED, near_dedup.PROBED)
    a, b = (set(h[row == i].tolist()) for i in (0, 1))
    assert abs((sig[0] == sig[1]).mean() - len(a & b) / len(a | b)) < 0.1


def test_contract_finds_components_of_long_chains(spark):
    rng = np.random.default_rng(1)
    names = rng.permutation(300).tolist()
    edges = [(names[i], names[i + 1]) for i in range(299) if i not in (99, 199)]
    got = {r["node"]: r["root"] for r in near_dedup.contract(spark.createDataFrame(edges, "a long, b long")).collect()}
    for part in (names[:100], names[100:200], names[200:]):
        assert {got[x] for x in part} == {min(part)}


def test_texts_go_to_python_once(spark, monkeypatch):
    """For the sets; what comes after fetches texts and rows by joins."""
    plans = []
    saved = near_dedup.saved

    def noted(df, name, *by):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return saved(df, name, *by)

    monkeypatch.setattr(near_dedup, "saved", noted)
    kept = near_dedup.keep_one(frame(spark, near_rows(3, groups=2, members=5)))
    assert "MapInArrow" in dict(plans)["near-sets"]
    assert "MapInArrow" not in dict(plans)["near-texts"]
    assert "MapInArrow" not in kept._jdf.queryExecution().executedPlan().toString()


def test_sets_of_a_large_batch_are_made_in_small_steps():
    rng = random.Random(4)
    text = [" ".join(f"w{rng.randrange(9000)}" for _ in range(500)) for _ in range(400)] * 10
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(text))), pa.array(text), pa.array([b""] * len(text))], ["id", "text", "digest"])
    tracemalloc.start()
    rows = sum(x.num_rows for x in near_dedup._sets(near_dedup.POSTED, near_dedup.PROBED, 5)(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == len(text) and peak < 60e6 < 6 * batch.nbytes
