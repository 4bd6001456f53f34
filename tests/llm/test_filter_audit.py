"""Filter audit against brute force; the tries by themselves."""
import random
import re
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from eventide.llm import filter_audit as fa
from llm.fixture_docs import documents, frame, words

LABELS = "doc_id long, quality int, toxic int"


def audit_documents():
    rng = random.Random(11)
    rows = documents()
    opening = "The same long opening of many texts, " * 5
    rows += [(1000 + i, opening + rng.choice("abcdef") * rng.randint(0, 3), "en", "src0", 0) for i in range(60)]
    rows += [(2000 + i, rng.choice(["SHOUT " * 50, "a b c " * 90, "price 5$", "x & y " + "word " * 250, "", "Ünïcode ÄÖ"]), rng.choice(["en", "de", None, ""]), None, 0) for i in range(80)]
    rows += [(3000, "a" * n, "de", "src1", 0) for n in range(40)]
    rows += [(7, "copy of the id", "fr", "src1", 0), (7, "copy of the id", "fr", "src1", 0), (7, "copy of the id", "de", "src1", 0), (None, "copy of the id", "fr", None, 0)]
    return rows


def labels():
    rng = random.Random(4)
    return [(r[0], rng.choice([0, 1, None]), rng.choice([0, 0, 1, None])) for r in audit_documents() if rng.random() < .7] + [(7, 1, 1), (7, 0, 0), (None, 1, 1)]


def fails(rows):
    least = {}
    for r in rows:
        if r[0] is not None:
            least[r[1] or ""] = min(least.get(r[1] or "", r[0]), r[0])
    for r in rows:
        t = r[1] or ""
        w = words(t)
        upper = len(re.findall("[A-Z]", t))
        yield r, "".join(n for n, bad in zip("ABCDE", (len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * upper > 3 * len(t),
                                                         re.search(r"[#$%&*|]", t), r[0] is not None and r[0] > least[t]), strict=True) if bad)


def brute(rows, labelled):
    good = {i for i, q, _ in labelled if q == 1 and i is not None}
    toxic = {i for i, _, t in labelled if t == 1 and i is not None}
    out, shares = Counter(), Counter()
    judged = list(fails(rows))
    for part in {r[2] or "" for r in rows}:
        mine = [(r, f) for r, f in judged if (r[2] or "") == part]
        for order in permutations("ABCDE"):
            left, gone = mine, []
            for step, name in enumerate(order, 1):
                removed = [x for x in left if name in x[1]]
                left = [x for x in left if name not in x[1]]
                key = part, "".join(order), step
                out[key] = (len(left), len(removed), sum(name in f for _, f in gone), sum(f == name for _, f in mine),
                            sum(r[0] in good for r, _ in removed), sum(r[0] in toxic for r, _ in removed))
                shares[part, name] += len(removed)
                gone = gone + removed
    return {k: (*v, shares[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


@pytest.mark.parametrize("sizes", [{}, {"part_bytes": 2000, "task_bytes": 20_000}])
def test_audit_matches_brute_force(spark, sizes):
    rows = audit_documents()
    docs = frame(spark, rows, extra=("part", "mask", "range", "task", "head"))
    known = spark.createDataFrame(labels(), LABELS).withColumn("part", F.lit("clash")).withColumn("good", F.lit(9))
    got = fa.audit(docs, known, **sizes).collect()
    want = brute(rows, labels())
    assert len(got) == len(want) and {tuple(r)[:3]: tuple(r)[3:] for r in got} == want


def test_masks_flag_every_larger_id(spark):
    rows = audit_documents()
    got = Counter(tuple(r) for r in fa.masks(frame(spark, rows, parts=9), part_bytes=500).collect())
    assert got == Counter((r[0], r[2] or "", sum(1 << "ABCDE".index(c) for c in f)) for r, f in fails(rows))


def test_trie_keeps_texts_apart():
    rng = random.Random(1)
    texts = [b"", *(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9))) for _ in range(600)), b"a" * 5000, b"a" * 5000 + b"b", b"a" * 4999 + b"c"]
    trie, least = fa.Trie(), {}
    for i in rng.sample(range(len(texts)), len(texts)):
        trie.leaf(texts[i]).add(i)
        least[texts[i]] = min(least.get(texts[i], i), i)
    assert {x.text: x.least for x in trie.leaves()} == least
    assert trie.bytes == sum(map(len, least))
    # compressed: an inner node forks or ends a text, so there are fewer of them than texts
    todo, inner = [trie.root], 0
    while todo:
        n = todo.pop()
        if isinstance(n, fa.Node):
            inner += 1
            assert n is trie.root or len(n.below) + (n.end is not None) >= 2
            todo += n.below.values()
    assert inner <= len(least)


def test_long_texts_that_differ_at_the_end():
    trie = fa.Trie()
    long = b"word " * 400_000
    for i, t in enumerate([long + b"x", long + b"y", long, long + b"x"]):
        trie.leaf(t).add(i)
    assert sorted((x.text[-1:], x.least) for x in trie.leaves()) == [(b" ", 2), (b"x", 0), (b"y", 1)]


def test_ranges_bound_by_the_shortest_prefix():
    r = fa.Ranges([("aaa", "abz", 10), ("acd", "zz", 10_000), ("äx", "ü", 5)], part_bytes=1000)
    assert r.bounds == [b"", b"ac", "ä".encode()] and r.splits == [1, 10, 1] and r.parts == 12
    assert r.part(b"") == 0 and r.part(b"abzz") == 0 and 1 <= r.part(b"ac") <= 10 and r.part("ö".encode()) == 11


def test_empty_tables(spark):
    none = spark.createDataFrame([], LABELS)
    assert fa.audit(frame(spark, []), none).count() == 0
    assert fa.audit(frame(spark, [(1, None, None, None, None)]), none).count() == 600
