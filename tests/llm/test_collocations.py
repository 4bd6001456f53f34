"""Collocations against brute force, whatever the sizes of groups and bitmap."""
import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from eventide.llm import collocations as co
from llm.fixture_docs import documents, frame, lower

PIECE = re.compile("[.,;:!?\n\x0b\x0c\r]")


def phrase_documents():
    rng = random.Random(9)
    rows = documents(n=40)
    vocab = ["the", "of", "a", "cat", "dog", "Cat", "sat", "on", "mat\x01", "é", "\x1f", "new", "york", "city", "x\x00y", "\xa0"]
    common = ["new york city hall", "the cat sat on", "on the mat\x01", "of the of the"]
    for i in range(150):
        out = []
        for _ in range(rng.randint(0, 60)):
            out.append(rng.choice(common) if rng.random() < .4 else rng.choice(vocab))
            out.append(rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", " ; "]))
        rows.append((3000 + i, "".join(out), rng.choice(["en", "en", "de", None, "und"]), "src0", 0))
    return rows + [(None, "the of " * 4000, "en", None, None)]


def brute(rows, top=2000, least=30):
    f, n = defaultdict(Counter), Counter()
    for r in rows:
        lang = "und" if r[2] is None else r[2]
        for piece in PIECE.split(lower(r[1])):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for i in range(len(w)):
                for k in range(1, 5):
                    if i + k <= len(w):
                        f[lang][tuple(w[i:i + k])] += 1
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) >= 2 and a >= least}
        inside = defaultdict(int)
        for p, a in cand.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i:i + k]] = max(inside[p[i:i + k]], a)
        rows_ = []
        for p, a in cand.items():
            if 100 * inside[p] >= 80 * a:
                continue
            score, _, l, r = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            rows_.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(rows_)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("sizes", [{}, {"group_words": 1500, "n_bits": 1 << 16}, {"top": 5, "group_words": 400, "n_bits": 32768}])
def test_collocations_match_brute_force(spark, sizes):
    rows = phrase_documents()
    got = co.collocations(frame(spark, rows, extra=("phrase", "words", "f", "group", "a")), **sizes)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, top=sizes.get("top", 2000))


def test_small_steps_and_batches_change_nothing(spark, monkeypatch):
    rows = phrase_documents()[:90]
    monkeypatch.setattr(co, "STEP_BYTES", 500)
    got = co.collocations(frame(spark, rows, parts=7), group_words=2000, min_count=3)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, least=3)


def test_a_full_bitmap_loses_nothing(spark):
    rows = phrase_documents()
    some = co.frequent_phrases(frame(spark, rows), n_bits=32768)[0]
    assert sorted(map(tuple, some.collect())) == sorted(map(tuple, co.frequent_phrases(frame(spark, rows), n_bits=1 << 24)[0].collect()))


def test_bitmap_agrees_with_the_hash_in_tasks(spark):
    words = [("en", w) for w in ("the", "é", "", "x\x00y", "😀")]
    bits = co.bitmap(spark.createDataFrame(words, "lang string, phrase string"), 1 << 16)
    assert len(bits) == 8192 and sum(map(int.bit_count, bits)) == len({co.bucket(a.encode(), b.encode(), 1 << 16) for a, b in words})
    for a, b in words:
        h = co.bucket(a.encode(), b.encode(), 1 << 16)
        assert bits[h >> 3] >> (h & 7) & 1


def test_words_and_runs():
    b = pa.record_batch({"lang": ["en", None, "en"], "text": ["A b.c  d", None, "e,f g"]})
    w = co.Words(b)
    words = w.words.to_pylist()
    assert [words[c] for c in w.code] == [b"a", b"b", b"c", b"d", b"e", b"f", b"g"]
    assert w.run.tolist() == [2, 1, 2, 1, 1, 2, 1] and [w.langs[i].as_py() for i in w.lang] == ["en"] * 7


def test_empty_tables(spark):
    assert co.collocations(frame(spark, [])).count() == 0
    assert co.collocations(frame(spark, [(1, None, None, None, None), (2, " .,", "en", None, None)])).count() == 0


def test_products_beyond_64_bits(spark):
    big = 9_000_000_000_000_000_000
    row = spark.createDataFrame([(big, big, 1)], "a long, l long, r long")
    got = row.select(F.expr("1").alias("x"), (co._exact("a") * 2_000_000).alias("al"), (co._exact("l") + co._exact("r")).alias("lr")).select(F.expr("al div lr")).first()[0]
    assert got == 2_000_000 * big // (big + 1)
