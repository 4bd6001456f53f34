"""Toxicity: folding, exceptions, learning, held-out accuracy."""
import math
import random
import time
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from eventide.llm import toxicity
from eventide.llm.queries import QUERIES
from llm.fixture_docs import documents, frame

SF = "/root/testdata/sf0.1"


def test_folding():
    t = toxicity.Folding()
    assert toxicity.fold("ІD10T!!  1d1оt-Ｉｄｉｏｔ i\u200bd\u0301iot", t) == " idiot idiot idiot idiot "
    assert toxicity.fold("", t) == toxicity.fold(" .!", t) == " "


def test_exceptions_and_word_starts():
    m = toxicity.Matcher(toxicity.Lexicon({" clown ": 4.0, " bad": 3.0}, ("clown fish",)))
    assert m.density("The clown.") > 0 and m.density("A clown fish") == 0 and m.density("clowns") == 0
    assert m.density("badly") > 0 and m.density("forbade") == 0
    assert m.density("clown fish and clown") > 0


def plain_density(text, lexicon):
    """Every place of the text tried with every term and every phrase."""
    folded = toxicity.fold(text or "", toxicity.Folding())
    spans = [(i, i + len(p) + 2) for p in lexicon.exceptions for i in range(len(folded)) if folded.startswith(f" {p} ", i)]
    total = 0.0
    for i in range(len(folded)):
        weights = [w for t, w in lexicon.terms.items() if folded.startswith(t, i)]
        if weights and not any(a <= i < b - 1 for a, b in spans):
            total += max(weights)
    return total / math.sqrt(folded.count(" ") + 8)


def test_scores_match_a_plain_scan_of_the_lexicon(spark):
    rng = random.Random(3)
    vocab = ["clown", "fish", "bad", "badly", "id10t", "nice", "сlown", "the", "circus", "x"]
    rows = documents() + [(1000 + i, rng.choice([" ", ", ", "\n"]).join(rng.choice(vocab) for _ in range(rng.randint(0, 40))), None, None, 0) for i in range(200)]
    lexicon = toxicity.Lexicon({" clown ": 4.0, " bad": 3.0, " badly ": 5.0, " idiot ": 4.5, " word ": 1.0},
                               ("clown fish", "the clown", "fish bad nice", "circus clown fish"), (1.3, -2.0))
    got = toxicity.score(frame(spark, rows, extra=("label",)), lexicon).select("doc_id", "text", "score").collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-(1.3 * plain_density(r["text"], lexicon) - 2.0))))


def test_a_text_of_a_million_words_with_matches_and_exceptions():
    m = toxicity.Matcher(toxicity.Lexicon({" clown ": 4.0, " bad": 3.0}, ("clown fish",)))
    text = "clown fish bad day " * 250_000
    t = time.time()
    assert m.density(text) == pytest.approx(3.0 * 250_000 / math.sqrt(1_000_001 + 8))
    assert time.time() - t < 30


def test_the_sample_is_bounded_in_rows(spark):
    rows = [(i % 2, f"text {i}", None, None, 1) for i in range(500)]
    labels = spark.createDataFrame([(0, 0), (1, 1)], "doc_id long, label int")
    assert sorted(r["text"] for r in toxicity.sampled(frame(spark, rows), labels, 5).collect()) == ["text 0", "text 1"]


def test_score_normalises_by_length():
    m = toxicity.Matcher(toxicity.Lexicon({" bad ": 4.0}))
    assert m.score("bad") > m.score("bad " + "good " * 500) > m.score("good")
    assert m.score("") == pytest.approx(m.score("good"))


def test_awkward_rows_and_tables_without_labels(spark):
    rows = documents()
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    lexicon = toxicity.learn_from_labels(frame(spark, rows), none)
    got = toxicity.score(frame(spark, rows, extra=("score", "label")), lexicon).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] < 0.5 for r in got)
    odd = spark.createDataFrame([(0, 1, None), (None, 1, 1), (3, 1, 7), (6, 0, 1), (6, 0, 1), (9, 0, 0)], "doc_id long, quality int, toxic int")
    assert toxicity.score(frame(spark, rows), toxicity.learn_from_labels(frame(spark, rows), odd)).count() == len(rows)
    assert toxicity.score(frame(spark, []), lexicon).count() == 0


def test_held_out_rows_never_reach_learning(spark):
    rows = [(i, "aaaa bbbb cccc", None, None, 1) for i in range(300)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(300)], "doc_id long, quality int, toxic int")
    held = {r["doc_id"] for r in frame(spark, rows).where(toxicity.held_out(F.col("doc_id"))).collect()}
    assert held == {i for i in range(300) if zlib.crc32(str(i).encode()) % 3 == 1}
    seen = labels.select("doc_id", F.col("toxic").alias("label")).where(~toxicity.held_out(F.col("doc_id")))
    n = toxicity.sampled(frame(spark, rows), seen).count()
    assert n == 300 - len(held)


def test_rare_toxic_rows_reach_learning(spark):
    """0.5% of the labelled rows are toxic, and the draw is a twentieth of the rows."""
    rows = [(i, f"aaaa w{i * 7919 % 89}x bbbb cccc {'nastyword' if i % 200 == 0 else 'dddd'}", None, None, 1) for i in range(6000)]
    labels = spark.createDataFrame([(i, 1, int(i % 200 == 0)) for i in range(6000)], "doc_id long, quality int, toxic int")
    docs = frame(spark, rows)
    lexicon = toxicity.learn_from_labels(docs, labels, rows=300)
    got = toxicity.score(docs, lexicon).collect()
    assert {r["doc_id"] for r in got if r["score"] >= toxicity.THRESHOLD} == set(range(0, 6000, 200))
    seen = labels.select("doc_id", F.col("toxic").alias("label"))
    n = {r["label"]: r["count"] for r in toxicity.sampled(docs, seen, 300).groupBy("label").count().collect()}
    assert n == {0: 300, 1: 30} and toxicity.draw_shift(seen, 300) == pytest.approx(-toxicity.math.log(5970 / 300))


def test_terms_of_few_among_many_toxic_rows_are_learned(spark):
    """Under 1% of the toxic rows use the word; a word as rare in both labels is no term."""
    def text(i, t):
        return f"aaaa bbbb {'nastyword' if t and i < 18 else 'usual'} {'evenword' if i < 4 else 'usual'}"
    sample = spark.createDataFrame([(text(i, t), t) for t in (0, 1) for i in range(2500)], "text string, label int").repartition(4)
    terms = toxicity.learn(sample).terms
    assert any(t.startswith(" nast") for t in terms) and not any(t.startswith(" even") for t in terms)


def test_held_out_accuracy(spark):
    got = {r["doc_id"]: r for r in QUERIES["op1_toxicity"](spark, SF).collect()}
    labels = duckdb.sql(f"SELECT doc_id, toxic FROM read_parquet('{SF}/labels.parquet')").fetchall()
    seen = [(got[i], t) for i, t in labels if got[i]["held_out"]]
    assert len(got) == 10000 and len(seen) > 1000
    hit = sum(1 for r, t in seen if r["predicted"] and t)
    assert hit / sum(t for _, t in seen) > 0.85                      # recall
    assert hit / sum(r["predicted"] for r, _ in seen) > 0.95         # precision
    pos, neg = [r["score"] for r, t in seen if t], [r["score"] for r, t in seen if not t]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert wins > 0.93
