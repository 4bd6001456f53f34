"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text.

Folding lower-cases the text, maps look-alike letters of other scripts and
digit substitutions (``1d10t``) to the Latin letter, drops marks that join or
hide letters, and turns everything that is no letter into one blank. Lexicon
terms are whole words or word beginnings. A match inside an exception phrase
does not count. The weights of the matches are normalised by the length of the
text, and a logistic curve turns that into a score.

Learning takes labelled rows only: terms are the words and word beginnings
whose documents are toxic far more often than chance (log-odds), exceptions the
word pairs around a term that clean documents use, the curve is fitted by
Newton steps. A term needs ``MIN_DOCS`` toxic documents and a frequency among
them that chance gives at most with ``MAX_CHANCE`` (Fisher's exact test),
however many there are; every term that passes is kept. It uses a documented, bounded sample of the labelled rows, those of smallest hash,
drawn for either label (``SAMPLE_ROWS``), so rare toxic rows are all read, one
row an id (the smallest text, where an id repeats); the
curve is set back to the shares of the labels. Scoring covers every row and
whole texts.

Null and empty texts have no match and get the score of zero density. Rows are
independent, so repeated rows get equal scores, and columns of other names are
passed on as they are (one named like the score is replaced). Very long texts
are scanned once, in time that grows with their length; an empty table or a table
without labels gives a lexicon without terms and scores that say "not toxic".
"""

from __future__ import annotations

import math
import unicodedata
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from eventide.llm.shared import saved, ship
from eventide.llm.textops import steps

SAMPLE_ROWS = 20_000     # labelled rows of either label that learning reads at most
PREFIX = (4, 5, 6, 7)    # lengths of word beginnings that may be terms
MIN_WEIGHT = 3.0         # log-odds of a term at least
MIN_DOCS = 3             # toxic documents of a term at least
MAX_CHANCE = 1e-3        # that a term of equal frequency in both labels is in so many toxic documents
THRESHOLD = 0.7

# Letters of other scripts that look like a Latin one.
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "к": "k",
    "м": "m", "т": "t", "в": "b", "н": "h", "ԁ": "d", "һ": "h", "ո": "n", "ս": "u",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "μ": "u", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "ω": "w", "γ": "y", "ı": "i", "ⅼ": "l", "ɡ": "g", "ɑ": "a",
}
# Digits and signs written for a letter.
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}


class Folding(dict):
    """Translation table that works out each character when it is first met."""

    def __missing__(self, code: int):
        c = chr(code)
        if c in DIGITS:
            out = DIGITS[c]
        else:
            wide = unicodedata.normalize("NFKC", c).lower()
            if unicodedata.category(c) in ("Mn", "Cf"):
                out = ""
            elif len(wide) == 1 and wide in HOMOGLYPHS:
                out = HOMOGLYPHS[wide]
            else:
                out = wide if wide.isalpha() else " "
        self[code] = out
        return out


def fold(text: str, table: Folding) -> str:
    """Folded words with one blank before, between and after them."""
    words = text.lower().translate(table).split()
    return f" {' '.join(words)} " if words else " "


@dataclass
class Lexicon:
    """``terms``: " word " or " beginning" -> weight; ``exceptions``: folded phrases;
    ``curve``: slope and intercept of the score over the density."""

    terms: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    curve: tuple[float, float] = (1.0, -4.0)


class Matcher:
    """Aho-Corasick automaton over terms and exception phrases."""

    def __init__(self, lexicon: Lexicon):
        import ahocorasick

        self.table = Folding()
        self.auto = ahocorasick.Automaton()
        self.lexicon = lexicon
        for term, weight in lexicon.terms.items():
            self.auto.add_word(term, (len(term), weight))
        for phrase in lexicon.exceptions:
            self.auto.add_word(f" {' '.join(phrase.split())} ", (len(" ".join(phrase.split())) + 2, None))
        if len(self.auto):
            self.auto.make_automaton()

    def hits(self, folded: str) -> tuple[dict[int, float], list[tuple[int, int]]]:
        """Start of each matched word -> its largest weight; spans of exceptions."""
        found: dict[int, float] = {}
        excused = []
        if len(self.auto):
            for end, (size, weight) in self.auto.iter(folded):
                start = end + 1 - size
                if weight is None:
                    excused.append((start, end))
                elif weight > found.get(start, 0.0):
                    found[start] = weight
        return found, excused

    def density(self, text: str) -> float:
        """Weight of the matches that no exception covers, over the root of the number of words."""
        folded = fold(text, self.table)
        found, excused = self.hits(folded)
        if excused:
            starts, ends = [], []                      # the phrases' spans, merged
            for a, b in sorted(excused):
                if ends and a <= ends[-1]:
                    ends[-1] = max(ends[-1], b)
                else:
                    starts.append(a), ends.append(b)

            def inside(s):
                at = bisect_right(starts, s) - 1
                return at >= 0 and s < ends[at]

            found = {s: w for s, w in found.items() if not inside(s)}
        return sum(found.values()) / math.sqrt(folded.count(" ") + 8)

    def score(self, text: str) -> float:
        a, b = self.lexicon.curve
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, a * self.density(text) + b))))


def _features(folded: str) -> set[str]:
    out = set()
    for w in set(folded.split()):
        out.add(f" {w} ")
        out.update(f" {w[:n]}" for n in PREFIX if len(w) > n)
    return out


def _count(sample: DataFrame, of, name: str) -> DataFrame:
    """Documents of either label that have each feature."""
    schema = T.StructType([T.StructField(name, T.StringType()), T.StructField("label", T.IntegerType()),
                           T.StructField("n", T.LongType())])

    def counted(batches):
        make = of()
        seen = (Counter(), Counter())
        for batch in batches:
            cols = [c.to_pylist() for c in batch.columns]
            for text, label in zip(*cols, strict=True):
                seen[label].update(make(text or ""))
            if len(seen[0]) + len(seen[1]) > 500_000:
                yield _emit(seen)
                seen = (Counter(), Counter())
        yield _emit(seen)

    def _emit(seen):
        keys = [k for c in seen for k in c]
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.string()), pa.array([0] * len(seen[0]) + [1] * len(seen[1]), pa.int32()),
             pa.array([n for c in seen for n in c.values()], pa.int64())], schema.names)

    n = lambda label: F.sum(F.when(F.col("label") == label, F.col("n")).otherwise(0))
    return sample.mapInArrow(counted, schema).groupBy(name).agg(n(0).alias("clean"), n(1).alias("toxic"))


def _critical(toxic: int, clean: int, chance: float, upto: int = 200) -> list[int]:
    """For terms of 1, 2, ... documents the least number of toxic ones that equal
    frequency gives with at most ``chance`` (Fisher's exact test, one side)."""
    def ways(n, k):
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    out = []
    for n in range(1, min(upto, toxic + clean) + 1):
        least, tail = n + 1, 0.0
        for t in range(min(n, toxic), max(0, n - clean) - 1, -1):
            tail += math.exp(ways(toxic, t) + ways(clean, n - t) - ways(toxic + clean, n))
            if tail > chance:
                break
            least = t
        out.append(least)
    return out


def _known(labels: DataFrame) -> DataFrame:
    return labels.where(F.col("label").isin(0, 1)).groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))


def sampled(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``text, label`` of the labelled rows, at most ``rows`` of either label by
    smallest hash of their id; an id that repeats gives its smallest text."""
    clean, toxic = (_known(labels).where(F.col("label") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for t in (0, 1))
    # at most twice `rows` pairs of numbers: small enough to broadcast, whatever the table
    found = docs.select("doc_id", "text").join(F.broadcast(clean.unionByName(toxic)), "doc_id")
    return saved(found.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("label").alias("label")).select("text", "label"), "toxicity-sample")


def draw_shift(labels: DataFrame, rows: int = SAMPLE_ROWS) -> float:
    """Log-odds of toxic rows in ``labels`` less those in the draw of :func:`sampled`."""
    n = {r["label"]: r["n"] for r in _known(labels).groupBy("label").agg(F.count("*").alias("n")).collect()}
    part = {label: math.log(max(k, rows) / rows) for label, k in n.items()}
    return part.get(1, 0.0) - part.get(0, 0.0)


def learn(sample: DataFrame, min_weight: float = MIN_WEIGHT,
          exceptions: tuple[str, ...] = (), shift: float = 0.0) -> Lexicon:
    """Lexicon from ``text, label`` rows; ``sample`` must be bounded (see :func:`sampled`),
    ``shift`` is added to the curve's intercept (see :func:`draw_shift`)."""
    ship(sample.sparkSession)
    n = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    clean, toxic = n.get(0, 0), n.get(1, 0)
    if not toxic or not clean:
        return Lexicon()

    def feature_maker():
        table = Folding()
        return lambda text: _features(fold(text, table))

    def log_odds(t, c):
        return F.log((t + 0.5) / (toxic + 1.0)) - F.log((c + 0.5) / (clean + 1.0))

    # by the exact tail for terms of few documents, above by its bound
    few = _critical(toxic, clean, MAX_CHANCE)

    def unlikely(t, c):
        share = toxic / (toxic + clean)
        excess = t * F.log(t / ((t + c) * share)) + F.when(c > 0, c * F.log(c / ((t + c) * (1 - share)))).otherwise(0.0)
        bound = (t > (t + c) * share) & (excess >= -math.log(MAX_CHANCE))
        return F.when(t + c <= len(few), t >= F.element_at(F.lit(few), F.least(t + c, F.lit(len(few))).cast("int"))).otherwise(bound)

    found = (_count(sample, feature_maker, "term").where((F.col("toxic") >= MIN_DOCS) & unlikely(F.col("toxic"), F.col("clean")))
             .withColumn("weight", log_odds(F.col("toxic"), F.col("clean"))).where(F.col("weight") >= min_weight)
             .orderBy(F.desc("weight"), F.desc("toxic"), "term").collect())      # of a bounded sample
    terms: dict[str, float] = {}
    for r in sorted(found, key=lambda r: len(r["term"].rstrip())):   # a beginning stands for the words it begins
        parts = [r["term"][:k] for k in range(2, len(r["term"]))]
        if not any(terms.get(p, -1.0) >= r["weight"] - 1.0 for p in parts):
            terms[r["term"]] = float(r["weight"])
    lexicon = Lexicon(terms, exceptions)

    def pair_maker():
        matcher = Matcher(lexicon)

        def pairs(text):
            folded = fold(text, matcher.table)
            out = set()
            for start in matcher.hits(folded)[0]:
                stop = folded.index(" ", start + 1)
                before, after = folded.rfind(" ", 0, start), folded.find(" ", stop + 1)
                if before >= 0:
                    out.add(folded[before + 1:stop])
                if after >= 0:
                    out.add(folded[start + 1:after])
            return out
        return pairs

    excused = (_count(sample, pair_maker, "phrase")
               .where((F.col("clean") >= 2) & (log_odds(F.col("toxic"), F.col("clean")) <= 0))
               .orderBy(F.desc("clean"), "phrase").collect())
    lexicon.exceptions = (*exceptions, *(r["phrase"] for r in excused))
    slope, intercept = _fit(*_densities(sample, lexicon))
    lexicon.curve = slope, intercept + shift
    return lexicon


def _densities(sample: DataFrame, lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray]:
    """Density and label of the (bounded) sample's rows."""
    def densities(batches):
        m = Matcher(lexicon)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([m.density(t or "") for t in batch.column(0).to_pylist()], pa.float64()), batch.column(1)], ["x", "y"])

    rows = sample.mapInArrow(densities, "x double, y int").collect()
    return np.array([r["x"] for r in rows]), np.array([r["y"] for r in rows], float)


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, n: np.ndarray | None = None) -> tuple[float, float]:
    """Logistic curve by damped Newton steps on a standardised density; ``n``: rows that each value stands for."""
    order = np.lexsort((y, x))
    n = np.ones(len(x)) if n is None else n[order]
    x, y = x[order], y[order]
    scale = max(float(np.sqrt((n * x * x).sum() / n.sum())), 1e-9)
    a = np.column_stack([x / scale, np.ones(len(x))])
    w = np.zeros(2)

    def loss(v):
        z = a @ v
        return float((n * np.logaddexp(0, z)).sum() - (n * y * z).sum() + ridge / 2 * (v @ v))

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -40, 40)))
        grad = a.T @ (n * (p - y)) + ridge * w
        hess = (a * (n * p * (1 - p))[:, None]).T @ a + ridge * np.eye(2)
        step = np.linalg.solve(hess, grad)
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return float(w[0] / scale), float(w[1])


def score(docs: DataFrame, lexicon: Lexicon, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with ``score_col`` added (an older column of that name is
    replaced): every row, the whole text."""
    ship(docs.sparkSession)
    docs = docs.drop(score_col)
    out = T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())])
    at = docs.columns.index(text_col)

    def scored(batches):
        m = Matcher(lexicon)
        for batch in batches:
            for part in steps(batch, text_col):
                values = [m.score(t or "") for t in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(values, pa.float64())], out.names)

    return docs.mapInArrow(scored, out)


def held_out(doc_id):
    """Rows whose labels learning never sees: a third, by crc32 of the id as text."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def learn_from_labels(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Lexicon:
    """Lexicon from the rows of ``labels(doc_id, toxic)`` that are not held out."""
    seen = labels.select("doc_id", F.col("toxic").alias("label")).where(~held_out(F.col("doc_id")))
    return learn(sampled(docs, seen, rows), shift=draw_shift(seen, rows))
