"""Phrase collocations by vertically partitioned, depth-truncated suffix trees.

Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and LF..CR and those
into words at space and TAB. Of every word position the suffix of at most four
words inside its piece is kept. All counts are per language.

1. Every word is counted exactly; the frequent ones (at least ``min_count``)
   are kept. A fixed bitmap of ``BITS`` bits over their hashes says "perhaps
   frequent": a suffix ends before the first word that it rules out. No phrase
   of ``min_count`` occurrences holds such a word, so nothing is lost; where the
   bitmap fills up, fewer suffixes are cut short and the rest stays the same.
2. Suffixes are grouped by their first word; the groups, of about ``group_words``
   suffixes, share the words out by hash. A word with more than ``group_words``
   occurrences is a group prefix too large, so its two-word prefixes take its
   place, then the three-word prefixes of the large ones among those, then whole
   suffixes; their exact counts come from a pass over the extensions of the
   large ones. Each task ships equal suffixes once with their number, one packed
   row per group.
3. Each group builds its own subtree: leaves in order, and per depth the nodes
   as runs of leaves with the same first words; a node's count is the total of
   its leaves. Nodes under ``min_count`` end there.

Scores, the test against longer phrases and the ranks are joins and groupings
over the frequent phrases; products are decimals of 38 digits.

Large prefixes on the driver number at most 3 * words / group_words, and the
bitmap has 2 MB at any size of the input. A group's subtree is what a task
holds. Null texts are empty, null languages ``und``; rows without words give
nothing; repeated rows count as often as they come; very long texts go through
in one step of their own. Only the named columns are read, so others may have
any name. An empty table gives no rows.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from eventide.llm.shared import saved, ship
from eventide.llm.textops import steps, utf8

DEPTH = 4                    # words of the longest phrase
MIN_COUNT = 30
TOP = 2000
DROP_SHARE = 80              # percent of a phrase's occurrences inside a longer one that drop it
GROUP_WORDS = 1 << 20        # suffixes in one subtree
STEP_BYTES = 8 << 20         # text that one task works on at a time
HELD_WORDS = 400_000         # word counts that a task holds before it ships them
BITS = 1 << 24
SALTS = 32

_PIECE_END = np.zeros(256, bool)
_PIECE_END[list(b".,;:!?\n\x0b\x0c\r")] = True
_SOLID = ~_PIECE_END
_SOLID[list(b" \t")] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Words:
    """The words of a step's texts: ``words`` (distinct), ``code`` of each word in
    order, ``lang`` of its text (index into ``langs``), ``run`` (words from it to
    the end of its piece)."""

    def __init__(self, batch: pa.RecordBatch):
        langs = batch.column(0).fill_null("und").dictionary_encode()
        self.langs = langs.dictionary
        buf, offs = utf8(batch.column(1))
        buf = _LOWER[buf]
        solid = _SOLID[buf]
        edge = np.zeros(len(buf) + 1, bool)
        edge[offs] = True
        before, after = np.zeros_like(solid), np.zeros_like(solid)
        before[1:], after[:-1] = solid[:-1], solid[1:]
        first = np.flatnonzero(solid & (~before | edge[:-1]))
        last = np.flatnonzero(solid & (~after | edge[1:]))
        n = len(first)
        ends = np.zeros(n + 1, np.int64)
        np.cumsum(last - first + 1, out=ends[1:])
        data = np.ascontiguousarray(buf[solid])
        flat = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(data)]).dictionary_encode()
        self.words, self.code = flat.dictionary, flat.indices.to_numpy(zero_copy_only=False)
        doc = np.searchsorted(offs, first, "right") - 1
        self.lang = langs.indices.to_numpy(zero_copy_only=False)[doc] if n else np.empty(0, np.int32)
        piece = np.cumsum(_PIECE_END[buf], dtype=np.int64)[first] if n else np.empty(0, np.int64)
        stop = np.ones(n, bool)
        if n:
            stop[:-1] = (doc[1:] != doc[:-1]) | (piece[1:] != piece[:-1])
        self.run = ahead(stop) + 1

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Language and word in one number, and how many words there are."""
        return self.lang * np.int64(max(1, len(self.words))) + self.code, len(self.words)


def ahead(stop: np.ndarray) -> np.ndarray:
    """Per position the number of steps to the next ``True`` (itself: 0; none: to the end)."""
    n = len(stop)
    at = np.append(np.flatnonzero(stop), n)
    return at[np.searchsorted(at, np.arange(n))] - np.arange(n)


def _text(col: pa.Array) -> pa.Array:
    return col.cast(pa.large_string()).cast(pa.string())


def _rows(schema: pa.Schema, *cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) if not isinstance(c, pa.Array) else c for c, f in zip(cols, schema, strict=True)], schema=schema)


COUNTS = "lang string, phrase string, f long"
_COUNTS = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("f", pa.int64())])


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words with their number, summed over the steps of a task; all words of a language under null."""
    held = []
    for batch in batches:
        for part in steps(batch, "text", STEP_BYTES):
            w = Words(part)
            pairs, many = w.pairs()
            if not len(pairs):
                continue
            n = np.bincount(pairs) if len(w.langs) * many <= 8 * len(pairs) else None
            pair, n = np.unique(pairs, return_counts=True) if n is None else (at := np.flatnonzero(n), n[at])
            held.append(_rows(_COUNTS, w.langs.take(pair // many), _text(w.words.take(pair % many)), n))
            n = np.bincount(w.lang, minlength=len(w.langs))
            held.append(_rows(_COUNTS, w.langs, pa.nulls(len(w.langs), pa.string()), n))
            if sum(b.num_rows for b in held) > HELD_WORDS:
                held = _summed(held)
                if sum(b.num_rows for b in held) > HELD_WORDS / 2:
                    yield from held
                    held = []
    yield from _summed(held)


def _summed(held: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
    if not held:
        return []
    t = pa.Table.from_batches(held).group_by(["lang", "phrase"]).aggregate([("f", "sum")])
    return pa.table([t["lang"], t["phrase"], t["f_sum"]], schema=_COUNTS).combine_chunks().to_batches()


def bucket(lang: bytes, word: bytes, bits: int) -> int:
    return zlib.crc32(lang + b"\n" + word) % bits


def bitmap(words: DataFrame, bits: int) -> bytes:
    """Bits of the hashes of ``lang, phrase``; ``bits / 8`` bytes whatever the number of rows."""
    h = F.crc32(F.concat("lang", F.lit("\n"), "phrase").cast("binary")) % bits + 1
    parts = (words.select(h.alias("h")).groupBy(F.bitmap_bucket_number("h").alias("k"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position("h")).alias("bits")).collect())
    out = bytearray(max(bits // 8, 4096))
    for r in parts:
        out[(r["k"] - 1) * 4096:r["k"] * 4096] = r["bits"]
    return bytes(out)


def perhaps(w: Words, bits: bytes, n_bits: int) -> np.ndarray:
    """Per word, whether the bitmap lets it pass as frequent."""
    pairs, many = w.pairs()
    if not len(pairs):
        return np.empty(0, bool)
    lang, word = np.divmod(first := _distinct(pairs, len(w.langs) * many), many)
    langs, words = [x.encode() + b"\n" for x in w.langs.to_pylist()], w.words.to_pylist()
    h = np.fromiter((zlib.crc32(langs[a] + words[b]) for a, b in zip(lang.tolist(), word.tolist(), strict=True)), np.int64, len(first)) % n_bits
    known = np.frombuffer(bits, np.uint8)
    hit = (known[h >> 3] >> (h & 7).astype(np.uint8) & 1).astype(bool)
    return hit[np.searchsorted(first, pairs)] if len(w.langs) * many > 8 * len(pairs) else _spread(first, hit, len(w.langs) * many)[pairs]


def _distinct(x: np.ndarray, below: int) -> np.ndarray:
    return np.unique(x) if below > 8 * len(x) else np.flatnonzero(np.bincount(x, minlength=below))


def _spread(at: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, values.dtype)
    out[at] = values
    return out


class Suffixes:
    """Distinct suffixes of ``least`` words or more of a step: columns ``lang,
    c0..c3`` (-1: none) in order, and their ``number``; of those that begin at
    ``begin`` and end before a word that is not in ``among``."""

    def __init__(self, w: Words, among: np.ndarray | None = None, begin: np.ndarray | None = None, least: int = 2, depth: int = DEPTH):
        many = len(w.words)
        run = w.run if among is None else np.minimum(w.run, ahead(~among))
        at = np.flatnonzero((run >= least) if begin is None else (run >= least) & begin)
        run = np.minimum(run[at], depth)
        self.words, self.langs, self.many = w.words, w.langs, many
        code = np.append(w.code, np.full(DEPTH, -1, np.int32))
        cols = [w.lang[at]] + [np.where(run > d, code[at + d], np.int32(-1)) for d in range(DEPTH)]
        order, new = tree_order(cols, many)
        starts = np.flatnonzero(new[DEPTH])
        self.cols = [c[order][starts] for c in cols]
        self.number = np.diff(np.append(starts, len(order)))
        self.new = [x[starts] for x in new]

    def node_ids(self, depth: int) -> np.ndarray:
        """Number of the first ``depth`` words of each suffix, as a node."""
        return np.cumsum(self.new[depth]) - 1

    def codes(self, prefixes: list[tuple[str, ...]], depth: int) -> np.ndarray:
        """Whether the first ``depth`` words of each suffix are among ``prefixes`` (language first)."""
        mine = [p for p in prefixes if len(p) == depth + 1]
        hit = np.zeros(len(self.number), bool)
        if not mine or not len(hit):
            return hit
        langs = pc.index_in(pa.array([p[0] for p in mine], self.langs.type), self.langs).to_pylist()
        words = [pc.index_in(pa.array([p[d + 1].encode() for p in mine], self.words.type), self.words).to_pylist() for d in range(depth)]
        local = {(lang, *w) for lang, *w in zip(langs, *words, strict=True) if lang is not None and None not in w}
        if local:
            first = np.flatnonzero(self.new[depth])
            nodes = np.array([x in local for x in zip(*(c[first].tolist() for c in self.cols[:depth + 1]), strict=True)], bool)
            hit = nodes[self.node_ids(depth)]
        return hit


def tree_order(cols: list[np.ndarray], many: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Order of suffixes ``lang, c0..c3`` as leaves of a tree, and per depth where a new node begins."""
    many = np.int64(many)
    upper = (cols[0] * many + cols[1]) * (many + 1) + cols[2] + 1
    lower = (cols[3] + np.int64(1)) * (many + 1) + cols[4] + 1
    order = np.lexsort((lower, upper))
    del upper, lower
    new, at = [], np.zeros(len(order), bool)
    at[:1] = True
    for c in cols:
        c = c[order]
        at = at.copy()
        at[1:] |= c[1:] != c[:-1]
        new.append(at)
    return order, new


def _extensions(large: list[tuple[str, ...]], depth: int):
    """Counts of the prefixes of ``depth`` words that begin with a large one of ``depth - 1``."""
    heads = pa.array({p[1].encode() for p in large}, pa.large_binary())

    def run(batches):
        for batch in batches:
            for part in steps(batch, "text", STEP_BYTES):
                w = Words(part)
                begin = pc.is_in(w.words, heads).to_numpy(zero_copy_only=False)[w.code]
                s = Suffixes(w, None, begin, depth, depth)
                hit = s.codes(large, depth - 1)
                if hit.any():
                    first = np.flatnonzero(s.new[depth])
                    n = np.bincount(s.node_ids(depth), s.number).astype(np.int64)
                    first, n = first[hit[first]], n[hit[first]]
                    yield _rows(_COUNTS, s.langs.take(s.cols[0][first]), phrase(s.words, [s.cols[d + 1][first] for d in range(depth)]), n)

    return run


def phrase(words: pa.Array, cols: list[np.ndarray]) -> pa.Array:
    parts = [_text(words.take(pa.array(c))) for c in cols]
    return pc.binary_join_element_wise(*parts, " ")


PACKED = "group int, langs array<string>, words binary, rows int, leaves binary"
_PACKED = pa.schema([("group", pa.int32()), ("langs", pa.list_(pa.string())), ("words", pa.binary()), ("rows", pa.int32()), ("leaves", pa.binary())])
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _shipped(bits, n_bits: int, large: list[tuple[str, ...]], groups: int):
    """Suffixes of every step, packed per group: distinct words and the leaves as numbers of them."""

    def run(batches):
        for batch in batches:
            for part in steps(batch, "text", STEP_BYTES):
                w = Words(part)
                yield from packed(Suffixes(w, perhaps(w, bits.value, n_bits)))

    def packed(s):
        own = np.ones(len(s.number), np.int64)     # words of the prefix that names the group
        for depth in range(1, DEPTH):
            own[s.codes(large, depth) & (own == depth)] = depth + 1
        cols = np.array(s.cols)
        keep = cols[own, np.arange(cols.shape[1])] >= 0 if len(own) else np.empty(0, bool)
        cols, own, number = cols[:, keep], own[keep], s.number[keep]
        if not len(own):
            return
        h = np.fromiter((zlib.crc32(x) for x in s.words.to_pylist()), np.uint64, s.many)
        key = np.fromiter((zlib.crc32(x.encode()) for x in s.langs.to_pylist()), np.uint64, len(s.langs))[cols[0]]
        for d in range(DEPTH):
            key = np.where(own > d, (key ^ h[cols[d + 1]]) * _M1 + _M2, key)
        group = ((key >> np.uint64(20)) % np.uint64(groups)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        cols, own, number, group = np.array([c[order] for c in cols]), own[order], number[order], group[order]
        place = np.zeros(s.many + 1, np.int32)
        place[-1] = -1
        cuts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        langs, words = s.langs.to_pylist(), s.words.cast(pa.binary())
        for a, b in zip(cuts, np.append(cuts[1:], len(group)), strict=True):
            c = cols[1:, a:b]
            used = np.unique(c)
            used = used[used >= 0]
            place[used] = np.arange(len(used), dtype=np.int32)
            leaves = np.vstack([cols[0, a:b], place[c], own[a:b].astype(np.int32), number[a:b].astype(np.int32)])
            names = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(used)], pa.int32()), words.take(pa.array(used))), b"\n")
            yield _rows(_PACKED, [int(group[a])], [langs], names, [b - a], [pa.compress(leaves, "zstd", asbytes=True)])

    return run


def _subtrees(min_count: int):
    """Nodes of two words or more, with the totals of their leaves, of one group after the other."""

    def run(batches):
        now, held = None, []
        for batch in batches:
            for r in batch.to_pylist():
                if r["group"] != now:
                    yield from nodes(held)
                    now, held = r["group"], []
                held.append(r)
        yield from nodes(held)

    def nodes(held):
        if not held:
            return
        langs = pa.chunked_array([pa.array(r["langs"], pa.string()) for r in held]).combine_chunks().dictionary_encode()
        words = pa.chunked_array([pa.array(r["words"].split(b"\n"), pa.large_binary()) for r in held]).combine_chunks().dictionary_encode()
        lang_of, word_of = langs.indices.to_numpy(), words.indices.to_numpy()
        parts, at_lang, at_word = [], 0, 0
        for r in held:
            size = r["rows"] * (DEPTH + 3) * 4
            m = np.frombuffer(pa.decompress(r["leaves"], size, "zstd"), np.int32).reshape(DEPTH + 3, -1).copy()
            n_words = r["words"].count(b"\n") + 1
            to = np.append(word_of[at_word:at_word + n_words], np.int32(-1))
            m[0] = lang_of[at_lang:at_lang + len(r["langs"])][m[0]]
            m[1:DEPTH + 1] = to[m[1:DEPTH + 1]]
            parts.append(m)
            at_lang, at_word = at_lang + len(r["langs"]), at_word + n_words
        held.clear()
        m = np.concatenate(parts, axis=1)
        parts.clear()
        order, new = tree_order(list(m[:DEPTH + 1]), len(words.dictionary))
        m = m[:, order]
        for depth in range(2, DEPTH + 1):
            first = np.flatnonzero(new[depth])
            total = np.add.reduceat(m[DEPTH + 2], first, dtype=np.int64)
            first, total = (x[(total >= min_count) & (m[depth, first] >= 0) & (m[DEPTH + 1, first] <= depth)] for x in (first, total))
            if len(first):
                yield _rows(_COUNTS, langs.dictionary.take(pa.array(m[0, first])), phrase(words.dictionary, [m[d + 1, first] for d in range(depth)]), total)

    return run


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, group_words: int = GROUP_WORDS, n_bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """``lang, text`` -> ``lang, phrase, f`` of all phrases of 1 to 4 words with at
    least ``min_count`` occurrences, and ``lang, n`` (all word occurrences)."""
    spark: SparkSession = docs.sparkSession
    ship(spark)
    texts = docs.select("lang", "text")
    words = saved(texts.mapInArrow(_word_counts, COUNTS).groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
                  .where(F.col("phrase").isNull() | (F.col("f") >= min_count)), "words")
    totals = words.where(F.col("phrase").isNull()).select("lang", F.col("f").alias("n"))
    words = words.where(F.col("phrase").isNotNull())
    bits = spark.sparkContext.broadcast(bitmap(words, n_bits))

    def names(df):
        return [(r["lang"], *r["phrase"].split(" ")) for r in df.where(F.col("f") > group_words).select("lang", "phrase").collect()]

    large, found = names(words), [words]
    for depth in range(2, DEPTH):
        last = [p for p in large if len(p) == depth]
        if not last:
            break
        more = saved(texts.mapInArrow(_extensions(last, depth), COUNTS).groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
                     .where((F.col("f") > group_words) & (F.col("f") >= min_count)), "large")
        large += names(more)
        found.append(more)
    total = totals.agg(F.sum("n")).first()[0] or 0
    groups = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / group_words))
    packed = texts.mapInArrow(_shipped(bits, n_bits, large, groups), PACKED)
    nodes = packed.repartitionById(groups, "group").mapInArrow(_subtrees(min_count), COUNTS)
    for more in found:
        nodes = nodes.unionByName(more)
    return saved(nodes, "phrases"), totals


def _exact(col: str) -> Column:
    return F.col(col).cast("decimal(38,0)")


def collocations(docs: DataFrame, top: int = TOP, min_count: int = MIN_COUNT, **sizes) -> DataFrame:
    """The ``top`` phrases of every language by their weakest cut: ``lang, rank,
    phrase, a, l, r, n, score`` (``score``: 2,000,000 a / (l + r), rounded down)."""
    counts, totals = frequent_phrases(docs, min_count, **sizes)
    some = (counts.withColumn("words", F.split("phrase", " ")).where(F.size("words") >= 2)
            .select("lang", "phrase", F.col("f").alias("a"), "words", F.size("words").alias("len")))
    part = lambda first, n: F.array_join(F.slice("words", first, n), " ")
    cuts = (some.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("len") - 1)))
            .select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.col("len") - F.col("k")).alias("right")))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)), ["lang", side])
    cuts = cuts.withColumn("al", _exact("a") * 2_000_000).withColumn("lr", _exact("l") + _exact("r"))
    weakest = (cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(F.expr("al div lr").alias("score"), "k", "l", "r")).alias("cut"))
               .select("lang", "phrase", "a", "cut.score", "cut.l", "cut.r"))
    shorter = F.flatten(F.transform(F.sequence(F.lit(2), F.col("len") - 1), lambda n: F.transform(
        F.sequence(F.lit(1), F.col("len") - n + 1), lambda first: part(first, n))))
    inside = (some.where(F.col("len") > 2).select("lang", F.col("a").alias("f"), F.explode(shorter).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("f").alias("f")))
    kept = (weakest.join(inside, ["lang", "phrase"], "left")
            .where(F.col("f").isNull() | (_exact("f") * 100 < _exact("a") * DROP_SHARE)).drop("f"))
    best = F.col("score").desc(), F.col("a").desc(), F.col("phrase")
    few = (kept.withColumn("salt", F.pmod(F.hash("phrase"), F.lit(SALTS)))
           .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best))).where(F.col("rank") <= top))
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
