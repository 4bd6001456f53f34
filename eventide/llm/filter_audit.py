"""Filter interaction audit: which filter removes what, in every order of the filters.

Each document gets a mask of the filters that it fails; all counts for all
orders follow from the number of documents per (part, mask). Four filters look
at one text; the last one, ``E``, fails a text that a smaller id has as well,
and is decided with radix tries:

* texts are dealt to ranges by adaptive prefixes: the distinct first ``HEAD``
  characters and their bytes are counted, put into ranges of about ``PART_BYTES``
  and each range is bounded by the shortest prefix that sets it apart from the
  one before. A range that one common opening makes larger is split by the hash
  of the whole text, which keeps equal texts together;
* before the exchange each task puts its texts into a trie of its own: copies
  that are not the smallest id of their text there are decided on the spot, and
  the text itself travels once per task, however many copies it has;
* after it, each range is a compressed trie over whole texts with the smallest
  id at every terminal; a walk over the terminals flags every larger id.

A trie holds one range (or ``PART_BYTES`` of a task's texts) and goes before
the next begins. What leaves is a row per document of id, part and mask, which
meets the labels and is reduced to at most 32 counts per part.

Null texts and parts count as empty; a null id is never smaller than another
and never fails ``E``; rows that repeat an id and text do not fail ``E`` by
each other; ids without a label count as neither good nor toxic, of an id
labelled more than once any label counts. Texts of any length go through whole.
Only the named columns are read, so others may have any name. An empty table
gives no rows.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import permutations

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from eventide.llm.shared import saved, ship

HEAD = 64                    # characters of a text that can bound a range
PART_BYTES = 32 << 20        # text in one trie
TASK_BYTES = 256 << 20       # text of the ranges that one task reads after the exchange
OUT_BYTES = 4 << 20          # text in one Arrow batch that leaves a task

MIN_WORDS, MIN_DISTINCT, MAX_UPPER = 200, 50, 3
ODD = re.compile(rb"[#$%&*|]")
UPPER = bytes(range(ord("A"), ord("Z") + 1))
FOLLOWING = bytes(range(0x80, 0xC0))     # UTF-8 bytes that begin no code point
FILTERS = "ABCDE"
DUPLICATE = 1 << FILTERS.index("E")


def own_mask(text: bytes) -> int:
    """Bits of the filters A-D that a text fails; words are split at space and TAB..CR."""
    words = text.split()
    upper = len(text) - len(text.translate(None, UPPER))
    points = len(text.translate(None, FOLLOWING))
    return ((len(words) < MIN_WORDS) | (100 * len(set(words)) < MIN_DISTINCT * len(words)) << 1
            | (100 * upper > MAX_UPPER * points) << 2 | bool(ODD.search(text)) << 3)


class Leaf:
    """Terminal of one text: the smallest id that has it, and its rows."""

    __slots__ = ("text", "least", "rows")

    def __init__(self, text: bytes):
        self.text, self.least, self.rows = text, None, []

    def add(self, doc_id, *row) -> None:
        if doc_id is not None and (self.least is None or doc_id < self.least):
            self.least = doc_id
        self.rows.append((doc_id, *row))


class Node:
    """Inner node: the bytes on the edge to it, what follows, and the text that ends here."""

    __slots__ = ("label", "below", "end")

    def __init__(self, label: bytes):
        self.label, self.below, self.end = label, {}, None


def differ(a: bytes, b: bytes, at: int) -> int:
    """First position from ``at`` where the two are not the same (or the shorter one's end)."""
    end, step = min(len(a), len(b)), 64
    while at < end:
        if a[at:at + step] == b[at:at + step]:
            at = min(end, at + step)
            step *= 2
        elif step > 1:
            step = max(1, step // 8)
        else:
            return at
    return end


class Trie:
    """Compressed trie of whole texts."""

    def __init__(self):
        self.root, self.bytes = Node(b""), 0

    def leaf(self, text: bytes) -> Leaf:
        """The terminal of ``text``, put in if it is new."""
        node, at = self.root, 0
        while at < len(text):
            step = node.below.get(text[at])
            if step is None:
                return self._hang(node, at, text)
            if type(step) is Leaf:
                if step.text == text:
                    return step
                fork = differ(text, step.text, at)
                inner = Node(text[at:fork])
                node.below[text[at]] = inner
                self._put(inner, fork, step)
                node, at = inner, fork
            elif text.startswith(step.label, at):
                node, at = step, at + len(step.label)
            else:
                n = differ(text[at:at + len(step.label)], step.label, 0)
                inner = Node(step.label[:n])
                node.below[text[at]] = inner
                step.label = step.label[n:]
                inner.below[step.label[0]] = step
                node, at = inner, at + n
        if node.end is None:
            node.end = Leaf(text)
            self.bytes += len(text)
        return node.end

    def _hang(self, node: Node, at: int, text: bytes) -> Leaf:
        leaf = Leaf(text)
        self._put(node, at, leaf)
        self.bytes += len(text)
        return leaf

    @staticmethod
    def _put(node: Node, at: int, leaf: Leaf) -> None:
        if at == len(leaf.text):
            node.end = leaf
        else:
            node.below[leaf.text[at]] = leaf

    def leaves(self) -> Iterator[Leaf]:
        todo = [self.root]
        while todo:
            node = todo.pop()
            if type(node) is Leaf:
                yield node
                continue
            if node.end is not None:
                yield node.end
            todo.extend(node.below.values())


class Ranges:
    """Bounds of the ranges and the number of hash parts of each."""

    def __init__(self, heads: list[tuple[str, str, int]], part_bytes: int = PART_BYTES):
        """``heads``: first head, last head and bytes of each range, in order."""
        self.bounds, self.first, self.splits = [], [], []
        last, parts = None, 0
        for low, high, size in heads:
            n = 0
            while last is not None and low[:n] <= last:
                n += 1
            self.bounds.append(low[:n].encode())
            self.first.append(parts)
            self.splits.append(max(1, math.ceil(size / part_bytes)))
            parts += self.splits[-1]
            last = high
        self.parts = max(1, parts)

    def part(self, text: bytes) -> int:
        k = max(0, bisect_right(self.bounds, text) - 1)
        if not self.bounds or self.splits[k] == 1:
            return self.first[k] if self.bounds else 0
        return self.first[k] + xxhash.xxh3_64_intdigest(text) % self.splits[k]


def ranges(texts: DataFrame, part_bytes: int = PART_BYTES) -> tuple[Ranges, int]:
    """Ranges over the ``text`` column and the text's bytes. The driver gets a row
    per range: two heads and a size."""
    spark = texts.sparkSession
    heads = saved(texts.select(F.substring("text", 1, HEAD).alias("head"), F.octet_length("text").alias("size"))
                  .groupBy("head").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows")), "heads")
    total = heads.agg(F.sum(F.col("size") + 100 * F.col("rows"))).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / part_bytes))
    spread = (heads.repartitionByRange(n, "head").select(F.spark_partition_id().alias("p"), "head", "size")
              .groupBy("p").agg(F.min("head").alias("low"), F.max("head").alias("high"), F.sum("size").alias("size")).orderBy("low").collect())
    fair = max(1, min(part_bytes, total // n))
    return Ranges([(r["low"], r["high"], r["size"]) for r in spread], fair), total


LOCAL = "doc_id long, part string, mask int, text binary, range int, task int, parts array<string>"
FLAGGED = "doc_id long, part string, mask int"
_LOCAL = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("text", pa.binary()), ("range", pa.int32()), ("task", pa.int32()),
                    ("parts", pa.list_(pa.string()))])
_FLAGGED = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("mask", pa.int32())])


def _batches(rows: Iterator[tuple], schema: pa.Schema, text: int | None = None) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += 100 + len(r[text] or b"" if text is not None else b"")
        if size > OUT_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema, strict=True)], schema=schema)


def _in_task(spread: Ranges, tasks: int, part_bytes: int):
    """Texts of one task: copies decided on the spot, each text once to its range."""

    def rows(batches):
        trie = Trie()
        for batch in batches:
            ids, parts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            texts = batch.column(2).cast(pa.large_binary())
            for i, (doc_id, part) in enumerate(zip(ids, parts, strict=True)):
                trie.leaf(texts[i].as_py()).add(doc_id, part)
                if trie.bytes > part_bytes:
                    yield from decided(trie)
                    trie = Trie()
        yield from decided(trie)

    def decided(trie):
        for leaf in trie.leaves():
            mask, first = own_mask(leaf.text), []
            for doc_id, part in leaf.rows:
                if doc_id is not None and doc_id == leaf.least:
                    first.append(part)
                else:
                    yield doc_id, part, mask | (0 if doc_id is None else DUPLICATE), None, None, (doc_id or 0) % tasks, None
            if first:
                k = spread.part(leaf.text)
                yield leaf.least, None, mask, leaf.text, k, k * tasks // spread.parts, first

    return lambda batches: _batches(rows(batches), _LOCAL, 3)


def _in_range(batches):
    """Rows in order of their range: decided ones pass, the others go into its trie."""

    def rows():
        trie, now = Trie(), None
        for batch in batches:
            small = [batch.column(i).to_pylist() for i in (0, 1, 2, 4, 6)]
            texts = batch.column(3)
            for i, (doc_id, part, mask, k, parts) in enumerate(zip(*small, strict=True)):
                if k is None:
                    yield doc_id, part, mask
                    continue
                if k != now:
                    yield from flagged(trie)
                    trie, now = Trie(), k
                trie.leaf(texts[i].as_py()).add(doc_id, mask, parts)
        yield from flagged(trie)

    def flagged(trie):
        for leaf in trie.leaves():
            for doc_id, mask, parts in leaf.rows:
                for part in parts:
                    yield doc_id, part, mask | (DUPLICATE if doc_id > leaf.least else 0)

    return _batches(rows(), _FLAGGED)


def masks(docs: DataFrame, part: str = "lang", part_bytes: int = PART_BYTES, task_bytes: int = TASK_BYTES) -> DataFrame:
    """``doc_id, text`` and a part column -> one row per document: ``doc_id, part,
    mask`` (bit k: fails the k-th of ``FILTERS``)."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part), F.lit("")).alias("part"),
                       F.coalesce("text", F.lit("")).alias("text"))
    spread, total = ranges(rows, part_bytes)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / task_bytes))
    local = rows.mapInArrow(_in_task(spread, tasks, part_bytes), LOCAL)
    return local.repartitionById(tasks, "task").sortWithinPartitions("range").mapInArrow(_in_range, FLAGGED)


def reduced(flags: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents per ``part, mask``: ``n``, and how many of them are labelled ``good`` and ``toxic``."""
    mine = flags.groupBy("doc_id", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    known = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"),
                                                                              F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    both = mine.join(known, "doc_id", "left")
    return both.groupBy("part", "mask").agg(F.sum("n").alias("n"), *(F.sum(F.col("n") * F.coalesce(c, F.lit(0))).alias(c) for c in ("good", "toxic")))


AUDIT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long,"
         " shapley long")


def _orders(counts: pd.DataFrame) -> pd.DataFrame:
    """The counts of one part, a row per mask, in all orders of the filters."""
    part, out, shares = counts["part"].iloc[0], [], dict.fromkeys(FILTERS, 0)
    rows = [(int(m), int(n), int(g), int(t)) for m, n, g, t in zip(counts["mask"], counts["n"], counts["good"], counts["toxic"], strict=True)]
    for order in permutations(FILTERS):
        gone = 0
        for step, name in enumerate(order, 1):
            bit = 1 << FILTERS.index(name)
            here = [r for r in rows if r[0] & bit and not r[0] & gone]
            removed = sum(r[1] for r in here)
            shares[name] += removed
            out.append(["".join(order), step, sum(r[1] for r in rows if not r[0] & (gone | bit)), removed,
                        sum(r[1] for r in rows if r[0] & bit and r[0] & gone), sum(r[1] for r in rows if r[0] == bit),
                        sum(r[2] for r in here), sum(r[3] for r in here)])
            gone |= bit
    return pd.DataFrame([[part, *r, shares[r[0][r[1] - 1]]] for r in out], columns=[c.split()[0] for c in AUDIT.split(",")])


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang", **sizes) -> DataFrame:
    """Per part, order of the five filters and step: ``kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley``. ``labels``: ``doc_id, quality, toxic``."""
    return reduced(masks(docs, part, **sizes), labels).groupBy("part").applyInPandas(_orders, AUDIT)
