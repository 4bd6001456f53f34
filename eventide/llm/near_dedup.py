"""Near-duplicates by an inverted join over MinHash signature coordinates.

1. Every text gets its set of distinct ``SHINGLE``-word shingles (A-Z folded)
   and a signature of ``POSTED + PROBED`` minimum hashes. Texts with the same
   set are one node from here on.
2. Each node is posted under its first ``POSTED`` coordinate-value pairs.
   Prefix: two sets of 0.75 or more share at least ``SHARED`` of them (a miss
   has a probability under one in a million), so in one global order, rarest
   pair first, they meet in the first ``POSTED - SHARED + 1``; a node whose
   pairs are too rare to share that many drops out at once.
3. Skip: the long lists behind the prefix are never merged. Candidates that
   meet in a prefix list count their collisions on the whole signatures, and
   pairs with ``MATCHES`` or more go on to be confirmed on their full sets.
4. Lists are joined star-wise: every member with one pivot, then, where a list
   still holds several components, with a few more, and at last the members
   outside a list's largest component with all members of other components, in
   blocks. So a group of thousands of near copies costs its number of members,
   and yet no link between components is lost. What the blocks compare are
   signatures of ``WIDE`` coordinates, made for the members of open lists only.
   Pairs that these allow are many and often just under the similarity, so they
   never become rows: a member lists its candidates, the texts come to the block
   once a member, and the block confirms its pairs on the full sets itself and
   gives only the links that join components.
5. Components by contraction: every node hooks to its smallest neighbour,
   pointers jump to the root, edges are relabelled, until none is left.

All texts go to Python once, for the sets. A row's id and the digest of its text
then stand for the row, so later steps fetch texts and rows by plain joins.

A text without words has an empty set and is linked with nothing; with fewer
words than a shingle the whole sequence is one shingle. Null counts as empty.
Rows that repeat are equal sets; an id with several texts has a row for each,
judged by its own set; a null id never is a component's smallest unless there
is no other. Very long texts go through whole, one at a time. Columns of other
names are not read. An empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from eventide.llm.passages import range_hash
from eventide.llm.shared import saved, ship
from eventide.llm.textops import U, Words, grams, mix, steps

SHINGLE = 5
PERCENT = 75          # similarity in per cent at least
POSTED, PROBED = 32, 224
SHARED = 10           # of the posted coordinates; for 75 %
MATCHES = 158         # of all coordinates; for 75 %: five standard deviations below the 192 expected
HEAD, HEAD_MATCHES = 64, 30   # the first coordinates, counted inside the lists already
WIDE = 1024           # coordinates of the last comparison
PIVOTS = 4
BLOCK = 512
BLOCK_SHINGLES = 1 << 20      # of the members of one side of a block together
SET_BYTES = 1 << 19   # text whose sets a task makes at a time
_SHORT = 0x8CB92BA72F3D8DD7


def shingles(col: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """``(row, hash)`` of the distinct shingles of each row, sorted by both."""
    w = Words(col, fold=True)
    m = max(0, len(w) - size + 1)
    inside = w.doc[:m] == w.doc[size - 1:] if m else np.empty(0, bool)
    row, h = w.doc[:m][inside], grams(w, size)[inside]
    n = np.diff(w.first)
    short = np.flatnonzero((n > 0) & (n < size))
    row = np.concatenate([row, short])
    h = np.concatenate([h, range_hash(w.hash, w.first[short], w.first[short + 1], _SHORT)])
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    return row[new], h[new]


def set_sums(row: np.ndarray, h: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size and 128-bit digest of each row's set."""
    n = np.bincount(row, minlength=rows)
    lo, hi = np.zeros(rows, U), np.zeros(rows, U)
    has = np.flatnonzero(n)
    if len(has):
        at = np.cumsum(n)[has] - n[has]
        lo[has] = np.add.reduceat(mix(h ^ U(_SHORT)), at)
        hi[has] = np.add.reduceat(mix(h + U(_SHORT)), at)
    return n, lo, hi


def _coefficients(k: int) -> np.ndarray:
    return np.random.default_rng(20240229).integers(1, 2**32, k, dtype=np.uint32) | np.uint32(1)


def signatures(row: np.ndarray, h: np.ndarray, n: np.ndarray, posted: int, probed: int) -> tuple[np.ndarray, np.ndarray]:
    """Posting keys (rows x posted) and signature bytes (rows x all); rows without a set get zeros."""
    rows, k = len(n), posted + probed
    keys, sig = np.zeros((rows, posted), U), np.zeros((rows, k), np.uint8)
    has = np.flatnonzero(n)
    if len(has):
        at = np.cumsum(n)[has] - n[has]
        x = (mix(h) >> U(32)).astype(np.uint32)
        for j, a in enumerate(_coefficients(k)):
            v = x * a
            v ^= v >> np.uint32(15)
            v *= np.uint32(0x2C1B3C6D)
            low = np.minimum.reduceat(v, at)
            sig[has, j] = (low * np.uint32(0x9E3779B1) >> np.uint32(24)).astype(np.uint8)
            if j < posted:
                keys[has, j] = mix((low.astype(U) << U(8)) | U(j))
    return keys, sig


_SETS = "id long, digest binary, n long, lo long, hi long, keys array<long>, sig binary"


def _sets(posted: int, probed: int, size: int):
    def run(batches):
        for batch in batches:
            for part in steps(batch, "text", SET_BYTES):
                rows = part.num_rows
                row, h = shingles(part.column(1), size)
                n, lo, hi = set_sums(row, h, rows)
                keys, sig = signatures(row, h, n, posted, probed)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(n), pa.array(lo.view(np.int64)), pa.array(hi.view(np.int64)),
                     pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * posted), pa.array(keys.view(np.int64).ravel())),
                     _binaries(sig)], ["id", "digest", "n", "lo", "hi", "keys", "sig"])
    return run


def _binaries(matrix: np.ndarray) -> pa.Array:
    ends = (np.arange(len(matrix) + 1) * matrix.shape[1]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(matrix), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(matrix.tobytes())])


def _matrix(col: pa.Array, width: int) -> np.ndarray:
    lists = col.to_pylist()
    return np.frombuffer(b"".join(lists), np.uint8).reshape(len(lists), width)


def least_matches(coordinates: int, percent: int) -> int:
    """Collisions that a pair of ``percent`` has, less five standard deviations."""
    p = percent / 100
    return math.floor(coordinates * p - 5 * math.sqrt(coordinates * p * (1 - p)))


def wide_signatures(lists: DataFrame, info: DataFrame, texts: DataFrame, size: int, wide: int) -> DataFrame:
    """``node, n, sig`` of the members of ``lists``, ``sig`` with ``wide`` coordinates."""
    def run(batches):
        for batch in batches:
            for part in steps(batch, "text", 1 << 20):
                row, h = shingles(part.column(1), size)
                _, sig = signatures(row, h, np.bincount(row, minlength=part.num_rows), 0, wide)
                yield pa.RecordBatch.from_arrays([part.column(0), _binaries(sig)], ["node", "sig"])

    asked = lists.select("node").distinct()
    made = texts.join(asked, "node", "left_semi").select("node", "text").mapInArrow(run, "node long, sig binary")
    return saved(made.join(info.select("node", "n"), "node").select("node", "n", "sig"), "near-wide")


def prefixes(nodes: DataFrame, posted: int = POSTED, shared: int = SHARED) -> DataFrame:
    """``key, node``: the postings in the prefix of each node (pairs that no
    other node has stand first in the order and need no posting)."""
    posts = nodes.select("node", F.explode("keys").alias("key"))
    # written first: a join of two plain shuffles can be split where one pair is hot
    common = saved(posts.groupBy("key").agg(F.count("*").alias("f")).where(F.col("f") > 1), "near-common")
    return (posts.join(common, "key").groupBy("node")
            .agg(F.sort_array(F.collect_list(F.struct("f", "key"))).alias("own"))           # at most `posted`
            .where(F.size("own") >= shared)
            .select("node", F.explode(F.slice("own", F.lit(1), F.size("own") - (shared - 1))).alias("p"))
            .select("p.key", "node"))


def similar(pairs: DataFrame, info: DataFrame, matches: int = MATCHES, percent: int = PERCENT) -> DataFrame:
    """Pairs ``a, b`` whose sizes allow the similarity and whose signatures collide often enough."""
    side = lambda c: info.select(F.col("node").alias(c), F.col("n").alias("n" + c), F.col("sig").alias("s" + c))
    near = (pairs.join(side("a"), "a").join(side("b"), "b")
            .where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent).select("a", "b", "sa", "sb"))

    def count(batches):
        for batch in batches:
            if batch.num_rows:
                width = len(batch.column(2)[0].as_py())
                hit = (_matrix(batch.column(2), width) == _matrix(batch.column(3), width)).sum(1) >= matches
                yield pa.RecordBatch.from_arrays([c.filter(pa.array(hit)) for c in batch.columns[:2]], ["a", "b"])

    return near.mapInArrow(count, "a long, b long")


def _within_lists(lists: DataFrame, info: DataFrame, pivots: int, head: int, head_matches: int, percent: int, name: str) -> DataFrame:
    """Pairs ``a, b`` of each list's pivots with its members of other components
    whose sizes and first coordinates allow the similarity."""
    rows = saved(lists.join(info.select("node", "n", F.expr(f"substring(sig, 1, {head})").alias("head")), "node"), f"near-{name}-rows")
    pick = [F.min(F.struct(F.xxhash64(F.col("node"), F.lit(i)).alias("h"), "node", "root", "n", "head")) for i in range(pivots)]
    centre = saved(rows.groupBy("key").agg(F.array(*pick).alias("p"))
                   .select("key", F.explode(F.array_distinct(F.transform("p", lambda x: x.dropFields("h")))).alias("p"))
                   .select("key", F.col("p.node").alias("a"), F.col("p.root").alias("ra"), F.col("p.n").alias("na"), F.col("p.head").alias("ha")),
                   f"near-{name}-centre")
    pairs = (rows.join(centre, "key")
             .where((F.col("root") != F.col("ra")) & (F.least("n", "na") * 100 >= F.greatest("n", "na") * percent))
             .select("a", F.col("node").alias("b"), "ha", "head"))

    def count(batches):
        for batch in batches:
            if batch.num_rows:
                hit = (_matrix(batch.column(2), head) == _matrix(batch.column(3), head)).sum(1) >= head_matches
                yield pa.RecordBatch.from_arrays([c.filter(pa.array(hit)) for c in batch.columns[:2]], ["a", "b"])

    return pairs.mapInArrow(count, "a long, b long").distinct()


def confirmed(pairs: DataFrame, texts: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Pairs whose full sets are similar enough. ``a`` is the side that many pairs share."""
    both = (pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")
            .join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a").select("a", "b", "ta", "tb"))

    def check(batches):
        for batch in batches:
            for part in steps(batch, "ta", 1 << 20):
                n = part.num_rows
                (ra, ha), (rb, hb) = shingles(part.column(2), size), shingles(part.column(3), size)
                row, h = np.concatenate([ra, rb]), np.concatenate([ha, hb])
                order = np.lexsort((h, row))
                row, h = row[order], h[order]
                twice = (row[1:] == row[:-1]) & (h[1:] == h[:-1])
                inter = np.bincount(row[1:][twice], minlength=n)
                union = np.bincount(row, minlength=n) - inter
                ok = pa.array((inter * 100 >= union * percent) & (inter > 0))
                yield pa.RecordBatch.from_arrays([c.filter(ok) for c in part.columns[:2]], ["a", "b"])

    return both.mapInArrow(check, "a long, b long")


def contract(edges: DataFrame, name: str = "near") -> DataFrame:
    """``node, root`` of every node with an edge: its component's smallest node."""
    edges = saved(edges, f"{name}-edges")
    label = saved(edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().withColumn("root", F.col("node")), f"{name}-label")
    left = edges
    while True:
        left = saved(left.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{name}-left")
        if left.isEmpty():
            return label
        hook = saved(left.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root")), f"{name}-hook")
        while True:
            jump = hook.select(F.col("node").alias("root"), F.col("root").alias("_next"))
            if hook.join(jump.select("root"), "root", "left_semi").isEmpty():
                break
            hook = saved(hook.join(jump, "root", "left").select("node", F.coalesce("_next", "root").alias("root")), f"{name}-hook")
        step = hook.select(F.col("node").alias("_n"), F.col("root").alias("_r"))
        label = saved(label.join(step, F.col("root") == F.col("_n"), "left").select("node", F.coalesce("_r", "root").alias("root")), f"{name}-label")
        for c in ("a", "b"):
            left = left.join(step, F.col(c) == F.col("_n"), "left").withColumn(c, F.coalesce("_r", c)).select("a", "b")


def _merge(labels: DataFrame | None, edges: DataFrame, name: str) -> DataFrame:
    """Labels after more edges between nodes."""
    if labels is None:
        return contract(edges, name)
    old = labels.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    for c in ("a", "b"):
        edges = edges.join(old, F.col(c) == F.col("_node"), "left").withColumn(c, F.coalesce("_root", c)).select("a", "b")
    new = contract(edges, name).select(F.col("node").alias("_n"), F.col("root").alias("_r"))
    moved = (labels.join(new, F.col("root") == F.col("_n"), "left")
             .select("node", F.coalesce("_r", "root").alias("root")))
    fresh = new.join(labels.select("node"), F.col("_n") == F.col("node"), "left_anti")   # without an edge so far
    return saved(moved.unionByName(fresh.select(F.col("_n").alias("node"), F.col("_r").alias("root"))), f"{name}-merged")


def _open_lists(posts: DataFrame, labels: DataFrame, name: str) -> DataFrame:
    """Postings with their component, of the lists that hold more than one."""
    placed = (posts.join(labels.withColumnRenamed("root", "_root"), "node", "left")
              .select("key", "node", F.coalesce("_root", "node").alias("root")))
    several = placed.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x < y").select("key")
    return saved(placed.join(several, "key"), name)


def _blocks(lists: DataFrame, info: DataFrame, matches: int, percent: int, block: int, head: int = HEAD, head_matches: int = 0,
            candidates: bool = False, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """Pairs of different components within each list: of two members at least
    one is outside the largest component, so those few ("small") are compared
    with all, a block of them with a block of the list at a time: by ``head``
    coordinates first, then by all.

    With ``candidates`` the pairs do not become rows: a block gives the members
    that have any (``key, i, j, second, node, root, others``), once each, and
    ``others`` holds the second members that a first one is similar to."""
    lists = lists.join(info.select("node", F.col("n").alias("_n")), "node")
    sizes = lists.groupBy("key", "root").agg(F.count("*").alias("n"), F.sum("_n").alias("s"))
    top = sizes.groupBy("key").agg(F.sum("n").alias("_size"), F.sum("s").alias("_sum"), F.max(F.struct("n", "root", "s")).alias("_top"))
    size = top.select("key", "_size", "_sum", F.col("_top.root").alias("_large"), (F.col("_size") - F.col("_top.n")).alias("_small"),
                      (F.col("_sum") - F.col("_top.s")).alias("_small_sum"))
    blocks = lambda c, s: F.greatest(F.ceil(F.col(c) / block), F.ceil(F.col(s) / block_shingles), F.lit(1)).cast("int")
    h = F.xxhash64("node")
    placed = lists.join(size, "key").withColumn("_rows", blocks("_small", "_small_sum")).withColumn("_cols", blocks("_size", "_sum"))
    each = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    asks = F.when(F.col("root") != F.col("_large"),
                  F.transform(each("_cols"), lambda j: F.struct(F.pmod(h, F.col("_rows")).cast("int").alias("i"), j.alias("j"), F.lit(False).alias("second"))))
    told = F.transform(each("_rows"), lambda i: F.struct(i.alias("i"), F.pmod(h, F.col("_cols")).cast("int").alias("j"), F.lit(True).alias("second")))
    placed = placed.withColumn("_at", F.explode(F.concat(told, F.coalesce(asks, F.slice(told, 1, 0)))))
    # a pair is reported in the first list that both are in: at most `posted` keys a node
    own = lists.groupBy("node").agg(F.collect_set("key").alias("own"))
    dealt = (placed.select("key", "_at.i", "_at.j", "_at.second", "node", "root")
             .join(info.select("node", "n", "sig").join(own, "node"), "node")
             .repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "second", "node")
             .select("key", "i", "j", "second", "node", "root", "n", "sig", "own"))

    def compare(batches):
        for table, marks in _whole_blocks(batches):
            hits = _compare_groups(table, marks, matches, percent, head, head_matches)
            yield _members(table, hits) if candidates else _pairs(table, hits)

    return dealt.mapInArrow(compare, _MEMBERS if candidates else "a long, b long")


_MEMBERS = "key long, i int, j int, second boolean, node long, root long, others array<long>"


def _whole_blocks(batches):
    """Rows sorted by ``key, i, j`` as tables that end with a block, and where their blocks begin and end."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
        group = [table.column(c).to_numpy() for c in range(3)]
        n = table.num_rows
        cut = np.flatnonzero(np.any([g[1:] != g[:-1] for g in group], 0)) + 1 if n > 1 else np.empty(0, np.int64)
        done = int(cut[-1]) if len(cut) else 0
        rest = table.slice(done).combine_chunks()
        if done:
            yield table.slice(0, done), np.concatenate([[0], cut])
    if rest is not None and rest.num_rows:
        yield rest, np.array([0, rest.num_rows])


def _compare_groups(table: pa.Table, marks: np.ndarray, matches: int, percent: int, head: int, head_matches: int) -> list[tuple[int, list[int]]]:
    """Row numbers of the members that have candidates, with those of the candidates."""
    second, node, root, n = (table.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in range(3, 7))
    key, own = table.column(0).to_numpy(), {}
    lists = table.column(8).combine_chunks()

    def keys_of(i):
        if i not in own:
            own[i] = set(lists[i].as_py())
        return own[i]

    raw = table.column(7).combine_chunks()
    sig = _matrix(raw, len(raw[0].as_py()))
    first = np.ascontiguousarray(sig[:, :head])
    out = []
    for lo, hi in zip(marks[:-1].tolist(), marks[1:].tolist(), strict=True):
        turn = lo + int(np.searchsorted(second[lo:hi], True))
        for i in range(lo, turn):
            other = np.arange(turn, hi)
            other = other[(root[other] != root[i]) & (np.minimum(n[other], n[i]) * 100 >= np.maximum(n[other], n[i]) * percent)]
            other = other[(first[other] == first[i]).sum(1) >= head_matches]
            if len(other):
                hit = other[(sig[other] == sig[i]).sum(1) >= matches]
                if found := [x for x in hit.tolist() if min(keys_of(i) & keys_of(x)) == key[i]]:
                    out.append((i, found))
    return out


def _pairs(table: pa.Table, hits: list[tuple[int, list[int]]]) -> pa.RecordBatch:
    node = table.column(4).to_numpy()
    a = node[np.repeat([i for i, _ in hits], [len(x) for _, x in hits])] if hits else np.empty(0, np.int64)
    b = node[np.concatenate([x for _, x in hits])] if hits else np.empty(0, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])


def _members(table: pa.Table, hits: list[tuple[int, list[int]]]) -> pa.RecordBatch:
    node = table.column(4).to_numpy()
    found = {i: node[x] for i, x in hits}
    rows = sorted({*found, *(x for _, others in hits for x in others)})
    some = table.select(range(6)).take(pa.array(rows, pa.int64())).combine_chunks()
    columns = [c.combine_chunks() for c in some.columns]
    return pa.RecordBatch.from_arrays([*columns, pa.array([found.get(i) for i in rows], pa.list_(pa.int64()))], [*some.column_names, "others"])


class _Joined:
    """Components that links of this task have joined."""

    def __init__(self):
        self.up = {}

    def find(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = x = self.up.get(y, y)
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def _links(members: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links ``a, b`` that join the components of ``members`` (of :func:`_blocks`),
    confirmed on full sets, fewer in a task than the components it meets: pairs
    whose components the task has joined already need no look."""
    dealt = (members.join(texts.select("node", "text"), "node").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "second", "node")
             .select("key", "i", "j", "second", "node", "root", "others", "text"))

    def confirm(batches):
        joined = _Joined()
        for table, marks in _whole_blocks(batches):
            for lo, hi in zip(marks[:-1].tolist(), marks[1:].tolist(), strict=True):
                out = _confirm_block(table.slice(lo, hi - lo).combine_chunks().to_batches()[0], joined, size, percent)
                if out:
                    a, b = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return dealt.mapInArrow(confirm, "a long, b long")


def _confirm_block(block: pa.RecordBatch, joined: _Joined, size: int, percent: int) -> list[tuple[int, int]]:
    sets = []
    for part in steps(block, "text", 1 << 20):
        row, h = shingles(part.column(7), size)
        sets += np.split(h, np.cumsum(np.bincount(row, minlength=part.num_rows))[:-1])
    second, node, root, others = (block.column(c).to_pylist() for c in range(3, 7))
    place = {x: at for at, x in enumerate(node) if second[at]}
    out = []
    for i, asked in enumerate(others):
        mine = joined.find(root[i])
        asked = [at for x in asked or () if joined.find(root[at := place[x]]) != mine]
        if not asked:
            continue
        n = np.array([len(sets[at]) for at in asked])
        theirs = np.concatenate([sets[at] for at in asked])
        where = np.minimum(np.searchsorted(sets[i], theirs), len(sets[i]) - 1)
        inter = np.add.reduceat((sets[i][where] == theirs).astype(np.int64), np.cumsum(n) - n)
        near = inter * 100 >= (len(sets[i]) + n - inter) * percent
        out += [(node[i], node[at]) for at, ok in zip(asked, near.tolist(), strict=True) if ok and joined.join(root[i], root[at])]
    return out


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, percent: int = PERCENT,
                posted: int = POSTED, probed: int = PROBED, shared: int = SHARED, matches: int = MATCHES,
                block: int = BLOCK) -> DataFrame:
    """``id, n_shingles, component_id, kept`` of every row. ``shared`` and
    ``matches`` must fit ``percent``: far enough below ``percent`` of ``posted``
    and of all coordinates that a true pair does not fall under them."""
    judged = _judged(docs, id_col, text_col, size, percent, posted, probed, shared, matches, block)
    return judged.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", _stays().alias("kept"))


def _stays():
    return F.col("id").eqNullSafe(F.col("component_id"))


def _judged(docs: DataFrame, id_col: str, text_col: str, size: int, percent: int, posted: int, probed: int, shared: int, matches: int,
            block: int) -> DataFrame:
    """``id, digest, n, component_id`` of every row: its id, its text's digest, its set's size and its group."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sets = saved(rows.withColumn("digest", _digest()).mapInArrow(_sets(posted, probed, size), _SETS), "near-sets")
    nodes = saved(sets.where("n > 0").groupBy("lo", "hi", "n")
                  .agg(F.min("id").alias("rep"), F.first("keys").alias("keys"), F.first("sig").alias("sig"))
                  .withColumn("node", F.monotonically_increasing_id()), "near-nodes")
    posts = saved(prefixes(nodes, posted, shared), "near-posts")
    info = saved(nodes.join(posts.select("node").distinct(), "node").select("node", "rep", "n", "sig", "lo", "hi"), "near-info")
    texts = saved(_texts(rows, info, size, sets), "near-texts")

    def star(lists, pivots: int, name: str):
        pairs = _within_lists(lists, info, pivots, HEAD, HEAD_MATCHES, percent, name)
        return confirmed(saved(similar(pairs, info, matches, percent), f"near-{name}"), texts, size, percent)

    labels = _merge(None, star(posts.withColumn("root", F.col("node")), 1, "star"), "near-1")
    open_ = _open_lists(posts, labels, "near-open-1")
    labels = _merge(labels, star(open_, PIVOTS, "more"), "near-2")
    open_ = _open_lists(open_.select("key", "node"), labels, "near-open-2")
    wide = wide_signatures(open_, info, texts, size, WIDE)
    near = _blocks(open_, wide, least_matches(WIDE, percent), percent, block, posted + probed, matches, candidates=True)
    labels = _merge(labels, _links(near, texts, size, percent), "near-3")

    named = labels.join(info.select("node", "rep"), "node")
    first = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    grouped = named.join(first, "root").select("node", "component_id")
    known = (nodes.select("lo", "hi", "n", "node", "rep").join(grouped, "node", "left")
             .select("lo", "hi", "n", F.coalesce("component_id", "rep").alias("component_id")))
    full = sets.where("n > 0").join(known, ["lo", "hi", "n"]).select("id", "digest", "n", "component_id")
    empty = sets.where("n = 0").select("id", "digest", "n", F.col("id").alias("component_id"))
    return full.unionByName(empty)


def _with_sets(rows: DataFrame, text: int, size: int) -> DataFrame:
    """The rows and their sets' ``n, lo, hi``; ``text`` is the place of the text column."""
    names = rows.columns

    def run(batches):
        for batch in batches:
            for part in steps(batch, names[text], SET_BYTES):
                row, h = shingles(part.column(text), size)
                n, lo, hi = set_sums(row, h, part.num_rows)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(n.astype(np.int64)), pa.array(lo.view(np.int64)), pa.array(hi.view(np.int64))],
                                                 [*names, "n", "lo", "hi"])

    return rows.mapInArrow(run, T.StructType([*rows.schema, *(T.StructField(c, T.LongType()) for c in ("n", "lo", "hi"))]))


def _id_key(c: str) -> list:
    """An id, null too, as values that an equality join takes."""
    return [F.coalesce(F.col(c), F.lit(0)).alias("_id"), F.col(c).isNull().alias("_none")]


_SET = ["_id", "_none", "n", "lo", "hi"]
_ROW = ["_id", "_none", "digest"]


def _digest():
    return F.unhex(F.sha2("text", 256))


def _texts(rows: DataFrame, info: DataFrame, size: int, sets: DataFrame | None = None) -> DataFrame:
    """``node, text`` of the nodes that have postings: of the rows with the node's
    id and set. ``sets`` are those of the rows with ``id, digest``, where they are made already."""
    if sets is None:
        sets = _with_sets(rows.withColumn("digest", _digest()), rows.columns.index("text"), size).drop("text")
    asked = info.select("node", *_id_key("rep"), "n", "lo", "hi")
    held = (sets.select(*_id_key("id"), "digest", "n", "lo", "hi").join(asked, _SET)
            .groupBy("node").agg(F.min(F.struct(*_ROW)).alias("row")).select("node", "row.*"))
    found = rows.select("text", *_id_key("id"), _digest().alias("digest")).join(held, _ROW)
    return found.groupBy("node").agg(F.min("text").alias("text"))


def keep_one(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, posted: int = POSTED, probed: int = PROBED, shared: int = SHARED,
             matches: int = MATCHES, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` that stay: of every group the one with the smallest
    id, with all columns of ``docs``. An id's rows with other texts are judged
    by their own groups."""
    judged = _judged(docs.select("doc_id", "text"), "doc_id", "text", size, percent, posted, probed, shared, matches, block)
    kept = judged.where(_stays()).select(*_id_key("id"), "digest").distinct()
    # the row is one struct, so no column name of its own can clash
    rows = docs.select(F.struct("*").alias("row"), F.coalesce(F.col("text"), F.lit("")).alias("text"), F.col("doc_id").cast("long").alias("id"))
    return rows.select("row", *_id_key("id"), _digest().alias("digest")).join(kept, _ROW, "left_semi").select("row.*")
