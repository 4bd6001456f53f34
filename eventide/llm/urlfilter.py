"""URL filter: rules and listed sites in a sorted digest array.

Every entry (a rule such as ``org/`` or ``example.org/es/``, or a listed site
such as ``spam.example.org``) is kept under its 64-bit xxhash. The keys lie
sorted in a memory-mapped file, with the full strings behind them. A page is
looked up under all texts that could match it - each domain its host belongs
to, alone and with each beginning of its path that some rule has - by a
vectorised binary search; a hit counts only if the stored string is equal, and
entries that share a key are tried one after the other.

An index of up to ``MAP_BYTES`` (measured, not guessed) goes to every task,
which maps it. A larger one stays in the shared folder, cut into key ranges:
the distinct texts to look up are shuffled to the range that owns them and one
task per range maps its part; hits are joined back.

Host: after the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased;
path: from there up to ``? #`` or the end; both are empty for null or without
``://``. A rule fits its host and all subdomains when the path starts with the
rule's; the longest wins. Without a rule a listed site is blocked and the rest
allowed. Rows that repeat are judged alike; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
import os
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from eventide.llm.shared import saved, ship
from eventide.llm.textops import lower_az

MAP_BYTES = 32 << 20
SEED = 42                     # of Spark's own xxhash64()
ALLOW, BLOCK, LISTED = 0, 1, 2


def read_sites(path) -> tuple[str, ...]:
    """Listed sites of a text file: one a line, A-Z lower-cased; blank lines and ``#`` comments do not count."""
    with open(path, encoding="utf-8") as f:
        lines = [line.partition("#")[0].strip() for line in f]
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return tuple(sorted({line.translate(upper) for line in lines if line}))


def entries(spark: SparkSession, rules, listed) -> DataFrame:
    """``text, action`` of rules ``(action, text)`` and of listed sites."""
    rows = [(text, {"allow": ALLOW, "block": BLOCK}[action]) for action, text in rules] + [(site, LISTED) for site in listed]
    return spark.createDataFrame(rows, "text string, action int")


class DigestArray:
    """Sorted keys in a mapped file, strings behind them."""

    def __init__(self, texts: list[bytes], actions: list[int]):
        keys = np.array([digest(t) for t in texts], np.uint64)
        order = np.argsort(keys, kind="stable")
        self.texts, self.actions = [texts[i] for i in order], [actions[i] for i in order]
        # the file is unlinked at once: the map lives as long as the task, nothing stays behind
        handle, path = tempfile.mkstemp()
        with os.fdopen(handle, "wb") as f:
            f.write(keys[order].tobytes() or bytes(8))
        self.keys = np.memmap(path, np.uint64, "r")[:len(keys)]
        os.unlink(path)

    def find(self, texts: list[bytes]) -> np.ndarray:
        """Place of each text in the array, or -1."""
        want = np.array([digest(t) for t in texts], np.uint64)
        at = np.searchsorted(self.keys, want)
        out = np.full(len(texts), -1, np.int64)
        todo = np.arange(len(texts))
        while len(todo):
            todo = todo[at[todo] < len(self.keys)]
            todo = todo[self.keys[at[todo]] == want[todo]]
            for i in todo.tolist():
                if self.texts[at[i]] == texts[i]:
                    out[i] = at[i]
            todo = todo[out[todo] < 0]     # a collision: the next entry of the same key
            at[todo] += 1
        return out


def digest(text: bytes) -> int:
    import xxhash
    return xxhash.xxh64_intdigest(text, SEED)


def parts(url):
    """``(host, path)`` columns of a url column."""
    u = F.coalesce(url, F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substr(u, at + 3)).otherwise("")
    host = F.regexp_extract(rest, "^([^/?#]*)", 1)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return lower_az(host), path


def candidates(host: str, path: str, lengths: tuple[int, ...]) -> list[str]:
    """Texts under which a page may be found: rules from the longest, then sites."""
    labels = host.split(".") if host else []
    domains = [".".join(labels[i:]) for i in range(len(labels))]
    starts = {path[:n] for n in lengths if n <= len(path)}
    return sorted((d + s for d in domains for s in starts), key=lambda t: (-len(t), t)) + domains


def verdicts(pages: DataFrame, listing: DataFrame, url_col: str = "url", map_bytes: int = MAP_BYTES) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict`` (older columns of these names
    are replaced); ``listing`` has ``text, action``."""
    spark = pages.sparkSession
    ship(spark)
    listing = saved(listing.groupBy("text").agg(F.max("action").alias("action")), "url-listing")
    is_rule = F.col("action") != LISTED
    facts = listing.agg(F.sum(F.octet_length("text") + 16).alias("bytes"),
                        F.collect_set(F.when(is_rule, F.length("text") - F.instr("text", "/") + 1)).alias("lengths")).first()
    lengths = tuple(sorted(facts["lengths"]))
    host, path = parts(F.col(url_col))
    split = pages.drop("host", "path", "rule", "verdict").withColumn("host", host).withColumn("path", path)
    if (facts["bytes"] or 0) <= map_bytes:
        return _mapped(split, listing, lengths)
    return _sharded(split, listing, lengths, max(1, -(-facts["bytes"] // map_bytes)))


def _judge(hits) -> tuple[str | None, str]:
    """From ``(text, action)`` of a page's hits in order of precedence."""
    for text, action in hits:
        return (None, "block") if action == LISTED else (text, "allow" if action == ALLOW else "block")
    return None, "allow"


def _mapped(split: DataFrame, listing: DataFrame, lengths) -> DataFrame:
    rows = [(r["text"], r["action"]) for r in listing.orderBy("text").collect()]   # at most MAP_BYTES
    out = T.StructType([*split.schema.fields, T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())])
    h, p = split.columns.index("host"), split.columns.index("path")

    def judged(batches):
        index = DigestArray([t.encode() for t, _ in rows], [a for _, a in rows])
        for batch in batches:
            tries = [candidates(a, b, lengths) for a, b in zip(batch.column(h).to_pylist(), batch.column(p).to_pylist(), strict=True)]
            at = index.find([t.encode() for ts in tries for t in ts]).tolist()
            ends = list(itertools.accumulate(map(len, tries), initial=0))
            found = [_judge((index.texts[k].decode(), index.actions[k]) for k in at[a:b] if k >= 0)
                     for a, b in itertools.pairwise(ends)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([r for r, _ in found], pa.string()), pa.array([v for _, v in found], pa.string())], out.names)

    return split.mapInArrow(judged, out)


def _sharded(split: DataFrame, listing: DataFrame, lengths, shards: int) -> DataFrame:
    """Key ranges owned by tasks; texts to look up go to the range of their key."""
    import pandas as pd

    kept = saved(split.withColumn("_row", F.monotonically_increasing_id()), "url-pages")
    schema = T.StructType([T.StructField("_row", T.LongType()), T.StructField("_no", T.IntegerType()), T.StructField("text", T.StringType())])

    def tried(batches):
        for batch in batches:
            cols = [c.to_pylist() for c in batch.columns]
            rows = [(r, n, t) for r, a, b in zip(*cols, strict=True) for n, t in enumerate(candidates(a, b, lengths))]
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x, strict=True)) for x in rows], pa.schema([("_row", pa.int64()), ("_no", pa.int32()), ("text", pa.string())]))

    tries = kept.select("_row", "host", "path").mapInArrow(tried, schema)
    shard = F.pmod(F.shiftright(F.xxhash64("text"), 32), F.lit(shards))

    def looked_up(wanted, part):
        index = DigestArray([t.encode() for t in part["text"]], part["action"].tolist())
        at = index.find([t.encode() for t in wanted["text"]])
        hit = np.flatnonzero(at >= 0)
        return pd.DataFrame({"text": wanted["text"].to_numpy()[hit], "action": [index.actions[k] for k in at[hit]]})

    wanted = tries.select("text").distinct().withColumn("_shard", shard)
    hits = (wanted.groupBy("_shard").cogroup(listing.withColumn("_shard", shard).groupBy("_shard"))
            .applyInPandas(looked_up, "text string, action int"))
    best = (tries.join(hits, "text").groupBy("_row").agg(F.min(F.struct("_no", "text", "action")).alias("_hit"))
            .select("_row", "_hit"))
    listed = F.col("_hit.action") == LISTED
    return (kept.join(best, "_row", "left")
            .withColumn("rule", F.when(~listed, F.col("_hit.text")))
            .withColumn("verdict", F.when(F.col("_hit").isNull() | (F.col("_hit.action") == ALLOW), "allow").otherwise("block"))
            .drop("_row", "_hit"))
