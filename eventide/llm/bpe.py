"""Byte-level BPE: encoding in overlapping chunks, decoding by joining raw bytes.

A text of up to ``chunk_chars`` characters is one chunk and is encoded where it
is read. A longer one is cut into chunks that overlap by ``overlap``
characters; the chunks are dealt over all tasks and pre-tokenised there. The
pre-token pattern has no memory beyond the position where a match starts, so
once two neighbouring chunks share one boundary inside their overlap they share
all that follow: the text is stitched at the first such boundary, and its
pieces are then merged by the ranks. Boundaries within ``MARGIN`` characters of
a chunk's end are not trusted (the pattern looks that far ahead). Where an
overlap holds no common boundary (a run of letters or blanks longer than the
overlap) the rest of the left chunk is pre-tokenised anew together with the
right one, so the pieces are always those of the whole text.

Null and empty texts have no ids. Rows are independent: repeated rows and ids
give repeated results; an empty table gives no rows. The rank file is read on
the driver and shipped with the tasks (its size is that of the vocabulary).
"""

from __future__ import annotations

import base64
import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from eventide.llm.shared import ship
from eventide.llm.textops import steps

CHUNK_CHARS = 16_384
OVERLAP = 512
MARGIN = 8
CACHED_PIECES = 50_000
STEP = 1 << 20          # text bytes that are Python objects at a time


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def parse_ranks(raw: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in raw.splitlines() if line)}


class PieceEncoder:
    """Pre-tokens by the pattern, ids by the ranks; keeps the ids of frequent pieces."""

    def __init__(self, raw: bytes, pattern: str):
        import regex
        import tiktoken

        self.findall = regex.compile(pattern).findall
        self.core = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=parse_ranks(raw), special_tokens={})._core_bpe
        self.known: dict[str, list[int]] = {}

    def piece(self, piece: str) -> list[int]:
        ids = self.known.get(piece)
        if ids is None:
            ids = self.core.encode_single_piece(piece.encode("utf-8", "surrogatepass"))
            if len(piece) <= 64:
                if len(self.known) >= CACHED_PIECES:
                    self.known.clear()
                self.known[piece] = ids
        return ids

    def ids(self, pieces: list[str]) -> list[int]:
        return list(itertools.chain.from_iterable(map(self.piece, pieces)))


def cut(text: str, chunk: int, overlap: int) -> list[str]:
    """Chunks of ``chunk`` characters; each but the first begins ``overlap`` before its neighbour's end."""
    step = chunk - overlap
    return [text[a:a + chunk] for a in range(0, max(1, len(text) - overlap), step)]


def stitch(chunks: list[str], lengths: list[np.ndarray], overlap: int, findall) -> list[str]:
    """Pieces of the whole text from each chunk's own pieces (given by their lengths)."""
    out: list[str] = []
    base = 0                       # place of the current left text in the whole
    left, ends, done = chunks[0], np.cumsum(lengths[0]), 0   # done: left is cut into pieces up to here
    for chunk, own in zip(chunks[1:], lengths[1:], strict=True):
        at = len(left) - overlap   # where this chunk begins in left
        mine = np.cumsum(own) + at
        safe = ends[(ends > max(at, done)) & (ends <= len(left) - MARGIN)]
        common = np.intersect1d(safe, mine)
        if len(common):
            p = int(common[0])
            out += _slices(left, ends, done, p)
            left, done, ends = chunk, p - at, mine - at
        else:
            # no boundary in common: keep what is certain, pre-tokenise the rest with the next chunk
            good = ends[(ends > done) & (ends <= len(left) - MARGIN)]
            p = int(good[-1]) if len(good) else done
            out += _slices(left, ends, done, p)
            left = left[p:] + chunk[overlap:]
            done, ends = 0, np.cumsum([len(x) for x in findall(left)])
    return out + _slices(left, ends, done, len(left))


def _slices(text: str, ends: np.ndarray, start: int, stop: int) -> list[str]:
    marks = [start, *ends[(ends > start) & (ends <= stop)].tolist()]
    return [text[a:b] for a, b in itertools.pairwise(marks)]


def _id_lists(lists: list[list[int]]) -> pa.Array:
    offs = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
    flat = np.fromiter(itertools.chain.from_iterable(lists), np.int32, int(offs[-1]))
    return pa.ListArray.from_arrays(pa.array(offs), pa.array(flat))


def encode(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", ids_col: str = "ids",
           keep: tuple[str, ...] = ("doc_id",), chunk_chars: int = CHUNK_CHARS, overlap: int = OVERLAP,
           bytes_col: str | None = None) -> DataFrame:
    """The columns ``keep`` and ``ids_col`` (array of int), one row per input
    row. ``bytes_col`` adds the decoded bytes of those ids in the same pass, as
    :func:`decode` does in one of its own (with workers of its own)."""
    if chunk_chars < 2 * overlap + MARGIN or overlap <= MARGIN:
        raise ValueError("a chunk must hold two overlaps, and an overlap more than the margin")
    spark = docs.sparkSession
    ship(spark)
    raw = read_ranks(ranks_path)
    slim = docs.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    fields = [slim.schema[k] for k in keep]
    out = T.StructType([*fields, T.StructField(ids_col, T.ArrayType(T.IntegerType())),
                        *([T.StructField(bytes_col, T.BinaryType())] if bytes_col else [])])

    def whole(batches):
        enc, dec = PieceEncoder(raw, pattern), Decoder(raw)
        for batch in batches:
            for part in steps(batch, "_text", STEP):
                ids = _id_lists([enc.ids(enc.findall(t)) for t in part.column(len(keep)).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns[:len(keep)], ids, *([dec.bytes(ids)] if bytes_col else [])], out.names)

    short = slim.where(F.length("_text") <= chunk_chars).mapInArrow(whole, out)

    chunked = T.StructType([T.StructField("_row", T.LongType()), T.StructField("_no", T.IntegerType()), *fields,
                            T.StructField("_chunk", T.StringType())])

    def cut_rows(batches):
        for batch in batches:
            for part in steps(batch, "_text", 1 << 20):
                rows, texts = part.column(len(keep) + 1).to_pylist(), part.column(len(keep)).to_pylist()
                for i, (row, text) in enumerate(zip(rows, texts, strict=True)):
                    chunks = cut(text, chunk_chars, overlap)
                    for at in range(0, len(chunks), 64):
                        some = chunks[at:at + 64]
                        index = pa.array(np.full(len(some), i))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([row] * len(some), pa.int64()), pa.array(range(at, at + len(some)), pa.int32()),
                             *[part.column(k).take(index) for k in range(len(keep))], pa.array(some, pa.string())],
                            [f.name for f in chunked])

    split = T.StructType([*chunked.fields, T.StructField("_lengths", T.ArrayType(T.IntegerType()))])

    def pre_tokenise(batches):
        import regex
        findall = regex.compile(pattern).findall
        for batch in batches:
            lists = [[len(x) for x in findall(t)] for t in batch.column(len(keep) + 2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, _id_lists(lists)], [f.name for f in split])

    made: list = []   # one encoder and decoder for all documents of a task

    def join_chunks(pdf):
        import pandas as pd
        pdf = pdf.sort_values("_no")
        if not made:
            made.extend((PieceEncoder(raw, pattern), Decoder(raw)))
        enc, dec = made
        pieces = stitch(pdf["_chunk"].tolist(), [np.asarray(x) for x in pdf["_lengths"]], overlap, enc.findall)
        row = {k: [pdf[k].iloc[0]] for k in keep}
        ids = np.array(enc.ids(pieces), np.int32)
        joined = {bytes_col: [dec.bytes(_id_lists([ids]))[0].as_py()]} if bytes_col else {}
        return pd.DataFrame({**row, ids_col: [ids], **joined})

    long = (slim.where(F.length("_text") > chunk_chars)
            .withColumn("_row", F.monotonically_increasing_id())
            .mapInArrow(cut_rows, chunked)
            .repartition("_row", "_no").mapInArrow(pre_tokenise, split)
            .groupBy("_row").applyInPandas(join_chunks, out))
    return short.unionByName(long)


class Decoder:
    """Raw bytes of ids, joined: one gather from the vocabulary's bytes."""

    def __init__(self, raw: bytes):
        ranks = parse_ranks(raw)
        tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.blob = np.frombuffer(b"".join(tokens), np.uint8)
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.size)[:-1]]) if len(tokens) else self.size

    def bytes(self, lists: pa.ListArray) -> pa.Array:
        ids = lists.flatten().to_numpy(zero_copy_only=False)
        count = np.nan_to_num(pc.list_value_length(lists).to_numpy(zero_copy_only=False)).astype(np.int64)
        width = self.size[ids]
        ends = np.concatenate([[0], np.cumsum(width)])
        data = self.blob[np.repeat(self.first[ids] - ends[:-1], width) + np.arange(ends[-1])]
        offs = ends[np.concatenate([[0], np.cumsum(count)])]
        return pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(lists), [None, pa.py_buffer(offs.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())]).cast(pa.binary())


def decode(encoded: DataFrame, ranks_path: str, ids_col: str = "ids", bytes_col: str = "bytes") -> DataFrame:
    """Adds ``bytes_col``: the raw bytes of the ids, joined."""
    ship(encoded.sparkSession)
    raw = read_ranks(ranks_path)
    out = T.StructType([*encoded.schema.fields, T.StructField(bytes_col, T.BinaryType())])
    at = encoded.columns.index(ids_col)

    def to_bytes(batches):
        decoder = Decoder(raw)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                yield pa.RecordBatch.from_arrays([*part.columns, decoder.bytes(part.column(at))], [f.name for f in out])

    return encoded.mapInArrow(to_bytes, out)
