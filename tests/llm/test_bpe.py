"""BPE against tiktoken; stitching; round trips."""
import base64
import collections

import numpy as np
import pytest
import regex
import tiktoken

from eventide.llm import bpe
from eventide.llm.queries import tokenizer
from llm.fixture_docs import documents, frame

RANKS, PATTERN = tokenizer()


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("chunk,overlap", [(bpe.CHUNK_CHARS, bpe.OVERLAP), (120, 40), (64, 12)])
def test_ids_are_those_of_tiktoken(spark, reference, chunk, overlap):
    rows = documents(n=40)
    df = bpe.encode(frame(spark, rows, extra=("ids", "_text", "_row")), RANKS, PATTERN, chunk_chars=chunk, overlap=overlap)
    got = collections.Counter((r["doc_id"], tuple(r["ids"])) for r in bpe.decode(df, RANKS).collect())
    assert got == collections.Counter((r[0], tuple(reference.encode_ordinary(r[1] or ""))) for r in rows)


def test_round_trip(spark):
    rows = documents(n=40) + [(900, "it's we'll they've​ ́ \x00 \x85 don't", None, None, 1), (901, "'" * 50 + "ll", None, None, 1)]
    back = bpe.decode(bpe.encode(frame(spark, rows), RANKS, PATTERN), RANKS).collect()
    same = bpe.encode(frame(spark, rows), RANKS, PATTERN, chunk_chars=120, overlap=40, bytes_col="bytes").collect()
    assert collections.Counter(map(repr, same)) == collections.Counter(map(repr, back))
    assert collections.Counter((r["doc_id"], bytes(r["bytes"]).decode()) for r in back) == collections.Counter((r[0], r[1] or "") for r in rows)


def test_stitch_equals_whole_text():
    findall = regex.compile(PATTERN).findall
    rng = np.random.default_rng(3)
    alphabet = list("ab '  \n\n\t1.é!") + ["'ll", "'s", "   ", "the", " "]
    for _ in range(400):
        text = "".join(rng.choice(alphabet, int(rng.integers(0, 300)))) + "z" * int(rng.integers(0, 80)) + " " * int(rng.integers(0, 60))
        chunks = bpe.cut(text, 48, 16)
        pieces = bpe.stitch(chunks, [np.array([len(x) for x in findall(c)], int) for c in chunks], 16, findall)
        assert pieces == findall(text)


def test_no_special_tokens_and_empty_table(spark):
    rows = [(1, "<|endoftext|>", None, None, 1)]
    assert len(bpe.encode(frame(spark, rows), RANKS, PATTERN).first()["ids"]) > 1
    assert bpe.decode(bpe.encode(frame(spark, []), RANKS, PATTERN), RANKS).count() == 0
