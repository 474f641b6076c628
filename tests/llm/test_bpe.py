"""Byte-level BPE against the library, whole and cut into small chunks."""

import hashlib
import tracemalloc
from collections import Counter

import numpy as np
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import ODD, SF001, sf001, small

from kpipulse.llm import bpe
from kpipulse.llm import queries as Q

RANKS = P.path("byte_bpe_50k.tiktoken")
CODER = bpe.Encoder.get(RANKS, P.PATTERN)
# letters, numbers and others of newer Unicode versions than some libraries know
NEW = "՘࢏౜ᲉꟋ₏\U00011de0\U00016d40\U0001e5d0\U0001246f"
ALPHABET = "aé 's'tre'llm\n\t  　x1²٣!?…\U0001f600\x1c\x85" + NEW
TRICKY = [
    "we'll they're I'd 'S 'sx ''s x'",
    "   leading  and   trailing   \n\n \t x",
    "x" * 700 + "!" * 300 + " " * 500 + "7" * 400,
    " " * 1000,
    "\n" * 257 + "'",
    "don't" * 100,
    ("a" * 15 + "'") * 40,
    "é\U0001f600" * 200,
    NEW * 30,
    "word " * 300,
]


def _library(text):
    return CODER.encoding.encode_ordinary(text or "")


@given(st.text(alphabet=ALPHABET, max_size=60))
@settings(max_examples=300, deadline=None)
def test_pieces_are_the_librarys(text):
    assert "".join(CODER.pieces(text)) == text
    assert np.frombuffer(CODER.encode(text), "<u4").tolist() == _library(text)


def _check(frame, texts, **cut):
    coded = bpe.encode(frame, RANKS, P.PATTERN, **cut)
    got = Counter((r["doc_id"], bytes(r["ids"]), bytes(r["decoded"])) for r in bpe.decode(coded, RANKS, P.PATTERN).collect())
    assert got == Counter((i, np.array(_library(t), "<u4").tobytes(), (t or "").encode()) for i, t in texts)


def test_chunks_are_stitched(spark):
    """Small chunks: cuts inside words, contractions, runs of white space, and
    pre-tokens over many chunks."""
    rng = np.random.default_rng(5)
    texts = TRICKY + ["".join(rng.choice(list(ALPHABET), 400)) for _ in range(60)] + [t for _, t in small(spark)[:20]]
    rows = list(enumerate(texts))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    _check(frame, rows, chunk_chars=32, overlap=8)
    _check(frame, rows, chunk_chars=13, overlap=13)
    _check(frame, rows, chunk_chars=100, overlap=40)


def test_odd_rows(spark, odd, none):
    _check(odd, ODD)
    _check(odd, ODD, chunk_chars=4096, overlap=64)
    assert bpe.encode(none, RANKS, P.PATTERN).count() == 0
    assert bpe.encode(none, RANKS, P.PATTERN).columns == ["doc_id", "ids"]


def test_query_digests(spark):
    got = Counter(tuple(r) for r in Q.op11_byte_bpe(spark, SF001).collect())
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = Counter()
    for i, t in small(spark):
        ids = _library(t)
        want[(i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha((t or "").encode()))] += 1
    assert got == want and sf001(spark, "documents").count() == sum(got.values())


def test_remembered_pieces_stay_small():
    """Texts of ever new words don't fill the worker's memory."""
    coder = bpe.Encoder(RANKS, P.PATTERN)
    tracemalloc.start()
    try:
        for i in range(400):
            text = " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}{chr(97 + j % 26)}{chr(97 + j // 26 % 26)}{chr(97 + j // 676)}" for j in range(1000))
            got = coder.encode(text)
            if i % 57 == 0:
                assert np.frombuffer(got, "<u4").tolist() == _library(text)
        held = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert held < 40e6
    assert not any(len(p) > bpe.CACHED_CHARS for p in coder.known)
