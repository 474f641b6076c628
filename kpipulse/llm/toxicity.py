"""Toxicity: a factorization machine over hashed terms.

A document is the set of its terms (lower-case runs of letters, digits and
non-ASCII characters, and their first 4, 5 and 6 bytes, so that inflected
forms share a term), hashed into ``2**BITS`` buckets. The machine adds to
the linear weights a learned interaction of each pair of terms, the inner
product of their factors, computed in linear time from two sums per factor.

The machine is fitted on a bounded sample of labelled rows (``MAX_LABELLED``,
by hash of the id): Spark counts the buckets, and those take part that depend on
the label beyond chance (``MIN_CHI``) or stand in so large a share of the rows
(``FREQUENT``) that a pair of them can matter where each alone does not. There
is no rank to cut them off: at most ``2**BITS`` buckets exist, so the model has
a bounded size whatever the corpus is. Weights and factors follow mini-batch
AdaGrad on the logistic loss; scoring is one pass over all texts.

Defined results for odd input: null and empty texts have no terms and get the
machine's base rate; a null ``doc_id`` is kept (and not used to learn); rows
that repeat a ``doc_id`` are scored apart; without labels of both classes
every score is the share of ones (0.5 without labels); an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W

BITS = 20
STEMS = (4, 5, 6)
MAX_LABELLED = 20_000
MIN_CHI = 10.83  # one in a thousand by chance
FREQUENT = 0.1
FACTORS = 8
BYTES_AT_ONCE = 1 << 20

_TERM = np.full(256, 32, np.uint8)  # what ends a term becomes a space
for _c in range(256):
    if _c >= 128 or chr(_c).isalnum():
        _TERM[_c] = _c + 32 if 65 <= _c <= 90 else _c


def plain(texts: pa.Array) -> pa.Array:
    """Texts in lower case with a space for each byte that ends a term."""
    body, offsets = W.raw(texts)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(texts), [None, pa.py_buffer(np.ascontiguousarray(offsets)), pa.py_buffer(_TERM[body])]
    )


def terms(texts: pa.Array, slot: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of each distinct term of each text, sorted. With
    ``slot`` only buckets that have one."""
    row = None
    keys = []
    for buckets, starts in hashed(plain(texts)):
        if row is None:
            row = np.repeat(np.arange(len(texts), dtype=np.int64), np.diff(starts))
        known = slice(None) if slot is None else slot[buckets] >= 0
        keys.append((row[known] << BITS) | buckets[known])
    key = np.unique(np.concatenate(keys))
    return key >> BITS, key & ((1 << BITS) - 1)


def hashed(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets of the whole words, then of their beginnings of each length in
    ``STEMS`` (whole words that are shorter share the bucket of all of them)."""
    kept, bounds, starts = W.cut_words(texts)
    begin, end = bounds[:-1], bounds[1:]
    up, down = W.powers(0, max(1, len(kept)))
    run = np.zeros(len(kept) + 1, dtype=np.uint64)
    np.cumsum(W.BYTE_VALUES[0][kept] * up[: len(kept)], out=run[1:])
    for stem in (None, *STEMS):
        stop = end if stem is None else np.minimum(begin + stem, end)
        tag = (stop - begin).astype(np.uint64) + np.uint64(0 if stem is None else 1 << 20)
        value = W.mix((run[stop] - run[begin]) * down[begin], tag)
        yield (value >> np.uint64(64 - BITS)).astype(np.int64), starts


@dataclass
class Machine:
    """``slot``: bucket to term number, or -1; ``weights``; ``factors``."""

    slot: np.ndarray
    base: float
    weights: np.ndarray
    factors: np.ndarray

    def score(self, row: np.ndarray, bucket: np.ndarray, n: int) -> np.ndarray:
        term = self.slot[bucket]
        row, term = row[term >= 0], term[term >= 0]
        z = self.base + np.bincount(row, self.weights[term], n)
        for f in range(self.factors.shape[1]):
            v = self.factors[term, f]
            z += (np.bincount(row, v, n) ** 2 - np.bincount(row, v * v, n)) / 2
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def screen(counts: DataFrame, n: int, pos: int, min_chi: float = MIN_CHI, frequent: float = FREQUENT, min_rows: int = 3) -> np.ndarray:
    """Buckets whose chi-square against the label is at least ``min_chi`` or
    that stand in a share ``frequent`` of the rows, from ``bucket, seen, hits``
    (documents with the term, and how many of them are ones)."""
    want = F.col("seen") * F.lit(pos / n)
    spread = want * F.lit(1 - pos / n) * (1 - F.col("seen") / F.lit(n))
    chi = (F.col("hits") - want) ** 2 / spread
    some = counts.filter((F.col("seen") >= min_rows) & (spread > 0))
    rows = some.filter((chi >= min_chi) | (F.col("seen") >= frequent * n)).select("bucket")
    return np.array(sorted(r["bucket"] for r in rows.collect()), np.int64)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch: each bucket, in how many texts it is, and in how many ones."""
    for batch in batches:
        row, bucket = terms(W.as_binary(batch["text"]))
        toxic = batch["toxic"].to_numpy()[row]
        found, place = np.unique(bucket, return_inverse=True)
        columns = [found, np.bincount(place, minlength=len(found)), np.bincount(place, toxic, len(found)).astype(np.int64)]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["bucket", "seen", "hits"])


def fit(
    row: np.ndarray,
    bucket: np.ndarray,
    y: np.ndarray,
    factors: int = FACTORS,
    epochs: int = 15,
    batch: int = 256,
    rate: float = 0.1,
    shrink: float = 2e-4,
    seed: int = 9,
) -> Machine:
    """Fit on documents 0..len(y)-1 with terms ``(row, bucket)``."""
    slot = np.full(1 << BITS, -1, np.int64)
    share = float(y.mean()) if len(y) else 0.5
    if share in (0.0, 1.0) or not len(y):
        share = min(max(share, 1e-3), 1 - 1e-3)
        return Machine(slot, float(np.log(share / (1 - share))), np.zeros(0), np.zeros((0, factors)))
    chosen = np.unique(bucket)
    slot[chosen] = np.arange(len(chosen))
    order = np.argsort(row, kind="stable")
    term = slot[bucket][order]
    first = np.searchsorted(row[order], np.arange(len(y) + 1))
    rng = np.random.default_rng(seed)
    base, w, v = float(np.log(share / (1 - share))), np.zeros(len(chosen)), rng.normal(0, 0.05, (len(chosen), factors))
    gb, gw, gv = 1e-6, np.full(len(chosen), 1e-6), np.full((len(chosen), factors), 1e-6)
    for _ in range(epochs):
        for pick in np.array_split(rng.permutation(len(y)), max(1, len(y) // batch)):
            n = first[pick + 1] - first[pick]
            doc = np.repeat(np.arange(len(pick)), n)
            t = term[np.arange(n.sum()) + np.repeat(first[pick] - (np.cumsum(n) - n), n)]
            of_doc = lambda x: np.bincount(doc, x, len(pick))  # noqa: E731, B023
            of_term = lambda x: np.bincount(t, x, len(chosen))  # noqa: E731, B023
            rows = v[t]
            sums = np.stack([of_doc(rows[:, f]) for f in range(factors)], axis=1)
            squares = of_doc((rows**2).sum(1))
            z = base + of_doc(w[t]) + ((sums**2).sum(1) - squares) / 2
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[pick]) / len(pick)
            mass = of_term(error[doc])
            dw = mass + shrink * w
            pulled = error[:, None] * sums
            dv = np.stack([of_term(pulled[doc, f]) for f in range(factors)], axis=1) - mass[:, None] * v + shrink * v
            db = error.sum()
            gb += db * db
            gw += dw * dw
            gv += dv * dv
            base -= rate * db / np.sqrt(gb)
            w -= rate * dw / np.sqrt(gw)
            v -= rate * dv / np.sqrt(gv)
    return Machine(slot, base, w, v)


def held_out(doc_id: Column) -> Column:
    """Rows never learned from: crc32 of the id as text divides by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Machine:
    chosen = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .select(F.col("doc_id").alias("_id"), "toxic")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "toxic")
        .limit(max_labelled)
    )
    known = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    known = known.select("doc_id", F.col("toxic").cast("int").alias("toxic"), "text")
    total = known.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("pos")).first()
    if not 0 < total["pos"] < total["n"]:
        return fit(np.zeros(0, np.int64), np.zeros(0, np.int64), np.full(total["n"], float(total["pos"] > 0)))
    counts = known.mapInArrow(_counts, "bucket long, seen long, hits long").groupBy("bucket")
    best = screen(counts.agg(F.sum("seen").alias("seen"), F.sum("hits").alias("hits")), total["n"], total["pos"])
    slot = np.full(1 << BITS, -1, np.int32)
    slot[best] = 1

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = W.as_binary(batch["text"])
            row, bucket = terms(texts, slot)
            cuts = np.searchsorted(row, np.arange(len(texts) + 1))
            packed = [bucket[a:b].astype("<i4").tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["toxic"], pa.array(packed, pa.binary())], ["doc_id", "toxic", "terms"])

    # at most max_labelled rows (and as many more as repeat an id), each with
    # its chosen terms
    rows = known.mapInArrow(collect, "doc_id long, toxic int, terms binary").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["toxic"], r["terms"]))
    lists = [np.frombuffer(r["terms"], "<i4") for r in rows]
    row = np.repeat(np.arange(len(lists)), [len(x) for x in lists]).astype(np.int64)
    bucket = np.concatenate([np.zeros(0, "<i4"), *lists]).astype(np.int64)
    return fit(row, bucket, np.array([r["toxic"] for r in rows], float))


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """``doc_id, score`` for every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = W.as_binary(batch["text"])
            out = []
            for i, j in W.slices(np.diff(W.raw(texts)[1]), BYTES_AT_ONCE):
                row, bucket = terms(texts.slice(i, j - i), machine.slot)
                out.append(machine.score(row, bucket, j - i))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(np.concatenate(out or [np.zeros(0)]))], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
