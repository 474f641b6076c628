"""Benchmark decontamination by spaced-seed hashing.

A seed is a fixed mask over a span of words: the hash covers the positions
that the mask selects and ignores the others, so a substituted word spoils
only the seeds that select it. Seeds of all benchmark items form a lookup
table; every window of the corpus is hashed under each mask and looked up.
Around a hit the item is laid along the text (no gaps), and all maximal
stretches with enough equal words are verified word by word: those with equal
words at both ends that lie in no longer one (they may overlap).

The masks miss no overlap. One of at least twice ``min_words`` words can be
halved, and a half is an overlap as well, so it holds one of ``min_words`` to
``2 * min_words - 1`` words; under ``MASKS`` each choice of replaced words in
such a one leaves a seed whole (tests enumerate them). Looser limits than
those of ``MASKS`` take the run of equal words that must be left.

Words are lower-case runs of letters, digits and non-ASCII characters. The
benchmark is handled in blocks of about ``BLOCK_WORDS`` words, each a table of
bounded size that goes to the executors; the corpus is never shuffled.

Defined results for odd input: null and blank texts have no overlap; items of
fewer than ``min_item`` words (``MIN_ITEM`` by default, 1 for all) identify nothing and
are left out; items shorter than ``min_words`` must occur whole and unchanged; null ids are kept; rows
that repeat an id are handled apart; an empty table on either side gives no
overlaps; other columns are ignored, and kept by ``remove_contaminated``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .toxicity import plain

#: Which words of a span a seed selects: complete for overlaps of at least
#: ``MASK_WORDS`` words of which ``MASK_PERCENT`` percent are equal.
MASKS = ("11110111", "11101001011", "110011111", "1110100010011", "1001001010111", "1111111")
MASK_WORDS, MASK_PERCENT = 13, 80
MIN_ITEM = 5
BLOCK_WORDS = 500_000
FILTER_BITS = 22
BYTES_AT_ONCE = 1 << 20
PAIRS_AT_ONCE = 1 << 18

_ODD = np.random.default_rng(8).integers(1, 1 << 62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def masks_for(min_words: int, percent: int) -> tuple[str, ...]:
    """Masks of which each overlap has a seed."""
    if min_words >= MASK_WORDS and percent >= MASK_PERCENT:
        return MASKS
    runs = []
    for n in range(min_words, 2 * min_words):
        replaced = n * (100 - percent) // 100
        runs.append(math.ceil((n - replaced) / (replaced + 1)))
    return ("1" * max(1, min(runs)),)


def seeds(h: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the selected words of each window."""
    n = len(h) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i, bit in enumerate(mask):
        if bit == "1":
            total += h[i : i + n] * _ODD[i]
    return W.mix(total, np.full(1, len(mask), np.uint64))


@dataclass
class Index:
    """Seeds of some items: per mask the sorted hashes with item and place,
    and a bit table over the hashes' upper bits. ``flat`` holds the words of
    all items, ``begin`` the first one of each."""

    ids: list
    flat: np.ndarray
    begin: np.ndarray
    tables: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]
    filter: np.ndarray
    min_words: int
    percent: int

    @classmethod
    def of(cls, ids: list, texts: list[bytes], min_words: int, percent: int, min_item: int = MIN_ITEM) -> Index:
        (h,), starts = W.hash_words(plain(pa.array(texts, pa.large_binary())), lanes=1)
        masks = masks_for(min_words, percent)
        rows: dict[str, list] = {}
        for k, (a, b) in enumerate(zip(starts[:-1], starts[1:], strict=True)):
            words = h[a:b]
            if len(words) < max(1, min_item):
                continue
            for mask in masks if len(words) >= min_words else ("1" * len(words),):
                found = seeds(words, mask)
                rows.setdefault(mask, []).append((found, np.full(len(found), k), np.arange(len(found))))
        tables = {}
        bits = np.zeros(1 << FILTER_BITS, bool)
        for mask, parts in rows.items():
            hashes, owner, place = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(hashes, kind="stable")
            tables[mask] = hashes[order], owner[order], place[order]
            bits[(hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        return cls(ids, h, starts, tables, np.packbits(bits), min_words, percent)

    def words(self, item: int) -> np.ndarray:
        return self.flat[self.begin[item] : self.begin[item + 1]]

    def hits(self, h: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Distinct (text, item, shift): the item's first word lies ``shift``
        words after the first word of the batch."""
        bits = np.unpackbits(self.filter).astype(bool)
        out = [np.zeros((0, 3), np.int64)]
        for mask, (hashes, owner, place) in self.tables.items():
            at = W.window_starts(starts, len(mask))
            found = seeds(h, mask)[at]
            maybe = bits[(found >> np.uint64(64 - FILTER_BITS)).astype(np.int64)]
            found, at = found[maybe], at[maybe]
            low, high = np.searchsorted(hashes, found), np.searchsorted(hashes, found, side="right")
            some = high > low
            low, at, n = low[some], at[some], (high - low)[some]
            for i, j in W.slices(n, PAIRS_AT_ONCE):
                m = n[i:j]
                row = np.repeat(low[i:j], m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
                where = np.repeat(at[i:j], m)
                text = np.searchsorted(starts, where, side="right") - 1
                near = self._near(h, starts, text, where, owner[row], place[row])
                out.append(np.unique(np.stack([text, owner[row], where - place[row]], axis=1)[near], axis=0))
        return np.unique(np.concatenate(out), axis=0)

    def _near(self, h: np.ndarray, starts: np.ndarray, text: np.ndarray, at: np.ndarray, item: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Whether enough words around a hit are equal for a shortest overlap:
        one of under ``2 * min_words`` words that holds the hit."""
        begin, end = self.begin[item], self.begin[item + 1]
        own = begin + place
        equal = np.zeros(len(at), np.int64)
        for by in range(2 - 2 * self.min_words, 2 * self.min_words - 1):
            t, o = at + by, own + by
            inside = (t >= starts[text]) & (t < starts[text + 1]) & (o >= begin) & (o < end)
            equal += inside & (h[np.where(inside, t, 0)] == self.flat[np.where(inside, o, 0)])
        least = self.min_words - self.min_words * (100 - self.percent) // 100
        return equal >= np.minimum(least, end - begin)


def stretches(same: np.ndarray, percent: int, least: int) -> list[tuple[int, int]]:
    """The maximal runs of at least ``least`` places, equal at both ends, of
    which at least ``percent`` percent are equal."""
    at = np.flatnonzero(same)
    if not len(at):
        return []
    run = np.concatenate([[0], np.cumsum(np.where(same, 100 - percent, -percent))])
    low = np.minimum.accumulate(run)
    # per end the first place with a running sum no larger, and there or next an equal one
    first = at[np.searchsorted(at, np.searchsorted(-low, -run[at + 1]))]
    ahead = np.minimum.accumulate(first[::-1])[::-1]
    keep = np.append(first[:-1] < ahead[1:], True) & (at + 1 - first >= least)
    return list(zip(first[keep].tolist(), (at[keep] + 1).tolist(), strict=True))


def overlaps_of(index: Index, texts: pa.Array) -> list[tuple[int, int, int, int, int]]:
    """Verified overlaps: row, item, first word, end word, equal words."""
    (h,), starts = W.hash_words(plain(texts), lanes=1)
    out = []
    for row, item, shift in index.hits(h, starts).tolist():
        words = index.words(item)
        a, b = max(shift, starts[row]), min(shift + len(words), starts[row + 1])
        same = h[a:b] == words[a - shift : b - shift]
        if len(words) < index.min_words:
            found = [(0, len(words))] if len(same) == len(words) and same.all() else []
        else:
            found = stretches(same, index.percent, index.min_words)
        for i, j in found:
            out.append((row, item, int(a + i - starts[row]), int(a + j - starts[row]), int(same[i:j].sum())))
    return out


def blocks(benchmark: DataFrame, min_words: int, percent: int, min_item: int) -> Iterator[Index]:
    """Indexes of the benchmark, a block of items at a time."""
    items = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    n_bytes = items.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    n = max(1, math.ceil(n_bytes / 5 / BLOCK_WORDS))
    for block in range(n):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block).collect()
        rows.sort(key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["text"]))
        if rows:
            yield Index.of([r["item_id"] for r in rows], [r["text"].encode() for r in rows], min_words, percent, min_item)


def find_overlaps(docs: DataFrame, benchmark: DataFrame, min_words: int = 13, percent: int = 80, min_item: int = MIN_ITEM) -> DataFrame:
    """``doc_id, item_id, start, end, n_equal`` of every overlap: word
    positions in the document, and how many words of the stretch are equal.
    Items of fewer than ``min_item`` words are left out."""

    def scan(index: Index) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = W.as_binary(batch["text"])
                ids = batch["doc_id"].to_pylist()
                for i, j in W.slices(np.diff(W.raw(texts)[1]), BYTES_AT_ONCE):
                    found = overlaps_of(index, texts.slice(i, j - i))
                    rows = [(ids[i + r], index.ids[k], a, b, n) for r, k, a, b, n in found]
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (zip(*rows, strict=True) if rows else [[]] * 5)], _NAMES)

        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ", ".join(f"`{n}` long" for n in _NAMES))

    found = [scan(index) for index in blocks(benchmark, min_words, percent, min_item)]
    if not found:
        return docs.sparkSession.createDataFrame([], ", ".join(f"`{n}` long" for n in _NAMES))
    return reduce(DataFrame.unionByName, found)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, min_words: int = 13, percent: int = 80, min_item: int = MIN_ITEM) -> DataFrame:
    """The rows of ``docs`` without any overlap, in one pass per block."""

    def clean(rows: DataFrame, index: Index) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = W.as_binary(batch["text"])
                keep = np.ones(batch.num_rows, bool)
                for i, j in W.slices(np.diff(W.raw(texts)[1]), BYTES_AT_ONCE):
                    for found in overlaps_of(index, texts.slice(i, j - i)):
                        keep[i + found[0]] = False
                yield batch.filter(pa.array(keep))

        return rows.mapInArrow(run, rows.schema)

    return reduce(clean, blocks(benchmark, min_words, percent, min_item), docs)


_NAMES = ["doc_id", "item_id", "start", "end", "n_equal"]
