"""Substring dedup: words covered by a window seen earlier are removed.

A window is ``size`` consecutive words of one document. Documents are dealt
into chunks by ``doc_id``; a count-min prefilter (``sketch``) tells each chunk
which of its windows are estimated to repeat. A second pass groups exactly
those: a chunk keeps the first occurrence of each window to itself (so a
window comes at most once from a chunk, however often it occurs) and marks the
others; Spark then numbers the remaining occurrences of each window by
(document, start), and all but the first are marked. The texts are shuffled
once; identity of windows is a 128-bit hash in a chunk, and 96 bits of it between
chunks.

Defined results for odd input: null text has no words; a null ``doc_id`` comes
after all others; rows that repeat a ``doc_id`` are separate documents, in the
order of their texts; texts shorter than a window are kept as they are (words
joined by one space); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words as W
from .sketch import Shape, read_flags, repeated
from .store import chunks_for, shuffle_width, text_bytes

NO_ID = (1 << 63) - 1
BYTES_AT_ONCE = 1 << 20


def chunked(docs: DataFrame, n_chunks: int) -> DataFrame:
    """``chunk, doc, text`` (``doc``: the id, ``NO_ID`` for null)."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    return docs.select(chunk_of(doc, n_chunks).alias("chunk"), doc.alias("doc"), F.coalesce("text", F.lit("")).alias("text"))


def chunk_of(doc, n_chunks: int):
    return F.pmod(F.xxhash64(doc), F.lit(n_chunks)).cast("int")


def in_order(table: pa.Table) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """A chunk's ids, copy numbers (0 unless an id repeats) and texts, by id
    and then text."""
    docs, texts = table["doc"].to_numpy(), W.as_binary(table["text"])
    order = np.argsort(docs, kind="stable")
    docs = docs[order]
    same = np.flatnonzero(docs[1:] == docs[:-1])
    if len(same):
        order = np.array(sorted(order.tolist(), key=lambda i: (table["doc"][i].as_py(), texts[i].as_py())))
    first = np.searchsorted(docs, docs)
    return docs, np.arange(len(docs)) - first, texts.take(pa.array(order))


def hash_all(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two hashes of every word and the first word of each text."""
    one, two, counts = [], [], [np.zeros(1, np.int64)]
    for i, j in W.slices(np.diff(W.raw(texts)[1]), BYTES_AT_ONCE):
        (h1, h2), starts = W.hash_words(texts.slice(i, j - i), lower)
        one.append(h1)
        two.append(h2)
        counts.append(np.diff(starts))
    empty = [np.zeros(0, np.uint64)]
    return np.concatenate(one or empty), np.concatenate(two or empty), np.cumsum(np.concatenate(counts))


def windows(table: pa.Table, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and places (word number in the ordered chunk) of all windows,
    and the first word of each document."""
    _, _, texts = in_order(table)
    h1, h2, starts = hash_all(texts)
    at = W.window_starts(starts, size)
    return W.window_hashes(h1, size)[at], W.window_hashes(h2, size)[at], at, starts


def drop_repeats(docs: DataFrame, size: int = 20) -> DataFrame:
    """``doc_id, text`` (kept words joined by one space), ``n_words``,
    ``n_removed``."""
    spark = docs.sparkSession
    n_bytes = text_bytes(docs)
    n_chunks = chunks_for(spark, n_bytes, 8 << 20)
    shape = Shape.of(n_bytes // 6, shuffle_width(spark))
    chunks = chunked(docs, n_chunks)
    flags = repeated(chunks, lambda table: windows(table, size)[:2], shape)

    def suspects(table: pa.Table, answer: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _SUSPECTS.empty_table()
        ids, copies, _ = in_order(table)
        h1, h2, at, starts = windows(table, size)
        hot = np.flatnonzero(read_flags(answer, shape, h1, h2))
        h1, h2, at = h1[hot], h2[hot], at[hot]
        order = np.lexsort((at, h2, h1))
        new = np.ones(len(order), bool)
        new[1:] = (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1])
        first, again = np.sort(order[new]), np.sort(at[order[~new]])
        doc_at = np.searchsorted(starts, at[first], side="right") - 1
        # later occurrences in the chunk: runs of neighbouring places
        doc_again = np.searchsorted(starts, again, side="right") - 1
        head = np.ones(len(again), bool)
        head[1:] = (np.diff(again) != 1) | (np.diff(doc_again) != 0)
        heads = np.flatnonzero(head)
        run = np.diff(np.append(heads, len(again)))
        again, doc_again = again[heads], doc_again[heads]
        own = W.mix(ids[doc_again].astype(np.uint64), again.astype(np.uint64))
        doc = np.concatenate([doc_at, doc_again])
        place = np.concatenate([at[first], again]) - starts[doc]
        return pa.table(
            [
                np.concatenate([h1[first], own]).view(np.int64),
                (np.concatenate([h2[first], W.mix(own, own)]) >> np.uint64(32)).astype(np.uint32).view(np.int32),
                ids[doc],
                copies[doc].astype(np.int32),
                place.astype(np.int32),
                np.concatenate([np.zeros(len(first)), run]).astype(np.int32),
            ],
            schema=_SUSPECTS,
        )

    found = chunks.groupBy("chunk").cogroup(flags.groupBy("chunk")).applyInArrow(
        suspects, "h1 long, h2 int, doc long, copy int, at int, run int"
    )
    order = Window.partitionBy("h1", "h2").orderBy("doc", "copy", "at")
    later = found.withColumn("nth", F.row_number().over(order)).filter("run > 0 or nth > 1")
    gone = later.select(chunk_of(F.col("doc"), n_chunks).alias("chunk"), "doc", "copy", "at", F.greatest("run", F.lit(1)).alias("run"))

    def cut(table: pa.Table, gone: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _KEPT.empty_table()
        ids, _, texts = in_order(table)
        kept, bounds, starts = W._cut(texts, False)
        row = np.searchsorted(ids, gone["doc"].to_numpy()) + gone["copy"].to_numpy()
        begin = starts[row] + gone["at"].to_numpy()
        change = np.zeros(len(bounds) + 1, np.int64)
        np.add.at(change, begin, 1)
        np.add.at(change, begin + gone["run"].to_numpy() + size - 1, -1)
        keep = np.cumsum(change)[: len(bounds) - 1] == 0
        kept_words = np.concatenate([[0], np.cumsum(keep)])
        per_doc = np.diff(kept_words[starts])
        return pa.table(
            [
                pa.array(ids),
                join_words(kept, bounds, keep, per_doc),
                pa.array(np.diff(starts)),
                pa.array(np.diff(starts) - per_doc),
            ],
            schema=_KEPT,
        )

    out = chunks.groupBy("chunk").cogroup(gone.groupBy("chunk")).applyInArrow(cut, "doc long, text string, n_words long, n_removed long")
    return out.select(F.nullif("doc", F.lit(NO_ID)).alias("doc_id"), "text", "n_words", "n_removed")


def join_words(kept: np.ndarray, bounds: np.ndarray, keep: np.ndarray, per_doc: np.ndarray) -> pa.Array:
    """The kept words of each document joined by one space."""
    size = np.diff(bounds)
    body = kept[np.repeat(keep, size)]
    size = size[keep]
    last = np.zeros(len(size), np.int64)  # the last word of a document has no space after it
    last[np.cumsum(per_doc)[per_doc > 0] - 1] = 1
    spaces = 1 - last
    before = np.concatenate([[0], np.cumsum(spaces)])
    out = np.full(len(body) + int(spaces.sum()), 32, np.uint8)
    out[np.arange(len(body)) + np.repeat(before[:-1], size)] = body
    word_end = np.concatenate([[0], np.cumsum(size + spaces)])
    offsets = word_end[np.concatenate([[0], np.cumsum(per_doc)])]
    flat = pa.LargeStringArray.from_buffers(len(per_doc), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out))
    return flat.cast(pa.string())


_SUSPECTS = pa.schema(
    [("h1", pa.int64()), ("h2", pa.int32()), ("doc", pa.int64()), ("copy", pa.int32()), ("at", pa.int32()), ("run", pa.int32())]
)
_KEPT = pa.schema([("doc", pa.int64()), ("text", pa.string()), ("n_words", pa.int64()), ("n_removed", pa.int64())])
