"""Words and word windows of Arrow text arrays, vectorised.

A word is a run of bytes outside space, tab, line feed, vertical tab, form
feed and carriage return; UTF-8 never has these bytes inside a character. The
helpers run inside Arrow batches on executors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True

_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xC2B2AE3D27D4EB4F)


@dataclass
class Words:
    """The words of some texts, one after another.

    ``codes``: index into ``vocab`` per word; ``starts``: first word of each
    text, and the total at the end.
    """

    codes: np.ndarray
    vocab: pa.Array
    starts: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.starts)

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.starts) - 1), self.counts)


def as_binary(texts: pa.Array | pa.ChunkedArray) -> pa.Array:
    """One large-binary array; null texts become empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks() if texts.num_chunks != 1 else texts.chunk(0)
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], texts.type)
    return texts.cast(pa.large_binary()).fill_null(b"")


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a large-binary array and the offsets of its texts."""
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[at[0] : at[-1]], at - at[0]


def _cut(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all words, the offsets of the words in them, and the first
    word of each text (with the total at the end)."""
    body, offsets = raw(texts)
    if lower:
        body = np.where((body >= 65) & (body <= 90), body + np.uint8(32), body)
    solid = ~IS_SPACE[body]
    head = solid.copy()
    head[1:] &= ~solid[:-1]
    cuts = offsets[:-1][np.diff(offsets) > 0]
    head[cuts] = solid[cuts]  # a text's first byte starts a word even after a word
    first = np.flatnonzero(head)
    kept = np.ascontiguousarray(body[solid])
    begin = np.flatnonzero(head[solid])
    bounds = np.append(begin, len(kept)).astype(np.int64)
    return kept, bounds, np.searchsorted(first, offsets)


def split_words(texts: pa.Array, lower: bool = False) -> Words:
    """Words of each text; ``lower`` maps A-Z to a-z first."""
    kept, bounds, starts = _cut(texts, lower)
    flat = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(kept)]
    )
    coded = flat.dictionary_encode()
    return Words(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary, starts)


_SEED = np.random.default_rng(20)
_BYTE_VALUES = _SEED.integers(1, 1 << 63, size=(2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASES = (0x5851F42D4C957F2D, 0x2545F4914F6CDD1D)
_POWERS: list[tuple[np.ndarray, np.ndarray]] = []


def _powers(lane: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i up to n."""
    if not _POWERS or len(_POWERS[0][0]) < n:
        size = max(1 << 20, 1 << (n - 1).bit_length())
        _POWERS.clear()
        for base in _BASES:
            pair = []
            for x in (base, pow(base, -1, 1 << 64)):
                run = np.full(size, x, dtype=np.uint64)
                run[0] = 1
                pair.append(np.multiply.accumulate(run))
            _POWERS.append(tuple(pair))
    up, down = _POWERS[lane]
    return up[:n], down


def hash_words(texts: pa.Array, lower: bool = False, lanes: int = 2) -> tuple[list[np.ndarray], np.ndarray]:
    """``lanes`` independent 64-bit hashes of every word, and the first word
    of each text. A hash is a polynomial over the word's bytes, taken for all
    words at once from running sums, then mixed with the length."""
    kept, bounds, starts = _cut(texts, lower)
    begin, size = bounds[:-1], np.diff(bounds).astype(np.uint64)
    out = []
    for lane in range(lanes):
        up, down = _powers(lane, max(1, len(kept)))
        run = np.zeros(len(kept) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_VALUES[lane][kept] * up[: len(kept)], out=run[1:])
        value = (run[bounds[1:]] - run[begin]) * down[begin]
        out.append(mix(value, size))
    return out, starts


def release() -> None:
    """Gives back the memory that Arrow keeps for later: an idle worker would
    hold it beside the stages that follow."""
    pa.default_memory_pool().release_unused()


def slices(lengths: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose lengths add up to about ``most``."""
    total = np.concatenate([[0], np.cumsum(lengths)])
    i = 0
    while i < len(lengths):
        j = max(i + 1, int(np.searchsorted(total, total[i] + most, side="right")) - 1)
        yield i, j
        i = j


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ordered pair (a, b)."""
    x = a * _A
    x ^= b * _B + (a >> np.uint64(29))
    x ^= x >> np.uint64(32)
    x *= _A
    x ^= x >> np.uint64(29)
    return x


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` values, by doubling (log2(size) steps)."""
    if len(h) < size:
        return np.zeros(0, np.uint64)
    out, at, level, width = None, 0, h, 1
    parts = []
    while width <= size:
        if size & width:
            parts.append((width, level))
        if width * 2 <= size:
            level = mix(level[:-width], level[width:])
        width *= 2
    n = len(h) - size + 1
    for width, level in reversed(parts):
        piece = level[at : at + n]
        out = piece if out is None else mix(out, piece)
        at += width
    return out


def window_starts(starts: np.ndarray, size: int) -> np.ndarray:
    """Positions where a window of ``size`` words of one text starts."""
    ends = np.repeat(starts[1:], np.diff(starts))
    return np.flatnonzero(np.arange(len(ends)) + size <= ends)


def order_by_doc(doc: np.ndarray, h: np.ndarray) -> np.ndarray:
    """An order by document, then hash: one sort on 16 + 48 bits, and a full
    one where documents are too many or 48 bits of different hashes agree."""
    if len(doc) and int(doc.max()) >> 16:
        return np.lexsort((h, doc))
    order = np.argsort((doc.astype(np.uint64) << np.uint64(48)) | (h >> np.uint64(16)))
    near = np.diff((doc[order].astype(np.uint64) << np.uint64(48)) | (h[order] >> np.uint64(16))) == 0
    if (h[order][1:][near] != h[order][:-1][near]).any():
        return np.lexsort((h, doc))
    return order


# names for other modules
cut_words = _cut
powers = _powers
BYTE_VALUES = _BYTE_VALUES
