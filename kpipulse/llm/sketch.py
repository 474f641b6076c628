"""Count-min prefilter over items of text chunks.

Each chunk counts its items in a count-min sketch of ``depth`` rows. A row is
cut into slices, and a chunk sends of each slice only the cells that it
touched (sorted gaps, compressed) with a bit for cells it counted twice or
more: one to two bytes an item and row, however wide the sketch. Slices are
merged apart from each other, and what goes back to a chunk is one bit for
each cell it had sent: whether the merged count is two or more. The minimum
over the rows never underestimates, so an item with a zero bit occurs once in
the whole input; none that repeats is lost.

Width follows the input (``cells_per_item``), the memory of a merge is one
slice (``ITEMS_PER_SLICE`` items), nothing is broadcast or collected.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .words import mix

ITEMS_PER_SLICE = 1 << 21
Items = Callable[[pa.Table], tuple[np.ndarray, np.ndarray]]


@dataclass(frozen=True)
class Shape:
    """A sketch of ``depth`` rows, ``slices`` a row, ``2**bits`` cells a slice."""

    depth: int
    slices: int
    bits: int

    @classmethod
    def of(cls, n_items: int, width: int, depth: int = 2, cells_per_item: int = 8) -> Shape:
        slices = max(1, width, math.ceil(n_items / ITEMS_PER_SLICE))
        bits = math.ceil(math.log2(max(1024, cells_per_item * n_items / slices)))
        return cls(depth, slices, min(bits, 32))

    def cells(self, row: int, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Slice in the upper, cell in the lower 32 bits."""
        g = (h1, h2)[row] if row < 2 else mix(h1, h2 + np.uint64(row))
        part = ((g >> np.uint64(32)) * np.uint64(self.slices)) >> np.uint64(32)
        return (part << np.uint64(32)) | (g & np.uint64((1 << self.bits) - 1))


def pack(cells: np.ndarray) -> bytes:
    """Sorted 32-bit numbers as compressed byte planes of their gaps."""
    gaps = np.diff(cells, prepend=0)
    kind = np.dtype("<u2") if len(gaps) and gaps.max() < 1 << 16 else np.dtype("<u4")
    planes = gaps.astype(kind).view(np.uint8).reshape(-1, kind.itemsize).T.tobytes()
    return bytes([kind.itemsize]) + len(planes).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    width, size = data[0], int.from_bytes(data[1:9], "little")
    planes = np.frombuffer(pa.decompress(data[9:], size, codec="zstd", asbytes=True), dtype=np.uint8)
    gaps = np.ascontiguousarray(planes.reshape(width, -1).T).view(f"<u{width}").ravel()
    return np.cumsum(gaps, dtype=np.int64)


def repeated(chunks: DataFrame, items: Items, shape: Shape) -> DataFrame:
    """``chunk, row, slice, hot``: for each chunk, the bits of its cells.

    ``chunks`` has a column ``chunk``; ``items(table)`` gives the two 64-bit
    hashes of each item of a chunk's rows, the same ones whenever it is run.
    """

    def count(table: pa.Table) -> pa.Table:
        chunk = table["chunk"][0].as_py()
        h1, h2 = items(table)
        out: dict[str, list] = {"chunk": [], "row": [], "slice": [], "cells": [], "twice": []}
        for row in range(shape.depth):
            cells, counts = np.unique(shape.cells(row, h1, h2), return_counts=True)
            part = (cells >> np.uint64(32)).astype(np.int64)
            low = (cells & np.uint64(0xFFFFFFFF)).astype(np.int64)
            cuts = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part))
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                out["chunk"].append(chunk)
                out["row"].append(row)
                out["slice"].append(int(part[a]))
                out["cells"].append(pack(low[a:b]))
                out["twice"].append(np.packbits(counts[a:b] > 1).tobytes())
            del cells, counts, part, low  # before the next row makes its own
        return pa.table(out, schema=_PIECE)

    def merge(table: pa.Table) -> pa.Table:
        pieces = [unpack(x) for x in table["cells"].to_pylist()]
        sizes = [len(x) for x in pieces]
        twice = [np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in zip(table["twice"].to_pylist(), sizes, strict=True)]
        cells, weight = np.concatenate(pieces), np.concatenate(twice) + 1
        order = np.argsort(cells, kind="stable")
        run = np.cumsum(np.diff(cells[order], prepend=-1) != 0) - 1
        hot = np.empty(len(cells), bool)
        hot[order] = (np.bincount(run, weights=weight[order]) > 1)[run]
        bits = [np.packbits(x).tobytes() for x in np.split(hot, np.cumsum(sizes)[:-1])]
        return pa.table([table["chunk"], table["row"], table["slice"], pa.array(bits, pa.binary())], schema=_ANSWER)

    pieces = chunks.groupBy("chunk").applyInArrow(count, "chunk int, row int, slice int, cells binary, twice binary")
    return pieces.groupBy("row", "slice").applyInArrow(merge, "chunk int, row int, slice int, hot binary")


_PIECE = pa.schema([("chunk", pa.int32()), ("row", pa.int32()), ("slice", pa.int32()), ("cells", pa.binary()), ("twice", pa.binary())])
_ANSWER = pa.schema([("chunk", pa.int32()), ("row", pa.int32()), ("slice", pa.int32()), ("hot", pa.binary())])


def read_flags(answer: pa.Table, shape: Shape, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Whether each item of a chunk is estimated to occur twice or more, from
    the chunk's rows of ``repeated``."""
    hot = np.ones(len(h1), bool)
    if not len(h1):
        return hot
    rows, parts = answer["row"].to_numpy(), answer["slice"].to_numpy()
    bits = answer["hot"].to_pylist()
    for row in range(shape.depth):
        cells, place = np.unique(shape.cells(row, h1, h2), return_inverse=True)
        part = cells >> np.uint64(32)
        found, sizes = np.unique(part, return_counts=True)
        mine = np.flatnonzero(rows == row)
        mine = mine[np.argsort(parts[mine])]
        if not np.array_equal(parts[mine], found.astype(parts.dtype)):
            raise ValueError("the chunk differs from the one that was counted")
        flags = np.concatenate([np.unpackbits(np.frombuffer(bits[i], np.uint8), count=n) for i, n in zip(mine, sizes, strict=True)])
        hot &= flags[place].astype(bool)
        del cells, place, part, flags  # before the next row makes its own
    return hot
