r"""Byte-level BPE: overlapping chunk encoding, decoding by joined bytes.

A text is cut into chunks of ``chunk_chars`` characters, each with ``overlap``
more of the next one. Chunks are pre-tokenised in parallel, each from its own
first character, which may lie inside a pre-token. The pattern never looks
behind, so what follows a boundary depends on the text after it alone: at the
first boundary in the overlap that both neighbours see, the later chunk is
synchronised with the earlier one and the cut moves there. Chunks that see no
common boundary (a pre-token longer than the overlap) are joined and looked at
again. Between two cuts lie whole pre-tokens; these pieces are encoded apart and their ids
concatenated. Decoding concatenates the bytes of the ids.

A boundary near a chunk's end counts only where the pattern could not have
read on (``MARGIN`` characters of look-ahead). A text of one chunk needs no
stitching and stays in its task; longer ones are stored as chunks and dealt
over the cluster, so that a very long text is no single task until its ids are
put together in its row.

The pattern runs in ``regex`` whose tables may be newer than the library's:
characters that are not assigned in Python's own tables are asked of the
library itself and replaced by a stand-in of the class that it sees.

Defined results for odd input: null text is encoded as empty (no ids); a null
``doc_id`` is kept; rows that repeat a ``doc_id`` are encoded apart; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import struct
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words as W
from .store import shuffle_width, stored

CHUNK_CHARS = 1 << 15
OVERLAP = 1 << 9
MARGIN = 4
CACHED_PIECES = 100_000
CACHED_CHARS = 32
BYTES_AT_ONCE = 1 << 21


class Encoder:
    """Pre-tokens and ids of texts for one rank file and pattern."""

    def __init__(self, ranks: str, pattern: str):
        import tiktoken

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.library = lambda extra=None: tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=extra or table, special_tokens={})
        self.encoding = self.library()
        self.pieces_of = regex.compile(pattern).findall
        # recent pre-tokens, and those of the time before
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.stand_in: dict[int, str] = {}

    @classmethod
    @cache
    def get(cls, ranks: str, pattern: str) -> Encoder:
        return cls(ranks, pattern)

    def _learn(self, chars: list[str]) -> None:
        """The stand-ins of characters new to Python's tables: whether the
        library takes one as a letter or a number, it shows by not cutting
        between it and a character of that class."""
        ranks = {bytes([i]): i for i in range(256)}
        pairs = [lead + c for c in chars for lead in "a1"]
        for pair in pairs:
            for k in range(2, len(pair.encode()) + 1):
                ranks.setdefault(pair.encode()[:k], len(ranks))
        probe = self.library(ranks)
        whole = {pair for pair in pairs if len(probe.encode_ordinary(pair)) == 1}
        for c in chars:
            self.stand_in[ord(c)] = "ª" if "a" + c in whole else "²" if "1" + c in whole else "§"

    def pieces(self, text: str) -> list[str]:
        """The pre-tokens of a text; joined they are the text."""
        if text.isascii():
            return self.pieces_of(text)
        odd = [c for c in set(text) if c > "Ԁ" and unicodedata.category(c) == "Cn"]
        if not odd:
            return self.pieces_of(text)
        if new := [c for c in odd if ord(c) not in self.stand_in]:
            self._learn(new)
        ends = np.cumsum([len(p) for p in self.pieces_of(text.translate({ord(c): self.stand_in[ord(c)] for c in odd}))])
        return [text[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def boundaries(self, text: str) -> np.ndarray:
        """Where pre-tokens start, and the end of the text."""
        return np.cumsum([0, *map(len, self.pieces(text))])

    def encode(self, text: str, ahead: int = 0) -> bytes:
        """The ids of a run of whole pre-tokens as little-endian unsigned
        32-bit integers; each distinct pre-token is encoded once per run, and
        recent ones of at most ``CACHED_CHARS`` characters are remembered.
        The last ``ahead`` characters belong to what follows the run."""
        pieces = self.pieces(text)
        while ahead > 0:
            ahead -= len(pieces.pop())
        if ahead:
            raise ValueError("the run ends inside a pre-token")
        long = {}
        for p in set(pieces).difference(self.known):
            done = self.older.get(p)
            if done is None:
                ids = self.encoding.encode_ordinary(p)
                done = struct.pack(f"<{len(ids)}I", *ids)
            (self.known if len(p) <= CACHED_CHARS else long)[p] = done
        out = b"".join(map(self.known.__getitem__, pieces)) if not long else b"".join(long.get(p) or self.known[p] for p in pieces)
        if len(self.known) > CACHED_PIECES:
            self.known, self.older = {}, self.known
        return out


def _texts(column: pa.Array) -> Iterator[tuple[int, int, list[str]]]:
    """Slices of a text column of about ``BYTES_AT_ONCE`` bytes, decoded."""
    raw = W.as_binary(column)
    for i, j in W.slices(np.diff(W.raw(raw)[1]), BYTES_AT_ONCE):
        yield i, j, [t.decode("utf-8", "replace") for t in raw.slice(i, j - i).to_pylist()]


def _coded(df: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``df`` with the ``ids`` of ``text``, of which the last ``ahead``
    characters are only looked at."""
    kinds = {n: kind for n, kind in df.dtypes if n not in ("text", "ahead")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.get(ranks, pattern)
        for batch in batches:
            for i, j, texts in _texts(batch["text"]):
                ahead = batch["ahead"].slice(i, j - i).to_pylist()
                done = pa.array(map(encoder.encode, texts, ahead), pa.binary())
                yield pa.RecordBatch.from_arrays([*[batch[n].slice(i, j - i) for n in kinds], done], [*kinds, "ids"])

    return df.mapInArrow(run, ", ".join(f"{n} {kind}" for n, kind in kinds.items()) + ", ids binary")


def _chunks(long: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """``doc_id, row, at, size, last, body`` of the overlapping chunks of each
    text: ``size`` characters of its own and the overlap (``row`` numbers the
    documents; the table is stored)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, _, texts in _texts(batch["text"]):
                for k, text in enumerate(texts, i):
                    starts = list(range(0, max(1, len(text)), chunk))
                    for a in range(0, len(starts), 64):
                        part = starts[a : a + 64]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([batch["doc_id"][k].as_py()] * len(part), pa.int64()),
                                pa.array([batch["row"][k].as_py()] * len(part), pa.int64()),
                                pa.array([s // chunk for s in part], pa.int32()),
                                pa.array([min(chunk, len(text) - s) for s in part], pa.int32()),
                                pa.array([s + chunk >= len(text) for s in part], pa.bool_()),
                                pa.array([text[s : s + chunk + overlap] for s in part], pa.string()),
                            ],
                            ["doc_id", "row", "at", "size", "last", "body"],
                        )

    numbered = long.withColumn("row", F.monotonically_increasing_id())
    return stored(numbered.mapInArrow(cut, "doc_id long, row long, at int, size int, last boolean, body string"), "bpe-chunks")


def _marks(chunks: DataFrame, ranks: str, pattern: str, overlap: int) -> DataFrame:
    """``row, at, met``: the first boundary that a chunk and the one before it
    both see in the overlap, as an offset in the chunk (null: none)."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.get(ranks, pattern)
        for batch in batches:
            head, tail = [], []
            for text, size, last in zip(*(batch[c].to_pylist() for c in ("body", "size", "last")), strict=True):
                ends = encoder.boundaries(text)
                sure = ends[:-1] if last else ends[ends <= len(text) - MARGIN]
                head.append(sure[sure < overlap].tolist())
                tail.append((sure[sure >= size] - size).tolist())
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([batch["row"], batch["at"], pa.array(head, kind), pa.array(tail, kind)], ["row", "at", "head", "tail"])

    # dealt by chunk, so that one long text is work for many tasks
    dealt = chunks.select("row", "at", "body", "size", "last").repartition(shuffle_width(chunks.sparkSession), "row", "at")
    seen = dealt.mapInArrow(look, "row long, at int, head array<int>, tail array<int>")
    along = Window.partitionBy("row").orderBy("at")
    return seen.select("row", "at", F.array_min(F.array_intersect("head", F.lag("tail").over(along))).alias("met"))


def _joined(chunks: DataFrame, marks: DataFrame) -> DataFrame:
    """Each run of chunks without a common boundary as one longer chunk."""
    along = Window.partitionBy("row").orderBy("at")
    first = (F.col("at") == 0) | F.col("met").isNotNull()
    runs = marks.select("row", "at", F.max(F.when(first, F.col("at"))).over(along).alias("to"))
    each = chunks.join(runs, ["row", "at"])
    own = F.struct("at", F.substring(F.col("body"), F.lit(1), F.col("size")).alias("text"))
    ahead = F.max_by(F.expr("substring(body, size + 1)"), "at")
    texts = F.transform(F.array_sort(F.collect_list(own)), lambda x: x["text"])
    return each.groupBy("doc_id", "row", F.col("to").alias("at")).agg(
        F.sum("size").cast("int").alias("size"), F.bool_or("last").alias("last"), F.concat(F.array_join(texts, ""), ahead).alias("body")
    )


def _pieces(chunks: DataFrame, ranks: str, pattern: str, overlap: int) -> DataFrame:
    """``doc_id, row, at, ahead, text``: runs of whole pre-tokens between the
    cuts, each with the ``ahead`` characters that the pattern looks ahead.

    A chunk that is not synchronised with the one before it may see wrong
    boundaries to its end; it is joined to that one and the longer chunk looked
    at again, until all chunks are synchronised (a pre-token over many chunks
    is joined in one round)."""
    while True:
        marks = stored(_marks(chunks, ranks, pattern, overlap), "bpe-marks")
        if marks.filter("at > 0 and met is null").isEmpty():
            break
        chunks = stored(_joined(chunks, marks), "bpe-chunks")
    along = Window.partitionBy("row").orderBy("at")
    cuts = marks.select("row", "at", F.coalesce("met", F.lit(0)).alias("begin"), F.coalesce(F.lead("met").over(along), F.lit(0)).alias("more"))
    size = F.col("size") + F.col("more") - F.col("begin")
    read = F.substring(F.col("body"), F.col("begin") + 1, F.when(F.col("last"), size).otherwise(size + MARGIN))
    pieces = chunks.join(cuts, ["row", "at"]).select("doc_id", "row", "at", size.alias("size"), read.alias("text"))
    return pieces.select("doc_id", "row", "at", (F.length("text") - F.col("size")).alias("ahead"), "text")


def encode(docs: DataFrame, ranks: str, pattern: str, chunk_chars: int = CHUNK_CHARS, overlap: int = OVERLAP) -> DataFrame:
    """``doc_id, ids`` of every document: ids as little-endian unsigned 32-bit
    integers. ``ranks`` is a rank file, ``pattern`` splits before the merges;
    ``overlap`` is at most ``chunk_chars``."""
    if not MARGIN < overlap <= chunk_chars:
        raise ValueError("the overlap is longer than the margin and at most a chunk")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # octets bound the characters, and are known without reading the text
    one = F.octet_length("text") <= chunk_chars
    short = _coded(rows.filter(one).withColumn("ahead", F.lit(0)), ranks, pattern)
    chunks = _chunks(rows.filter(~one), chunk_chars, overlap)
    pieces = _pieces(chunks, ranks, pattern, overlap)
    coded = _coded(pieces, ranks, pattern)
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("at", "ids"))), lambda p: F.hex(p["ids"]))
    long = coded.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.unhex(F.array_join(in_order, "")).alias("ids"))
    return short.unionByName(long.select("doc_id", "ids"))


def decode(coded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``coded`` (``doc_id, ids``) with ``decoded``, the joined bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Encoder.get(ranks, pattern).encoding
        for batch in batches:
            raw = batch["ids"].cast(pa.large_binary())
            for i, j in W.slices(np.diff(W.raw(raw)[1]), BYTES_AT_ONCE):
                part = batch.slice(i, j - i)
                texts = [table.decode_bytes(np.frombuffer(x, "<u4").tolist()) for x in part["ids"].to_pylist()]
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["ids"], pa.array(texts, pa.binary())], ["doc_id", "ids", "decoded"])

    return coded.mapInArrow(run, "doc_id long, ids binary, decoded binary")
