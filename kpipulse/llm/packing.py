"""Sequence packing: shortest-pack-first over the length histogram.

Documents become token ids (one end id after each) and are cut into pieces of
at most ``max_len`` ids. Only the histogram of piece lengths, at most
``max_len`` numbers, is planned on the driver: lengths are placed longest
first, each into the pack patterns with the most room, and what is kept is how
many packs follow each pattern. Spark then ranks the pieces of each length and
joins the pattern slots back by rank.

Ranks need no single task per length: pieces are numbered within (length,
bucket), and the buckets of a length get offsets by a running sum of counts.

Tokenizing: the words between ASCII white space are encoded apart, each
distinct one once per batch and worker (bounded cache), because the
tokenizer's normaliser and pre-tokenizer never look across white space. The
cache is arrays of fixed width sorted by a hash of the word, which take less
memory than a dict of as many words; only words longer than ``KEY_BYTES``, and
those whose hash another word has, are in a dict. New words of letters go
through the tokenizer many at a time, as one text; where each word's ids end
shows in the end-of-word suffix of its last one.

Defined results for odd input: null or empty text is a document of the end id
only; a null ``doc_id`` is kept; rows that repeat a ``doc_id`` are packed
separately; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words as W
from .store import stored

BYTES_AT_ONCE = 1 << 20
CACHED_WORDS = 1_000_000
CACHED_LONG_BYTES = 16 << 20
KEY_BYTES = 15
LEARNT_AT_ONCE = 1024
MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")
RANK_BUCKETS = 256

_ENCODERS: dict[str, WordEncoder] = {}


class WordEncoder:
    """Ids of white-space separated words, with a cache of at most
    ``CACHED_WORDS`` words (one batch's, if it has more).

    ``ids`` and ``ends`` hold the ids of the cached words by slot; ``hashes``
    (sorted), ``keys`` and ``slots`` find the words of at most ``KEY_BYTES``
    bytes, ``others`` the rest."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.letters, self.closing = self._letters_only(Tokenizer.from_file(path))
        self._reset(0)

    def _reset(self, words: int) -> None:
        """An empty cache with room for a batch of ``words``."""
        self.hashes, self.keys, self.slots = np.zeros(0, np.uint64), np.zeros((0, 2), np.uint64), np.zeros(0, np.int32)
        self.others: dict[bytes, int] = {}
        self.other_bytes = self.n = 0
        self.ids = np.zeros(1 << 20, np.uint32)
        self.ends = np.zeros(max(words, CACHED_WORDS) + 1, np.int64)

    @classmethod
    def get(cls, path: str) -> WordEncoder:
        if path not in _ENCODERS:
            _ENCODERS[path] = cls(path)
        return _ENCODERS[path]

    @staticmethod
    def _letters_only(tokenizer):
        """The same tokenizer for words of letters in composed form, or of
        marks, between single spaces: without the steps that change nothing in
        these (normal form, white space, the split into letters and others).
        And which ids end a word. Nones if it isn't built of these steps, or
        some word's last id may not show its end."""
        from tokenizers.pre_tokenizers import ByteLevel

        steps = json.loads(tokenizer.to_str())
        norm, pre = steps["normalizer"] or {}, steps["pre_tokenizer"] or {}
        names = [x["type"] for x in norm.get("normalizers", [])], [x["type"] for x in pre.get("pretokenizers", [])]
        if names != (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]):
            return None, None
        vocab, suffix = tokenizer.get_vocab(), steps["model"].get("end_of_word_suffix")
        if not suffix or any(c + suffix not in vocab for c in ByteLevel.alphabet()):
            return None, None
        # bytes become characters for the whole text at once, the space a letter that no other byte becomes
        steps["normalizer"]["normalizers"] = [norm["normalizers"][2], {"type": "ByteLevel"}]
        steps["pre_tokenizer"] = {"type": "CharDelimiterSplit", "delimiter": ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(" ")[0][0]}
        closing = np.zeros(max(vocab.values()) + 1, bool)
        closing[[i for token, i in vocab.items() if token.endswith(suffix)]] = True
        return type(tokenizer).from_str(json.dumps(steps)), closing

    def _plain(self, cores: list[str]) -> np.ndarray:
        """Which words are letters that stay so in lower case, and composed."""
        if self.letters is None:
            return np.zeros(len(cores), bool)
        plain = np.fromiter(map(str.isalpha, cores), bool, len(cores))
        beyond = [i for i in np.flatnonzero(plain).tolist() if not cores[i].isascii()]
        kept = lambda text: text.lower().replace(" ", "").isalpha() and unicodedata.is_normalized("NFC", text)
        if beyond and not kept(" ".join([cores[i] for i in beyond])):
            plain[beyond] = [kept(cores[i]) for i in beyond]
        return plain

    def _ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """An order of the words, their ids in it and how many each has:
        letters first, as one text, with the marks at a word's end (which the
        split always cuts off) as a word of their own; then other words in
        full, each apart."""
        cores = [w.rstrip(MARKS) for w in words]
        plain = self._plain(cores)
        short, whole = np.flatnonzero(plain), np.flatnonzero(~plain)
        ids, sizes = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if len(short):
            marked = np.array([len(cores[i]) < len(words[i]) for i in short.tolist()])
            text = " ".join([f"{cores[i]} {words[i][len(cores[i]) :]}" if m else cores[i] for i, m in zip(short.tolist(), marked.tolist(), strict=True)])
            ids = np.array(self.letters.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self.closing[ids]) + 1
            sizes = np.diff(ends[np.cumsum(1 + marked) - 1], prepend=0)
        full = [x.ids for x in self.tokenizer.encode_batch_fast([words[i] for i in whole.tolist()], add_special_tokens=False)]
        flat = np.array([x for one in full for x in one], np.uint32)
        return np.append(short, whole), np.append(ids, flat), np.append(sizes, np.array([len(x) for x in full], np.int64))

    def _learn(self, fresh: list[bytes]) -> np.ndarray:
        """The slots of new words, after putting their ids there."""
        out = np.empty(len(fresh), np.int32)
        for i in range(0, len(fresh), LEARNT_AT_ONCE):
            order, flat, sizes = self._ids([w.decode() for w in fresh[i : i + LEARNT_AT_ONCE]])
            at = self.ends[self.n]
            while at + len(flat) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
            self.ids[at : at + len(flat)] = flat
            self.ends[self.n + 1 : self.n + 1 + len(order)] = at + np.cumsum(sizes)
            out[i + order] = np.arange(self.n, self.n + len(order))
            self.n += len(order)
        return out

    @staticmethod
    def _keys(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which words are short, ordered by hash, their hashes, and their
        keys: the bytes, padded, and the length, so that different words have
        different keys."""
        body, offsets = W.raw(words)
        size = np.diff(offsets)
        short = np.flatnonzero(size <= KEY_BYTES)
        n = size[short]
        key = np.zeros((len(short), KEY_BYTES + 1), np.uint8)
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        key[np.repeat(np.arange(len(short)), n), within] = body[np.repeat(offsets[short], n) + within]
        key[:, KEY_BYTES] = n
        key = key.view(np.uint64)
        hashes = W.mix(key[:, 0], key[:, 1])
        order = np.argsort(hashes)
        return short[order], hashes[order], key[order]

    def _slots(self, words: pa.Array) -> np.ndarray:
        """The slots of distinct words; new ones are learnt."""
        out = np.full(len(words), -1, np.int32)
        short, hashes, keys = self._keys(words)
        at = np.searchsorted(self.hashes, hashes)
        held = np.flatnonzero(at < len(self.hashes))
        held = held[self.hashes[at[held]] == hashes[held]]
        there = (self.keys[at[held]] == keys[held]).all(axis=1)
        out[short[held[there]]] = self.slots[at[held[there]]]
        # a hash is held once: words that share it with another are looked up with the long ones
        new = np.append(True, hashes[1:] != hashes[:-1])[: len(short)]
        twin = ~new
        twin[held[there]] = new[held] = False
        twin[held[~there]] = True
        rest = np.append(np.setdiff1d(np.arange(len(words)), short, assume_unique=True), short[twin])
        texts = words.take(pa.array(rest)).to_pylist()
        out[rest] = [self.others.get(w, -1) for w in texts]
        fresh = np.flatnonzero(out < 0)
        if not len(fresh):
            return out
        out[fresh] = self._learn(words.take(pa.array(fresh)).to_pylist())
        self.hashes = np.insert(self.hashes, at[new], hashes[new])
        self.keys = np.insert(self.keys, at[new], keys[new], axis=0)
        self.slots = np.insert(self.slots, at[new], out[short[new]])
        for w, slot in zip(texts, out[rest].tolist(), strict=True):
            if w not in self.others:
                self.others[w] = slot
                self.other_bytes += len(w)
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and the first id of each text."""
        words = W.split_words(texts)
        if self.n + len(words.vocab) > len(self.ends) - 1 or self.other_bytes > CACHED_LONG_BYTES:
            self._reset(len(words.vocab))
        slot = self._slots(words.vocab)[words.codes]
        begin, size = self.ends[slot], self.ends[slot + 1] - self.ends[slot]
        before = np.concatenate([[0], np.cumsum(size)])
        place = np.arange(before[-1]) + np.repeat(begin - before[:-1], size)
        return self.ids[place], before[words.starts]


def pieces(docs: DataFrame, tokenizer: str, max_len: int, end_id: int, keep_ids: bool) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens`` and, if asked for,
    ``ids`` of every piece."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.get(tokenizer)
        for batch in batches:
            texts = W.as_binary(batch["text"])
            for i, j in W.slices(np.diff(W.raw(texts)[1]), BYTES_AT_ONCE):
                yield from _cut(batch["doc_id"].slice(i, j - i), *encoder.encode(texts.slice(i, j - i)))
        batch = texts = None
        W.release()

    def _cut(ids: pa.Array, tokens: np.ndarray, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        closed = np.insert(tokens, starts[1:], end_id).astype("<u4")
        starts = starts + np.arange(len(starts))
        total = np.diff(starts)
        n = -(-total // max_len)
        doc = np.repeat(np.arange(len(total)), n)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
        at = nth * max_len
        length = np.minimum(max_len, total[doc] - at)
        begin = starts[doc] + at
        view = memoryview(closed).cast("B")
        crc = [zlib.crc32(view[4 * b : 4 * (b + m)]) for b, m in zip(begin.tolist(), length.tolist(), strict=True)]
        out = [ids.take(pa.array(doc)), pa.array(at), pa.array(length), pa.array(crc, pa.int64()), pa.array(total[doc])]
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
        if keep_ids:
            out.append(pa.ListArray.from_arrays(pa.array(np.append(begin, starts[-1]).astype(np.int32)), pa.array(closed.astype(np.int32))))
            names.append("ids")
        yield pa.RecordBatch.from_arrays(out, names)

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * keep_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(encode, schema)


@dataclass
class Pattern:
    """``packs`` sequences that hold ``slots`` (length, how many) and have
    ``room`` left."""

    room: int
    packs: int
    slots: tuple[tuple[int, int], ...]


def plan_patterns(histogram: dict[int, int], max_len: int) -> list[Pattern]:
    """Shortest-pack-first: lengths longest first, each into the packs with
    the most room; new packs only when no pack has enough.

    Bounded by ``max_len`` alone: a length splits at most one pattern per
    step, whatever the counts are.
    """
    by_room: dict[int, list[Pattern]] = {}

    def put(p: Pattern) -> None:
        for other in by_room.setdefault(p.room, []):
            if other.slots == p.slots:
                other.packs += p.packs
                return
        by_room[p.room].append(p)

    def add(p: Pattern, packs: int, length: int, each: int) -> Pattern:
        slots = p.slots
        if slots and slots[-1][0] == length:
            slots = (*slots[:-1], (length, slots[-1][1] + each))
        else:
            slots = (*slots, (length, each))
        return Pattern(p.room - each * length, packs, slots)

    empty = Pattern(max_len, 0, ())
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = max(by_room, default=0)
            if room >= length:
                p = by_room[room].pop()
                if not by_room[room]:
                    del by_room[room]
                take = min(left, p.packs)
                if take < p.packs:
                    put(Pattern(p.room, p.packs - take, p.slots))
                put(add(p, take, length, 1))
                left -= take
            else:
                # new packs: as many as fill up alone, then one for the rest
                each = max_len // length
                packs = left // each
                if packs:
                    put(add(empty, packs, length, each))
                if left % each:
                    put(add(empty, 1, length, left % each))
                left = 0
    return [p for group in by_room.values() for p in group]


@dataclass
class Slots:
    """Pattern slots by (length, first rank): arrays for a sorted lookup."""

    key: np.ndarray
    first: np.ndarray
    each: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray

    RANK_BITS = 48

    @classmethod
    def of(cls, patterns: list[Pattern]) -> Slots:
        rows, sequence = [], 0
        rank: dict[int, int] = {}
        for p in patterns:
            offset = 0
            for length, each in p.slots:
                first = rank.get(length, 0)
                rows.append((length, first, each, sequence, offset))
                rank[length] = first + p.packs * each
                offset += length * each
            sequence += p.packs
        table = np.array(sorted(rows), np.int64).reshape(-1, 5)
        return cls((table[:, 0] << cls.RANK_BITS) + table[:, 1], *table[:, 1:].T)

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the pieces with these ranks."""
        row = np.searchsorted(self.key, (length << self.RANK_BITS) + rank, side="right") - 1
        nth = rank - self.first[row]
        return self.sequence[row] + nth // self.each[row], self.offset[row] + nth % self.each[row] * length


def pack(docs: DataFrame, tokenizer: str, max_len: int = 4096, end_id: int = 2, keep_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset`` and ``ids`` if ``keep_ids``."""
    table = stored(pieces(docs, tokenizer, max_len, end_id, keep_ids), "pack-pieces")
    bucket = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(RANK_BUCKETS))
    table = table.withColumn("bucket", bucket)
    counts = table.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    # at most max_len rows
    histogram = {r["length"]: r["n"] for r in table.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = Slots.of(plan_patterns(histogram, max_len))

    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32")
    ranked = (
        table.withColumn("nth", F.row_number().over(within))
        .join(base, ["length", "bucket"])
        .withColumn("rank", F.col("base") + F.col("nth") - 1)
        .drop("bucket", "nth", "base")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = slots.place(batch["length"].to_numpy(), batch["rank"].to_numpy())
            kept = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays([*batch.select(kept).columns, pa.array(sequence), pa.array(offset)], [*kept, "sequence_id", "offset"])

    schema = ", ".join(f"{c} {kind}" for c, kind in ranked.dtypes if c != "rank") + ", sequence_id bigint, offset bigint"
    return ranked.mapInArrow(place, schema)
