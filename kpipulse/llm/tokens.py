"""Token counts: greedy longest-match word pieces in linear time.

The vocabulary is a byte trie with two roots, one for pieces that begin a word
and one for pieces that continue it. Each node has a failure link (where the
match goes on once the pieces it completes are popped) and the number of
pieces popped on that link, both precomputed. Counting the pieces of a word
walks its bytes once; no piece is built. All distinct words of a batch are
walked side by side.

Greedy matching on UTF-8 bytes equals matching on characters: pieces are whole
characters, so a match can only end between characters.

Defined results for odd input: null and blank texts have no words and no
tokens; a word that cannot be covered by pieces counts as one unknown token; a
null ``doc_id`` is kept; rows that repeat a ``doc_id`` are counted apart; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W

BYTES_AT_ONCE = 4 << 20
BEGIN, INSIDE = 0, 1
NONE = -1

_AUTOMATA: dict[str, Automaton] = {}


@dataclass
class Automaton:
    """``edges``: sorted ``node * 256 + byte``; ``targets``: their nodes;
    ``fail``: failure link or NONE; ``popped``: pieces popped on it."""

    edges: np.ndarray
    targets: np.ndarray
    fail: np.ndarray
    popped: np.ndarray

    @classmethod
    def of(cls, begin: Iterable[bytes], inside: Iterable[bytes]) -> Automaton:
        children: list[dict[int, int]] = [{}, {}]
        ends: set[int] = set()
        for root, pieces in ((BEGIN, begin), (INSIDE, inside)):
            for piece in pieces:
                node = root
                for byte in piece:
                    nxt = children[node].get(byte)
                    if nxt is None:
                        nxt = children[node][byte] = len(children)
                        children.append({})
                    node = nxt
                if node != root:
                    ends.add(node)
        fail, popped = [NONE] * len(children), [0] * len(children)
        queue = deque([BEGIN, INSIDE])
        while queue:
            node = queue.popleft()
            for byte, child in children[node].items():
                queue.append(child)
                if child in ends:
                    fail[child], popped[child] = INSIDE, 1
                    continue
                link, count = fail[node], popped[node]
                while link != NONE and byte not in children[link]:
                    count += popped[link]
                    link = fail[link]
                if link != NONE:
                    fail[child], popped[child] = children[link][byte], count
        flat = sorted((node * 256 + byte, child) for node, kids in enumerate(children) for byte, child in kids.items())
        table = np.array(flat, np.int64).reshape(-1, 2)
        return cls(table[:, 0].copy(), table[:, 1].copy(), np.array(fail, np.int64), np.array(popped, np.int64))

    @classmethod
    def from_sentencepiece(cls, path: str) -> Automaton:
        """Pieces with the word mark begin words, the others continue them;
        control, unknown and byte pieces are left out. Cached per process."""
        if path not in _AUTOMATA:
            from sentencepiece import SentencePieceProcessor

            model = SentencePieceProcessor(model_file=path)
            use = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
            pieces = [model.id_to_piece(i) for i in use]
            mark = "▁"
            begin = [p[1:].encode() for p in pieces if p.startswith(mark) and mark not in p[1:]]
            inside = [p.encode() for p in pieces if mark not in p]
            _AUTOMATA[path] = cls.of(begin, inside)
        return _AUTOMATA[path]

    def step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Where a byte leads, or NONE."""
        if not len(self.edges):
            return np.full(len(node), NONE, np.int64)
        key = node * 256 + byte
        at = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
        return np.where(self.edges[at] == key, self.targets[at], NONE)

    def count(self, words: pa.Array) -> np.ndarray:
        """Pieces of each word, or -1 where it cannot be covered."""
        body, offsets = W.raw(words)
        size = np.diff(offsets)
        order = np.argsort(-size, kind="stable")
        begin, size = offsets[:-1][order], size[order]
        node, total = np.full(len(order), BEGIN, np.int64), np.zeros(len(order), np.int64)
        live = np.ones(len(order), bool)
        for at in range(int(size[0]) if len(size) else 0):
            now = np.flatnonzero(live[: np.searchsorted(-size, -at, side="left")])
            if not len(now):
                break
            byte = body[begin[now] + at].astype(np.int64)
            while len(now):
                to = self.step(node[now], byte)
                moved = to != NONE
                node[now[moved]] = to[moved]
                now, byte = now[~moved], byte[~moved]
                total[now] += self.popped[node[now]]
                node[now] = self.fail[node[now]]
                lost = node[now] == NONE
                live[now[lost]] = False
                now, byte = now[~lost], byte[~lost]
        now = np.flatnonzero(live & (node != INSIDE))
        while len(now):
            total[now] += self.popped[node[now]]
            node[now] = self.fail[node[now]]
            live[now[node[now] == NONE]] = False
            now = now[(node[now] != NONE) & (node[now] != INSIDE)]
        total[~live] = -1
        out = np.empty(len(order), np.int64)
        out[order] = total
        return out


def count_tokens(docs: DataFrame, model: str) -> DataFrame:
    """``doc_id, n_words, n_tokens, n_unknown`` for every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton.from_sentencepiece(model)
        for batch in batches:
            texts = W.as_binary(batch["text"])
            for i, j in W.slices(np.diff(W.raw(texts)[1]), BYTES_AT_ONCE):
                words = W.split_words(texts.slice(i, j - i))
                each = automaton.count(words.vocab)[words.codes]
                sums = lambda x, s=words.starts: np.diff(np.concatenate([[0], np.cumsum(x)])[s])
                columns = [pa.array(words.counts), pa.array(sums(np.abs(each))), pa.array(sums(each < 0))]
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(i, j - i), *columns], ["doc_id", "n_words", "n_tokens", "n_unknown"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_words long, n_tokens long, n_unknown long"
    )
