"""N-gram Jaccard join by vertical partitioning.

A document's set is its distinct word shingles. The global order of the
shingles (by hash) is cut into fragments; a document is cut into one segment
per fragment, partial overlaps of a candidate pair are counted per fragment
and summed.

What keeps it near-linear:

* a count-min prefilter (``sketch``) finds shingles that occur in one document
  only; a document with over a fifth of such shingles cannot link with any;
* documents with equal sets collapse to one representative, first within a
  chunk, then everywhere;
* a fragment holds all occurrences of its shingles, so it counts document
  frequencies exactly and drops shingles of one representative;
* a pair must share one of its rarest shingles (prefix filter), early enough
  that the rest of both sets still holds the overlap asked for (positions);
* in a bucket (representatives with one rare shingle) every member is first
  compared with the most central one only. Members of the component that this
  makes need no further comparison with each other; pairs across components
  that pass the filters are then all compared. No link between components is
  lost, and a group of near copies costs as many pairs as it has members.

Identity of shingles is a 128-bit hash, within fragments a 64-bit one.

Defined results for odd input: null and blank texts have an empty set and link
with nothing; a text of fewer words than a shingle has one shingle, all of it;
a null ``doc_id`` sorts last and gives a null component id if it is alone;
rows that repeat a ``doc_id`` are separate documents; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .components import components
from .sketch import Shape, read_flags, repeated
from .store import chunks_for, shuffle_width, stored, text_bytes
from .substrings import NO_ID, chunked, hash_all, in_order

VERTICAL = 4
FRAGMENTS = 64  # at least, and as many as keep a fragment in memory
FRAGMENT_TOKENS = 4 << 20


def shingles(table: pa.Table, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each document of a chunk, in chunk order: two
    hashes each, and the first one of each document."""
    _, _, texts = in_order(table)
    h1, h2, starts = hash_all(texts, lower=True)
    counts = np.diff(starts)
    at = W.window_starts(starts, size)
    # the whole of shorter texts: their numbers, by number of words
    short = [(n, np.flatnonzero(counts == n)) for n in range(1, size)]
    short = [(n, docs) for n, docs in short if len(docs)]

    def runs(h: np.ndarray) -> np.ndarray:
        whole = [W.mix(W.window_hashes(h, n)[starts[docs]], np.full(len(docs), n, np.uint64)) for n, docs in short]
        windows = W.window_hashes(h, size)[at]
        return np.concatenate([windows, *whole]) if whole else windows

    # a chunk's arrays are large: none is kept longer than needed
    one = runs(h1)
    del h1
    two = runs(h2)
    del h2
    doc = np.searchsorted(starts, at, side="right") - 1
    doc = np.concatenate([doc, *(docs for _, docs in short)]) if short else doc
    del at
    order = np.lexsort((two, one, doc)) if len(counts) >> 16 else _order(doc, one)
    one = one[order]
    two = two[order]
    doc = doc[order]
    del order
    new = np.ones(len(one), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (one[1:] != one[:-1]) | (two[1:] != two[:-1])
    one = one[new]
    two = two[new]
    return one, two, np.searchsorted(doc[new], np.arange(len(counts) + 1))


def _order(doc: np.ndarray, h: np.ndarray) -> np.ndarray:
    """By document, then hash: one sort on 16 + 48 bits, and a full one in the
    rare case that 48 bits of different hashes agree."""
    key = doc.astype(np.uint64)
    key <<= np.uint64(48)
    key |= h >> np.uint64(16)
    order = np.argsort(key)
    key = key[order]
    tie = np.flatnonzero(key[1:] == key[:-1])
    if (h[order[tie + 1]] != h[order[tie]]).any():
        return np.lexsort((h, doc))
    return order


def _sum_by(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    run = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values, dtype=values.dtype)])
    return run[starts[1:]] - run[starts[:-1]]


def _digests(docs: DataFrame, size: int, similarity: Fraction) -> DataFrame:
    """``doc, node, n, d1, d2, tokens`` per document: set size, set digest,
    and the possibly shared shingles of the first document of a chunk with a
    set that can link at all."""
    spark = docs.sparkSession
    n_bytes = text_bytes(docs)
    chunks = chunked(docs, chunks_for(spark, n_bytes, 8 << 20))
    shape = Shape.of(n_bytes // 6, shuffle_width(spark))
    flags = repeated(chunks, lambda table: shingles(table, size)[:2], shape)
    top, bottom = similarity.numerator, similarity.denominator

    def digest(table: pa.Table, answer: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _DIGEST.empty_table()
        ids, copies, _ = in_order(table)
        one, two, starts = shingles(table, size)
        hot = read_flags(answer, shape, one, two)
        n = np.diff(starts)
        shared = _sum_by(hot.astype(np.int64), starts)
        d1 = _sum_by(W.mix(one, two), starts)
        d2 = _sum_by(W.mix(two, one), starts)
        extra = np.uint64(1 << 62) | (W.mix(ids.astype(np.uint64), copies.astype(np.uint64)) >> np.uint64(3))
        node = np.where(copies == 0, ids, extra.astype(np.int64))
        able = (n > 0) & (bottom * shared >= top * n)
        seen, tokens = set(), []
        for i in range(len(ids)):
            key = (int(d1[i]), int(d2[i]), int(n[i]))
            if not able[i] or key in seen:
                tokens.append(None)
                continue
            seen.add(key)
            part = slice(starts[i], starts[i + 1])
            tokens.append(one[part][hot[part]].tobytes())
        return pa.table([ids, node, n, d1.view(np.int64), d2.view(np.int64), pa.array(tokens, pa.binary())], schema=_DIGEST)

    return chunks.groupBy("chunk").cogroup(flags.groupBy("chunk")).applyInArrow(
        digest, "doc long, node long, n long, d1 long, d2 long, tokens binary"
    )


def _segments(reps: DataFrame, n_fragments: int) -> DataFrame:
    """``node, n, fragment, ids, dfs``: segments of the representatives with
    exact document frequencies; shingles of one representative are gone and
    the others numbered within their fragment."""

    def cut(batches):
        for batch in batches:
            out = {"node": [], "n": [], "fragment": [], "tokens": []}
            nodes, sizes, tokens = batch["node"].to_pylist(), batch["n"].to_pylist(), batch["tokens"].to_pylist()
            for node, n, raw in zip(nodes, sizes, tokens, strict=True):
                h = np.sort(np.frombuffer(raw, np.uint64))
                part = ((h >> np.uint64(32)) * np.uint64(n_fragments) >> np.uint64(32)).astype(np.int64)
                heads = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(h))
                for a, b in zip(heads[:-1], heads[1:], strict=True):
                    out["node"].append(node)
                    out["n"].append(n)
                    out["fragment"].append(int(part[a]))
                    out["tokens"].append(h[a:b].tobytes())
            yield pa.RecordBatch.from_pydict(out, schema=_CUT)
        batch = out = tokens = None
        W.release()

    def number(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x, np.uint64) for x in table["tokens"].to_pylist()]
        owner = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
        _, ids, counts = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        keep = counts[ids] > 1
        owner, ids = owner[keep], ids[keep]
        rows, heads = np.unique(owner, return_index=True)
        offsets = pa.array(np.append(heads, len(ids)).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (ids, counts[ids])]
        some = table.select(["node", "n", "fragment"]).take(pa.array(rows))
        return pa.table([*some.columns, *lists], names=["node", "n", "fragment", "ids", "dfs"])

    rows = reps.select("node", "n", "tokens").mapInArrow(cut, "node long, n long, fragment int, tokens binary")
    return rows.groupBy("fragment").applyInArrow(number, "node long, n long, fragment int, ids array<int>, dfs array<int>")


def _fits(similarity: Fraction, rest_a: str, n_a: str, rest_b: str, n_b: str) -> Column:
    """Whether a common shingle can be the first one, in the global order, of
    a pair that links: what is left of both sets from there on (``rest``)
    bounds the overlap, and that must be s / (1 + s) * (n_a + n_b). Each
    linked pair passes at its first common shingle."""
    top, bottom = similarity.numerator, similarity.denominator
    return F.least(F.col(rest_a), F.col(rest_b)) * (top + bottom) >= (F.col(n_a) + F.col(n_b)) * top


def _linked(pairs: DataFrame, sets: DataFrame, similarity: Fraction) -> DataFrame:
    """The pairs ``a, b`` that reach the similarity: partial overlaps per
    vertical fragment, summed per pair."""
    left = sets.select(F.col("node").alias("b"), "part", F.col("keys").alias("keys_b"))
    right = sets.select(F.col("node").alias("a"), "part", F.col("keys").alias("keys_a"))
    partial = (
        pairs.join(left, "b")
        .join(right, ["a", "part"])
        .select("a", "b", "n_a", "n_b", F.size(F.array_intersect("keys_a", "keys_b")).alias("overlap"))
    )
    top, bottom = similarity.numerator, similarity.denominator
    total = partial.groupBy("a", "b", "n_a", "n_b").agg(F.sum("overlap").alias("overlap"))
    return total.filter(F.col("overlap") * (top + bottom) >= (F.col("n_a") + F.col("n_b")) * top).select("a", "b")


def similar_classes(docs: DataFrame, size: int = 5, similarity: Fraction = Fraction(4, 5)) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each document."""
    top, bottom = similarity.numerator, similarity.denominator
    base = stored(_digests(docs, size, similarity), "jaccard-digests")
    # the smallest node that holds tokens, if one does (the first document of
    # a chunk need not be the class's smallest node)
    first = F.min(F.struct(F.col("tokens").isNull().alias("bare"), "node"))["node"]
    classes = stored(base.filter("n > 0").groupBy("d1", "d2", "n").agg(first.alias("rep")), "jaccard-classes")
    reps = base.filter("tokens is not null").join(classes.select(F.col("rep").alias("node")), "node", "left_semi")
    n_tokens = base.agg(F.sum(F.octet_length("tokens") / 8).alias("n")).first()["n"] or 0
    fragments = max(FRAGMENTS, math.ceil(n_tokens / FRAGMENT_TOKENS))
    segments = stored(_segments(reps, fragments), "jaccard-segments")

    pairs_of = F.transform(F.arrays_zip("dfs", "ids"), lambda x: F.struct(x["dfs"].alias("df"), F.col("fragment"), x["ids"].alias("id")))
    whole = segments.select("node", "n", pairs_of.alias("part")).groupBy("node", "n").agg(F.flatten(F.collect_list("part")).alias("all"))
    whole = whole.withColumn("shared", F.size("all")).filter(F.col("shared") * bottom >= F.col("n") * top)
    able = stored(whole.withColumn("all", F.sort_array("all")), "jaccard-sets")

    # vertical fragments of the sets, for counting
    key = lambda x: F.shiftleft(x["fragment"].cast("long"), 32) + x["id"]
    parts = [
        F.struct(
            F.lit(v).alias("part"),
            F.transform(_of_part(v), key).alias("keys"),
        )
        for v in range(VERTICAL)
    ]
    sets = able.select("node", F.explode(F.array(*parts)).alias("p")).select("node", "p.part", "p.keys").filter(F.size("keys") > 0)

    # rarest first; the shingles of one document come before all of these
    reach = F.col("n") - F.ceil(F.col("n") * top / bottom) + 1 - (F.col("n") - F.col("shared"))
    central = F.struct(
        F.col("shared") / F.col("n"), F.aggregate("all", F.lit(0.0), lambda a, x: a + x["df"]) / F.col("n"), -F.col("node")
    )
    entries = stored(
        able.withColumn("rank", central)
        .select("node", "n", "shared", "rank", F.posexplode(F.slice("all", F.lit(1), reach.cast("int"))).alias("at", "x"))
        .select("node", "n", (F.col("shared") - F.col("at")).alias("rest"), "rank", "x.fragment", "x.id"),
        "jaccard-prefixes",
    )

    # every member with the most central one of its bucket
    token = ["fragment", "id"]
    hubs = entries.groupBy(*token).agg(F.max(F.struct("rank", "node", "n", "rest")).alias("h"), F.count("*").alias("c")).filter("c > 1")
    near = (
        entries.join(hubs, token)
        .select(F.col("h.node").alias("a"), F.col("h.n").alias("n_a"), F.col("h.rest").alias("r_a"), F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("rest").alias("r_b"))
        .filter((F.col("a") != F.col("b")) & _fits(similarity, "r_a", "n_a", "r_b", "n_b"))
    )
    tested = stored(near.select("a", "b", "n_a", "n_b").distinct(), "jaccard-near")
    links = stored(_linked(tested, sets, similarity), "jaccard-links")
    labels = components(links)

    # then all pairs across components that pass the filters
    across = stored(_across(entries, labels, tested, similarity), "jaccard-across")
    more = stored(_linked(across, sets, similarity), "jaccard-more")
    labels = components(links.unionByName(more)).withColumnRenamed("node", "rep")

    member = base.join(classes.select("d1", "d2", "n", "rep"), ["d1", "d2", "n"], "left").join(labels, "rep", "left")
    group = F.coalesce("label", "rep", "node")
    rows = member.select("doc", "n", group.alias("group"))
    least = rows.groupBy("group").agg(F.min("doc").alias("component"))
    out = rows.join(least, "group")
    return out.select(
        F.nullif("doc", F.lit(NO_ID)).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.nullif("component", F.lit(NO_ID)).alias("component_id"),
    )


def _of_part(v: int) -> Column:
    return F.filter("all", lambda x: x["fragment"] % VERTICAL == v)


def _across(entries: DataFrame, labels: DataFrame, tested: DataFrame, similarity: Fraction) -> DataFrame:
    """Pairs ``a, b, n_a, n_b`` with a common rare shingle, in different
    components, that pass the size filters and were not compared yet."""
    token = ["fragment", "id"]
    top, bottom = similarity.numerator, similarity.denominator
    marked = entries.drop("rank").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    # whoever cannot reach even the shortest partner allowed drops out
    least = marked.groupBy(*token).agg(F.min("n").alias("least"))
    shortest = F.greatest(F.col("least"), F.ceil(F.col("n") * top / bottom))
    fit = marked.join(least, token).filter(F.col("rest") * (top + bottom) >= (F.col("n") + shortest) * top).drop("least")
    # buckets with several components: the largest one's members need
    # comparing with the others only
    sizes = fit.groupBy(*token, "label").agg(F.count("*").alias("c"))
    main = sizes.groupBy(*token).agg(F.max(F.struct("c", "label"))["label"].alias("main"), F.count("*").alias("k")).filter("k > 1")
    open_ = stored(fit.join(main.drop("k"), token), "jaccard-open")
    small = open_.filter("label <> main").select(
        *token, F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("rest").alias("r_a"), F.col("label").alias("l_a")
    )
    every = open_.select(
        *token, F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("rest").alias("r_b"), F.col("label").alias("l_b"), "main"
    )
    both = small.join(every, token).filter(
        (F.col("l_a") != F.col("l_b"))
        & ((F.col("l_b") == F.col("main")) | (F.col("a") < F.col("b")))
        & _fits(similarity, "r_a", "n_a", "r_b", "n_b")
    )
    pairs = both.select("a", "b", "n_a", "n_b").distinct()
    known = tested.select("a", "b").unionByName(tested.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return pairs.join(known, ["a", "b"], "left_anti")


_DIGEST = pa.schema(
    [("doc", pa.int64()), ("node", pa.int64()), ("n", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("tokens", pa.binary())]
)
_CUT = pa.schema([("node", pa.int64()), ("n", pa.int64()), ("fragment", pa.int32()), ("tokens", pa.binary())])
