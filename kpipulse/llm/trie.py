r"""Conversation prefix trie, rolled up by centroid decomposition.

Conversations are sequences of turns (role, text); each distinct prefix is a
node of a trie, from the empty root. Sums over subtrees come from a centroid
decomposition of the parent-edge forest: a component is split at its centroid
(the lowest node whose subtree holds more than half of the component), the
component's total below the centroid is aggregated, and added along the path
from the centroid to the component's top, so that the parts can be rolled up
apart. Parts have at most half of the nodes: the rounds are logarithmic in the
number of nodes, however deep or wide the trie is. Components of at most
``LOCAL_NODES`` nodes are finished many at a time in one task each.

The path needs no walk: with the subtree sizes inside a component, the nodes
on it are those that hold more than half. Sizes come first, from the members:
a node that has conversation m as its smallest member lies on m's own path, so
a subtree's size is the sum, over the members of its top, of the nodes on
their paths from there on that are theirs. Whether a node lies below the
centroid, and in which part, is read off its smallest member's path at the
centroid's depth.

Texts are hashed once and never shuffled. A node is named by its depth and the
running sums of four hashes of (depth, turn): a prefix of a conversation of any
length, in a sort over the cluster. Ids that end in one node are joined in
blocks, and only hashed in one task (the digest is one sequence).

Defined results for odd input: null role or text is empty; null turns come
first, equal turns are ordered by a digest of role and text; rows with a null
``conv_id`` belong to no conversation and are left out; repeated rows are
turns of their own; an empty table has no nodes; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranks import ranked
from .store import shuffle_width, stored

WORD = r"[^\x20\x09-\x0D]++"
LANES = 4
LOCAL_NODES = 1 << 14
IDS_PER_BLOCK = 4096
SUMS = tuple(f"lane{k}" for k in range(LANES))


def turns_of(talks: DataFrame) -> DataFrame:
    """``conv, place, total, digest, words`` of every turn, in order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = talks.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"),
        "turn",
        F.sha2(told, 256).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    return stored(ranked(stored(turns, "trie-turns"), "conv", [F.col("turn").asc_nulls_first(), F.col("digest")], "trie-order").drop("turn"), "trie-places")


def rebuilt(turns: DataFrame, donor: Column, head: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first ``head`` turns are taken from conversation
    ``donor`` (columns over ``conv``; heads of at most ``most`` turns).

    Returns all conversations, ``conv, given`` (turns taken), and their turns,
    ``conv, depth`` (from 1), ``digest, words``."""
    convs = turns.filter("place = 0").select("conv", "total", donor.alias("donor"), head.cast("long").alias("head"))
    heads = turns.filter(F.col("place") < most).select(F.col("conv").alias("donor"), "place", "digest", "words")
    sizes = convs.select(F.col("conv").alias("donor"), F.col("total").alias("there"))
    given = F.least(F.col("head"), F.coalesce("there", F.lit(0).cast("long")))
    known = stored(convs.join(sizes, "donor", "left").select("conv", "donor", "head", given.alias("given")), "trie-convs")
    taken = known.join(heads, "donor").filter(F.col("place") < F.col("head")).select("conv", (F.col("place") + 1).alias("depth"), "digest", "words")
    own = turns.join(known, "conv").filter(F.col("place") >= F.col("head"))
    own = own.select("conv", (F.col("place") - F.col("head") + F.col("given") + 1).alias("depth"), "digest", "words")
    return known.select("conv", "given"), taken.unionByName(own)


def _name(depth: Column, lanes: list[Column]) -> Column:
    return F.md5(F.concat_ws(",", depth, *lanes))


def paths_of(turns: DataFrame) -> DataFrame:
    """``conv, depth, length, node, up, words``: the node of every prefix and
    the one above it."""
    lane = lambda k: F.shiftrightunsigned(F.xxhash64(F.lit(k), "depth", "digest"), 32)
    # the hashes, each twice: a running sum and the turn's own
    each = turns.select("conv", "depth", "words", *[lane(k).alias(c) for k, c in enumerate(SUMS)]).withColumns({f"own_{c}": F.col(c) for c in SUMS})
    sums = ranked(stored(each, "trie-lanes"), "conv", [F.col("depth")], "trie-sums", SUMS)
    node = _name(F.col("depth"), [F.col(c) for c in SUMS])
    up = _name(F.col("depth") - 1, [F.col(c) - F.col(f"own_{c}") for c in SUMS])
    return stored(sums.select("conv", "depth", F.col("total").alias("length"), node.alias("node"), up.alias("up"), "words"), "trie-paths")


def nodes_of(convs: DataFrame, paths: DataFrame) -> DataFrame:
    """``node, up, depth, conv_id, n_convs, words, size`` of every node, the
    root too: its smallest member, members, words of its last turn and nodes
    in its subtree."""
    firsts = stored(
        paths.groupBy("node").agg(
            F.min("up").alias("up"),
            F.min("depth").alias("depth"),
            F.min("conv").alias("conv_id"),
            F.count("*").alias("n_convs"),
            F.min("words").alias("words"),
        ),
        "trie-firsts",
    )
    own = firsts.groupBy(F.col("conv_id").alias("conv")).agg(F.min("depth").alias("own_from"))
    theirs = F.greatest(F.col("length") - F.greatest("own_from", "depth") + 1, F.lit(0))
    sizes = paths.join(own, "conv").groupBy("node").agg(F.sum(theirs).alias("size"))
    root = convs.agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    top = root.select(
        _name(F.lit(0).cast("long"), [F.lit(0).cast("long")] * LANES).alias("node"),
        F.lit(None).cast("string").alias("up"),
        F.lit(0).cast("long").alias("depth"),
        "conv_id",
        "n_convs",
        F.lit(0).cast("long").alias("words"),
        (firsts.select(F.count("*")).scalar() + 1).alias("size"),
    )
    return stored(firsts.join(sizes, "node").unionByName(top), "trie-nodes")


def split_components(parts: list[np.ndarray], depth: np.ndarray, size: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Subtree sums of a forest of small components, by centroids.

    ``parts``: the row of each node's parent (-1: top of its component) and the
    row of its component's top; ``weights``: one column per sum."""
    parent, comp = parts[0], parts[1].copy()
    size, total = size.copy(), np.zeros_like(weights)
    live = np.argsort(depth, kind="stable")
    while len(live):
        whole = size[comp[live]]
        heavy = live[2 * size[live] > whole]
        centroid = np.full(len(comp), -1)
        down = heavy[np.argsort(-size[heavy], kind="stable")]
        centroid[comp[down]] = down  # the last one written is the smallest
        mine = centroid[comp[live]]
        # labels go down level by level: a child of the centroid starts a part
        part = np.full(len(comp), -1)
        cuts = np.append(np.flatnonzero(np.diff(depth[live], prepend=-1)), len(live))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            at, c = live[a:b], mine[a:b]
            above = parent[at]
            inside = above >= 0
            part[at] = np.where(inside & (above == c), at, np.where(inside & (at != c), part[above], -1))
        below = (part[live] >= 0) | (live == mine)
        sums = np.zeros_like(weights)
        np.add.at(sums, mine[below], weights[live[below]])
        centres = np.unique(mine)
        total[centres] += sums[centres]
        along = heavy[heavy != centroid[comp[heavy]]]
        c = centroid[comp[along]]
        total[along] += sums[c]
        size[along] -= size[c]
        moved = live[part[live] >= 0]
        tops = np.unique(part[moved])
        comp[moved] = part[moved]
        parent[tops] = -1
        live = live[live != mine]
    return total


def _local(ready: DataFrame, sums: tuple[str, ...], n_nodes: int, local_nodes: int) -> DataFrame:
    """Totals of components of at most ``local_nodes`` nodes, many in a task."""
    buckets = max(shuffle_width(ready.sparkSession), -(-n_nodes // (4 * local_nodes)))

    def finish(table: pa.Table) -> pa.Table:
        row = {n: i for i, n in enumerate(table["node"].to_pylist())}
        comp = np.array([row[c] for c in table["comp"].to_pylist()])
        above = np.array([row.get(u, -1) for u in table["up"].to_pylist()])
        above[np.arange(len(comp)) == comp] = -1
        weights = np.stack([table[c].to_numpy() for c in sums], axis=1)
        got = split_components([above, comp], table["depth"].to_numpy(), table["size"].to_numpy(), weights)
        out = [pa.array(got[:, k] + table[f"more_{c}"].to_numpy()) for k, c in enumerate(sums)]
        return pa.table([table["node"], *out], names=["node", *sums])

    bucket = F.pmod(F.xxhash64("comp"), F.lit(buckets)).alias("bucket")
    return ready.withColumn("bucket", bucket).groupBy("bucket").applyInArrow(finish, ", ".join(["node string", *[f"{c} long" for c in sums]]))


def roll_up(nodes: DataFrame, steps: DataFrame, sums: tuple[str, ...], local_nodes: int = LOCAL_NODES) -> DataFrame:
    """``node`` and the sum of each of ``sums`` over its subtree.

    ``nodes``: ``node, up, depth, conv_id, size`` and the columns of ``sums``;
    ``steps``: ``conv, depth, node, below``, the nodes along a conversation
    (for a node's ``conv_id``), each with the next one."""
    more = {f"more_{c}": F.lit(0).cast("long") for c in sums}
    top = nodes.filter("up is null").select(F.col("node").alias("comp"))
    n_nodes = nodes.count()
    whole = nodes.select("node", "up", "depth", "conv_id", "size", *sums, top.scalar().alias("comp"))
    state = stored(whole.withColumns(more), "trie-component")
    done, ready = [], []
    while True:
        wholes = stored(state.groupBy("comp").agg(F.max("size").alias("whole")), "trie-wholes")
        large = wholes.filter(F.col("whole") > local_nodes)
        ready.append(state.join(wholes.filter(F.col("whole") <= local_nodes).select("comp"), "comp", "left_semi"))
        if large.isEmpty():
            break
        split = state.join(large, "comp")
        heavy = 2 * F.col("size") > F.col("whole")
        centre = F.min_by(F.struct("node", "depth", "size"), F.when(heavy, F.col("size"))).alias("c")
        centres = stored(split.groupBy("comp").agg(centre), "trie-centres")
        at = split.join(centres.select("comp", F.col("c.node").alias("c_node"), F.col("c.depth").alias("c_depth"), F.col("c.size").alias("c_size")), "comp")
        way = steps.select(F.col("conv").alias("conv_id"), F.col("depth").alias("c_depth"), F.col("node").alias("via"), "below")
        seen = at.join(way, ["conv_id", "c_depth"], "left")
        inside = (F.col("depth") > F.col("c_depth")) & F.coalesce(F.col("via") == F.col("c_node"), F.lit(False))
        is_centre = F.col("node") == F.col("c_node")
        placed = stored(
            seen.select(*at.columns, F.when(inside, F.col("below")).alias("part"), is_centre.alias("centre"), heavy.alias("heavy")), "trie-split"
        )
        under = F.col("centre") | F.col("part").isNotNull()
        totals = stored(placed.filter(under).groupBy("comp").agg(*[F.sum(c).alias(f"sum_{c}") for c in sums]), "trie-totals")
        told = placed.join(totals, "comp")
        done.append(told.filter("centre").select("node", *[(F.col(f"more_{c}") + F.col(f"sum_{c}")).alias(c) for c in sums]))
        along = F.col("heavy") & F.col("part").isNull()
        state = stored(
            told.filter("not centre").select(
                "node",
                "up",
                "depth",
                "conv_id",
                F.when(along, F.col("size") - F.col("c_size")).otherwise(F.col("size")).alias("size"),
                *sums,
                F.coalesce("part", "comp").alias("comp"),
                *[F.when(along, F.col(f"more_{c}") + F.col(f"sum_{c}")).otherwise(F.col(f"more_{c}")).alias(f"more_{c}") for c in sums],
            ),
            "trie-component",
        )
    rest = ready[0]
    for part in ready[1:]:
        rest = rest.unionByName(part)
    out = _local(rest, sums, n_nodes, local_nodes)
    for part in done:
        out = out.unionByName(part)
    return stored(out, "trie-sums")


def ends_of(convs: DataFrame, paths: DataFrame) -> DataFrame:
    """``node, ends_sha256``: the digest of the ascending ids of the
    conversations that end in a node, comma-joined."""
    root = _name(F.lit(0).cast("long"), [F.lit(0).cast("long")] * LANES)
    last = paths.filter("depth = length").select("node", "conv")
    turnless = convs.join(paths.filter("depth = 1").select("conv"), "conv", "left_anti").select(root.alias("node"), "conv")
    placed = ranked(stored(last.unionByName(turnless), "trie-ends"), "node", [F.col("conv")], "trie-ends")
    ids = F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string"))
    block = F.floor(F.col("place") / IDS_PER_BLOCK).alias("block")
    blocks = stored(placed.groupBy("node", block).agg(F.array_join(ids, ",").alias("ids"), F.max("total").alias("total")), "trie-id-blocks")
    one = F.col("total") <= IDS_PER_BLOCK

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, sha256()
        for batch in batches:
            names, texts = [], []
            for name, ids in zip(batch["node"].to_pylist(), batch["ids"].to_pylist(), strict=True):
                if name == node:
                    state.update(b",")
                else:
                    if node is not None:
                        names.append(node)
                        texts.append(state.hexdigest())
                    node, state = name, sha256()
                state.update(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.string())], ["node", "ends_sha256"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([state.hexdigest()])], ["node", "ends_sha256"])

    many = blocks.filter(~one).repartition(shuffle_width(blocks.sparkSession), "node").sortWithinPartitions("node", "block")
    long = many.select("node", "ids").mapInArrow(hashed, "node string, ends_sha256 string")
    return blocks.filter(one).select("node", F.sha2("ids", 256).alias("ends_sha256")).unionByName(long)


def build(talks: DataFrame, donor: Column, head: Column, most: int, local_nodes: int = LOCAL_NODES) -> DataFrame:
    """The trie of the rebuilt conversations, one row per node: ``conv_id,
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256``."""
    convs, turns = rebuilt(turns_of(talks), donor, head, most)
    paths = paths_of(turns)
    nodes = nodes_of(convs, paths)
    children = nodes.filter("up is not null").groupBy(F.col("up").alias("node")).agg(F.count("*").alias("n_children"))
    told = nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    weighed = stored(
        told.withColumns(
            {
                "n_leaves": F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long"),
                "saved_tokens": (F.col("n_convs") - 1) * F.col("words"),
            }
        ),
        "trie-weighed",
    )
    steps = paths.select("conv", (F.col("depth") - 1).alias("depth"), F.col("up").alias("node"), F.col("node").alias("below"))
    sums = roll_up(weighed, steps, ("n_leaves", "saved_tokens"), local_nodes)
    above = weighed.select(F.col("node").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    full = weighed.drop("n_leaves", "saved_tokens").join(above, "up", "left").join(sums, "node").join(ends_of(convs, paths), "node", "left")
    none = F.sha2(F.lit(""), 256)
    return full.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", none).alias("ends_sha256"),
    )
