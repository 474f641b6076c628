r"""Merkle manifest of a table: cogrouped subtree exchange.

Each row is a leaf: the SHA-256 of its fields. Leaves of a group ascend by key;
every two consecutive nodes become one (the last run may be one node, hashed
alone) until one is left, the subroot; subroots in order of their group become
the root in the same way.

Leaves are cut into superblocks of ``1 << bits`` consecutive ones. One pass
reduces each superblock to its node; the nodes of all superblocks are again
leaves of a smaller tree, and so on (``BITS`` levels a pass) up to the root.
Then the exchange goes down: the nodes of a superblock and the outer nodes that
they need (the siblings above the superblock's node, one row) are cogrouped by
superblock, and ``applyInPandas`` reduces the superblock again, joins the
siblings inside and above it to proofs and folds each presented leaf to a root.

A task holds one superblock. Places of leaves come from a sort over the
cluster, so a group may hold any share of the rows.

Defined results for odd input: a null group is a group of its own and comes
first; null keys come first in a group; rows with equal keys are ordered by
their leaf; equal rows are separate leaves; an empty table gives no rows;
other columns do not matter unless named as fields.
"""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranks import ranked
from .store import stored

BITS = 10
PROOF = ("subroot", "root", "sides", "siblings")


def hashed(fields: list[Column]) -> Column:
    """Hex digest of the fields: ``-`` for null, else byte count, ``:``, value."""
    text = [f.cast("string") for f in fields]
    each = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]
    return F.sha2(F.concat(*each), 256)


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def reduce_up(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes of each level, the given ones first."""
    out = [nodes]
    for _ in range(levels):
        below = out[-1]
        pairs = [below[i] + below[i + 1] for i in range(0, len(below) - 1, 2)]
        out.append([digest(x) for x in (*pairs, *below[2 * len(pairs) :])])
    return out


def siblings(levels: list[list[str]], place: int) -> tuple[str, str]:
    """Sides and digests of a node's siblings, level by level: ``L`` or ``R``
    and the digest, ``-`` where the node is hashed alone."""
    sides, nodes = [], []
    for nth, level in enumerate(levels[:-1]):
        own = place >> nth
        other = own ^ 1
        if other < len(level):
            sides.append("R" if other > own else "L")
            nodes.append(level[other])
        else:
            sides.append("-")
    return "".join(sides), "".join(nodes)


def fold(leaf: str, sides: str, nodes: str) -> str:
    """The root that a leaf and its proof lead to."""
    at = 0
    for side in sides:
        if side == "-":
            leaf = digest(leaf)
            continue
        other = nodes[at : at + 64]
        at += 64
        leaf = digest(leaf + other if side == "R" else other + leaf)
    return leaf


def _depth(total: int, bits: int) -> int:
    """Levels inside a superblock: all, or those up to the top of a tree that
    has no more."""
    return min(bits, (total - 1).bit_length())


def _blocks(nodes: DataFrame, bits: int) -> DataFrame:
    return nodes.withColumn("block", F.shiftright("place", bits))


def _tops(nodes: DataFrame, bits: int) -> DataFrame:
    """The superblocks' nodes as leaves of the next tree."""

    def top(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("place")
        total = int(part["total"].iloc[0])
        node = reduce_up(part["node"].tolist(), _depth(total, bits))[-1][0]
        return pd.DataFrame([(key[0], key[1], -(-total >> bits), node)], columns=["tree", "place", "total", "node"])

    return _blocks(nodes, bits).select("tree", "block", "place", "total", "node").groupBy("tree", "block").applyInPandas(
        top, "tree string, place long, total long, node string"
    )


def _exchange(nodes: DataFrame, outer: DataFrame, bits: int, finish: bool) -> DataFrame:
    """Nodes of each superblock with their proofs up to the root.

    ``outer``: ``tree, place`` (the superblock), ``subroot, root`` and the
    ``sides, siblings`` above it. With ``finish`` the nodes are leaves: each
    ``presented`` one is folded."""
    kinds = {c: kind for c, kind in nodes.dtypes if c not in ("total", "block")}
    added = dict.fromkeys([*PROOF, "folded"] if finish else PROOF, "string")

    def join(key: tuple, part: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("place")
        up = above.iloc[0]
        if int(part["place"].iloc[0]) & ((1 << bits) - 1):
            raise ValueError("a superblock starts at its first place")
        levels = reduce_up(part["node"].tolist(), _depth(int(part["total"].iloc[0]), bits))
        proofs = [siblings(levels, i) for i in range(len(part))]
        part["subroot"], part["root"] = up["subroot"], up["root"]
        part["sides"] = [a + up["sides"] for a, _ in proofs]
        part["siblings"] = [b + up["siblings"] for _, b in proofs]
        if finish:
            part["folded"] = list(map(fold, part["presented"], part["sides"], part["siblings"]))
        return part[[*kinds, *added]]

    schema = ", ".join(f"{c} {kind}" for c, kind in (kinds | added).items())
    tops = outer.withColumnRenamed("place", "block")
    return _blocks(nodes, bits).groupBy("tree", "block").cogroup(tops.groupBy("tree", "block")).applyInPandas(join, schema)


def _levels(nodes: DataFrame, bits: int) -> list[DataFrame]:
    """The nodes, their superblocks' nodes, and so on up to one per tree."""
    most = nodes.agg(F.max("total")).first()[0] or 0
    out = [nodes]
    while most > 1:
        out.append(stored(_tops(out[-1], bits), "merkle-tops"))
        most = -(-most >> bits)
    return out


def _down(levels: list[DataFrame], outer: DataFrame, bits: int, finish: bool) -> DataFrame:
    """The exchange from the top to the first level; ``outer`` has what is
    above each tree."""
    for nodes in reversed(levels[1:]):
        outer = stored(_exchange(nodes, outer, bits, False).select("tree", "place", *PROOF), "merkle-outer")
    return _exchange(levels[0], outer, bits, finish)


def prove(leaves: DataFrame, bits: int = BITS) -> DataFrame:
    """Proofs of all leaves. ``leaves``: ``key, group, leaf`` and ``presented``
    (the digest that is to be checked against the proof). Adds ``subroot,
    root``, the proof (``sides`` and concatenated ``siblings``) and the
    ``folded`` root of the presented leaf."""
    # a group's name in the trees: null first, then bytewise
    tree = F.coalesce(F.concat(F.lit("="), F.col("group")), F.lit(""))
    table = stored(leaves.select("key", F.col("leaf").alias("node"), "presented", tree.alias("tree")), "merkle-leaves")
    placed = ranked(table, "tree", [F.col("key").asc_nulls_first(), F.col("node")], "merkle-order")
    inner = _levels(stored(placed, "merkle-places"), bits)

    subroots = inner[-1].select(F.col("tree").alias("name"), "node", F.lit("").alias("tree"))
    upper = _levels(stored(ranked(stored(subroots, "merkle-subroots"), "tree", [F.col("name")], "merkle-groups"), "merkle-groups"), bits)
    top = upper[-1].select("tree", "place", F.col("node").alias("subroot"), F.col("node").alias("root"), F.lit("").alias("sides"), F.lit("").alias("siblings"))
    groups = _down(upper, top, bits, False)
    above = groups.select(F.col("name").alias("tree"), F.lit(0).cast("long").alias("place"), F.col("node").alias("subroot"), *PROOF[1:])
    proved = _down(inner, stored(above, "merkle-outer"), bits, True)
    group = F.when(F.col("tree") != "", F.substr(F.col("tree"), F.lit(2)))
    return proved.select("key", group.alias("group"), "place", F.col("node").alias("leaf"), *PROOF, "folded")
