"""The Merkle manifest against a plain recursion and the registered SQL."""

from collections import Counter, defaultdict
from hashlib import sha256

import duckdb
import pytest
from llm_helpers import SF001
from pyspark.sql import functions as F

from kpipulse.llm import merkle
from kpipulse.llm import queries as Q


def H(text):
    return sha256(text.encode()).hexdigest()


def _tree(nodes):
    """The root and, for each node, the (side, digest) list of its siblings
    (None where it is hashed alone)."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for proof, i in zip(proofs, at):
            j = i ^ 1
            proof.append(("R" if j > i else "L", nodes[j]) if j < len(nodes) else None)
        nodes = [H("".join(nodes[i : i + 2])) for i in range(0, len(nodes), 2)]
        at = [i // 2 for i in at]
    return nodes[0], proofs


def _fold(leaf, proof):
    for step in proof:
        leaf = H(leaf if step is None else leaf + step[1] if step[0] == "R" else step[1] + leaf)
    return leaf


def _expected(rows):
    """Rows ``key, group, leaf, presented`` by the definition."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    tops = {g: _tree([r[2] for r in groups[g]]) for g in names}
    root, above = _tree([tops[g][0] for g in names])
    out = Counter()
    for g, outer in zip(names, above):
        subroot, proofs = tops[g]
        for (key, _, leaf, presented), proof in zip(groups[g], proofs):
            whole = proof + outer
            told = "".join(step[1] for step in whole if step)
            out[(key, g, leaf, subroot, root, told, _fold(presented, whole))] += 1
    return out


def _run(frame, **how):
    cols = ("key", "group", "leaf", "subroot", "root", "siblings", "folded")
    return Counter(tuple(r[c] for c in cols) for r in merkle.prove(frame, **how).collect())


def _frame(spark, rows):
    return spark.createDataFrame(rows, "key long, group string, leaf string, presented string")


@pytest.mark.parametrize("bits", [2, 10])
def test_proofs_by_superblocks(spark, bits):
    """Trees of one leaf to many superblocks, nulls, ties and equal rows;
    every fifth presented leaf is another one."""
    rows = []
    for g, n in ((None, 5), ("", 1), ("a", 2), ("ä", 3), ("=", 17), ("b", 4), ("c", 64), ("d", 33)):
        for i in range(n):
            leaf = H(f"{g}{i}")
            rows.append((i * 7 % 50, g, leaf, H("x") if i % 5 == 4 else leaf))
    rows += [(None, "b", H("n1"), H("n1")), (None, "b", H("n2"), H("n1")), (3, "c", H("tie"), H("tie"))]
    rows += [(9, "c", H("same"), H("same"))] * 3
    got = _run(_frame(spark, rows), bits=bits)
    assert got == _expected(rows)
    assert sum(n for r, n in got.items() if r[6] == r[4]) < len(rows)


def test_one_group_one_leaf_and_none(spark):
    one = [(1, "a", H("x"), H("x"))]
    assert _run(_frame(spark, one)) == Counter({(1, "a", H("x"), H("x"), H("x"), "", H("x")): 1})
    assert merkle.prove(_frame(spark, [])).count() == 0
    rows = [(i, "a", H(str(i)), H(str(i))) for i in range(3000)]
    assert _run(_frame(spark, rows).repartition(7)) == _expected(rows)


def test_hashed_fields(spark):
    row = spark.createDataFrame([(5, None, "é|", "")], "a long, b string, c string, d string")
    assert row.select(merkle.hashed([F.col(x) for x in "abcd"])).first()[0] == H("1:5-3:é|0:")


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF001}/documents.parquet'")
    want = con.sql(Q.OP12_SQL)
    got = Q.op12_merkle_manifest(spark, SF001)
    assert sorted(got.columns) == sorted(want.columns)
    rows = got.select(*want.columns).collect()
    assert Counter(map(tuple, rows)) == Counter(want.fetchall())
    assert {r["verified"] for r in rows} == {True, False}
