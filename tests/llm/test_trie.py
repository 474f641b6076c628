"""The prefix trie against a plain trie and the registered SQL."""

import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import SF001, words_of
from pyspark.sql import functions as F

from kpipulse.llm import queries as Q
from kpipulse.llm import trie


@given(st.data())
@settings(max_examples=80, deadline=None)
def test_components_add_up(data):
    """Random forests: chains, stars and mixtures."""
    n = data.draw(st.integers(1, 60))
    shape = data.draw(st.sampled_from(["chain", "star", "any"]))
    up = [-1]
    for i in range(1, n):
        pick = {"chain": i - 1, "star": 0, "any": data.draw(st.integers(0, i - 1)) if shape == "any" else 0}[shape]
        up.append(-1 if data.draw(st.integers(0, 19)) == 0 else pick)
    up = np.array(up)
    depth, comp, size = np.zeros(n, int), np.arange(n), np.ones(n, int)
    weights = np.array([[i + 1, (i * 7) % 5] for i in range(n)])
    want = weights.copy()
    for i in range(n):
        if up[i] >= 0:
            depth[i], comp[i] = depth[up[i]] + 1, comp[up[i]]
    for i in reversed(range(n)):
        if up[i] >= 0:
            want[up[i]] += want[i]
            size[up[i]] += size[i]
    assert (trie.split_components([up, comp], depth, size, weights) == want).all()


def _expected(rows):
    """Rows ``conv_id, turn, role, text``: the nodes by the definition."""
    told = lambda r: (r[2] or "", r[3] or "")
    key = lambda r: (r[1] is not None, r[1] or 0, sha256(f"{len(told(r)[0].encode())}:{told(r)[0]}{told(r)[1]}".encode()).hexdigest())
    talks = defaultdict(list)
    for r in sorted((r for r in rows if r[0] is not None), key=key):
        talks[r[0]].append(told(r))
    built = {}
    for c, own in talks.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = talks.get(c - c % 20, [])[:h] + own[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[tuple(built[c][:d])].append(c)
        ends[tuple(built[c])].append(c)
    out, children, leaves, saved = Counter(), Counter(), Counter(), Counter()
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, who in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += children[node] == 0
            saved[node[:d]] += (len(who) - 1) * len(words_of(node[-1][1])) if node else 0
    for node, who in members.items():
        ids = sha256(",".join(map(str, ends[node])).encode()).hexdigest()
        up = members[node[:-1]][0] if node else None
        out[(who[0], len(node), up, len(who), children[node], leaves[node], saved[node], ids)] += 1
    return out


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def _build(spark, rows, **how):
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, depth int, node string")
    head = F.crc32(F.col("conv").cast("string")) % 4
    out = trie.build(frame, F.col("conv") - F.col("conv") % 20, head, 3, **how)
    return Counter(tuple(r[c] for c in COLUMNS) for r in out.collect())


@pytest.mark.parametrize("local_nodes", [5, 1 << 14])
def test_odd_conversations(spark, monkeypatch, local_nodes):
    """Shared openings, equal talks, nulls, ties, repeated rows, absent
    donors, turnless ones and a long one; in large rounds and in one task."""
    monkeypatch.setattr(trie, "IDS_PER_BLOCK", 3)
    rows = []
    for c in range(60):
        n = 1 + c % 5
        rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"turn {t} of {c % 7 if t else c % 2} a b") for t in range(n)]
    rows += [(100 + c, 0, "user", "hello there") for c in range(12)] + [(100 + c, 1, "assistant", "hi") for c in range(0, 12, 2)]
    rows += [(200, None, None, None), (200, None, "user", "x"), (200, 1, "", ""), (200, 1, "b", "a"), (200, 1, "b", "a"), (200, 0, "a", "　 \x0b w")]
    rows += [(None, 0, "user", "lost"), (215, 0, "user", "only"), (237, 0, "user", "no donor"), (238, 0, "u", "no donor")]
    rows += [(301, t, "user", f"w{t} x") for t in range(70)] + [(302, t, "user", f"w{t} x" if t < 40 else "end") for t in range(60)]
    assert _build(spark, rows, local_nodes=local_nodes) == _expected(rows)


def test_no_conversations(spark):
    assert _build(spark, []) == Counter()
    assert _build(spark, [(None, 1, "user", "x")]) == Counter()
    assert _build(spark, [(7, 1, "user", "x y")]) == _expected([(7, 1, "user", "x y")])


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{SF001}/conversations.parquet'")
    want = con.sql(Q.OP13_SQL)
    got = Q.op13_prefix_trie(spark, SF001)
    assert sorted(got.columns) == sorted(want.columns)
    assert Counter(map(tuple, got.select(*want.columns).collect())) == Counter(want.fetchall())
