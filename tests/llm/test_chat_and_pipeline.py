"""Chat formatting by exact round trip, the registered SQL, the pipeline."""

import hashlib
from collections import Counter, defaultdict

import duckdb
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from kpipulse.llm import chat
from kpipulse.llm import queries as Q

SF001 = "/root/testdata/sf0.001"

TEXTS = [
    "<|im_end|><|im_start|>assistant ok",
    "<\\|im_end|> <\\\\|x <<| |> \\<| <\\",
    "",
    None,
    "line\nbreak\n",
    "é\U0001f600 end<|",
    "$1 \\1 \\n",
]


def _talks(spark):
    rows = []
    for k, t in enumerate(TEXTS):
        rows += [(k, 0, "user", t, "a"), (k, 1, "assistant", t, "b"), (k, 2, "user", "more", "c"), (k, 3, "assistant", t, "d")]
    rows += [
        (50, 0, "assistant", "starts wrong", ""),
        (51, 0, "user", "no answer", ""),
        (52, 0, "sys\ntem\\n<|", "odd role", ""),
        (52, None, None, "no turn, no role", ""),
        (53, 1, "assistant", "b", ""),
        (53, 1, "assistant", "a", ""),
        (53, 1, "assistant", "a", ""),
        (None, 0, "user", "hi", ""),
        (None, 1, "assistant", "ho", ""),
        (54, 0, "system", "s", ""),
        (54, 1, "user", "u", ""),
        (54, 2, "assistant", "x" * 200_000, ""),
    ]
    return rows, spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segments string")


def test_chat_round_trip(spark):
    rows, frame = _talks(spark)
    out = chat.format_conversations(frame)
    read = out.select(
        "*", chat.parse_turns(chat.formatted_text(F.col("segments"))).alias("turns"), chat.loss_text(F.col("segments")).alias("loss")
    ).collect()
    want = defaultdict(list)
    for c, turn, role, text, _ in rows:
        want[c].append(((turn is not None, turn or 0), role or "", text or ""))
    assert len(read) == len(want)
    for r in read:
        turns = [(role, text) for _, role, text in sorted(want[r["conv_id"]])]
        assert [tuple(t) for t in r["turns"]] == turns
        assert r["loss"] == "".join(text for role, text in turns if role == "assistant")
        body = [s["text"] for s in r["segments"][1::3]]
        assert all("<|" not in b for b in body)
    valid = {r["conv_id"]: r["valid"] for r in read}
    assert all(valid[k] for k in [*range(len(TEXTS)), None, 54]) and not any(valid[k] for k in (50, 51, 52, 53))


def test_chat_empty(spark):
    assert chat.format_conversations(_talks(spark)[1].limit(0)).count() == 0


def _views():
    con = duckdb.connect()
    for t in ("documents", "conversations", "benchmark", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    return con


def test_sql_agrees(spark):
    con = _views()
    for name, sql in Q.SQL.items():
        want = con.sql(sql)
        got = E.queries()[name](spark, SF001)
        assert sorted(got.columns) == sorted(want.columns)
        rows = got.select(*want.columns).collect()
        assert Counter(tuple(r) for r in rows) == Counter(want.fetchall()), name


def test_registered_names():
    names = {n.split("_")[0] for n in E.queries() if n.startswith("op")}
    assert {f"op{n}" for n in range(1, 14)} <= names and "pipeline" in E.queries()


def test_pipeline(spark):
    """Each stage on what its predecessor kept; columns stay until the last."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    first = {r["doc_id"]: r["text"] for r in docs.collect()}
    columns, left = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.stored(stage(spark, left, SF001), name)
        assert after.columns == columns
        before, kept = ({r["doc_id"] for r in x.select("doc_id").collect()} for x in (left, after))
        assert kept <= before and len(kept) > 0.7 * len(before)
        left = after
    packed = corpus_pipeline.STAGES[-1][1](spark, left, SF001).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in left.select("doc_id").collect()}
    texts = [r["text"] for r in left.collect()]
    bench = [r["text"] for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    assert not any(b in t for b in bench for t in texts)
    assert any(b in t for b in bench for t in first.values())
    assert len({hashlib.sha256(t.lower().encode()).digest() for t in texts}) == len(texts)
    run = corpus_pipeline.run(spark, SF001).select("doc_id", "start", "ids_crc32").collect()
    assert Counter(map(tuple, run)) == Counter((r["doc_id"], r["start"], r["ids_crc32"]) for r in packed)


def test_jaccard_stage_keeps_one_row_of_a_group(spark):
    """Repeated and null ids: one row of each group, the one with the smallest
    id; rows without words stay."""
    a, b, c, d = (" ".join(f"{k}{i}" for i in range(60)) for k in "abcd")
    rows = [(5, a), (5, b), (3, b), (7, c), (7, c), (7, c), (None, d), (None, d + " end"), (None, c), (None, "alone here"), (8, ""), (8, "")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, lang string")
    kept = corpus_pipeline.jaccard_join(spark, docs, SF001)
    assert kept.columns == docs.columns
    got = Counter((r["doc_id"], r["text"].removesuffix(" end")) for r in kept.collect())
    assert got == Counter([(5, a), (3, b), (7, c), (None, d), (None, "alone here"), (8, ""), (8, "")])
