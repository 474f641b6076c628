"""One query per operator over its whole table, and the DuckDB SQL where SQL
can express it. Each query derives its digest columns from the operator's
real output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from . import packing

    return packing.pack(_docs(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import pii

    found = pii.extract(_docs(spark, sf_dir))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(pii.span_text(F.col("base")), 256).alias("base_sha256"),
        pii.span_text(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size("base")).cast("long").alias("n_added"),
        F.size("spans").cast("long").alias("n_found"),
    )


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from . import tokens

    return tokens.count_tokens(_docs(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import lines

    out = lines.drop_template_lines(_docs(spark, sf_dir))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("text_sha256"))


OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL
), raw AS (
  SELECT doc_id, unnest(ls) AS l, unnest(range(len(ls))) AS ln FROM d
), w AS (
  SELECT doc_id, ln, list_filter(regexp_split_to_array(
           regexp_replace(l, '[^ \t\x0B\f\r]*[0-9][^ \t\x0B\f\r]*', '<*>', 'g'), '[ \t\x0B\f\r]+'), lambda x: x <> '') AS words
  FROM raw
), p AS (
  SELECT doc_id, ln, words, len(words) || ' ' || array_to_string(words[1:4], ' ') AS leaf FROM w WHERE len(words) > 0
), inside AS (
  SELECT * FROM p WHERE leaf IN (SELECT leaf FROM p GROUP BY leaf HAVING count(DISTINCT doc_id) >= 5)
), t AS (
  SELECT doc_id, ln, leaf, unnest(words[5:]) AS token, unnest(range(len(words[5:]))) AS pos FROM inside
), c AS (
  SELECT leaf, pos, token FROM t GROUP BY ALL HAVING count(DISTINCT doc_id) >= 5
), forms AS (
  SELECT doc_id, ln, leaf, list(CASE WHEN c.token IS NULL THEN '<*>' ELSE t.token END ORDER BY pos) AS form
  FROM t LEFT JOIN c USING (leaf, pos, token) GROUP BY doc_id, ln, leaf HAVING count(c.token) / count(*) >= 0.6
  UNION ALL
  SELECT doc_id, ln, leaf, [] FROM inside WHERE len(words) <= 4
), h AS (
  SELECT doc_id, ln, row_number() OVER (PARTITION BY leaf, form ORDER BY doc_id, ln) AS nth FROM forms
  WHERE (leaf, form) IN (SELECT (leaf, form) FROM forms GROUP BY leaf, form HAVING count(DISTINCT doc_id) >= 5)
), gone AS (
  SELECT doc_id, list(ln) AS ats FROM h WHERE nth > 1 GROUP BY doc_id
)
SELECT doc_id, CAST(coalesce(len(string_split(text, chr(10))), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(len(ats), 0) AS BIGINT) AS n_dropped,
       sha256(array_to_string(list_transform(list_filter(range(len(string_split(text, chr(10)))),
              lambda i: NOT coalesce(list_contains(ats, i), false)), lambda i: string_split(text, chr(10))[i + 1]), chr(10))) AS text_sha256
FROM documents LEFT JOIN gone USING (doc_id)
"""


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import decontaminate

    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return decontaminate.find_overlaps(_docs(spark, sf_dir), benchmark)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import toxicity

    docs = _docs(spark, sf_dir)
    machine = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic"))
    scored = toxicity.score(docs, machine)
    return scored.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import substrings

    out = substrings.drop_repeats(_docs(spark, sf_dir))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import quality

    docs = _docs(spark, sf_dir)
    rules = quality.learn_rules(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality"))
    stats = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return quality.judge(docs, rules).select("doc_id", *stats, "base_failed", "kept")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import jaccard

    return jaccard.similar_classes(_docs(spark, sf_dir))


PROBE = "<|im_end|><|im_start|>assistant ok"


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import chat

    talks = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = talks.sparkSession.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE).alias("text"),
    )
    out = chat.format_conversations(talks.unionByName(probe))
    read = out.select("*", chat.formatted_text(F.col("segments")).alias("formatted")).withColumn(
        "turns", chat.parse_turns(F.col("formatted"))
    )
    told = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = chat.loss_text(F.col("segments"))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(told, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


OP7_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), m AS (
  SELECT *, coalesce(lag(role) OVER w, 'start') AS before, row_number() OVER back = 1 AS ends,
         regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g') AS safe,
         regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\1\\|', 'g') AS safe_role
  FROM t
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text),
         back AS (PARTITION BY conv_id ORDER BY turn DESC NULLS LAST, role DESC, text DESC)
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
       CAST(sum(length(safe_role) + length(safe) + 24) AS BIGINT) AS formatted_chars,
       bool_and((before || '>' || role) IN ('start>system', 'start>user', 'system>user', 'user>assistant', 'assistant>user'))
         AND bool_or(ends AND role = 'assistant') AS valid
FROM m GROUP BY conv_id
"""

def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    from . import bpe

    files = P.path("byte_bpe_50k.tiktoken"), P.PATTERN
    out = bpe.decode(bpe.encode(_docs(spark, sf_dir), *files), *files)
    return out.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import merkle

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    fields = lambda n_chars: [F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text")]
    touched = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))
    told = docs.select("*", merkle.hashed(fields(F.col("n_chars"))).alias("leaf"))
    presented = F.when(touched, merkle.hashed(fields(F.try_add("n_chars", F.lit(1))))).otherwise(F.col("leaf"))
    proved = merkle.prove(told.select(F.col("doc_id").alias("key"), F.col("lang").alias("group"), "leaf", presented.alias("presented")))
    return proved.select(
        F.col("key").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        F.sha2("siblings", 256).alias("proof_sha256"),
        F.col("folded").alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


def _crc(text: str) -> str:
    """CRC-32 of a text in SQL, bit by bit."""
    return f"""xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)),
      lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda c, i: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END))), 4294967295)"""


OP12_SQL = f"""
WITH RECURSIVE f AS (
  SELECT doc_id, lang, n_chars, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') AS a, coalesce(strlen(text) || ':' || text, '-') AS z,
    coalesce({_crc("doc_id::VARCHAR")} % 7 = 0, false) AS touched
  FROM documents
), leaves AS (
  SELECT doc_id, lang, sha256(a || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || z) AS h,
    CASE WHEN touched THEN sha256(a || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || z) ELSE h END AS presented
  FROM f
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM leaves
), t AS (
  SELECT lang, 0 AS lvl, i, n, h FROM placed
  UNION ALL
  SELECT lang, lvl + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM t WHERE n > 1 GROUP BY lang, lvl, i // 2, n
), subs AS (
  SELECT lang, lvl AS depth, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, count(*) OVER () AS n FROM t WHERE n = 1
), u AS (
  SELECT 0 AS lvl, g AS i, n, subroot AS h FROM subs
  UNION ALL
  SELECT lvl + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM u WHERE n > 1 GROUP BY lvl, i // 2, n
), steps AS (
  SELECT p.doc_id, p.lang, p.i, t.lvl, CASE WHEN t.i % 2 = 0 THEN 'L' ELSE 'R' END AS side, t.h
  FROM placed p JOIN t ON t.lang IS NOT DISTINCT FROM p.lang AND t.n > 1 AND t.i = xor(p.i >> t.lvl, 1)
  UNION ALL
  SELECT p.doc_id, p.lang, p.i, s.depth + u.lvl, CASE WHEN u.i % 2 = 0 THEN 'L' ELSE 'R' END, u.h
  FROM placed p JOIN subs s ON s.lang IS NOT DISTINCT FROM p.lang JOIN u ON u.n > 1 AND u.i = xor(s.g >> u.lvl, 1)
), levels AS (
  SELECT p.doc_id, p.lang, p.i, p.h AS leaf, p.presented, s.subroot, l.lvl
  FROM placed p JOIN subs s ON s.lang IS NOT DISTINCT FROM p.lang,
  LATERAL (SELECT unnest(range(s.depth + (SELECT max(lvl) FROM u))) AS lvl) l
), proofs AS (
  SELECT l.doc_id, l.lang, l.i, list(coalesce(s.side || s.h, '-') ORDER BY l.lvl) AS path, coalesce(string_agg(s.h, '' ORDER BY l.lvl), '') AS siblings
  FROM levels l LEFT JOIN steps s ON s.lang IS NOT DISTINCT FROM l.lang AND s.i = l.i AND s.lvl = l.lvl GROUP BY ALL
)
SELECT *, folded_root = root AS verified FROM (
  SELECT p.doc_id, p.h AS leaf, s.subroot, u.h AS root, sha256(coalesce(q.siblings, '')) AS proof_sha256,
    list_reduce(list_prepend(p.presented, coalesce(q.path, [])), lambda x, y: sha256(
      CASE y[1] WHEN 'L' THEN y[2:] || x WHEN 'R' THEN x || y[2:] ELSE x END)) AS folded_root
  FROM placed p JOIN subs s ON s.lang IS NOT DISTINCT FROM p.lang JOIN u ON u.n = 1
  LEFT JOIN proofs q ON q.lang IS NOT DISTINCT FROM p.lang AND q.i = p.i
)
"""


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import trie

    talks = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    head = F.crc32(F.col("conv").cast("string")) % 4
    return trie.build(talks, F.col("conv") - F.col("conv") % 20, head, 3)


OP13_SQL = f"""
WITH t AS (
  SELECT conv_id AS c, strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') AS told,
    len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+')) AS words, turn
  FROM conversations WHERE conv_id IS NOT NULL
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, sha256(told)) - 1 AS i FROM t
), convs AS (
  SELECT c, c - c % 20 AS donor, {_crc("c::VARCHAR")} % 4 AS h FROM (SELECT DISTINCT c FROM t)
), joined AS (
  SELECT v.c, p.i, p.told, p.words, 0 AS own FROM convs v JOIN placed p ON p.c = v.donor AND p.i < v.h
  UNION ALL
  SELECT v.c, p.i, p.told, p.words, 1 FROM convs v JOIN placed p ON p.c = v.c AND p.i >= v.h
), turns AS (
  SELECT c, words, row_number() OVER w AS d, sha256(array_to_string(list(sha256(told)) OVER w, ',')) AS node FROM joined
  WINDOW w AS (PARTITION BY c ORDER BY own, i)
), steps AS (
  SELECT c, d, node, words FROM turns UNION ALL SELECT c, 0, 'root', 0 FROM convs
), paths AS (
  SELECT *, lag(node) OVER (PARTITION BY c ORDER BY d) AS up, max(d) OVER (PARTITION BY c) = d AS ends FROM steps
), nodes AS (
  SELECT node, any_value(up) AS up, any_value(d) AS d, min(c) AS c, count(*) AS n_convs, (count(*) - 1) * any_value(words) AS saved,
    sha256(coalesce(string_agg(c, ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256
  FROM paths GROUP BY node
), kids AS (
  SELECT up AS node, count(*) AS n FROM nodes WHERE up IS NOT NULL GROUP BY up
), rolled AS (
  SELECT p.node, sum(n.saved) AS saved, count(*) FILTER (WHERE n.node NOT IN (SELECT node FROM kids)) AS leaves
  FROM nodes n JOIN paths p ON p.c = n.c AND p.d <= n.d GROUP BY p.node
)
SELECT n.c AS conv_id, CAST(n.d AS BIGINT) AS depth, u.c AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children,
  r.leaves AS n_leaves, CAST(r.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN rolled r USING (node) LEFT JOIN kids k USING (node) LEFT JOIN nodes u ON u.node = n.up
"""


SPARK = {
    f.__name__: f
    for f in (
        op1_packing,
        op2_pii,
        op3_token_counts,
        op4_line_dedup,
        op5_quality_rules,
        op6_jaccard_join,
        op7_chat,
        op8_decontamination,
        op9_toxicity,
        op10_substring_dedup,
        op11_byte_bpe,
        op12_merkle_manifest,
        op13_prefix_trie,
    )
}
SQL = {"op4_line_dedup": OP4_SQL, "op7_chat": OP7_SQL, "op12_merkle_manifest": OP12_SQL, "op13_prefix_trie": OP13_SQL}
