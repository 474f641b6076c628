r"""Line dedup by log templates.

Lines go down a fixed-depth parse tree: the first level is the number of
tokens, the next ``depth`` levels are the leading tokens (tokens with a digit
count as the wildcard ``<*>``). In a leaf, a later position's token is constant
if lines of at least ``min_docs`` documents of the leaf have it there, and
variable otherwise. A line whose later positions are constant by a share of at
least ``similarity`` belongs to a template: its leaf and its later tokens with
the wildcard at the variable positions; a leaf may hold many templates. A
template recurs if lines of at least ``min_docs`` documents belong to it.
Instances of recurring templates are dropped; the first instance of each
template (smallest document, then line) stays. A line of leading tokens only
is its own template.

Built-in DataFrame functions only. Documents are keyed by ``doc_id`` and the
hash of the text; what is shuffled are hashes, the lines of leaves that hold
several different lines in several documents, and once the texts. Counting to
``min_docs`` needs the documents of rare lines only: a line of ``min_docs``
documents or more decides for its tokens and its template alone.

Defined results for odd input: null text stays null and empty text empty;
blank lines stay and are never instances; a null ``doc_id`` is a document like
any other (sorts first); rows that repeat both id and text count as one
document and get the same result; an empty table gives no rows. All columns of
the input are kept; ``n_lines`` and ``n_dropped`` are added (and replace
columns so named).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import stored

SPACE = r" \t\x0B\f\r"
DIGIT_TOKEN = rf"(?<![^\n{SPACE}])[^\n{SPACE}0-9]*+[0-9][^\n{SPACE}]*+"
WILDCARD = "<*>"
LEAF_BUCKETS = 1 << 20
HOT_SHARE = 1000
SALTS = 64


def _lines(docs: DataFrame, depth: int) -> DataFrame:
    """``doc, hash, line, leaf, sig, told`` of every line with a word (told:
    its words, numbers as wildcards)."""
    # the text is hashed before it is cut: after, that would be once per line
    masked = F.regexp_replace("text", DIGIT_TOKEN, WILDCARD).alias("masked")
    whole = docs.select(F.col("doc_id").alias("doc"), F.xxhash64("text").alias("hash"), masked)
    each = whole.select("doc", "hash", F.posexplode(F.split("masked", "\n", -1)).alias("line", "raw"))
    words = each.filter(F.col("raw").rlike(f"[^{SPACE}]")).withColumn("words", F.array_remove(F.split("raw", f"[{SPACE}]+"), ""))
    lead = F.array_join(F.slice("words", 1, depth), " ")
    told = words.select("doc", "hash", "line", F.xxhash64(F.size("words"), lead).alias("leaf"), F.array_join("words", " ").alias("told"))
    return told.withColumn("sig", F.xxhash64("told"))


def _bucket(leaf: Column) -> Column:
    return F.pmod(leaf, F.lit(LEAF_BUCKETS))


def _by_line(places: DataFrame, lines: DataFrame, counts: DataFrame) -> DataFrame:
    """``places`` joined with ``lines`` on ``(leaf, sig)``. Lines that hold more
    than one in ``HOT_SHARE`` of all documents' lines (at most that many, so
    they can be broadcast) are dealt over ``SALTS`` parts."""
    total = counts.select(F.sum("docs")).scalar()
    hot = F.broadcast(counts.filter(F.col("docs") * HOT_SHARE > total).select("leaf", "sig", F.lit(True).alias("hot")))
    part = F.pmod(F.xxhash64("doc", "hash", "line"), F.lit(SALTS))
    dealt = places.join(hot, ["leaf", "sig"], "left").withColumn("part", F.when(F.col("hot"), part).otherwise(F.lit(0).cast("long"))).drop("hot")
    parts = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))).cast("array<long>")
    spread = lines.join(hot, ["leaf", "sig"], "left").withColumn("part", F.explode(parts)).drop("hot")
    return dealt.join(spread, ["leaf", "sig", "part"]).drop("part")


def _mixed_templates(places: DataFrame, in_wide: DataFrame, depth: int, min_docs: int, similarity: float) -> DataFrame:
    """``leaf, sig, template`` of the lines that belong to recurring templates,
    in leaves with several different lines."""
    mixed = stored(in_wide.groupBy("leaf").agg(F.count("*").alias("n")).filter("n > 1").select("leaf"), "mixed-leaves")
    # their lines are read again, first thinned by leaf bucket (LEAF_BUCKETS
    # numbers at most, whatever the input)
    buckets = mixed.select(_bucket(F.col("leaf")).alias("bucket")).distinct()
    thinned = places.select("leaf", "sig", "told").join(F.broadcast(buckets), _bucket(F.col("leaf")) == F.col("bucket"), "left_semi")
    once = thinned.groupBy("leaf", "sig").agg(F.first("told").alias("told"))
    later = F.slice(F.split("told", " "), F.lit(depth + 1), F.greatest(F.size(F.split("told", " ")) - depth, F.lit(0)))
    lines = once.join(mixed, "leaf", "left_semi").join(in_wide, ["leaf", "sig"]).select("leaf", "sig", "docs", later.alias("later"))
    tokens = stored(
        lines.select("leaf", "sig", "docs", F.posexplode("later").alias("at", "token")).withColumn("token", F.xxhash64("token")), "leaf-tokens"
    )
    rare = in_wide.filter(F.col("docs") < min_docs).join(mixed, "leaf", "left_semi").select("leaf", "sig")
    rare_docs = stored(places.join(rare, ["leaf", "sig"]).select("leaf", "sig", "doc", "hash").distinct(), "rare-line-documents")

    common = tokens.filter(F.col("docs") >= min_docs).select("leaf", "at", "token")
    pairs = tokens.filter(F.col("docs") < min_docs).join(rare_docs, ["leaf", "sig"])
    apart = pairs.groupBy("leaf", "at", "token", "doc", "hash").agg(F.lit(1).alias("one"))
    summed = apart.groupBy("leaf", "at", "token").agg(F.count("*").alias("n")).filter(F.col("n") >= min_docs).select("leaf", "at", "token")
    constants = common.unionByName(summed).distinct().withColumn("constant", F.lit(True))

    wild = F.xxhash64(F.lit(WILDCARD))
    shown = F.struct("at", F.when(F.col("constant"), F.col("token")).otherwise(wild).alias("token"))
    told = tokens.join(constants, ["leaf", "at", "token"], "left").groupBy("leaf", "sig", "docs").agg(
        F.avg(F.when(F.col("constant"), 1.0).otherwise(0.0)).alias("share"), F.xxhash64(F.array_sort(F.collect_list(shown))).alias("form")
    )
    named = stored(
        told.filter(F.col("share") >= similarity).select("leaf", "sig", "docs", F.xxhash64("leaf", "form").alias("template")), "line-templates"
    )
    alone = named.filter(F.col("docs") >= min_docs).select("template")
    members = named.join(rare_docs, ["leaf", "sig"]).groupBy("template", "doc", "hash").agg(F.lit(1).alias("one"))
    together = members.groupBy("template").agg(F.count("*").alias("n")).filter(F.col("n") >= min_docs).select("template")
    return named.join(alone.unionByName(together).distinct(), "template", "left_semi").select("leaf", "sig", "template")


def find_instances(docs: DataFrame, depth: int = 4, min_docs: int = 5, similarity: float = 0.6) -> DataFrame:
    """``doc, hash, line``: the lines to drop."""
    places = stored(_lines(docs, depth), "lines")
    sigs = places.groupBy("leaf", "sig", "doc", "hash").agg(F.lit(1).alias("one")).groupBy("leaf", "sig").agg(F.count("*").alias("docs"))
    leaves = places.groupBy("leaf", "doc", "hash").agg(F.lit(1).alias("one")).groupBy("leaf").agg(F.count("*").alias("spread"))
    wide = leaves.filter(F.col("spread") >= min_docs).select("leaf")
    in_wide = stored(sigs.join(wide, "leaf"), "leaf-lines")
    several = in_wide.groupBy("leaf").agg(F.count("*").alias("n"), F.first("sig").alias("sig"))
    # a leaf of one line: its documents are the leaf's
    alone = several.filter("n = 1").select("leaf", "sig", F.xxhash64("leaf").alias("template"))
    gone = stored(_mixed_templates(places, in_wide, depth, min_docs, similarity).unionByName(alone), "recurring-lines")
    hits = stored(_by_line(places.drop("told"), gone, in_wide).select("template", "doc", "hash", "line").distinct(), "line-hits")
    # a place is of one template, so the first ones are taken out by place: no
    # join by template, which a very common line would make uneven
    first = hits.groupBy("template").agg(F.min(F.struct("doc", "hash", "line")).alias("p"))
    first = first.select(F.col("p.doc").alias("d"), F.col("p.hash").alias("h"), F.col("p.line").alias("l"))
    same = F.col("doc").eqNullSafe(F.col("d")) & (F.col("hash") == F.col("h")) & (F.col("line") == F.col("l"))
    return hits.select("doc", "hash", "line").join(first, same, "left_anti")


def _without(text: Column, drop: Column) -> Column:
    """``text`` without its lines numbered ``drop``. The lines are an argument
    of the outer function, cut once: within the inner one, which runs per line,
    the whole text would be cut again for each of them."""
    numbers = lambda lines: F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), drop)
    joined = lambda lines: F.array_join(F.transform(numbers(lines), lambda i: F.element_at(lines, i + 1)), "\n")
    return F.transform(F.array(F.split(text, "\n", -1)), joined)[0]


def drop_template_lines(docs: DataFrame, depth: int = 4, min_docs: int = 5, similarity: float = 0.6, keep_emptied: bool = True) -> DataFrame:
    """``docs`` with the instances of recurring templates taken out of
    ``text``, plus ``n_lines`` and ``n_dropped``; without ``keep_emptied``,
    documents go whose every line with a word is dropped."""
    drops = find_instances(docs, depth, min_docs, similarity)
    per_doc = drops.groupBy(F.col("doc").alias("__line_doc"), F.col("hash").alias("__line_hash")).agg(F.collect_list("line").alias("__line_drop"))
    keyed = docs.withColumn("__line_key", F.xxhash64("text"))
    joined = keyed.join(per_doc, F.col("doc_id").eqNullSafe(F.col("__line_doc")) & (F.col("__line_key") == F.col("__line_hash")), "left")
    if not keep_emptied:
        # judged by counts: a filter on the new text would make Spark build it twice
        told = F.size(F.filter(F.split("text", "\n", -1), lambda x: x.rlike(f"[^{SPACE}]")))
        joined = joined.filter(F.col("__line_drop").isNull() | F.coalesce(told > F.size("__line_drop"), F.lit(True)))
    text = F.when(F.col("__line_drop").isNull(), F.col("text")).otherwise(_without(F.col("text"), F.col("__line_drop")))
    others = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return joined.select(
        *[text.alias(c) if c == "text" else F.col(c) for c in others],
        F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("__line_drop"), F.lit(0)).cast("long").alias("n_dropped"),
    )
