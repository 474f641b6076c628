"""Personal data: fixed patterns, then bootstrapped contextual extraction.

``base_spans`` finds e-mail addresses, IPv4 addresses, payment-card numbers
and phone numbers by pattern and check. ``extract`` uses them, and long hex
keys (kind ``secret``), as seed entities. A candidate is a run of
identifier-shaped tokens (each holds a digit or ``@``) joined by single spaces,
and each token of such a run. What surrounds a candidate are its lexical
patterns: the word to its left, the two words to its left, the word to its
right (punctuation that stands alone is a word), and its own shape (digits as
9, letters as a). Spark scores the bipartite graph of patterns and candidates
in rounds: a context is worth the share of its distinct candidates that are
believed to be of a kind; a shape the share of that kind among its believed
ones, since a candidate that fails a check is no evidence against its shape. A
candidate is believed by the noisy-or of its confident patterns. Candidates
believed at the end, at places that a confident pattern marks, are added: whole
ones, none that overlaps a base span, a run before its tokens.

Built-in DataFrame functions only. The texts are read once; what follows works
on a stored table of spans and candidates.

Defined results for odd input: null or empty text has no spans; a null
``doc_id`` is kept as null; rows that repeat a ``doc_id`` are separate
documents; an empty table gives no rows; other columns are ignored. Matching
is linear in the text length (possessive quantifiers, anchored starts), and
what follows in the number of candidates but for sorting.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import stored

KINDS = ("email", "ip", "card", "phone")

# A match can only start where its run of characters starts, or where the
# previous match ended (\G): any later start in the same run fails as well.
_RUN = r"A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:(?<![{_RUN}])|\G)[{_RUN}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?+[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
_OCTET = r"0*(?:[0-9]|[1-9][0-9]|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
FOUND_KINDS = (*KINDS, "secret")
_ID = r"[^\s0-9@]*+[0-9@]\S*+"
RUN = rf"(?<!\S){_ID}(?: {_ID})*+"
HEX_KEY = r"^(?=.*[0-9])(?=.*[A-Fa-f])(?:[0-9a-f]{32,}|[0-9A-F]{32,})$"
MIN_DIGITS = 4  # of a candidate found by its context
SHAPE_DIGITS = 6  # of a candidate whose shape says something


def luhn(digits: Column) -> Column:
    """Luhn check of a column of digit strings."""
    chars = F.split(F.reverse(digits), "")
    doubled = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    each = F.transform(chars, lambda c, i: F.when(i % 2 == 1, doubled(c.cast("int"))).otherwise(c.cast("int")))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    hit = m["hit"]
    digits = F.regexp_replace(hit, "[^0-9]", "")
    if kind == "ip":
        return hit.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once: what stands inside a
    lambda is evaluated for each element unless it is the lambda's variable."""
    return F.element_at(F.transform(F.array(value), body), 1)


MATCH = "array<struct<start:int,end:int,hit:string,before:string,after:string>>"
BLOCK = 128


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches: array of struct ``start, end, hit,
    before, after`` (code points, end exclusive; the texts between matches).

    The gaps come from ``split`` and the matches from ``regexp_extract_all``
    with the same pattern, so a start is the length of all that precedes it:
    running sums within blocks of matches, then over the blocks, so that a text
    with very many matches costs little more per match than one with few.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    found = let(hits, lambda h: let(F.split(text, pattern, -1), lambda g: _placed(h, g)))
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(MATCH))


def _placed(hits: Column, gaps: Column) -> Column:
    sides = F.zip_with(
        F.slice(gaps, F.lit(1), F.size(hits)), F.slice(gaps, F.lit(2), F.size(hits)), lambda b, a: F.struct(b.alias("b"), a.alias("a"))
    )
    rows = F.zip_with(hits, sides, lambda h, s: F.struct(h.alias("h"), s["b"].alias("b"), s["a"].alias("a")))
    return let(rows, lambda r: let(F.transform(_blocks(r), _within), _shifted))


def _blocks(rows: Column) -> Column:
    last = F.floor((F.size(rows) - 1) / BLOCK).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(rows, i * BLOCK + 1, F.lit(BLOCK)))


def _within(block: Column) -> Column:
    """Matches of a block with starts from the block's beginning, and the
    block's length."""

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["b"])
        end = start + F.length(x["h"])
        one = F.struct(start.alias("start"), end.alias("end"), x["h"].alias("hit"), x["b"].alias("before"), x["a"].alias("after"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    return F.aggregate(block, F.struct(F.lit(0).alias("at"), F.array().cast(MATCH).alias("out")), add)


def _shifted(blocks: Column) -> Column:
    def add(acc: Column, x: Column) -> Column:
        return F.struct((acc["at"] + x["at"]).alias("at"), F.concat(acc["begin"], F.array(acc["at"])).alias("begin"))

    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("begin"))
    begins = F.aggregate(blocks, first, add, lambda acc: acc["begin"])
    move = lambda by: lambda m: F.struct(
        (m["start"] + by).alias("start"), (m["end"] + by).alias("end"), m["hit"].alias("hit"), m["before"].alias("before"), m["after"].alias("after")
    )
    return F.flatten(F.zip_with(blocks, begins, lambda x, by: F.transform(x["out"], move(by))))


def base_spans(text: Column) -> Column:
    """Array of struct ``start, rank, end, kind``, sorted (rank: the kind's
    place in ``KINDS``)."""
    each = []
    for rank, kind in enumerate(KINDS):
        valid = F.filter(matches(text, PATTERNS[kind]), partial(_valid, kind))
        each.append(F.transform(valid, partial(_span_of, rank)))
    return F.array_sort(F.concat(*each))


def _span_of(rank: int, m: Column) -> Column:
    return span(m["start"], rank, m["end"], KINDS[rank])


def span(start: Column, rank, end: Column, kind) -> Column:
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(start.alias("start"), lit(rank).alias("rank"), end.alias("end"), lit(kind).alias("kind"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _word(near: Column, pattern: str) -> Column:
    """The word that ``pattern`` takes from a lower-case gap, without the
    punctuation at its ends unless it is nothing else; empty when there is
    none in reach."""
    raw = F.regexp_extract(near, pattern, 1)
    bare = F.regexp_replace(raw, r"^[\p{Punct}]+|[\p{Punct}]+$", "")
    return F.when(bare == "", raw).otherwise(bare)


def runs(text: Column) -> Column:
    """Runs of identifier-shaped tokens: array of struct ``start, hit, left,
    before, right`` (before: the word to the left of ``left``)."""

    def one(m: Column) -> Column:
        ahead, behind = F.lower(F.right(m["before"], F.lit(80))), F.lower(F.left(m["after"], F.lit(80)))
        return F.struct(
            m["start"].alias("start"),
            m["hit"].alias("hit"),
            _word(ahead, r"(\S++)\s*+$").alias("left"),
            _word(ahead, r"(\S++)\s++\S++\s*+$").alias("before"),
            _word(behind, r"^\s*+(\S++)").alias("right"),
        )

    return F.transform(matches(text, RUN), one)


def shape(token: Column) -> Column:
    """Hex keys by their length; else digits as 9 and letters as a. Null for
    a token of few digits."""
    digits = F.length(F.regexp_replace(token, "[^0-9]", ""))
    form = F.regexp_replace(F.regexp_replace(token, "[0-9]", "9"), r"\p{L}+", "a")
    return F.when(token.rlike(HEX_KEY), F.concat(F.lit("hex "), F.length(token))).when(digits >= SHAPE_DIGITS, form)


def candidates(table: DataFrame) -> DataFrame:
    """``row, run, whole, start, end, token, seed, left, two, right``: the runs
    of a stored table and their tokens, cut to their core. ``seed``: place in
    ``FOUND_KINDS`` of the base span that is the candidate, or of a key, else
    -1. Candidates that overlap a base span otherwise are left out."""
    each = table.select("row", F.explode("runs").alias("r")).select("row", F.col("r.start").alias("run"), "r.hit", "r.left", "r.before", "r.right")
    two = F.when((F.col("left") != "") & (F.col("before") != ""), F.concat_ws(" ", "before", "left"))
    each = each.withColumn("two", two).drop("before")
    whole = each.select("row", "run", F.lit(True).alias("whole"), F.col("run").alias("start"), "hit", "left", "two", "right")
    several = each.filter(F.col("hit").contains(" ")).withColumn("parts", matches(F.col("hit"), r"\S++"))
    parts = several.select("row", "run", "left", "two", "right", F.size("parts").alias("n"), F.posexplode("parts").alias("at", "m"))
    first, last = F.col("at") == 0, F.col("at") == F.col("n") - 1
    single = parts.select(
        "row",
        "run",
        F.lit(False).alias("whole"),
        (F.col("run") + F.col("m.start")).alias("start"),
        F.col("m.hit").alias("hit"),
        *[F.when(first, F.col(c)).alias(c) for c in ("left", "two")],
        F.when(last, F.col("right")).alias("right"),
    )
    every = whole.unionByName(single)
    lead = F.regexp_extract("hit", r"^([\p{Punct}&&[^+@(]]*+)", 1)
    core = F.regexp_replace(F.expr("substring(hit, length(lead) + 1)"), r"\p{Punct}+$", "")
    opened = F.col("token").startswith("(") & ~F.col("token").contains(")")
    cut = every.withColumn("lead", lead).withColumn("token", core).withColumn("start", F.col("start") + F.length("lead"))
    cut = cut.withColumn("start", F.when(opened, F.col("start") + 1).otherwise(F.col("start")))
    cut = cut.withColumn("token", F.when(opened, F.expr("substring(token, 2)")).otherwise(F.col("token"))).filter("token != ''")
    cut = cut.drop("hit", "lead").withColumn("end", F.col("start") + F.length("token"))

    # base spans among them: the one that is the candidate, and overlaps
    spans = table.select("row", F.explode("base").alias("s")).select("row", F.col("s.start").alias("start"), F.col("s.end").alias("end"), F.col("s.rank").alias("rank"))
    known = spans.groupBy("row", "start", "end").agg(F.min("rank").alias("rank"))
    both = cut.join(known, ["row", "start", "end"], "left").withColumn("own", F.lit(False))
    marks = spans.groupBy("row", "start").agg(F.max("end").alias("end")).withColumn("own", F.lit(True))
    both = both.unionByName(marks, allowMissingColumns=True)
    up = Window.partitionBy("row").orderBy("start", F.desc("own")).rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy("row").orderBy(F.desc("start"), "own").rowsBetween(Window.unboundedPreceding, 0)
    near = both.withColumns(
        {"reach": F.max(F.when(F.col("own"), F.col("end"))).over(up), "next": F.min(F.when(F.col("own"), F.col("start"))).over(down)}
    )
    clash = (F.coalesce("reach", F.lit(-1)) > F.col("start")) | (F.coalesce("next", F.col("end")) < F.col("end"))
    free = near.filter(~F.col("own") & (F.col("rank").isNotNull() | ~clash))
    seed = F.coalesce("rank", F.when(F.col("token").rlike(HEX_KEY), len(KINDS)), F.lit(-1))
    return free.select("row", "run", "whole", "start", "end", "token", seed.alias("seed"), "left", "two", "right")


def score(edges: DataFrame, rounds: int, min_support: int, min_shape_support: int, min_confidence: float) -> tuple[DataFrame, DataFrame]:
    """Score the graph. ``edges``: ``pattern, token, seed``. Returns the
    confident patterns ``pattern, kind, confidence`` and believed tokens
    ``token, kind, belief``."""
    links = edges.groupBy("pattern", "token").agg(F.max("seed").alias("seed"))
    seeds = links.filter("seed >= 0").groupBy("token").agg(F.max("seed").alias("kind")).withColumn("belief", F.lit(1.0))
    believed, patterns = seeds, None
    is_shape = F.col("pattern").startswith("S ")
    for _ in range(rounds):
        known = links.join(believed, "token", "left")
        totals = known.groupBy("pattern").agg(F.count("*").alias("tokens"), F.sum("belief").alias("known"))
        worth = known.filter("kind is not null").groupBy("pattern", "kind").agg(
            F.sum("belief").alias("mass"), F.count("*").alias("support")
        )
        enough = F.col("support") >= F.when(is_shape, min_shape_support).otherwise(min_support)
        patterns = stored(
            worth.join(totals, "pattern")
            .withColumn("confidence", F.col("mass") / F.when(is_shape, F.col("known")).otherwise(F.col("tokens")))
            .filter(enough & (F.col("confidence") >= min_confidence))
            .select("pattern", "kind", "confidence"),
            "pii-patterns",
        )
        doubt = F.sum(F.log(F.greatest(F.lit(1e-9), 1 - F.col("confidence"))))
        voted = links.select("pattern", "token").join(patterns, "pattern").groupBy("token", "kind").agg(
            (1 - F.exp(doubt)).alias("belief")
        )
        best = voted.groupBy("token").agg(F.max_by(F.struct("kind", "belief"), F.struct("belief", -F.col("kind"))).alias("b"))
        grown = best.select("token", "b.kind", "b.belief").join(seeds.select("token"), "token", "left_anti")
        believed = stored(seeds.unionByName(grown), "pii-tokens")
    return patterns, believed


def extract(
    docs: DataFrame,
    rounds: int = 2,
    min_support: int = 5,
    min_shape_support: int = 3,
    min_confidence: float = 0.8,
    min_belief: float = 0.8,
) -> DataFrame:
    """One row per document: ``doc_id``, ``base`` and ``spans`` (arrays of
    struct ``start, rank, end, kind``; ``spans`` is base plus discovered)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select("doc_id", text.alias("text")).withColumn("base", base_spans(F.col("text")))
    table = stored(
        found.select(F.monotonically_increasing_id().alias("row"), "doc_id", "base", runs(F.col("text")).alias("runs")),
        "pii-spans",
    )
    each = stored(candidates(table), "pii-candidates")
    mark = lambda name, c: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(name), c))
    contexts = F.array(
        mark("L ", F.col("left")), mark("LL ", F.col("two")), mark("R ", F.col("right")), mark("S ", shape(F.col("token")))
    )
    marked = each.withColumn("pattern", F.explode(F.array_compact(contexts)))
    edges = stored(marked.groupBy("pattern", "token").agg(F.max("seed").alias("seed")), "pii-edges")
    patterns, believed = score(edges, rounds, min_support, min_shape_support, min_confidence)

    # the unseen ones: at a place that a confident pattern marks, of the kind
    # that the candidate is believed to be
    digits = F.length(F.regexp_replace("token", "[^0-9]", ""))
    likely = F.col("pattern").startswith("S ") | (digits >= MIN_DIGITS)
    fresh = (
        marked.filter((F.col("seed") < 0) | (F.col("seed") >= len(KINDS)))
        .filter(likely)
        .join(patterns.select("pattern", "kind"), "pattern")
        .join(believed.filter(F.col("belief") >= min_belief), ["token", "kind"])
        .select("row", "run", "whole", "start", "end", "kind")
        .distinct()
    )
    in_run = Window.partitionBy("row", "run")
    kept = fresh.withColumn("all", F.bool_or("whole").over(in_run)).filter(F.col("whole") | ~F.col("all"))
    names = F.array(*[F.lit(k) for k in FOUND_KINDS])
    added = kept.groupBy("row").agg(
        F.collect_list(span(F.col("start"), F.col("kind"), F.col("end"), F.element_at(names, F.col("kind") + 1))).alias("added")
    )
    every = F.when(F.col("added").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "added")))
    return table.select("row", "doc_id", "base").join(added, "row", "left").select("doc_id", "base", every.alias("spans"))
