"""Quality rules: text statistics and a learned decision list.

``statistics`` counts words, characters, symbols, repeated lines and repeated
word windows of whole texts in Arrow batches. ``learn`` grows a decision list
by sequential covering: a rule is a conjunction of thresholds on statistics
that singles out bad documents, grown on two thirds of the labelled rows by
information gain, pruned from its end on the other third, and accepted while
it is precise enough there; the rows it covers are taken out and the next rule
is grown. ``verdict`` turns the list into one ordered conditional expression,
so applying it is a projection.

Labels are a bounded sample (``MAX_LABELLED`` rows, by hash of the id); all
documents get statistics and a verdict.

Defined results for odd input: null text is empty (all counts 0); a null
``doc_id`` is kept and never labelled; rows that repeat a ``doc_id`` are
separate documents; with no labels of one of the classes the list is empty and
keeps all; an empty table gives no rows; other columns are ignored by
``statistics`` and kept by ``judge`` (statistics replace columns so named).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W

MAX_LABELLED = 20_000
REPEAT_WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
BYTES_AT_ONCE = 1 << 20

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks", "n_digits")
# ratios the rules may test: name, numerator, denominator
RATIOS = (
    ("chars_per_word", "word_chars", "n_words"),
    ("symbols_per_word", "n_symbols", "n_words"),
    ("marks_per_word", "n_marks", "n_words"),
    ("digits_per_word", "n_digits", "n_words"),
    ("upper_share", "n_upper", "word_chars"),
    ("repeat_share", "n_repeat_words", "n_words"),
    ("dup_line_share", "n_dup_lines", "n_lines"),
    ("words_per_line", "n_words", "n_lines"),
    ("words", "n_words", None),
)


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, np.uint8)
    out[list(chars)] = 1
    return out


_SYMBOL = _table(b"#*$%&|<>")
_MARK = _table(b"!?.,;:'\"()[]{}-_/\\")
_UPPER = _table(bytes(range(65, 91)))
_DIGIT = _table(bytes(range(48, 58)))
_CHAR = np.ones(256, np.uint8)  # one per code point of a word
_CHAR[0x80:0xC0] = 0
_CHAR[W.IS_SPACE] = 0


def repeated_words(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text: the number of words, and of words covered by a window of
    ``size`` words that occurs twice or more in the text."""
    (h1, h2), starts = W.hash_words(texts)
    at = W.window_starts(starts, size)
    one, two = W.window_hashes(h1, size)[at], W.window_hashes(h2, size)[at]
    doc = np.searchsorted(starts, at, side="right") - 1
    order = W.order_by_doc(doc, one)
    one, two, doc = one[order], two[order], doc[order]
    same = (one[1:] == one[:-1]) & (two[1:] == two[:-1]) & (doc[1:] == doc[:-1])
    twice = np.zeros(len(at), bool)
    twice[1:] |= same
    twice[:-1] |= same
    begin = at[order[twice]]
    change = np.zeros(starts[-1] + 1, np.int64)
    np.add.at(change, begin, 1)
    np.add.at(change, begin + size, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(change)[:-1] > 0)])
    return np.diff(starts), np.diff(covered[starts])


def _count(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    run = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return np.diff(run[offsets])


def _dup_lines(text: bytes) -> tuple[int, int]:
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines), len(lines) - len(set(lines))


def measure(texts: pa.Array) -> dict[str, np.ndarray]:
    body, offsets = W.raw(texts)
    n_words, n_repeat = repeated_words(texts, REPEAT_WINDOW)
    lines = np.array([_dup_lines(x) for x in texts.to_pylist()], np.int64).reshape(-1, 2)
    return {
        "n_words": n_words,
        "word_chars": _count(_CHAR[body], offsets),
        "n_symbols": _count(_SYMBOL[body], offsets),
        "n_dup_lines": lines[:, 1],
        "n_repeat_words": n_repeat,
        "n_lines": lines[:, 0],
        "n_upper": _count(_UPPER[body], offsets),
        "n_marks": _count(_MARK[body], offsets),
        "n_digits": _count(_DIGIT[body], offsets),
    }


def statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns ``STATISTICS`` added."""
    kept = [c for c in docs.columns if c not in STATISTICS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = W.as_binary(batch["text"])
            for i, j in W.slices(np.diff(W.raw(texts)[1]), BYTES_AT_ONCE):
                found = measure(texts.slice(i, j - i))
                rows = batch.slice(i, j - i)
                columns = [*rows.columns, *(pa.array(found[s].astype(np.int64)) for s in STATISTICS)]
                yield pa.RecordBatch.from_arrays(columns, [*kept, *STATISTICS])
        batch = texts = rows = columns = None
        W.release()

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema.fields]
    return docs.select(*kept).mapInArrow(run, ", ".join([*fields, *(f"{s} long" for s in STATISTICS)]))


def ratio(name: str) -> Column:
    """A ratio as a Spark expression; 0 where there is nothing to divide by."""
    _, top, bottom = next(r for r in RATIOS if r[0] == name)
    if bottom is None:
        return F.col(top).cast("double")
    return F.when(F.col(bottom) > 0, F.col(top) / F.col(bottom)).otherwise(0.0)


@dataclass(frozen=True)
class Test:
    """``ratio >= threshold`` or ``ratio <= threshold``."""

    name: str
    above: bool
    threshold: float

    def rows(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.name] >= self.threshold if self.above else x[self.name] <= self.threshold

    def expression(self) -> Column:
        return ratio(self.name) >= self.threshold if self.above else ratio(self.name) <= self.threshold


Rule = tuple[Test, ...]


def covers(rule: Rule, x: dict[str, np.ndarray]) -> np.ndarray:
    out = np.ones(len(next(iter(x.values()))), bool)
    for test in rule:
        out &= test.rows(x)
    return out


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, max_tests: int, cuts: int) -> Rule:
    """Add the test with the best gain until no good row is covered."""
    rule: Rule = ()
    inside = np.ones(len(bad), bool)
    while len(rule) < max_tests:
        p0, n0 = (inside & bad).sum(), (inside & ~bad).sum()
        if not p0 or not n0:
            break
        before, best = np.log2(p0 / (p0 + n0)), (0.0, None)
        for name, values in x.items():
            here = values[inside]
            order = np.argsort(here)
            v, b = here[order], bad[inside][order]
            edges = np.unique(np.quantile(v, np.linspace(0, 1, cuts)))
            for above in (True, False):
                k = np.searchsorted(v, edges, side="left" if above else "right")
                total = np.concatenate([[0], np.cumsum(b)])
                p = (p0 - total[k]) if above else total[k]
                n = (len(v) - k if above else k) - p
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(p > 0, p * (np.log2(p / (p + n)) - before), 0)
                i = int(np.argmax(gain))
                if gain[i] > best[0] + 1e-9:
                    best = (gain[i], Test(name, above, float(edges[i])))
        if best[1] is None:
            break
        rule = (*rule, best[1])
        inside &= best[1].rows(x)
    return rule


def _prune(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """The prefix of the rule with the best (p - n) / (p + n) on other rows."""

    def worth(r: Rule) -> float:
        hit = covers(r, x)
        p, n = (hit & bad).sum(), (hit & ~bad).sum()
        return (p - n) / (p + n) if p + n else -1.0

    return max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: (worth(r), -len(r)), default=())


def learn(
    x: dict[str, np.ndarray], bad: np.ndarray, min_precision: float = 0.95, min_support: int = 5, max_rules: int = 12, max_tests: int = 4, cuts: int = 64
) -> list[Rule]:
    """An ordered list of rules for ``bad`` rows by sequential covering."""
    rules: list[Rule] = []
    third = np.arange(len(bad)) % 3 == 2
    left = np.ones(len(bad), bool)
    while len(rules) < max_rules and (left & bad & ~third).any():
        take = lambda m: {k: v[m] for k, v in x.items()}
        grow, prune = left & ~third, left & third
        rule = _prune(_grow(take(grow), bad[grow], max_tests, cuts), take(prune), bad[prune])
        if not rule:
            break
        hit = covers(rule, x) & left
        p, n = (hit & bad & third).sum(), (hit & ~bad & third).sum()
        every_p, every_n = (hit & bad).sum(), (hit & ~bad).sum()
        if p + n == 0 or every_p < min_support or p < min_precision * (p + n) or every_p < min_precision * (every_p + every_n):
            break
        rules.append(rule)
        left &= ~hit
    return rules


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)


def verdict(rules: list[Rule]) -> Column:
    """True to keep: the first rule that fires rejects."""
    out = F.lit(True)
    for rule in reversed(rules):
        fires = F.lit(True)
        for test in rule:
            fires &= test.expression()
        out = F.when(fires, False).otherwise(out)
    return out


def learn_rules(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> list[Rule]:
    """Rules from at most ``max_labelled`` labelled documents (those that the
    base rules keep teach the rest)."""
    chosen = (
        labels.filter("doc_id is not null and quality is not null")
        .select(F.col("doc_id").alias("_id"), "quality")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "quality")
        .limit(max_labelled)
    )
    rows = statistics(docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).drop("_id"))
    table = rows.filter(~base_failed()).select("doc_id", "quality", *[ratio(r[0]).alias(r[0]) for r in RATIOS])
    known = sorted(table.collect())
    x = {r[0]: np.array([row[i + 2] for row in known], float) for i, r in enumerate(RATIOS)}
    bad = np.array([row["quality"] == 0 for row in known], bool)
    return learn(x, bad) if bad.any() and not bad.all() else []


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """``docs`` with the statistics, ``base_failed`` and ``kept``."""
    rated = statistics(docs.drop("base_failed", "kept"))
    return rated.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & verdict(rules))
