"""Odd rows, small tables and word splitting shared by the operator tests."""

import os
import re

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SPACE = "\x20\x09-\x0d"
SF001 = "/root/testdata/sf0.001"


def words_of(text):
    return re.findall(f"[^{SPACE}]+", text or "")


LONG = " ".join("abcdefghij"[i % 7] * (1 + i % 5) + "klmnopqrst"[i * i % 10] + "uvwxyz"[i // 5 % 6] * (1 + i % 31 % 4) for i in range(30_000))
BODY = "the quick brown fox jumps over a lazy dog while seven wizards quietly mix fresh potions under the old stone bridge at dawn"

# id, text: nulls, blanks, a very long text, copies, repeated rows and ids
ODD = [
    (1, None),
    (2, ""),
    (3, " \t\n \x0b\x0c\r"),
    (4, LONG),
    (5, LONG),
    (6, BODY),
    (6, BODY),
    (6, BODY + " and then some more words follow here"),
    (7, BODY.upper()),
    (None, BODY),
    (None, "a null id é \U0001f600 end"),
    (8, "one"),
    (9, "one"),
    (10, "a b c d"),
    (11, "\n".join(["same line here"] * 30)),
    (12, "x" * 100_000),
]


def sf001(spark, name):
    return spark.read.parquet(f"{SF001}/{name}.parquet")


def small(spark):
    """The rows of the small documents table."""
    return [(r["doc_id"], r["text"]) for r in sf001(spark, "documents").select("doc_id", "text").collect()]
