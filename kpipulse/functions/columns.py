"""Scalar Column builders shared by the operators (all JVM-side expressions)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..contract import ISO_MILLIS_FORMAT


def parse_event_ts(c: Column | str) -> Column:
    """ISO-8601 text -> TIMESTAMP: the contract format first, then Spark's default
    parser, else null. ``try_to_timestamp`` keeps bad text from failing the job
    under ANSI mode (plain ``to_timestamp`` throws on Spark 4)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.try_to_timestamp(c, F.lit(ISO_MILLIS_FORMAT)), F.try_to_timestamp(c))


def guarded_ratio(num: Column | str, den: Column | str) -> Column:
    """num / den when den > 0, else 0.0 (double)."""
    num = F.col(num) if isinstance(num, str) else num
    den = F.col(den) if isinstance(den, str) else den
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def holds(pred: Column) -> Column:
    """Two-valued truth of a predicate: null counts as false."""
    return F.coalesce(pred, F.lit(False))


def all_of(preds: list[Column]) -> Column:
    """AND of a list of predicates; true for an empty list."""
    return reduce(lambda a, b: a & b, preds, F.lit(True))


def to_iso_z(c: Column | str) -> Column:
    """Timestamp -> ``yyyy-MM-ddTHH:mm:ssZ`` text (microseconds when present)."""
    c = F.col(c) if isinstance(c, str) else c
    whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(c, "SSSSSS")
    return F.concat(whole, F.when(micros != F.lit("000000"), F.concat(F.lit("."), micros)).otherwise(F.lit("")), F.lit("Z"))


def alert_id(rule: Column | str, metric: Column | str, ts: Column | str) -> Column:
    """Deterministic alert id ``rule:metric:yyyy-MM-ddTHH:mm:ss`` (no zone)."""
    rule = F.lit(rule) if isinstance(rule, str) else rule
    metric = F.col(metric) if isinstance(metric, str) else metric
    ts = F.col(ts) if isinstance(ts, str) else ts
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(ts, "SSSSSS")
    iso = F.concat(whole, F.when(micros != F.lit("000000"), F.concat(F.lit("."), micros)).otherwise(F.lit("")))
    return F.concat_ws(":", rule, metric, iso)
