"""Silver validation: the nine data-quality rules, reasons string and split.

Rules are data: a list of ``Rule(code, fails)`` where ``fails`` builds a
two-valued Column (never null). ``validate`` appends ``validation_errors`` (the
comma-joined codes of the rules that fire, in list order, ``""`` when none)
and ``is_valid``. The whole thing is one projection: no shuffle, no Python.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import contract as C
from ..functions.columns import holds, parse_event_ts


@dataclass(frozen=True)
class Rule:
    code: str
    fails: Callable[[], Column]


def _col(name: str) -> Column:
    return F.col(name)


def _type_is(*types: str) -> Column:
    return holds(_col("event_type").isin(*types))


def _present(name: str) -> Column:
    return _col(name).isNotNull()


def _cart_ok() -> Column:
    return holds(
        _present("quantity") & (_col("quantity") >= 1) & _present("price") & (_col("price") >= 0) & _present("currency")
    )


def _purchase_ok() -> Column:
    return holds(
        _present("order_id")
        & _present("quantity")
        & (_col("quantity") >= 1)
        & _present("price")
        & (_col("price") >= 0)
        & _present("currency")
    )


def default_rules(null_type: str = "invalid") -> list[Rule]:
    """The contract's nine rules, in code order.

    ``null_type="invalid"`` (default, as documented) makes a null event type
    fire ``invalid_event_type``; ``"pass"`` lets it through, as a plain
    ``NOT isin`` does under three-valued logic.
    """
    if null_type not in ("invalid", "pass"):
        raise ValueError("null_type must be 'invalid' or 'pass'")
    if null_type == "invalid":
        bad_type = lambda: ~_type_is(*C.EVENT_TYPES)
    else:
        bad_type = lambda: _col("event_type").isNotNull() & ~_type_is(*C.EVENT_TYPES)
    return [
        Rule(C.ERR_MISSING_EVENT_ID, lambda: _col("event_id").isNull()),
        Rule(C.ERR_INVALID_EVENT_TYPE, bad_type),
        Rule(C.ERR_MISSING_USER_ID, lambda: _col("user_id").isNull()),
        Rule(C.ERR_MISSING_SESSION_ID, lambda: _col("session_id").isNull()),
        Rule(C.ERR_BAD_INGEST_TIME, lambda: _col("ingest_time_ts").isNull()),
        Rule(C.ERR_BAD_EVENT_TIME, lambda: _col("event_time_ts").isNull()),
        Rule(C.ERR_PRODUCT_FOR_CLICK_CART, lambda: _type_is("click", "add_to_cart") & _col("product_id").isNull()),
        Rule(C.ERR_CART_FIELDS, lambda: _type_is("add_to_cart") & ~_cart_ok()),
        Rule(C.ERR_PURCHASE_FIELDS, lambda: _type_is("purchase") & ~_purchase_ok()),
    ]


def with_times(bronze: DataFrame) -> DataFrame:
    """Parse the event time, parse the ingest time unless Bronze already
    carries it (same parser, same value), and stamp the processing time."""
    out = bronze.withColumn("event_time_ts", parse_event_ts("event_time"))
    if "ingest_time_ts" not in bronze.columns:
        out = out.withColumn("ingest_time_ts", parse_event_ts("ingest_time"))
    return out.withColumn("processing_time", F.current_timestamp())


def reasons(rules: list[Rule]) -> Column:
    """Comma string of the codes of firing rules; ``""`` when none fires."""
    return F.concat_ws(",", *[F.when(r.fails(), F.lit(r.code)) for r in rules])


def validate(df: DataFrame, rules: list[Rule] | None = None, parse_times: bool = True) -> DataFrame:
    """Append ``validation_errors`` and ``is_valid``.

    With ``parse_times`` the event and ingest times are parsed first (the rules
    read ``event_time_ts`` / ``ingest_time_ts``). Rules may reference any
    column, so custom rule lists validate other tables as well.
    """
    rules = default_rules() if rules is None else rules
    if parse_times:
        df = with_times(df)
    df = df.withColumn("validation_errors", reasons(rules))
    return df.withColumn("is_valid", F.col("validation_errors") == F.lit(""))


def quarantine(validated: DataFrame) -> DataFrame:
    """Invalid rows in the quarantine layout, partitioned by ingest date / hour
    (null when the ingest time is bad)."""
    return (
        validated.filter(~F.col("is_valid"))
        .withColumn("ingest_date", F.to_date("ingest_time_ts"))
        .withColumn("ingest_hour", F.hour("ingest_time_ts"))
        .select(*C.QUARANTINE_COLUMNS)
    )


def valid_rows(validated: DataFrame) -> DataFrame:
    """Valid rows with event-time partition columns, flags dropped."""
    return (
        validated.filter(F.col("is_valid"))
        .withColumn("event_date", F.to_date("event_time_ts"))
        .withColumn("event_hour", F.hour("event_time_ts"))
        .drop("validation_errors", "is_valid")
    )


def error_counts(validated: DataFrame) -> DataFrame:
    """Rows per error code: explode the reasons and count (partial + final
    hash aggregate, so a hot code is combined map-side)."""
    return (
        validated.filter(~F.col("is_valid"))
        .select(F.explode(F.split("validation_errors", ",")).alias("error_code"))
        .groupBy("error_code")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
