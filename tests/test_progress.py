"""Progress of streaming queries as a table."""

import datetime as dt

from core_helpers import SF001, envelope_rows
from pyspark.sql import functions as F
from test_streaming import _event

from kpipulse.operators import validate as V
from kpipulse.plans import pipeline as P
from kpipulse.streaming import jobs as J
from kpipulse.streaming import runs as R
from kpipulse.streaming.progress import ProgressLog, read_progress, rule_counts


def test_progress_records_late_rows_state_and_rules(spark):
    paths = R.new_paths(spark, "progress")
    R.configure(spark)
    t0 = dt.datetime(2024, 1, 1, 12, 0)
    later = t0 + dt.timedelta(hours=3)
    for i, evs in enumerate([[_event("a", t0), "not json"], [_event("b", later)], [_event("d", later)], [_event("late", t0), _event("late2", t0), _event("c", later)]]):
        envelope_rows(spark, evs, start_offset=10 * i).coalesce(1).write.mode("append").parquet(paths.topic)
        R.run_stream_pipeline(spark, SF001, paths, stages=("bronze",), land=False)
    log = f"{paths.root}/progress"
    assert read_progress(spark, log).count() == 0
    # one file per Bronze batch and date folder: a batch for each
    bronze = J.parquet_stream(spark, paths.bronze, J.BRONZE_READ_SCHEMA, max_files_per_trigger=1)
    with ProgressLog(spark, log):
        good, bad = J.silver_queries(bronze, paths.silver, paths.quarantine, paths.ckpt("s"), paths.ckpt("q"), watermark="15 minutes", by_hour=False)
        good.awaitTermination()
        bad.awaitTermination()
    mine = {r.batch_id: r for r in read_progress(spark, log, good.id).collect()}
    assert sum(r.n_late for r in mine.values()) == 2 and sum(r.n_input for r in mine.values()) == 7
    assert max(r.state_rows for r in mine.values()) > 0
    rules = rule_counts(read_progress(spark, log, bad.id))
    want = V.error_counts(V.validate(spark.read.option("basePath", paths.bronze).parquet(paths.bronze)))
    key = lambda df: sorted(tuple(r) for r in df.collect())
    assert key(rules) == key(want) and len(key(want)) > 1
    # the listener is gone: a later query leaves no record
    before = read_progress(spark, log).count()
    P.validated(spark, SF001).agg(F.count("*")).collect()
    assert read_progress(spark, log).count() == before
