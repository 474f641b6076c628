"""kpipulse: event KPI and anomaly engine on Spark DataFrames.

Stages (each a plain DataFrame -> DataFrame function, batch and stream):

* ``operators.bronze``   topic envelope -> typed event rows
* ``operators.validate`` nine data-quality rules, valid / quarantine split
* ``operators.dedupe``   keep one row per event id
* ``operators.kpis``     ten KPIs per event-time window, wide and long
* ``operators.detect``   EWMA baseline, rolling z-score, severity, cooldown
* ``operators.serve``    range, latest-value and alert reads
* ``operators.tables``   idempotent table writers (window replace, insert-if-absent)
"""

__version__ = "0.1.0"
