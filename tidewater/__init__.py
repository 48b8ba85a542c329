"""tidewater: keyed-stream metrics, daily ETL, lake zones, event-state folds,
chat fan-out, document and media annotation jobs expressed as Spark
DataFrame / Structured Streaming plans.

Every job is a plain function over DataFrames.  Wall-clock time never enters
the logic: jobs take an ``as_of`` argument instead.
"""

from tidewater.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
