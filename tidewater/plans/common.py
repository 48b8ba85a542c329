"""Shared pieces of the registered query plans: fixed clocks and table access."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.sources.tables import read_table

# The clocks the registered queries run at (jobs never read the
# wall clock).  Events span January 2024; orders start in 1995.
EVENTS_AS_OF = "2024-01-31 00:00:00"
ETL_AS_OF = "1996-01-03 00:00:00"
LAKE_AS_OF = "2024-02-01 00:00:00"


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return read_table(spark, sf_dir, name)


# Registered outputs carry times as ISO text, as the reference stores them;
# this also keeps the comparison with the SQL oracle type-exact.
def ts_text(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def day_text(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.date_format(col, "yyyy-MM-dd")
