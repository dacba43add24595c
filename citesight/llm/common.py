"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

#: Small tables (one row per source, host suffix ...) are broadcast only when
#: a count proves that they have at most this many rows.
BROADCAST_ROWS = 10_000


def bounded(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` written once and marked for broadcast if it is proven small;
    otherwise as it is, for a shuffled join."""
    kept = materialize(df)
    return F.broadcast(kept) if kept.limit(max_rows + 1).count() <= max_rows else kept


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def hash60(c: Column) -> Column:
    """The first 60 bits of the md5 of a string, as a long (SQL-expressible)."""
    return F.conv(F.substring(F.md5(c), 1, 15), 16, 10).cast("long")


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
