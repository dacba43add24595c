"""Typed scans that account for what they could not read.

A value that is not of its column's type becomes NULL, and its text goes to a
rescue column, a map from column to text; ``count_rejects`` counts the entries
while the rows are written (an observation, no pass of its own).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESCUED = "_RESCUED"


def rescued(pairs: Sequence[tuple[str, Column, Column]]) -> Column:
    """The map of (column, text, value) whose text is not blank but whose value is NULL."""
    entries = F.array(*[F.when(value.isNull() & (F.trim(text.cast("string")) != ""),
                               F.struct(F.lit(name).alias("key"), text.cast("string").alias("value"))) for name, text, value in pairs])
    return F.map_from_entries(F.filter(entries, lambda e: e.isNotNull()))


def no_rejects() -> Column:
    return F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))


def merge(*maps: Column) -> Column:
    """Rescue maps of successive steps together; the earliest text of a column stays."""
    out = maps[0]
    for m in maps[1:]:
        have = out
        out = F.map_concat(have, F.map_filter(m, lambda k, _: ~F.map_contains_key(have, k)))
    return out


def typed_scan(df: DataFrame, schema: T.StructType, required: Sequence[str] = (), rescue: bool = True) -> DataFrame:
    """The columns of ``schema``, cast; a missing one is NULL unless it is
    ``required``.  With ``rescue`` the text of values that could not be cast is kept."""
    missing = [c for c in required if c in schema.fieldNames() and c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    cast = {f.name: F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)
            for f in schema.fields}
    out = [c.alias(n) for n, c in cast.items()]
    if rescue:
        tried = [(f.name, F.col(f"`{f.name}`"), cast[f.name]) for f in schema.fields
                 if f.name in df.columns and not isinstance(f.dataType, T.StringType)]
        out.append((rescued(tried) if tried else no_rejects()).alias(RESCUED))
    return df.select(*out)


def count_rejects(df: DataFrame, columns: Sequence[str], name: str = "rejects") -> tuple[DataFrame, Observation]:
    """``df`` without the rescue column, and the observation that counts its
    rows (``rows``) and the rejects of each column as ``df`` is written."""
    seen = Observation(name)
    counts = [F.count_if(F.map_contains_key(F.col(RESCUED), F.lit(c))).alias(c) for c in columns]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts).drop(RESCUED), seen


def reject_report(df: DataFrame) -> DataFrame:
    """(column, rejected, texts): how many values of each column were not read,
    and how many different texts they had."""
    return (df.select(F.explode(RESCUED).alias("column", "text")).groupBy("column")
            .agg(F.count("*").alias("rejected"), F.count_distinct("text").alias("texts")))
