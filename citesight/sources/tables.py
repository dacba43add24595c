"""Scans and sinks.

Tables are read with declared schemas (no inference) and handed off between
stages as Parquet.  Delimited text is supported only at the edges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .schemas import MART, check_schema


def read_table(spark: SparkSession, path: str, schema: StructType | str | None = None,
               fmt: str = "parquet", columns: Sequence[str] | None = None, **options) -> DataFrame:
    """Read a typed table.  ``columns`` prunes at the scan."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    for k, v in options.items():
        reader = reader.option(k, v)
    df = reader.load(path)
    return df.select(*columns) if columns else df


def read_text_table(spark: SparkSession, path: str, schema: StructType | str,
                    encoding: str = "ISO-8859-1", partitions: int | None = None) -> DataFrame:
    """Delimited text with a header, quoted multi-line fields and a given
    encoding, read range by range (``quoted.scan_quoted``).  The columns are
    taken in the order of ``schema``; a value that is not of its type is NULL.
    ``partitions`` spreads the rows over so many tasks."""
    from .quoted import scan_quoted
    kinds = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    rows = scan_quoted(spark, path, encoding)
    names = [*rows.columns, *[None] * (len(kinds.fields) - len(rows.columns))]
    df = rows.select(*[(F.lit(None).cast(f.dataType) if n is None else F.col(f"`{n}`").try_cast(f.dataType)).alias(f.name)
                       for n, f in zip(names, kinds.fields)])
    return df.repartition(partitions) if partitions else df


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
                mode: str = "overwrite") -> None:
    """Create or replace a Parquet table (optionally partitioned)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_text_table(df: DataFrame, path: str, mode: str = "overwrite", encoding: str = "UTF-8") -> None:
    """Overwriting delimited sink with a header line; quotes are doubled."""
    df.write.mode(mode).options(header=True, escape='"', encoding=encoding).csv(path)


def load_mart(spark: SparkSession, path: str, schema: StructType | None = MART) -> DataFrame:
    """Scan of a mart stored as Parquet; its columns must be those of ``schema``."""
    df = spark.read.parquet(path)
    return df if schema is None else check_schema(df, schema)


def tpch(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """One of the driver's test tables, pruned to ``columns`` at the scan."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread CPU-heavy row work (regex clean-up, tokenising) over the cluster
    when the scan yields fewer partitions than there are cores -- e.g. one
    unsplittable file.  Inputs that already have enough partitions are left
    as they are (no shuffle)."""
    try:
        want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - no RDD view (Spark Connect): leave as is
        return df
    return df.repartition(want) if have < want else df
