"""Report tables (data behind each chart; drawing is not part of the library)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codes import node_category, transition_category
from ..functions.numeric import marker_size, round_half_even
from .aggregates import district_stats, group_size
from .joins import lookup


def district_map(mart: DataFrame, coords: DataFrame, district: str, serious: Sequence[str]) -> DataFrame:
    """District statistics with coordinates, statewide shares (1 decimal,
    half-even), serious rate and bubble size.  Shares are over districts
    only (rows without a district are not in the denominators)."""
    from ..session import materialize
    st = materialize(district_stats(mart, district, serious))  # one row per district
    tot = st.agg(F.sum("total_actions").alias("a"), F.sum("serious_citations").alias("s")).first()
    all_actions, all_serious = F.lit(tot["a"]), F.lit(tot["s"])
    out = lookup(st, coords, district)
    share = round_half_even(F.col("total_actions") * F.lit(100.0) / all_actions, 1)
    return out.select(
        "*",
        share.alias("citation_share_pct"),
        round_half_even(F.try_divide(F.col("serious_citations") * F.lit(100.0), all_serious.cast("double")),
                        1).alias("serious_share_pct"),
        marker_size(share).alias("size_scaled"),
        round_half_even(F.try_divide(F.col("serious_citations") * F.lit(100.0),
                                     F.col("total_actions").cast("double")), 1).alias("serious_rate"))


def district_coordinates(spark: SparkSession, coords: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Look-up table of district offices, ``DISTRICT_OFFICE, lat, lon``."""
    rows = [(name, lat, lon) for name, (lat, lon) in coords.items()]
    return spark.createDataFrame(rows, "DISTRICT_OFFICE string, lat double, lon double")


def map_points(districts: DataFrame) -> DataFrame:
    """The districts that can be drawn: those with coordinates."""
    return districts.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())


def transitions(mart: DataFrame, start: str, end: str, keep: Sequence[str],
                min_count: int = 3) -> DataFrame:
    """Class transitions start -> end that changed, from the listed start
    classes, seen at least ``min_count`` times."""
    g = group_size(mart, [start, end])
    return g.where((F.col(start) != F.col(end)) & F.col(start).isin(list(keep))
                   & (F.col("count") >= min_count))


def flow_graph(trans: DataFrame, start: str, end: str, removed: Sequence[str], dropped: str,
               severe: Sequence[str], suffix: str = " (Initial)") -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of the transition flow.

    Nodes: the start labels (with ``suffix``) first, then the end labels, each
    side in label order; ids are 0-based positions in that order.  Edges carry
    the count and an outcome category.  The transition table is small (at most
    one row per class pair), so the ranking windows run over few rows.
    """
    from pyspark.sql import Window

    from ..session import materialize
    trans = materialize(trans)  # at most one row per class pair; read five times below
    # End labels are listed in order of first appearance in the (start, end)
    # sorted transition table: by their smallest start class, then label.
    src = (trans.select(F.concat(F.col(start), F.lit(suffix)).alias("label")).distinct()
           .withColumn("side", F.lit(0)).withColumn("_o", F.col("label")))
    dst = (trans.groupBy(F.col(end).alias("label")).agg(F.min(start).alias("_o"))
           .withColumn("side", F.lit(1)))
    nodes = src.unionByName(dst)
    nodes = nodes.withColumn("id", (F.row_number().over(Window.orderBy("side", "_o", "label")) - 1).cast("int"))
    nodes = nodes.withColumn("category", node_category(F.col("label"), severe, removed, dropped,
                                                        suffix.strip()))
    # no hint: the node table's size is only known at run time, where AQE
    # measures it and broadcasts it when small
    ns = nodes.where(F.col("side") == 0).select(F.col("label").alias("_sl"), F.col("id").alias("source"))
    nt = nodes.where(F.col("side") == 1).select(F.col("label").alias("_tl"), F.col("id").alias("target"))
    e = trans.withColumn("_sl", F.concat(F.col(start), F.lit(suffix))).withColumn("_tl", F.col(end))
    edges = (e.join(ns, "_sl").join(nt, "_tl")
             .select("source", "target", F.col("count").alias("value"),
                     transition_category(F.col(end), removed, dropped).alias("category")))
    return nodes.select("id", "label", "side", "category"), edges
