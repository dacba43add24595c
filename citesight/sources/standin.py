"""Stand-in penalty tables derived from the driver's TPC-H-like tables.

The original inputs (penalty records, a facility-type lookup, narratives) are
not part of the test data, so these adapters derive tables of the same shape
from ``lineitem`` x ``orders`` x ``customer`` x ``nation`` x ``part`` and
``documents``.  Every row of the source tables becomes a row here, so the
work grows with them.  A few deterministic perturbations (tabs, NBSP, odd
case, NULLs, bad dates, empty list items) give the cleaning rules something to
do; they depend only on ``l_linenumber`` and are mirrored in the SQL oracle.

Grain and meaning (line-item grain):

======================  ==============================================
EVENTID                 order key
FACID                   customer key (text)
FACILITY_NAME           customer name
FAC_TYPE_CODE           market segment
DISTRICT_OFFICE         nation name
PENALTY_NUMBER          "<orderkey>-<linenumber>" (not unique)
PENALTY_ISSUE_DATE      ship date as text
PENALTY_TYPE            order priority
PENALTY_CATEGORY        part name
PENALTY_DETAIL          part type
CLASS_ASSESSED_INITIAL  return flag
CLASS_ASSESSED_FINAL    order status
DEATH_RELATED           return flag R -> 'Y', A -> 'N'
APPEALED                line status F -> 'Yes', else 'No'
TOTAL_* money           extended price / account balance
PRIORITY_ALL            priority letter and return flag as a list
======================  ==============================================
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import presets
from ..operators.joins import broadcast_if_small
from .tables import spread, tpch

TAB = "\t"
NBSP = " "
BAD_DATE = "31/31/2020"


def literal_rows(spark: SparkSession, rows, names) -> DataFrame:
    """A small all-string table from literal rows, built JVM-side (no Python
    data transfer); Spark knows its exact size."""
    structs = [F.struct(*[F.lit(v).cast("string").alias(n) for v, n in zip(r, names)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def _ln(k: int) -> Column:
    return F.col("l_linenumber") == k


def penalty_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined line-item rows the stand-in tables are made of.

    ``nation`` (25 rows in the TPC-H layout) is broadcast after a bounded
    size check; the other joins are left to the planner, which broadcasts a
    side only when its measured size is under the threshold and otherwise
    shuffles both sides on the key.
    """
    li = tpch(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_linenumber",
              "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate")
    o = tpch(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus",
             "o_orderdate", "o_orderpriority")
    c = tpch(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_acctbal",
             "c_mktsegment")
    n = tpch(spark, sf_dir, "nation", "n_nationkey", "n_name")
    p = tpch(spark, sf_dir, "part", "p_partkey", "p_name", "p_type")
    # orders x customer first (order grain), so the line-item-sized rows are
    # shuffled only twice (on order key, then on part key)
    oc = (o.join(c, F.col("o_custkey") == F.col("c_custkey"))
          .join(broadcast_if_small(n, 10_000), F.col("c_nationkey") == F.col("n_nationkey")))
    return (li.join(oc, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(p, F.col("l_partkey") == F.col("p_partkey")))


def raw_enforcement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw penalty records (text as it arrives, money as decimal)."""
    b = penalty_base(spark, sf_dir)
    facid = F.col("o_custkey").cast("string")
    seg = F.col("c_mktsegment")
    pnum = F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
    code = F.substr(F.lit("ABCDE"), F.substr("o_orderpriority", F.lit(1), F.lit(1)).cast("int"), F.lit(1))
    flag = F.col("l_returnflag")
    money = F.col("l_extendedprice").cast("decimal(18,2)")
    return b.select(
        F.col("l_orderkey").cast("string").alias("EVENTID"),
        F.when(_ln(5), F.concat(F.lit(" "), facid, F.lit(" "))).otherwise(facid).alias("FACID"),
        F.col("c_name").alias("FACILITY_NAME"),
        F.when(_ln(1), F.concat(F.lit(" "), F.lower(seg), F.lit(TAB)))
         .when(_ln(2), F.concat(seg, F.lit(NBSP))).otherwise(seg).alias("FAC_TYPE_CODE"),
        F.col("c_nationkey").cast("string").alias("FAC_FDR"),
        F.col("n_name").alias("DISTRICT_OFFICE"),
        F.when(_ln(3), F.concat(pnum, F.lit(" "))).otherwise(pnum).alias("PENALTY_NUMBER"),
        F.when(_ln(7), F.lit(BAD_DATE))
         .when(_ln(3), F.date_format("l_shipdate", "yyyyMMdd"))
         .when(_ln(4), F.date_format("l_shipdate", "yyyy/MM/dd"))
         .when(_ln(5), F.date_format("l_shipdate", "d MMMM yyyy"))
         .when(_ln(6), F.concat(F.date_format("l_shipdate", "M/d/yyyy"), F.lit(" 1:30 PM")))
         .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("PENALTY_ISSUE_DATE"),
        F.date_format("o_orderdate", "MM/dd/yyyy").alias("VIOLATION_FROM_DATE"),
        F.col("o_orderpriority").alias("PENALTY_TYPE"),
        F.col("p_name").alias("PENALTY_CATEGORY"),
        F.when(_ln(4), F.concat(F.lit(" "), F.col("p_type"), F.lit(TAB + TAB)))
         .otherwise(F.col("p_type")).alias("PENALTY_DETAIL"),
        F.col("l_linestatus").alias("DISPOSITION"),
        F.when(_ln(4), F.concat(flag, F.lit(TAB)))
         .when(_ln(6), F.concat(F.lit(" "), flag)).otherwise(flag).alias("CLASS_ASSESSED_INITIAL"),
        F.when(_ln(2), F.concat(F.col("o_orderstatus"), F.lit(TAB)))
         .otherwise(F.col("o_orderstatus")).alias("CLASS_ASSESSED_FINAL"),
        F.when(flag == "R", F.when(_ln(5), F.lit("y")).otherwise(F.lit("Y")))
         .when(flag == "A", F.lit("N")).alias("DEATH_RELATED"),
        F.when(_ln(6) & (flag == "N"), F.lit(None).cast("string"))
         .when(F.col("l_linestatus") == "F", F.lit("Yes")).otherwise(F.lit("No")).alias("APPEALED"),
        money.alias("TOTAL_AMOUNT_INITIAL"),
        money.alias("TOTAL_AMOUNT_DUE_FINAL"),
        F.when(_ln(3), F.lit(None).cast("decimal(18,2)")).otherwise(money).alias("TOTAL_BALANCE_DUE"),
        F.col("c_acctbal").cast("decimal(18,2)").alias("TOTAL_PENALTY_OFFSET_AMOUNT"),
        F.when(_ln(7), F.lit(None).cast("string"))
         .when(_ln(6), F.concat(flag, F.lit(",,"), code))
         .otherwise(F.concat(code, F.lit(", "), flag)).alias("PRIORITY_ALL"),
    )


def raw_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lookup table: one facility-type row per market segment found in
    ``customer`` (segments without a definition get no row), the class rows,
    and the repeated header rows a spreadsheet export carries."""
    defs = literal_rows(spark, list(presets.STANDIN_SEGMENT_DEFINITIONS.items()), ["seg", "DEFINITION"])
    segs = tpch(spark, sf_dir, "customer", "c_mktsegment").distinct()
    fac = (segs.join(F.broadcast(defs), F.col("c_mktsegment") == F.col("seg"))
           .select(F.lit("FAC_TYPE_CODE").alias("VARIABLE"),
                   F.concat(F.lit(" "), F.col("seg"), F.lit(TAB)).alias("VALUE"),
                   F.initcap("seg").alias("DESCRIPTION"), "DEFINITION"))
    names = ["VARIABLE", "VALUE", "DESCRIPTION", "DEFINITION"]
    cls = literal_rows(spark, [("Class_Assessed_Final", f"C_{d}", d, None)
                               for d in presets.STANDIN_CLASS_DESCRIPTIONS], names)
    headers = literal_rows(spark, [("VARIABLE", "VALUE", "DESCRIPTION", "DEFINITION"),
                                   ("VARIABLE  ", "VALUE", "DESCRIPTION", "DEFINITION"),
                                   (None, "NULLVAR", "no variable", "kept: a NULL variable is not a header")],
                           names)
    return fac.unionByName(cls).unionByName(headers)


def raw_narratives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Narratives from ``documents``: whole texts with code-like prefixes and
    a lower-case facility name to title-case."""
    d = spread(tpch(spark, sf_dir, "documents", "doc_id", "text", "lang", "source", "n_chars"))
    did = F.col("doc_id")
    codes = F.concat(
        F.lit("F"), (F.lit(1000) + did % 9000).cast("string"), F.lit(" ART"),
        (F.col("n_chars") % 100).cast("string"), F.lit(" (ref "), F.col("source"), F.lit(") "),
        F.lit("DIV"), (did % 7).cast("string"), F.lit(" T"), F.lpad((did % 100).cast("string"), 2, "0"),
        F.lit(" "))
    return d.select(
        did.cast("string").alias("FACID"),
        F.concat(F.lower("source"), F.lit("'s "), F.col("lang"), F.lit(" 3rd st.")).alias("FACILITY_NAME"),
        F.concat(F.lit(" "), did.cast("string")).alias("PENALTY_NUMBER"),
        F.lit("A").alias("CLASS_ASSESSED_INITIAL"),
        F.concat((did % 12 + 1).cast("string"), F.lit("/"), (did % 28 + 1).cast("string"), F.lit("/2020"))
        .alias("PENALTY_ISSUE_DATE"),
        did.cast("string").alias("EVENTID"),
        F.concat(codes, F.col("text"), F.lit(" CH"), (did % 50).cast("string")).alias("NARRATIVE"),
    )


def coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """District coordinates for the stand-in districts (nations), by a fixed
    rule on the nation and region keys."""
    n = tpch(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    return n.select(
        F.col("n_name").alias("DISTRICT_OFFICE"),
        (F.lit(32.5) + F.col("n_nationkey") * F.lit(0.25)).alias("lat"),
        (F.lit(-124.0) + F.col("n_regionkey") * F.lit(1.5)).alias("lon"))
