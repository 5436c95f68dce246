"""The driver tables seen as filings, holdings, item facts, mapping and catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.asof import CIK_WIDTH, GVK_WIDTH
from tidemark.functions.conform import pad_key
from tidemark.sources.tables import read_table

# The five priorities stand in for form types, grouped into two families.
FORM_TYPES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
FORM_FAMILIES = {"fast": FORM_TYPES[:2], "slow": FORM_TYPES[2:]}


def filings(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("uuid"),
        F.col("o_custkey").alias("cik"),
        F.col("o_orderdate").alias("filing_date"),
        F.col("o_orderpriority").alias("form_type"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("total"),
    )


def holding_lines(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("uuid"),
        F.col("l_partkey").alias("cusip"),
        F.col("l_linenumber").alias("line"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_returnflag").alias("put_call"),
        F.col("l_linestatus").alias("line_status"),
        F.col("l_shipdate").alias("form_availability_timestamp"),
    )


def item_facts(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "events").select(
        F.col("event_id").alias("form_uuid"),
        F.col("user_id").alias("cik"),
        F.col("event_type").alias("item_name"),
        F.col("value").alias("item_value"),
        F.col("ts").alias("filing_date"),
        F.col("ts").alias("form_availability_timestamp"),
    )


def catalog(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "part").select(
        F.col("p_partkey").alias("payload_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("commodity"),
        F.col("p_brand").alias("business_category"),
        F.col("p_size").cast("string").alias("country"),
        F.regexp_extract("p_name", r"(\S+)$", 1).alias("frequency"),
    )


def filers(spark: SparkSession, folder: str) -> DataFrame:
    """Filer attributes; the segment stands in for the ticker."""
    return read_table(spark, folder, "customer").select(
        pad_key("c_custkey", CIK_WIDTH).alias("cik"),
        F.col("c_mktsegment").alias("ticker"),
        F.col("c_name").alias("company"),
    )


def id_map(spark: SparkSession, folder: str) -> DataFrame:
    """Company key of a filer, renewed with its first filing of each year.

    Filings are reduced to one row per filer and year before the window, which
    then orders a filer's few years.
    """
    yearly = (
        read_table(spark, folder, "orders")
        .groupBy("o_custkey", F.year("o_orderdate").alias("year"))
        .agg(F.min("o_orderdate").alias("effdate"), F.min("o_orderkey").alias("gvk"))
    )
    following = F.lead("effdate").over(Window.partitionBy("o_custkey").orderBy("year"))
    last_second = following - F.expr("INTERVAL 1 SECOND")
    open_end = F.lit("2100-12-31").cast("timestamp_ntz")
    return yearly.withColumn("thrudate", F.coalesce(last_second, open_end)).select(
        pad_key("o_custkey", CIK_WIDTH).alias("cik"),
        "effdate",
        "thrudate",
        pad_key("gvk", GVK_WIDTH).alias("gvk"),
    )


# The same mapping for the SQL equivalents.
ID_MAP_SQL = """
  SELECT CASE WHEN length(o_custkey::VARCHAR) < 10
              THEN lpad(o_custkey::VARCHAR, 10, '0') ELSE o_custkey::VARCHAR END AS cik,
         effdate,
         coalesce(lead(effdate) OVER (PARTITION BY o_custkey ORDER BY yr) - INTERVAL 1 SECOND,
                  TIMESTAMP '2100-12-31') AS thrudate,
         CASE WHEN length(g::VARCHAR) < 6 THEN lpad(g::VARCHAR, 6, '0') ELSE g::VARCHAR END AS gvk
  FROM (SELECT o_custkey, year(o_orderdate) AS yr, min(o_orderdate) AS effdate,
               min(o_orderkey) AS g
        FROM orders GROUP BY 1, 2)
"""
