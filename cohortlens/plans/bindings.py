"""Views of the given tables in the roles the operators expect, and the same views as SQL text.

``unit``: one row per order, grouped by customer. ``docs``: labelled documents grouped by source.
``events``: one row per event, grouped by user.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortlens.operators.enrich import add_prior_year, yearly_counts, yearly_rates


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """25 nations with their region: a table of fixed size."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", F.col("n_name").alias("state"), F.col("r_name").alias("region")
    )


def unit_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer's attributes; joins only, no aggregates."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    rows = orders.join(customer, orders.o_custkey == customer.c_custkey).join(
        F.broadcast(places(spark, sf_dir)), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return rows.select(
        F.col("o_orderkey").alias("row_id"),
        F.col("o_custkey").cast("string").alias("group_id"),
        "state",
        "region",
        F.col("o_orderpriority").alias("network"),
        F.when(F.col("o_orderstatus") == "F", F.lit(1.0)).otherwise(F.lit(0.0)).alias("y"),
        F.year("o_orderdate").alias("year"),
        F.col("o_totalprice").alias("weight"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("acctbal"),
        F.col("c_mktsegment").alias("segment"),
        (F.col("c_nationkey") % 2 == 0).alias("is_even_nation"),
        F.lit(2).alias("grade"),
        F.lit(None).cast("double").alias("lag1_empty"),
        F.round(F.col("o_totalprice") / F.lit(1000000), 3).alias("score"),
    )


UNIT_BASE_SQL = """
unit_base AS (
  SELECT o_orderkey AS row_id, CAST(o_custkey AS VARCHAR) AS group_id, n_name AS state, r_name AS region,
         o_orderpriority AS network,
         CASE WHEN o_orderstatus = 'F' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS y,
         CAST(year(o_orderdate) AS INTEGER) AS year, o_totalprice AS weight,
         CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS acctbal, c_mktsegment AS segment,
         (c_nationkey % 2 = 0) AS is_even_nation, 2 AS grade, CAST(NULL AS DOUBLE) AS lag1_empty,
         round(o_totalprice / 1000000, 3) AS score
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""


def unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide unit table: base columns, prior-year rates of the group and of the state, goals in percent."""
    base = unit_base(spark, sf_dir)
    counts = yearly_counts(base, ["group_id", "state"])
    rows = add_prior_year(base, yearly_rates(counts, ["group_id"], "rate"), ["group_id"], "rate")
    # 25 states x the years of the data: far below any broadcast limit
    state = yearly_rates(counts, ["state"], "lag1_state_rate").withColumn("year", F.col("year") + 1).drop("n")
    rows = rows.join(F.broadcast(state), ["state", "year"], "left")
    return rows.select(
        *base.columns,
        "lag1_rate",
        "lag1_state_rate",
        F.when(F.col("lag1_state_rate").isNotNull(), F.least(F.lit(100.0), F.col("lag1_state_rate") + 5)).alias("goal_t"),
        F.when(F.col("lag1_state_rate").isNotNull(), F.least(F.lit(100.0), F.col("lag1_state_rate") + 10)).alias("goal_t1"),
    )


UNIT_SQL = (
    UNIT_BASE_SQL
    + """,
group_year AS (SELECT group_id, year, avg(y) * 100 AS rate FROM unit_base GROUP BY ALL),
state_year AS (SELECT state, year, avg(y) * 100 AS rate FROM unit_base GROUP BY ALL),
unit AS (
  SELECT b.*, g.rate AS lag1_rate, s.rate AS lag1_state_rate,
         CASE WHEN s.rate IS NOT NULL THEN least(100.0::DOUBLE, s.rate + 5) END AS goal_t,
         CASE WHEN s.rate IS NOT NULL THEN least(100.0::DOUBLE, s.rate + 10) END AS goal_t1
  FROM unit_base b
  LEFT JOIN group_year g ON g.group_id = b.group_id AND g.year = b.year - 1
  LEFT JOIN state_year s ON s.state = b.state AND s.year = b.year - 1
)"""
)


def scored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``row_id, group_id, y, score`` straight from the orders (no joins needed)."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("row_id"),
        F.col("o_custkey").cast("string").alias("group_id"),
        (F.col("o_orderstatus") == "F").cast("int").alias("y"),
        F.round(F.col("o_totalprice") / F.lit(1000000), 3).alias("score"),
    )


SCORED_ORDERS_SQL = """
scored AS (
  SELECT o_orderkey AS row_id, CAST(o_custkey AS VARCHAR) AS group_id,
         CAST(o_orderstatus = 'F' AS INTEGER) AS y, round(o_totalprice / 1000000, 3) AS score
  FROM orders
)"""


def scored_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return docs.select("doc_id", "source", "lang", "n_chars").join(labels, "doc_id").select(
        F.col("doc_id").alias("row_id"),
        F.col("source").alias("group_id"),
        F.col("lang").alias("region"),
        F.col("quality").alias("y"),
        F.round(F.col("n_chars") / F.lit(100000.0), 3).alias("score"),
    )


SCORED_DOCS_SQL = """
scored AS (
  SELECT d.doc_id AS row_id, source AS group_id, lang AS region, quality AS y, round(n_chars / 100000.0, 3) AS score
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id
)"""


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("row_id"),
        F.col("user_id").cast("string").alias("group_id"),
        (F.col("event_type") == "purchase").cast("int").alias("y"),
        F.round(F.col("value") / F.lit(1000), 3).alias("score"),
    )


SCORED_EVENTS_SQL = """
scored AS (
  SELECT event_id AS row_id, CAST(user_id AS VARCHAR) AS group_id,
         CAST(event_type = 'purchase' AS INTEGER) AS y, round(value / 1000, 3) AS score
  FROM events
)"""
