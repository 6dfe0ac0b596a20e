"""Queries for the decision tables."""

from pyspark.sql import functions as F

from cohortlens.catalog.registry import query, r9, with_
from cohortlens.operators import decide
from cohortlens.plans.bindings import UNIT_BASE_SQL, UNIT_SQL, scored_events, unit, unit_base

CONTEXT_SQL = ", ".join(
    f"arg_min({c}, row_id) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in decide.CONTEXT
)
RISK_SQL = f"""
, g AS (SELECT group_id, count(*) AS n_units, avg(y) AS observed_rate, avg(score) AS predicted_rate, {CONTEXT_SQL}
  FROM unit WHERE group_id IS NOT NULL GROUP BY 1),
risk AS (SELECT *, 1 - predicted_rate AS risk, predicted_rate * 100 - goal_t AS gap_goal_t,
  coalesce(predicted_rate * 100 < goal_t, false) AS misses_goal_t, predicted_rate * 100 - goal_t1 AS gap_goal_t1,
  coalesce(predicted_rate * 100 < goal_t1, false) AS misses_goal_t1,
  row_number() OVER (ORDER BY round(1 - predicted_rate, 9) DESC, md5('42:' || group_id) || group_id) AS rank FROM g)"""
ROUNDED = (
    "observed_rate predicted_rate goal_t goal_t1 lag1_rate lag1_state_rate risk gap_goal_t gap_goal_t1".split()
)
PLAIN = "group_id n_units state region network acctbal misses_goal_t misses_goal_t1 rank".split()
RISK_SELECT = "SELECT " + ", ".join(PLAIN + [f"round({c}, 9) AS {c}" for c in ROUNDED]) + " FROM risk"


def _rounded(df):
    return df.select(*PLAIN, *[r9(c) for c in ROUNDED])


@query("f1_group_risk", with_(UNIT_SQL + RISK_SQL, RISK_SELECT))
def f1(spark, sf):
    return _rounded(decide.group_risk(unit(spark, sf)))


@query(
    "f2_risk_rank",
    """
WITH r AS (SELECT CAST(user_id AS VARCHAR) AS group_id, round(1 - avg(round(value / 1000, 3)), 9) AS risk FROM events GROUP BY 1)
SELECT group_id, row_number() OVER (ORDER BY risk DESC, md5('42:' || group_id) || group_id) AS rank FROM r""",
)
def f2(spark, sf):
    return decide.group_risk(scored_events(spark, sf)).select("group_id", "rank")


REGION_SQL = """SELECT region, count(DISTINCT group_id) AS n_groups, round(avg(predicted_rate), 9) AS mean_predicted_rate,
round(avg(risk), 9) AS mean_risk, CAST(sum(n_units) AS BIGINT) AS n_units FROM risk WHERE region IS NOT NULL GROUP BY 1"""


@query("f3_region_profile", with_(UNIT_SQL + RISK_SQL, REGION_SQL))
def f3(spark, sf):
    out = decide.region_profile(decide.add_goal_flags(decide.group_rates(unit(spark, sf), "group_id", ["region"], "row_id")))
    return out.select("region", "n_groups", r9("mean_predicted_rate"), r9("mean_risk"), "n_units")


# clusters given by rule: customers with no, low and high balance
CLUSTER_SQL = """
, clustered AS (SELECT group_id, count(*) AS n_units, avg(score) AS predicted_rate, max(acctbal) AS acctbal,
  CASE WHEN max(acctbal) IS NULL THEN 0 WHEN max(acctbal) < 5000 THEN 1 ELSE 2 END AS cluster,
  arg_min(region, row_id) AS region FROM unit_base GROUP BY 1)"""


def clustered(spark, sf):
    rates = decide.group_rates(unit_base(spark, sf), "group_id", ["acctbal", "region"], "row_id")
    label = F.when(F.col("acctbal").isNull(), 0).when(F.col("acctbal") < 5000, 1).otherwise(2)
    return rates.withColumn("cluster", label)


@query(
    "f4_cluster_profile",
    with_(
        UNIT_BASE_SQL + CLUSTER_SQL,
        """
, c AS (SELECT cluster, region, count(*) AS n FROM clustered GROUP BY ALL)
SELECT cluster, count(*) AS n_groups, round(avg(predicted_rate), 9) AS predicted_rate, round(avg(acctbal), 9) AS acctbal,
  any_value((SELECT arg_min(c.region, (-c.n, c.region)) FROM c WHERE c.cluster = k.cluster)) AS main_region,
  any_value((SELECT round_even(max(c.n) / sum(c.n)::DOUBLE, 4) FROM c WHERE c.cluster = k.cluster)) AS main_region_share
FROM clustered k GROUP BY 1""",
    ),
)
def f4(spark, sf):
    out = decide.cluster_profile(clustered(spark, sf), ["predicted_rate", "acctbal"])
    return out.select("cluster", "n_groups", r9("predicted_rate"), r9("acctbal"), "main_region", "main_region_share")


@query(
    "f5_dominant_category",
    with_(
        UNIT_BASE_SQL,
        """
, c AS (SELECT segment, network, count(*) AS n FROM unit_base GROUP BY ALL)
SELECT segment, arg_min(network, (-n, network)) AS main_network, round_even(max(n) / sum(n)::DOUBLE, 4) AS main_network_share
FROM c GROUP BY 1""",
    ),
)
def f5(spark, sf):
    return decide.dominant_category(unit_base(spark, sf), "segment", "network")


SHARE = "round_even(count_if(cluster = {k}) / count(*)::DOUBLE, 4) AS cluster_{k}"
CROSSTAB_SQL = "SELECT region, " + ", ".join(SHARE.format(k=k) for k in range(3)) + " FROM clustered GROUP BY 1"


@query("f6_crosstab", with_(UNIT_BASE_SQL + CLUSTER_SQL, CROSSTAB_SQL))
def f6(spark, sf):
    return decide.region_cluster_crosstab(clustered(spark, sf))


@query(
    "f7_top_risk",
    with_(UNIT_SQL + RISK_SQL, "SELECT group_id, n_units, round(risk, 9) AS risk, rank FROM risk WHERE rank <= 10"),
)
def f7(spark, sf):
    return decide.top_risk(decide.group_risk(unit(spark, sf))).select("group_id", "n_units", r9("risk"), "rank")


@query(
    "f8_cluster_scatter",
    with_(
        UNIT_BASE_SQL + CLUSTER_SQL,
        "SELECT group_id, acctbal AS x, round(predicted_rate, 9) AS predicted_rate, cluster FROM clustered",
    ),
)
def f8(spark, sf):
    return decide.cluster_scatter(clustered(spark, sf)).withColumn("predicted_rate", F.round("predicted_rate", 9))


@query(
    "f8_stacked_shares",
    with_(
        UNIT_BASE_SQL + CLUSTER_SQL + f", x AS ({CROSSTAB_SQL})",
        "SELECT region, cluster, share FROM (UNPIVOT x ON cluster_0, cluster_1, cluster_2 INTO NAME cluster VALUE share)",
    ),
)
def f8_shares(spark, sf):
    return decide.crosstab_long(decide.region_cluster_crosstab(clustered(spark, sf)))


@query(
    "i3_share_of_total",
    """WITH c AS (SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2)
SELECT *, round(n / (sum(n) OVER (PARTITION BY o_orderstatus))::DOUBLE, 9) AS share FROM c""",
)
def i3(spark, sf):
    from cohortlens.plans.bindings import table

    counts = table(spark, sf, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))
    return decide.share_of_total(counts, "n", ["o_orderstatus"]).withColumn("share", F.round("share", 9))
