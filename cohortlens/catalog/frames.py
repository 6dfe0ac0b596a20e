"""Queries for column roles, derived columns, joins and prior-year enrichment."""

from pyspark.sql import functions as F

from cohortlens.catalog.registry import query, r9, with_
from cohortlens.functions.columns import group_text
from cohortlens.operators import attach as at, decide, enrich, frame, metrics, profile
from cohortlens.plans.bindings import (
    SCORED_EVENTS_SQL,
    SCORED_ORDERS_SQL,
    UNIT_BASE_SQL,
    UNIT_SQL,
    scored_events,
    scored_orders,
    table,
    unit,
    unit_base,
)
from cohortlens.session import written

UNIT_COLUMNS = (
    "row_id group_id state region network y year weight acctbal segment is_even_nation grade lag1_empty score "
    "lag1_rate lag1_state_rate goal_t goal_t1"
).split()


def _union(lines):
    return " UNION ALL ".join(lines)


@query(
    "b1_goal_gap",
    with_(UNIT_SQL, "SELECT row_id, round(goal_t, 9) AS goal_t, round(goal_t - lag1_rate, 9) AS goal_gap FROM unit"),
)
def b1(spark, sf):
    return frame.add_goal_gap(unit(spark, sf)).select("row_id", r9("goal_t"), r9("goal_gap"))


@query(
    "b2_surviving_columns",
    with_(
        UNIT_SQL,
        "SELECT * FROM ("
        + _union(f"SELECT '{c}' AS \"column\", count({c}) AS non_null FROM unit" for c in UNIT_COLUMNS)
        + ") WHERE non_null > 0",
    ),
)
def b2(spark, sf):
    return frame.surviving_columns(written(unit(spark, sf), "unit"))


@query(
    "b3_constant_columns",
    with_(
        UNIT_SQL,
        "SELECT \"column\" FROM ("
        + _union(
            f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS d FROM unit"
            for c in UNIT_COLUMNS
            if c not in ("row_id", "y", "group_id")
        )
        + ") WHERE d <= 1",
    ),
)
def b3(spark, sf):
    return frame.constant_column_rows(written(unit(spark, sf), "unit"))


@query(
    "b5_model_frame",
    with_(
        UNIT_SQL,
        """
SELECT row_id, group_id, state, region, network, CAST(y AS INTEGER) AS y, year, weight, acctbal, segment,
       is_even_nation, score, round(lag1_rate, 9) AS lag1_rate, round(lag1_state_rate, 9) AS lag1_state_rate,
       round(goal_t, 9) AS goal_t, round(goal_t1, 9) AS goal_t1, round(goal_t - lag1_rate, 9) AS goal_gap
FROM unit""",
    ),
)
def b5(spark, sf):
    out = frame.build_model_frame(written(unit(spark, sf), "unit"))
    rounded = ("lag1_rate", "lag1_state_rate", "goal_t", "goal_t1", "goal_gap")
    return out.select(*[r9(c) if c in rounded else c for c in out.columns])


# candidates in the order of the schema, then of the columns; constant columns and texts of more than 30 levels drop out
ROLE_CANDIDATES = (
    *((c, "numeric") for c in "lag1_rate lag1_state_rate goal_t acctbal goal_gap year is_even_nation grade score lag1_empty".split()),
    *((c, "categorical") for c in "network region state segment".split()),
)


@query(
    "b6_feature_roles",
    with_(
        UNIT_SQL,
        ", u AS (SELECT *, goal_t - lag1_rate AS goal_gap FROM unit), c AS ("
        + _union(
            f"SELECT {i} AS i, '{c}' AS feature, '{role}' AS role, count(DISTINCT {c}) AS n FROM u" for i, (c, role) in enumerate(ROLE_CANDIDATES)
        )
        + ") SELECT CAST(row_number() OVER (ORDER BY i) - 1 AS INTEGER) AS position, feature, role FROM c WHERE n > 1 AND (role = 'numeric' OR n <= 30)",
    ),
)
def b6(spark, sf):
    roles = frame.feature_roles(frame.build_model_frame(written(unit(spark, sf), "unit")))
    rows = [(i, c, "numeric") for i, c in enumerate(roles.numeric)]
    rows += [(i + len(rows), c, "categorical") for i, c in enumerate(roles.categorical)]
    return spark.createDataFrame(rows, "position int, feature string, role string")


@query(
    "b7_model_rows",
    with_(
        UNIT_SQL,
        """
SELECT row_id, coalesce(group_id, '__NULL__') AS group_id, CAST(y AS INTEGER) AS y,
       round(lag1_rate, 9) AS lag1_rate, acctbal, network, region FROM unit""",
    ),
)
def b7(spark, sf):
    rows = frame.model_rows(written(unit(spark, sf), "unit"), frame.Roles(["lag1_rate", "acctbal"], ["network", "region"]))
    return rows.withColumn("lag1_rate", F.round("lag1_rate", 9))


@query("b10_log_clipped", "SELECT c_custkey, round(ln(1 + greatest(c_acctbal, 0)), 9) AS log_acctbal FROM customer")
def b10(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", r9(frame.log_clipped("c_acctbal"), "log_acctbal"))


@query(
    "b11_min_max_score",
    """
SELECT o_orderkey, round((o_totalprice - min(o_totalprice) OVER ())
  / (max(o_totalprice) OVER () - min(o_totalprice) OVER () + 1e-9), 9) AS score FROM orders""",
)
def b11(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return frame.min_max_score(rows, "o_totalprice").select("o_orderkey", r9("score"))


@query(
    "b12_threshold",
    with_(SCORED_ORDERS_SQL, "SELECT row_id, y, CAST(score >= 0.25::DOUBLE AS INTEGER) AS predicted FROM scored"),
)
def b12(spark, sf):
    return frame.apply_threshold(scored_orders(spark, sf), 0.25).select("row_id", "y", "predicted")


@query(
    "b13_goal_flags",
    with_(
        UNIT_SQL,
        """
, r AS (SELECT group_id, avg(score) AS p, arg_min(goal_t, row_id) FILTER (WHERE goal_t IS NOT NULL) AS g0,
        arg_min(goal_t1, row_id) FILTER (WHERE goal_t1 IS NOT NULL) AS g1 FROM unit GROUP BY 1)
SELECT group_id, round(1 - p, 9) AS risk, round(p * 100 - g0, 9) AS gap_goal_t, coalesce(p * 100 - g0 < 0, false) AS misses_goal_t,
       round(p * 100 - g1, 9) AS gap_goal_t1, coalesce(p * 100 - g1 < 0, false) AS misses_goal_t1 FROM r""",
    ),
)
def b13(spark, sf):
    rates = decide.group_rates(unit(spark, sf), "group_id", ["goal_t", "goal_t1"], "row_id")
    return decide.add_goal_flags(rates).select(
        "group_id", r9("risk"), r9("gap_goal_t"), "misses_goal_t", r9("gap_goal_t1"), "misses_goal_t1"
    )


@query(
    "b14_coverage",
    with_(
        UNIT_SQL,
        _union(
            f"SELECT '{c}' AS \"column\", count(*) AS n_rows, count({c}) AS non_null FROM unit"
            for c in ("state", "acctbal", "lag1_rate", "goal_t", "lag1_empty")
        ),
    ),
)
def b14(spark, sf):
    return profile.coverage(unit(spark, sf), ["state", "acctbal", "lag1_rate", "goal_t", "lag1_empty"])


@query(
    "b15_complete_cases",
    with_(
        UNIT_SQL,
        """SELECT row_id, y, acctbal, round(lag1_rate, 9) AS lag1_rate FROM unit
WHERE y IS NOT NULL AND acctbal IS NOT NULL AND lag1_rate IS NOT NULL""",
    ),
)
def b15(spark, sf):
    out = frame.complete_cases(unit(spark, sf), ["row_id", "y", "acctbal", "lag1_rate"])
    return out.withColumn("lag1_rate", F.round("lag1_rate", 9))


@query(
    "b17_odds",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_discount AS coef,
round(exp(l_discount), 9) AS odds_ratio, abs(l_discount) AS abs_coef FROM lineitem""",
)
def b17(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_discount").alias("coef")
    )
    return frame.odds(rows).withColumn("odds_ratio", F.round("odds_ratio", 9))


@query(
    "c1_lookup_first",
    with_(
        UNIT_BASE_SQL,
        """
, f AS (SELECT group_id, arg_min(acctbal, row_id) FILTER (WHERE acctbal IS NOT NULL) AS acctbal,
        arg_min(network, row_id) FILTER (WHERE network IS NOT NULL) AS network FROM unit_base GROUP BY 1)
SELECT o.row_id, o.group_id, f.acctbal, f.network FROM unit_base o LEFT JOIN f USING (group_id)""",
    ),
)
def c1(spark, sf):
    rows = scored_orders(spark, sf).select("row_id", "group_id")
    return at.lookup_first(rows, unit_base(spark, sf), "group_id", ["acctbal", "network"], "row_id")


@query(
    "c2_label_lookup",
    with_(
        UNIT_BASE_SQL,
        """
, c AS (SELECT segment, region, count(*) AS n FROM unit_base GROUP BY ALL),
m AS (SELECT segment, arg_min(region, (-n, region)) AS main_region,
      round_even(max(n) / sum(n)::DOUBLE, 4) AS main_region_share FROM c GROUP BY 1),
s AS (SELECT segment, count(*) AS n_units FROM unit_base GROUP BY 1)
SELECT segment, n_units, main_region, main_region_share FROM s LEFT JOIN m USING (segment)""",
    ),
)
def c2(spark, sf):
    rows = unit_base(spark, sf)
    sizes = rows.groupBy("segment").agg(F.count("*").alias("n_units"))
    return at.label_lookup(sizes, decide.dominant_category(rows, "segment", "region"), "segment")


@query(
    "c3_shared_keys",
    with_(
        SCORED_ORDERS_SQL,
        """SELECT count(*) AS overlap FROM (SELECT group_id FROM scored WHERE y = 1 INTERSECT
SELECT group_id FROM scored WHERE y = 0)""",
    ),
)
def c3(spark, sf):
    rows = scored_orders(spark, sf)
    return at.shared_keys(rows.where("y = 1"), rows.where("y = 0"), "group_id")


@query(
    "c5_scored_with_context",
    with_(
        UNIT_SQL,
        """
, f AS (SELECT group_id, arg_min(region, row_id) AS region, arg_min(goal_t, row_id) FILTER (WHERE goal_t IS NOT NULL) AS goal_t
        FROM unit GROUP BY 1)
SELECT u.row_id, u.group_id, CAST(u.y AS INTEGER) AS y, u.score, f.region, round(f.goal_t, 9) AS goal_t
FROM unit u LEFT JOIN f USING (group_id)""",
    ),
)
def c5(spark, sf):
    source = unit(spark, sf)
    rows = scored_orders(spark, sf)
    out = at.lookup_first(rows, source, "group_id", ["region", "goal_t"], "row_id")
    return out.withColumn("goal_t", F.round("goal_t", 9))


@query(
    "m1_prior_year",
    with_(
        UNIT_BASE_SQL,
        """
, r AS (SELECT group_id, year, avg(y) * 100 AS rate FROM unit_base GROUP BY ALL)
SELECT a.group_id, a.year, round(a.rate, 9) AS rate, round(b.rate, 9) AS lag1_rate
FROM r a LEFT JOIN r b ON a.group_id = b.group_id AND b.year = a.year - 1""",
    ),
)
def m1(spark, sf):
    rates = enrich.yearly_rates(enrich.yearly_counts(unit_base(spark, sf), ["group_id"]), ["group_id"], "rate")
    out = enrich.prior_year(rates, ["group_id"], ["rate"])
    return out.select("group_id", "year", r9("rate"), r9("lag1_rate"))


@query(
    "m2_grain_breaks",
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def m2(spark, sf):
    return enrich.grain_breaks(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("m3_match_coverage", with_(UNIT_SQL, "SELECT round(count(lag1_rate) / count(*)::DOUBLE, 9) AS coverage FROM unit"))
def m3(spark, sf):
    return enrich.match_coverage(unit(spark, sf), "lag1_rate").select(r9("coverage"))


LIMITS = {"acctbal": 25.0, "lag1_rate": 20.0, "lag1_empty": 100.0, "state": 0.0}


@query(
    "m4_missingness_contract",
    with_(
        UNIT_SQL,
        'SELECT "column", round(p, 9) AS pct_missing, allowed, p <= allowed AS ok FROM ('
        + _union(
            f"SELECT '{c}' AS \"column\", 100.0 * (1 - count({c}) / count(*)::DOUBLE) AS p, {v}::DOUBLE AS allowed FROM unit"
            for c, v in LIMITS.items()
        )
        + ")",
    ),
)
def m4(spark, sf):
    return enrich.missingness_breaks(unit(spark, sf), LIMITS).withColumn("pct_missing", F.round("pct_missing", 9))


@query(
    "m5_weighted_rate",
    with_(
        UNIT_BASE_SQL,
        """SELECT region, round(sum(weight), 2) AS total_weight, round(sum(weight * y), 2) AS weighted_positives,
round(sum(weight * y) / sum(weight), 9) AS weighted_rate FROM unit_base GROUP BY 1""",
    ),
)
def m5(spark, sf):
    out = enrich.weighted_rate(unit_base(spark, sf), "region")
    return out.select(
        "region",
        F.round("total_weight", 2).alias("total_weight"),
        F.round("weighted_positives", 2).alias("weighted_positives"),
        r9("weighted_rate"),
    )


@query(
    "m6_drop_invalid",
    "SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderpriority NOT IN ('4-NOT SPECIFIED') GROUP BY 1",
)
def m6(spark, sf):
    rows = enrich.drop_invalid(table(spark, sf, "orders"), "o_orderpriority", ["4-NOT SPECIFIED"])
    return rows.groupBy("o_orderpriority").agg(F.count("*").alias("n"))


@query(
    "e13_group_agreement",
    with_(
        UNIT_SQL,
        """
, r AS (SELECT group_id, avg(y) AS o, avg(score) AS p,
        arg_min(goal_t, row_id) FILTER (WHERE goal_t IS NOT NULL) AS g0,
        arg_min(goal_t1, row_id) FILTER (WHERE goal_t1 IS NOT NULL) AS g1 FROM unit GROUP BY 1)
SELECT count(*) AS n_groups, round(corr(p, o), 9) AS r, count_if(coalesce(p * 100 < g0, false))::BIGINT AS n_misses_goal_t,
       count_if(coalesce(p * 100 < g1, false))::BIGINT AS n_misses_goal_t1 FROM r""",
    ),
)
def e13(spark, sf):
    rates = decide.group_rates(unit(spark, sf), "group_id", ["goal_t", "goal_t1"], "row_id")
    return metrics.group_agreement(decide.add_goal_flags(rates)).withColumn("r", F.round("r", 9))


@query(
    "b7_group_text",
    with_(
        SCORED_EVENTS_SQL,
        """SELECT CASE WHEN y = 1 THEN '__NULL__' ELSE group_id END AS group_id, count(*) AS n FROM scored GROUP BY 1""",
    ),
)
def b7_text(spark, sf):
    rows = scored_events(spark, sf).select(F.when(F.col("y") == 0, F.col("group_id")).alias("g"))
    return rows.groupBy(group_text("g").alias("group_id")).agg(F.count("*").alias("n"))
