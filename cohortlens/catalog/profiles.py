"""Queries for the profiling operators."""

from pyspark.sql import functions as F

from cohortlens.catalog.registry import query, r6, with_
from cohortlens.operators import frame, profile
from cohortlens.plans.bindings import UNIT_BASE_SQL, UNIT_SQL, table, unit, unit_base
from cohortlens.session import written

WIDE = ("state", "region", "network", "y", "year", "weight", "acctbal", "segment", "grade", "lag1_empty", "score", "lag1_rate", "goal_t")
NUMBERS = ("year", "weight", "acctbal", "grade", "lag1_empty", "score", "lag1_rate", "lag1_state_rate", "goal_t", "goal_t1")


def _union(lines):
    return " UNION ALL ".join(lines)


def _corr(a, b):
    return f"CASE WHEN isnan(corr({a}, {b})) THEN NULL ELSE corr({a}, {b}) END"


@query(
    "d1_profile",
    with_(
        UNIT_SQL,
        _union(
            f"""SELECT '{c}' AS "column", count({c}) AS non_null,
round_even(100.0 * (count(*) - count({c})) / count(*)::DOUBLE, 2) AS pct_missing, count(DISTINCT {c}) AS n_unique FROM unit"""
            for c in WIDE
        ),
    ),
)
def d1(spark, sf):
    return profile.profile(written(unit(spark, sf), "unit").select(*WIDE)).drop("dtype")


@query(
    "d2_target_balance",
    """SELECT o_orderstatus AS class, count(*) AS count, round_even(count(*) / sum(count(*)) OVER ()::DOUBLE, 4) AS proportion
FROM orders GROUP BY 1""",
)
def d2(spark, sf):
    return profile.target_balance(table(spark, sf, "orders"), "o_orderstatus")


@query(
    "d3_top_correlations",
    with_(
        UNIT_SQL,
        'SELECT "column", round(r, 6) AS r FROM ('
        + _union(f"SELECT '{c}' AS \"column\", {_corr(c, 'y')} AS r FROM unit" for c in NUMBERS)
        + ') WHERE r IS NOT NULL ORDER BY abs(r) DESC, "column" LIMIT 15',
    ),
)
def d3(spark, sf):
    return profile.correlation_with_target(unit(spark, sf), "y", NUMBERS).withColumn("r", F.round("r", 6))


MATRIX = ("y", "weight", "acctbal", "lag1_rate", "lag1_state_rate", "goal_t", "grade")


@query(
    "d4_correlation_matrix",
    with_(
        UNIT_SQL,
        _union(
            f"SELECT '{a}' AS col_a, '{b}' AS col_b, round({_corr(a, b)}, 6) AS r FROM unit" for a in MATRIX for b in MATRIX
        ),
    ),
)
def d4(spark, sf):
    return profile.correlation_matrix(unit(spark, sf), MATRIX).withColumn("r", F.round("r", 6))


SHOWN = ("weight", "acctbal", "grade", "score", "lag1_rate", "lag1_state_rate")


@query(
    "d4_heatmap",
    with_(
        UNIT_SQL,
        # the rows once, each pair once, then both ways round
        f", u0 AS MATERIALIZED (SELECT {', '.join((*SHOWN, 'y'))} FROM unit), u AS MATERIALIZED (SELECT "
        + ", ".join(f"{_corr(a, b)} AS r_{i}_{i + j}" for i, a in enumerate((*SHOWN, "y")) for j, b in enumerate((*SHOWN, "y")[i:]))
        + " FROM u0), m AS MATERIALIZED (SELECT x.a AS col_a, x.b AS col_b, round(x.r, 6) AS r FROM (SELECT unnest(["
        + ", ".join(
            f"{{'a': '{a}', 'b': '{b}', 'r': r_{min(i, j)}_{max(i, j)}}}" for i, a in enumerate((*SHOWN, "y")) for j, b in enumerate((*SHOWN, "y"))
        )
        + """]) AS x FROM u)),
t AS (SELECT 'y' AS c UNION ALL SELECT * FROM (SELECT col_a FROM m WHERE col_b = 'y' AND col_a <> 'y' AND r IS NOT NULL
  ORDER BY abs(r) DESC, col_a LIMIT 3))
SELECT * FROM m WHERE col_a IN (SELECT c FROM t) AND col_b IN (SELECT c FROM t)""",
    ),
)
def d4_heatmap(spark, sf):
    return profile.heatmap(written(unit(spark, sf), "unit"), "y", 3, SHOWN).withColumn("r", F.round("r", 6))


@query(
    "d5_family_correlations",
    with_(
        UNIT_SQL,
        _union(
            f"SELECT '{c}' AS \"column\", round_even({_corr(c, 'y')}, 3) AS r FROM unit"
            for c in ("lag1_empty", "lag1_rate", "lag1_state_rate")
        ),
    ),
)
def d5(spark, sf):
    return profile.family_correlations(unit(spark, sf), "lag1_")


@query(
    "d6_rate_by_category",
    with_(
        UNIT_BASE_SQL,
        """SELECT category, n, round(rate, 6) AS rate FROM (
SELECT CASE WHEN region = 'ASIA' THEN NULL ELSE state END AS category, count(*) AS n, avg(y) AS rate FROM unit_base GROUP BY 1)
ORDER BY rate DESC, category NULLS LAST LIMIT 12""",
    ),
)
def d6(spark, sf):
    rows = unit_base(spark, sf).withColumn("place", F.when(F.col("region") != "ASIA", F.col("state")))
    return profile.rate_by_category(rows, "place").withColumn("rate", F.round("rate", 6))


@query(
    "d7_rate_by_known_category",
    with_(
        UNIT_BASE_SQL,
        """SELECT CASE WHEN region = 'ASIA' THEN NULL ELSE state END AS category, count(*) AS n, round(avg(y), 6) AS rate
FROM unit_base WHERE region <> 'ASIA' GROUP BY 1""",
    ),
)
def d7(spark, sf):
    rows = unit_base(spark, sf).withColumn("place", F.when(F.col("region") != "ASIA", F.col("state")))
    return profile.rate_by_category(rows, "place", top=None, keep_missing=False).withColumn("rate", F.round("rate", 6))


DESCRIBED = ("weight", "acctbal", "score", "lag1_rate", "goal_t")


@query(
    "d8_describe",
    with_(
        UNIT_SQL,
        _union(
            f"""SELECT '{c}' AS "column", count({c}) AS count, round_even(avg({c}), 2) AS mean, round_even(stddev_samp({c}), 2) AS std,
round_even(min({c}), 2) AS min, round_even(quantile_cont({c}, 0.25), 2) AS q25, round_even(quantile_cont({c}, 0.5), 2) AS q50,
round_even(quantile_cont({c}, 0.75), 2) AS q75, round_even(max({c}), 2) AS max FROM unit"""
            for c in DESCRIBED
        ),
    ),
)
def d8(spark, sf):
    return profile.describe(written(unit(spark, sf), "unit"), DESCRIBED)


LINE = ("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate")


@query(
    "d9_distinct_counts",
    _union(f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_unique FROM lineitem" for c in LINE),
)
def d9(spark, sf):
    return profile.distinct_counts(table(spark, sf, "lineitem"), LINE)


@query("d10_sorted_values", "SELECT DISTINCT o_orderpriority AS value FROM orders")
def d10(spark, sf):
    return profile.sorted_values(table(spark, sf, "orders"), "o_orderpriority")


@query(
    "d11_null_rates",
    with_(
        UNIT_SQL,
        _union(
            f"SELECT '{c}' AS \"column\", round_even(100.0 * (count(*) - count({c})) / count(*)::DOUBLE, 1) AS pct_missing FROM unit"
            for c in ("lag1_empty", "lag1_rate", "lag1_state_rate")
        ),
    ),
)
def d11(spark, sf):
    return profile.null_rates(unit(spark, sf), "lag1_")


@query(
    "d12_null_cells",
    with_(UNIT_SQL, "SELECT CAST(" + " + ".join(f"count_if({c} IS NULL)" for c in WIDE) + " AS BIGINT) AS null_cells FROM unit"),
)
def d12(spark, sf):
    return profile.null_cells(unit(spark, sf).select(*WIDE))


@query(
    "d13_grain_check",
    with_(
        UNIT_BASE_SQL,
        """SELECT 'state' AS attribute, max(n) AS max_distinct FROM (SELECT count(DISTINCT state) AS n FROM unit_base GROUP BY group_id)
UNION ALL SELECT 'network', max(n) FROM (SELECT count(DISTINCT network) AS n FROM unit_base GROUP BY group_id)""",
    ),
)
def d13(spark, sf):
    rows = unit_base(spark, sf)
    checks = [
        profile.grain_check(rows, "group_id", c).select(F.lit(c).alias("attribute"), "max_distinct")
        for c in ("state", "network")
    ]
    return checks[0].unionByName(checks[1])


@query(
    "d14_histogram",
    """
WITH s AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
c AS (SELECT CAST(least(floor((l_extendedprice - lo) / ((hi - lo) / 15)), 14) AS INTEGER) AS bin, count(*) AS n FROM lineitem, s GROUP BY 1)
SELECT CAST(g.bin AS INTEGER) AS bin, round(lo + g.bin * ((hi - lo) / 15), 6) AS low, round(lo + (g.bin + 1) * ((hi - lo) / 15), 6) AS high,
       coalesce(n, 0) AS n
FROM range(15) g(bin) CROSS JOIN s LEFT JOIN c ON c.bin = g.bin""",
)
def d14(spark, sf):
    return profile.histogram(table(spark, sf, "lineitem"), "l_extendedprice").select("bin", r6("low"), r6("high"), "n")


@query(
    "d15_ordered_indicator",
    with_(
        UNIT_BASE_SQL,
        """SELECT state, round(100 * avg(y), 6) AS rate FROM unit_base WHERE region <> 'EUROPE' GROUP BY 1 ORDER BY rate DESC, state""",
    ),
)
def d15(spark, sf):
    rates = unit_base(spark, sf).groupBy("state").agg(
        F.round(F.max(F.when(F.col("region") != "EUROPE", 1.0)) * F.avg("y") * 100, 6).alias("rate")
    )
    return profile.ordered_indicator(rates, "state", "rate")


@query("d16_feature_summary")
def d16(spark, sf):
    from cohortlens.plans.profiling import feature_summary

    return feature_summary(written(unit(spark, sf), "unit"), frame.Schema())


@query(
    "d17_overview",
    """
WITH a AS (
"""
    + _union(
        f"""SELECT '{t}' AS "table", count(*) AS n_rows, {n} AS n_columns, '{c}' AS "column",
round_even(100.0 * (count(*) - count({c})) / count(*)::DOUBLE, 2) AS pct_missing FROM {t}"""
        for t, n, cols in (
            ("orders", 6, "o_custkey o_orderdate o_orderkey o_orderpriority o_orderstatus"),
            ("customer", 5, "c_acctbal c_custkey c_mktsegment c_name c_nationkey"),
            ("nation", 3, "n_name n_nationkey n_regionkey"),
        )
        for c in cols.split()
    )
    + ") SELECT * FROM a",
)
def d17(spark, sf):
    return profile.overview({t: table(spark, sf, t) for t in ("orders", "customer", "nation")})
