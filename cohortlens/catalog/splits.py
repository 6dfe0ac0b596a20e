"""Queries for holdouts, folds and samples."""

from pyspark.sql import functions as F

from cohortlens.catalog.registry import query, with_
from cohortlens.functions.seeded import take_lowest
from cohortlens.operators import splits
from cohortlens.plans.bindings import SCORED_EVENTS_SQL, SCORED_ORDERS_SQL, scored_events, scored_orders, table

GROUPED_SQL = """
, g AS (SELECT group_id, row_number() OVER (ORDER BY md5('42:' || group_id) || group_id) AS i, count(*) OVER () AS n
  FROM (SELECT DISTINCT group_id FROM scored)),
side AS (SELECT s.*, g.i <= ceil(0.2::DOUBLE * g.n) AS is_test FROM scored s JOIN g USING (group_id))"""


@query("g1_grouped_holdout", with_(SCORED_ORDERS_SQL + GROUPED_SQL, "SELECT row_id, group_id, is_test FROM side"))
def g1(spark, sf):
    return splits.grouped_holdout(scored_orders(spark, sf)).select("row_id", "group_id", "is_test")


@query(
    "g1_grouped_holdout_approx",
    with_(
        SCORED_EVENTS_SQL,
        """SELECT row_id, (('0x' || substr(md5('42:' || group_id), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE) < 0.2::DOUBLE AS is_test
FROM scored""",
    ),
)
def g1_approx(spark, sf):
    return splits.grouped_holdout_approx(scored_events(spark, sf)).select("row_id", "is_test")


@query(
    "g2_random_holdout",
    with_(
        SCORED_ORDERS_SQL,
        """SELECT row_id, y, row_number() OVER (PARTITION BY y ORDER BY md5('42:' || row_id) || row_id)
<= round(0.2::DOUBLE * count(*) OVER (PARTITION BY y)) AS is_test FROM scored""",
    ),
)
def g2(spark, sf):
    return splits.random_holdout(scored_orders(spark, sf)).select("row_id", "y", "is_test")


FOLDS_SQL = """
, pg AS (SELECT group_id, count(*) AS n, CAST(sum(y) AS BIGINT) AS n_pos FROM scored GROUP BY 1),
ranked AS (SELECT *, (row_number() OVER (ORDER BY n DESC, n_pos DESC, md5('42:' || group_id) || group_id) - 1) % 10 AS place FROM pg),
folds AS (SELECT group_id, n, n_pos, CAST(CASE WHEN place < 5 THEN place ELSE 9 - place END AS INTEGER) AS fold FROM ranked)"""


@query("g3_group_folds", with_(SCORED_ORDERS_SQL + FOLDS_SQL, "SELECT * FROM folds"))
def g3(spark, sf):
    return splits.group_folds(scored_orders(spark, sf))


@query(
    "g3_rows_with_folds",
    with_(SCORED_EVENTS_SQL + FOLDS_SQL, "SELECT row_id, group_id, fold FROM scored JOIN folds USING (group_id)"),
)
def g3_rows(spark, sf):
    return splits.with_folds(scored_events(spark, sf)).select("row_id", "group_id", "fold")


@query(
    "g4_row_cap",
    with_(SCORED_ORDERS_SQL, "SELECT row_id FROM scored ORDER BY md5('42:' || row_id) || row_id LIMIT 500"),
)
def g4(spark, sf):
    return splits.row_cap(scored_orders(spark, sf), 500).select("row_id")


@query(
    "g5_nested_samples",
    with_(
        SCORED_EVENTS_SQL,
        """, r AS (SELECT y, row_number() OVER (ORDER BY md5('42:' || row_id) || row_id) AS i FROM scored)
SELECT size, count(*) AS n, CAST(sum(y) AS BIGINT) AS n_pos
FROM (SELECT unnest([200, 1000, 5000]) AS size) s JOIN r ON r.i <= s.size GROUP BY 1""",
    ),
)
def g5(spark, sf):
    """Sub-samples of three sizes; each holds the smaller ones."""
    rows = scored_events(spark, sf)
    out = None
    for n in (200, 1000, 5000):
        part = take_lowest(rows, n, "row_id").agg(
            F.lit(n).alias("size"), F.count("*").alias("n"), F.sum(F.col("y").cast("long")).alias("n_pos")
        )
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "g6_group_counts",
    with_(
        SCORED_ORDERS_SQL + GROUPED_SQL,
        "SELECT is_test, count(DISTINCT group_id) AS n_groups, count(*) AS n_rows FROM side GROUP BY 1",
    ),
)
def g6(spark, sf):
    return splits.group_counts(splits.grouped_holdout(scored_orders(spark, sf)))


@query("a9_seeded_sample", "SELECT * FROM events ORDER BY md5('42:' || event_id) || event_id LIMIT 1000")
def a9(spark, sf):
    return take_lowest(table(spark, sf, "events"), 1000, "event_id")


@query(
    "a10_balanced_sample",
    with_(
        SCORED_EVENTS_SQL,
        """
, s AS (SELECT * FROM scored ORDER BY md5('42:' || row_id) || row_id LIMIT 2000)
SELECT row_id, y FROM (SELECT *, row_number() OVER (PARTITION BY y ORDER BY md5('42:class:' || row_id) || row_id) AS i FROM s)
WHERE i <= 1000""",
    ),
)
def a10(spark, sf):
    return splits.class_balanced_sample(scored_events(spark, sf), 2000).select("row_id", "y")
