"""Queries for the evaluation metrics, on scores that need no model."""

from pyspark.sql import functions as F

from cohortlens.catalog.registry import query, r6, with_
from cohortlens.operators import metrics as m
from cohortlens.operators.ordering import global_rank, running_totals
from cohortlens.plans.bindings import (
    SCORED_DOCS_SQL,
    SCORED_EVENTS_SQL,
    SCORED_ORDERS_SQL,
    scored_docs,
    scored_events,
    scored_orders,
    table,
)

CURVE_SQL = """
, per AS (SELECT score, sum(y) AS pos, sum(1 - y) AS neg, sum((score - y) * (score - y)) AS sq FROM scored GROUP BY 1),
curve AS (SELECT score, pos::DOUBLE AS pos, neg::DOUBLE AS neg, sq,
  sum(pos) OVER (ORDER BY score DESC)::DOUBLE AS tps, sum(neg) OVER (ORDER BY score DESC)::DOUBLE AS fps FROM per)"""

AUC = "sum(neg * (tps - pos) + neg * pos / 2) / (sum(pos) * sum(neg))"
AP = "sum(pos * tps / (tps + fps)) / sum(pos)"


def metric_sql(threshold: str, prefix: str = "", source: str = "curve", name: str = "metric_row") -> str:
    """One CTE with the metrics of ``curve`` at a threshold expression."""
    return f"""
, cells_{name} AS (
  SELECT {threshold} AS t, {AUC} AS roc_auc, {AP} AS pr_auc, sum(sq) / sum(pos + neg) AS brier,
    coalesce(sum(neg) FILTER (WHERE score < {threshold}), 0)::BIGINT AS tn,
    coalesce(sum(neg) FILTER (WHERE score >= {threshold}), 0)::BIGINT AS fp,
    coalesce(sum(pos) FILTER (WHERE score < {threshold}), 0)::BIGINT AS fn,
    coalesce(sum(pos) FILTER (WHERE score >= {threshold}), 0)::BIGINT AS tp
  FROM {source}),
{name} AS (
  SELECT round(t, 6) AS {prefix}threshold, round(roc_auc, 6) AS {prefix}roc_auc, round(pr_auc, 6) AS {prefix}pr_auc,
    round((tp + tn) / (tp + tn + fp + fn)::DOUBLE, 6) AS {prefix}accuracy,
    round((tp / (tp + fn)::DOUBLE + tn / (tn + fp)::DOUBLE) / 2, 6) AS {prefix}balanced_accuracy,
    round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn)::DOUBLE END, 6) AS {prefix}f1,
    round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp)::DOUBLE END, 6) AS {prefix}precision,
    round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn)::DOUBLE END, 6) AS {prefix}recall,
    round(brier, 6) AS {prefix}brier, tn AS {prefix}tn, fp AS {prefix}fp, fn AS {prefix}fn, tp AS {prefix}tp
  FROM cells_{name})"""


def _rounded(df):
    kinds = dict(df.dtypes)
    return df.select(*[r6(c) if kinds[c] == "double" else c for c in df.columns])


@query(
    "e1_confusion",
    with_(
        SCORED_ORDERS_SQL,
        """SELECT count_if(y = 0 AND score < 0.25::DOUBLE)::BIGINT AS tn, count_if(y = 0 AND score >= 0.25::DOUBLE)::BIGINT AS fp,
count_if(y = 1 AND score < 0.25::DOUBLE)::BIGINT AS fn, count_if(y = 1 AND score >= 0.25::DOUBLE)::BIGINT AS tp FROM scored""",
    ),
)
def e1(spark, sf):
    return m.confusion(scored_orders(spark, sf), 0.25)


@query(
    "e2_classification_metrics",
    with_(SCORED_ORDERS_SQL + CURVE_SQL + metric_sql("0.25::DOUBLE", "m_"), "SELECT * FROM metric_row"),
)
def e2(spark, sf):
    return _rounded(m.classification_metrics(scored_orders(spark, sf), 0.25, "m_"))


@query("e3_roc_auc", with_(SCORED_EVENTS_SQL + CURVE_SQL, f"SELECT round({AUC}, 6) AS roc_auc FROM curve"))
def e3(spark, sf):
    return m.roc_auc(scored_events(spark, sf)).select(r6("roc_auc"))


@query("e3_roc_auc_ranges", with_(SCORED_EVENTS_SQL + CURVE_SQL, f"SELECT round({AUC}, 6) AS roc_auc FROM curve"))
def e3_ranges(spark, sf):
    """The same number by the many-task path that large tables take."""
    return m.roc_auc(scored_events(spark, sf), range_rows=500).select(r6("roc_auc"))


@query("e4_average_precision", with_(SCORED_ORDERS_SQL + CURVE_SQL, f"SELECT round({AP}, 6) AS pr_auc FROM curve"))
def e4(spark, sf):
    return m.average_precision(scored_orders(spark, sf)).select(r6("pr_auc"))


@query("e5_brier", with_(SCORED_ORDERS_SQL, "SELECT round(avg((score - y) * (score - y)), 6) AS brier FROM scored"))
def e5(spark, sf):
    return m.brier(scored_orders(spark, sf)).select(r6("brier"))


@query(
    "e6_precision_recall_curve",
    with_(
        SCORED_DOCS_SQL + CURVE_SQL,
        """SELECT score AS threshold, round(tps / (tps + fps), 6) AS precision, round(tps / (SELECT sum(pos) FROM per), 6) AS recall FROM curve
UNION ALL SELECT NULL, 1.0::DOUBLE, 0.0::DOUBLE""",
    ),
)
def e6(spark, sf):
    out = m.precision_recall_curve(m.score_curve(scored_docs(spark, sf)))
    return out.select("threshold", r6("precision"), r6("recall"))


@query(
    "e7_roc_curve",
    with_(
        SCORED_DOCS_SQL + CURVE_SQL,
        """SELECT score AS threshold, round(fps / (SELECT sum(neg) FROM per), 6) AS fpr, round(tps / (SELECT sum(pos) FROM per), 6) AS tpr FROM curve
UNION ALL SELECT NULL, 0.0::DOUBLE, 0.0::DOUBLE""",
    ),
)
def e7(spark, sf):
    return m.roc_curve(m.score_curve(scored_docs(spark, sf))).select("threshold", r6("fpr"), r6("tpr"))


def threshold_sql(min_precision: float) -> str:
    return f"""
, pr AS (SELECT score AS thr, tps / (tps + fps) AS prec, tps / (SELECT sum(pos) FROM per) AS rec FROM curve),
picked AS (SELECT coalesce(
  (SELECT thr FROM pr WHERE prec >= {min_precision}::DOUBLE ORDER BY rec DESC, thr LIMIT 1),
  (SELECT thr FROM pr ORDER BY 2 * prec * rec / (prec + rec + 1e-12) DESC, thr LIMIT 1), 0.5::DOUBLE) AS threshold)"""


@query(
    "e8_recall_threshold",
    with_(
        SCORED_DOCS_SQL + CURVE_SQL + threshold_sql(0.9),
        "SELECT threshold FROM picked",
    ),
)
def e8(spark, sf):
    return m.recall_threshold(m.score_curve(scored_docs(spark, sf)), 0.9)


@query("e8_f1_fallback", with_(SCORED_EVENTS_SQL + CURVE_SQL + threshold_sql(1.1), "SELECT threshold FROM picked"))
def e8_fallback(spark, sf):
    return m.recall_threshold(m.score_curve(scored_events(spark, sf)), 1.1)


@query(
    "e9_two_thresholds",
    with_(
        SCORED_ORDERS_SQL
        + CURVE_SQL
        + threshold_sql(0.62)
        + metric_sql("0.5::DOUBLE", name="low_row")
        + metric_sql("(SELECT threshold FROM picked)", "recall_oriented_", name="high_row"),
        "SELECT * FROM low_row CROSS JOIN high_row",
    ),
)
def e9(spark, sf):
    return _rounded(m.two_threshold_metrics(scored_orders(spark, sf)))


@query(
    "e10_class_report",
    with_(
        SCORED_ORDERS_SQL,
        """
, c AS (SELECT count_if(y = 0 AND score < 0.25::DOUBLE)::DOUBLE AS tn, count_if(y = 0 AND score >= 0.25::DOUBLE)::DOUBLE AS fp,
  count_if(y = 1 AND score < 0.25::DOUBLE)::DOUBLE AS fn, count_if(y = 1 AND score >= 0.25::DOUBLE)::DOUBLE AS tp FROM scored),
k AS (SELECT '0' AS label, tn / (tn + fn) AS p, tn / (tn + fp) AS r, 2 * tn / (2 * tn + fn + fp) AS f, tn + fp AS s FROM c
  UNION ALL SELECT '1', tp / (tp + fp), tp / (tp + fn), 2 * tp / (2 * tp + fp + fn), tp + fn FROM c)
SELECT label, round_even(p, 3) AS precision, round_even(r, 3) AS recall, round_even(f, 3) AS f1, s::BIGINT AS support FROM k
UNION ALL SELECT 'macro avg', round_even(avg(p), 3), round_even(avg(r), 3), round_even(avg(f), 3), sum(s)::BIGINT FROM k
UNION ALL SELECT 'weighted avg', round_even(sum(p * s) / sum(s), 3), round_even(sum(r * s) / sum(s), 3),
  round_even(sum(f * s) / sum(s), 3), sum(s)::BIGINT FROM k""",
    ),
)
def e10(spark, sf):
    return m.class_report(scored_orders(spark, sf), 0.25)


@query(
    "e11_calibration",
    with_(
        SCORED_EVENTS_SQL,
        """
, q AS (SELECT quantile_cont(score, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e FROM scored),
b AS (SELECT CAST(""" + " + ".join(f"CAST(e[{i}] < score AS INTEGER)" for i in range(1, 10)) + """ AS INTEGER) AS bin, score, y FROM scored, q)
SELECT bin, count(*) AS n, round(avg(score), 6) AS mean_score, round(avg(y), 6) AS positive_share FROM b GROUP BY 1""",
    ),
)
def e11(spark, sf):
    return m.calibration(scored_events(spark, sf)).select("bin", "n", r6("mean_score"), r6("positive_share"))


MODELS_SQL = """
long AS (
  SELECT 'by_price' AS model, CAST(o_orderstatus = 'F' AS INTEGER) AS y, round(o_totalprice / 1000000, 3) AS score FROM orders
  UNION ALL SELECT 'by_cheapness', CAST(o_orderstatus = 'F' AS INTEGER), round(1 - o_totalprice / 1000000, 3) FROM orders
  UNION ALL SELECT 'constant', CAST(o_orderstatus = 'F' AS INTEGER), 0.5::DOUBLE FROM orders
),
per AS (SELECT model, score, sum(y)::DOUBLE AS pos, sum(1 - y)::DOUBLE AS neg FROM long GROUP BY ALL),
curve AS (SELECT *, sum(pos) OVER (PARTITION BY model ORDER BY score DESC) AS tps FROM per)"""


def long_scores(spark, sf):
    """Three model-free scorings of the orders as one long frame."""
    rows = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("row_id"),
        (F.col("o_orderstatus") == "F").cast("int").alias("y"),
        (F.col("o_totalprice") / 1000000).alias("p"),
    )
    models = F.array(
        F.struct(F.lit("by_price").alias("model"), F.round("p", 3).alias("score")),
        F.struct(F.lit("by_cheapness").alias("model"), F.round(1 - F.col("p"), 3).alias("score")),
        F.struct(F.lit("constant").alias("model"), F.lit(0.5).alias("score")),
    )
    return rows.select("row_id", "y", F.inline(models))


@query(
    "e12_model_comparison",
    with_(
        MODELS_SQL,
        """SELECT c.model, round(sum(neg * (tps - pos) + neg * pos / 2) / (sum(pos) * sum(neg)), 6) AS roc_auc,
       any_value(b.brier) AS brier FROM curve c
JOIN (SELECT model, round(avg((score - y) * (score - y)), 6) AS brier FROM long GROUP BY 1) b ON b.model = c.model GROUP BY 1""",
    ),
)
def e12(spark, sf):
    return m.model_comparison(long_scores(spark, sf)).select("model", r6("roc_auc"), r6("brier"))


@query(
    "k1_running_totals",
    """
WITH p AS (SELECT l_extendedprice AS price, count(*) AS n FROM lineitem GROUP BY 1)
SELECT price, n, CAST(sum(n) OVER (ORDER BY price) AS BIGINT) AS cum_n FROM p""",
)
def k1(spark, sf):
    """Running count over distinct prices by the many-task path."""
    prices = table(spark, sf, "lineitem").groupBy(F.col("l_extendedprice").alias("price")).agg(F.count("*").alias("n"))
    return running_totals(prices, "price", ["n"], range_rows=500)


@query(
    "i1_global_rank",
    """SELECT o_orderkey, row_number() OVER (ORDER BY q DESC, md5('42:' || o_orderkey) || o_orderkey) AS rank FROM (
SELECT o_orderkey, round(o_totalprice, -5) AS q FROM orders)""",
)
def i1(spark, sf):
    """Ranks of all orders on a value with few levels, by the many-task path: heavy ties."""
    rows = table(spark, sf, "orders").select("o_orderkey", F.round("o_totalprice", -5).alias("q"))
    return global_rank(rows, "q", "o_orderkey", descending=True, range_rows=500).select("o_orderkey", "rank")
