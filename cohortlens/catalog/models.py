"""Queries for preparation, candidate models, search and clustering."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cohortlens.catalog.metrics import MODELS_SQL, long_scores
from cohortlens.catalog.registry import query, r6, with_
from cohortlens.functions.seeded import given
from cohortlens.operators import balls, cluster, decide, frame, metrics, models, pairs, pivots, prep, splits
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
from cohortlens.session import shared_folder, written
from cohortlens.sources import sinks

NUMBERS = ("weight", "acctbal", "lag1_rate", "goal_t")


def _union(lines):
    return " UNION ALL ".join(lines)


@query(
    "h1_medians",
    with_(UNIT_SQL, _union(f"SELECT '{c}' AS \"column\", round(quantile_cont({c}, 0.5), 6) AS median FROM unit" for c in NUMBERS)),
)
def h1(spark, sf):
    return prep.medians(written(unit(spark, sf), "unit"), NUMBERS).withColumn("median", F.round("median", 6))


@query(
    "h2_standardised",
    with_(
        UNIT_BASE_SQL,
        """
, f AS (SELECT row_id, coalesce(acctbal, (SELECT quantile_cont(acctbal, 0.5) FROM unit_base)) AS a, weight AS w FROM unit_base)
SELECT row_id, round((a - avg(a) OVER ()) / stddev_pop(a) OVER (), 6) AS num__acctbal,
       round((w - avg(w) OVER ()) / stddev_pop(w) OVER (), 6) AS num__weight FROM f""",
    ),
)
def h2(spark, sf):
    out = prep.standardised(unit_base(spark, sf), ["acctbal", "weight"])
    return out.select("row_id", r6("num__acctbal"), r6("num__weight"))


@query(
    "h3_sentinel",
    with_(
        UNIT_BASE_SQL,
        "SELECT CASE WHEN region = 'ASIA' THEN 'UNKNOWN' ELSE state END AS text__place, count(*) AS n FROM unit_base GROUP BY 1",
    ),
)
def h3(spark, sf):
    rows = unit_base(spark, sf).withColumn("place", F.when(F.col("region") != "ASIA", F.col("state")))
    return prep.text_stage(["place"]).transform(rows).groupBy("text__place").agg(F.count("*").alias("n"))


@query(
    "h4_levels",
    with_(
        UNIT_BASE_SQL,
        _union(
            f"""SELECT '{c}' AS "column", {c} AS level, CAST(row_number() OVER (ORDER BY {c}) - 1 AS INTEGER) AS position
FROM (SELECT DISTINCT {c} FROM unit_base)"""
            for c in ("network", "region", "state")
        ),
    ),
)
def h4(spark, sf):
    return prep.levels(unit_base(spark, sf), ["network", "region", "state"])


@query(
    "h4_one_hot",
    with_(
        UNIT_BASE_SQL,
        """, l AS (SELECT network, CAST(row_number() OVER (ORDER BY network) - 1 AS INTEGER) AS position FROM
(SELECT DISTINCT network FROM unit_base WHERE region <> 'ASIA'))
SELECT row_id, position, 1.0::DOUBLE AS value FROM unit_base JOIN l USING (network)""",
    ),
)
def h4_one_hot(spark, sf):
    """Levels learned without one region, applied to all rows: the one set position of each row."""
    rows = unit_base(spark, sf)
    fitted = prep.fit_prep(rows.where("region <> 'ASIA'"), frame.Roles([], ["network"]))
    out = fitted.transform(rows).select("row_id", F.posexplode(vector_to_array("features")).alias("position", "value"))
    return out.where("value <> 0")


ROLES = frame.Roles(["lag1_rate", "acctbal", "weight", "goal_gap"], ["network", "region"])


def model_input(spark, sf):
    """The model rows of the unit table, written once: fits and searches read them many times."""
    rows = frame.model_rows(frame.add_goal_gap(unit(spark, sf)), ROLES)
    return written(rows, "model_rows")


@query(
    "h5_feature_names",
    with_(
        UNIT_BASE_SQL,
        _union(f"SELECT 'num__{c}' AS feature, 0.0::DOUBLE AS mean" for c in ("lag1_rate", "acctbal", "weight", "goal_gap"))
        + " UNION ALL "
        + _union(
            f"SELECT 'cat__{c}_' || {c}, round(count(*) / (SELECT count(*) FROM unit_base)::DOUBLE, 6) FROM unit_base GROUP BY {c}"
            for c in ("network", "region")
        ),
    ),
)
def h5(spark, sf):
    """Names and mean values of the encoded features."""
    rows = written(unit(spark, sf), "unit").transform(frame.add_goal_gap)
    fitted = prep.fit_prep(rows, ROLES)
    names = F.array(*[F.lit(n) for n in prep.feature_names(fitted)])
    long = fitted.transform(rows).select(F.posexplode(vector_to_array("features")).alias("i", "value"))
    return long.groupBy("i").agg(F.avg("value").alias("mean")).select(
        F.element_at(names, F.col("i") + 1).alias("feature"), (F.round("mean", 6) + F.lit(0.0)).alias("mean")
    )


@query(
    "h6_dummy",
    with_(
        SCORED_ORDERS_SQL,
        """, c AS (SELECT y, count(*) AS n FROM scored GROUP BY 1),
d AS (SELECT arg_min(y, (-n, y)) AS label FROM c)
SELECT label::DOUBLE AS score, 0.5::DOUBLE AS roc_auc, round(avg(y), 6) AS pr_auc FROM scored, d GROUP BY label""",
    ),
)
def h6(spark, sf):
    rows = scored_orders(spark, sf).select("row_id", "y")
    model = models.fit_model("dummy", rows, frame.Roles([], []))
    scored = models.score(model, rows)
    out = metrics.classification_metrics(scored).select(r6("roc_auc"), r6("pr_auc"))
    return out.select(scored.agg(F.max("score")).scalar().alias("score"), "*")


def _holdout_metrics(spark, sf, name, params):
    rows = written(splits.grouped_holdout(model_input(spark, sf)), "holdout")
    model = models.fit_model(name, rows.where("not is_test"), ROLES, params)
    scored = models.score(model, rows.where("is_test")).select("y", "score")
    return metrics.classification_metrics(scored)


@query("h7_logistic")
def h7(spark, sf):
    return _holdout_metrics(spark, sf, "logistic", {"C": 0.01, "class_weight": "balanced"})


@query("h8_tree")
def h8(spark, sf):
    return _holdout_metrics(spark, sf, "tree", {"max_depth": 8, "min_samples_leaf": 100, "ccp_alpha": 1e-4})


@query("h9_forest")
def h9(spark, sf):
    params = {"n_trees": 50, "max_depth": 8, "min_samples_leaf": 30, "class_weight": "balanced"}
    return _holdout_metrics(spark, sf, "random_forest", params)


def vectors(spark, sf):
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("v"), (F.col("label") < 5).cast("double").alias("y"), "label"
    )


NEAREST_SQL = """
WITH e AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[64]) AS v, CAST(label < 5 AS DOUBLE) AS y FROM embeddings),
p AS (SELECT a.id, b.id AS neighbor, b.y, {distance} AS distance FROM e a JOIN e b ON a.id <> b.id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY id ORDER BY distance, neighbor) AS INTEGER) AS rank FROM p)
"""
EUCLIDEAN = NEAREST_SQL.format(distance="array_distance(a.v, b.v)")


@query("h10_nearest", EUCLIDEAN + "SELECT id, rank, neighbor, round(distance, 6) AS distance FROM r WHERE rank <= 5")
def h10(spark, sf):
    rows = vectors(spark, sf)
    out = pivots.nearest(rows, rows, 5, skip_same_id=True)
    return out.select("id", "rank", "neighbor", r6("distance"))


@query("h10_vote_uniform", EUCLIDEAN + "SELECT id, round(avg(y), 6) AS score FROM r WHERE rank <= 15 GROUP BY 1")
def h10_uniform(spark, sf):
    rows = vectors(spark, sf)
    return pairs.vote(pairs.nearest(rows, rows, 15, skip_same_id=True), 15).select("id", r6("score"))


@query(
    "h10_vote_distance",
    NEAREST_SQL.format(
        distance="list_sum(list_transform(range(1, 65), lambda i: abs(a.v[i] - b.v[i])))"
    )
    + """SELECT id, round(coalesce(avg(y) FILTER (WHERE distance = 0),
sum(CASE WHEN distance > 0 THEN y / distance END) / sum(CASE WHEN distance > 0 THEN 1 / distance END)), 6) AS score
FROM r WHERE rank <= 11 GROUP BY 1""",
)
def h10_distance(spark, sf):
    rows = vectors(spark, sf)
    near = pairs.nearest(rows, rows, 11, "manhattan", skip_same_id=True)
    return pairs.vote(near, 11, "distance").select("id", r6("score"))


@query("h10_knn_model")
def h10_model(spark, sf):
    """The k-nearest classifier of the search, fitted on all rows of the training groups."""
    rows = written(splits.grouped_holdout(model_input(spark, sf)), "holdout")
    train = rows.where("not is_test").withColumn("row_id", given("row_id"))
    model = models.fit_model("knn", train, ROLES, {"k": 31, "weights": "distance"})
    return metrics.classification_metrics(models.score(model, rows.where("is_test")).select("y", "score"))


@query(
    "h11_class_weights",
    with_(
        SCORED_EVENTS_SQL,
        "SELECT y, count(*) AS n, round(sum(count(*)) OVER ()::DOUBLE / (2 * count(*)), 6) AS weight FROM scored GROUP BY y",
    ),
)
def h11(spark, sf):
    return models.class_weight_table(scored_events(spark, sf)).select("y", "n", r6("weight"))


@query("h13_random_search")
def h13(spark, sf):
    """AUC per setting and fold of a search at its full size, one row each."""
    found = models.search("logistic", model_input(spark, sf), ROLES)
    rows = [(found.name, params, fold, auc) for params, fold, auc in found.fold_scores]
    return spark.createDataFrame(rows, "name string, params string, fold int, roc_auc double")


FOLD_AUC_SQL = """
, pg AS (SELECT group_id, count(*) AS n, CAST(sum(y) AS BIGINT) AS n_pos FROM scored GROUP BY 1),
ranked AS (SELECT *, (row_number() OVER (ORDER BY n DESC, n_pos DESC, md5('42:' || group_id) || group_id) - 1) % 10 AS place FROM pg),
folds AS (SELECT group_id, CASE WHEN place < 5 THEN place ELSE 9 - place END AS fold FROM ranked),
per AS (SELECT fold, score, sum(y)::DOUBLE AS pos, sum(1 - y)::DOUBLE AS neg FROM scored JOIN folds USING (group_id) GROUP BY ALL),
curve AS (SELECT *, sum(pos) OVER (PARTITION BY fold ORDER BY score DESC) AS tps FROM per),
auc AS (SELECT fold, sum(neg * (tps - pos) + neg * pos / 2) / (sum(pos) * sum(neg)) AS roc_auc FROM curve GROUP BY 1)"""


@query(
    "h14_cv_summary",
    with_(
        SCORED_ORDERS_SQL + FOLD_AUC_SQL,
        """SELECT 'by_price' AS params, round(avg(roc_auc), 6) AS mean_test_score, round(stddev_pop(roc_auc), 6) AS std_test_score FROM auc""",
    ),
)
def h14(spark, sf):
    folded = splits.with_folds(scored_orders(spark, sf))
    rows = metrics.roc_auc(folded, by=["fold"]).withColumn("params", F.lit("by_price"))
    return models.cv_summary(rows).select("params", r6("mean_test_score"), r6("std_test_score"))


MODEL_AUC_SQL = """
, auc AS (SELECT CASE model WHEN 'by_price' THEN 'logistic' WHEN 'by_cheapness' THEN 'random_forest' ELSE 'tree' END AS name,
  sum(neg * (tps - pos) + neg * pos / 2) / (sum(pos) * sum(neg)) AS m FROM curve GROUP BY model),
best AS (SELECT max(m) AS m FROM auc)"""


@query(
    "h15_champion",
    with_(
        MODELS_SQL + MODEL_AUC_SQL,
        """SELECT CASE WHEN (SELECT count(*) FROM auc, best WHERE name IN ('logistic', 'random_forest') AND abs(auc.m - best.m) < 0.005) = 2
THEN 'logistic' ELSE (SELECT name FROM auc ORDER BY m DESC, name DESC LIMIT 1) END AS champion""",
    ),
)
def h15(spark, sf):
    """The champion rule over the AUCs of three model-free scorings standing in for candidates."""
    name = F.when(F.col("model") == "by_price", "logistic").when(F.col("model") == "by_cheapness", "random_forest").otherwise("tree")
    auc = metrics.roc_auc(long_scores(spark, sf), by=["model"])
    results = auc.select(name.alias("name"), F.lit(None).cast("double").alias("cv_roc_auc"), F.col("roc_auc").alias("holdout_roc_auc"))
    return models.champion(results)


@query("a16_model_sink", "SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_different FROM orders")
def a16(spark, sf):
    """Rows that a reloaded model scores differently than the saved one: none, and how many it scores."""
    rows = model_input(spark, sf)
    model = models.fit_model("logistic", rows, ROLES, {"C": 0.1})
    path = sinks.save_model(model, shared_folder(spark), "logistic")
    again = models.score(sinks.load_model(path), rows, "again")
    both = models.score(model, rows).select("row_id", "score").join(again.select("row_id", "again"), "row_id")
    return both.agg(F.count("*").alias("n"), F.count_if(F.col("score") != F.col("again")).alias("n_different"))


SILHOUETTE_SQL = """
WITH e AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[64]) AS v, label AS cluster FROM embeddings),
d AS (SELECT a.id, a.cluster, b.cluster AS other, sum(array_distance(a.v, b.v)) AS total, count(*) AS n FROM e a, e b GROUP BY ALL),
s AS (SELECT id, cluster, max(CASE WHEN other = cluster AND n > 1 THEN total / (n - 1) END) AS a, max(CASE WHEN other = cluster THEN n END) AS size,
  min(CASE WHEN other <> cluster THEN total / n END) AS b FROM d GROUP BY ALL)
SELECT id, cluster, round(CASE WHEN size = 1 THEN 0 ELSE (b - a) / greatest(a, b) END, 6) AS silhouette FROM s"""


@query("h23_silhouette", SILHOUETTE_SQL)
def h23(spark, sf):
    rows = vectors(spark, sf).withColumnRenamed("label", "cluster")
    return balls.silhouette(rows).select("id", "cluster", r6("silhouette"))


def _customer_profiles(spark, sf):
    rates = decide.group_rates(unit_base(spark, sf), "group_id", ["acctbal", "region"], "row_id")
    return decide.add_goal_flags(rates, ())


@query("h22_clusters")
def h22(spark, sf):
    """Profile of the chosen clusters of customers."""
    found = cluster.cluster_groups(_customer_profiles(spark, sf), ["predicted_rate", "acctbal", "n_units"])
    return found.profile


@query("h22_cluster_choice")
def h22_choice(spark, sf):
    """Silhouette of each number of clusters and the chosen one."""
    return cluster.cluster_groups(_customer_profiles(spark, sf), ["predicted_rate", "acctbal", "n_units"]).diagnostics


@query(
    "h22_profile_vectors",
    with_(
        UNIT_BASE_SQL,
        """
, g AS (SELECT group_id, avg(score) AS p, ln(1 + count(*)) AS n FROM unit_base GROUP BY 1)
SELECT group_id, round((p - avg(p) OVER ()) / stddev_pop(p) OVER (), 6) AS z_rate, round((n - avg(n) OVER ()) / stddev_pop(n) OVER (), 6) AS z_units FROM g""",
    ),
)
def h22_vectors(spark, sf):
    out = cluster.profile_vectors(_customer_profiles(spark, sf), ["predicted_rate", "n_units"])
    v = vector_to_array("features")
    return out.select("group_id", r6(v[0], "z_rate"), r6(v[1], "z_units"))


@query("a15_search_report")
def a15_search(spark, sf):
    """A search report as written to JSON and read back."""
    found = models.search("logistic", model_input(spark, sf), ROLES)
    path = sinks.save_search_report(spark, [found], shared_folder(spark) + "/search")
    out = spark.read.json(path)
    return out.select("name", "cv_roc_auc", "cv_std", "n_train", F.to_json("best_params").alias("best_params"))
