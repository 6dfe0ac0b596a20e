import inspect
import itertools
import math
import random
import threading

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Observation, functions as F

import __spark_entry__ as entry
from cohortlens.operators import cluster, explain, metrics, models, pairs, prep, splits
from cohortlens.operators.frame import Roles
from cohortlens.plans import experiment, profiling
from cohortlens.session import shared_folder
from cohortlens.sources import sinks
from cohortlens.worklist import Worklist, data_fingerprint

from .conftest import rows

ROLES = Roles(["a", "b", "flat"], ["c"])


@pytest.fixture(scope="module")
def learnable(spark):
    """y depends on a and on c; b has gaps; 60 groups."""
    rng = np.random.default_rng(7)
    n = 1200
    a, b = rng.normal(size=n), rng.normal(size=n)
    c = rng.choice(["p", "q", "r"], size=n)
    y = (a + (c == "p") * 1.5 + rng.normal(scale=0.7, size=n) > 0.5).astype(int)
    data = [
        (i, f"g{i % 60}", int(y[i]), float(a[i]), None if i % 9 == 0 else float(b[i]), 1.0, None if i % 11 == 0 else str(c[i]))
        for i in range(n)
    ]
    df = spark.createDataFrame(data, "row_id long, group_id string, y int, a double, b double, flat double, c string")
    return df.cache()


@pytest.fixture(scope="module")
def forest(learnable):
    return models.fit_model("random_forest", learnable, ROLES, {"n_trees": 4, "max_depth": 4, "min_samples_leaf": 20})


def test_preparation_fills_scales_and_encodes(spark, learnable):
    fitted = prep.fit_prep(learnable, ROLES)
    names = prep.feature_names(fitted)
    assert names == ["num__a", "num__b", "num__flat", "cat__c_UNKNOWN", "cat__c_p", "cat__c_q", "cat__c_r"]
    x = np.array([r[0] for r in fitted.transform(learnable).select(vector_to_array("features")).collect()])
    assert x[:, :2].mean(axis=0) == pytest.approx([0, 0], abs=1e-9) and x[:, :2].std(axis=0) == pytest.approx([1, 1])
    assert (x[:, 2] == 0).all() and (x[:, 3:].sum(axis=1) == 1).all()
    new = spark.createDataFrame([(None, None, None, "never seen")], "a double, b double, flat double, c string")
    got = fitted.transform(new).select(vector_to_array("features")).first()[0]
    assert got[3:] == [0.0, 0.0, 0.0, 0.0] and not any(math.isnan(v) for v in got)


def test_dummy_scores_like_a_constant(learnable):
    model = models.fit_model("dummy", learnable, ROLES)
    got = metrics.classification_metrics(models.score(model, learnable)).first()
    assert got["roc_auc"] == 0.5
    assert got["pr_auc"] == pytest.approx(learnable.agg(F.avg("y")).first()[0])


def test_logistic_matches_a_newton_solution(learnable):
    model = models.fit_model("logistic", learnable, ROLES, {"C": 0.05, "class_weight": "balanced"})
    pdf = prep.fit_prep(learnable, ROLES).transform(learnable).select(vector_to_array("features").alias("v"), "y").toPandas()
    x, y = np.stack(pdf["v"]), pdf["y"].to_numpy()
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    x1 = np.hstack([x, np.ones((len(x), 1))])
    beta, ridge = np.zeros(x1.shape[1]), np.diag([1 / 0.05] * x.shape[1] + [0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x1 @ beta))
        grad = x1.T @ (w * (p - y)) + ridge @ beta
        beta -= np.linalg.solve((x1 * (w * p * (1 - p))[:, None]).T @ x1 + ridge + 1e-12 * np.eye(len(beta)), grad)
    assert model.stages[-1].coefficients.toArray() == pytest.approx(beta[:-1], abs=1e-4)
    table = explain.coefficients(model, 3).collect()
    assert len(table) == 3 and table[0]["abs_coef"] >= table[1]["abs_coef"]
    assert table[0]["odds_ratio"] == pytest.approx(math.exp(table[0]["coef"]))


def test_saved_model_scores_the_same(spark, learnable, forest):
    path = sinks.save_model(forest, shared_folder(spark), "forest")
    again = sinks.load_model(path)
    assert rows(models.score(again, learnable), "row_id", "score") == rows(models.score(forest, learnable), "row_id", "score")
    assert prep.feature_names(again) == prep.feature_names(forest)


def test_trees_learn_and_importances_sum_to_one(learnable, forest):
    assert metrics.roc_auc(models.score(forest, learnable).select("y", "score")).first()[0] > 0.8
    table = explain.impurity_importance(forest)
    assert table.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    assert explain.top_importance(table, 2).count() == 2
    assert explain.coefficients(forest) is None
    logistic = models.fit_model("logistic", learnable, ROLES)
    assert explain.impurity_importance(logistic) is None
    with pytest.raises(TypeError):
        explain.tree_nodes(logistic)


def test_nearest_equals_brute_force(spark):
    rng = np.random.default_rng(0)
    v = rng.integers(0, 4, size=(700, 3)).astype(float)  # many ties and copies
    df = spark.createDataFrame([(i, [float(x) for x in v[i]], float(i % 2)) for i in range(700)], "id long, v array<double>, y double")
    for metric, power in (("euclidean", 2), ("manhattan", 1)):
        near = pairs.nearest(df, df, 6, metric, skip_same_id=True, block_rows=150)
        got = {(r["id"], r["rank"]): r["neighbor"] for r in near.collect()}
        d = (np.abs(v[:, None] - v[None]) ** power).sum(axis=2)
        np.fill_diagonal(d, np.inf)
        order = np.argsort(d, axis=1, kind="stable")[:, :6]
        assert got == {(i, k + 1): order[i, k] for i in range(700) for k in range(6)}


def test_votes(spark):
    near = spark.createDataFrame(
        [(1, 1, 1.0, 0.0), (1, 2, 0.0, 0.0), (1, 3, 1.0, 2.0), (2, 1, 1.0, 1.0), (2, 2, 0.0, 3.0), (2, 3, 0.0, 9.0)],
        "id long, rank int, y double, distance double",
    )
    assert rows(pairs.vote(near, 3)) == [(1, pytest.approx(2 / 3)), (2, pytest.approx(1 / 3))]
    assert rows(pairs.vote(near, 2, "distance")) == [(1, 0.5), (2, pytest.approx(0.75))]


def test_knn_model_round_trip(spark, learnable):
    model = models.fit_model("knn", learnable.where("row_id % 2 = 0"), ROLES, {"k": 11, "weights": "distance"})
    test = learnable.where("row_id % 2 = 1")
    scored = models.score(model, test)
    assert scored.count() == test.count() and scored.where("score is null").count() == 0
    assert metrics.roc_auc(scored.select("y", "score")).first()[0] > 0.75
    again = models.KnnModel.load(spark, model.save(shared_folder(spark)))
    assert rows(models.score(again, test), "row_id", "score") == rows(scored, "row_id", "score")


def test_silhouette_by_hand(spark):
    pts = [(0, [0.0], 0), (1, [1.0], 0), (2, [10.0], 1), (3, [12.0], 1), (4, [50.0], 2)]
    df = spark.createDataFrame(pts, "id long, v array<double>, cluster int")
    got = {r["id"]: r["silhouette"] for r in pairs.silhouette_values(df, block_rows=2).collect()}
    assert got[0] == pytest.approx((11 - 1) / 11) and got[4] == 0.0 and got[2] == pytest.approx((9.5 - 2) / 9.5)


def test_clusters(spark):
    rng = np.random.default_rng(1)
    centers = [(0.2, 10.0), (0.5, 500.0), (0.9, 9000.0)]
    data = [(f"g{i}", float(centers[i % 3][0] + rng.normal(scale=0.02)), float(centers[i % 3][1] * rng.uniform(0.9, 1.1)), "nsw"[i % 3]) for i in range(90)]
    df = spark.createDataFrame(data, "group_id string, predicted_rate double, acctbal double, region string")
    found = cluster.cluster_groups(df, restarts=2)
    assert found.k == 3
    assert rows(found.assigned.groupBy("cluster").agg(F.count_distinct("region").alias("n")), "n") == [(1,)] * 3
    profile = found.profile.collect()
    assert [r["predicted_rate"] for r in profile] == sorted(r["predicted_rate"] for r in profile)
    assert profile[0]["main_region_share"] == 1.0
    skipped = cluster.cluster_groups(df.limit(4))
    assert skipped.k is None and skipped.assigned.where("cluster is not null").count() == 0


def test_draws_are_different_and_seeded():
    space = models.SPACES["random_forest"]
    assert math.prod(len(v) for v in space.values()) == 96
    got = models.draws(space, 8)
    assert len(got) == 8 and got == models.draws(space, 8) and len({str(p) for p in got}) == 8
    assert len(models.draws(models.SPACES["knn"], 99)) == 16


def test_search_over_folds(learnable):
    found = models.search("logistic", learnable, ROLES, n_draws=2, k=3)
    assert len(found.fold_scores) == 6 and found.n_train == 1200 and found.cv_roc_auc > 0.8
    knn = models.search("knn", learnable, ROLES, n_draws=4, k=2, knn_rows=300)
    assert knn.n_train == 300 and knn.cv_std is not None


@pytest.mark.parametrize(("name", "params"), [("logistic", {}), ("random_forest", {"n_trees": 2, "max_depth": 3})])
def test_fresh_models_score_in_a_session_with_tags_and_observations(spark, learnable, name, params):
    seen = Observation()
    spark.addTag("scoring")
    try:
        assert learnable.observe(seen, F.count("*").alias("n")).count() == seen.get["n"]
        model = models.fit_model(name, learnable, ROLES, params)
        assert models.score(model, learnable).agg(F.count("score")).first()[0] == 1200
    finally:
        spark.removeTag("scoring")


@pytest.mark.parametrize(("name", "params", "partitions"), [("logistic", {}, 2), ("random_forest", {"n_trees": 2, "max_depth": 3}, 12)])
def test_logistic_fits_deal_their_rows_to_larger_partitions(learnable, monkeypatch, name, params, partitions):
    dealt, spread = [], models.spread
    monkeypatch.setattr(models, "LOGISTIC_ROWS", 800, raising=False)
    monkeypatch.setattr(models, "PARTITION_ROWS", 100, raising=False)
    monkeypatch.setattr(models, "spread", lambda *args: dealt.append(spread(*args)) or dealt[-1])
    models.fit_model(name, learnable, ROLES, params)
    assert [df.rdd.getNumPartitions() for df in dealt] == [partitions]


def test_units_side_by_side_have_local_properties_of_their_own(spark, tmp_path):
    both = threading.Barrier(2, timeout=60)

    def pool():
        both.wait()
        return spark.sparkContext.getLocalProperty("spark.scheduler.pool")

    found = Worklist(spark, str(tmp_path), "own").units({"a": pool, "b": pool})
    assert found["a"].startswith("a-") and found["b"].startswith("b-")


def test_champion_rule(spark):
    schema = "name string, cv_roc_auc double, holdout_roc_auc double"
    pick = lambda *lines: models.champion(spark.createDataFrame(list(lines), schema)).first()[0]
    assert pick(("dummy", 0.99, 0.99), ("tree", 0.6, 0.1), ("logistic", 0.5, 0.9)) == "tree"
    assert pick(("logistic", 0.646, 0.0), ("random_forest", 0.65, 0.0)) == "logistic"
    assert pick(("logistic", 0.500, 0.0), ("random_forest", 0.505, 0.0)) == "random_forest"
    assert pick(("logistic", 0.648, 0.0), ("random_forest", 0.649, 0.0), ("knn", 0.65, 0.0)) == "logistic"
    assert pick(("logistic", None, 0.7), ("tree", 0.6, 0.9)) == "logistic"
    assert pick(("dummy", None, 0.5)) == "logistic"


def test_min_max_fallback_for_decision_values(spark, learnable):
    from pyspark.ml import PipelineModel
    from pyspark.ml.classification import LinearSVC

    fitted = prep.fit_prep(learnable, ROLES)
    svc = LinearSVC(featuresCol="features", labelCol="y", maxIter=5).fit(fitted.transform(learnable))
    got = models.score(PipelineModel([*fitted.stages, svc]), learnable).agg(F.min("score"), F.max("score")).first()
    assert got[0] == 0.0 and got[1] == pytest.approx(1.0, abs=1e-6)


def test_leakage_and_learning_curve(learnable):
    got = explain.leakage_comparison(learnable, ROLES).first()
    assert got["grouped_overlap"] == 0 and got["random_overlap"] > 0
    assert (got["n_groups_train_grouped"], got["n_groups_test_grouped"]) == (48, 12)
    assert got["auc_inflation"] == pytest.approx(got["random_roc_auc"] - got["grouped_roc_auc"])
    curve = explain.learning_curve("logistic", {}, learnable, ROLES, group="group_id", folds=2, shares=(0.3, 1.0))
    assert curve.count() == 8 and curve.where("roc_auc < 0.6").count() == 0


def test_permutation_importance(learnable):
    model = models.fit_model("logistic", learnable, ROLES)
    got = {r["feature"]: r for r in explain.permutation_importance(model, learnable, ROLES.features, n_repeats=2).collect()}
    assert got["flat"]["importance_mean"] == 0.0 and got["flat"]["importance_std"] == 0.0
    assert got["a"]["importance_mean"] > got["b"]["importance_mean"] and got["a"]["importance_mean"] > 0.1


def test_shuffled_is_a_permutation(learnable):
    out = explain.shuffled(learnable.select("row_id", "a"), ["a"], 0, "row_id")
    pairs_ = out.collect()
    assert sorted(r["a"] for r in pairs_) == sorted(r["_d_a"] for r in pairs_)
    assert sum(r["a"] != r["_d_a"] for r in pairs_) > 1000


def brute_shapley(leaves, x, n):
    """Shapley values of the path-dependent game by its definition."""
    def value(known):
        total = 0.0
        for leaf in leaves:
            p = leaf["value"]
            for f, tests in leaf["tests"].items():
                p *= all(explain._passes(x[None, f], t)[0] for t in tests) if f in known else leaf["share"][f]
            total += p
        return total

    phi = np.zeros(n)
    for i in range(n):
        rest = [j for j in range(n) if j != i]
        for size in range(n):
            for s in itertools.combinations(rest, size):
                weight = math.factorial(size) * math.factorial(n - size - 1) / math.factorial(n)
                phi[i] += weight * (value({*s, i}) - value(set(s)))
    return phi


def test_attribution_equals_the_definition(learnable, forest):
    names = prep.feature_names(forest)
    leaves = explain.leaf_paths(explain.tree_nodes(forest))
    x = np.array([r[0] for r in forest.transform(learnable.limit(4)).select(vector_to_array("features")).collect()])
    got = explain.attribute_rows(x, leaves)
    for i in range(len(x)):
        assert got[i] == pytest.approx(brute_shapley(leaves, x[i], len(names)), abs=1e-12)


def test_attribution_works_out_each_kind_of_row_once(learnable, forest, monkeypatch):
    leaves = explain.leaf_paths(explain.tree_nodes(forest))
    few = np.array([r[0] for r in forest.transform(learnable.limit(7)).select(vector_to_array("features")).collect()])
    kinds, seen = [], np.bincount  # one call a leaf

    def counted(code, *args, **kwargs):
        kinds.append((len(code), len(set(code.tolist()))))
        return seen(code, *args, **kwargs)

    monkeypatch.setattr(np, "bincount", counted)
    many = explain.attribute_rows(np.tile(few, (300, 1)), leaves)
    assert kinds and all(rows == 2100 and found <= 7 for rows, found in kinds)
    monkeypatch.setattr(explain, "FEW_PASSED", 0)
    assert explain.attribute_rows(few, leaves) == pytest.approx(many[:7], abs=1e-15)
    assert np.array_equal(many[:7], many[-7:])


def test_fits_of_a_learning_curve_run_side_by_side(learnable, monkeypatch):
    import threading

    first_two, fit = threading.Barrier(2, timeout=60), explain.fit_model
    begun = itertools.count()

    def together(*args, **kwargs):
        if next(begun) < 2:
            first_two.wait()  # broken, and so an error, if one fit waits for the other to end
        return fit(*args, **kwargs)

    monkeypatch.setattr(explain, "fit_model", together)
    curve = explain.learning_curve("dummy", {}, learnable, ROLES, group="group_id", folds=2, shares=(0.3, 1.0))
    assert {(r["fold"], r["split"]) for r in curve.collect()} == {(f, s) for f in (0, 1) for s in ("train", "validation")}


def test_attribution_adds_up_to_the_score(learnable, forest):
    values = explain.tree_attribution(forest, learnable, n_samples=200)
    total = values.groupBy("row_id").agg((F.sum("phi") + F.max("base")).alias("t"))
    both = total.join(models.score(forest, learnable), "row_id")
    assert both.count() == 200 and both.where("abs(t - score) > 1e-9").count() == 0
    assert explain.mean_attribution(values).count() == 7
    tree = models.fit_model("tree", learnable, ROLES, {"max_depth": 3, "min_samples_leaf": 20})
    one = explain.tree_attribution(tree, learnable, n_samples=50).groupBy("row_id").agg((F.sum("phi") + F.max("base")).alias("t"))
    assert one.join(models.score(tree, learnable), "row_id").where("abs(t - score) > 1e-9").count() == 0


def test_class_weights(learnable):
    got = {r["y"]: (r["n"], r["weight"]) for r in models.class_weight_table(learnable).collect()}
    assert sum(n * w for n, w in got.values()) == pytest.approx(1200)
    assert got[0][1] == pytest.approx(1200 / (2 * got[0][0]))


def test_cv_summary(spark):
    df = spark.createDataFrame([("p", 0.5), ("p", 0.7), ("q", 0.9)], "params string, roc_auc double")
    first, second = models.cv_summary(df).collect()
    assert first["params"] == "q" and second["std_test_score"] == pytest.approx(0.1)


def test_experiment_end_to_end(spark, learnable):
    raw = (
        learnable.withColumn("y", F.col("y").cast("double"))
        .withColumn("region", F.element_at(F.array(F.lit("n"), F.lit("s")), (F.substring("group_id", 2, 3).cast("int") % 2 + 1)))
        .withColumn("goal_t", F.lit(40.0) + F.col("a"))
        .withColumn("lag1_rate", F.lit(30.0) + F.length("group_id"))
        .withColumn("same_year_level", F.col("y"))
        .withColumn("_batch", F.lit("x"))
    )
    out = shared_folder(spark)
    small = {"learning_rows": 300, "explain_rows": 300, "attribution_rows": 50}
    options = {
        "candidates": ("dummy", "logistic", "random_forest", "knn"),
        "n_draws": 1,
        "folds": 2,
        "cluster_features": ("predicted_rate", "lag1_rate", "n_units"),
        "cluster_args": {"k_range": (2, 3), "restarts": 1},
        "folder": shared_folder(spark),
        **small,
    }
    found = experiment.run(raw, out=out, **options)
    assert "same_year_level" not in found.roles.features and "flat" not in found.roles.features
    compared = {r["model"]: r for r in found.comparison.collect()}
    assert compared["dummy"]["roc_auc"] == 0.5 and compared["logistic"]["roc_auc"] > 0.75
    assert found.champion in ("logistic", "random_forest", "knn")
    assert found.risk.count() == 12 and rows(found.regions, "region") == [("n",), ("s",)]
    for name in ("group_risk", "region_risk", "cluster_profile", "cluster_by_region", "leakage", "learning_curve"):
        assert spark.read.csv(f"{out}/reports/{name}", header=True).count() > 0
    assert spark.read.json(f"{out}/reports/model_search").count() == 4
    assert spark.read.json(f"{out}/reports/model_metrics").where("champion").count() == 1
    # a second run reads the records and fits nothing
    fits = []
    with pytest.MonkeyPatch.context() as patch:
        for owner, name in ((models, "fit_prep"), (models, "_fit_on_features"), (cluster, "best_of")):
            patch.setattr(owner, name, lambda *a, n=name, **b: fits.append(n) or 1 / 0)
        again = experiment.run(raw.repartition(5), **options)
        assert again.work.worked == [] and fits == []
        assert sorted(map(str, again.comparison.collect())) == sorted(map(str, found.comparison.collect()))
        assert sorted(map(str, again.clustering.assigned.collect())) == sorted(map(str, found.clustering.assigned.collect()))
    # other settings are another job
    other = experiment.run(raw, **{**options, "candidates": ("dummy", "logistic"), "extras": False, "n_draws": 2})
    assert {c.name for c in other.candidates} == {"dummy", "logistic"} and other.work.folder != found.work.folder


def test_a_search_is_taken_up_where_it_was_cut_off(spark, learnable):
    folder, whole = shared_folder(spark), models._fold_scores
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(models, "_fold_scores", lambda name, settings, folds, fold: whole(name, settings, folds, fold) if fold < 2 else 1 / 0)
        with pytest.raises(ZeroDivisionError):
            models.search("logistic", learnable, ROLES, n_draws=2, k=3, folder=folder)
    done = []
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(models, "_fold_scores", lambda name, settings, folds, fold: done.append(fold) or whole(name, settings, folds, fold))
        found = models.search("logistic", learnable, ROLES, n_draws=2, k=3, folder=folder)
    assert done == [2]
    plain = models.search("logistic", learnable, ROLES, n_draws=2, k=3)
    assert plain.fold_scores == found.fold_scores and plain.cv_roc_auc == found.cv_roc_auc


def test_units_of_a_job(spark):
    folder = shared_folder(spark)
    work = Worklist(spark, folder, "job")
    calls = []
    make = lambda: calls.append("t") or spark.range(7)
    todo = {f"u {i}": (lambda i=i: calls.append(i) or [i, work.table("t", make).count()]) for i in range(6)}
    assert work.units(todo) == {f"u {i}": [i, 7] for i in range(6)} and sorted(map(str, calls)) == ["0", "1", "2", "3", "4", "5", "t"]
    later = Worklist(spark, folder, "job")
    assert later.units(todo) == {f"u {i}": [i, 7] for i in range(6)} and len(calls) == 7 and later.worked == []
    assert later.table("t", make).count() == 7 and later.maybe_table("none", lambda: None) is None
    assert data_fingerprint(spark.range(9)) == data_fingerprint(spark.range(9).repartition(4)) != data_fingerprint(spark.range(8))


def test_profiling_end_to_end(spark, learnable):
    found = profiling.run({"unit_analytic": learnable, "group_context": learnable.limit(3)}, out=shared_folder(spark))
    assert found["profile"].count() == 7 and found["overview"].count() == 10  # both tables
    assert found["feature_summary"].first()["constant_columns"] == ["flat"]
    assert found["histogram_a"].count() == 15


def test_row_cap_is_optional(learnable):
    assert splits.row_cap(learnable, None).count() == 1200 and splits.row_cap(learnable, 10).count() == 10


def test_a_forest_does_not_depend_on_how_its_rows_are_dealt(learnable):
    from cohortlens.operators import frame, models

    roles = frame.Roles(["a"], [])
    params = {"n_trees": 5, "max_depth": 4, "min_samples_leaf": 5}
    totals = set()
    for parts in (1, 3, 7):
        model = models.fit_model("random_forest", learnable.repartition(parts), roles, params)
        totals.add(models.score(model, learnable).selectExpr("sum(score)").first()[0].__round__(9))
    assert len(totals) == 1


@pytest.mark.parametrize(
    "name, home, operator, given",
    [
        ("h25_experiment", experiment, "run", {"raw", "out"}),
        ("a15_search_report", models, "search", {"name", "train", "roles"}),
        ("h22_clusters", cluster, "cluster_groups", {"risk", "features"}),
        ("h22_cluster_choice", cluster, "cluster_groups", {"risk", "features"}),
    ],
)
def test_queries_run_the_whole_search(spark, data, monkeypatch, name, home, operator, given):
    """Nothing but the input is handed over, so draws, folds, candidates, restarts and tables are the operator's own."""
    whole, calls = inspect.signature(getattr(home, operator)), []

    class Called(Exception):
        pass

    def called(*args, **options):
        calls.append(whole.bind(*args, **options).arguments)
        raise Called

    monkeypatch.setattr(home, operator, called)
    with pytest.raises(Called):
        entry.queries()[name](spark, data)
    assert set(calls[0]) == given


def test_pruning_cuts_the_weakest_links(spark, learnable):
    alphas = (0.0, 1e-4, 1e-3, 1e-2, 1.0)
    fitted = {a: models.fit_model("tree", learnable, ROLES, {"max_depth": 7, "min_samples_leaf": 5, "ccp_alpha": a}) for a in alphas}
    trees = {a: m.stages[-1] for a, m in fitted.items()}
    leaves = [(t.numNodes + 1) // 2 for t in trees.values()]
    assert leaves[0] > leaves[2] and leaves == sorted(leaves, reverse=True) and leaves[-1] == 1
    whole = models.fit_model("tree", learnable, ROLES, {"max_depth": 7, "min_samples_leaf": 5})
    score = lambda m: {r["row_id"]: r["score"] for r in models.score(m, learnable).select("row_id", "score").collect()}
    assert score(whole) == score(fitted[0.0])
    # by definition: cut the weakest link of all, again and again
    nodes = {r["id"]: r for r in spark.read.parquet(_saved(spark, trees[0.0])).collect()}
    total = sum(nodes[0]["impurityStats"])
    cost = lambda i: nodes[i]["impurity"] * sum(nodes[i]["impurityStats"]) / total
    for a in alphas[1:]:
        cut = set()

        def ends(i):
            return [i] if i in cut or nodes[i]["leftChild"] < 0 else ends(nodes[i]["leftChild"]) + ends(nodes[i]["rightChild"])

        def inner(i):
            return [] if len(ends(i)) == 1 else [i, *inner(nodes[i]["leftChild"]), *inner(nodes[i]["rightChild"])]

        while links := [((cost(i) - sum(map(cost, ends(i)))) / (len(ends(i)) - 1), i) for i in inner(0)]:
            if min(links)[0] > a:
                break
            cut.add(min(links)[1])
        assert (trees[a].numNodes + 1) // 2 == len(ends(0))
    # a pruned tree is saved and scored like any other
    path = sinks.save_model(fitted[1e-3], shared_folder(spark), "pruned")
    assert score(sinks.load_model(path)) == score(fitted[1e-3])
    assert models.score(fitted[1e-3], learnable).select("score").distinct().count() <= leaves[2]


def _saved(spark, tree):
    path = shared_folder(spark) + "/tree"
    tree.write().save(path)
    return path + "/data"


def test_a_forest_that_keeps_the_nodes_of_its_rows_has_the_same_trees(spark):
    rng = random.Random(4)
    lines = [(Vectors.dense([rng.random() for _ in range(4)]), float(rng.random() < 0.4), 1.0) for _ in range(600)]
    rows = spark.createDataFrame(lines, ["features", "y", "_w"]).coalesce(1)
    shallow, deep = ({**models.DEFAULTS["random_forest"], "n_trees": 4, "max_depth": d, "min_samples_leaf": 5} for d in (5, 12))
    kept = models._classifier("random_forest", shallow, 600.0, 3)
    assert kept.getCacheNodeIds()
    assert not models._classifier("random_forest", deep, 600.0, 3).getCacheNodeIds()
    trees = kept.fit(rows).toDebugString.split("\n")[1:]
    assert trees == kept.copy().setCacheNodeIds(False).fit(rows).toDebugString.split("\n")[1:]
