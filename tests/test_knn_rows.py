"""The nearest-neighbor model takes all training rows."""

import numpy as np
import pytest

from pyspark.sql import functions as F

from cohortlens.catalog import models as catalog
from cohortlens.operators import models, splits
from cohortlens.operators.frame import Roles
from cohortlens.session import shared_folder
from cohortlens.worklist import Worklist


@pytest.fixture(scope="module")
def units(spark):
    rng = np.random.default_rng(3)
    n = 900
    x = rng.normal(size=(n, 4))
    y = (x[:, 0] + rng.normal(scale=0.5, size=n) > 0).astype(float)
    data = [(i, f"g{i % 45}", float(y[i]), *map(float, x[i]), "pq"[i % 2], "ns"[i % 3 % 2]) for i in range(n)]
    schema = "row_id long, group_id string, y double, lag1_rate double, acctbal double, weight double, goal_gap double, network string, region string"
    return spark.createDataFrame(data, schema).cache()


def test_the_registered_model_is_fitted_on_all_training_rows(spark, units, monkeypatch):
    # 50,000 rows were the most; here 100 would be
    monkeypatch.setattr(models, "KNN_ROWS", 100, raising=False)
    monkeypatch.setattr(catalog, "model_input", lambda spark, sf: units)
    fitted, fit = [], models.fit_model
    monkeypatch.setattr(models, "fit_model", lambda *a: fitted.append(fit(*a)) or fitted[-1])
    assert catalog.h10_model(spark, "").first()["roc_auc"] > 0.8
    assert fitted[0].base.count() == splits.grouped_holdout(units).where("not is_test").count() > 100


def test_a_training_row_without_a_key_is_an_error(spark, units, monkeypatch):
    monkeypatch.setattr(catalog, "model_input", lambda spark, sf: units.selectExpr("nullif(row_id, 5) row_id", "* except (row_id)"))
    with pytest.raises(Exception, match="'row_id' is missing in some rows"):
        catalog.h10_model(spark, "").collect()


def test_a_search_keeps_all_rows_unless_a_number_is_given(spark):
    rows = spark.range(50_100).select(
        F.col("id").alias("row_id"), F.concat(F.lit("g"), F.col("id") % 500).alias("group_id"), (F.col("id") % 2).cast("double").alias("y"), F.rand(1).alias("a")
    )
    roles = Roles(["a"], [])
    folds = models.FoldMatrices(rows, roles, Worklist(spark, shared_folder(spark), "whole"), k=2)
    assert folds.folded().where("capped").count() == 50_100
    assert folds.fit_rows("knn", None).count() == 50_100
    assert folds.fit_rows("knn", 0).count() + folds.held_rows("knn", 0).count() == 50_100
    capped = models.FoldMatrices(rows, roles, Worklist(spark, shared_folder(spark), "capped"), k=2, knn_rows=300)
    assert capped.folded().where("capped").count() == 300


def test_a_search_over_rows_without_a_key_is_an_error(units):
    rows = units.selectExpr("nullif(row_id, 5) row_id", "* except (row_id)")
    with pytest.raises(Exception, match="'row_id' is missing in some rows"):
        models.search("logistic", rows, Roles(["lag1_rate"], []), n_draws=1, k=2)
