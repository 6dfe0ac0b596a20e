import pytest
from pyspark.sql import functions as F

from cohortlens.operators import decide, enrich

from .conftest import rows


@pytest.fixture(scope="module")
def units(spark):
    data = [
        (1, "a", 1, 0.9, 80.0, None, "north", "n1"),
        (2, "a", 0, 0.5, 80.0, 60.0, "north", "n2"),
        (3, "b", 0, 0.2, None, 90.0, "south", "n1"),
        (4, "c", 1, 0.2, 10.0, 15.0, None, None),
        (5, None, 1, 0.1, 10.0, 10.0, "south", "n1"),
    ]
    return spark.createDataFrame(
        data, "row_id int, group_id string, y int, score double, goal_t double, goal_t1 double, region string, network string"
    )


def test_risk_table(units):
    got = {r["group_id"]: r for r in decide.group_risk(units).collect()}
    assert set(got) == {"a", "b", "c"}  # rows without a group are left out
    assert got["a"]["n_units"] == 2 and got["a"]["predicted_rate"] == pytest.approx(0.7)
    assert got["a"]["network"] == "n1" and got["c"]["network"] is None
    assert got["a"]["gap_goal_t"] == pytest.approx(-10) and got["a"]["misses_goal_t"] is True
    assert got["b"]["gap_goal_t"] is None and got["b"]["misses_goal_t"] is False
    assert got["a"]["goal_t1"] == 60.0 and got["a"]["misses_goal_t1"] is False
    assert {got["b"]["rank"], got["c"]["rank"]} == {1, 2} and got["a"]["rank"] == 3


def test_region_profile_is_unweighted_and_drops_missing(units):
    got = rows(decide.region_profile(decide.group_risk(units)).select("region", "n_groups", F.round("mean_risk", 6), "n_units"))
    assert got == [("north", 1, 0.3, 2), ("south", 1, 0.8, 1)]
    assert decide.region_profile(decide.group_risk(units.drop("region"))).count() == 0


def test_dominant_category_and_crosstab(spark):
    df = spark.createDataFrame(
        [("a", 0, "n"), ("b", 0, "n"), ("c", 0, "s"), ("d", 1, "s"), ("e", 1, None), ("f", None, "s")], "group_id string, cluster int, region string"
    )
    assert rows(decide.dominant_category(df.where("cluster is not null"))) == [(0, "n", 0.6667), (1, "s", 1.0)]
    tab = decide.region_cluster_crosstab(df)
    assert rows(tab, "region", "cluster_0", "cluster_1") == [("n", 1.0, 0.0), ("s", 0.5, 0.5)]
    assert rows(decide.crosstab_long(tab).groupBy("region").agg(F.sum("share"))) == [("n", 1.0), ("s", 1.0)]
    profile = decide.cluster_profile(df.withColumn("v", F.lit(1.0)), ["v"])
    assert rows(profile, "cluster", "n_groups") == [(0, 3), (1, 2)]


def test_prior_year_ignores_gaps(spark):
    rates = spark.createDataFrame([("a", 2020, 1.0), ("a", 2022, 3.0), ("a", 2023, 4.0)], "g string, year int, rate double")
    assert rows(enrich.prior_year(rates, ["g"], ["rate"]), "year", "lag1_rate") == [(2020, None), (2022, None), (2023, 3.0)]


def test_contracts(spark):
    df = spark.createDataFrame([(1, None, 2.0, 1), (1, "x", 6.0, 0)], "k int, c string, weight double, y int")
    assert rows(enrich.grain_breaks(df, ["k"])) == [(1, 2)]
    assert rows(enrich.match_coverage(df, "c")) == [(0.5,)]
    assert [r["ok"] for r in enrich.missingness_breaks(df, {"c": 40}).collect()] == [False]
    assert rows(enrich.weighted_rate(df, "k"), "weighted_rate") == [(0.25,)]
    assert enrich.drop_invalid(df, "c", ["x"]).count() == 1
