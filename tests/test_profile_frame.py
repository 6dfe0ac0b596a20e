import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortlens.functions.columns import clean_floats, safe_corr
from cohortlens.operators import frame, profile

from .conftest import rows

NAN = float("nan")


@pytest.fixture(scope="module")
def table(spark):
    data = [
        (1, "g1", 1.0, 1.5, 2.0, "x", None, 7, True, "m1", 10.0, 55.0),
        (2, "g1", 0.0, NAN, 1.0, None, None, 7, False, "m1", 20.0, 60.0),
        (3, "g2", 1.0, 3.5, None, "y", None, 7, None, "m1", None, 70.0),
        (4, None, 0.0, None, 4.0, "x", None, 7, True, "m1", 40.0, None),
    ]
    schema = (
        "row_id int, group_id string, y double, a double, b double, c string, all_null double, const int, flag boolean, "
        "_batch string, lag1_rate double, goal_t double"
    )
    return clean_floats(spark.createDataFrame(data, schema))


def test_nan_becomes_null(table):
    assert table.where("a is null").count() == 2 and table.where(F.isnan("a")).count() == 0


def test_profile(table):
    got = {r["column"]: r for r in profile.profile(table).collect()}
    assert got["all_null"]["pct_missing"] == 100.0 and got["all_null"]["n_unique"] == 0
    assert got["a"]["non_null"] == 2 and got["c"]["n_unique"] == 2 and got["flag"]["n_unique"] == 2
    first = profile.profile(table).first()
    assert first["column"] == "all_null"
    assert profile.null_cells(table).first()[0] == sum(r["pct_missing"] for r in got.values()) * 4 / 100


def test_negative_zero_is_zero(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (1.0,)], "x double")
    assert profile.distinct_counts(df).first()["n_unique"] == 2


def test_target_balance_keeps_missing_and_needs_the_column(spark):
    df = spark.createDataFrame([(1,), (1,), (0,), (None,)], "y int")
    assert [tuple(r) for r in profile.target_balance(df).collect()] == [(1, 2, 0.5), (0, 1, 0.25), (None, 1, 0.25)]
    with pytest.raises(KeyError):
        profile.target_balance(df, "nothing")


def test_correlation_is_pairwise_complete_and_null_on_constants(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"y": rng.integers(0, 2, 50).astype(float), "a": rng.normal(size=50), "k": 0.1})
    pdf.loc[::4, "a"] = np.nan
    df = clean_floats(spark.createDataFrame(pdf))
    got = df.agg(safe_corr(F.col("a"), F.col("y")), safe_corr(F.col("k"), F.col("y"))).first()
    assert got[0] == pytest.approx(pdf["a"].corr(pdf["y"])) and got[1] is None
    assert [r["column"] for r in profile.correlation_with_target(df).collect()] == ["a"]
    m = {(r["col_a"], r["col_b"]): r["r"] for r in profile.correlation_matrix(df, ["y", "a"]).collect()}
    assert m["a", "a"] == pytest.approx(1.0) and m["a", "y"] == m["y", "a"]


def test_histogram_closes_the_last_bin_and_keeps_empty_ones(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 0, 1, 15]] + [(None,)], "x double")
    got = [(r["bin"], r["n"]) for r in profile.histogram(df, "x").orderBy("bin").collect()]
    assert len(got) == 15 and got[0] == (0, 2) and got[1] == (1, 1) and got[14] == (14, 1) and sum(n for _, n in got) == 4
    one = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert profile.histogram(one, "x").agg(F.sum("n")).first()[0] == 2


def test_describe_equals_pandas(spark):
    values = np.random.default_rng(2).gamma(2, size=101).round(3)
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got, want = profile.describe(df).first(), pd.Series(values).describe().round(2)
    assert [got[c] for c in ("count", "mean", "std", "min", "q25", "q50", "q75", "max")] == pytest.approx(list(want))


def test_rates_and_grain(table):
    kept = profile.rate_by_category(table, "c").collect()
    assert {r["category"] for r in kept} == {"x", "y", None}
    assert profile.rate_by_category(table, "c", keep_missing=False, top=None).count() == 2
    assert profile.grain_check(table, "group_id", "lag1_rate").first()[0] == 2
    assert rows(profile.null_rates(table, "lag1_")) == [("lag1_rate", 25.0)]


def test_model_frame_drops_what_it_should(table):
    out = frame.build_model_frame(table)
    assert "all_null" not in out.columns and "const" not in out.columns
    assert "_batch" in out.columns  # metadata is never judged constant
    assert "goal_gap" in out.columns and dict(out.dtypes)["y"] == "int"
    gaps = {r["row_id"]: r["goal_gap"] for r in out.collect()}
    assert gaps == {1: 45.0, 2: 40.0, 3: None, 4: None}
    roles = frame.feature_roles(out)
    assert "flag" in roles.numeric and "c" in roles.categorical and roles.high_card == []
    assert not {"y", "group_id", "row_id", "_batch"} & set(roles.features)
    assert roles.numeric[:2] == ["lag1_rate", "goal_t"]


def test_model_frame_refuses_bad_targets(table):
    with pytest.raises(KeyError):
        frame.build_model_frame(table.drop("y"))
    with pytest.raises(ValueError):
        frame.build_model_frame(table.withColumn("y", F.when(F.col("row_id") > 1, F.col("y"))))
    with pytest.raises(KeyError):
        frame.model_rows(table.drop("group_id"), frame.Roles(["a"], []))


def test_gap_that_is_constant_is_dropped(spark):
    df = spark.createDataFrame([(1, "g", 1.0, 10.0, 20.0), (2, "h", 0.0, 20.0, 30.0)], "row_id int, group_id string, y double, lag1_rate double, goal_t double")
    assert "goal_gap" not in frame.build_model_frame(df).columns


def test_eda_roles_differ_from_model_roles(table):
    names = frame.eda_features(table)
    assert "group_id" in names and "_batch" not in names
    numeric, categorical = frame.split_by_type(table, names)
    assert "flag" in categorical and "a" in numeric
    assert frame.by_prefix(table, "lag1_") == ["lag1_rate"]


def test_many_levels_are_no_feature(spark):
    df = spark.range(100).select(F.col("id").alias("row_id"), F.lit("g").alias("group_id"), (F.col("id") % 2).alias("y"), F.concat(F.lit("v"), F.col("id") % 31).alias("wide"), F.concat(F.lit("v"), F.col("id") % 30).alias("narrow"))
    assert frame.feature_roles(df).categorical == ["narrow"]


def test_missing_group_is_named(table):
    assert rows(frame.model_rows(table, frame.Roles(["a"], [])).where("group_id = '__NULL__'"), "row_id") == [(4,)]


def test_log_keeps_missing(spark):
    df = spark.createDataFrame([(None,), (-3.0,), (0.0,)], "x double")
    assert rows(df.select(frame.log_clipped("x").alias("v"))) == [(0.0,), (0.0,), (None,)]


def test_correlations_of_many_columns_in_one_pass(spark):
    """79 columns with gaps, constants and values far from 0, against numpy pair by pair."""
    import numpy as np

    rng = np.random.default_rng(5)
    n, k = 300, 79
    x = rng.normal(size=(n, 6)) @ rng.normal(size=(6, k)) + rng.normal(size=(n, k))
    x[:, 3] = 0.1
    x[:, 4] = 1e9 + x[:, 5] * 1e-2
    gaps = rng.random((n, k)) < 0.15
    gaps[:, 0] = False
    gaps[:, 6] = True
    data = [[None if g else float(v) for v, g in zip(row, gap)] for row, gap in zip(x, gaps)]
    names = [f"x{i}" for i in range(k)]
    df = spark.createDataFrame(data, ", ".join(f"{c} double" for c in names)).repartition(3)
    got = {(r["col_a"], r["col_b"]): r["r"] for r in profile.correlation_matrix(df, names).collect()}
    assert len(got) == k * k
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            both = ~gaps[:, i] & ~gaps[:, j]
            u, v = x[both, i], x[both, j]
            if not both.any() or u.min() == u.max() or v.min() == v.max():
                assert got[a, b] is None
            else:
                assert abs(got[a, b] - np.corrcoef(u, v)[0, 1]) < 1e-6
    assert profile.correlation_matrix(df, []).count() == 0
