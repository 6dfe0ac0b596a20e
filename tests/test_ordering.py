import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.functions.seeded import seeded_tag, take_lowest
from cohortlens.operators.ordering import exact_quantiles, global_rank, running_totals

from .conftest import rows


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("range_rows", [10**6, 7])
def test_running_totals_match_a_plain_sum(spark, descending, range_rows):
    values = np.random.default_rng(1).permutation(3000) / 7.0
    df = spark.createDataFrame([(float(v), i % 5) for i, v in enumerate(values)], "v double, n long")
    got = {r["v"]: r["cum_n"] for r in running_totals(df, "v", ["n"], descending=descending, range_rows=range_rows).collect()}
    order = sorted(((float(v), i % 5) for i, v in enumerate(values)), reverse=descending)
    total = 0
    for v, n in order:
        total += n
        assert got[v] == total


def test_running_totals_per_stratum(spark):
    df = spark.range(4000).select((F.col("id") % 4).cast("int").alias("g"), (F.col("id") * 1.5).alias("v"), F.lit(1).alias("n"))
    out = running_totals(df, "v", ["n"], by=["g"], range_rows=7)
    bad = out.where(F.col("cum_n") != F.floor(F.col("v") / 6) + 1)
    assert out.count() == 4000 and bad.count() == 0


@pytest.mark.parametrize("range_rows", [10**6, 7])
def test_rank_with_a_heavy_tie(spark, range_rows):
    # 60% of the rows share one value, some have none
    df = spark.range(5000).select(
        F.col("id").cast("string").alias("k"),
        F.when(F.col("id") % 97 == 0, None).when(F.col("id") % 5 < 3, F.lit(0.25)).otherwise(F.col("id") / 5000).alias("v"),
    )
    got = global_rank(df, "v", "k", descending=True, range_rows=range_rows).withColumn("tag", F.concat(seeded_tag(42, "k"), "k")).collect()
    expected = sorted(got, key=lambda r: (r["v"] is None, -(r["v"] or 0), r["tag"]))
    assert [r["rank"] for r in expected] == list(range(1, 5001))


def test_quantiles_equal_numpy_and_skip_missing(spark):
    values = np.random.default_rng(3).normal(size=501).round(2)
    data = [(float(v), float(i) if i % 3 else None) for i, v in enumerate(values)] + [(float("nan"), None)]
    df = spark.createDataFrame(data, "a double, b double")
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    got = {(r["column"], r["prob"]): r["value"] for r in exact_quantiles(df, ["a", "b"], probs, range_rows=7).collect()}
    b = [i for i in range(501) if i % 3]
    for p in probs:
        assert got["a", p] == pytest.approx(np.quantile(values, p))
        assert got["b", p] == pytest.approx(np.quantile(b, p))


def test_median_of_even_count_is_the_mean_of_the_middle(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (10,)], "x int")
    assert exact_quantiles(df, ["x"], [0.5]).first()["value"] == 2.5


def test_sample_has_exact_size_does_not_depend_on_partitions_and_is_nested(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    small = {r[0] for r in take_lowest(df, 137, "k").collect()}
    again = {r[0] for r in take_lowest(df.repartition(13), 137, "k").collect()}
    large = {r[0] for r in take_lowest(df, 500, "k").collect()}
    assert len(small) == 137 and small == again and small < large
    assert take_lowest(df, 5000, "k").count() == 2000
    assert take_lowest(df, 0, "k").count() == 0
    assert rows(take_lowest(df, 2000, "k")) == rows(df)
