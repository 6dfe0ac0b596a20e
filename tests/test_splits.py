import pytest
from pyspark.sql import functions as F

from cohortlens.operators import splits
from cohortlens.operators.attach import attach, lookup_first, shared_keys

from .conftest import rows


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds a third of the rows, one group has no name."""
    return spark.range(3000).select(
        F.col("id").alias("row_id"),
        F.when(F.col("id") % 3 == 0, "big").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("g"), F.col("id") % 40)).alias("group_id"),
        (F.col("id") % 7 < 3).cast("int").alias("y"),
    )


def test_grouped_holdout_takes_whole_groups(skewed):
    named = skewed.where("group_id is not null")
    out = splits.grouped_holdout(named)
    sides = out.groupBy("group_id").agg(F.count_distinct("is_test").alias("n"))
    assert sides.where("n > 1").count() == 0
    assert out.where("is_test").select("group_id").distinct().count() == -(-named.select("group_id").distinct().count() // 5)
    assert shared_keys(out.where("is_test"), out.where("not is_test"), "group_id").first()[0] == 0
    assert rows(out) == rows(splits.grouped_holdout(named.repartition(7)))


def test_random_holdout_keeps_class_shares_exactly(skewed):
    out = splits.random_holdout(skewed)
    for r in out.groupBy("y").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect():
        assert r["t"] == round(0.2 * r["n"])
    assert shared_keys(out.where("is_test"), out.where("not is_test"), "group_id").first()[0] > 0


def test_approximate_holdout_keeps_groups_whole(skewed):
    out = splits.grouped_holdout_approx(skewed.where("group_id is not null"))
    assert out.groupBy("group_id").agg(F.count_distinct("is_test").alias("n")).where("n > 1").count() == 0


def test_folds_are_disjoint_and_complete(skewed):
    named = skewed.where("group_id is not null")
    out = splits.with_folds(named, 5)
    assert out.count() == named.count()
    assert out.groupBy("group_id").agg(F.count_distinct("fold").alias("n")).where("n <> 1").count() == 0
    splits.check_folds(out, 5)
    with pytest.raises(ValueError):
        splits.check_folds(splits.with_folds(named.where("group_id in ('g1', 'g2')"), 5), 5)


def test_folds_have_close_class_shares(spark):
    df = spark.range(6000).select(
        F.col("id").alias("row_id"), (F.col("id") % 300).cast("string").alias("group_id"), (F.xxhash64("id") % 10 < -2).cast("int").alias("y")
    )
    shares = [r[0] for r in splits.with_folds(df, 5).groupBy("fold").agg(F.avg("y")).select("avg(y)").collect()]
    assert max(shares) - min(shares) < 0.02


def test_attach_loses_no_row_and_multiplies_none(spark, skewed):
    table = skewed.where("group_id is not null").groupBy("group_id").agg(F.count("*").alias("n"))
    out = attach(skewed, table, ["group_id"], "row_id", splits=16)
    plain = skewed.join(table, "group_id", "left")
    assert rows(out, "row_id", "group_id", "y", "n") == rows(plain, "row_id", "group_id", "y", "n")


def test_lookup_takes_the_first_known_value_and_only_absent_columns(spark):
    source = spark.createDataFrame(
        [(1, "a", None, 9), (2, "a", "x", 8), (3, "a", "y", 7), (4, "b", None, 6)], "row_id int, group_id string, c string, d int"
    )
    base = source.select("row_id", "group_id", "d")
    assert rows(lookup_first(base, source, "group_id", ["c", "d", "nothing"], "row_id"), "row_id", "c", "d") == [
        (1, "x", 9), (2, "x", 8), (3, "x", 7), (4, None, 6),
    ]


def test_balanced_sample_only_acts_when_classes_differ(spark):
    uneven = spark.range(1000).select(F.col("id").alias("row_id"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    got = {r["y"]: r["n"] for r in splits.class_balanced_sample(uneven, 500).groupBy("y").agg(F.count("*").alias("n")).collect()}
    assert got[0] == 250 and 30 <= got[1] <= 70
    even = uneven.withColumn("y", (F.col("row_id") % 2).cast("int"))
    assert splits.class_balanced_sample(even, 500, max_gap=0.2).count() == 500
    # fewer rows than asked for: nothing is balanced
    assert splits.class_balanced_sample(uneven, 5000).count() == 1000


def test_a_missing_group_is_a_group_and_a_missing_key_an_error(spark):
    df = spark.createDataFrame([(i, None if i % 10 == 0 else str(i % 10)) for i in range(200)], "row_id int, group_id string")
    out = splits.grouped_holdout(df, share=0.2)
    sides = {(r["group_id"], r["is_test"]) for r in out.collect()}
    assert len(sides) == 10 and sum(t for _, t in sides) == 2
    for seed in range(30):  # some seed holds the missing group out
        if splits.grouped_holdout(df, share=0.2, seed=seed).where("group_id is null and is_test").count():
            break
    else:
        raise AssertionError("the missing group was never held out")
    with pytest.raises(Exception, match="missing in some rows"):
        splits.row_cap(df.withColumn("row_id", F.when(F.col("row_id") > 5, F.col("row_id"))), 3).collect()
