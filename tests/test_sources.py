import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from cohortlens.session import shared_folder
from cohortlens.sources import preview, samples, sinks, snapshot, tables

from .conftest import rows


@pytest.fixture(scope="module")
def lake(spark):
    """A table by year with three commits, one removed and re-added file and a stale one; a second without a log."""
    root = shared_folder(spark)
    base = f"{root}/unit_analytic"
    for year, name, ids in ((2023, "a", range(5)), (2024, "b", range(5, 12)), (2024, "c", range(100, 104)), (2024, "d e+f", range(20, 23))):
        df = spark.createDataFrame([(i, float(i % 2), float("nan") if i % 3 == 0 else 1.0) for i in ids], "row_id int, y double, x double")
        df.coalesce(1).write.parquet(f"{base}/year={year}/{name}.parquet")
    add = lambda year, name: {"add": {"path": f"year={year}/{name}.parquet", "partitionValues": {"year": str(year)}}}
    gone = lambda year, name: {"remove": {"path": f"year={year}/{name}.parquet"}}
    commits = [
        [{"protocol": {"x": 1}}, add(2023, "a"), add(2024, "b"), add(2024, "c")],
        [gone(2024, "b"), gone(2024, "c")],
        [add(2024, "b"), add(2024, "d%20e+f")],
    ]
    import json

    for version, lines in enumerate(commits):
        spark.createDataFrame([(json.dumps(line),) for line in lines], "value string").coalesce(1).write.text(
            f"{base}/{snapshot.LOG}/{version:020d}.json"
        )
    plain = spark.createDataFrame([(1, "s"), (2, "t")], "row_id int, state string")
    plain.coalesce(1).write.parquet(f"{root}/group_context")
    return tables.Lake(root=root)


def test_snapshot_skips_stale_files(spark, lake):
    files = snapshot.active_files(spark, lake.path("unit_analytic"))
    assert [f.split("unit_analytic/")[1] for f in files] == ["year=2023/a.parquet", "year=2024/b.parquet", "year=2024/d e+f.parquet"]
    df = tables.load(spark, lake, year="")
    assert {r[0] for r in df.select("row_id").collect()} == set(range(12)) | {20, 21, 22}
    assert df.where(F.isnan("x")).count() == 0


def test_snapshot_by_year_and_columns(spark, lake):
    df = tables.load(spark, lake, year=2024, columns=["row_id", "year"])
    assert df.columns == ["row_id", "year"] and df.count() == 10
    assert {r[0] for r in df.select("year").collect()} == {2024}
    assert tables.load(spark, lake, year=2024, max_files=1).count() == 7
    assert tables.load(spark, lake).count() == 15  # all years


def test_snapshot_with_a_checkpoint(spark, lake):
    path = shared_folder(spark) + "/t"
    actions = "add struct<path:string,partitionValues:map<string,string>>, remove struct<path:string,partitionValues:map<string,string>>"
    kept = spark.createDataFrame([((("k1", {"year": "2024"})), None), ((("k2", {"year": "2024"})), None)], actions)
    kept.coalesce(1).write.parquet(f"{path}/{snapshot.LOG}/{5:020d}.checkpoint.parquet")
    for version, line in ((3, '{"remove":{"path":"k1"}}'), (6, '{"remove":{"path":"k2"}}'), (7, '{"add":{"path":"k3","partitionValues":{"year":"2023"}}}')):
        spark.createDataFrame([(line,)], "value string").coalesce(1).write.text(f"{path}/{snapshot.LOG}/{version:020d}.json")
    assert snapshot.active_files(spark, path) == [f"{path}/k1", f"{path}/k3"]
    assert snapshot.active_files(spark, path, 2024) == [f"{path}/k1"]
    # a compacted file repeats its commits, and must neither stop the reading nor bring back what later ones removed
    compacted = f"{path}/{snapshot.LOG}/{3:020d}.{6:020d}.compacted.json"
    spark.createDataFrame([('{"add":{"path":"k2","partitionValues":{"year":"2024"}}}',)], "value string").coalesce(1).write.text(compacted)
    assert snapshot.active_files(spark, path) == [f"{path}/k1", f"{path}/k3"]


def test_without_a_log_files_are_listed_newest_first(spark):
    path = shared_folder(spark) + "/plain"
    for i in range(3):
        spark.range(i, i + 1).coalesce(1).write.mode("append").parquet(path)
    files = snapshot.recent_files(spark, path)
    assert [spark.read.parquet(f).first()[0] for f in files] == [2, 1, 0]
    assert all(f.endswith(".parquet") for f in files)


def test_guards(spark, lake):
    with pytest.raises(ValueError):
        tables.load(spark, lake, "nothing")
    with pytest.raises(FileNotFoundError):
        tables.load(spark, lake, "state_indicator")
    with pytest.raises(FileNotFoundError):
        tables.load(spark, lake, year=1999)
    with pytest.raises(KeyError):
        tables.modeling_table({}, lake)


def test_default_year(monkeypatch):
    monkeypatch.delenv(tables.YEAR_VARIABLE, raising=False)
    assert tables.default_year() is None
    monkeypatch.setenv(tables.YEAR_VARIABLE, "")
    assert tables.default_year() is None


def test_policy_and_stored_sample(spark, lake):
    assert tables.load_for_profiling(spark, lake, "unit_analytic", 4, "").count() == 4
    assert tables.load_for_profiling(spark, lake, "group_context", 1, "").count() == 2
    folder = shared_folder(spark)
    first = samples.stored_sample(spark, lake, folder, n=9, year="", balance_on="y")
    assert rows(first) == rows(samples.stored_sample(spark, lake, folder, n=9, year="", balance_on="y"))
    # other arguments, other sample: all that decides the rows is in the name
    plain = samples.stored_sample(spark, lake, folder, n=9, year="", balance_on=None)
    assert rows(plain) == rows(samples.take_lowest(tables.load(spark, lake, year=""), 9, lake.row_key))
    names = {samples.sample_path("f/", "t", None, 5, 42, source=s, balance_on=b) for s in ("a", "b") for b in ("y", None)}
    assert len(names) == 4


def test_partition_filter_reaches_the_scan(spark, lake, capsys):
    path = shared_folder(spark) + "/by_year"
    spark.range(10).withColumn("year", (F.col("id") % 2 + 2023).cast("int")).write.partitionBy("year").parquet(path)
    df = tables.read_partition(spark, path, 2024)
    assert df.count() == 5
    df.explain()
    assert "PartitionFilters: [isnotnull(year" in capsys.readouterr().out


def test_union_and_preview(spark):
    a = spark.createDataFrame([(1, "x")], "k int, c string")
    b = spark.createDataFrame([(2, 5.0)], "k int, d double")
    out = tables.union_by_name([a, b])
    assert rows(out, "k", "c", "d") == [(1, "x", None), (2, None, 5.0)]
    assert rows(preview.shape(out)) == [(2, 3)]
    assert preview.tail(spark.range(9).withColumnRenamed("id", "k"), "k", 2).collect()[0][0] == 7
    assert rows(preview.dtypes(a)) == [("c", "string"), ("k", "int")]


def test_sinks(spark):
    folder = shared_folder(spark)
    df = spark.createDataFrame([("a", 1.5), ("b", None)], "k string, v double")
    paths = sinks.save_tables({"t": df, "none": None, "empty": df.limit(0)}, folder)
    assert set(paths) == {"t"}
    assert rows(spark.read.csv(paths["t"], header=True, schema="k string, v double")) == rows(df)
    assert rows(spark.read.schema("k string, v double").json(sinks.save_json(df, folder + "/j"))) == rows(df)


@pytest.mark.parametrize(("years", "want"), [((1998, 1998, 1998, 2001), [(1998, 3, 3.0)]), ((1997, 2001), [])])
def test_the_partition_query_reads_its_year_whatever_the_last_one_is(spark, tmp_path, years, want):
    orders = [(i, f"{y}-03-0{i + 1}", 1.0) for i, y in enumerate(years)]
    df = spark.createDataFrame(orders, "o_orderkey long, d string, o_totalprice double")
    df.select("o_orderkey", F.to_date("d").alias("o_orderdate"), "o_totalprice").write.parquet(f"{tmp_path}/orders.parquet")
    assert rows(entry.queries()["a3_snapshot_partition"](spark, str(tmp_path))) == want
