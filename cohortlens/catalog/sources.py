"""Queries for the sources and sinks. Each writes the given tables to the shared folder and reads them back."""

from pyspark.sql import Window, functions as F

from cohortlens.catalog.registry import query, r6, with_
from cohortlens.plans.bindings import UNIT_BASE_SQL, table, unit_base
from cohortlens.session import shared_folder
from cohortlens.sources import preview, samples, sinks, snapshot, tables


def _orders_by_year(spark, sf):
    return table(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))


YEAR_SQL = """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n, round(sum(o_totalprice), 2) AS total
FROM orders {where} GROUP BY 1"""


def _by_year(df):
    return df.groupBy("year").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("a2_partition_read", YEAR_SQL.format(where="WHERE year(o_orderdate) = 1997"))
def a2(spark, sf):
    path = shared_folder(spark) + "/orders"
    _orders_by_year(spark, sf).write.partitionBy("year").parquet(path)
    return _by_year(tables.read_partition(spark, path, 1997))


def yearly_files(spark, sf):
    """The folder of the orders with one folder a year, as Spark writes and lists them."""
    path = shared_folder(spark) + "/by_year"
    _orders_by_year(spark, sf).write.partitionBy("year").parquet(path)
    return path


@query("a3_snapshot_read", YEAR_SQL.format(where=""))
def a3(spark, sf):
    """All files that make up a table without a log."""
    path = yearly_files(spark, sf)
    return _by_year(spark.read.option("basePath", path).parquet(*snapshot.recent_files(spark, path)))


@query("a3_snapshot_partition", YEAR_SQL.format(where="WHERE year(o_orderdate) = 1998"))
def a3_year(spark, sf):
    """The files of one partition."""
    path = yearly_files(spark, sf)
    lake = tables.Lake(root="", facts=("orders",), context=(), modeling="orders", paths={"orders": path})
    if not tables.list_files(spark, path, 1998):
        return _by_year(_orders_by_year(spark, sf).where("year = 1998"))
    return _by_year(tables.load(spark, lake, "orders", 1998, ["year", "o_totalprice"]))


def status_batches(spark, sf):
    """Orders in three appends, one status after the other, without a log. Names grow, as times may tie on some stores."""
    path = shared_folder(spark) + "/batches"
    rows = table(spark, sf, "orders")
    for i, status in enumerate(("F", "O", "P")):
        rows.where(F.col("o_orderstatus") == status).write.parquet(f"{path}/batch={i}")
    return path


@query(
    "a4_recent_files",
    """SELECT row_number() OVER (ORDER BY o_orderstatus DESC) AS position, o_orderstatus, n FROM
(SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1)""",
)
def a4(spark, sf):
    """Files newest first, shown by the status that each append holds."""
    path = status_batches(spark, sf)
    files = snapshot.recent_files(spark, path)
    order = spark.createDataFrame(list(enumerate(files)), "place int, file string").select("place", F.regexp_extract("file", "/(batch=[^/]*/[^/]*)$", 1).alias("file"))
    rows = spark.read.option("basePath", path).parquet(*files)
    held = rows.groupBy("o_orderstatus", F.regexp_extract(F.col("_metadata.file_path"), "/(batch=[^/]*/[^/]*)$", 1).alias("file")).agg(F.count("*").alias("n"))
    found = held.join(order, "file").groupBy("o_orderstatus").agg(F.min("place").alias("place"), F.sum("n").alias("n"))
    # three statuses
    return found.select(F.row_number().over(Window.orderBy("place")).cast("long").alias("position"), "o_orderstatus", "n")


@query("a5_column_pruned", "SELECT o_orderkey, o_totalprice FROM orders")
def a5(spark, sf):
    lake = tables.Lake(root=sf, facts=("orders.parquet",), context=(), modeling="orders.parquet")
    return tables.load(spark, lake, "orders.parquet", year="", columns=["o_orderkey", "o_totalprice"])


@query("a6_bounded_files", "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus = 'P' GROUP BY 1")
def a6(spark, sf):
    """Only the files of the newest append."""
    path = status_batches(spark, sf)
    newest = snapshot.file_listing(spark, f"{path}/batch=2").count()
    lake = tables.Lake(root="", facts=("orders",), context=(), modeling="orders", paths={"orders": path})
    return tables.load(spark, lake, year="", max_files=newest).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query(
    "a7_union_by_name",
    """SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderstatus = 'F'
UNION ALL BY NAME SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'F'""",
)
def a7(spark, sf):
    rows = table(spark, sf, "orders")
    new = rows.where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice", "o_orderpriority")
    return tables.union_by_name([new, rows.where("o_orderstatus <> 'F'").select("o_orderkey", "o_totalprice")])


@query(
    "a11_stored_sample",
    "SELECT event_id, event_type FROM events ORDER BY md5('42:' || event_id) || event_id LIMIT 700",
)
def a11(spark, sf):
    lake = tables.Lake(root=sf, facts=("events.parquet",), context=(), modeling="events.parquet", row_key="event_id")
    folder = shared_folder(spark)
    for _ in range(2):  # the second call reads what the first one wrote
        out = samples.stored_sample(spark, lake, folder, n=700, year="", balance_on=None)
    return out.select("event_id", "event_type")


@query(
    "a12_policy_loader",
    """SELECT 'events.parquet' AS name, least(count(*), 800) AS n FROM events
UNION ALL SELECT 'nation.parquet', count(*) FROM nation UNION ALL SELECT 'region.parquet', count(*) FROM region""",
)
def a12(spark, sf):
    lake = tables.Lake(
        root=sf, facts=("events.parquet",), context=("nation.parquet", "region.parquet"), row_key="event_id"
    )
    out = None
    for name, df in tables.load_tables(spark, lake, 800, "").items():
        part = df.agg(F.lit(name).alias("name"), F.count("*").alias("n"))
        out = part if out is None else out.unionByName(part)
    return out


REGION_SQL = """SELECT region, count(*) AS n, round(avg(score), 9) AS mean_score FROM unit_base GROUP BY 1"""


def _region(spark, sf):
    return unit_base(spark, sf).groupBy("region").agg(F.count("*").alias("n"), F.round(F.avg("score"), 9).alias("mean_score"))


@query("a14_csv_sink", with_(UNIT_BASE_SQL, REGION_SQL))
def a14(spark, sf):
    path = sinks.save_table(_region(spark, sf), shared_folder(spark) + "/region")
    return spark.read.schema("region string, n long, mean_score double").csv(path, header=True)


@query("a15_json_sink", with_(UNIT_BASE_SQL, REGION_SQL))
def a15(spark, sf):
    path = sinks.save_json(_region(spark, sf), shared_folder(spark) + "/region")
    return spark.read.schema("region string, n long, mean_score double").json(path)


@query("a17_shape", "SELECT count(*) AS n_rows, 6 AS n_columns FROM orders")
def a17(spark, sf):
    return preview.shape(table(spark, sf, "orders"))


@query("a17_head", "SELECT * FROM customer ORDER BY c_custkey LIMIT 5")
def a17_head(spark, sf):
    return preview.head(table(spark, sf, "customer"), "c_custkey")


@query("a17_tail", "SELECT * FROM customer ORDER BY c_custkey DESC LIMIT 5")
def a17_tail(spark, sf):
    return preview.tail(table(spark, sf, "customer"), "c_custkey")


@query("a13_modeling_table", with_(UNIT_BASE_SQL, "SELECT row_id, y, round(acctbal, 6) AS acctbal FROM unit_base"))
def a13(spark, sf):
    """The modeling table without its all-null columns."""
    lake = tables.Lake(root=sf)
    out = tables.modeling_table({"unit_analytic": unit_base(spark, sf).select("row_id", "y", "acctbal", "lag1_empty")}, lake)
    return out.select(*[r6(c) if c == "acctbal" else c for c in out.columns])
