"""The warehouse connector and store settings per read."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from result_rows import rows
from lakeload.session import scratch_dir
from lakeload.sinks.tables import copy_table
from lakeload.sources import warehouse
from lakeload.sources.connectors import scan_connector
from lakeload.sources.files import scan_object_store

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def fmt(spark):
    return warehouse.register(spark)


def local(spark, name):
    path = scratch_dir(spark, name).removeprefix("file://")
    os.makedirs(path)
    return path


def test_a_query_is_read_in_parts(spark, fmt):
    got = scan_connector(spark, fmt, {"database": SF, "partitionColumn": "o_orderkey", "numPartitions": "7"}, "SELECT o_orderkey, o_orderdate FROM orders")
    assert got.rdd.getNumPartitions() == 7
    want = duckdb.sql(f"SELECT o_orderkey, o_orderdate FROM '{SF}/orders.parquet'").fetchall()
    assert rows(got) == sorted(want, key=repr) and dict(got.dtypes)["o_orderdate"] == "timestamp_ntz"
    sizes = [len(p) for p in got.rdd.glom().collect()]
    assert min(sizes) > 0.5 * max(sizes)


@pytest.mark.parametrize("parts", ["1", "4"])
def test_filters_run_in_the_source_and_nulls_are_in_one_part(spark, fmt, parts):
    query = "SELECT CASE WHEN n % 5 = 0 THEN NULL ELSE n END AS k, n, 'v' || n AS v FROM range(50) t(n)"
    df = scan_connector(spark, fmt, {"database": SF, "partitionColumn": "k", "numPartitions": parts}, query)
    assert df.count() == 50 and df.where("k IS NULL").count() == 10
    assert rows(df.where("n < 7 AND v <> 'v3' AND k IN (1, 2, 6)"), "k") == [(1,), (2,), (6,)]
    assert rows(df.where("NOT (n >= 3)"), "n") == [(0,), (1,), (2,)]
    assert rows(df.where("k <=> NULL AND n = 10"), "v") == [("v10",)]
    reader = warehouse.WarehouseReader({"database": SF, "query": query}, df.schema)
    left = list(reader.pushFilters([warehouse.ds.EqualTo(("n",), 3), warehouse.ds.StringContains(("v",), "x"), warehouse.ds.Not(warehouse.ds.IsNull(("k",)))]))
    assert [type(f).__name__ for f in left] == ["StringContains"]
    assert reader.statement(warehouse.Part()) == (f'SELECT * FROM ({query}) q WHERE "n" = ? AND NOT ("k" IS NULL)', [3])


def test_rows_come_while_the_engine_makes_them():
    query = "SELECT CASE WHEN n < 400000 THEN n ELSE error('too late') END AS n FROM range(500000) t(n)"
    schema = warehouse.T.StructType([warehouse.T.StructField("n", warehouse.T.LongType())])
    got = warehouse.WarehouseReader({"database": SF, "query": query}, schema).read(warehouse.Part("n >= ?", [5]))
    first = next(got)
    assert 0 < first.num_rows <= warehouse.BATCH_ROWS and first.column(0)[0].as_py() == 5
    with pytest.raises(Exception, match="too late"):
        for _ in got:
            pass


def test_what_a_task_has_no_memory_for_goes_to_its_own_disk(monkeypatch, tmp_path):
    monkeypatch.setattr(warehouse, "TASK_MEMORY", "60MB")
    monkeypatch.setattr(warehouse.tempfile, "tempdir", str(tmp_path))
    query = "SELECT n, v FROM (SELECT (n * 7919) % 1000003 AS n, repeat(md5(n::VARCHAR), 4) AS v FROM range(1000003) t(n)) ORDER BY n"
    schema = warehouse.T.StructType([warehouse.T.StructField("n", warehouse.T.LongType()), warehouse.T.StructField("v", warehouse.T.StringType())])
    reader, used, n = warehouse.WarehouseReader({"database": SF, "query": query}, schema), [], 0
    for batch in reader.read(warehouse.Part()):
        assert batch.column(0).to_pylist() == list(range(n, n + batch.num_rows))
        n += batch.num_rows
        used = used or [f for f in tmp_path.rglob("*") if f.is_file()]
    assert n == 1000003 and used and not list(tmp_path.iterdir())


def test_tables_are_copied_replaced_and_appended(spark, fmt):
    db = local(spark, "t_db")
    source = {"database": SF, "dbtable": "nation"}
    assert copy_table(spark, fmt, source, fmt, {"database": db, "dbtable": "n"}, check_data=True, preview_rows=0) == 25
    read = lambda: scan_connector(spark, fmt, {"database": db, "dbtable": "n"})
    assert rows(read()) == rows(spark.read.parquet(f"{SF}/nation.parquet"))
    copy_table(spark, fmt, source, fmt, {"database": db, "dbtable": "n"}, mode="append", query="SELECT * FROM nation WHERE n_nationkey < 3")
    assert read().count() == 28
    copy_table(spark, fmt, source, fmt, {"database": db, "dbtable": "n"}, query="SELECT * FROM nation WHERE n_nationkey < 0")
    assert read().count() == 0 and read().columns == ["n_nationkey", "n_name", "n_regionkey"]
    assert sorted(os.listdir(db)) == ["n.parquet"]


def test_a_failing_task_leaves_nothing_behind(spark, fmt):
    db = local(spark, "t_db")
    spark.range(10).repartition(2).write.format(fmt).mode("overwrite").options(database=db, dbtable="t").save()
    before = sorted(os.listdir(f"{db}/t.parquet"))
    bad = spark.range(100).repartition(4).select(F.when(F.col("id") == 77, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        bad.write.format(fmt).mode("overwrite").options(database=db, dbtable="t").save()
    assert os.listdir(db) == ["t.parquet"] and sorted(os.listdir(f"{db}/t.parquet")) == before


@pytest.mark.parametrize("options", [{}, {"database": SF}])
def test_missing_options_are_named(spark, fmt, options):
    with pytest.raises(Exception, match="needs the option"):
        spark.read.format(fmt).options(**options).load().count()


def test_reads_of_one_store_with_different_settings_do_not_mix(spark):
    at = lambda table: {"fs.viewfs.mounttable.t.link./x": f"file://{SF}/{table}.parquet"}
    region, nation = (scan_object_store(spark, "viewfs://t/x", at(t)) for t in ("region", "nation"))
    again = scan_object_store(spark, "viewfs://t/x", at("region"))
    assert (region.count(), nation.count(), again.count()) == (5, 25, 5)
    joined = region.join(nation.withColumnRenamed("n_regionkey", "r_regionkey"), "r_regionkey")
    assert joined.count() == 25 and joined.select("r_name").distinct().count() == 5
    assert spark.sparkContext._jsc.hadoopConfiguration().get("fs.viewfs.mounttable.t.link./x") is None


# ---------------------------------------------------------------- listing in tasks

def test_a_tree_listed_by_tasks_equals_the_index(spark, tmp_path):
    from lakeload.sources.inventory import file_inventory, list_tree
    for i in range(60):
        folder = tmp_path / f"a{i % 4}" / f"b {i % 7}%41" / f"c{i}"
        folder.mkdir(parents=True)
        for j in range(50):
            (folder / f"f{j}.txt").write_text("x" * (j + 1))
        (folder / "_hidden").write_text("x")
    (tmp_path / "top.csv").write_text("y")
    (tmp_path / "empty").mkdir()
    tree, index = list_tree(spark, [f"file:{tmp_path}"]), file_inventory(spark, str(tmp_path))
    assert tree.count() == 3001 and tree.schema["modificationTime"].dataType == index.schema["modificationTime"].dataType
    cut = lambda df: sorted((r["name"], r["length"], r["modificationTime"].replace(microsecond=0), r["path"].count("/")) for r in df.collect())
    assert cut(tree) == cut(index)
    assert {r[0] for r in tree.where("name = 'f1.txt'").select("path").collect()} == {f"file:{p}" for p in tmp_path.rglob("f1.txt")}
    assert [r["name"] for r in list_tree(spark, [f"file:{tmp_path}"], ".csv").collect()] == ["top.csv"]
    prefixes = spark.createDataFrame([(f"file:{tmp_path}/a{i}",) for i in range(4)], "path string")
    assert list_tree(spark, prefixes).count() == 3000
    (tmp_path / "empty" / "nothing.txt").touch()
    assert rows(list_tree(spark, [f"file:{tmp_path}/empty"]), "name", "length") == [("nothing.txt", 0)]
