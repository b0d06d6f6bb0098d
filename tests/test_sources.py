from __future__ import annotations

import pytest

from plumbline.sources import readers


def test_csv_scan_reads_missing_tokens_as_null(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name,price\n1,x,1.5\n2,NA,\n3,,2\n4,null,3\n")
    df = readers.read_source(spark, str(tmp_path / "a.csv"))
    assert dict(df.dtypes) == {"id": "int", "name": "string", "price": "double"}
    assert [r["name"] for r in df.orderBy("id").collect()] == ["x", None, None, None]
    typed = readers.scan_csv(spark, str(tmp_path / "a.csv"), schema="id bigint, name string, price string")
    assert typed.schema["price"].dataType.simpleString() == "string"
    assert readers.read_source(spark, "csv", path=str(tmp_path / "a.csv"), limit=2).count() == 2
    assert readers.read_source(spark, f"csv://{tmp_path}/a.csv", sep=",").count() == 4


def test_other_file_formats(spark, tmp_path):
    df = spark.range(5)
    for kind in ("parquet", "json", "orc"):
        df.write.format(kind).save(str(tmp_path / kind))
        assert readers.read_source(spark, kind, path=str(tmp_path / kind)).count() == 5


def test_snapshots_are_numbered_in_name_order(spark, tmp_path):
    for name, value in (("daily_orders_02", 2), ("daily_orders_10", 10), ("daily_orders_01", 1), ("other", 99)):
        (tmp_path / f"{name}.csv").write_text(f"v\n{value}\n{value}\n")
    df = readers.scan_snapshots(spark, f"{tmp_path}/daily_orders_*.csv")
    assert sorted((r["day"], r["v"]) for r in df.distinct().collect()) == [(1, 1), (2, 2), (3, 10)]
    assert df.count() == 6


def test_union_fills_missing_columns(spark):
    union = readers.union_snapshots(spark.sql("SELECT 1 AS a"), spark.sql("SELECT 2 AS a, 3 AS b"))
    assert sorted((r["a"], r["b"]) for r in union.collect()) == [(1, None), (2, 3)]


def test_postgresql_uri():
    source = readers.resolve("postgresql://me:p%40ss@db:5433/shop?schema=sales", "orders")
    assert source.format == "jdbc" and source.path is None
    assert source.options["url"] == "jdbc:postgresql://db:5433/shop?currentSchema=sales"
    assert source.options["dbtable"] == '"sales"."orders"'
    assert (source.options["user"], source.options["password"]) == ("me", "p@ss")


def test_jdbc_options():
    split = readers.jdbc_options("h", "d", "t", partition=("id", 0, 1000, 8))
    assert split["numPartitions"] == "8" and split["partitionColumn"] == "id" and split["upperBound"] == "1000"
    assert readers.jdbc_options("h", "d", query="SELECT 1")["query"] == "SELECT 1"
    assert readers.jdbc_options("h", "d", "t", limit=5)["query"] == 'SELECT * FROM "public"."t" LIMIT 5'
    both = readers.jdbc_options("h", "d", query="SELECT 1 AS id", partition=("id", 0, 9, 2))
    assert both["dbtable"] == "(SELECT 1 AS id) AS source" and "query" not in both
    for wrong in ({}, {"table": "t", "query": "q"}):
        with pytest.raises(ValueError, match="either"):
            readers.jdbc_options("h", "d", **wrong)
    with pytest.raises(ValueError, match="limited"):
        readers.jdbc_options("h", "d", "t", limit=1, partition=("id", 0, 1, 2))


def test_snowflake_uri():
    source = readers.resolve("snowflake://u:p@acct/ANALYTICS/PUBLIC?warehouse=WH&role=R", "ORDERS")
    assert source.format == "net.snowflake.spark.snowflake"
    wanted = {"sfURL": "acct.snowflakecomputing.com", "sfDatabase": "ANALYTICS", "sfSchema": "PUBLIC", "sfWarehouse": "WH", "sfRole": "R", "dbtable": "ORDERS", "sfUser": "u", "sfPassword": "p"}
    assert source.options == wanted
    limited = readers.resolve("snowflake://u:p@acct/A/P", "ORDERS", limit=3)
    assert limited.options["query"] == 'SELECT * FROM "A"."P"."ORDERS" LIMIT 3' and "dbtable" not in limited.options


@pytest.mark.parametrize("name", ["postgresql", "postgres", "pg"])
def test_type_names(name):
    assert readers.resolve(name, "t", host="h", database="d").options["url"].startswith("jdbc:postgresql://h:5432/d")


@pytest.mark.parametrize("source", ["mysql://h/d", "excel", "file.xlsx", "s3://bucket/a.xlsx"])
def test_unknown_sources_list_the_supported_ones(source):
    with pytest.raises(ValueError, match="supported.*csv.*snowflake"):
        readers.resolve(source, "t")


def test_remote_paths_keep_their_scheme():
    assert readers.resolve("s3a://bucket/a/b.parquet") == readers.Source("parquet", {}, "s3a://bucket/a/b.parquet")


def test_reachability_never_raises(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a\n1\n")
    assert readers.reachable(spark, str(tmp_path / "a.csv"))
    assert not readers.reachable(spark, str(tmp_path / "absent.csv"))
    assert not readers.reachable(spark, "nothing")


def test_listing(spark):
    spark.range(1).createOrReplaceTempView("zz_view")
    spark.range(1).createOrReplaceTempView("aa_view")
    found = readers.list_tables(spark)
    assert found == sorted(found) and {"aa_view", "zz_view"} <= set(found)
    assert "table_schema = 'o''x'" in readers.table_listing_query("o'x")
    assert "'PUBLIC'" in readers.table_listing_query("public", "snowflake")
    assert set(readers.list_sources()) == {"csv", "parquet", "json", "orc", "postgresql", "snowflake"}


def test_schema_inspection_covers_the_whole_table(spark):
    df = spark.range(500).selectExpr("id", "CASE WHEN id < 499 THEN 'v' END AS late_null", "CAST('NaN' AS DOUBLE) AS nan")
    found = {r["column_name"]: r for r in readers.schema_inspect(df).collect()}
    assert not found["id"]["nullable"] and found["late_null"]["nullable"] and found["nan"]["nullable"]
    assert (found["id"]["dtype"], found["id"]["sample"], found["nan"]["sample"]) == ("bigint", "0", None)


def test_schema_inspection_of_lengths_samples_and_defaults(spark):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("n", T.IntegerType(), True, {"CURRENT_DEFAULT": "7"}), T.StructField("s", T.StringType())])
    found = {r["column_name"]: r for r in readers.schema_inspect(spark.createDataFrame([(10, "ab"), (9, "éèê"), (None, None)], schema)).collect()}
    assert (found["n"]["sample"], found["n"]["default"], found["n"]["max_length"]) == ("9", "7", None)
    assert (found["s"]["sample"], found["s"]["default"], found["s"]["max_length"]) == ("ab", None, 3)
