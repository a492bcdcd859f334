from loadlens.operators import sinks as SK
from loadlens.operators import store as ST
from loadlens.session import fresh_path

SCHEMA = "user_id string, app_type_id string, ymd long, family string, col string, value string, version long"


def test_upsert_newest_version_wins(spark):
    a = spark.createDataFrame([("u", "1", 1704121200, "Daily", "cnt", "3", 1),
                               ("u", "1", 1704121200, "Daily", "dur", "30", 1)], SCHEMA)
    b = spark.createDataFrame([("u", "1", 1704121200, "Daily", "cnt", "4", 2),
                               ("u", "1", 1704121200, "Daily", "cnt", "9", 0)], SCHEMA)
    got = sorted((r.col, r.value, r.version) for r in ST.upsert(a, b).collect())
    assert got == [("cnt", "4", 2), ("dur", "30", 1)]


def test_month_partitioned_upsert_table(spark):
    path = fresh_path(spark, "test-cells")
    jan = spark.createDataFrame([("u", "1", 1704121200, "Daily", "cnt", "3", 1)], SCHEMA)
    feb = spark.createDataFrame([("u", "1", 1706799600, "Daily", "cnt", "5", 1)], SCHEMA)
    ST.upsert_table(spark, path, jan)
    ST.upsert_table(spark, path, feb)
    ST.upsert_table(spark, path, jan.selectExpr("user_id", "app_type_id", "ymd", "family", "col",
                                                "'7' AS value", "2L AS version"))
    got = sorted((r.yyyymm, r.value) for r in spark.read.parquet(path).collect())
    assert got == [(202401, "7"), (202402, "5")]


def test_row_key(spark):
    df = spark.createDataFrame([("u1 ", 1704121200, "25")], "user_id string, ymd long, app_type_id string")
    import hashlib
    r = ST.with_row_key(df).collect()[0]
    assert r.row_key == hashlib.md5(b"u11704121200").hexdigest() + "25"


def test_schema_enforced_load_fails_on_bad_record(spark):
    import pytest
    from pyspark.sql import types as T
    path = fresh_path(spark, "bad-json")
    spark.createDataFrame([('{"user_id": "u", "data": "oops"}',)], "v string").write.text(path)
    schema = T.StructType([T.StructField("user_id", T.StringType()),
                           T.StructField("data", T.ArrayType(T.LongType()))])
    with pytest.raises(Exception):
        SK.load_with_schema(spark, path, schema).collect()


def test_store_refuses_to_start_over(spark):
    """Only a missing path is an empty store; a foreign schema or an unreadable folder fails and changes nothing."""
    import pytest
    path = fresh_path(spark, "foreign")
    old = spark.createDataFrame([("u", "1", 1704121200, "Daily", "cnt", "3", 1, 202401)], SCHEMA + ", yyyymm int")
    old.withColumnRenamed("version", "ver").write.partitionBy("yyyymm", "family", "ymd").parquet(path)
    new = spark.createDataFrame([("v", "1", 1704121200, "Daily", "cnt", "4", 2)], SCHEMA)
    with pytest.raises(Exception):
        ST.upsert_table(spark, path, new)
    assert [r.user_id for r in spark.read.parquet(path).collect()] == ["u"]


def test_store_refuses_cells_of_other_months(spark):
    import pytest
    path = fresh_path(spark, "months")
    feb = spark.createDataFrame([("u", "1", 1706799600, "Daily", "cnt", "5", 1)], SCHEMA)
    ST.upsert_table(spark, path, feb)
    with pytest.raises(Exception, match="may not write"):
        ST.upsert_table(spark, path, feb.selectExpr("'w' AS user_id", "app_type_id", "ymd", "family", "col", "value", "version"), months=[202401])
    assert [r.user_id for r in spark.read.parquet(path).collect()] == ["u"]


def test_one_day_upsert_leaves_other_files_alone(spark):
    path = fresh_path(spark, "days")
    days = [1704121200 + 86400 * k for k in range(5)]
    ST.upsert_table(spark, path, spark.createDataFrame([("u", "1", d, f, "cnt", "3", 1) for d in days for f in ("Daily", "Weekly")], SCHEMA))
    files = set(spark.read.parquet(path).inputFiles())
    ST.upsert_table(spark, path, spark.createDataFrame([("u", "1", days[2], "Daily", "cnt", "4", 2), ("u", "1", days[2], "Daily", "dur", "9", 2)], SCHEMA),
                    months=[202401])
    after = set(spark.read.parquet(path).inputFiles())
    day = f"family=Daily/ymd={days[2]}"
    assert {f for f in files ^ after} == {f for f in files | after if day in f} and len(files - after) >= 1
    got = sorted((r.ymd, r.family, r.col, r.value) for r in spark.read.parquet(path).collect() if r.ymd == days[2])
    assert got == [(days[2], "Daily", "cnt", "4"), (days[2], "Daily", "dur", "9"), (days[2], "Weekly", "cnt", "3")]


def test_required_fields_fail_the_load(spark):
    import json
    import pytest
    from loadlens.sources.schemas import NESTED_ESTIMATE
    whole = {"user_id": "u", "data": [{"timestamp": 1, "app_types": [{"app_type_id": 2, "apps": [{"app_id": 3, "pwr": None}]}]}]}
    path = fresh_path(spark, "good-json")
    spark.createDataFrame([(json.dumps(whole),), (json.dumps({"user_id": "v"}),)], "v string").write.text(path)
    assert SK.load_with_schema(spark, path, NESTED_ESTIMATE).count() == 2      # a repeated field may be absent
    bad = [{"data": whole["data"]}, {"user_id": "u", "data": [{"app_types": []}]},
           {"user_id": "u", "data": [{"timestamp": 1, "app_types": [{"apps": []}]}]},
           {"user_id": "u", "data": [{"timestamp": 1, "app_types": [{"app_type_id": 2, "apps": [{"pwr": 1.0}]}]}]}]
    for k, record in enumerate(bad):
        path = fresh_path(spark, "bad-required")
        spark.createDataFrame([(json.dumps(record),)], "v string").write.text(path)
        with pytest.raises(Exception, match="required field"):
            SK.load_with_schema(spark, path, NESTED_ESTIMATE).collect()


def test_partitioned_writes_make_few_files(spark):
    path = fresh_path(spark, "few")
    df = spark.range(0, 4000, 1, 16).selectExpr("id", "cast(id % 3 as string) AS ser_id", "cast(id % 4 as int) AS partition")
    SK.write_partitioned_json(df, path)
    assert len(spark.read.json(path).inputFiles()) == 12
