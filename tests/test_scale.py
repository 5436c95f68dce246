"""Plans that must hold at scale: no cross joins, hot keys split, pruned scans."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from tidemark.operators import quality
from tidemark.operators.asof import attach_as_of
from tidemark.operators.joins import member_rows

FOLDER = "/root/testdata/sf0.001"
# These land files first, so their final plan says nothing about joins.
LANDING = {"stream_sync"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def small_partitions(spark, no_broadcast):
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_no_query_crosses_or_calls_python(spark, no_broadcast):
    for name, build in entry_module.queries().items():
        if name in LANDING:
            continue
        plan = plan_of(build(spark, FOLDER))
        for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython"):
            assert node not in plan, (name, node)


@pytest.fixture
def hot(spark, tmp_path):
    """A third of the rows share one key, scanned from files."""
    path = str(tmp_path / "hot")
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.xxhash64("id") % 5000)
    spark.range(400_000).select(
        "id", key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("pad")
    ).repartition(16).write.parquet(path)
    return spark.read.parquet(path)


def final_plan(df):
    count = df.agg(F.count("*"), F.max("pad"))
    rows = count.collect()[0][0]
    return rows, plan_of(count)


def test_hot_key_is_split_for_aggregated_keys(small_partitions, hot):
    rows, plan = final_plan(quality.duplicate_rows(hot, "k"))
    assert "skew=true" in plan
    single = hot.groupBy("k").count().where("count = 1").count()
    assert rows == hot.count() - single


def test_hot_key_is_split_for_stored_keys(spark, small_partitions, hot, tmp_path):
    keys = str(tmp_path / "keys")
    spark.range(0, 5000).select(F.col("id").alias("k")).write.parquet(keys)
    rows, plan = final_plan(member_rows(hot, spark.read.parquet(keys), "k", unique=True))
    assert "skew=true" in plan
    assert rows == hot.where("k >= 0 AND k < 5000").count()


def test_hot_key_is_split_in_as_of_join(spark, small_partitions, hot):
    facts = hot.withColumn("at", F.expr("timestamp_ntz'2020-03-01' + make_dt_interval(id % 20)"))
    mapping = facts.groupBy("k").agg(F.min("at").alias("effdate"), F.max("at").alias("thrudate"))
    mapping = mapping.withColumn("gvk", F.col("k").cast("string"))
    rows, plan = final_plan(attach_as_of(facts, mapping, "k", "at"))
    assert "skew=true" in plan and rows == 400_000


def test_aggregates_combine_before_the_shuffle(spark):
    for name in ("dup_values", "set_diff_report", "column_values", "frame_diff", "ordered_diff"):
        plan = plan_of(entry_module.queries()[name](spark, FOLDER))
        assert "partial_" in plan, name


def test_scans_read_only_what_they_need(spark):
    plan = plan_of(entry_module.queries()["rows_per_filer"](spark, FOLDER))
    assert "ReadSchema: struct<o_custkey:bigint>" in plan


def test_high_water_mark_reaches_the_scan(spark):
    plan = plan_of(entry_module.queries()["incremental_since"](spark, FOLDER))
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts,ScalarSubquery" in plan
