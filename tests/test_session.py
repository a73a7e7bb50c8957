import pytest
from pyspark.sql import functions as F

from assay.functions.columns import evaluated_once
from assay.plans.queries import REGISTRY
from assay.session import TARGET_PARTITION_BYTES, apply_runtime_settings, shared_folder, shuffle_partitions


class FakeContext:
    applicationId = "app"

    def __init__(self, master):
        self.master, self.checkpoint = master, None

    def getCheckpointDir(self):
        return self.checkpoint

    def setCheckpointDir(self, path):
        self.checkpoint = path


class FakeSession:
    def __init__(self, master, configured=None):
        self.sparkContext, self.conf, self.configured = FakeContext(master), self, configured

    def get(self, key, default=None):
        return self.configured or default


def test_the_clusters_folder_is_used_as_named():
    session = FakeSession("yarn", "hdfs:///shared/")
    assert shared_folder(session, "a", "b") == "hdfs:///shared/app/a/b"
    assert session.sparkContext.checkpoint is None


def test_only_a_local_session_may_fall_back_to_a_temporary_folder():
    local = FakeSession("local[2]")
    assert shared_folder(local).startswith(local.sparkContext.checkpoint)
    assert shared_folder(local) == shared_folder(local)
    with pytest.raises(ValueError):
        shared_folder(FakeSession("spark://host:7077"))


def test_partitions_follow_the_input_but_never_fall_below_the_cores():
    assert shuffle_partitions(1, 8) == 8
    assert shuffle_partitions(100 * 10**12, 4000) == -(-(100 * 10**12) // TARGET_PARTITION_BYTES)


def test_results_do_not_hang_on_the_zone_of_the_session(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    apply_runtime_settings(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_a_costly_column_is_not_copied_into_filters(spark):
    parsed = evaluated_once(
        spark.createDataFrame([('{"a":1}',)], "v string"), "p", F.from_json("v", "a int, b int")
    ).where("p.a > 0 and p.b is null").select("p.a", "p.b")
    plan = parsed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1
    assert parsed.count() == 1


@pytest.mark.parametrize("name", ["fct_revenue_summary", "party", "measures_by_segment", "scd2", "reconcile_differs"])
def test_plans_have_no_nested_loops_and_stay_in_the_jvm(spark, name):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = REGISTRY[name](spark, "/root/testdata/sf0.001")
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert not any(word in plan for word in ("NestedLoop", "Cartesian", "Python", "ArrowEval"))


@pytest.mark.parametrize(
    "name, table, columns",
    [
        ("daily_revenue", "l_", {"l_orderkey", "l_quantity", "l_extendedprice"}),
        ("redelivery_check", "l_", {"l_orderkey", "l_linenumber"}),
        ("key_overlap", "c_", {"c_custkey"}),
    ],
)
def test_scans_read_only_what_the_query_names(spark, name, table, columns):
    df = REGISTRY[name](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    schemas = [part.split(">", 1)[0] for part in plan.split("ReadSchema: struct<")[1:]]
    read = {field.split(":")[0] for schema in schemas for field in schema.split(",")}
    assert {field for field in read if field.startswith(table)} == columns
