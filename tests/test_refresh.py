"""Versions, refresh by dependencies, and the comparison of written surfaces."""

import datetime as dt
import random
import re
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from assay.operators import cdc, history, measures, reconcile, state
from assay.plans import medallion, refresh
from assay.plans.feeds import Feeds
from assay.sources import versions
from assay.streaming import upsert
from conftest import rows

FOLDER = "/root/testdata/sf0.001"


def files_of(df):
    return {row[0] for row in df.select(F.input_file_name()).distinct().collect()}


def test_graph_is_in_order_and_names_every_table():
    known = {read for step in medallion.STEPS for read in step.reads if read.startswith("bronze_")}
    for step in medallion.STEPS:
        assert known.issuperset(step.reads), step.name
        known.add(step.name)
    assert {*medallion.SILVER, *medallion.GOLD} <= known and set(refresh.PRODUCT_CONTRACT) == {*medallion.SILVER, *medallion.GOLD}
    reached = [step.name for step in medallion.below({"bronze_fx_rates"})]
    assert reached == [
        "silver_fx_daily", "fct_orders", "fct_sales", "dim_product", "dim_date", "fct_daily_revenue", "fct_revenue_summary",
    ]
    assert ("silver_customers", "dim_customer") in medallion.edges()


def test_parts_replace_parts_and_old_versions_stay(spark, folder):
    first = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "a")], "x int, k string")
    entry = versions.write_whole(first, f"{folder}/1", "k")
    one = versions.publish(spark, folder, {"version": 1, "tables": {"t": entry}})
    again = spark.createDataFrame([(10, "a"), (30, None)], "x int, k string")
    # Part b is declared anew and has no rows any more.
    two = {"version": 2, "tables": {"t": versions.write_parts(again, f"{folder}/2", entry, ["=a", "=b", ""])}}
    versions.publish(spark, folder, two)
    assert rows(versions.read(spark, one, "t")) == rows(first)
    assert rows(versions.read(spark, versions.current(spark, folder), "t")) == rows(again)
    third = versions.write_parts(spark.createDataFrame([(5, "b")], "x int, k string"), f"{folder}/3", two["tables"]["t"], ["=b"])
    assert rows(versions.read(spark, {"tables": {"t": third}}, "t"), "x") == [(10,), (30,), (5,)]
    with pytest.raises(versions.VersionTaken):
        versions.publish(spark, folder, two)
    assert versions.current(spark, f"{folder}/none") == {"version": 0, "tables": {}}


def test_metrics_are_of_the_rows_that_passed(spark, folder):
    from assay.sources import tables

    df = spark.range(100).selectExpr("id", "id % 7 as k")
    seen = tables.write_observed(df, f"{folder}/t", rows=F.count("*"), top=F.max("k"))
    assert seen == {"rows": 100, "top": 6} and spark.read.parquet(f"{folder}/t").count() == 100


def test_claim_survives_a_writer_that_dies(spark, folder):
    upsert.claim(spark, folder, "mine")
    upsert.claim(spark, folder, "mine")
    with pytest.raises(upsert.ForeignWriter):
        upsert.claim(spark, folder, "other")


class Rates(Feeds):
    factor = 1

    def fx_rates(self):
        changed = F.col("rate_date") == dt.date(2024, 1, 10)
        return super().fx_rates().withColumn("rate", F.when(changed, F.col("rate") * self.factor).otherwise(F.col("rate")).cast("decimal(18,8)"))


def test_refresh_rebuilds_affected_days_only(spark, folder):
    feeds = Feeds(spark, FOLDER)
    first, built = refresh.refresh(feeds, folder, set())
    assert {c.action for c in built} == {refresh.WHOLE} and len(built) == len(medallion.STEPS)
    # The plans that ran read what the graph declares, and nothing else.
    pairs = {(r["source"], r["target"]) for r in refresh.observed_edges(spark, first).collect()}
    assert pairs == {tuple(r) for r in refresh.declared_edges(spark).collect()}
    rates = Rates(spark, FOLDER)
    rates.factor = 3
    second, changes = refresh.refresh(rates, folder, {"bronze_fx_rates"})
    by_table = {c.table: c for c in changes}
    assert by_table["fct_orders"].parts == by_table["fct_daily_revenue"].parts == ["=2024-01-10"]
    assert by_table["fct_revenue_summary"].parts == ["=FY24 Q4"]
    assert by_table["dim_date"].action == by_table["dim_product"].action == refresh.EQUAL
    assert second["tables"]["silver_orders"] == first["tables"]["silver_orders"]
    # Contents are those of a full build over the new rates, day by day.
    full = medallion.build(rates, f"{folder}/full")
    for table in ("fct_orders", "fct_sales", "fct_daily_revenue", "fct_revenue_summary"):
        held = versions.read(spark, second, table)
        assert rows(held) == rows(full[table].select(*held.columns)), table
    # Other days are still read from the first version's files.
    sales = versions.read(spark, second, "fct_orders")
    moved = files_of(sales) - files_of(versions.read(spark, first, "fct_orders"))
    assert moved and all("order_date=2024-01-10" in name for name in moved)
    # The same delivery again changes nothing, and stops at the first equal table.
    third, changes = refresh.refresh(rates, folder, {"bronze_fx_rates"})
    assert [(c.table, c.action) for c in changes] == [("silver_fx_daily", refresh.EQUAL)]
    assert third["tables"] == second["tables"]
    # A broken contract publishes nothing.
    rates.factor = -1
    with pytest.raises(refresh.ContractBroken, match="rate_is_positive"):
        refresh.refresh(rates, folder, {"bronze_fx_rates"})
    assert versions.current(spark, folder) == third


def test_digests_find_what_differs_and_leave_the_rest(spark):
    data = [(i % 50, None if i % 7 == 0 else f"k{i % 9}", Decimal(i)) for i in range(450)]
    left = spark.createDataFrame(data, "a int, b string, v decimal(19,4)").groupBy("a", "b").agg({"v": "sum"}).toDF("a", "b", "v")
    assert reconcile.differing_buckets(left, left.repartition(5), ["a", "b"], ["v"]) == []
    right = left.where("not (a = 3 and b is null)").selectExpr("a", "b", "if(a = 4 and b = 'k1', v + 1, if(a = 5, v + 0.001, v)) as v")
    assert rows(reconcile.compare_by_digest(left, right, ["a", "b"], ["v"])) == rows(
        reconcile.compare(left, right, ["a", "b"], ["v"])
    )
    apart = reconcile.differing_buckets(left, right, ["a", "b"], ["v"])
    assert 0 < len(apart) <= left.where("a in (3, 4, 5)").count()


def test_facts_are_summed_apart(spark):
    model = measures.Model(
        tables={
            "one": spark.createDataFrame([("x", 1), ("x", 2), (None, 5), ("z", 1)], "k string, v int"),
            "two": spark.createDataFrame([("x", 10), ("y", 20), ("y", 1), (None, 7)], "k string, w int"),
            "place": spark.createDataFrame([("x", "X"), ("y", "Y")], "k string, name string"),
        },
        measures={"one": [measures.sum_of("v", "v"), measures.count_rows("n")], "two": [measures.sum_of("w", "w")]},
        relationships=[measures.Relationship(f, "k", "place", "k") for f in ("one", "two")],
    )
    found = model.summarize_across(["one", "two"], ["place.name"])
    assert rows(found, "place_name", "v", "n", "w") == sorted(
        [("X", 3, 2, 10), ("Y", None, None, 21), (None, 6, 2, 7)], key=repr
    )
    with pytest.raises(ValueError, match="share a name"):
        model.summarize_across(["one", "one"], ["place.name"])


@pytest.mark.parametrize("seed", [1, 2])
def test_state_moves_on_as_replay_would(spark, folder, seed):
    rng = random.Random(seed)
    log = [
        (rng.choice("IUUUD"), i, 0 if i % 3 == 0 else rng.randrange(25), f"s{rng.randrange(4)}", dt.date(2024, 1, 1 + rng.randrange(20)))
        for i in range(300)
    ]
    schema = "op string, at long, id long, status string, day date"
    shuffled = log[:]
    rng.shuffle(shuffled)
    batches = [shuffled[:100], shuffled[80:200], shuffled[200:290], shuffled[290:] + shuffled[:5], []]
    for batch in batches:
        manifest = state.merge_batch(spark.createDataFrame(batch, schema), folder, ["id"], "day", "at", buckets=8)
    whole = spark.createDataFrame(log, schema)
    assert rows(state.read_state(spark, manifest)) == rows(cdc.current_state(whole, ["id"], "at"))
    wanted = history.validity_intervals(whole, ["id"], "day", "at", chunk_offsets=16)
    held = state.read_history(spark, manifest)
    assert rows(held, *wanted.columns) == rows(wanted)


def test_a_batch_opens_its_own_buckets_only(spark, folder):
    events = spark.range(400).selectExpr("'I' as op", "id as at", "id % 40 as id", "current_date() as day")
    first = state.merge_batch(events, folder, ["id"], "day", "at", buckets=16)
    late = spark.createDataFrame([("D", 1000, 7, dt.date(2024, 1, 1))], events.schema)
    second = state.merge_batch(late, folder, ["id"], "day", "at")
    old = {f.rsplit("/", 2)[1] for f in files_of(versions.read(spark, first, state.STATE))}
    new = Counter(f.rsplit("/", 2)[1] for f in files_of(versions.read(spark, second, state.STATE)) - files_of(versions.read(spark, first, state.STATE)))
    assert len(new) == 1 and len(old) > 5
    assert state.read_state(spark, second).count() == 39
    (bucket,) = new
    touched = versions.read(spark, first, state.HISTORY).where(versions.in_parts(F.col("_bucket"), [f"={bucket.split('=')[1]}"]))
    assert {f.rsplit("/", 2)[1] for f in files_of(touched)} == {bucket}
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = touched._jdf.queryExecution().explainString(mode)
    assert re.search(r"PartitionFilters: \[.*concat\(=, cast\(_bucket", plan)
