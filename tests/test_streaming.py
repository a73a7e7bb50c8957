import datetime as dt

import pytest
from pyspark.sql import functions as F

from assay.plans.feeds import CHANGE_IMAGE
from assay.sources import changes, files, tables
from assay.streaming import exactly_once, ingest, markers, upsert
from conftest import rows

IMAGE = '{"erp_customer_id":%d,"account_status":"%s","credit_band":"b","effective_date":"2024-01-02"}'


def envelope(op, key, status="s"):
    image = IMAGE % (key, status)
    before, after = (image, "null") if op == "d" else ("null", image)
    return f'{{"op":"{op}","before":{before},"after":{after}}}'


def land(spark, path, *events):
    df = spark.createDataFrame(list(events), "capture_offset long, value string")
    df.coalesce(1).write.mode("append").parquet(path)
    return df


def test_gate_refuses_a_partial_stream(spark):
    ingest.require_complete(spark.range(3), 3)
    with pytest.raises(ingest.IncompleteStream):
        ingest.require_complete(spark.range(2), 3)


def test_a_rerun_does_not_double_the_log(spark, folder):
    topic, log, checkpoint = f"{folder}/topic", f"{folder}/log", f"{folder}/checkpoint"
    land(spark, topic, (0, envelope("c", 1)), (1, envelope("u", 1, "t")))
    first = ingest.land_changes(changes.stream_landed(spark, topic), CHANGE_IMAGE, log, checkpoint)
    assert first.count() == 2
    again = ingest.land_changes(changes.stream_landed(spark, topic), CHANGE_IMAGE, log, checkpoint)
    assert again.count() == 2
    land(spark, topic, (2, envelope("d", 1)))
    more = ingest.land_changes(changes.stream_landed(spark, topic, 1), CHANGE_IMAGE, log, checkpoint)
    assert rows(more, "capture_offset", "op") == [(0, "I"), (1, "U"), (2, "D")]


@pytest.mark.parametrize("bad, named", [(envelope("r", 1), "snapshot read"), (None, "tombstone")])
def test_a_bad_event_fails_the_run_and_is_named(spark, folder, bad, named):
    topic = f"{folder}/topic"
    land(spark, topic, (0, envelope("c", 1)), (1, bad))
    with pytest.raises(ingest.UnusableEvents, match=f"{named} at offset 1"):
        ingest.land_changes(
            changes.stream_landed(spark, topic), CHANGE_IMAGE, f"{folder}/log", f"{folder}/checkpoint"
        )


def test_upsert_is_exactly_once_over_redelivery_and_restart(spark, folder):
    source, table, checkpoint = f"{folder}/in", f"{folder}/table", f"{folder}/checkpoint"
    schema = "key long, seq long, v string"

    def deliver(*events):
        spark.createDataFrame(list(events), schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        return upsert.upsert(stream, ["key"], "seq", table, checkpoint)

    assert rows(deliver((1, 1, "a"), (2, 1, "b"))) == [(1, 1, "a"), (2, 1, "b")]
    assert rows(deliver((1, 2, "c"), (1, 1, "a"), (2, 1, "b"))) == [(1, 2, "c"), (2, 1, "b")]
    late = deliver((1, 1, "a"), (3, 9, "d"))
    assert rows(late) == [(1, 2, "c"), (2, 1, "b"), (3, 9, "d")]
    compacted = upsert.compact(spark, ["key"], "seq", table, f"{folder}/compacted")
    assert spark.read.parquet(compacted).count() == 3
    assert rows(upsert.read_latest(spark, ["key"], "seq", compacted)) == rows(late)


def test_a_replayed_batch_overwrites_its_first_attempt(spark, folder):
    """The folder of a batch is replaced, so a crash between write and commit adds nothing."""
    source, table, checkpoint = f"{folder}/in", f"{folder}/table", f"{folder}/checkpoint"
    spark.createDataFrame([(1, 1)], "key long, seq long").write.parquet(source)
    stream = spark.readStream.schema("key long, seq long").parquet(source)
    upsert.upsert(stream, ["key"], "seq", table, checkpoint)
    commit = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits/0")
    assert commit.getFileSystem(spark._jsc.hadoopConfiguration()).delete(commit, False)
    upsert.upsert(stream, ["key"], "seq", table, checkpoint)
    assert spark.read.parquet(table).count() == 1


def test_a_writer_with_another_checkpoint_is_refused_and_nothing_is_lost(spark, folder):
    table = f"{folder}/table"

    def stream(name, key):
        spark.createDataFrame([(key, 1)], "key long, seq long").write.parquet(f"{folder}/{name}")
        return spark.readStream.schema("key long, seq long").parquet(f"{folder}/{name}")

    upsert.upsert(stream("one", 1), ["key"], "seq", table, f"{folder}/checkpoint-1")
    with pytest.raises(upsert.ForeignWriter):
        upsert.upsert(stream("two", 2), ["key"], "seq", table, f"{folder}/checkpoint-2")
    assert rows(upsert.read_latest(spark, ["key"], "seq", table)) == [(1, 1)]


def test_one_writer_per_table(spark, folder):
    stream = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    held = (
        stream.writeStream.format("noop")
        .queryName(upsert.writer_name(folder))
        .option("checkpointLocation", f"{folder}/held")
        .start()
    )
    try:
        with pytest.raises(Exception, match="already active|already exists|with that name"):
            upsert.start_upsert(
                stream.select(F.col("value").alias("key"), F.col("value").alias("seq")),
                ["key"], "seq", folder, f"{folder}/checkpoint",
            )
    finally:
        held.stop()


def test_markers_trigger_once_per_completed_delivery(spark, folder):
    landing, done = f"{folder}/landing", []

    def deliver(day, complete):
        tables.write_table(spark.range(2).repartition(2), f"{landing}/{day}")
        if complete:
            files.mark_complete(spark, f"{landing}/{day}")

    def refresh(session, delivered, batch_id):
        done.append((delivered.rsplit("/", 1)[1], batch_id))

    deliver("2024-01-01", True)
    deliver("2024-01-02", False)
    markers.on_delivery(spark, landing, refresh, f"{folder}/checkpoint")
    assert done == [("2024-01-01", 0)]
    files.mark_complete(spark, f"{landing}/2024-01-02")
    deliver("2024-01-03", True)
    markers.on_delivery(spark, landing, refresh, f"{folder}/checkpoint")
    markers.on_delivery(spark, landing, refresh, f"{folder}/checkpoint")
    assert sorted(d for d, _ in done) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    # The two that came together are one batch, told apart by their folders.
    assert [b for _, b in done] == [0, 1, 1]
    assert len({markers.delivery_id(*delivery) for delivery in done}) == 3


def test_state_is_bounded_and_late_events_are_found(spark, folder):
    schema = "topic string, partition int, offset long, event_time timestamp, kind string"

    def deliver(number, rows_of):
        rows_ = [("t", i % 2, i, dt.datetime(2024, 1, day), "k") for i, day in rows_of]
        spark.createDataFrame(rows_, schema).write.parquet(f"{folder}/topic/delivery={number}")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/topic/delivery=*")
        return exactly_once.land_once(stream, "event_time", "3 days", f"{folder}/table", f"{folder}/checkpoint")

    deliver(0, [(i, 1 + i // 10) for i in range(200)])
    again = [(i, 1 + i // 10) for i in range(150, 200)]
    progress = deliver(1, [*again, *again, (1000, 2), (1000, 2), (1001, 3), *[(2000 + i, 21) for i in range(10)]])
    landed = spark.read.parquet(f"{folder}/table")
    assert sorted(r["offset"] for r in landed.collect()) == [*range(200), *range(2000, 2010)]
    late = exactly_once.late_rows(spark.read.schema(schema).parquet(f"{folder}/topic/delivery=*"), landed)
    assert sorted(r["offset"] for r in late.collect()) == [1000, 1001]
    assert sum(p["late"] for p in progress) >= 3 and 0 < progress[-1]["held"] <= 60
    # A restart with nothing new changes nothing.
    stream = spark.readStream.schema(schema).parquet(f"{folder}/topic/delivery=*")
    exactly_once.land_once(stream, "event_time", "3 days", f"{folder}/table", f"{folder}/checkpoint")
    assert spark.read.parquet(f"{folder}/table").count() == 210
