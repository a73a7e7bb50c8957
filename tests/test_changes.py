import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from assay.operators import cdc, history
from assay.plans.feeds import CHANGE_IMAGE
from conftest import rows

SCHEMA = "op string, offset long, key long, eff date"


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def versions_by_hand(events):
    """Brute force: per key in (effective, offset) order, each non-delete is closed by the next."""
    found = []
    for key in {e[2] for e in events}:
        mine = sorted((e for e in events if e[2] == key), key=lambda e: (e[3], e[1]))
        for event, following in zip(mine, [*mine[1:], None]):
            if event[0] != "D":
                found.append((key, event[1], event[3], following and following[3]))
    return sorted(found, key=repr)


def random_events(seed, n, hot_share=1 / 3):
    rng = random.Random(seed)
    return [
        (rng.choice("IUUD"), i, 7 if rng.random() < hot_share else rng.randrange(20), day(rng.randrange(12)))
        for i in range(n)
    ]


@pytest.mark.parametrize("seed, chunk", [(1, 1), (2, 3), (3, 16), (4, 1 << 22)])
def test_versions_match_brute_force_for_any_chunk_and_a_hot_key(spark, seed, chunk):
    events = random_events(seed, 400)
    df = spark.createDataFrame(events, SCHEMA)
    found = history.validity_intervals(df, ["key"], "eff", "offset", chunk_offsets=chunk)
    assert rows(found, "key", "offset", "valid_from", "valid_to") == versions_by_hand(events)


def test_current_versions_are_the_live_rows(spark):
    df = spark.createDataFrame(random_events(9, 400), SCHEMA)
    found = history.validity_intervals(df, ["key"], "eff", "offset").where("is_current")
    live = cdc.current_state(df, ["key"], "offset")
    assert rows(found, "key", "offset") == rows(live, "key", "offset")


def test_hot_key_is_split_over_chunks(spark):
    """No window group may hold more rows than a chunk is wide."""
    df = spark.createDataFrame(random_events(5, 600, hot_share=0.9), SCHEMA)
    sizes = df.groupBy("key", "eff", history.offset_block("offset", 16)).count()
    assert sizes.agg(F.max("count")).first()[0] <= 16
    assert df.where("key = 7").count() > 500


def test_late_update_same_day_and_insert_after_delete(spark):
    events = [
        ("I", 1, 1, day(0)),
        ("U", 2, 1, day(5)),
        ("U", 3, 1, day(2)),
        ("D", 4, 1, day(6)),
        ("I", 5, 1, day(6)),
        ("U", 6, 1, day(6)),
        ("D", 1, 2, day(0)),
    ]
    df = spark.createDataFrame(events, SCHEMA)
    found = history.validity_intervals(df, ["key"], "eff", "offset")
    assert rows(found, "offset", "valid_from", "valid_to", "is_current") == [
        (1, day(0), day(2), False),
        (2, day(5), day(6), False),
        (3, day(2), day(5), False),
        (5, day(6), day(6), False),
        (6, day(6), None, True),
    ]


@pytest.mark.parametrize("chunk", [1, 5, 1 << 22])
def test_order_disagreements_match_brute_force(spark, chunk):
    events = random_events(6, 300)
    expected = {}
    for key in {e[2] for e in events}:
        mine = [e[3] for e in events if e[2] == key]
        back = sum(1 for a, b in zip(mine, mine[1:]) if b < a)
        if back:
            expected[key] = back
    df = spark.createDataFrame(events, SCHEMA)
    found = history.order_disagreements(df, ["key"], "eff", "offset", chunk_offsets=chunk)
    assert rows(found) == sorted(expected.items(), key=repr)


def test_orders_that_agree_yield_nothing(spark):
    df = spark.createDataFrame([("I", i, 1, day(i)) for i in range(5)], SCHEMA)
    assert history.order_disagreements(df, ["key"], "eff", "offset").count() == 0


def test_null_values_lead_as_null_and_null_keys_form_their_own_group(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 2, None), (None, 3, "c"), (1, 4, "d")], "k int, o long, v string")
    found = history.lead_by_chunk(df, ["k"], {"_c": history.offset_block("o", 2)}, "o", "v", "n")
    assert rows(found, "o", "n") == [(1, None), (2, "c"), (3, None), (4, None)]


def test_replay_drops_deleted_keys_and_keeps_the_last_image(spark):
    events = [("I", 1, 1, day(0)), ("U", 2, 1, day(1)), ("I", 3, 2, day(0)), ("D", 4, 2, day(1))]
    df = spark.createDataFrame(events, SCHEMA)
    assert rows(cdc.current_state(df, ["key"], "offset"), "key", "offset") == [(1, 2)]


IMAGE = '{"erp_customer_id":1,"account_status":"a","credit_band":"b","effective_date":"2024-01-02"}'


@pytest.mark.parametrize(
    "value, op, fault",
    [
        ('{"op":"c","before":null,"after":%s}' % IMAGE, "I", None),
        ('{"op":"u","before":%s,"after":%s}' % (IMAGE, IMAGE), "U", None),
        ('{"op":"d","before":%s,"after":null}' % IMAGE, "D", None),
        ('{"op":"d","before":null,"after":%s}' % IMAGE, "D", "no row image"),
        ('{"op":"r","before":null,"after":%s}' % IMAGE, None, "snapshot read"),
        ('{"op":"t","before":null,"after":%s}' % IMAGE, None, "unknown operation"),
        ("nonsense", None, "unreadable envelope"),
        (None, None, "tombstone"),
    ],
)
def test_envelopes_are_judged_never_repaired(spark, value, op, fault):
    df = spark.createDataFrame([(9, value)], "capture_offset long, value string")
    event = cdc.parse_envelopes(df, CHANGE_IMAGE).first()
    assert (event.op, event.fault) == (op, fault)
    if fault is None:
        assert (event.capture_offset, event.erp_customer_id, event.effective_date) == (9, 1, dt.date(2024, 1, 2))


def test_gate_passes_only_the_exact_count(spark):
    df = spark.range(5)
    assert cdc.count_gate(df, 5).count() == 0
    assert [tuple(r) for r in cdc.count_gate(df, 6).collect()] == [(5, 6)]


def test_redelivered_events_count_once(spark):
    df = spark.createDataFrame([("I", 1, 1, day(0)), ("U", 2, 1, day(1))], SCHEMA)
    assert cdc.drop_redelivered(df.unionByName(df), ["offset"]).count() == 2
