import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from assay.operators import conform, dedupe, densify, identity, lines, quarantine
from conftest import rows


def test_latest_event_wins_whatever_the_order_of_arrival(spark):
    events = [(1, 2, "b"), (1, 1, "a"), (2, 5, "x"), (1, 2, "b"), (2, 5, "y")]
    for delivered in (events, events[::-1]):
        df = spark.createDataFrame(delivered, "key int, seq int, v string").repartition(3)
        assert rows(dedupe.latest_by_sequence(df, ["key"], "seq")) == [(1, 2, "b"), (2, 5, "x")]


def test_dedupe_reduces_a_hot_key_before_the_shuffle(spark):
    """A third of the rows share one key; the plan keeps one row per key and map task."""
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("key"), F.col("id").alias("seq")
    )
    latest = dedupe.latest_by_sequence(df, ["key"], "seq")
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")
    assert latest.count() == 20_001
    assert latest.where("key = 0").first()["seq"] == 29_997


def test_rows_without_a_key_all_stay(spark):
    df = spark.createDataFrame(
        [(None, 1, "a"), (None, 1, "a"), (1, None, "b"), (1, 2, "c"), (1, 2, "c")], "k int, m int, v string"
    )
    assert rows(dedupe.latest_per_key(df, ["k", "m"], ["v"])) == [
        (1, 2, "c"), (1, None, "b"), (None, 1, "a"), (None, 1, "a")
    ]


def test_dedupe_of_keys_alone(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "key int")
    assert rows(dedupe.latest_per_key(df, ["key"], [])) == [(1,), (2,)]


def test_redeliveries_are_counted(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (1,)], "key int")
    assert tuple(dedupe.redeliveries(df, ["key"]).first()) == (4, 2, 2, 3)


def test_quarantine_keeps_every_row_and_names_the_reasons(spark):
    df = spark.createDataFrame([(1, 5, "2.0"), (2, 0, "x"), (3, None, "1")], "id int, quantity int, price string")
    split = quarantine.split(
        df, {"quantity": F.col("quantity") > 0, "price": F.col("price").try_cast("decimal(19,4)").isNotNull()}
    )
    assert rows(split.clean, "id") == [(1,)]
    assert rows(split.quarantined, "id", "reasons") == [(2, ["quantity", "price"]), (3, ["quantity"])]


def test_country_conform_keeps_the_unmatched(spark):
    df = spark.createDataFrame([(1, " united states"), (2, "Freedonia"), (3, None)], "id int, typed string")
    names = spark.createDataFrame([("United States", "US")], "name string, code string")
    found = conform.conform_lookup(df, "typed", names, "name", "code", "country")
    assert rows(found, "id", "country") == [(1, "US"), (2, None), (3, None)]


def test_a_lookup_that_repeats_a_name_fails(spark):
    df = spark.createDataFrame([("US",)], "typed string")
    lookup = spark.createDataFrame([("US", 1), (" us ", 2)], "name string, code int")
    with pytest.raises(Exception, match="lookup repeats the key"):
        conform.conform_lookup(df, "typed", lookup, "name", "code", "into").collect()


def test_domain_differences_name_both_sides(spark):
    df = spark.createDataFrame([("a",), ("b",)], "v string")
    assert rows(conform.domain_differences(df, "v", ["a", "b"])) == []
    assert rows(conform.domain_differences(df, "v", ["a", "c"])) == [("b", "unexpected"), ("c", "absent")]


def test_missing_keys_bypass_the_join_and_survive(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "z")], "id int, k string")
    other = spark.createDataFrame([("a", 10)], "k string, v int")
    assert rows(conform.join_missing_apart(df, other, "k"), "id", "v") == [(1, 10), (2, None), (3, None)]


def _published(spark):
    return spark.createDataFrame(
        [
            ("EUR", dt.date(2024, 1, 4), Decimal("1.1")),
            ("EUR", dt.date(2024, 1, 8), Decimal("1.2")),
            ("GBP", dt.date(2024, 1, 5), Decimal("1.3")),
            ("GBP", dt.date(2024, 1, 6), None),
        ],
        "currency string, day date, rate decimal(18,8)",
    )


def test_densify_carries_the_last_value_and_flags_it(spark):
    dense = densify.densify_daily(_published(spark), "currency", "day", "rate")
    found = [(r.currency, r.day.day, str(r.rate)[:3], r.is_carried) for r in dense.collect()]
    assert sorted(found) == [
        ("EUR", 4, "1.1", False),
        ("EUR", 5, "1.1", True),
        ("EUR", 6, "1.1", True),
        ("EUR", 7, "1.1", True),
        ("EUR", 8, "1.2", False),
        ("GBP", 5, "1.3", False),
        ("GBP", 6, "1.3", True),
        ("GBP", 7, "1.3", True),
        ("GBP", 8, "1.3", True),
    ]


def test_two_values_for_one_day_are_refused(spark):
    twice = _published(spark).unionByName(_published(spark))
    with pytest.raises(Exception, match="two values of rate"):
        densify.densify_daily(twice, "currency", "day", "rate").collect()


def test_carry_accounting_sees_a_series_that_starts_late(spark):
    dense = densify.densify_daily(_published(spark), "currency", "day", "rate")
    whole = densify.carry_accounting(dense, "currency", "day").first()
    assert (whole.dense_rows, whole.carried_rows, whole.published_rows) == (9, 6, 3)
    assert not whole.is_dense
    assert densify.carry_accounting(dense.where("currency = 'EUR'"), "currency", "day").first().is_dense


def _systems(spark):
    pos = spark.createDataFrame(
        [(1, "Ann@x.com"), (2, "bob@x.com"), (3, None), (4, None), (5, "ANN@x.com")], "id long, email string"
    )
    web = spark.createDataFrame([("w1", "ann@x.com"), ("w2", "eve@x.com"), ("w3", None)], "id string, email string")
    return pos, web


def test_parties_fall_into_disjoint_cohorts(spark):
    pos, web = _systems(spark)
    parties = identity.resolve_parties(identity.members(pos, "id", "email"), identity.members(web, "id", "email"))
    assert rows(parties, "party_key", "pos_id", "pos_accounts", "web_id", "in_pos", "in_web") == [
        ("POS:3", 3, 1, None, True, False),
        ("POS:4", 4, 1, None, True, False),
        ("WEB:w3", None, 0, "w3", False, True),
        ("ann@x.com", 1, 2, "w1", True, True),
        ("bob@x.com", 2, 1, None, True, False),
        ("eve@x.com", None, 0, "w2", False, True),
    ]
    counts = identity.cohort_counts(parties).first()
    assert (counts.matched, counts.pos_only, counts.web_only, counts.no_email) == (1, 3, 2, 3)
    assert counts.accounted


def test_parties_carry_the_attributes_of_their_lowest_account(spark):
    pos = spark.createDataFrame([(2, "A@x", "b"), (1, "a@x", "a"), (3, None, "c")], "id long, email string, kind string")
    web = spark.createDataFrame([("w", "a@x", "z"), ("v", None, "y")], "id string, email string, kind string")
    parties = identity.resolve_parties(
        identity.members(pos, "id", "email", keep=["kind"]), identity.members(web, "id", "email", keep=["kind"])
    )
    assert rows(parties, "party_key", "pos_kind", "web_kind") == [
        ("POS:3", "c", None), ("WEB:v", None, "y"), ("a@x", "a", "z")
    ]


def test_every_account_reaches_its_party(spark):
    pos, web = _systems(spark)
    members = identity.members(pos, "id", "email")
    parties = identity.resolve_parties(members, identity.members(web, "id", "email"))
    bridge = identity.party_of(members, "POS")
    assert bridge.count() == 5
    assert bridge.join(parties, "party_key", "left_anti").count() == 0
    assert bridge.where("party_key = 'ann@x.com'").count() == 2


def test_conforming_beats_the_naive_match(spark):
    pos, web = _systems(spark)
    assert identity.raw_matches(pos, "email", web, "email").first()[0] == 0
    conformed = identity.members(pos, "id", "email")
    assert identity.raw_matches(conformed, "email", web, "email").first()[0] == 1


def test_lines_keep_orders_that_lost_theirs(spark):
    df = spark.createDataFrame(
        [("a", [("1", "p"), ("2", "q")]), ("b", []), ("c", None)], "id string, lines array<struct<no: string, sku: string>>"
    )
    assert rows(lines.explode_lines(df)) == [
        ("a", 0, "1", "p"), ("a", 1, "2", "q"), ("b", None, None, None), ("c", None, None, None)
    ]
    assert lines.explode_lines(df, keep_empty=False).count() == 2
    assert tuple(lines.nested_survived(df).first()) == (3, 1, 2)
