import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from assay.operators import integrity, lineage, profile, quality
from conftest import rows


def _tables(spark):
    return {
        "dim": spark.createDataFrame([(1,), (2,), (2,)], "id int"),
        "fact": spark.createDataFrame(
            [(1, "a", 5), (9, "b", 0), (9, "z", 1), (None, None, None)], "dim_id int, status string, quantity int"
        ),
    }


def _violations(spark, rules, tables=None):
    results = quality.evaluate(tables or _tables(spark), rules)
    return {(r.table_name, r.rule): r.violations for r in results.collect()}


def test_every_kind_of_rule(spark):
    tables = _tables(spark)
    rules = quality.rules_from(
        {
            "dim": {"id": ["unique", "not_null"]},
            "fact": {
                "dim_id": ["not_null", {"relationships": {"to": "dim", "field": "id"}}],
                "status": [{"accepted_values": {"values": ["a", "b"]}}],
            },
        },
        tables,
    )
    rules.append(quality.row_rule("fact", "quantity", "quantity_positive", F.col("quantity") > 0))
    assert _violations(spark, rules) == {
        ("dim", "id_unique"): 1,
        ("dim", "id_not_null"): 0,
        ("fact", "dim_id_not_null"): 1,
        ("fact", "dim_id_resolves_in_dim"): 2,
        ("fact", "status_accepted"): 1,
        ("fact", "quantity_positive"): 2,
    }


def test_relationship_without_a_target_claims_presence_only(spark):
    tables = _tables(spark)
    rule = quality.relationship("fact", "dim_id", tables, "elsewhere", "id")
    assert (rule.kind, rule.name, quality.METRICS[rule.kind][0]) == ("presence", "dim_id_present", "completeness")
    resolved = quality.relationship("fact", "dim_id", tables, "dim", "id")
    assert (resolved.kind, quality.METRICS[resolved.kind][0]) == ("relationships", "consistency")


def test_rules_of_one_name_are_refused(spark):
    tables = _tables(spark)
    two = [quality.relationship("fact", "dim_id", tables, target, "id") for target in ("dim", "dim")]
    with pytest.raises(ValueError, match="declared twice"):
        quality.declared(spark, two)


def test_null_keys_are_not_dangling_references(spark):
    tables = _tables(spark)
    assert rows(quality.unresolved_keys(tables["fact"], "dim_id", tables["dim"], "id")) == [(9, 2)]


def test_a_rule_that_did_not_run_is_visible(spark):
    tables = _tables(spark)
    ran, forgotten = quality.unique("dim", "id"), quality.not_null("fact", "status")
    report = quality.rule_report(quality.evaluate(tables, [ran]), [ran, forgotten])
    assert rows(report, "rule", "violations", "evaluated", "passed") == [
        ("id_unique", 1, True, False), ("status_not_null", None, False, False)
    ]


def test_unknown_test_is_refused(spark):
    with pytest.raises(ValueError):
        quality.rules_from({"dim": {"id": ["positive"]}}, _tables(spark))


def test_row_rules_of_a_table_share_one_pass(spark):
    rules = [quality.not_null("fact", c) for c in ("dim_id", "status", "quantity")]
    plan = quality.evaluate(_tables(spark), rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange SinglePartition") == 1


def test_money_must_be_decimal_and_whole_at_four_places(spark):
    df = spark.createDataFrame([(Decimal("1.2345"), 1.0), (Decimal("1.23456"), 2.0)], "a decimal(19,6), b double")
    assert quality.float_money(df, ["a", "b"]) == ["b"]
    assert quality.money_losing_digits(df, "a").count() == 1


def test_missing_channel(spark):
    df = spark.createDataFrame([("POS",), ("POS",)], "channel string")
    assert rows(quality.missing_values(df, "channel", ["POS", "WEB"])) == [("WEB",)]
    assert rows(quality.missing_values(df, "channel", ["POS"])) == []


# --- bronze integrity


def test_blank_leaves_are_found_at_the_top_and_inside_lines(spark):
    schema = "id string, renamed string, lines array<struct<no: string, sku: string>>"
    df = spark.createDataFrame([("1", None, [("1", None)]), (None, None, None), ("2", None, [])], schema)
    assert rows(integrity.leaf_counts(df)) == [("id", 2), ("lines.no", 1), ("lines.sku", 0), ("renamed", 0)]
    assert rows(integrity.blank_columns(df)) == [("lines.sku",), ("renamed",)]


def test_blank_columns_of_an_empty_table(spark):
    df = spark.createDataFrame([], "id string")
    assert rows(integrity.blank_columns(df)) == [("id",)]


def test_calendar_gap(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 5),), (dt.date(2024, 1, 8),), (dt.date(2024, 1, 8),)], "day date")
    assert tuple(integrity.calendar_gap(df, "day").first()) == (4, 2, 2)


def test_distinct_counts_ignore_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, None)], "n int, s string")
    assert rows(integrity.distinct_counts(df, ["n", "s"])) == [("n", 2), ("s", 1)]


# --- lineage and profile


def test_edges_pair_inside_a_move_only(spark):
    moves = spark.createDataFrame(
        [(["a", "b"], ["x"]), (["c"], ["y", "z"]), (["a"], ["x"])], "reads array<string>, writes array<string>"
    )
    assert rows(lineage.edges_from_moves(moves)) == [("a", "x"), ("b", "x"), ("c", "y"), ("c", "z")]


def test_one_move_per_landed_path(spark):
    landed = spark.createDataFrame([("vendor", "p1"), ("vendor", "p2")], "connection string, path string")
    edges = lineage.edges_from_moves(lineage.moves_from_source(landed, "connection", "path"))
    assert rows(edges) == [("vendor", "p1"), ("vendor", "p2")]


def _edges(spark, *pairs):
    return spark.createDataFrame(list(pairs), "source string, target string")


def test_declared_edges_carry_their_producer(spark):
    observed = _edges(spark, ("a", "b"), ("q", "r")).withColumn("producer", F.lit("copy"))
    labelled = lineage.label_edges(_edges(spark, ("a", "b"), ("b", "c")), observed)
    assert rows(labelled, "source", "target", "producer") == [("a", "b", "copy"), ("b", "c", "declared only")]


def test_an_empty_observation_fails_instead_of_passing_for_a_graph(spark):
    observed = _edges(spark, ("a", "b"))
    assert lineage.observed_or_fail(observed) is observed
    with pytest.raises(ValueError):
        lineage.observed_or_fail(observed.limit(0))


def test_orphans_on_either_side(spark):
    into, out_of = _edges(spark, ("v", "p1"), ("v", "p2")), _edges(spark, ("p1", "t"), ("p3", "t"))
    assert rows(lineage.orphans(into, out_of)) == [("p2", "never read"), ("p3", "never written")]


def test_trace_reaches_every_vendor_once_through_diamonds_and_cycles(spark, folder):
    edges = _edges(
        spark, ("v1", "b1"), ("v2", "b2"), ("b1", "s"), ("b2", "s"), ("b1", "t"), ("t", "s"), ("s", "g"), ("g", "t")
    )
    starts = spark.createDataFrame([("g",), ("b2",)], "node string")
    assert rows(lineage.trace_to_sources(edges, starts, folder)) == [
        ("b2", "v2", 1), ("g", "v1", 3), ("g", "v2", 3)
    ]


def test_trace_has_no_depth_limit(spark, folder):
    chain = _edges(spark, *[(f"n{i}", f"n{i + 1}") for i in range(36)])
    starts = spark.createDataFrame([("n36",)], "node string")
    assert rows(lineage.trace_to_sources(chain, starts, folder)) == [("n36", "n0", 36)]


def test_what_starts_share_is_traced_once(spark, folder, monkeypatch):
    orders = [f"order {i}" for i in range(60)]
    edges = _edges(
        spark, ("r", "n"), ("n", "s"), *[("s", order) for order in orders], *[(f"p{i}", o) for i, o in enumerate(orders)]
    )
    traced, trace = [], lineage.trace_upstream
    monkeypatch.setattr(lineage, "trace_upstream", lambda e, s, f: traced.append((e.count(), rows(s))) or trace(e, s, f))
    starts = spark.createDataFrame([(order,) for order in orders], "node string")
    assert rows(lineage.trace_to_sources(edges, starts, folder)) == sorted(
        [(o, "r", 3) for o in orders] + [(o, f"p{i}", 1) for i, o in enumerate(orders)], key=repr
    )
    # Level by level goes only what feeds the orders and is fed itself, not sixty orders.
    assert traced == [(2, [("s",)])]


def test_profile_counts_rows_nulls_and_distinct_values(spark):
    df = spark.createDataFrame([(1, None, [1.0]), (1, "a", [1.0]), (2, None, None)], "n long, s string, v array<double>")
    assert rows(profile.profile({"t": df})) == [
        ("t", "n", "INT", 3, 0, 2), ("t", "s", "STRING", 3, 2, 1), ("t", "v", "STRING", 3, 1, 1)
    ]
