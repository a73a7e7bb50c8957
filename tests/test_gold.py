import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from assay.operators import measures, quality, reconcile
from assay.plans import gold
from conftest import rows

D = Decimal


def day(n):
    return dt.date(2026, 6, 28) + dt.timedelta(days=n)


def _fx(spark):
    published = [("EUR", day(0), D("2"), False), ("EUR", day(1), D("2"), True), ("EUR", day(2), D("4"), False)]
    return spark.createDataFrame(published, "currency string, rate_date date, rate decimal(18,8), is_carried boolean")


def _orders(spark):
    schema = (
        "order_id long, line_no int, customer_id long, party_key string, product_id long, order_date date, "
        "currency string, quantity long, amount decimal(19,4), is_cancelled boolean"
    )
    return spark.createDataFrame(
        [
            (1, 1, 1, "ann", 10, day(0), "EUR", 2, D("5"), False),
            (1, 2, 1, "ann", 11, day(1), "EUR", 1, D("3"), True),
            (2, 1, 2, "POS:2", 10, day(2), "EUR", 1, D("1.5"), False),
            (3, 1, 2, "POS:2", 12, day(2), "XXX", 1, D("9"), False),
        ],
        schema,
    )


def _star(spark):
    orders = gold.fct_orders(_orders(spark), _fx(spark))
    account_party = spark.createDataFrame([("w", "ann")], "member_id string, party_key string")
    web = spark.createDataFrame(
        [(7, 1, "w", 13, day(3 - 1), "EUR", 1, D("2"), False)],
        "order_id long, line_no int, account_id string, product_id long, order_date date, currency string, "
        "quantity long, amount decimal(19,4), is_cancelled boolean",
    )
    return orders, gold.fct_sales(orders, web, account_party, _fx(spark))


def test_orders_convert_at_their_own_days_rate(spark):
    orders, _ = _star(spark)
    assert rows(orders, "order_id", "line_no", "amount_usd", "rate_is_carried") == [
        (1, 1, D("10.0000"), False),
        (1, 2, D("6.0000"), True),
        (2, 1, D("6.0000"), False),
        (3, 1, None, None),
    ]


def test_sales_union_both_systems_under_the_resolved_party(spark):
    _, sales = _star(spark)
    assert rows(sales, "channel_system", "order_id", "line_no", "party_key", "amount_usd") == [
        ("POS", 1, 1, "ann", D("10.0000")),
        ("POS", 1, 2, "ann", D("6.0000")),
        ("POS", 2, 1, "POS:2", D("6.0000")),
        ("POS", 3, 1, "POS:2", None),
        ("WEB", 7, 1, "ann", D("8.0000")),
    ]


def test_products_sold_outside_the_hierarchy_get_a_member(spark):
    _, sales = _star(spark)
    hierarchy = spark.createDataFrame(
        [(10, "s", "d"), (99, "s", "d")], "product_id long, product_segment string, department string"
    )
    assert rows(gold.dim_product(hierarchy, sales), "product_id", "department") == [
        (10, "d"), (11, "Unallocated"), (12, "Unallocated"), (13, "Unallocated"), (99, "d")
    ]


def test_dates_come_from_the_fact(spark):
    _, sales = _star(spark)
    assert rows(gold.dim_date(sales), "order_date", "fiscal_quarter_label") == [
        (day(0), "FY27 Q1"), (day(1), "FY27 Q1"), (day(2), "FY27 Q1")
    ]


def test_summary_loses_nothing_and_keeps_cancelled_apart(spark):
    _, sales = _star(spark)
    parties = spark.createDataFrame(
        [("ann", "retail", "US"), ("POS:2", "trade", None)], "party_key string, customer_segment string, country string"
    )
    hierarchy = spark.createDataFrame([(10, "s", "d")], "product_id long, product_segment string, department string")
    summary = gold.fct_revenue_summary(sales, gold.dim_date(sales), gold.dim_product(hierarchy, sales), parties)
    found = rows(
        summary, "channel_system", "customer_segment", "department", "sale_lines", "units",
        "revenue_usd", "cancelled_revenue_usd", "revenue_at_carried_rate",
    )
    zero = D("0.0000")
    assert found == [
        ("POS", "retail", "Unallocated", 1, 1, zero, D("6.0000"), zero),
        ("POS", "retail", "d", 1, 2, D("10.0000"), zero, zero),
        ("POS", "trade", "Unallocated", 1, 1, zero, zero, zero),
        ("POS", "trade", "d", 1, 1, D("6.0000"), zero, zero),
        ("WEB", "retail", "Unallocated", 1, 1, D("8.0000"), zero, zero),
    ]
    kept = F.sum(F.when(~F.col("is_cancelled"), F.col("amount_usd"))).cast("decimal(29,4)")
    control = quality.control_total(sales, kept, summary, F.sum("revenue_usd"))
    assert control.first().lost == 0
    short = quality.control_total(sales, kept, summary.where("channel_system = 'POS'"), F.sum("revenue_usd"))
    assert short.first().lost == D("8.0000")


def test_daily_revenue_keeps_orders_of_unknown_customers(spark):
    orders, _ = _star(spark)
    customers = spark.createDataFrame([(1, "a", "US")], "customer_id long, name string, country string")
    daily = gold.fct_daily_revenue(orders, customers)
    assert rows(daily, "order_date", "country", "orders", "revenue") == [
        (day(0), "US", 1, D("10.0000")), (day(1), "US", 1, D("6.0000")), (day(2), None, 2, D("6.0000"))
    ]


# --- measures


def _model(spark):
    facts = spark.createDataFrame(
        [(1, "x", D("10"), 2), (1, "y", D("5"), 0), (2, "x", D("7"), 7), (3, "x", D("1"), 0)],
        "customer_id int, channel string, amount decimal(19,4), units long",
    )
    customers = spark.createDataFrame([(1, "US"), (2, "GB")], "id int, country string")
    countries = spark.createDataFrame([("US", "a"), ("US", "b")], "code string, name string")
    return measures.Model(
        {"sales": facts, "customer": customers, "country": countries},
        {
            "sales": [
                measures.sum_of("revenue", "amount"),
                measures.sum_of("units", "units"),
                measures.ratio("per_unit", "revenue", "units"),
                measures.plus("double", "revenue", "revenue"),
                measures.count_rows("lines"),
            ]
        },
        [
            measures.Relationship("sales", "customer_id", "customer", "id"),
            measures.Relationship("sales", "channel", "country", "code"),
        ],
    )


def test_summarize_by_own_column(spark):
    found = _model(spark).summarize("sales", ["channel"])
    assert rows(found) == [
        ("x", D("18.0000"), 9, D("2.000000000"), D("36.0000"), 3),
        ("y", D("5.0000"), 0, None, D("10.0000"), 1),
    ]


def test_summarize_through_a_relationship_keeps_unmatched_facts(spark):
    found = _model(spark).summarize("sales", ["customer.country"], ["revenue", "lines"])
    assert rows(found) == [("GB", D("7.0000"), 1), ("US", D("15.0000"), 2), (None, D("1.0000"), 1)]


def test_only_needed_measures_are_aggregated(spark):
    found = _model(spark).summarize("sales", ["channel"], ["per_unit"])
    assert found.columns == ["channel", "per_unit"]


def test_a_one_side_with_duplicates_is_reported(spark):
    assert rows(_model(spark).duplicate_keys()) == [("country", "US", 2)]


def test_a_one_side_with_duplicates_fails_the_summary(spark):
    with pytest.raises(Exception, match="country repeats the key"):
        _model(spark).summarize("sales", ["country.name"], ["revenue"]).collect()


def test_plus_takes_a_blank_as_zero_and_keeps_its_type(spark):
    facts = spark.createDataFrame(
        [("a", D("1"), None, 1.5), ("b", None, None, 2.0)],
        "k string, x decimal(19,4), y decimal(19,4), z double",
    )
    model = measures.Model(
        {"f": facts},
        {
            "f": [
                measures.sum_of("x", "x"), measures.sum_of("y", "y"), measures.sum_of("z", "z"),
                measures.count_rows("n"), measures.plus("x_y", "x", "y"), measures.plus("z_n", "z", "n"),
            ]
        },
    )
    found = model.summarize("f", ["k"], ["x_y", "z_n"])
    assert rows(found) == [("a", D("1.0000"), 2.5), ("b", None, 3.0)]
    assert dict(found.dtypes)["z_n"] == "double"


def test_unrelated_table_is_refused(spark):
    with pytest.raises(ValueError):
        _model(spark).summarize("sales", ["orders.day"])


def test_hot_key_is_summed_before_the_dimension_join(spark):
    plan = _model(spark).summarize("sales", ["customer.country"], ["revenue"])
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("Join") < text.rindex("Aggregate")


def test_model_names_map_back(spark):
    df = spark.createDataFrame([(1,)], "fiscal_year_label int")
    renamed = measures.to_model_names(df)
    assert renamed.columns == ["FiscalYearLabel"]
    assert measures.to_table_names(renamed).columns == df.columns
    with pytest.raises(ValueError):
        measures.to_model_names(spark.createDataFrame([(1,)], "Bad_Name int"))


# --- reconciliation


def _surface(spark, *quarters):
    return spark.createDataFrame(
        [(q, D(r), D(c)) for q, r, c in quarters],
        "quarter string, revenue_usd decimal(19,4), cancelled_revenue_usd decimal(19,4)",
    )


FIELDS = ["revenue_usd", "cancelled_revenue_usd"]


def test_agreement_has_no_problems(spark):
    side = _surface(spark, ("FY27 Q1", "10", "1"), (None, "2", "2"))
    assert reconcile.compare(side, side, ["quarter"], FIELDS).count() == 0


def test_a_dollar_apart_names_the_quarter_and_field(spark):
    left, right = _surface(spark, ("FY27 Q1", "10", "1")), _surface(spark, ("FY27 Q1", "11", "1"))
    assert rows(reconcile.compare(left, right, ["quarter"], FIELDS)) == [
        ("FY27 Q1", "revenue_usd", "differs", D("10.0000"), D("11.0000"))
    ]


def test_a_cent_apart_is_tolerated_and_more_is_not(spark):
    left = _surface(spark, ("a", "10.00", "1"), ("b", "10.00", "1"))
    right = _surface(spark, ("a", "10.01", "1"), ("b", "10.0101", "1"))
    assert rows(reconcile.compare(left, right, ["quarter"], FIELDS), "quarter") == [("b",)]


def test_a_quarter_on_one_side_only(spark):
    left = _surface(spark, ("a", "1", "1"), ("b", "1", "1"))
    right = _surface(spark, ("a", "1", "1"), ("c", "1", "1"))
    assert rows(reconcile.compare(left, right, ["quarter"], FIELDS), "quarter", "problem") == [
        ("b", "left only"), ("c", "right only")
    ]


def test_null_against_a_value_differs(spark):
    left = _surface(spark, ("a", "1", "1"))
    right = left.withColumn("revenue_usd", F.lit(None).cast("decimal(19,4)"))
    assert rows(reconcile.compare(left, right, ["quarter"], FIELDS), "field") == [("revenue_usd",)]


def test_compare_joins_on_hashed_keys_not_nested_loops(spark):
    left, right = _surface(spark, ("a", "1", "1")), _surface(spark, ("a", "1", "1"))
    plan = reconcile.compare(left, right, ["quarter"], FIELDS)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_snapshots_compare_by_metric(spark):
    a = spark.createDataFrame([(D("1"), 5)], "revenue_usd decimal(19,4), sale_lines long")
    b = spark.createDataFrame([(D("1"), 6)], "revenue_usd decimal(19,4), sale_lines long")
    assert reconcile.snapshot_diff(a, a).count() == 0
    assert rows(reconcile.snapshot_diff(a, b), "metric") == [("sale_lines",)]


def test_pack_total_graded_against_the_export(spark):
    pack = spark.createDataFrame([(D("1.00"),), (D("2.00"),)], "v decimal(19,4)")
    export = spark.createDataFrame([(D("3.00"),)], "v decimal(19,4)")
    assert reconcile.grade_total(pack, "v", export, "v").first().agrees
    assert not reconcile.grade_total(pack, "v", pack, "v").first().pack_total == D("2")
    assert not reconcile.grade_total(pack, "v", export.unionByName(export), "v").first().agrees
