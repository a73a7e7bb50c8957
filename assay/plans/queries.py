"""Registered queries: every operator over whole given tables.

Each takes the feeds over one directory and returns a DataFrame; the registry turns it
into the ``(spark, folder)`` form.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.functions.calendar import fiscal_quarter_label, utc_date
from assay.operators import (
    cdc,
    conform,
    dedupe,
    densify,
    history,
    identity,
    integrity,
    lineage,
    lines,
    measures,
    profile,
    quality,
    quarantine,
    reconcile,
    state,
)
from assay.plans import gold, medallion, refresh
from assay.plans.feeds import CHANGE_IMAGE, TABLES, Feeds
from assay.session import apply_runtime_settings, shared_folder
from assay.sources import changes, files, landing, tables, versions
from assay.streaming import exactly_once, ingest, markers, upsert
from assay.types import MONEY, RATE, TOTAL, all_strings, money, page_of

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[Feeds], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(Feeds(apply_runtime_settings(spark), folder))

    run.__name__, run.__doc__ = build.__name__, build.__doc__
    REGISTRY[build.__name__] = run
    return run


def staging(feeds: Feeds, name: str) -> str:
    """A fresh place in the shared folder for files a query lands before it reads them."""
    return shared_folder(feeds.spark, name, uuid.uuid4().hex)


_PRODUCTS: dict[tuple[str, str], str] = {}


def _product(feeds: Feeds) -> dict:
    """The manifest of the whole product over the feeds, built and published once a session."""
    key = (feeds.spark.sparkContext.applicationId, feeds.folder)
    if key not in _PRODUCTS:
        root = staging(feeds, "product")
        refresh.refresh(feeds, root, set())
        _PRODUCTS[key] = root
    return versions.current(feeds.spark, _PRODUCTS[key])


# --- revenue ------------------------------------------------------------------------


def _order_places(feeds: Feeds) -> DataFrame:
    """Orders with their day, cancellation and the country and region they were sold in."""
    nations = feeds.table("nation").join(
        feeds.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    places = feeds.table("customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return (
        feeds.table("orders")
        .join(places, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("o_orderkey").alias("l_orderkey"),
            F.to_date("o_orderdate").alias("order_date"),
            (F.col("o_orderstatus") == "P").alias("is_cancelled"),
            F.col("c_custkey").alias("customer_id"),
            F.col("n_name").alias("country"),
            F.col("r_name").alias("region"),
        )
    )


def _sold_lines(feeds: Feeds) -> DataFrame:
    return (
        feeds.table("lineitem")
        .select(
            "l_orderkey",
            F.col("l_quantity").cast("long").alias("quantity"),
            money("l_extendedprice").alias("amount"),
        )
        .join(_order_places(feeds), "l_orderkey")
    )


def _sold_orders(feeds: Feeds) -> DataFrame:
    """Totals per order with the order's day and place.

    Lines are summed by the key they join on, so the one shuffle carries a row per
    order and map task, and an order holding a third of the lines is like any other.
    """
    totals = feeds.table("lineitem").groupBy("l_orderkey").agg(
        F.count("*").alias("lines"),
        F.sum(F.col("l_quantity").cast("long")).alias("units"),
        F.sum(money("l_extendedprice")).cast(TOTAL).alias("amount"),
    )
    return totals.join(_order_places(feeds), "l_orderkey")


@query
def fiscal_revenue(feeds: Feeds) -> DataFrame:
    """Net and cancelled revenue by fiscal quarter and region.

    Orders are summed per day before the fiscal labels are formed, so labelling costs
    one row per day and region.
    """
    kept = ~F.col("is_cancelled")
    daily = (
        _sold_orders(feeds)
        .groupBy("order_date", "region")
        .agg(
            F.sum(F.when(kept, F.col("amount"))).cast(TOTAL).alias("net"),
            F.sum(F.when(~kept, F.col("amount"))).cast(TOTAL).alias("cancelled"),
            F.sum("lines").alias("lines"),
        )
    )
    return (
        daily.withColumn("fiscal_quarter", fiscal_quarter_label(F.col("order_date")))
        .groupBy("fiscal_quarter", "region")
        .agg(
            F.sum("net").cast(TOTAL).alias("revenue"),
            F.sum("cancelled").cast(TOTAL).alias("cancelled_revenue"),
            F.sum("lines").alias("sale_lines"),
        )
    )


@query
def daily_revenue(feeds: Feeds) -> DataFrame:
    return (
        _sold_orders(feeds)
        .groupBy("order_date", "country")
        .agg(
            F.count("*").alias("orders"),
            F.sum("units").alias("units"),
            F.sum("amount").cast(TOTAL).alias("revenue"),
        )
    )


# --- dedupe, quarantine, conform ----------------------------------------------------


@query
def latest_line(feeds: Feeds) -> DataFrame:
    return feeds.latest_lines()


@query
def redelivery_check(feeds: Feeds) -> DataFrame:
    return dedupe.redeliveries(feeds.line_events(), ["l_orderkey", "l_linenumber"])


@query
def quarantine_lines(feeds: Feeds) -> DataFrame:
    return feeds.judged_lines().quarantined.select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", F.concat_ws("; ", "reasons").alias("reasons")
    )


@query
def missing_key_quarantined(feeds: Feeds) -> DataFrame:
    """Lines that arrive without their order: each reaches quarantine, repeats included."""
    events = feeds.line_events().withColumn(
        "l_orderkey", F.when(F.col("l_linenumber") != 7, F.col("l_orderkey"))
    )
    latest = dedupe.latest_by_sequence(events, ["l_orderkey", "l_linenumber"], "l_shipdate")
    split = quarantine.split(latest, {"key missing": F.col("l_orderkey").isNotNull()})
    return split.quarantined.select(
        "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", F.concat_ws("; ", "reasons").alias("reasons")
    )


@query
def quarantine_accounting(feeds: Feeds) -> DataFrame:
    """Clean and quarantined rows; together they are the distinct keys."""
    split = feeds.judged_lines()
    clean = split.clean.agg(F.count("*").alias("rows")).select(F.lit("clean").alias("part"), "rows")
    held = split.quarantined.agg(F.count("*").alias("rows")).select(F.lit("quarantined").alias("part"), "rows")
    return clean.unionByName(held)


@query
def money_conform(feeds: Feeds) -> DataFrame:
    """Prices as text, some with a currency sign no decimal can hold."""
    price = F.col("l_extendedprice").cast(MONEY).cast("string")
    typed = F.when(F.col("l_returnflag") == "R", F.concat(F.lit("$"), price)).otherwise(price)
    return (
        feeds.table("lineitem")
        .select("l_returnflag", money(typed).alias("amount"))
        .groupBy("l_returnflag")
        .agg(
            F.count("amount").alias("parsed"),
            F.count_if(F.col("amount").isNull()).alias("unparsed"),
            F.sum("amount").cast(TOTAL).alias("total"),
        )
    )


@query
def country_conform(feeds: Feeds) -> DataFrame:
    return feeds.customers().select("customer_id", "typed_country", "country")


@query
def hierarchy_conform(feeds: Feeds) -> DataFrame:
    return feeds.hierarchy()


@query
def domain_check(feeds: Feeds) -> DataFrame:
    """Return flags found against those expected: one unexpected, one absent."""
    return conform.domain_differences(feeds.table("lineitem"), "l_returnflag", ["A", "N", "X"])


@query
def distincts(feeds: Feeds) -> DataFrame:
    return integrity.distinct_counts(
        feeds.table("lineitem"), ["l_orderkey", "l_partkey", "l_suppkey", "l_shipdate", "l_returnflag"]
    )


# --- identity -----------------------------------------------------------------------


@query
def party(feeds: Feeds) -> DataFrame:
    return feeds.parties()


@query
def party_cohorts(feeds: Feeds) -> DataFrame:
    """Cohort sizes, and the naive match that conforming must strictly beat."""
    naive = identity.raw_matches(feeds.addressed_customers(), "email", feeds.accounts(), "email")
    return (
        identity.cohort_counts(feeds.parties())
        .withColumn("naive_matches", naive.scalar())
        .withColumn("conforming_gains", F.col("matched") > F.col("naive_matches"))
    )


@query
def missing_key_apart(feeds: Feeds) -> DataFrame:
    """Customers beside the account sharing their address; those without one survive."""
    accounts = feeds.web_members().where(F.col("email").isNotNull())
    customers = feeds.pos_members().withColumnRenamed("member_id", "customer_id")
    return conform.join_missing_apart(
        customers, accounts.withColumnRenamed("member_id", "account_id"), "email"
    ).select("customer_id", "email", "account_id")


@query
def key_overlap(feeds: Feeds) -> DataFrame:
    return identity.shared_keys(feeds.table("events"), "user_id", feeds.table("customer"), "c_custkey")


# --- nested orders and offsets --------------------------------------------------------


@query
def order_lines_exploded(feeds: Feeds) -> DataFrame:
    return lines.explode_lines(feeds.web_orders())


@query
def nested_survived(feeds: Feeds) -> DataFrame:
    return lines.nested_survived(feeds.web_orders())


@query
def utc_order_date(feeds: Feeds) -> DataFrame:
    """UTC day of each storefront order beside the day its local text shows."""
    return feeds.web_orders().select(
        "web_order_id",
        "placed_at",
        utc_date(F.col("placed_at")).alias("utc_day"),
        F.substring("placed_at", 1, 10).cast("date").alias("local_day"),
    )


# --- exchange rates -------------------------------------------------------------------


@query
def fx_dense(feeds: Feeds) -> DataFrame:
    return feeds.fx_daily()


@query
def fx_accounting(feeds: Feeds) -> DataFrame:
    return densify.carry_accounting(feeds.fx_daily(), "currency", "rate_date")


@query
def fx_gap(feeds: Feeds) -> DataFrame:
    return integrity.calendar_gap(feeds.fx_rates(), "rate_date")


# --- the star -------------------------------------------------------------------------


@query
def dim_customer(feeds: Feeds) -> DataFrame:
    return gold.dim_customer(feeds.customers())


@query
def dim_party(feeds: Feeds) -> DataFrame:
    return feeds.dim_party()


@query
def dim_country(feeds: Feeds) -> DataFrame:
    return gold.dim_country(feeds.dim_party(), feeds.country_names())


@query
def fct_orders(feeds: Feeds) -> DataFrame:
    return feeds.fct_orders()


@query
def fct_sales(feeds: Feeds) -> DataFrame:
    return feeds.fct_sales()


@query
def sales_usd(feeds: Feeds) -> DataFrame:
    """Both channels by currency, cancelled and carried apart."""
    return (
        feeds.fct_sales()
        .groupBy("channel_system", "currency")
        .agg(*gold.sale_totals())
    )


@query
def dim_product(feeds: Feeds) -> DataFrame:
    return gold.dim_product(feeds.hierarchy(), feeds.fct_sales())


@query
def dim_date(feeds: Feeds) -> DataFrame:
    return gold.dim_date(feeds.fct_sales())


@query
def fct_daily_revenue(feeds: Feeds) -> DataFrame:
    return gold.fct_daily_revenue(feeds.fct_orders(), gold.dim_customer(feeds.customers()))


def _summary(feeds: Feeds) -> DataFrame:
    """The reporting summary over a written fact: three models read it, one builds it."""
    sales = tables.materialise(feeds.fct_sales(), staging(feeds, "fct_sales"))
    return gold.fct_revenue_summary(
        sales, gold.dim_date(sales), gold.dim_product(feeds.hierarchy(), sales), feeds.dim_party()
    )


@query
def fct_revenue_summary(feeds: Feeds) -> DataFrame:
    return _summary(feeds)


@query
def medallion_tables(feeds: Feeds) -> DataFrame:
    """The whole product built table by table, and what each table holds where it was written."""
    root = staging(feeds, "product")
    medallion.build(feeds, root)
    paths = {name: f"{root}/{name}" for name in (*medallion.SILVER, *medallion.GOLD)}
    return tables.landed_at(feeds.spark, paths).select("table_name", "rows")


# --- refresh --------------------------------------------------------------------------

# The days whose rates a second delivery restates, and the money each table adds up.
RESTATED = ("2024-01-16", "2024-01-19")
TABLE_TOTALS = {
    "silver_fx_daily": "rate",
    "fct_orders": "amount_usd",
    "fct_sales": "amount_usd",
    "fct_daily_revenue": "revenue",
    "fct_revenue_summary": "revenue_usd",
}


class DeliveredRates(Feeds):
    """The feeds with rates of a later delivery in place of those published before."""

    def __init__(self, spark: SparkSession, folder: str, delivered: DataFrame):
        super().__init__(spark, folder)
        self.delivered = delivered

    def fx_rates(self) -> DataFrame:
        return super().fx_rates().join(self.delivered, ["currency", "rate_date"], "left_anti").unionByName(self.delivered)


def _restated_rates(feeds: Feeds, factor: int) -> DataFrame:
    return feeds.fx_rates().where(F.col("rate_date").between(*RESTATED)).withColumn(
        "rate", (F.col("rate") * F.lit(factor)).cast(RATE)
    )


def _delivered(feeds: Feeds, rates: DataFrame, root: str) -> list[tuple[dict, list[refresh.Change]]]:
    """Land rates, mark the delivery complete, and refresh what lies below the feed it names."""
    landing_root = staging(feeds, "landing")
    path = tables.write_table(rates, files.feed_path(landing_root, "treasury", "2024-01-31", "fx_rates"))
    files.mark_complete(feeds.spark, path)
    outcome = []

    def react(session: SparkSession, folder: str, batch_id: int) -> None:
        landed = session.read.schema(rates.schema).option("pathGlobFilter", "part-*").parquet(folder)
        feed = f"bronze_{folder.rstrip('/').rsplit('/', 1)[-1]}"
        outcome.append(refresh.refresh(DeliveredRates(session, feeds.folder, landed), root, {feed}))

    markers.on_delivery(feeds.spark, landing_root, react, staging(feeds, "checkpoints"))
    return outcome


@query
def product_refresh(feeds: Feeds) -> DataFrame:
    """A delivery of restated rates, and what it did to the product it reached.

    One row per table rebuilt: how, the parts written anew, and rows and money before and after.
    """
    root = staging(feeds, "product")
    before = refresh.branch(feeds, root, _product(feeds))
    ((after, changes),) = _delivered(feeds, _restated_rates(feeds, 2), root)
    found = []
    for change in changes:
        row = feeds.spark.range(1).select(
            F.lit(change.table).alias("table_name"),
            F.lit(change.action).alias("action"),
            F.lit(None if change.parts is None else len(change.parts)).cast("long").alias("parts"),
        )
        for when, manifest in (("before", before), ("after", after)):
            total = F.sum(TABLE_TOTALS[change.table]) if change.table in TABLE_TOTALS else F.lit(None)
            held = versions.read(feeds.spark, manifest, change.table).agg(
                F.count("*").alias(f"rows_{when}"), total.cast("decimal(38,8)").alias(f"total_{when}")
            )
            row = row.select("*", *[held.select(c).scalar().alias(c) for c in held.columns])
        found.append(row)
    return reduce(DataFrame.unionByName, found)


@query
def product_lineage(feeds: Feeds) -> DataFrame:
    """Declared edges of the product, labelled by the run whose plans read them.

    The run is a refresh after a delivery of rates; what it had no cause to build is declared only.
    """
    root = staging(feeds, "product")
    refresh.branch(feeds, root, _product(feeds))
    ((manifest, _),) = _delivered(feeds, _restated_rates(feeds, 2), root)
    observed = refresh.observed_edges(feeds.spark, manifest, since=manifest["version"])
    return lineage.label_edges(refresh.declared_edges(feeds.spark), lineage.observed_or_fail(observed))


@query
def refreshed_daily_revenue(feeds: Feeds) -> DataFrame:
    """Daily revenue as readers find it once restated rates were delivered."""
    root = staging(feeds, "product")
    refresh.branch(feeds, root, _product(feeds))
    _delivered(feeds, _restated_rates(feeds, 2), root)
    return versions.read(feeds.spark, versions.current(feeds.spark, root), "fct_daily_revenue")


@query
def refused_refresh(feeds: Feeds) -> DataFrame:
    """Daily revenue after a delivery whose rates break a contract: that of the version before."""
    root = staging(feeds, "product")
    refresh.branch(feeds, root, _product(feeds))
    broken = DeliveredRates(feeds.spark, feeds.folder, _restated_rates(feeds, -1))
    try:
        refresh.refresh(broken, root, {"bronze_fx_rates"})
    except refresh.ContractBroken:
        return versions.read(feeds.spark, versions.current(feeds.spark, root), "fct_daily_revenue")
    raise AssertionError("negative rates were published")


@query
def dq_product(feeds: Feeds) -> DataFrame:
    """Every contract rule of every written table with its violations."""
    held = refresh.tables_of(feeds, _product(feeds))
    rules = refresh.product_rules(held)
    return quality.rule_report(quality.evaluate(held, rules), rules)


# --- measures -------------------------------------------------------------------------

PACK_MEASURES = [
    measures.sum_of("revenue_usd", "revenue_usd"),
    measures.sum_of("units_sold", "units"),
    measures.sum_of("cancelled_revenue", "cancelled_revenue_usd"),
    measures.plus("gross_revenue", "revenue_usd", "cancelled_revenue"),
    measures.sum_of("revenue_at_carried_rate", "revenue_at_carried_rate"),
    measures.ratio("carried_rate_share", "revenue_at_carried_rate", "revenue_usd"),
]

SALES_MEASURES = [
    measures.sum_of("total_revenue", "amount"),
    measures.sum_of("total_units", "quantity"),
    measures.ratio("revenue_per_unit", "total_revenue", "total_units"),
    measures.count_rows("sale_lines"),
]


def _sales_model(feeds: Feeds) -> measures.Model:
    return measures.Model(
        tables={
            "sales": _sold_lines(feeds).select("order_date", "customer_id", "quantity", "amount"),
            "customer": feeds.customers(),
            "account": feeds.table("events"),
        },
        measures={"sales": SALES_MEASURES},
        relationships=[
            measures.Relationship("sales", "customer_id", "customer", "customer_id"),
            measures.Relationship("sales", "customer_id", "account", "user_id"),
        ],
    )


@query
def measures_by_segment(feeds: Feeds) -> DataFrame:
    return _sales_model(feeds).summarize("sales", ["customer.segment", "customer.country"])


@query
def measures_by_day(feeds: Feeds) -> DataFrame:
    return _sales_model(feeds).summarize("sales", ["order_date"])


@query
def model_duplicate_keys(feeds: Feeds) -> DataFrame:
    """Keys that break a one side: customers are unique, event users are not."""
    return _sales_model(feeds).duplicate_keys()


@query
def pack_by_quarter(feeds: Feeds) -> DataFrame:
    pack = measures.Model({"reporting": _summary(feeds)}, {"reporting": PACK_MEASURES})
    return pack.summarize("reporting", ["fiscal_quarter_label", "channel_system"])


@query
def country_across(feeds: Feeds) -> DataFrame:
    """Customers, order revenue and reported revenue by one country, each fact summed apart."""
    held = refresh.tables_of(feeds, _product(feeds))
    model = measures.Model(
        tables={
            "customer": held["dim_customer"],
            "revenue": held["fct_daily_revenue"],
            "reporting": held["fct_revenue_summary"],
            "country": held["dim_country"],
        },
        measures={
            "customer": [measures.count_rows("customers")],
            "revenue": [measures.sum_of("order_revenue", "revenue"), measures.sum_of("order_units", "units")],
            "reporting": [
                measures.sum_of("reported_revenue", "revenue_usd"),
                measures.sum_of("reported_units", "units"),
                measures.ratio("reported_per_unit", "reported_revenue", "reported_units"),
            ],
        },
        relationships=[
            measures.Relationship(fact, "country", "country", "country")
            for fact in ("customer", "revenue", "reporting")
        ],
    )
    return model.summarize_across(["customer", "revenue", "reporting"], ["country.country", "country.country_name"])


@query
def pack_in_model_names(feeds: Feeds) -> DataFrame:
    return measures.to_model_names(gold.dim_date(feeds.fct_sales()))


# --- the change stream ----------------------------------------------------------------


@query
def cdc_envelope(feeds: Feeds) -> DataFrame:
    return cdc.usable(cdc.parse_envelopes(feeds.envelopes(), CHANGE_IMAGE))


@query
def cdc_faults(feeds: Feeds) -> DataFrame:
    """Envelopes spoiled by event type: each spoiled kind must be named, none repaired."""
    kind = F.get_json_object("value", "$.after.account_status")
    spoiled = feeds.envelopes().select(
        "capture_offset",
        F.when(kind == "view", F.regexp_replace("value", '"op":"u"', '"op":"r"'))
        .when(kind == "click", F.regexp_replace("value", '"op":"u"', '"op":"x"'))
        .when(kind == "purchase", F.lit('{"op":"u"}'))
        .when(kind == "signup", F.lit(None))
        .otherwise(F.col("value"))
        .alias("value"),
    )
    parsed = cdc.faults(cdc.parse_envelopes(spoiled, CHANGE_IMAGE))
    return parsed.groupBy("fault").agg(F.count("*").alias("events"))


@query
def change_counts(feeds: Feeds) -> DataFrame:
    return cdc.counts_by_operation(feeds.changes())


@query
def current_state(feeds: Feeds) -> DataFrame:
    return cdc.current_state(feeds.changes(), ["erp_customer_id"], "capture_offset")


@query
def scd2(feeds: Feeds) -> DataFrame:
    versions = history.validity_intervals(
        feeds.changes(), ["erp_customer_id"], "effective_date", "capture_offset"
    )
    return versions.drop("effective_date")


@query
def scd2_current_is_live(feeds: Feeds) -> DataFrame:
    """Customers whose current version is not the row that replaying the log leaves: none."""
    keys = ["erp_customer_id", "capture_offset"]
    versions = history.validity_intervals(
        feeds.changes(), ["erp_customer_id"], "effective_date", "capture_offset"
    )
    current = versions.where("is_current").select(*keys, F.lit(True).alias("in_history"))
    live = cdc.current_state(feeds.changes(), ["erp_customer_id"], "capture_offset").select(
        *keys, F.lit(True).alias("in_state")
    )
    return current.join(live, keys, "full_outer").where("in_history is null or in_state is null").select(*keys)


BATCHES = 4


def _merged_batches(feeds: Feeds) -> dict:
    """All changes merged batch by batch, late ones among them, the first one delivered twice."""
    root = staging(feeds, "erp_state")
    # Business days run behind capture, so batches cut by a mix of both hold late events.
    batch = F.pmod(F.col("capture_offset") * 7 + F.floor(F.col("capture_offset") / 100), F.lit(BATCHES))
    events = feeds.changes().withColumn("batch", batch)
    for number in (0, *range(BATCHES)):
        manifest = state.merge_batch(
            events.where(F.col("batch") == number).drop("batch"),
            root,
            ["erp_customer_id"],
            "effective_date",
            "capture_offset",
            buckets=16,
        )
    return manifest


@query
def state_by_batches(feeds: Feeds) -> DataFrame:
    """Current state moved on batch by batch: what replaying the whole log leaves."""
    return state.read_state(feeds.spark, _merged_batches(feeds))


@query
def history_by_batches(feeds: Feeds) -> DataFrame:
    """Validity intervals moved on batch by batch: those of the whole log."""
    return state.read_history(feeds.spark, _merged_batches(feeds)).drop("effective_date")


@query
def order_disagreement(feeds: Feeds) -> DataFrame:
    return history.order_disagreements(
        feeds.changes(), ["erp_customer_id"], "effective_date", "capture_offset"
    )


@query
def redelivered_changes(feeds: Feeds) -> DataFrame:
    """A stream delivered twice holds every event once after the re-run."""
    twice = feeds.changes().unionByName(feeds.changes())
    return cdc.counts_by_operation(cdc.drop_redelivered(twice, ["capture_offset"]))


# --- contracts ------------------------------------------------------------------------


def _contract_tables(feeds: Feeds) -> dict[str, DataFrame]:
    return {
        "lineitem": feeds.table("lineitem"),
        "orders": feeds.table("orders"),
        "customer": feeds.table("customer"),
        "classified_part": feeds.hierarchy(),
        "priced_customer": feeds.customers(),
    }


CONTRACT = {
    "orders": {
        "o_orderkey": ["unique", "not_null"],
        "o_orderstatus": ["not_null", {"accepted_values": {"values": ["F", "O"]}}],
        "o_custkey": [{"relationships": {"to": "customer", "field": "c_custkey"}}],
    },
    "lineitem": {
        "l_orderkey": ["unique", {"relationships": {"to": "orders", "field": "o_orderkey"}}],
        "l_partkey": [{"relationships": {"to": "classified_part", "field": "product_id"}}],
        "l_suppkey": [{"relationships": {"to": "vendor", "field": "vendor_id"}}],
        "l_returnflag": [{"accepted_values": {"values": ["A", "N"]}}],
    },
    "priced_customer": {"customer_id": ["unique"], "email": ["not_null"], "country": ["not_null"]},
}


@query
def dq_report(feeds: Feeds) -> DataFrame:
    """Every declared rule with its violations, row rules of a table in one pass.

    The last rule is declared and never run: the report must say so.
    """
    given = _contract_tables(feeds)
    rules = quality.rules_from(CONTRACT, given)
    rules.append(quality.row_rule("lineitem", "l_quantity", "quantity_is_positive", F.col("l_quantity") > 0))
    rules.append(quality.row_rule("lineitem", "l_discount", "discount_below_tenth", F.col("l_discount") < 0.1))
    forgotten = quality.not_null("customer", "c_name")
    return quality.rule_report(quality.evaluate(given, rules), [*rules, forgotten])


@query
def dq_duplicate_values(feeds: Feeds) -> DataFrame:
    return quality.duplicate_values(feeds.table("lineitem"), "l_orderkey")


@query
def dq_invalid_values(feeds: Feeds) -> DataFrame:
    return quality.invalid_values(feeds.table("orders"), "o_orderstatus", ["F", "O"]).select(
        "o_orderkey", "o_orderstatus"
    )


@query
def dq_null_values(feeds: Feeds) -> DataFrame:
    return quality.null_values(feeds.customers(), "email").select("customer_id", "segment")


@query
def dq_unresolved_keys(feeds: Feeds) -> DataFrame:
    """Parts sold but never classified, with the lines that name them."""
    return quality.unresolved_keys(feeds.table("lineitem"), "l_partkey", feeds.hierarchy(), "product_id")


@query
def dq_channels(feeds: Feeds) -> DataFrame:
    """Selling systems that never reach the fact, out of three required."""
    return quality.missing_values(feeds.fct_sales(), "channel_system", [gold.POS, gold.WEB, "PHONE"])


@query
def dq_countries(feeds: Feeds) -> DataFrame:
    """Countries of parties the dimension lacks; half of it is withheld."""
    parties = tables.materialise(feeds.dim_party(), staging(feeds, "dim_party"))
    known = gold.dim_country(parties, feeds.country_names()).where(F.col("country") < "N12")
    return quality.unresolved_keys(parties, "country", known, "country")


@query
def dq_fiscal_year(feeds: Feeds) -> DataFrame:
    """Order dates whose fiscal label is just the calendar year's, per quarter label.

    Only January to March may carry the label of their own calendar year.
    """
    day = F.col("order_date")
    calendar_label = F.format_string("FY%02d", F.pmod(F.year(day), F.lit(100)))
    dates = gold.dim_date(feeds.table("orders").select(F.to_date("o_orderdate").alias("order_date")))
    return (
        dates.withColumn("same_as_calendar", F.col("fiscal_year_label") == calendar_label)
        .withColumn("may_be_same", F.month(day) < 4)
        .groupBy("same_as_calendar", "may_be_same")
        .agg(F.count("*").alias("dates"))
    )


@query
def dq_money(feeds: Feeds) -> DataFrame:
    """Prices per unit that lose digits at four places, and money columns still floating."""
    per_unit = F.col("l_extendedprice").cast(MONEY) / F.col("l_quantity").cast("decimal(10,0)")
    priced = feeds.table("lineitem").select("l_orderkey", "l_extendedprice", per_unit.alias("per_unit"))
    losing = quality.money_losing_digits(priced, "per_unit")
    floating = quality.float_money(priced, ["l_extendedprice", "per_unit"])
    return losing.agg(F.count("*").alias("losing_digits")).withColumn(
        "float_columns", F.lit(",".join(floating))
    )


@query
def dq_control_total(feeds: Feeds) -> DataFrame:
    """The reporting summary holds exactly the fact's revenue."""
    sales = tables.materialise(feeds.fct_sales(), staging(feeds, "fct_sales"))
    summary = gold.fct_revenue_summary(
        sales, gold.dim_date(sales), gold.dim_product(feeds.hierarchy(), sales), feeds.dim_party()
    )
    kept = F.sum(F.when(~F.col("is_cancelled"), F.col("amount_usd"))).cast(TOTAL)
    return quality.control_total(sales, kept, summary, F.sum("revenue_usd").cast(TOTAL))


# --- reconciliation -------------------------------------------------------------------


def _two_surfaces(feeds: Feeds) -> tuple[DataFrame, DataFrame]:
    """Revenue by month through the model, and by a plain GROUP BY."""
    month = F.date_format("order_date", "yyyy-MM")
    sold = _sold_lines(feeds).withColumn("month", month)
    model = measures.Model(
        {"sales": sold},
        {"sales": [measures.sum_of("revenue", "amount"), measures.sum_of("units", "quantity")]},
    )
    direct = sold.groupBy("month").agg(
        F.sum("amount").cast(TOTAL).alias("revenue"), F.sum("quantity").alias("units")
    )
    return model.summarize("sales", ["month"]), direct


@query
def reconcile_agrees(feeds: Feeds) -> DataFrame:
    """The same question of two surfaces: no rows."""
    model, direct = _two_surfaces(feeds)
    return reconcile.compare(model, direct, ["month"], ["revenue", "units"])


@query
def reconcile_differs(feeds: Feeds) -> DataFrame:
    """One surface misses a year and another is off by a dollar or by a cent."""
    model, direct = _two_surfaces(feeds)
    perturbed = direct.where(~F.col("month").startswith("1997")).withColumn(
        "revenue",
        F.when(F.col("month").startswith("1998"), F.col("revenue") + F.lit(1))
        .when(F.col("month").startswith("1999"), F.col("revenue") + F.lit("0.01").cast(MONEY))
        .otherwise(F.col("revenue"))
        .cast(TOTAL),
    )
    return reconcile.compare(model, perturbed, ["month"], ["revenue", "units"])


SURFACE_KEYS = [
    "fiscal_quarter_label", "customer_segment", "country", "channel_system", "department", "product_segment",
]
SURFACE_FIELDS = ["revenue", "cancelled", "units"]


def _written_surfaces(feeds: Feeds) -> tuple[DataFrame, DataFrame]:
    """One question of two written tables: the model over the reporting summary, and SQL over the fact."""
    held = refresh.tables_of(feeds, _product(feeds))
    model = measures.Model(
        {"reporting": held["fct_revenue_summary"]},
        {
            "reporting": [
                measures.sum_of("revenue", "revenue_usd"),
                measures.sum_of("cancelled", "cancelled_revenue_usd"),
                measures.sum_of("units", "units"),
            ]
        },
    )
    direct = feeds.spark.sql(
        """SELECT fiscal_quarter_label, customer_segment, y.country, channel_system, department, product_segment,
                  coalesce(sum(amount_usd) FILTER (WHERE NOT is_cancelled), 0) AS revenue,
                  coalesce(sum(amount_usd) FILTER (WHERE is_cancelled), 0) AS cancelled, sum(quantity) AS units
           FROM (SELECT order_date, party_key, product_id, channel_system, is_cancelled,
                        sum(amount_usd) AS amount_usd, sum(quantity) AS quantity
                 FROM {sales} GROUP BY ALL) s
           LEFT JOIN {dates} d ON s.order_date = d.order_date
           LEFT JOIN {products} p ON s.product_id = p.product_id
           LEFT JOIN {parties} y ON s.party_key = y.party_key
           GROUP BY ALL""",
        sales=held["fct_sales"],
        dates=held["dim_date"],
        products=held["dim_product"],
        parties=held["dim_party"],
    )
    return model.summarize("reporting", SURFACE_KEYS), direct


@query
def reconcile_written(feeds: Feeds) -> DataFrame:
    """The written summary against the written fact, by digests of buckets: no rows."""
    model, direct = _written_surfaces(feeds)
    return reconcile.compare_by_digest(model, direct, SURFACE_KEYS, SURFACE_FIELDS)


@query
def reconcile_planted(feeds: Feeds) -> DataFrame:
    """One group of the written summary is off by a dollar and a brand's web sales are lost: each is named."""
    model, direct = _written_surfaces(feeds)
    first = model.agg(F.min(F.struct(*[F.coalesce(k, F.lit("")).alias(k) for k in SURFACE_KEYS])).alias("k")).first()["k"]
    planted = F.lit(True)
    for key in SURFACE_KEYS:
        planted = planted & (F.coalesce(F.col(key), F.lit("")) == F.lit(first[key]))
    spoiled = model.where("product_segment is null or product_segment <> 'Brand#15' or channel_system <> 'WEB'").withColumn(
        "revenue", F.when(planted, F.col("revenue") + 1).otherwise(F.col("revenue")).cast(TOTAL)
    )
    written = tables.materialise(spoiled, staging(feeds, "planted"))
    return reconcile.compare_by_digest(written, direct, SURFACE_KEYS, SURFACE_FIELDS)


@query
def headline_snapshot(feeds: Feeds) -> DataFrame:
    return reconcile.headline(feeds.fct_sales())


@query
def snapshot_diff(feeds: Feeds) -> DataFrame:
    """The headline of both channels against the shops alone."""
    sales = tables.materialise(feeds.fct_sales(), staging(feeds, "fct_sales"))
    shops = sales.where(F.col("channel_system") == gold.POS)
    return reconcile.snapshot_diff(reconcile.headline(sales), reconcile.headline(shops))


@query
def pack_total(feeds: Feeds) -> DataFrame:
    """The pack's total graded against the fact it was summed from."""
    sales = tables.materialise(feeds.fct_sales(), staging(feeds, "fct_sales"))
    summary = gold.fct_revenue_summary(
        sales, gold.dim_date(sales), gold.dim_product(feeds.hierarchy(), sales), feeds.dim_party()
    )
    net = sales.where(~F.col("is_cancelled"))
    return reconcile.grade_total(summary, "revenue_usd", net, "amount_usd")


# --- lineage and profile ----------------------------------------------------------------


def _supply_moves(feeds: Feeds) -> DataFrame:
    """Each order line as a move: it reads its part and supplier, and writes its order."""
    return feeds.table("lineitem").select(
        F.array(
            F.concat(F.lit("part "), F.col("l_partkey").cast("string")),
            F.concat(F.lit("supplier "), F.col("l_suppkey").cast("string")),
        ).alias("reads"),
        F.array(F.concat(F.lit("order "), F.col("l_orderkey").cast("string"))).alias("writes"),
    )


def _place_moves(feeds: Feeds) -> DataFrame:
    """Suppliers land from their nation, nations from their region."""
    suppliers = lineage.moves_from_source(
        feeds.table("supplier").select(
            F.concat(F.lit("nation "), F.col("s_nationkey").cast("string")).alias("source"),
            F.concat(F.lit("supplier "), F.col("s_suppkey").cast("string")).alias("path"),
        ),
        "source",
        "path",
    )
    nations = lineage.moves_from_source(
        feeds.table("nation").select(
            F.concat(F.lit("region "), F.col("n_regionkey").cast("string")).alias("source"),
            F.concat(F.lit("nation "), F.col("n_nationkey").cast("string")).alias("path"),
        ),
        "source",
        "path",
    )
    return suppliers.unionByName(nations)


@query
def lineage_edges(feeds: Feeds) -> DataFrame:
    return lineage.edges_from_moves(_supply_moves(feeds).unionByName(_place_moves(feeds)))


def _order_book(feeds: Feeds) -> DataFrame:
    return feeds.table("orders").select(
        F.concat(F.lit("customer "), F.col("o_custkey").cast("string")).alias("source"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("target"),
    )


@query
def lineage_labelled(feeds: Feeds) -> DataFrame:
    """Orders declared in the book, labelled with the line status that witnessed them."""
    witnessed = feeds.table("lineitem").select(
        F.concat(F.lit("order "), F.col("l_orderkey").cast("string")).alias("target"),
        F.concat(F.lit("line "), F.col("l_linestatus")).alias("producer"),
    )
    lineage.observed_or_fail(witnessed)
    per_order = witnessed.groupBy("target").agg(F.min("producer").alias("producer"))
    observed = _order_book(feeds).join(per_order, "target")
    return lineage.label_edges(_order_book(feeds), observed)


@query
def lineage_orphans(feeds: Feeds) -> DataFrame:
    """Orders the book wrote that no line reads."""
    read = feeds.table("lineitem").select(
        F.concat(F.lit("order "), F.col("l_orderkey").cast("string")).alias("source"),
        F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("target"),
    )
    return lineage.orphans(_order_book(feeds), read)


@query
def upstream_sources(feeds: Feeds) -> DataFrame:
    """Every order traced through its suppliers and their nations to its regions and parts."""
    edges = lineage.edges_from_moves(_supply_moves(feeds).unionByName(_place_moves(feeds)))
    starts = feeds.table("orders").select(
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("node")
    )
    return lineage.trace_to_sources(edges, starts, staging(feeds, "trace"))


@query
def column_profile(feeds: Feeds) -> DataFrame:
    return profile.profile({name: feeds.table(name) for name in TABLES}, distinct=False)


@query
def column_profile_approx(feeds: Feeds) -> DataFrame:
    return profile.profile({name: feeds.table(name) for name in TABLES})


@query
def column_distincts(feeds: Feeds) -> DataFrame:
    """Exact distinct values of master data columns, and whether the sketch is near them."""
    parts = []
    for name in ("region", "nation", "customer", "supplier", "part", "orders"):
        df = feeds.table(name)
        exact = integrity.distinct_counts(df, df.columns)
        sketch = profile.profile_table(df, name).select("column_name", "approx_distinct")
        parts.append(exact.join(sketch, "column_name").select(F.lit(name).alias("table_name"), "*"))
    bound = F.greatest(F.lit(2.0), 0.08 * F.col("distinct_values"))
    near = F.abs(F.col("approx_distinct") - F.col("distinct_values")) <= bound
    return reduce(DataFrame.unionByName, parts).select(
        "table_name", "column_name", "distinct_values", near.alias("sketch_is_near")
    )


# --- landed files -----------------------------------------------------------------------

CUSTOMER_COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
WEB_ORDER_PAGE = page_of(
    ["web_order_id", "email", "placed_at", "status", "currency"],
    {"lines": ["line_no", "product_id", "quantity", "unit_price"]},
)
ORDERS_PER_PAGE = 500


def _customer_text(feeds: Feeds) -> DataFrame:
    """Customers as the vendor exports them: text, money with four decimals."""
    return feeds.table("customer").select(
        F.col("c_custkey").cast("string").alias("c_custkey"),
        "c_name",
        F.col("c_nationkey").cast("string").alias("c_nationkey"),
        F.col("c_acctbal").cast(MONEY).cast("string").alias("c_acctbal"),
        "c_mktsegment",
    )


def _order_text(feeds: Feeds) -> DataFrame:
    return feeds.table("orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.col("o_custkey").cast("string").alias("o_custkey"),
        "o_orderstatus",
        F.col("o_totalprice").cast(MONEY).cast("string").alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
        "o_orderpriority",
    )


def _landed_customers(feeds: Feeds) -> str:
    path = files.feed_path(staging(feeds, "landing"), "pos", "2024-01-31", "customers")
    return files.write_csv_parts(_customer_text(feeds), path)


def _landed_web_orders(feeds: Feeds) -> str:
    path = files.feed_path(staging(feeds, "landing"), "web", "2024-01-31", "orders")
    page = F.floor(F.col("web_order_id").cast("long") / F.lit(ORDERS_PER_PAGE))
    return files.write_json_pages(feeds.web_orders(), path, page, ["web_order_id"])


@query
def csv_parts(feeds: Feeds) -> DataFrame:
    """Customers landed as CSV parts and read back verbatim."""
    return files.read_csv_parts(
        feeds.spark, _landed_customers(feeds), all_strings(CUSTOMER_COLUMNS)
    )


@query
def csv_reordered(feeds: Feeds) -> DataFrame:
    """Customers landed in parts of two column orders and read back by name."""
    path = files.feed_path(staging(feeds, "landing"), "pos", "2024-01-31", "customers")
    text = _customer_text(feeds)
    odd = F.col("c_custkey").cast("long") % 2 == 1
    files.write_csv_parts(text.where(odd), f"{path}/first")
    files.write_csv_parts(text.where(~odd).select(*reversed(text.columns)), f"{path}/second")
    return files.read_csv_parts(feeds.spark, f"{path}/*", all_strings(CUSTOMER_COLUMNS))


@query
def jsonl_parts(feeds: Feeds) -> DataFrame:
    """Orders landed as JSON Lines and read back verbatim."""
    path = files.feed_path(staging(feeds, "landing"), "pos", "2024-01-31", "orders")
    files.write_jsonl(_order_text(feeds), path)
    return files.read_jsonl(feeds.spark, path, all_strings(ORDER_COLUMNS))


@query
def json_pages(feeds: Feeds) -> DataFrame:
    """Nested orders landed as array pages, read back and brought to line grain."""
    pages = files.read_json_pages(feeds.spark, _landed_web_orders(feeds), WEB_ORDER_PAGE)
    return lines.explode_lines(pages.drop(files.CORRUPT))


@query
def null_columns(feeds: Feeds) -> DataFrame:
    """Leaves that parse entirely NULL once the vendor renames one column and one line field."""
    declared = page_of(
        ["web_order_id", "e_mail", "placed_at", "status", "currency"],
        {"lines": ["line_no", "sku", "quantity"]},
    )
    pages = files.read_json_pages(feeds.spark, _landed_web_orders(feeds), declared)
    return integrity.blank_columns(pages.drop(files.CORRUPT))


@query
def leaf_counts(feeds: Feeds) -> DataFrame:
    return integrity.leaf_counts(feeds.web_orders())


@query
def schema_drift(feeds: Feeds) -> DataFrame:
    """Drift of a landed header against a stale declaration, the same in every part."""
    parts = landing.landed_parts(feeds.spark, _landed_customers(feeds))
    drift = landing.header_drift(
        landing.header_names(parts), ["c_custkey", "c_name", "c_nationkey", "c_balance", "c_mktsegment"]
    )
    return drift.select(
        F.concat_ws(",", "appeared").alias("appeared"),
        F.concat_ws(",", "missing").alias("missing"),
        F.concat_ws(",", "duplicated").alias("duplicated"),
        "trailing_delimiter",
    ).distinct()


@query
def landing_integrity(feeds: Feeds) -> DataFrame:
    """Faults of landed parts against the manifest taken when they landed, and rows held."""
    spark = feeds.spark
    csv_path, page_path = _landed_customers(feeds), _landed_web_orders(feeds)
    table_path = tables.write_table(feeds.table("part"), staging(feeds, "landing") + "/reference/2024-01-31/parts")
    reports = []
    for feed, path, rows in (
        ("customers", csv_path, files.read_csv_parts(spark, csv_path, all_strings(CUSTOMER_COLUMNS))),
        ("web orders", page_path, files.read_json_pages(spark, page_path, WEB_ORDER_PAGE)),
        ("parts", table_path, files.read_parquet(spark, table_path)),
    ):
        parts = landing.landed_parts(spark, path)
        names = parts.select("path", "feed", "part", "length")
        manifest_path = staging(feeds, "manifest")
        tables.write_table(
            names.select("path", F.col("length").alias("received_bytes")).join(landing.digests(parts), "path"),
            manifest_path,
        )
        manifest = tables.read_table(spark, manifest_path)
        spans = names.groupBy("feed").agg(F.min("part").alias("first_part"), F.max("part").alias("last_part"))
        checks = {
            "size_faults": landing.size_faults(parts, manifest),
            "digest_faults": landing.digest_faults(parts, manifest),
            "marker_faults": landing.magic_faults(parts),
            "page_faults": landing.page_faults(spark, path) if feed == "web orders" else None,
            "missing_parts": landing.missing_parts(names, spans),
        }
        report = rows.agg(F.count("*").alias("rows")).withColumn("feed", F.lit(feed))
        for name, found in checks.items():
            skipped = found is None or (name == "marker_faults" and feed != "parts")
            value = F.lit(None).cast("long") if skipped else found.agg(F.count("*")).scalar()
            report = report.withColumn(name, value)
        reports.append(report)
    return reports[0].unionByName(reports[1]).unionByName(reports[2])


@query
def landing_faults(feeds: Feeds) -> DataFrame:
    """Each way a delivery can be wrong, planted in the landed customers and named."""
    spark, path = feeds.spark, _landed_customers(feeds)
    parts = landing.landed_parts(spark, path)
    names = parts.select("path", "feed", "part", "length")
    received = names.select("path", F.col("length").alias("received_bytes"))
    manifest = tables.materialise(received.join(landing.digests(parts), "path"), staging(feeds, "manifest"))
    longer = manifest.withColumn("received_bytes", F.col("received_bytes") + 1)
    spoiled = manifest.withColumn("sha256", F.reverse("sha256"))
    unpublished = manifest.withColumn("sha256", F.lit(""))
    shifted = names.groupBy("feed").agg(
        (F.min("part") + 1).alias("first_part"), (F.max("part") + 1).alias("last_part")
    )
    pages = landing.page_faults(spark, path).withColumn("problem", F.lit("incomplete page"))
    found = {
        "bytes received": landing.size_faults(parts, longer),
        "manifest": landing.size_faults(parts, manifest.where(F.lit(False))),
        "digest": landing.digest_faults(parts, spoiled),
        "published digest": landing.digest_faults(parts, unpublished),
        "marker": landing.magic_faults(parts),
        "sequence": landing.missing_parts(names, shifted),
        "page": pages,
    }
    named = [df.select(F.lit(check).alias("check"), "problem").distinct() for check, df in found.items()]
    return reduce(DataFrame.unionByName, named)


# --- tables at rest ---------------------------------------------------------------------


@query
def landed_tables(feeds: Feeds) -> DataFrame:
    """Bronze tables found where they were written, with what they hold."""
    root = staging(feeds, "bronze")
    names = ("customer", "orders", "lineitem", "events", "documents")
    paths = {name: tables.write_table(feeds.table(name), f"{root}/{name}") for name in names}
    return tables.landed_at(feeds.spark, paths)


@query
def run_counts(feeds: Feeds) -> DataFrame:
    """Run counts against counts at rest; the orders table at rest lost what is pending."""
    root = staging(feeds, "bronze")
    names = ("customer", "orders", "lineitem")
    run = tables.landed_at(feeds.spark, {name: f"{feeds.folder}/{name}.parquet" for name in names})
    paths = {
        "customer": tables.write_table(feeds.table("customer"), f"{root}/customer"),
        "orders": tables.write_table(feeds.table("orders").where("o_orderstatus <> 'P'"), f"{root}/orders"),
        "supplier": tables.write_table(feeds.table("supplier"), f"{root}/supplier"),
    }
    return tables.count_mismatches(run, tables.landed_at(feeds.spark, paths))


@query
def observed_writes(feeds: Feeds) -> DataFrame:
    """What each write saw pass, beside what lies at rest afterwards; one table lost rows in between."""
    root = staging(feeds, "bronze")
    found = []
    for name, value in (("orders", "o_totalprice"), ("lineitem", "l_extendedprice"), ("customer", "c_acctbal")):
        path = f"{root}/{name}"
        seen = tables.write_observed(
            feeds.table(name), path, rows=F.count("*"), amount=F.sum(money(value)).cast(TOTAL)
        )
        if name == "customer":
            path = tables.write_table(tables.read_table(feeds.spark, path).where("c_mktsegment <> 'BUILDING'"), f"{root}/lost")
        rest = tables.read_table(feeds.spark, path).agg(
            F.count("*").alias("rest_rows"), F.sum(money(value)).cast(TOTAL).alias("rest_amount")
        )
        found.append(
            rest.select(
                F.lit(name).alias("table_name"),
                F.lit(seen["rows"]).cast("long").alias("run_rows"),
                F.lit(seen["amount"]).cast(TOTAL).alias("run_amount"),
                "rest_rows",
                "rest_amount",
            )
        )
    return reduce(DataFrame.unionByName, found)


@query
def run_metrics(feeds: Feeds) -> DataFrame:
    """The one-row metrics of a bronze run, written and read back."""
    written = tables.write_table(
        tables.run_metrics(
            feeds.table("lineitem"),
            rows=F.count("*"),
            orders=F.count_distinct("l_orderkey"),
            first_shipped=F.min(F.to_date("l_shipdate")),
            last_shipped=F.max(F.to_date("l_shipdate")),
            amount=F.sum(money("l_extendedprice")).cast(TOTAL),
        ),
        staging(feeds, "metrics"),
    )
    tables.read_metrics(feeds.spark, written)
    return tables.read_table(feeds.spark, written)


@query
def published_snapshot(feeds: Feeds) -> DataFrame:
    """The headline published with its contract names, read back as published."""
    written = tables.write_snapshot(
        reconcile.headline(feeds.fct_sales()),
        ["both_selling_systems", "every_country_resolves", "no_revenue_lost"],
        staging(feeds, "snapshot"),
    )
    published = feeds.spark.read.schema(
        "revenue_usd string, cancelled_revenue_usd string, sale_lines string, contracts array<string>"
    ).json(written)
    return published.withColumn("contracts", F.concat_ws(",", "contracts"))


# --- streams ----------------------------------------------------------------------------


def _landed_envelopes(feeds: Feeds) -> str:
    return tables.write_table(feeds.envelopes(), staging(feeds, "topic"))


@query
def stream_gate(feeds: Feeds) -> DataFrame:
    """The count gate against a stream that lost its deletes."""
    held = feeds.envelopes()
    kept = feeds.changes().where(F.col("op") != "D")
    return cdc.count_gate(kept, held.count())


@query
def stream_changes(feeds: Feeds) -> DataFrame:
    """The topic consumed behind its gate into the change log, consumed again, and replayed.

    The second run finds nothing new, so the log holds every event once.
    """
    topic, checkpoint = _landed_envelopes(feeds), staging(feeds, "checkpoints")
    log_path = staging(feeds, "change_log")
    ingest.require_complete(tables.read_table(feeds.spark, topic), feeds.table("events").count())
    for _ in range(2):
        stream = changes.stream_landed(feeds.spark, topic)
        log = ingest.land_changes(stream, CHANGE_IMAGE, log_path, checkpoint)
    ingest.require_complete(log, feeds.table("events").count())
    return cdc.current_state(log, ["erp_customer_id"], "capture_offset")


def _account_topic(feeds: Feeds) -> DataFrame:
    """Account events by their place in a topic of four partitions."""
    return feeds.table("events").select(
        F.lit("accounts").alias("topic"),
        F.pmod("user_id", F.lit(4)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("event_type").alias("kind"),
    )


# The days of the first delivery, those it repeats and those it held back.
FIRST_UNTIL, REPEATED_FROM, HELD_UNTIL = "2024-01-21", "2024-01-11", "2024-01-08"


@query
def stream_exactly_once(feeds: Feeds) -> DataFrame:
    """Two deliveries over a restart: the second repeats ten days and brings some events too late.

    Every event is landed once or quarantined as late, by kind.
    """
    spark, events = feeds.spark, _account_topic(feeds)
    topic, path, checkpoint = (staging(feeds, name) for name in ("topic", "landed", "checkpoints"))
    held_back = (F.col("event_time") < F.lit(HELD_UNTIL)) & (F.pmod("offset", F.lit(10)) == 0)
    early = F.col("event_time") < F.lit(FIRST_UNTIL)
    deliveries = (
        events.where(early & ~held_back),
        events.where(~early | held_back | (F.col("event_time") >= F.lit(REPEATED_FROM))),
    )
    for number, delivered in enumerate(deliveries):
        delivered.write.parquet(f"{topic}/delivery={number}")
        stream = spark.readStream.schema(events.schema).parquet(f"{topic}/delivery=*")
        exactly_once.land_once(stream, "event_time", "5 days", path, checkpoint)
    landed = tables.read_table(spark, path)
    late = exactly_once.late_rows(spark.read.schema(events.schema).parquet(f"{topic}/delivery=*"), landed)
    both = landed.select("kind", F.lit("landed").alias("status")).unionByName(
        late.select("kind", F.lit("late").alias("status"))
    )
    return both.groupBy("kind", "status").agg(F.count("*").alias("events"))


@query
def stream_upsert(feeds: Feeds) -> DataFrame:
    """Redelivered order lines streamed in several batches into an exactly-once table."""
    landed = tables.write_table(feeds.line_events(), staging(feeds, "line_events"))
    stream = (
        feeds.spark.readStream.schema(feeds.line_events().schema)
        .option("maxBytesPerTrigger", 64 * 1024 * 1024)
        .parquet(landed)
    )
    return upsert.upsert(
        stream,
        ["l_orderkey", "l_linenumber"],
        "l_shipdate",
        staging(feeds, "latest_lines"),
        staging(feeds, "checkpoints"),
    )


@query
def marker_refresh(feeds: Feeds) -> DataFrame:
    """Orders delivered per priority; each completed delivery is refreshed once."""
    root, out = staging(feeds, "landing"), staging(feeds, "refreshed")
    # The whole priority names its folder, by a digest that is fit for one.
    by_priority = feeds.table("orders").withColumn("priority", F.md5("o_orderpriority"))
    by_priority.write.partitionBy("priority").parquet(root)
    for row in feeds.spark.read.parquet(root).select("priority").distinct().collect():
        files.mark_complete(feeds.spark, f"{root}/priority={row['priority']}")

    def refresh(spark: SparkSession, folder: str, batch_id: int) -> None:
        delivered = spark.read.schema(feeds.table("orders").schema).option("pathGlobFilter", "part-*").parquet(folder)
        delivered.groupBy("o_orderpriority").agg(
            F.count("*").alias("orders"), F.sum(money("o_totalprice")).cast(TOTAL).alias("total")
        ).write.mode("overwrite").parquet(f"{out}/delivery={markers.delivery_id(folder, batch_id)}")

    markers.on_delivery(feeds.spark, root, refresh, staging(feeds, "checkpoints"))
    return feeds.spark.read.parquet(out).drop("delivery")
