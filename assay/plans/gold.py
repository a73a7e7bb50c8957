"""The gold star: conformed dimensions, facts in USD and the reporting summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.functions.calendar import (
    fiscal_quarter,
    fiscal_quarter_label,
    fiscal_year,
    fiscal_year_label,
)
from assay.types import MONEY, TOTAL

POS, WEB = "POS", "WEB"
UNALLOCATED = "Unallocated"

SALES_COLUMNS = (
    "channel_system",
    "order_id",
    "line_no",
    "order_date",
    "party_key",
    "product_id",
    "currency",
    "quantity",
    "amount",
    "amount_usd",
    "is_cancelled",
    "rate_is_carried",
)


def dim_customer(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id", "name", "country")


def dim_party(parties: DataFrame) -> DataFrame:
    """One row per person with the attributes their accounts supply, the shop's first."""
    return parties.select(
        "party_key",
        "email",
        "in_pos",
        "in_web",
        F.coalesce("pos_segment", F.lit(UNALLOCATED)).alias("customer_segment"),
        F.coalesce("pos_country", "web_country").alias("country"),
    )


def dim_country(parties: DataFrame, names: DataFrame) -> DataFrame:
    """One row per country any party has, with its name; unnamed ones stay."""
    return (
        parties.where(F.col("country").isNotNull())
        .select("country")
        .distinct()
        .join(names.select("country", "country_name"), "country", "left")
    )


def in_usd(lines: DataFrame, fx: DataFrame) -> DataFrame:
    """Lines converted at their own day's rate, flagged where that rate was carried.

    ``fx`` is dense, so an equi-join on (currency, day) finds the latest published rate
    without a range join. A line no rate covers keeps NULLs.
    """
    rates = fx.select(
        "currency",
        F.col("rate_date").alias("order_date"),
        "rate",
        F.col("is_carried").alias("rate_is_carried"),
    )
    return lines.join(rates, ["currency", "order_date"], "left").withColumn(
        "amount_usd", (F.col("amount") * F.col("rate")).cast(MONEY)
    )


def fct_orders(orders: DataFrame, fx: DataFrame) -> DataFrame:
    """Order lines in USD. Each carries its customer's party, resolved on the order header."""
    return in_usd(orders, fx).select(
        "order_id",
        "line_no",
        "customer_id",
        "party_key",
        "product_id",
        "order_date",
        "currency",
        "quantity",
        "amount",
        "amount_usd",
        "is_cancelled",
        "rate_is_carried",
    )


def fct_sales(orders: DataFrame, web_lines: DataFrame, account_party: DataFrame, fx: DataFrame) -> DataFrame:
    """Both selling systems at line grain, in USD, keyed by the resolved party.

    ``orders`` are already converted and know their party; ``account_party`` maps each
    storefront account to its own.
    """
    parties = account_party.select(F.col("member_id").alias("account_id"), "party_key")
    pos = orders.withColumn("channel_system", F.lit(POS)).select(*SALES_COLUMNS)
    web = (
        in_usd(web_lines, fx)
        .join(parties, "account_id", "left")
        .withColumn("channel_system", F.lit(WEB))
        .select(*SALES_COLUMNS)
    )
    return pos.unionByName(web)


def dim_product(hierarchy: DataFrame, sales: DataFrame) -> DataFrame:
    """The hierarchy, plus an unallocated member for every product sold outside it."""
    sold = sales.where(F.col("product_id").isNotNull()).select("product_id").distinct()
    outside = sold.join(hierarchy, "product_id", "left_anti").select(
        "product_id",
        F.lit(UNALLOCATED).alias("product_segment"),
        F.lit(UNALLOCATED).alias("department"),
    )
    return hierarchy.select("product_id", "product_segment", "department").unionByName(outside)


def dim_date(sales: DataFrame) -> DataFrame:
    """The fact's own dates with their place in the fiscal calendar."""
    day = F.col("order_date")
    return (
        sales.where(day.isNotNull())
        .select("order_date")
        .distinct()
        .select(
            "order_date",
            F.year(day).alias("calendar_year"),
            fiscal_year(day).alias("fiscal_year"),
            fiscal_quarter(day).alias("fiscal_quarter"),
            fiscal_year_label(day).alias("fiscal_year_label"),
            fiscal_quarter_label(day).alias("fiscal_quarter_label"),
        )
    )


def fct_daily_revenue(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders, units and revenue in USD by day and country.

    Orders are counted at order grain: lines are first summed per order and day, where
    they lie, and orders per customer before the customers are looked up, so a customer
    who bought a third of everything is one row per day there. Orders come in several
    currencies, so only converted amounts add up.
    """
    per_order = orders.groupBy("order_date", "customer_id", "order_id").agg(
        F.sum("quantity").alias("units"), F.sum("amount_usd").cast(TOTAL).alias("revenue")
    )
    per_customer = per_order.groupBy("order_date", "customer_id").agg(
        F.count("*").alias("orders"),
        F.sum("units").alias("units"),
        F.sum("revenue").cast(TOTAL).alias("revenue"),
    )
    return (
        per_customer.join(customers.select("customer_id", "country"), "customer_id", "left")
        .groupBy("order_date", "country")
        .agg(
            F.sum("orders").alias("orders"),
            F.sum("units").alias("units"),
            F.sum("revenue").cast(TOTAL).alias("revenue"),
        )
    )


def sale_totals(amount: str = "amount_usd") -> list[F.Column]:
    """Net, cancelled and carried-rate revenue beside lines and units.

    Cancelled lines count as lines and units but never as revenue.
    """
    money = F.col(amount)
    kept = ~F.col("is_cancelled")
    return [
        F.count("*").alias("sale_lines"),
        F.sum("quantity").alias("units"),
        F.coalesce(F.sum(F.when(kept, money)), F.lit(0)).cast(TOTAL).alias("revenue_usd"),
        F.coalesce(F.sum(F.when(~kept, money)), F.lit(0)).cast(TOTAL).alias("cancelled_revenue_usd"),
        F.coalesce(F.sum(F.when(kept & F.col("rate_is_carried"), money)), F.lit(0))
        .cast(TOTAL)
        .alias("revenue_at_carried_rate"),
    ]


SUMMARY_TOTALS = (
    "sale_lines",
    "units",
    "revenue_usd",
    "cancelled_revenue_usd",
    "revenue_at_carried_rate",
)


def fct_revenue_summary(
    sales: DataFrame, dates: DataFrame, products: DataFrame, parties: DataFrame
) -> DataFrame:
    """Sales by fiscal period, product rollup, customer segment, country and channel.

    Sales are summed to one row per product inside each group before products are
    looked up, so the fact itself shuffles once, for its parties.
    """
    periods = dates.select("order_date", "fiscal_year_label", "fiscal_quarter_label")
    people = parties.select("party_key", "customer_segment", "country")
    axes = ["fiscal_year_label", "fiscal_quarter_label", "customer_segment", "country", "channel_system"]
    per_product = (
        sales.join(periods, "order_date", "left")
        .join(people, "party_key", "left")
        .groupBy(*axes, "product_id")
        .agg(*sale_totals())
    )
    again = [F.sum(name).cast(per_product.schema[name].dataType).alias(name) for name in SUMMARY_TOTALS]
    return (
        per_product.join(products, "product_id", "left")
        .groupBy(*axes, "department", "product_segment")
        .agg(*again)
    )
