"""The whole product: its tables, what each reads and how each is built.

The graph is data. A full build writes every table once, in the order given, each read back by the
ones after it, so no table is computed twice and a lost executor re-reads files instead of
replaying the layers below. ``assay.plans.refresh`` follows the same graph to rebuild only what a
delivery reaches.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from assay.functions.calendar import fiscal_quarter_label
from assay.operators import identity
from assay.operators.quarantine import REASONS
from assay.plans import gold
from assay.plans.feeds import Feeds
from assay.sources.tables import materialise

# The tables of the product by layer.
SILVER = (
    "silver_customers",
    "silver_orders",
    "silver_quarantine_orders",
    "silver_web_customers",
    "silver_web_order_lines",
    "silver_party",
    "silver_fx_daily",
    "silver_product_hierarchy",
)
GOLD = (
    "dim_customer",
    "dim_party",
    "dim_country",
    "fct_orders",
    "fct_sales",
    "dim_product",
    "dim_date",
    "fct_daily_revenue",
    "fct_revenue_summary",
)

Reader = Callable[[str], DataFrame]


@dataclass(frozen=True)
class Step:
    """A table, what it reads, and its plan over the feeds and a reader of the tables before it.

    ``by`` is a column whose values the table is kept by, and ``part`` maps a day to such a value:
    when days change, only their parts are built again. ``day`` is the table's own day column.
    """

    name: str
    reads: tuple[str, ...]
    build: Callable[[Feeds, Reader], DataFrame]
    day: str | None = None
    by: str | None = None
    part: Callable[[Column], Column] = lambda day: day


def _quarantine(feeds: Feeds, of: Reader) -> DataFrame:
    return feeds.judged_lines(of("latest_lines")).quarantined.withColumnRenamed(REASONS, "quarantine_reasons")


def _sales(feeds: Feeds, of: Reader) -> DataFrame:
    members = identity.members(of("silver_web_customers"), "account_id", "email")
    return gold.fct_sales(
        of("fct_orders"), of("silver_web_order_lines"), identity.party_of(members, gold.WEB), of("silver_fx_daily")
    )


STEPS = (
    Step("silver_customers", ("bronze_customers", "bronze_countries"), lambda feeds, of: feeds.customers()),
    Step("latest_lines", ("bronze_orders",), lambda feeds, of: feeds.latest_lines()),
    Step(
        "silver_orders",
        ("latest_lines", "bronze_order_headers", "bronze_buyers"),
        lambda feeds, of: feeds.pos_orders(feeds.judged_lines(of("latest_lines")).clean),
        day="order_date",
    ),
    Step("silver_quarantine_orders", ("latest_lines",), _quarantine),
    Step("silver_web_customers", ("bronze_web_customers",), lambda feeds, of: feeds.accounts()),
    Step(
        "silver_web_order_lines", ("bronze_web_orders",), lambda feeds, of: feeds.web_lines(), day="order_date"
    ),
    Step(
        "silver_party",
        ("silver_customers", "silver_web_customers"),
        lambda feeds, of: feeds.described_parties(of("silver_customers"), of("silver_web_customers")),
    ),
    Step("silver_fx_daily", ("bronze_fx_rates",), lambda feeds, of: feeds.fx_daily(), day="rate_date"),
    Step("silver_product_hierarchy", ("bronze_product_hierarchy",), lambda feeds, of: feeds.hierarchy()),
    Step("dim_customer", ("silver_customers",), lambda feeds, of: gold.dim_customer(of("silver_customers"))),
    Step("dim_party", ("silver_party",), lambda feeds, of: gold.dim_party(of("silver_party"))),
    Step(
        "dim_country",
        ("dim_party", "bronze_countries"),
        lambda feeds, of: gold.dim_country(of("dim_party"), feeds.country_names()),
    ),
    Step(
        "fct_orders",
        ("silver_orders", "silver_fx_daily"),
        lambda feeds, of: gold.fct_orders(of("silver_orders"), of("silver_fx_daily")),
        day="order_date",
        by="order_date",
    ),
    Step(
        "fct_sales",
        ("fct_orders", "silver_web_order_lines", "silver_web_customers", "silver_fx_daily"),
        _sales,
        day="order_date",
        by="order_date",
    ),
    Step(
        "dim_product",
        ("silver_product_hierarchy", "fct_sales"),
        lambda feeds, of: gold.dim_product(of("silver_product_hierarchy"), of("fct_sales")),
    ),
    Step("dim_date", ("fct_sales",), lambda feeds, of: gold.dim_date(of("fct_sales"))),
    Step(
        "fct_daily_revenue",
        ("dim_customer", "fct_orders"),
        lambda feeds, of: gold.fct_daily_revenue(of("fct_orders"), of("dim_customer")),
        day="order_date",
        by="order_date",
    ),
    Step(
        "fct_revenue_summary",
        ("fct_sales", "dim_date", "dim_product", "dim_party"),
        lambda feeds, of: gold.fct_revenue_summary(of("fct_sales"), of("dim_date"), of("dim_product"), of("dim_party")),
        by="fiscal_quarter_label",
        part=lambda day: F.when(day.isNotNull(), fiscal_quarter_label(day)),
    ),
)


def edges() -> list[tuple[str, str]]:
    """(source, target) of every declared read."""
    return [(read, step.name) for step in STEPS for read in step.reads]


def below(changed: set[str]) -> list[Step]:
    """The steps that read what changed, directly or through others, in the order they are built."""
    reached, found = set(changed), []
    for step in STEPS:
        if reached.intersection(step.reads):
            reached.add(step.name)
            found.append(step)
    return found


def build(feeds: Feeds, root: str) -> dict[str, DataFrame]:
    """Write all tables under ``root`` and return them by name."""
    built: dict[str, DataFrame] = {}
    for step in STEPS:
        built[step.name] = materialise(step.build(feeds, built.__getitem__), f"{root}/{step.name}")
    return {name: built[name] for name in (*SILVER, *GOLD)}
