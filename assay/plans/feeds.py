"""Vendor feeds derived from the given tables.

The star needs two selling systems, an exchange-rate feed, a product hierarchy and a
change stream. Each is a deterministic projection over a whole given table, with the
defects those feeds have in life: redelivered lines, mixed-case and missing emails,
local timestamps, rates on trading days only, products outside the hierarchy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql import functions as F

from assay.functions.calendar import is_weekday, utc_date
from assay.operators import dedupe, identity, lines, quarantine
from assay.operators.conform import conform_hierarchy, conform_lookup
from assay.operators.densify import densify_daily
from assay.plans import gold
from assay.sources.files import read_parquet
from assay.types import RATE, money

# The names the tables go by.
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# What the events' types stand for as currencies, and UTC offsets in use.
CURRENCIES = ("click", "error", "purchase", "signup", "view")
OFFSETS = (("+00:00", 0), ("+05:30", 330), ("-08:00", -480), ("+09:00", 540))

CLASSIFIED_UP_TO = 40
FIRST_SALE_DAY = "2024-01-01"
SALE_DAYS = 30
CANCELLED_FROM = 90

CHANGE_IMAGE = T.StructType(
    [
        T.StructField("erp_customer_id", T.LongType()),
        T.StructField("account_status", T.StringType()),
        T.StructField("credit_band", T.StringType()),
        T.StructField("effective_date", T.DateType()),
    ]
)


class Feeds:
    """The feeds over one directory of given tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A given table; its files are listed once, however many plans read it."""
        if name not in self._tables:
            self._tables[name] = read_parquet(self.spark, f"{self.folder}/{name}.parquet")
        return self._tables[name]

    # --- countries and customers ------------------------------------------------

    def country_names(self) -> DataFrame:
        return self.table("nation").select(
            F.format_string("N%02d", "n_nationkey").alias("country"), F.col("n_name").alias("country_name")
        )

    def addressed_customers(self) -> DataFrame:
        """POS customers with their email as the shops typed it, some of them without."""
        email = F.concat(F.lit("Customer"), F.col("c_custkey").cast("string"), F.lit("@Example.com"))
        return self.table("customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("name"),
            F.col("c_nationkey").alias("nation_key"),
            F.col("c_mktsegment").alias("segment"),
            F.when(F.col("c_acctbal") < 0, F.lit(None))
            .when(F.col("c_mktsegment") == "BUILDING", email)
            .otherwise(F.lower(email))
            .alias("email"),
        )

    def typed_customers(self) -> DataFrame:
        """The same customers with their country as typed."""
        segment = F.col("segment")
        nations = self.table("nation").select(F.col("n_nationkey").alias("nation_key"), "n_name")
        return (
            self.addressed_customers()
            .join(nations, "nation_key", "left")
            .withColumn(
                "typed_country",
                F.when(segment == "BUILDING", F.lower("n_name"))
                .when(segment == "MACHINERY", F.concat(F.lit("  "), "n_name", F.lit(" ")))
                .when(segment == "FURNITURE", F.concat(F.lit("The "), "n_name"))
                .otherwise(F.col("n_name")),
            )
            .drop("n_name")
        )

    def customers(self) -> DataFrame:
        return conform_lookup(
            self.typed_customers(), "typed_country", self.country_names(), "country_name", "country", "country"
        )

    def accounts(self) -> DataFrame:
        """Storefront accounts: everyone who left an event, and the suppliers."""
        users = (
            self.table("events")
            .select("user_id")
            .distinct()
            .select(
                F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("account_id"),
                F.concat(F.lit("customer"), F.col("user_id").cast("string"), F.lit("@example.com")).alias("email"),
                F.lit(None).cast("string").alias("country"),
            )
        )
        suppliers = self.table("supplier").select(
            F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("account_id"),
            F.when(F.col("s_acctbal") >= 0, F.concat(F.lit("supplier"), F.col("s_suppkey").cast("string"), F.lit("@example.com"))).alias("email"),
            F.format_string("N%02d", "s_nationkey").alias("country"),
        )
        return users.unionByName(suppliers)

    def pos_members(self) -> DataFrame:
        return identity.members(self.addressed_customers(), "customer_id", "email")

    def web_members(self) -> DataFrame:
        return identity.members(self.accounts(), "account_id", "email")

    def parties(self) -> DataFrame:
        return identity.resolve_parties(self.pos_members(), self.web_members())

    def described_parties(self, customers: DataFrame, accounts: DataFrame) -> DataFrame:
        """Parties carrying what the dimension shows of them."""
        return identity.resolve_parties(
            identity.members(customers, "customer_id", "email", keep=["segment", "country"]),
            identity.members(accounts, "account_id", "email", keep=["country"]),
        )

    def dim_party(self) -> DataFrame:
        return gold.dim_party(self.described_parties(self.customers(), self.accounts()))

    # --- reference feeds --------------------------------------------------------

    def fx_rates(self) -> DataFrame:
        """Published on trading days only: one rate per currency and weekday."""
        day = F.to_date("ts")
        return (
            self.table("events")
            .where(is_weekday(day))
            .groupBy(F.col("event_type").alias("currency"), day.alias("rate_date"))
            .agg(F.max("value").cast(RATE).alias("rate"))
        )

    def fx_daily(self) -> DataFrame:
        return densify_daily(self.fx_rates(), "currency", "rate_date", "rate")

    def hierarchy(self) -> DataFrame:
        """Products the data office has classified; the largest sizes are still open."""
        classified = self.table("part").where(F.col("p_size") <= CLASSIFIED_UP_TO)
        return conform_hierarchy(classified, "p_partkey", "p_brand", "p_type")

    # --- POS orders -------------------------------------------------------------

    def line_events(self) -> DataFrame:
        """Order lines as delivered: at least once, ranked by the shipping date."""
        return self.table("lineitem")

    def latest_lines(self) -> DataFrame:
        return dedupe.latest_by_sequence(self.line_events(), ["l_orderkey", "l_linenumber"], "l_shipdate")

    def judged_lines(self, latest: DataFrame | None = None) -> quarantine.Split:
        return quarantine.split(
            latest if latest is not None else self.latest_lines(),
            {
                "small quantity": F.col("l_quantity") >= 5,
                "discount too high": F.col("l_discount") <= 0.08,
            },
        )

    def pos_orders(self, usable: DataFrame | None = None) -> DataFrame:
        """Usable order lines with customer, party, currency and a date inside the rates' span.

        What belongs to the customer joins the order headers, which are fewer than their
        lines, so lines shuffle only to meet their header.
        """
        offset = F.pmod(F.datediff(F.col("o_orderdate").cast("date"), F.lit("1995-01-01").cast("date")), F.lit(SALE_DAYS))
        currency = F.array(*[F.lit(c) for c in CURRENCIES])
        member = identity.members(self.addressed_customers(), "customer_id", "email", keep=["nation_key"])
        owners = member.select(
            F.col("member_id").alias("customer_id"),
            identity.party_key(gold.POS, F.col("member_id"), F.col("email")).alias("party_key"),
            F.get(currency, F.pmod("nation_key", F.lit(len(CURRENCIES)))).alias("currency"),
        )
        orders = self.table("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.date_add(F.lit(FIRST_SALE_DAY).cast("date"), offset).alias("order_date"),
            (F.col("o_orderstatus") == "P").alias("is_cancelled"),
        )
        sold = (usable if usable is not None else self.judged_lines().clean).select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line_no"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("long").alias("quantity"),
            money("l_extendedprice").alias("amount"),
        )
        return sold.join(orders.join(owners, "customer_id", "left"), "order_id", "left")

    # --- storefront orders ------------------------------------------------------

    def events_with_k(self) -> DataFrame:
        """Events with the number their properties carry."""
        return self.table("events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))

    def web_orders(self) -> DataFrame:
        """Purchases as the storefront's pages carry them: nested, every leaf a string."""
        k = F.col("k")
        zone = F.pmod(k, F.lit(len(OFFSETS)))
        labels = F.array(*[F.lit(label) for label, _ in OFFSETS])
        minutes = F.array(*[F.lit(m) for _, m in OFFSETS])
        local = F.col("ts") + F.make_dt_interval(mins=F.get(minutes, zone))
        placed_at = F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), F.get(labels, zone))
        lines_of = F.transform(
            F.sequence(F.lit(1), 1 + F.pmod(k, F.lit(3))),
            lambda n: F.struct(
                n.cast("string").alias("line_no"),
                (F.col("user_id") + n - 1).cast("string").alias("product_id"),
                (1 + F.pmod(k + n, F.lit(4))).cast("string").alias("quantity"),
                money("value").cast("string").alias("unit_price"),
            ),
        )
        currency = F.array(*[F.lit(c) for c in CURRENCIES])
        return (
            self.events_with_k()
            .where(F.col("event_type") == "purchase")
            .select(
                F.col("event_id").cast("string").alias("web_order_id"),
                F.concat(F.lit("customer"), F.col("user_id").cast("string"), F.lit("@example.com")).alias("email"),
                placed_at.alias("placed_at"),
                F.when(k >= CANCELLED_FROM, "cancelled").otherwise("paid").alias("status"),
                F.get(currency, F.pmod(k, F.lit(len(CURRENCIES)))).alias("currency"),
                F.when(k > 0, lines_of).alias("lines"),
            )
        )

    def web_lines(self) -> DataFrame:
        """Storefront lines typed and dated: one row per nested line."""
        quantity = F.col("quantity").try_cast("long")
        exploded = lines.explode_lines(self.web_orders())
        return exploded.where(F.col("line_position").isNotNull()).select(
            F.col("web_order_id").try_cast("long").alias("order_id"),
            F.col("line_no").try_cast("int").alias("line_no"),
            F.regexp_replace("email", "^customer([0-9]+)@.*$", "U$1").alias("account_id"),
            F.col("product_id").try_cast("long").alias("product_id"),
            utc_date(F.col("placed_at")).alias("order_date"),
            "currency",
            quantity.alias("quantity"),
            (money("unit_price") * quantity).cast("decimal(19,4)").alias("amount"),
            (F.col("status") == "cancelled").alias("is_cancelled"),
        )

    # --- the star ---------------------------------------------------------------

    def fct_orders(self) -> DataFrame:
        return gold.fct_orders(self.pos_orders(), self.fx_daily())

    def fct_sales(self) -> DataFrame:
        return gold.fct_sales(
            self.fct_orders(),
            self.web_lines(),
            identity.party_of(self.web_members(), gold.WEB),
            self.fx_daily(),
        )

    # --- the change stream ------------------------------------------------------

    def changes(self) -> DataFrame:
        """Account changes: capture order is the event's, business dates run behind it."""
        k = F.col("k")
        return self.events_with_k().select(
            F.when(F.col("event_type") == "signup", "I")
            .when(F.col("event_type") == "error", "D")
            .otherwise("U")
            .alias("op"),
            F.col("event_id").alias("capture_offset"),
            F.col("user_id").alias("erp_customer_id"),
            F.col("event_type").alias("account_status"),
            F.concat(F.lit("band "), F.pmod(k, F.lit(5)).cast("string")).alias("credit_band"),
            F.date_sub(F.to_date("ts"), F.pmod(k, F.lit(7))).alias("effective_date"),
        )

    def envelopes(self) -> DataFrame:
        """The same changes as the capture tool's envelopes."""
        image = F.struct(*CHANGE_IMAGE.names)
        nothing = F.lit(None).cast(CHANGE_IMAGE)
        deleted = F.col("op") == "D"
        return self.changes().select(
            "capture_offset",
            F.to_json(
                F.struct(
                    F.when(F.col("op") == "I", "c").when(deleted, "d").otherwise("u").alias("op"),
                    F.when(deleted, image).otherwise(nothing).alias("before"),
                    F.when(deleted, nothing).otherwise(image).alias("after"),
                )
            ).alias("value"),
        )
