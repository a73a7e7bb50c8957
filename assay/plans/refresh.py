"""Refresh of the product by what was delivered.

A delivery names the feeds it renewed. Only tables below them in the declared graph are built
again, in order, and a table kept by day is built for the affected days alone: the days on which
a rebuilt input differs from what it was. A rebuilt table that turns out equal is not replaced, so
nothing below is rebuilt for its sake. All new tables are published together, after the contracts
hold on them; a refresh that breaks one leaves the current version as it was.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.operators import lineage, quality
from assay.operators.reconcile import content_digest
from assay.plans import medallion
from assay.plans.feeds import Feeds
from assay.sources import versions

# What every published table must satisfy, by column.
PRODUCT_CONTRACT: dict[str, dict[str, list]] = {
    "silver_customers": {"customer_id": ["unique", "not_null"]},
    "silver_orders": {
        "order_id": ["not_null"],
        "customer_id": ["not_null", {"relationships": {"to": "silver_customers", "field": "customer_id"}}],
        "order_date": ["not_null"],
        "amount": ["not_null"],
    },
    "silver_quarantine_orders": {"quarantine_reasons": ["not_null"]},
    "silver_web_customers": {"account_id": ["unique", "not_null"]},
    "silver_web_order_lines": {
        "order_id": ["not_null"],
        "account_id": [{"relationships": {"to": "silver_web_customers", "field": "account_id"}}],
    },
    "silver_party": {"party_key": ["unique", "not_null"]},
    "silver_fx_daily": {"currency": ["not_null"], "rate": ["not_null"], "is_carried": ["not_null"]},
    "silver_product_hierarchy": {"product_id": ["unique", "not_null"]},
    "dim_customer": {"customer_id": ["unique", "not_null"]},
    "dim_party": {"party_key": ["unique", "not_null"], "customer_segment": ["not_null"]},
    "dim_country": {"country": ["unique", "not_null"], "country_name": ["not_null"]},
    "fct_orders": {
        "customer_id": [{"relationships": {"to": "dim_customer", "field": "customer_id"}}],
        "party_key": [{"relationships": {"to": "dim_party", "field": "party_key"}}],
    },
    "fct_sales": {
        "channel_system": ["not_null", {"accepted_values": {"values": ["POS", "WEB"]}}],
        "party_key": ["not_null", {"relationships": {"to": "dim_party", "field": "party_key"}}],
        "product_id": [{"relationships": {"to": "dim_product", "field": "product_id"}}],
        "order_date": [{"relationships": {"to": "dim_date", "field": "order_date"}}],
    },
    "dim_product": {"product_id": ["unique", "not_null"], "department": ["not_null"]},
    "dim_date": {"order_date": ["unique", "not_null"], "fiscal_quarter_label": ["not_null"]},
    "fct_daily_revenue": {"order_date": ["not_null"]},
    "fct_revenue_summary": {"channel_system": ["not_null"], "revenue_usd": ["not_null"]},
}


class ContractBroken(Exception):
    """The tables of a refresh do not satisfy a contract; they were not published."""


@dataclass
class Change:
    """How a refresh left a table: ``parts`` are those written anew, None where all of it was."""

    table: str
    action: str
    parts: list[str] | None = field(default=None)


WHOLE, BY_PARTS, EQUAL = "rewritten", "by parts", "equal"


def product_rules(tables: dict[str, DataFrame]) -> list[quality.Rule]:
    rules = quality.rules_from(PRODUCT_CONTRACT, tables)
    rules.append(
        quality.row_rule("silver_orders", "quantity", "quantity_is_positive", F.col("quantity") > 0)
    )
    rules.append(quality.row_rule("silver_fx_daily", "rate", "rate_is_positive", F.col("rate") > 0))
    return rules


def require_contracts(tables: dict[str, DataFrame], only: set[str]) -> None:
    """Fail unless every rule of the tables in ``only`` counts no violation."""
    rules = [rule for rule in product_rules(tables) if rule.table in only or rule.target in only]
    if rules:
        broken = quality.evaluate(tables, rules).where("violations <> 0").collect()
        if broken:
            named = ", ".join(sorted(f"{row['table_name']}.{row['rule']}: {row['violations']}" for row in broken))
            raise ContractBroken(named)


def tables_of(feeds: Feeds, manifest: dict) -> dict[str, DataFrame]:
    return {name: versions.read(feeds.spark, manifest, name) for name in manifest["tables"]}


def changed_days(before: DataFrame, after: DataFrame, day: str) -> list:
    """Days on which the two tables do not hold the same rows; a calendar bounds their number.

    Each side is digested by day where it lies, so only days and digests are shuffled.
    """
    same = F.col("left_day").eqNullSafe(F.col("right_day"))
    left = content_digest(before, [day]).select(F.col(day).alias("left_day"), F.col("digest").alias("left"))
    right = content_digest(after, [day]).select(F.col(day).alias("right_day"), F.col("digest").alias("right"))
    differs = left.join(right, same, "full_outer").where(~F.col("left").eqNullSafe(F.col("right")))
    return [row[0] for row in differs.select(F.coalesce("left_day", "right_day")).distinct().collect()]


def is_equal(before: DataFrame, after: DataFrame) -> bool:
    return content_digest(before, []).collect() == content_digest(after, []).collect()


def refresh(feeds: Feeds, root: str, delivered: set[str]) -> tuple[dict, list[Change]]:
    """Rebuild what lies below the ``delivered`` feeds and publish it as the next version.

    Returns the manifest and what became of each table reached. Without a version to start
    from, everything is built.
    """
    spark = feeds.spark
    held = versions.current(spark, root)
    entries, changes = dict(held["tables"]), []
    version = held["version"] + 1
    # What each table's last build read, by its plan.
    moves = dict(held.get("moves", {}))
    folder = f"{root}/data/{version:08d}-{uuid.uuid4().hex}"
    steps = medallion.below(delivered) if entries else list(medallion.STEPS)
    # What is known of each changed input: the days that differ, or None for any.
    days_of: dict[str, list | None] = {name: None for name in delivered}

    def of(name: str) -> DataFrame:
        return versions.read(spark, {"tables": entries}, name)

    def observed(step: medallion.Step, rows: DataFrame) -> DataFrame:
        moves[step.name] = {"version": version, "reads": lineage.plan_sources(rows)}
        return rows

    for step in steps:
        moved = [days_of[read] for read in step.reads if read in days_of]
        if entries and step.name in entries and not moved:
            continue  # all that could have reached it turned out equal
        days = None
        if moved and step.by and step.name in entries and all(m is not None for m in moved):
            days = list({day for m in moved for day in m})
        if days is not None:
            spans = {s.name: s.day for s in medallion.STEPS if s.day}
            parts = _parts(feeds, step, days)

            def of_parts(name: str, spans=spans, parts=parts, step=step) -> DataFrame:
                rows = of(name)
                if name not in spans:
                    return rows
                return rows.where(versions.in_parts(step.part(F.col(spans[name])), parts))

            rows = observed(step, step.build(feeds, of_parts))
            entries[step.name] = versions.write_parts(rows, f"{folder}/{step.name}", entries[step.name], parts)
            changes.append(Change(step.name, BY_PARTS, parts))
            days_of[step.name] = days if step.day else None
            continue
        made = versions.write_whole(observed(step, step.build(feeds, of)), f"{folder}/{step.name}", step.by)
        if step.name in entries:
            new = versions.read(spark, {"tables": {step.name: made}}, step.name)
            if is_equal(of(step.name), new):
                changes.append(Change(step.name, EQUAL))
                continue
            days_of[step.name] = changed_days(of(step.name), new, step.day) if step.day else None
        else:
            days_of[step.name] = None
        entries[step.name] = made
        changes.append(Change(step.name, WHOLE))
    manifest = {"version": version, "tables": entries, "moves": moves}
    rewritten = {change.table for change in changes if change.action != EQUAL}
    require_contracts(tables_of(feeds, manifest), rewritten)
    return versions.publish(spark, root, manifest), changes


def _parts(feeds: Feeds, step: medallion.Step, days: list) -> list[str]:
    """Names of the parts the days fall in."""
    listed = feeds.spark.createDataFrame([(day,) for day in days], "day date")
    return sorted(row[0] for row in listed.select(versions.part_name(step.part(F.col("day")))).distinct().collect())


# The given tables that stand for each vendor feed.
FEED_TABLES = {
    "bronze_customers": ("customer", "nation"),
    "bronze_buyers": ("customer",),
    "bronze_countries": ("nation",),
    "bronze_orders": ("lineitem",),
    "bronze_order_headers": ("orders",),
    "bronze_web_customers": ("events", "supplier"),
    "bronze_web_orders": ("events",),
    "bronze_fx_rates": ("events",),
    "bronze_product_hierarchy": ("part",),
}


def declared_edges(spark) -> DataFrame:
    """(source, target) of the graph as declared, vendor feeds by the tables that stand for them."""
    pairs = {(name, target) for source, target in medallion.edges() for name in FEED_TABLES.get(source, (source,))}
    return spark.createDataFrame(sorted(pairs), "source string, target string")


def observed_edges(spark, manifest: dict, since: int = 1) -> DataFrame:
    """(source, target, producer) of what the plans of runs since a version read to build each table."""
    rows = [
        (source, table, f"version {move['version']}")
        for table, move in manifest["moves"].items()
        if move["version"] >= since
        for source in move["reads"]
    ]
    return spark.createDataFrame(rows, "source string, target string, producer string")


def branch(feeds: Feeds, root: str, manifest: dict) -> dict:
    """A product of its own that starts from the tables another one published."""
    return versions.publish(feeds.spark, root, {"version": 1, "tables": dict(manifest["tables"]), "moves": dict(manifest["moves"])})
