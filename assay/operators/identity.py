"""Resolve one person across two selling systems by their conformed email."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.functions.text import conform_email


def members(df: DataFrame, key: str, email: str, keep: list[str] | None = None) -> DataFrame:
    """Accounts of one system with their conformed address and the attributes to ``keep``."""
    return df.select(
        F.col(key).alias("member_id"), conform_email(F.col(email)).alias("email"), *(keep or [])
    )


def party_key(system: str, member: F.Column, email: F.Column) -> F.Column:
    """The party a member belongs to: their address, or themselves without one."""
    return F.coalesce(email, F.concat(F.lit(f"{system}:"), member.cast("string")))


def resolve_parties(pos: DataFrame, web: DataFrame) -> DataFrame:
    """One row per person over both systems, as ``members`` of each.

    Accounts of one system sharing an address are one person; ``*_accounts`` counts
    them, ``*_id`` is the lowest, and attributes the members kept come from that one as
    ``pos_*`` and ``web_*``. Accounts without an address never meet the join: each is a
    party of its own, and the NULLs do not gather in one task.
    """

    def attributes(side: DataFrame) -> list[str]:
        return [name for name in side.columns if name not in ("member_id", "email")]

    def addressed(side: DataFrame, name: str) -> DataFrame:
        return (
            side.where(F.col("email").isNotNull())
            .groupBy("email")
            .agg(
                F.min("member_id").alias(f"{name}_id"),
                F.count("*").alias(f"{name}_accounts"),
                *[F.min_by(kept, "member_id").alias(f"{name}_{kept}") for kept in attributes(side)],
            )
        )

    def nameless(side: DataFrame, name: str, other: str) -> DataFrame:
        return side.where(F.col("email").isNull()).select(
            party_key(name.upper(), F.col("member_id"), F.col("email")).alias("party_key"),
            "email",
            F.col("member_id").alias(f"{name}_id"),
            F.lit(1).cast("long").alias(f"{name}_accounts"),
            F.lit(0).cast("long").alias(f"{other}_accounts"),
            *[F.col(kept).alias(f"{name}_{kept}") for kept in attributes(side)],
        )

    matched = (
        addressed(pos, "pos")
        .join(addressed(web, "web"), "email", "full_outer")
        .withColumn("party_key", F.col("email"))
        .fillna(0, ["pos_accounts", "web_accounts"])
    )
    return (
        matched.unionByName(nameless(pos, "pos", "web"), allowMissingColumns=True)
        .unionByName(nameless(web, "web", "pos"), allowMissingColumns=True)
        .withColumn("in_pos", F.col("pos_accounts") > 0)
        .withColumn("in_web", F.col("web_accounts") > 0)
    )


def party_of(side: DataFrame, system: str) -> DataFrame:
    """Which party each account of one system belongs to: ``(member_id, party_key)``."""
    return side.select(
        "member_id", party_key(system, F.col("member_id"), F.col("email")).alias("party_key")
    )


def cohort_counts(parties: DataFrame) -> DataFrame:
    """Cohort sizes beside their control total, as one row."""
    both = F.col("in_pos") & F.col("in_web")
    return parties.agg(
        F.count_if(both).alias("matched"),
        F.count_if(F.col("in_pos") & ~F.col("in_web")).alias("pos_only"),
        F.count_if(F.col("in_web") & ~F.col("in_pos")).alias("web_only"),
        F.count_if(F.col("email").isNull()).alias("no_email"),
        F.count("*").alias("parties"),
    ).withColumn(
        "accounted", F.col("matched") + F.col("pos_only") + F.col("web_only") == F.col("parties")
    )


def raw_matches(pos: DataFrame, pos_email: str, web: DataFrame, web_email: str) -> DataFrame:
    """Addresses found in both systems as typed, case and all: the naive match."""
    left = pos.select(F.col(pos_email).alias("email")).where(F.col(pos_email).isNotNull()).distinct()
    right = web.select(F.col(web_email).alias("email")).where(F.col(web_email).isNotNull()).distinct()
    return left.join(right, "email", "left_semi").agg(F.count("*").alias("naive_matches"))


def shared_keys(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """How many distinct keys of the left also occur on the right."""
    return (
        left.select(F.col(left_key).alias("key"))
        .distinct()
        .join(right.select(F.col(right_key).alias("key")).distinct(), "key", "left_semi")
        .agg(F.count("*").alias("shared_keys"))
    )
