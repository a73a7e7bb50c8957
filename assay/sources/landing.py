"""Integrity of landed files, checked before anything parses them.

Every check returns the offending files or lines, so an empty result is a pass. File
bodies are read through ``binaryFile``, one row per part; checks that need only names
and sizes select no content, which the reader then never loads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.sources.files import csv_names

PART_NUMBER = r"part-(\d+)"
PARQUET_MAGIC = "PAR1"


def landed_parts(spark: SparkSession, path: str, glob: str = "part-*", pattern: str = PART_NUMBER) -> DataFrame:
    """One row per landed file: path, length, part number and (lazily) its bytes."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(path)
        .withColumn("part", F.regexp_extract("path", pattern, 1).try_cast("int"))
        .withColumn("feed", F.regexp_extract("path", r"^(.*)/[^/]+$", 1))
    )


def missing_parts(parts: DataFrame, expected: DataFrame) -> DataFrame:
    """Part numbers each feed lacks, and numbers past the declared last one.

    ``expected`` is ``(feed, first_part, last_part)`` as the vendor declared it.
    """
    seen = parts.select("feed", "part").distinct()
    declared = expected.select(
        "feed", F.explode(F.sequence("first_part", "last_part")).alias("part")
    )
    return (
        declared.withColumn("declared", F.lit(True))
        .join(seen.withColumn("seen", F.lit(True)), ["feed", "part"], "full_outer")
        .where(F.col("declared").isNull() | F.col("seen").isNull())
        .select("feed", "part", F.when(F.col("seen").isNull(), "missing").otherwise("past the end").alias("problem"))
    )


def size_faults(parts: DataFrame, manifest: DataFrame) -> DataFrame:
    """Empty parts, and parts whose length is not the number of bytes received."""
    return (
        parts.select("path", "length")
        .join(manifest.select("path", "received_bytes"), "path", "left")
        .withColumn(
            "problem",
            F.when(F.col("length") == 0, "empty body")
            .when(F.col("received_bytes").isNull(), "not in the manifest")
            .when(F.col("length") != F.col("received_bytes"), "length differs"),
        )
        .where(F.col("problem").isNotNull())
    )


def digests(parts: DataFrame) -> DataFrame:
    return parts.select("path", F.sha2("content", 256).alias("sha256"))


def digest_faults(parts: DataFrame, manifest: DataFrame) -> DataFrame:
    """Parts whose SHA-256 is not the published one. No published digest is a fault."""
    return (
        digests(parts)
        .join(manifest.select("path", F.col("sha256").alias("published")), "path", "left")
        .withColumn(
            "problem",
            F.when(F.coalesce(F.col("published"), F.lit("")) == "", "no published digest").when(
                F.col("sha256") != F.col("published"), "digest differs"
            ),
        )
        .where(F.col("problem").isNotNull())
    )


def magic_faults(parts: DataFrame, magic: str = PARQUET_MAGIC) -> DataFrame:
    """Parts not starting and ending with the format's marker.

    Necessary only: a mangled body keeps both markers, so digests are still checked.
    """
    marker = F.lit(magic).cast("binary")
    size = len(magic)
    return parts.where(
        (F.substring("content", 1, size) != marker) | (F.substring("content", -size, size) != marker)
    ).select("path", F.lit("marker missing").alias("problem"))


def page_faults(spark: SparkSession, path: str) -> DataFrame:
    """Lines that are not a complete JSON array, per part.

    A page printed over several lines shows up here as fragments, before a reader
    turns them into NULLs.
    """
    line = F.trim("value")
    return (
        spark.read.text(path)
        .select(line.alias("line"), F.col("_metadata.file_path").alias("path"))
        .where((F.col("line") != "") & ~(F.col("line").startswith("[") & F.col("line").endswith("]")))
        .groupBy("path")
        .agg(F.count("*").alias("incomplete_lines"))
    )


def header_names(parts: DataFrame, separator: str = ",") -> DataFrame:
    """Column names on the header line of each CSV part, in order."""
    header = F.substring_index(F.col("content").cast("string"), "\n", 1)
    return parts.select("path", F.posexplode(csv_names(header, separator)).alias("position", "name"))


def header_drift(headers: DataFrame, declared: list[str]) -> DataFrame:
    """Per part: names that appeared, went missing, repeat or stand elsewhere than declared.

    A blank name is a trailing delimiter. Only parts with drift are returned.
    """
    expected = F.array(*[F.lit(name) for name in declared])
    per_name = headers.groupBy("path", "name").agg(
        F.count("*").alias("times"), F.min("position").alias("first")
    )
    return (
        per_name.groupBy("path")
        .agg(
            F.collect_list("name").alias("names"),
            F.collect_list(F.when(F.col("times") > 1, F.col("name"))).alias("duplicated"),
            F.transform(
                F.array_sort(F.collect_list(F.struct("first", "name"))), lambda x: x["name"]
            ).alias("ordered"),
        )
        .select(
            "path",
            F.array_sort(F.array_except("names", expected)).alias("appeared"),
            F.array_sort(F.array_except(expected, "names")).alias("missing"),
            F.array_sort("duplicated").alias("duplicated"),
            F.array_contains("names", "").alias("trailing_delimiter"),
            # Names that both sides have, in the order of each.
            (F.array_intersect("ordered", expected) != F.array_intersect(expected, "ordered")).alias(
                "reordered"
            ),
        )
        .where(
            (F.size("appeared") > 0)
            | (F.size("missing") > 0)
            | (F.size("duplicated") > 0)
            | F.col("reordered")
        )
    )


def frame_drift(frame: list[str], at_rest: list[str]) -> list[str]:
    """Columns the parsed frame has and the written table lacks: the read added them."""
    return [name for name in frame if name not in set(at_rest)]
