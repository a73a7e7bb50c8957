"""Landed feeds: a directory of parts is one dataset, parsed verbatim.

Layout is ``{root}/{vendor}/{day}/{feed}``. The schema is always declared: a reader
that infers would turn a vendor's rename into a silent change of type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql import functions as F

CORRUPT = "_corrupt_record"


def feed_path(root: str, vendor: str, day: str, feed: str) -> str:
    return f"{root}/{vendor}/{day}/{feed}"


def csv_names(header: F.Column, separator: str = ",") -> F.Column:
    """The names on a CSV header line; a quoted name may hold the separator."""
    outside = f'{separator}(?=(?:[^"]*"[^"]*")*[^"]*$)'
    parts = F.split(F.regexp_replace(header, "\r$", ""), outside, -1)
    unquoted = F.transform(parts, lambda name: F.regexp_replace(F.trim(name), '^"(.*)"$', "$1"))
    return F.transform(unquoted, lambda name: F.replace(name, F.lit('""'), F.lit('"')))


def csv_headers(spark: SparkSession, path: str) -> DataFrame:
    """(path, header): the first line of each part. Only first blocks are looked at."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.struct(F.monotonically_increasing_id().alias("_at"), F.col("value")).alias("_line"),
    )
    first = lines.where(F.col("_block") == 0).groupBy("path").agg(F.min("_line").alias("_line"))
    return first.select("path", F.col("_line.value").alias("header"))


def read_csv_parts(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV parts with a header line each, every column a string, matched by name.

    Parts are read in groups of one header, each under that header's own order, so a part
    whose columns stand elsewhere is not swapped. A declared column that a part lacks is
    NULL there; a column nobody declared is left to the drift check.
    """
    groups = (
        csv_headers(spark, path)
        .groupBy(csv_names(F.col("header")).alias("names"))
        .agg(F.collect_list("path").alias("paths"))
        .collect()
    )
    result = spark.createDataFrame([], schema)
    for group in groups:
        landed = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(len(group["names"]))])
        part = spark.read.schema(landed).option("header", True).csv(group["paths"])
        places = {name: f"_c{i}" for i, name in reversed(list(enumerate(group["names"])))}
        columns = [
            (F.col(places[f.name]) if f.name in places else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
        part = part.select(*columns)
        result = part if len(groups) == 1 else result.unionByName(part)
    return result


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON Lines, one record per line, keeping number text as the vendor wrote it."""
    return spark.read.schema(schema).json(path)


def read_json_pages(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON array pages, one complete array per line.

    The JSON reader unrolls top-level arrays itself. A line it cannot parse arrives
    in the corrupt-record column with every declared column NULL.
    """
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(with_corrupt)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def with_provenance(df: DataFrame, name: str = "source_path") -> DataFrame:
    """The landed part each row came from."""
    return df.withColumn(name, F.col("_metadata.file_path"))


def write_csv_parts(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_jsonl(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return path


def write_json_pages(df: DataFrame, path: str, page: F.Column, order: list[str]) -> str:
    """Land records as JSON array pages, one page per line.

    ``page`` must bound the number of records it groups: a page is one string.
    """
    record = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    ranked = F.struct(*[F.col(name) for name in order], record.alias("record"))
    records = F.transform(F.sort_array(F.collect_list(ranked)), lambda item: item["record"])
    (
        df.groupBy(page.alias("page"))
        .agg(F.concat(F.lit("["), F.array_join(records, ","), F.lit("]")).alias("value"))
        .select("value")
        .write.mode("overwrite")
        .text(path)
    )
    return path


def mark_complete(spark: SparkSession, folder: str, marker: str = "complete.json") -> str:
    """Put the delivery marker into ``folder``, once everything else has landed there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{marker}")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True)
    out.write(bytearray(b'{"complete":true}'))
    out.close()
    return f"{folder}/{marker}"
