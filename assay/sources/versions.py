"""Versions of a product's tables, published together by one pointer.

A refresh writes what it changed into folders of its own; nothing that readers use is touched.
The manifest it then publishes names, for each table, the folders that hold it, and for a table
kept by parts (days, buckets) which parts each folder still speaks for. A manifest appears whole or
not at all, and only the highest one is current; a reader that holds one keeps reading that
version. Data is in Spark's hands only: a manifest holds names.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, types as T
from pyspark.sql import functions as F

MANIFESTS = "_manifests"


class VersionTaken(Exception):
    """Another refresh published the version first."""


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def put_once(spark: SparkSession, path: str, text: str) -> bool:
    """Make the small file ``path`` appear whole; False where there is one already.

    It is written under another name and renamed, so a writer that dies leaves nothing behind
    that could be taken for it.
    """
    place, system = _file_system(spark, path)
    if system.exists(place):
        return False
    hidden, _ = _file_system(spark, f"{place.getParent().toString()}/.{uuid.uuid4().hex}")
    out = system.create(hidden, False)
    out.write(bytearray(text.encode()))
    out.close()
    if system.exists(place) or not system.rename(hidden, place):
        system.delete(hidden, False)
        return False
    return True


def read_small(spark: SparkSession, path: str) -> str:
    place, system = _file_system(spark, path)
    stream = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def current(spark: SparkSession, root: str) -> dict:
    """The manifest published last; that of a product not built yet is empty."""
    place, system = _file_system(spark, f"{root}/{MANIFESTS}")
    found = []
    if system.exists(place):
        names = [status.getPath().getName() for status in system.listStatus(place)]
        found = sorted(name for name in names if name.endswith(".json") and not name.startswith("."))
    if not found:
        return {"version": 0, "tables": {}}
    return json.loads(read_small(spark, f"{root}/{MANIFESTS}/{found[-1]}"))


def publish(spark: SparkSession, root: str, manifest: dict) -> dict:
    """Make ``manifest`` the current one; fails where its version exists."""
    path = f"{root}/{MANIFESTS}/{manifest['version']:08d}.json"
    if not put_once(spark, path, json.dumps(manifest)):
        raise VersionTaken(f"version {manifest['version']} of {root} is published already")
    return manifest


def part_name(value: Column) -> Column:
    """The name a part goes by in a manifest; NULL is a part too."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))


def in_parts(value: Column, parts: list[str]) -> Column:
    return part_name(value).isin(parts) if parts else F.lit(False)


def write_whole(df: DataFrame, path: str, by: str | None = None) -> dict:
    """Write a table, kept by the values of ``by`` if given; its entry in a manifest."""
    _write(df, path, by)
    return {"schema": df.schema.json(), "by": by, "folders": [{"path": path, "only": None, "except": []}]}


def write_parts(df: DataFrame, path: str, entry: dict, parts: list[str]) -> dict:
    """Write the rows of ``parts`` anew; the entry in which they replace what the table held of them.

    A part that has no rows any more is simply no longer read from the older folders.
    """
    _write(df.select(*T.StructType.fromJson(json.loads(entry["schema"])).names), path, entry["by"])
    folders = []
    for folder in entry["folders"]:
        if folder["only"] is None:
            left = folder | {"except": sorted({*folder["except"], *parts})}
        else:
            left = folder | {"only": [part for part in folder["only"] if part not in parts]}
        if left["only"] != []:
            folders.append(left)
    return entry | {"folders": [*folders, {"path": path, "only": sorted(parts), "except": []}]}


def _write(df: DataFrame, path: str, by: str | None) -> None:
    if by is None:
        df.write.parquet(path)
    else:
        # Parts are gathered into few files; a large part is still split over tasks.
        df.hint("rebalance", by).write.partitionBy(by).parquet(path)


def read(spark: SparkSession, manifest: dict, table: str) -> DataFrame:
    """A table as the manifest names it. Parts are folders, so others are not opened."""
    entry = manifest["tables"][table]
    schema = T.StructType.fromJson(json.loads(entry["schema"]))
    found = []
    for folder in entry["folders"]:
        rows = spark.read.schema(schema).parquet(folder["path"])
        if folder["only"] is not None:
            rows = rows.where(in_parts(F.col(entry["by"]), folder["only"]))
        elif folder["except"]:
            rows = rows.where(~in_parts(F.col(entry["by"]), folder["except"]))
        found.append(rows.select(*schema.names))
    return reduce(DataFrame.unionByName, found)
