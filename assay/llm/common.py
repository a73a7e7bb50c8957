"""What several operators share: passes over texts in Arrow batches, and staged tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from assay.session import shared_folder

# Bytes of text handed to one call of a per-batch function; bounds a task's memory.
SLICE_BYTES = 2 * 1024 * 1024
# Bytes of rows handed to a task's Python at once.
BATCH_BYTES = 4 * 1024 * 1024
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def staged(df: DataFrame, what: str, row_group: int | None = None) -> DataFrame:
    """Write ``df`` once in the shared folder and read it back.

    The written table cuts lineage: after a lost executor its files are read again. Where rows are
    megabytes each, ``row_group`` bounds the bytes that writers and readers hold at once.
    """
    spark = df.sparkSession
    path = shared_folder(spark, "llm", f"{what}-{uuid.uuid4().hex}")
    writer = df.write if row_group is None else df.write.option("parquet.block.size", row_group)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def schema_of(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def slices(sizes: list[int], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive (start, end) runs of rows of at most ``limit`` bytes, one row at least."""
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > limit:
            yield start, i
            start, held = i, 0
        held += size
    if len(sizes) > start:
        yield start, len(sizes)


def bounded_batches(spark: SparkSession, limit: int = BATCH_BYTES) -> None:
    """From now on the session hands rows to Python in batches of about ``limit`` bytes.

    For results that run after the caller gets them, when ``arrow_batches`` holds no more.
    """
    spark.conf.set(ARROW_BYTES, str(limit))


@contextmanager
def arrow_batches(spark: SparkSession, limit: int) -> Iterator[None]:
    """What runs inside hands rows to Python in batches of about ``limit`` bytes, one row at least.

    Spark's own 64 MB a batch are held by the JVM, outside its heap, and by Python at once, in each
    running task. What the session had before holds again afterwards.
    """
    before = spark.conf.get(ARROW_BYTES, None)
    spark.conf.set(ARROW_BYTES, str(limit))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(ARROW_BYTES)
        else:
            spark.conf.set(ARROW_BYTES, before)


def map_texts(
    df: DataFrame,
    make: Callable[[], Callable[..., dict[str, object]]],
    fields: str,
    *,
    text: str = "text",
    inputs: tuple[str, ...] = (),
    keep: tuple[str, ...] = (),
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """One row out for each row in: the columns ``keep``, then ``fields`` (DDL).

    ``make`` runs once per task and returns a function of a list of texts as UTF-8 bytes
    (None for null) and a list for each of ``inputs``; it returns one list or array (of numpy or
    Arrow) per field.
    Texts reach it in slices of at most ``limit`` bytes, never cut. A text that is kept is handed to
    Python once.
    """
    added = schema_of(fields)
    once = text in keep and dict(df.dtypes).get(text) in ("string", "binary")
    source = df.select(
        *[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)],
        *[F.col(c).alias(f"i{i}") for i, c in enumerate(inputs)],
        *([] if once else [F.col(text).cast("binary").alias("t")]),
    )
    kept = [source.schema[f"k{i}"] for i in range(len(keep))]
    out = StructType(kept + [f for f in added.fields])
    names = [f.name for f in added.fields]
    n_keep, n_in = len(keep), len(inputs)
    place = keep.index(text) if once else n_keep + n_in

    def bodies(batch: pa.RecordBatch) -> pa.Array:
        found = batch.column(place)
        return found.cast(pa.large_binary() if pa.types.is_large_string(found.type) else pa.binary()) if once else found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target, call = to_arrow_schema(out), make()
        for batch in batches:
            sizes = pc.binary_length(bodies(batch)).fill_null(0).to_pylist()
            for a, b in slices(sizes, limit):
                part = batch.slice(a, b - a)
                made = call(
                    bodies(part).to_pylist(),
                    *[part.column(n_keep + j).to_pylist() for j in range(n_in)],
                )
                columns = [part.column(j) for j in range(n_keep)]
                columns += [
                    made[name].cast(target.field(n_keep + j).type)
                    if isinstance(made[name], pa.Array)
                    else pa.array(made[name], type=target.field(n_keep + j).type, from_pandas=False)
                    for j, name in enumerate(names)
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=target)

    result = source.mapInArrow(run, out)
    return result.select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *[F.col(n) for n in names]
    )


def clear_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or a variant that clashes with no column of ``df`` (compared as Spark does)."""
    taken = {c.lower() for c in df.columns}
    name = wanted
    while name.lower() in taken:
        name += "_"
    return name


def keyed(documents: DataFrame, key: str, text: str) -> tuple[DataFrame, bool]:
    """(row, key, body), and whether rows had to be numbered.

    ``row`` is a unique long in the order of ``key``, nulls last.

    It is the key itself where that is a unique whole number; otherwise the rows are numbered
    in a table written once, so that later passes see the same numbers.
    """
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("body"))
    whole = dict(rows.dtypes)["key"] in ("bigint", "int", "smallint", "tinyint")
    counts = rows.agg(
        F.count("*").alias("n"), F.count("key").alias("filled"), F.countDistinct("key").alias("distinct")
    ).first()
    if whole and counts["n"] == counts["filled"] == counts["distinct"]:
        return rows.select(F.col("key").cast("long").alias("row"), "key", "body"), False
    ordered = rows.orderBy(F.asc_nulls_last("key"), F.xxhash64("body"))
    numbers = F.monotonically_increasing_id().alias("row")
    return staged(ordered.select(numbers, "key", "body"), "rows"), True
