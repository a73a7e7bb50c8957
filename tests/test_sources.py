from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.sources import files, landing, tables
from assay.types import all_strings, page_of
from conftest import rows


def write_text(spark, path, *lines):
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.mode("append").text(path)
    return path


def test_csv_parts_are_one_dataset_of_strings(spark, folder):
    df = spark.createDataFrame([("007", "1.50"), ("8", None)], "id string, price string").repartition(2)
    back = files.read_csv_parts(spark, files.write_csv_parts(df, folder), all_strings(["id", "price"]))
    assert rows(back) == [("007", "1.50"), ("8", None)]


def test_jsonl_keeps_number_text(spark, folder):
    write_text(spark, folder, '{"id": 1, "price": 12.50}')
    assert rows(files.read_jsonl(spark, folder, all_strings(["id", "price"]))) == [("1", "12.50")]


PAGE = page_of(["id", "price"], {"lines": ["no", "sku"]})


def test_pages_unroll_and_keep_nested_lines(spark, folder):
    write_text(
        spark, folder,
        '[{"id": 1, "price": 2.50, "lines": [{"no": 1, "sku": "a"}]}, {"id": 2, "price": null, "lines": []}]',
        '[{"id": 3, "price": 1, "lines": null}]',
    )
    back = files.read_json_pages(spark, folder, PAGE).drop(files.CORRUPT)
    assert [(r.id, r.price, r.lines and [tuple(x) for x in r.lines]) for r in back.orderBy("id").collect()] == [
        ("1", "2.50", [("1", "a")]), ("2", None, []), ("3", "1", None)
    ]


def test_a_page_cut_in_half_is_found_before_and_after_the_parse(spark, folder):
    write_text(spark, folder, '[{"id": 1}]', '[{"id": 2},', '{"id": 3}]')
    assert [r.incomplete_lines for r in landing.page_faults(spark, folder).collect()] == [2]
    corrupt = files.read_json_pages(spark, folder, PAGE).where(F.col(files.CORRUPT).isNotNull())
    assert len(corrupt.collect()) >= 1


def test_written_pages_hold_whole_records_in_order(spark, folder):
    df = spark.range(10).select(F.col("id").cast("string").alias("id"), F.lit(None).cast("string").alias("price"))
    files.write_json_pages(df, folder, F.floor(F.col("id").cast("long") / 4), ["id"])
    assert landing.page_faults(spark, folder).count() == 0
    assert spark.read.text(folder).count() == 3
    assert files.read_json_pages(spark, folder, all_strings(["id", "price"])).select("id").distinct().count() == 10


def test_provenance_names_the_part(spark, folder):
    write_text(spark, folder, '{"id": 1}')
    found = files.with_provenance(files.read_jsonl(spark, folder, all_strings(["id"]))).first()
    assert "part-" in found.source_path


# --- integrity of landed parts


def _landed(spark, folder):
    spark.range(40).repartition(4).write.parquet(folder)
    return landing.landed_parts(spark, folder)


def test_parts_in_sequence_pass_and_a_gap_or_surplus_is_named(spark, folder):
    parts = _landed(spark, folder)
    feed = parts.first().feed
    expected = spark.createDataFrame([(feed, 0, 3)], "feed string, first_part int, last_part int")
    assert landing.missing_parts(parts, expected).count() == 0
    longer = spark.createDataFrame([(feed, 0, 5)], "feed string, first_part int, last_part int")
    assert rows(landing.missing_parts(parts, longer), "part", "problem") == [(4, "missing"), (5, "missing")]
    shorter = spark.createDataFrame([(feed, 0, 2)], "feed string, first_part int, last_part int")
    assert rows(landing.missing_parts(parts, shorter), "part", "problem") == [(3, "past the end")]


def test_sizes_and_digests_against_the_manifest(spark, folder):
    parts = _landed(spark, folder)
    manifest = landing.digests(parts).join(parts.select("path", F.col("length").alias("received_bytes")), "path")
    assert landing.size_faults(parts, manifest).count() == 0
    assert landing.digest_faults(parts, manifest).count() == 0
    spoiled = manifest.withColumn("sha256", F.lit("0" * 64)).withColumn("received_bytes", F.col("received_bytes") + 1)
    assert {r.problem for r in landing.size_faults(parts, spoiled).collect()} == {"length differs"}
    assert {r.problem for r in landing.digest_faults(parts, spoiled).collect()} == {"digest differs"}
    unpublished = manifest.withColumn("sha256", F.lit(""))
    assert {r.problem for r in landing.digest_faults(parts, unpublished).collect()} == {"no published digest"}
    assert {r.problem for r in landing.digest_faults(parts, manifest.limit(0)).collect()} == {"no published digest"}
    assert {r.problem for r in landing.size_faults(parts, manifest.limit(0)).collect()} == {"not in the manifest"}


def test_markers_catch_a_page_that_is_not_parquet(spark, folder):
    parts = _landed(spark, folder)
    assert landing.magic_faults(parts).count() == 0
    write_text(spark, f"{folder}-html", "<html>")
    assert landing.magic_faults(landing.landed_parts(spark, f"{folder}-html")).count() == 1


def test_markers_survive_corruption_that_the_digest_finds(spark):
    """Both markers intact, the body changed."""
    sent = spark.createDataFrame([("p", bytearray(b"PAR1 body PAR1"))], "path string, content binary")
    arrived = spark.createDataFrame([("p", bytearray(b"PAR1 b?dy PAR1"))], "path string, content binary")
    assert landing.magic_faults(arrived).count() == 0
    assert landing.digest_faults(arrived, landing.digests(sent)).count() == 1


@pytest.mark.parametrize(
    "header, appeared, missing, duplicated, trailing, reordered",
    [
        ("a,b", None, None, None, None, None),
        ("a,c", ["c"], ["b"], [], False, False),
        ("a,b,b", [], [], ["b"], False, False),
        ("a,b,", [""], [], [], True, False),
        ("a,b\r", None, None, None, None, None),
        ('"a",b', None, None, None, None, None),
        ('a,b,"x, ""y"""', ['x, "y"'], [], [], False, False),
        ("b,a", [], [], [], False, True),
    ],
)
def test_header_drift(spark, header, appeared, missing, duplicated, trailing, reordered):
    body = bytearray(f"{header}\n1,2\n".encode())
    parts = spark.createDataFrame([("p", body)], "path string, content binary")
    drift = landing.header_drift(landing.header_names(parts), ["a", "b"]).collect()
    if appeared is None:
        assert drift == []
    else:
        assert tuple(drift[0])[1:] == (appeared, missing, duplicated, trailing, reordered)


def test_parts_of_other_column_orders_are_read_by_name(spark, folder):
    for name, text in (("one", 'a,b\n1,2\n'), ("two", 'b,"a"\n2,1\n'), ("three", "b,c\n2,3\n")):
        spark.createDataFrame([(text.rstrip("\n"),)], "value string").coalesce(1).write.text(f"{folder}/{name}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("a", "b")])
    found = files.read_csv_parts(spark, f"{folder}/*", schema)
    assert found.columns == ["a", "b"]
    assert rows(found) == [("1", "2"), ("1", "2"), (None, "2")]


def test_frame_drift_blames_the_read():
    assert landing.frame_drift(["a", "hidden"], ["a"]) == ["hidden"]
    assert landing.frame_drift(["a"], ["a"]) == []


# --- tables at rest


def test_tables_are_where_they_say(spark, folder):
    tables.write_table(spark.range(3), f"{folder}/t")
    assert rows(tables.landed_at(spark, {"t": f"{folder}/t"})) == [("t", 3, 1, "id")]
    with pytest.raises(AnalysisException):
        tables.landed_at(spark, {"t": f"{folder}/elsewhere"})


def test_a_second_write_replaces_the_first(spark, folder):
    tables.write_table(spark.range(3), folder)
    assert tables.materialise(spark.range(2), folder).count() == 2


def test_run_counts_against_counts_at_rest(spark):
    run = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "table_name string, rows long")
    rest = spark.createDataFrame([("a", 1), ("b", 3), ("d", 4)], "table_name string, rows long")
    assert tables.count_mismatches(run, run).count() == 0
    assert rows(tables.count_mismatches(run, rest)) == [("b", 2, 3), ("c", 3, None), ("d", None, 4)]


def test_metrics_are_exactly_one_row(spark, folder):
    tables.write_table(tables.run_metrics(spark.range(4), rows=F.count("*"), top=F.max("id")), folder)
    assert tables.read_metrics(spark, folder) == {"rows": 4, "top": 3}
    tables.write_table(spark.range(2), folder)
    with pytest.raises(ValueError):
        tables.read_metrics(spark, folder)


def _headline(spark, revenue, cancelled, lines):
    return spark.createDataFrame(
        [(revenue, cancelled, lines)],
        "revenue_usd decimal(29,4), cancelled_revenue_usd decimal(29,4), sale_lines long",
    )


def test_snapshot_refuses_to_say_nothing(spark, folder):
    good = _headline(spark, Decimal("1.5"), Decimal(0), 2)
    tables.write_snapshot(good, ["b", "a"], folder)
    published = spark.read.json(folder).first()
    assert (published.revenue_usd, published.cancelled_revenue_usd, published.sale_lines) == ("1.5000", "0.0000", "2")
    assert published.contracts == ["a", "b"]
    with pytest.raises(ValueError):
        tables.write_snapshot(good, [], folder)
    with pytest.raises(ValueError):
        tables.write_snapshot(_headline(spark, Decimal(0), Decimal(0), 0), ["a"], folder)
    with pytest.raises(ValueError):
        tables.write_snapshot(_headline(spark, None, None, 0), ["a"], folder)
    with pytest.raises(ValueError):
        tables.write_snapshot(good.limit(0), ["a"], folder)
