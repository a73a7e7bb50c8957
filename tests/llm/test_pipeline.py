import re

import __spark_entry__
import corpus_pipeline
import test_decontaminate
import test_jaccard_join
from assay.llm.common import ARROW_BYTES
from assay.session import shared_folder
from helpers import documents, prose

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def tables(spark, texts, name):
    folder = shared_folder(spark, "tests", name)
    docs = documents(spark, texts)
    docs.write.parquet(f"{folder}/documents.parquet")
    n = len(texts)
    labels = [(i, int(not (texts[i] or "").count("###")), int("lout" in (texts[i] or ""))) for i in range(0, n, 2)]
    spark.createDataFrame(labels or [(0, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(0, prose(4242, 40, 500))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages_take_effect(spark):
    clean = [prose(i, 60, 3000) for i in range(40)]
    junk = [" ".join(f"w{i}a{k}###" for k in range(50)) for i in range(40)]
    texts = clean + junk + [clean[0] + " tail", prose(50, 20, 3000) + " " + prose(4242, 40, 500), "a@b.co " + prose(51, 60, 3000), None, "few words"]
    folder = tables(spark, texts, "pipeline-small")
    rows = {r["doc_id"]: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert sorted(rows) == [*range(40), 82]
    assert rows[82]["text"].startswith("<EMAIL> ") and rows[82]["n_chars"] == len(rows[82]["text"])
    assert rows[0]["text"] == clean[0] and rows[0]["mixing"]["rate"] >= 0


def test_stages_hand_over_the_columns_of_documents(spark):
    folder = tables(spark, [], "pipeline-empty")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    odd = docs.selectExpr("*", "1 as contamination", "2 as row", "3 as quality_rules", "4 as mixing")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, folder)
        assert (out.columns, out.count(), name) == (odd.columns, 0, name)
    assert corpus_pipeline.STAGES[-1][1](spark, odd, folder).columns[: len(odd.columns)] == odd.columns


def base_failed(text):
    """The base rule of the quality stage: too few words, or too many in repeated 5-word windows."""
    words = SPACED.findall(text or "")
    places = {}
    for i in range(len(words) - 4):
        places.setdefault(tuple(words[i : i + 5]), []).append(i)
    repeated = {i + k for found in places.values() if len(found) > 1 for i in found for k in range(5)}
    return len(words) < 10 or 100 * len(repeated) > 20 * len(words)


def test_each_stage_matches_brute_force(spark):
    """Each stage on its predecessor's rows, against plain Python; no label tells anything apart here,
    so the quality stage keeps what the base rule keeps."""
    item = prose(4242, 40, 500)
    texts = [t for t in test_jaccard_join.corpus(3, 80)]
    texts += [f"{prose(600 + i, 30, 900)} {item.upper()}" for i in range(3)]
    texts += [f"{prose(700 + i, 400 * (i % 2) + 20, 900)} {' '.join(item.split()[:13])}" for i in range(4)]
    texts += [f"Write to a{i}.b@c-{i}.org or x@y.zz, {prose(800 + i, 25, 900)}" for i in range(4)]
    texts += ["one two three four five six seven " * 5, prose(990, 9, 900)]
    folder = tables(spark, texts, "pipeline-brute")
    labels = [(i, 1, 0) for i in range(len(texts))]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(f"{folder}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    held = dict(enumerate(texts))

    def step(name, expected):
        nonlocal docs
        docs = corpus_pipeline.staged(stages[name](spark, docs, folder), name)
        got = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert got == expected, name
        return expected

    held = step("quality_rules", {i: t for i, t in held.items() if not base_failed(t)})
    order = sorted(held)
    groups = test_jaccard_join.brute([held[i] for i in order])
    held = step("ngram_jaccard_join", {i: held[i] for k, i in enumerate(order) if groups[k][1] == k})
    before = len(held)
    held = step(
        "decontamination", {i: t for i, t in held.items() if not test_decontaminate.brute(t, [(0, item)])[3]}
    )
    assert before > len(held)
    held = step("pii", {i: EMAIL.sub("<EMAIL>", t) for i, t in held.items()})
    assert any("<EMAIL>" in t for t in held.values())
    assert all(r["n_chars"] == len(r["text"]) for r in docs.where("text like '%<EMAIL>%'").collect())
    step("source_mixing", held)
    assert all(r["mixing"]["rate"] >= 0 for r in docs.collect())


def test_rows_go_to_python_in_small_batches_with_one_copy_of_their_text(spark, monkeypatch):
    texts = [" ".join(f"w{i}x{k}" for k in range(20_000)) for i in range(60)]
    size = sum(map(len, texts))
    folder = tables(spark, texts, "pipeline-batches")
    spark.createDataFrame([], "item_id long, text string").write.mode("overwrite").parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet").coalesce(1)
    kind, seen = type(docs), spark.sparkContext.accumulator(0)
    real, before = kind.mapInArrow, spark.conf.get(ARROW_BYTES)

    def bounded(self, run, *rest):
        def checked(batches):
            def each():
                for batch in batches:
                    seen.add(batch.nbytes)
                    if batch.nbytes > 8_000_000:
                        raise ValueError(f"{batch.nbytes} bytes at once")
                    yield batch

            return run(each())

        return real(self, checked, *rest)

    monkeypatch.setattr(kind, "mapInArrow", bounded)
    stages = dict(corpus_pipeline.STAGES)
    # The labelled half is read once more, to learn rules from.
    for name, most in (("quality_rules", 1.6 * size), ("decontamination", 1.1 * size)):
        spark.conf.set(ARROW_BYTES, "64m")
        start = seen.value
        try:
            rows = stages[name](spark, docs, folder).collect()
        finally:
            spark.conf.set(ARROW_BYTES, before)
        assert {r["doc_id"]: r["text"] for r in rows} == dict(enumerate(texts)), name
        assert size < seen.value - start < most, name


def test_queries_are_registered():
    names = list(__spark_entry__.queries())
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
