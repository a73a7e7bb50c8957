import random

import numpy as np

from assay.llm import toxicity as op
from helpers import awkward, clashing, documents, prose

INSULTS = ("oaf", "lout", "cad")


def corpus(n=400):
    rng = random.Random(2)
    texts, toxic = [], []
    for i in range(n):
        bad = i % 5 == 0
        words = prose(1000 + i, rng.randint(30, 60), 400).split()
        for _ in range(rng.randint(1, 6) if bad else 0):
            words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        texts.append(" ".join(words))
        toxic.append(int(bad))
    return texts, toxic


def test_held_out_rows_are_graded(spark):
    texts, toxic = corpus()
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(i, t) for i, t in enumerate(toxic) if i % 2], "doc_id long, toxic int")
    model = op.fit_model(docs, labels)
    assert (np.diff(model.thresholds) >= 0).all()
    rows = {r["doc_id"]: r["toxicity"] for r in op.score_toxicity(docs, model).collect()}
    held = [i for i in range(len(texts)) if i % 2 == 0]
    assert np.mean([rows[i]["toxic"] == bool(toxic[i]) for i in held]) > 0.95
    few, many = op.score_toxicity(
        documents(spark, ["plain words and one oaf", "oaf lout cad oaf lout cad oaf"]), model
    ).orderBy("doc_id").collect()
    assert few["toxicity"]["severity"] < many["toxicity"]["severity"]


def test_grades_given_are_kept(spark):
    texts = ["meh " * 3 + prose(i, 20) if i % 3 == 1 else "vile " * 3 + prose(i, 20) if i % 3 == 2 else prose(i, 20) for i in range(240)]
    labels = spark.createDataFrame([(i, i % 3) for i in range(240)], "doc_id long, toxic int")
    docs = documents(spark, texts)
    model = op.fit_model(docs, labels, grades=3)
    rows = op.score_toxicity(docs, model).collect()
    assert np.mean([r["toxicity"]["grade"] == r["doc_id"] % 3 for r in rows]) > 0.95


def test_awkward_rows(spark):
    ids, texts = awkward()
    none = spark.createDataFrame([], "doc_id long, toxic int")
    docs = documents(spark, texts, ids)
    rows = op.score_toxicity(docs, op.fit_model(docs, none)).collect()
    assert len(rows) == len(texts)
    assert {(r["toxicity"]["severity"], r["toxicity"]["toxic"]) for r in rows} == {(0.0, False)}
    docs = clashing(spark, ["toxicity", "severity"])
    found = op.score_toxicity(docs, op.fit_model(docs, none), keep=("doc_id", "severity"))
    assert found.columns == ["doc_id", "severity", "toxicity"]
    assert op.score_toxicity(documents(spark, []), op.fit_model(documents(spark, []), none)).count() == 0
