import numpy as np
from pyspark.sql import functions as F

from assay.llm import mixing as op
from helpers import awkward, clashing, documents, prose

SOFT = "tokens long, posterior array<double>"


def solved(spark, rows, targets):
    soft = spark.createDataFrame(rows, SOFT)
    steps = op.fit_rates(soft, targets)
    return [r["rate"] for r in soft.select(op.rate_of(F.col("posterior"), steps).alias("rate")).collect()]


def totals(rows, rates):
    mass = sum(n for n, _ in rows)
    return np.sum([n * r * np.array(p) for (n, p), r in zip(rows, rates, strict=True)], axis=0) / mass


def test_targets_are_met_where_they_can_be(spark):
    rng = np.random.default_rng(1)
    rows = [(int(rng.integers(1, 500)), rng.dirichlet([0.3, 0.2, 0.1]).tolist()) for _ in range(300)]
    rates = solved(spark, rows, [0.8, 0.15, 0.05])
    assert min(rates) >= 0 and np.allclose(totals(rows, rates), [0.8, 0.15, 0.05], atol=2e-4)


def test_least_squares_where_they_cannot(spark):
    rows = [(10, [0.5, 0.5]), (30, [0.9, 0.1])]
    rates = solved(spark, rows, [0.2, 0.8])
    # Brute force over a grid.
    grid = np.linspace(0, 4, 401)
    a = np.array([[n * x / 40 for x in p] for n, p in rows])
    loss = [((x * a[0] + y * a[1] - [0.2, 0.8]) ** 2).sum() for x in grid for y in grid[:60]]
    assert ((totals(rows, rates) - [0.2, 0.8]) ** 2).sum() <= min(loss) + 1e-4


def test_posteriors_follow_labels(spark):
    texts = [prose(i, 40) + (" vile lout" if i % 3 == 1 else " ### ###" * 9 if i % 3 == 2 else "") for i in range(240)]
    names = ("high", "toxic", "low")
    labelled = spark.createDataFrame([(i, names[i % 3]) for i in range(0, 240, 2)], "doc_id long, domain string")
    rows = op.mix_sources(documents(spark, texts), labelled).collect()
    best = [max(names, key=lambda d, r=r: r["mixing"]["posterior"][d]) == names[r["doc_id"] % 3] for r in rows]
    assert np.mean(best) > 0.9
    for r in rows:
        assert abs(sum(r["mixing"]["posterior"].asDict().values()) - 1) < 1e-9


def test_awkward_rows(spark, capsys):
    ids, texts = awkward()
    none = spark.createDataFrame([], "doc_id long, domain string")
    docs = documents(spark, texts, ids)
    mixed = op.mix_sources(docs, none)
    assert mixed.columns == [*docs.columns, "mixing"] and mixed.count() == len(texts)
    empty = {r["mixing"]["tokens"] for r in mixed.collect() if not (r["text"] or "").strip()}
    assert empty == {0}
    odd = clashing(spark, ["mixing_tokens", "tokens", "posterior"])
    assert op.mix_sources(odd, none).columns == [*odd.columns, "mixing"]
    assert op.mix_sources(documents(spark, []), none).count() == 0
    mixed.explain()
    assert "Python" not in capsys.readouterr().out


def test_words_of_a_small_language_speak_for_a_domain(spark):
    def text(i):
        toxic = i % 2 == 1
        if i % 10 < 2:  # a fifth of the rows, with one word of letters that are not ASCII
            return prose(7000 + i, 30) + (" öäüß" if toxic else "")
        return prose(i, 30) + (" " + " ".join(f"bad{'abcdefgh'[k // 8]}{'ijklmnop'[k % 8]}" for k in range(60)) if toxic else "")

    names = ("high", "toxic", "low")
    labelled = spark.createDataFrame([(i, names[i % 2]) for i in range(300)], "doc_id long, domain string")
    rows = op.mix_sources(documents(spark, [text(i) for i in range(400)]), labelled).collect()
    small = [r["mixing"]["posterior"]["toxic"] for r in rows if r["doc_id"] % 10 == 1 and r["doc_id"] >= 300]
    clean = [r["mixing"]["posterior"]["toxic"] for r in rows if r["doc_id"] % 10 == 0 and r["doc_id"] >= 300]
    assert min(small) > 0.5 > max(clean)
