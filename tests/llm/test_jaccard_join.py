import random
import re
import tracemalloc

import numpy as np

from assay.llm import jaccard_join as op
from assay.llm import sketch
from assay.llm.components import components
from helpers import awkward, clashing, documents, prose

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall((text or "").encode().lower())
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(texts):
    """(set size, first place reachable) of each text."""
    sets = [shingles(t) for t in texts]
    group = list(range(len(texts)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, x in enumerate(sets):
        for j in range(i):
            if x and sets[j] and 100 * len(x & sets[j]) >= 75 * len(x | sets[j]):
                a, b = sorted((root(i), root(j)))
                group[b] = a
    return [(len(x), root(i)) for i, x in enumerate(sets)]


def corpus(seed=7, n=140):
    rng = random.Random(seed)
    common = prose(99, 40, 300)
    texts = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.35 or not texts:
            texts.append(prose(1000 + i, rng.randint(1, 90), 300) + (" " + common if rng.random() < 0.5 else ""))
        elif kind < 0.5:
            texts.append(rng.choice(texts))
        else:
            words = rng.choice(texts[: max(1, len(texts) // 4)]).split()
            for _ in range(rng.randint(1, max(1, len(words) // 12))):
                words.insert(rng.randrange(len(words) + 1), f"new{rng.randint(0, 50)}")
            texts.append(" ".join(words[rng.randint(0, 3) :]))
    return texts + ["", None, "one two", "One  TWO", "three"]


def joined(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in op.join_similar(df).collect()}


def test_components_match_brute_force(spark):
    texts = corpus()
    assert joined(documents(spark, texts)) == dict(enumerate(brute(texts)))


def test_salted_shingles_give_the_same(spark, monkeypatch):
    texts = corpus(8, 90)
    monkeypatch.setattr(op, "SALT_ROWS", 2)
    assert joined(documents(spark, texts)) == dict(enumerate(brute(texts)))


def test_prefixes_meet_for_every_pair_that_links():
    for x in range(1, 120):
        for y in range(x, 120):
            wanted = op._needed(x, y)
            if wanted <= x:  # such a pair can link
                assert wanted >= x - op.index_prefix(x) + 1
                assert wanted >= y - op.probe_prefix(y) + 1 or 75 * y > 100 * x


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 190)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 190: 190, 200: 190}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_awkward_rows(spark):
    ids, texts = awkward()
    rows = op.join_similar(documents(spark, texts, ids)).collect()
    assert len(rows) == len(texts)
    got = sorted(((r["doc_id"], r["component_id"], r["n_shingles"]) for r in rows), key=repr)
    copies = [x for x in got if x[0] in (10, 11, 12)]
    assert [x[1] for x in copies] == [10] * len(copies) and len(copies) == 4
    assert [x[2] for x in got if x[0] in (2, 3, 4)] == [0, 0, 0]
    assert [x[1] for x in got if x[0] == 20] == [20, 20] and (None, None, 1) in got


def test_one_of_each_group_stays(spark):
    texts = corpus(9, 60)
    docs = documents(spark, texts)
    kept = op.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [i for i, (_, c) in enumerate(brute(texts)) if c == i]
    odd = clashing(spark, ["row", "key", "component_id", "gone_key"])
    assert op.keep_one(odd).columns == odd.columns and op.keep_one(odd).count() == 2
    assert op.keep_one(documents(spark, [])).count() == 0


def test_one_row_stays_of_repeated_and_missing_keys(spark):
    text, other = prose(1, 80), prose(2, 80)
    kept = op.keep_one(documents(spark, [text] * 3 + [other] * 2, [7, 7, 9, None, None])).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept if r["doc_id"]) == [(7, text)]
    assert [r["text"] for r in kept if r["doc_id"] is None] == [other] and len(kept) == 2


def test_the_driver_holds_a_byte_for_each_slot_of_the_sketch(spark):
    values = spark.range(0, 300_000, 1, 3).selectExpr("id * id % 70001 + 900000 * (id % 2) as v")

    def make():
        return lambda batch: iter([batch.column(0).to_numpy()])

    bits = 21
    counts = sketch.count_values(values, make, bits)
    assert counts.sum() == 300_000
    tracemalloc.start()
    levels = sketch.count_values(values, make, bits, sketch.as_levels)
    mean = sketch.mean_count(levels)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert levels.tolist() == sketch.as_levels(counts).tolist() and mean == sketch.mean_count(sketch.as_levels(counts))
    assert (sketch.count_values(values, make, bits, sketch.is_any).view(bool) == (counts > 0)).all()
    assert most < 3 << bits
    assert sketch.count_values(values.limit(0), make, bits, sketch.as_levels).dtype == np.uint8


def test_tasks_are_handed_few_bytes_of_sets_at_once(spark, monkeypatch):
    limit = 1 << 16
    monkeypatch.setattr(op, "BATCH_BYTES", limit, raising=False)
    real = op._verify

    def verify(batches):
        def bounded():
            for batch in batches:
                if batch.nbytes > 2 * limit:
                    raise ValueError(f"{batch.nbytes} bytes at once")
                yield batch

        return real(bounded())

    monkeypatch.setattr(op, "_verify", verify)
    words = prose(11, 1500, 400).split()
    texts = [" ".join(words[:i] + ["other"] + words[i + 1 :]) for i in range(0, 1500, 30)]
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    rows = op.join_similar(documents(spark, texts)).collect()
    assert {r["component_id"] for r in rows} == {0} and len(rows) == 50
    assert spark.conf.get(name) == before


def test_rows_still_apart_are_those_of_mixed_tokens_salted_or_not(spark):
    met = spark.createDataFrame(
        [(t, s, r, 9, 0) for t, s, r in [(1, 0, 1), (1, 0, 2), (2, 0, 2), (2, 0, 3), (3, 1, 2), (3, 2, 3), (4, 1, 1), (4, 2, 3)]],
        "token long, salt int, row long, size int, pos int",
    )
    joined = spark.createDataFrame([(2, 2), (3, 2)], "node long, component long")
    found = op.still_apart(met, joined)
    assert sorted((r["token"], r["row"], r["component"]) for r in found.collect()) == [(1, 1, 1), (1, 2, 2), (4, 1, 1), (4, 3, 2)]
    # Rows are shuffled once for all the leads of their token, not once for each.
    led = op.meet(found, op.F.xxhash64("row", "token"), 0.0, op.F.array(*[op.F.xxhash64("token", op.F.lit(i)) for i in range(4)]))
    plan = led._jdf.queryExecution().optimizedPlan().toString()
    assert 0 <= plan.index("Generate") < plan.index("RepartitionByExpression")
    assert led.count() == 4 * 4
