import re
from collections import Counter

import numpy as np

from assay.llm import quality_rules as op
from assay.llm.hashing import Powers
from helpers import awkward, clashing, documents, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)), len(covered), len(set(words)),
    )


def test_statistics_match_brute_force():
    texts = [prose(i, n, 12) for i, n in enumerate((0, 3, 5, 9, 40, 300))]
    texts += ["a b c d e\na b c d e\n\n \n a", "#x | <y>\r\n#x | <y>", None, "", "\x0b\x0c é\xa0b"]
    found = op.statistics([None if t is None else t.encode() for t in texts], Powers())
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct_words")
    for i, text in enumerate(texts):
        assert tuple(int(found[n][i]) for n in names) == brute(text)


def test_rules_separate_and_become_an_expression(spark):
    rng = np.random.default_rng(1)
    n = 600
    rows = {"symbols_per_word": rng.random(n), "words": rng.integers(10, 500, n).astype(float)}
    low = (rows["symbols_per_word"] > 0.7) | (rows["words"] < 40)
    rules = op.learn_rules(rows, low)
    got = np.zeros(n, bool)
    for rule in rules:
        got |= op.covered_by(rule, rows, n)
    assert (got == low).mean() >= op.MIN_PRECISION
    assert op.learn_rules(rows, np.zeros(n, bool)) == [] == op.learn_rules({}, np.zeros(0, bool))


def junk(i):
    return " ".join(f"w{(i * 7 + k) % 97}###" for k in range(60))


def test_learns_from_labels_and_keeps_clean_rows(spark):
    clean = [" ".join(f"w{i}x{k}" for k in range(40 + i)) for i in range(60)]
    texts = clean + [junk(i) for i in range(60)]
    docs = documents(spark, texts)
    labels = spark.createDataFrame(
        [(i, int(i < 60)) for i in range(120)] + [(None, 1), (5000, 0), (3, 1)], "doc_id long, quality int"
    )
    kept = op.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(60))


def test_awkward_rows(spark):
    ids, texts = awkward()
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = op.apply_rules(documents(spark, texts, ids), op.fit_rules(documents(spark, texts, ids), none)).collect()
    assert len(rows) == len(texts)
    by = {r["doc_id"]: r["quality_rules"] for r in rows}
    assert by[4]["base_failed"] and not by[4]["kept"] and not by[3]["kept"] and by[10]["kept"]
    docs = clashing(spark, ["quality_rules", "n_words", "kept"])
    kept = op.keep_good(docs, none)
    assert kept.columns == docs.columns and kept.count() == 1
    assert op.keep_good(documents(spark, []), none).count() == 0
