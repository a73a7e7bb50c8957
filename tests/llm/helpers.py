"""Small tables with every awkward case, shared by the operators' tests."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    rows = [
        (i, t, "en", f"s{k % 3}", None if t is None else len(t))
        for k, (i, t) in enumerate(zip(ids, texts, strict=True))
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def prose(seed, n, vocabulary=60):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(vocabulary)]
    return " ".join(rng.choice(words) for _ in range(n))


def awkward():
    """(ids, texts): nulls in both columns, empty and long texts, ties and repeated rows."""
    long = prose(1, 6000)
    base = prose(2, 120)
    texts = [None, "", " \n\t ", "one", base, base, base + " tail", long, long, "日本 é\U0001f600 text", base]
    ids = [4, 3, 2, 1, 10, 11, 12, 20, 20, None, 11]
    return ids, texts


def clashing(spark, names):
    """Documents with further columns called as the operator's results."""
    df = documents(spark, [prose(3, 50), None])
    for name in names:
        df = df.selectExpr("*", f"'mine' as `{name}`")
    return df
