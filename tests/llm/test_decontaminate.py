import hashlib
import random
import re

from pyspark.sql import functions as F

from assay.llm import decontaminate as op
from helpers import awkward, clashing, documents, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(text, items):
    words = WORD.findall(fold(text))
    hit, ids = set(), set()
    for item, body in items:
        own = WORD.findall(fold(body))
        size = min(13, len(own))
        for i in range(len(own) - size + 1) if own else ():
            for j in range(len(words) - size + 1):
                if words[j : j + size] == own[i : i + size]:
                    hit.update(range(j, j + size))
                    if item is not None:
                        ids.add(str(item))
    return len(words), len(hit), ",".join(sorted(ids)), len(hit) > 0 and 20 * len(hit) >= len(words)


def result(df):
    c = "contamination."
    return [
        (r["n_words"], r["n_hit"], ",".join(r["hit_items"]), r["contaminated"], r["key"])
        for r in df.select(F.col("doc_id").alias("key"), c + "*").collect()
    ]


def case(spark):
    rng = random.Random(4)
    items = [(i, prose(100 + i, rng.choice([1, 2, 5, 12, 13, 14, 40]), 25)) for i in range(20)]
    items += [(3, items[5][1]), (None, prose(900, 20)), (30, None), (31, ""), (32, "!?")]
    texts = []
    for i in range(60):
        part = rng.choice(items)[1] or ""
        texts.append(f"{prose(200 + i, rng.randint(0, 30), 25)} {part.upper()}, {prose(300 + i, 10, 25)}")
    ids, odd = awkward()
    return documents(spark, texts + odd, list(range(100, 160)) + ids), texts + odd, items


def test_matches_brute_force(spark):
    docs, texts, items = case(spark)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = result(op.find_contamination(docs, benchmark))
    assert sorted(x[:4] for x in got) == sorted(brute(t, items) for t in texts)


def test_blocks_give_the_same(spark):
    docs, _, items = case(spark)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    whole = result(op.find_contamination(docs, benchmark))
    cut = result(op.find_contamination(docs, benchmark, block_bytes=700))
    assert sorted(whole, key=repr) == sorted(cut, key=repr)


def test_empty_tables_and_clashing_names(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = clashing(spark, ["n_words", "contaminated", "hit_runs"])
    found = op.find_contamination(docs, none, keep=tuple(docs.columns), name="c_")
    assert found.columns == [*docs.columns, "c_"]
    assert [r["c_"]["contaminated"] for r in found.collect()] == [False, False]
    assert op.find_contamination(documents(spark, []), none).count() == 0


def test_query_digest_of_nothing(spark):
    assert hashlib.sha256(b"").hexdigest() == spark.sql("select sha2('', 256) as h").first()["h"]


def test_a_kept_text_is_marked_alike_in_one_block_and_in_many(spark):
    texts = [prose(i % 9, 40 + i, 500) for i in range(30)] + [None, ""]
    benchmark = spark.createDataFrame([(i, prose(i, 60, 500)) for i in range(9)], "item_id long, text string")
    docs = documents(spark, texts)
    found = [
        {r["doc_id"]: r for r in op.find_contamination(docs, benchmark, keep=keep, block_bytes=size).collect()}
        for keep, size in ((("doc_id",), op.BLOCK_BYTES), (("doc_id", "text"), op.BLOCK_BYTES), (("text", "doc_id"), 300))
    ]
    assert any(r["contamination"]["contaminated"] for r in found[0].values())
    for rows in found[1:]:
        assert {i: r["text"] for i, r in rows.items()} == dict(enumerate(texts))
        assert all(r["contamination"] == found[0][i]["contamination"] for i, r in rows.items())
