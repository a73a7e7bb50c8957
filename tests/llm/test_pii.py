import random
import re

from pyspark.sql import functions as F

from assay.llm import pii as op
from helpers import awkward, clashing, documents

BASE = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def brute(text):
    out = []
    for kind, pattern in BASE:
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def spans(df, base=None):
    found = F.col("pii") if base is None else F.filter("pii", lambda s: s["base"] == base)
    return [(r["doc_id"], r["s"]) for r in df.select("doc_id", op.spelled(found).alias("s")).collect()]


def test_base_spans_match_brute_force(spark):
    rng = random.Random(3)
    letters = list("a.b@c1234 -+()_%é日 ..25 @x.y")
    parts = ["4465758382889437", "+1 (743) 555-3824", "8.196.197.208", "x@y.zz", "DE89370400440532013000"]
    texts = [
        "".join(rng.choice(letters) if rng.random() < 0.75 else rng.choice(parts) for _ in range(rng.randint(0, 50)))
        for _ in range(1500)
    ]
    ids, odd = awkward()
    texts += odd
    got = spans(op.with_spans(documents(spark, texts)), base=True)
    assert sorted(got) == [(i, brute(t)) for i, t in enumerate(texts)]


def test_long_runs_neither_overflow_nor_crawl(spark):
    texts = ["1" * 60000, "a" * 60000, "1 " * 30000, "a@" * 30000, "a.b-" * 15000, "+1" + " 2" * 30000, "a@b." + "c." * 20000]
    got = dict(spans(op.with_spans(documents(spark, texts)), base=True))
    assert got[6] == "email:0:40003" and not any(got[i] for i in range(6))


def test_method_spans_and_context(spark):
    texts = [
        "4465758382889437 4465758382889437",
        "IBAN DE89 3704 0044 0532 0130 00, not DE88 3704 0044 0532 0130 00",
        "ssn 123-45-6789",
        "call +1 (743) 555-3824 4465758382889437",
    ]
    df = op.with_spans(documents(spark, texts))
    got = dict(spans(df))
    assert got == {
        0: "card:0:16,card:17:33", 1: "iban:5:32", 2: "ssn:4:15", 3: "card:23:39,phone:5:22",
    }
    scores = {r["doc_id"]: r["pii"][0]["score"] for r in df.collect()}
    assert scores[2] > 0.6 and scores[0] == 0.8


def test_redaction_and_awkward_rows(spark):
    ids, texts = awkward()
    texts[0], texts[4] = "write a@b.co, 8.8.8.8", None
    docs = documents(spark, texts, ids)
    redacted = op.redact(docs)
    assert redacted.columns == docs.columns and redacted.count() == docs.count()
    by = {r["doc_id"]: r for r in redacted.where("doc_id in (4, 10, 20)").collect()}
    assert by[4]["text"] == "write <EMAIL>, <IP>" and by[4]["n_chars"] == len(by[4]["text"])
    assert by[10]["text"] is None and by[20]["text"] == texts[7]
    odd = clashing(spark, ["pii", "pii_spans_0_", "pii_text_"])
    assert op.redact(odd).columns == odd.columns and op.redact(odd).count() == 2
    assert op.redact(documents(spark, [])).count() == 0


def test_no_python_in_the_plan(spark, capsys):
    op.redact(documents(spark, ["a"])).explain()
    assert "Python" not in capsys.readouterr().out.replace("Scan ExistingRDD", "")
