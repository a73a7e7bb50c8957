import hashlib
import random

import numpy as np

from assay.llm import suffix_dedup as op
from assay.llm.induced import common_prefixes, suffix_array
from helpers import awkward, clashing, documents


def brute(texts):
    """Results of texts in order; a text's own earlier bytes come before it."""
    seen, out = set(), []
    for text in texts:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - 99):
            window = data[s : s + 100]
            if window in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.add(window)
        kept = bytes(x for x, g in zip(data, gone, strict=True) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed=5, n=120):
    rng = random.Random(seed)

    def noise(size):
        return "".join(rng.choice("abcde é\n") for _ in range(size))

    passages = [noise(rng.randint(90, 400)) for _ in range(6)]
    texts = []
    for _ in range(n):
        text = "".join(rng.choice(passages) if rng.random() < 0.4 else noise(rng.randint(0, 120)) for _ in range(rng.randint(0, 6)))
        if rng.random() < 0.1:
            text = noise(rng.randint(1, 12)) * rng.randint(1, 60)
        if rng.random() < 0.2 and texts:
            text = texts[-1]
        texts.append(text)
    return [*texts, None, "x" * 500, "x" * 99]


def found(df, **options):
    names = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
    return {r["doc_id"]: tuple(r[n] for n in names) for r in op.find_repeats(df, **options).collect()}


def test_suffix_arrays_and_common_prefixes():
    rng = random.Random(1)
    for _ in range(1500):
        k = rng.choice([1, 2, 3, 26])
        text = bytes(rng.randint(97, 96 + k) for _ in range(rng.randint(0, 40)))
        if rng.random() < 0.3:
            text = (text[: rng.randint(1, 5)] or b"a") * rng.randint(1, 12)
        data = np.frombuffer(text, np.uint8)
        order = sorted(range(len(text)), key=lambda i: text[i:])
        sa = suffix_array(data)
        assert sa.tolist() == order
        common = [0] * len(order)
        for r in range(1, len(order)):
            a, b = text[order[r - 1] :], text[order[r] :]
            common[r] = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert common_prefixes(data, sa).tolist() == common


def test_removals_match_brute_force(spark):
    texts = corpus()
    expected = dict(enumerate(brute(texts)))
    assert found(documents(spark, texts)) == expected
    # Every anchor hash of several segments by the way for hot ones.
    assert found(documents(spark, texts), shard_segments=1) == expected


def test_awkward_rows(spark):
    ids, texts = awkward()
    rows = op.find_repeats(documents(spark, texts, ids)).collect()
    assert len(rows) == len(texts)
    whole = sorted((r["doc_id"], r["n_removed"]) for r in rows if r["doc_id"] in (10, 11, 20))
    size = len(texts[4].encode())
    assert whole == [(10, 0), (11, size), (11, size), (20, 0), (20, len(texts[7].encode()))]
    assert next(r for r in rows if r["doc_id"] == 4)["kept_sha256"] == hashlib.sha256(b"").hexdigest()
    odd = clashing(spark, ["row", "body", "covers"])
    assert op.find_repeats(odd).count() == 2
    assert op.find_repeats(documents(spark, [])).count() == 0


def test_whole_texts_are_joined_once_however_often_segments_are_split(spark, monkeypatch):
    staged, seen = op.staged, []

    def watched(df, what, *more):
        seen.append((what, "body" in df._jdf.queryExecution().optimizedPlan().toString()))
        return staged(df, what, *more)

    monkeypatch.setattr(op, "staged", watched)
    texts = corpus(6, 60)
    assert found(documents(spark, texts), shard_segments=1) == dict(enumerate(brute(texts)))
    assert [what for what, body in seen if body] == ["segments", "pieces"] and len(seen) > 4
