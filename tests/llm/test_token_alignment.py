import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest

from assay.llm import token_alignment as op
from assay.llm.common import ARROW_BYTES
from helpers import awkward, clashing, documents, prose

PATHS = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
DIGESTS = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")
NOTHING = (0, 0, 0, 0, "")
PIECES = list("ab c  \n\t'sté\xa0日\U0001f9ff<>▁|.") + [
    "<|endoftext|>", "</s>", "<0x41>", "hello ", " the", " world", "　", " ", "\r\n", "́", "ﬁ", "\x00", "\x7f",
]


@pytest.fixture(scope="module")
def tokenizers():
    return op.TokenizerA(PATHS[0]), op.TokenizerB(PATHS[1])


def brute(tokenizers, text):
    """(digests, links as pairs of ids) of one text, encoded whole and compared token by token."""
    if not text:
        return NOTHING, []
    one, two = tokenizers
    a = one.library.encode(" " + text, add_special_tokens=False).ids
    b = two.library.encode(text)
    spans = []
    for table, ids in ((one.bytes, a), (two.bytes, b)):
        at, found = 0, []
        for i in ids:
            found.append((at, at + len(table[i])))
            at += len(table[i])
        if b"".join(table[i] for i in ids) != (" " + text).encode():
            return NOTHING, []
        spans.append(found)
    links = [(x, y) for x, (s, e) in zip(a, spans[0]) for y, (t, f) in zip(b, spans[1]) if max(s, t) < min(e, f)]
    both = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
    groups, start = [], 0
    for end in both:
        parts = [",".join(str(i) for i, (s, e) in zip(ids, found) if start < e <= end) for ids, found in zip((a, b), spans)]
        groups.append("|".join(parts))
        start = end
    return (len(a), len(b), len(groups), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest()), links


def wanted(tokenizers, texts):
    each = [brute(tokenizers, t) for t in texts]
    counts = Counter(pair for _, links in each for pair in set(links))
    best = {}
    for (a, _), n in counts.items():
        best[a] = max(best.get(a, 0), n)
    return sorted(
        (*digests, sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links)) for digests, links in each
    )


def found(df):
    return sorted((*[r[c] for c in DIGESTS], r["n_best"], r["count_sum"]) for r in df.collect())


def noise(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(1, 50))) for _ in range(n)]


def test_alignment_is_that_of_whole_texts(tokenizers):
    texts = [None, "", " ", "  ", "a ", *noise(1, 1500), prose(1, 300), "a  b   c\n d \U0001f9ff\U0001f9ff x"]
    made = op.align_slice([t.encode() if t else None for t in texts], op.Aligner(*PATHS))
    for i, text in enumerate(texts):
        assert tuple(made[c][i] for c in DIGESTS) == brute(tokenizers, text)[0], repr(text)


@pytest.mark.parametrize("block_pairs", [op.BLOCK_PAIRS, 300])
def test_counts_over_all_documents(spark, tokenizers, monkeypatch, block_pairs):
    ids, texts = awkward()
    texts = [t[:900] if t else t for t in texts]
    texts += noise(2, 60)
    ids += range(100, 160)
    monkeypatch.setattr(op, "HELD_PAIRS", 50)
    df = op.align_tokens(documents(spark, texts, ids), *PATHS, block_pairs=block_pairs)
    assert found(df) == wanted(tokenizers, texts)
    assert sorted(df.select("doc_id").collect(), key=str) == sorted([(i,) for i in ids], key=str)


def test_long_text_clashing_names_and_no_rows(spark):
    long = prose(4, 900_000)
    assert len(long.encode()) > 4_000_000
    row = op.align_tokens(documents(spark, [long]), *PATHS).first()
    assert row["n_links"] == row["n_a"] + row["n_b"] - row["n_groups"] and row["n_groups"] > 900_000
    docs = clashing(spark, ["n_a", "sums", "c0", "t"])
    assert op.align_tokens(docs, *PATHS, keep=("doc_id", "sums")).columns[:2] == ["doc_id", "sums"]
    assert op.align_tokens(documents(spark, []), *PATHS).count() == 0


def test_chunks_of_later_slices_are_not_encoded_again(tokenizers, monkeypatch):
    monkeypatch.setattr(op, "MEMORY", 120)
    aligner, encoded = op.Aligner(*PATHS), []
    encode = aligner.a.encode
    aligner.a.encode = lambda chunks: encoded.append(sum(map(len, chunks))) or encode(chunks)
    texts = [prose(5, 300), "x" * 100 + " " + prose(5, 200), *noise(6, 40), prose(5, 100), prose(7, 400, 100), prose(5, 300)]
    for text in texts:
        made = op.align_slice([text.encode()], aligner)
        assert tuple(made[c][0] for c in DIGESTS) == brute(tokenizers, text)[0], repr(text)
        counted = op._documents_of_pairs(op.packed(made, 0, 1))
        wanted_pairs = sorted({a << 32 | b for a, b in brute(tokenizers, text)[1]})
        assert counted[0][counted[1] > 0].tolist() == wanted_pairs
        assert len(aligner.place) == len(aligner.known.words) == len(aligner.again)
        assert max(map(len, aligner.place)) <= op.REMEMBERED_BYTES
    # The second text brings one chunk that the first has not.
    assert encoded[1] < 110 < encoded[0]


def test_links_are_not_handed_back_by_the_last_pass(spark):
    plan = op.align_tokens(documents(spark, [prose(8, 50)]), *PATHS)._jdf.queryExecution().optimizedPlan().toString()
    passed = next(line for line in plan.splitlines() if "MapInArrow" in line)
    assert "n_links" in passed.split("[")[-1] and "at_code" not in passed.split("[")[-1]


def test_links_go_to_python_in_small_batches(spark, tokenizers, monkeypatch):
    before, passes, write = spark.conf.get(ARROW_BYTES), {}, op.staged

    def staged(df, what, *more):
        passes[what] = spark.conf.get(ARROW_BYTES), df.columns
        return write(df, what, *more)

    monkeypatch.setattr(op, "staged", staged)
    monkeypatch.setattr(op, "BATCH_BYTES", 1000)
    texts = [None, prose(9, 200), *noise(9, 20), prose(9, 200)]
    df = op.align_tokens(documents(spark, texts), *PATHS)
    assert {limit for limit, _ in passes.values()} == {"1000"} and spark.conf.get(ARROW_BYTES) == before
    # What is left for the caller's run, under its own limit, asks for no links.
    assert "at_code" not in passes["summed"][1]
    assert "at_code" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert found(df) == wanted(tokenizers, texts)
