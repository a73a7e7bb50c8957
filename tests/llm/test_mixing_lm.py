import math
import tracemalloc
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from assay.llm import mixing_lm as op
from assay.llm.hashing import Powers
from helpers import awkward, clashing, documents, prose

END = "\0"


def tokens(text):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", folded), END]


def brute(ids, texts):
    counts = Counter()
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i in ids]
    for h, text in zip(held, texts, strict=True):
        if not h:
            counts.update(tokens(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for h, text in zip(held, texts, strict=True):
        own = tokens(text)
        score = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own)
        out.append((h, len(own), sum(counts[t] > 0 for t in own), n, score))
    return out


def check(rows, expected):
    got = sorted((r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in rows)
    for a, b in zip(got, sorted(expected), strict=True):
        assert a[:4] == b[:4] and math.isclose(a[4], b[4], rel_tol=1e-9)


def test_base_scores_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(op, "HEAD", 25)  # most words are joined
    texts = [prose(i, 5 + i % 50, 90).upper() if i % 3 else prose(i, 30, 500) for i in range(90)]
    rows = op.score_texts(documents(spark, texts)).collect()
    check(rows, brute(range(90), texts))


def test_model_learns(spark):
    texts = [prose(5, 400, 40) if i % 2 else " ".join(prose(5, 60, 40).split()[i % 30 :]) for i in range(120)]
    rows = op.score_texts(documents(spark, texts)).collect()
    held = [r for r in rows if r["held_out"]]
    assert held and all(r["score"] < 0 for r in rows)
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_probabilities_of_all_continuations_sum_to_one():
    codes = op.Codes({b"ab": 5, b"c": 2}, 3, 4, {0x2061: 3, 0x6120: 2})
    for first in (0, codes.bytes_from + 97 * 256, codes.bytes_from + 32 * 256):
        last = codes.bytes_from if first == 0 else first + 256
        assert math.isclose(sum(2.0 ** -int(s) for s in codes.size[first:last]), 1.0)
    table = np.zeros((op.CONTEXTS, 1 << op.SLOT_BITS), np.int8)
    even = op.log_likelihood([[b"ab"]], codes, table, Powers())[0]
    bits = codes.size[codes.id[b"ab"]] + codes.size[codes.end]
    assert math.isclose(even, -math.log(2) * int(bits), rel_tol=1e-6)


def test_a_score_depends_on_no_other_text():
    codes = op.Codes({b"ab": 5, b"c": 2}, 3, 4, {0x2061: 3, 0x6120: 2})
    rng = np.random.default_rng(1)
    table = rng.integers(-60, 60, (op.CONTEXTS, 1 << op.SLOT_BITS)).astype(np.int8)
    texts = [[b"ab", b"zz"] * 90, [], [b"c"], [b"q" * 300, b"ab"]]
    together = op.log_likelihood(texts, codes, table, Powers())
    alone = [op.log_likelihood([t], codes, table, Powers())[0] for t in texts]
    assert np.allclose(together, alone, rtol=1e-6)


def test_awkward_rows(spark):
    ids, texts = awkward()
    rows = op.score_texts(documents(spark, texts, ids)).collect()
    check(rows, brute(ids, texts))
    assert op.score_texts(clashing(spark, ["row", "score", "rest"])).count() == 2
    assert op.score_texts(documents(spark, [])).count() == 0
    only_held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2]
    rows = op.score_texts(documents(spark, ["a b"] * len(only_held), only_held)).collect()
    assert {(r["n_known"], r["train_tokens"], r["base_score"]) for r in rows} == {(0, 0, 0.0)}


def test_weights_adapt_all_along_a_long_text():
    codes = op.Codes({b"ab": 5, b"c": 2}, 3, 4, {0x2061: 3, 0x6120: 2})
    units = op.Units([[b"ab"] * 6400], codes, Powers())
    assert np.diff(np.flatnonzero(np.diff(units.block))).max() <= 64
    assert units.block.max() == 100


def test_the_last_byte_before_and_the_word_so_far_are_contexts():
    codes = op.Codes({b"ab": 5, b"c": 2}, 3, 4, {0x2061: 3, 0x6120: 2})
    # Before the last word: other rare words with the same end, then one with another end.
    one, two, three = (op.Units([[b"ab", w, b"c"]], codes, Powers()) for w in (b"xq", b"yq", b"xr"))
    assert op.CONTEXTS == 4
    assert one.contexts[2][2] == two.contexts[2][2] != three.contexts[2][2]
    # Spelled bytes that only the first byte of the word tells apart.
    long = [op.Units([[w + b"mnopqr"]], codes, Powers()) for w in (b"x", b"y")]
    assert long[0].contexts[1][-1] == long[1].contexts[1][-1]
    assert long[0].contexts[2][-1] != long[1].contexts[2][-1]


def test_odds_are_those_of_the_context_and_node_alone():
    codes = op.Codes({bytes([97 + i]): 9 + i for i in range(12)}, 3, 4, {0x2061: 3, 0x6120: 2})
    rng = np.random.default_rng(2)
    pairs = sorted({(int(c) << op.SYMBOL_BITS, int(s)) for c, s in zip(rng.integers(0, 40, 300), rng.integers(0, 14, 300), strict=True)})
    context, symbol = np.array(pairs).T
    n = rng.integers(0, 2**33, len(pairs))  # counts beyond 32 bits
    odds, first = op.context_odds(codes, op.pair_keys(context.astype(np.uint64), symbol), n)
    bits = Counter()
    path = lambda s: [(int(codes.node[i]), int(codes.bit[i])) for i in range(codes.first[s], codes.first[s] + codes.size[s])]
    for (c, s), times in zip(pairs, n.tolist(), strict=True):
        for node, bit in path(s):
            bits[c, node, bit] += times
    for (c, s), start in zip(pairs, first.tolist(), strict=True):
        for i, (node, _) in enumerate(path(s)):
            expected = round(16 * math.log((bits[c, node, 1] + 0.4) / (bits[c, node, 0] + 0.4)))
            assert abs(int(odds[start + i]) - max(-127, min(127, expected))) <= 1


def test_contexts_share_no_odds_however_many_there_are():
    codes = op.Codes({bytes([97 + i]): 9 + i for i in range(12)}, 3, 4, {0x2061: 3, 0x6120: 2})
    rng = np.random.default_rng(3)
    many = 1 << 21  # more contexts than a table of 2**20 slots tells apart
    context = np.unique(rng.integers(0, 1 << 46, many)).astype(np.uint64) << np.uint64(op.SYMBOL_BITS)
    many = len(context)
    symbol = rng.integers(0, 12, many)
    pairs = op.pair_keys(context, symbol)
    odds, first = op.context_odds(codes, pairs, np.ones(many, np.int64))
    known = op.PairOdds(pairs, odds.tobytes(), codes)
    assert (known.starts(pairs) == first).all()
    sure = codes.bit[codes.first[symbol]] == 1
    assert ((odds[first] > 0) == sure).all()
    assert (known.starts(pairs + np.uint64(100)) == len(odds)).all()


def test_scores_in_slices_are_those_in_one(spark, monkeypatch):
    monkeypatch.setattr(op, "HEAD", 25)
    texts = [prose(i % 7, 5 + i % 50, 90) for i in range(80)] + [None, ""]
    whole = {r["doc_id"]: r["score"] for r in op.score_texts(documents(spark, texts)).collect()}
    monkeypatch.setattr(op, "SLICE_BYTES", 500)
    cut = {r["doc_id"]: r["score"] for r in op.score_texts(documents(spark, texts)).collect()}
    assert whole.keys() == cut.keys() and all(math.isclose(whole[i], cut[i], rel_tol=1e-5) for i in whole)


def test_pairs_travel_packed_by_slice_and_range():
    codes = op.Codes({bytes([97 + i]): 9 + i for i in range(12)}, 3, 4, {0x2061: 3, 0x6120: 2})
    texts = [prose(i, 400, 90).encode() for i in range(40)]

    class Shared:
        value = codes

    rows = lambda k: [t for i, t in enumerate(texts) if i % 2 == k]
    bodies = lambda k: pa.table({"slice": [k] * 20, "body": pa.array(rows(k), pa.binary()), "trained": [i % 3 > 0 for i in range(20)]})
    asked = pa.concat_tables([op._count_contexts(Shared, 5)(bodies(k)) for k in (0, 1)])
    assert asked.num_rows == 10  # one row for a slice and range, however many pairs it has
    units = [op.Units([op.tokens_of(t) for t in rows(k)], codes, Powers()) for k in (0, 1)]
    held = sum(len(np.unique(op.pairs_of(u))) for u in units)
    assert sum(len(b) for c in ("pairs", "times") for b in asked[c].to_pylist()) < 8 * held
    numbers = asked["range"].to_numpy()
    answers = pa.concat_tables([op._answer(Shared)(asked.filter(numbers == r)) for r in (4, 2, 0, 1, 3)])
    times = [np.tile(np.array([i % 3 > 0 for i in range(20)], np.int64)[u.text], 3) for u in units]
    pairs, n = op.summed(np.concatenate([op.pairs_of(u) for u in units]), np.concatenate(times))
    odds, first = op.context_odds(codes, pairs, n)
    for k in (0, 1):
        own = answers.filter(answers["slice"].to_numpy() == k)
        known = op.odds_of_slice(rows(k), own, codes, Powers())
        wanted = np.unique(op.pairs_of(units[k]))
        assert (known.keys == wanted).all()
        for pair, at in zip(wanted, known.starts(wanted), strict=True):
            begin, size = first[np.searchsorted(pairs, pair)], codes.size[op.symbols_of(pair[None])[0]]
            assert (known.odds[at : at + size] == odds[begin : begin + size]).all()


def test_scoring_holds_little_beside_the_odds():
    codes = op.Codes({bytes([97 + i]): 9 + i for i in range(12)}, 3, 4, {0x2061: 3, 0x6120: 2})
    texts = [prose(i, 700, 700).encode() for i in range(250)]
    bodies = pa.array(texts, pa.binary())
    numbers = pa.array(range(250), pa.int64())
    asked = pa.table({"slice": [0] * 250, "row": numbers, "key": numbers, "body": bodies, "trained": [True] * 250})

    class Shared:
        value = codes

    class Model:
        value = codes, np.zeros(int(codes.node.max()) + 1, np.int8), np.ones(codes.bytes_from)

    found = op._count_contexts(Shared, 1)(asked)
    answers = op._answer(Shared)(found)
    scored = op._score_slice(Model)(asked, answers)
    tracemalloc.start()
    again = op._score_slice(Model)(asked, answers)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert again.equals(scored) and scored.num_rows == 250
    assert 900_000 < sum(map(len, texts)) < 1_100_000 and most < 500 * 2**20


def test_parts_joined_are_those_summed_at_once(monkeypatch):
    monkeypatch.setattr(op, "STEP_PAIRS", 50)
    rng = np.random.default_rng(4)
    parts = [(np.sort(rng.integers(0, 200, 30)).astype(np.uint64), rng.integers(0, 2**33, 30)) for _ in range(20)]
    at_once = op.summed(*(np.concatenate(c) for c in zip(*parts, strict=True)))
    for some in (parts, parts[:1]):
        pairs, n = op.gathered(iter(some), op.summed)
        wanted = at_once if some is parts else op.summed(*some[0])
        assert (pairs == wanted[0]).all() and (n == wanted[1]).all()
    (alone,) = op.gathered(((p,) for p, _ in parts), lambda x: (op.distinct(x),))
    assert (alone == at_once[0]).all()
    trained = rng.random(30) < 0.6
    for known in (trained, trained & False, trained | True):
        pairs, n = op.counted_once(parts[0][0], known)
        wanted = op.summed(parts[0][0], known.astype(np.int64))
        assert (pairs == wanted[0]).all() and (n == wanted[1]).all()


def test_texts_and_token_counts_travel_compressed():
    texts = [prose(i, 300, 4000) for i in range(64)] + [None, ""]
    bodies = pa.array([t and t.encode() for t in texts], pa.binary())
    numbers = pa.array(range(66), pa.int64())
    keys = pa.array([None, *map(str, range(65))], pa.string())
    batch = pa.record_batch([pa.array([i // 16 % 3 for i in range(66)]), numbers, keys, bodies], names=["slice", "row", "key", "body"])
    sent = pa.Table.from_batches(op._pack_texts(iter([batch.slice(0, 40), batch.slice(40)])))
    assert sent.num_rows == 6 and sum(map(len, sent["rows"].to_pylist())) < 0.6 * sum(len((t or "").encode()) for t in texts)
    for k in range(3):
        rows = op.texts_of(sent.filter(sent["slice"].to_numpy() == k))
        assert rows.equals(pa.Table.from_batches([batch]).filter(batch["slice"].to_numpy() == k).combine_chunks())
    counted = pa.Table.from_batches(op._count_tokens(5)(iter([pa.record_batch([bodies], names=["body"])] * 2)))
    found = pa.concat_tables([op._sum_tokens(counted.filter(counted["range"].to_numpy() == r)) for r in range(5)])
    wanted = Counter(t for x in texts for t in op.tokens_of((x or "").encode()))
    assert counted.num_rows == 5 and found.num_rows == len(wanted)
    assert dict(zip(*found.to_pydict().values(), strict=True)) == {t: 2 * n for t, n in wanted.items()}
    assert sum(len(b) for c in ("tokens", "times") for b in counted[c].to_pylist()) < 8 * len(wanted)
    assert list(op._count_tokens(5)(iter([])))[0].num_rows == 0
