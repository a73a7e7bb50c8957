import random

from assay.llm import licenses as op
from assay.llm.decontaminate import words_of
from helpers import awkward, clashing, documents


def brute(words):
    out = []
    for phrase, label in op.PHRASES.items():
        own = phrase.encode().split()
        out += [(i, label) for i in range(len(words) - len(own) + 1) if words[i : i + len(own)] == own]
    return sorted(out)


def test_automaton_finds_every_base_place():
    scan = op.LicenceScanner(op.PHRASES, op.TEMPLATES)
    rng = random.Random(1)
    vocabulary = "mit license apache general public gnu licensed under the version 2 0 released x".split()
    for _ in range(3000):
        words = [rng.choice(vocabulary).encode() for _ in range(rng.randint(0, 25))]
        assert sorted(scan(words)[0]) == brute(words)


def test_automaton_has_every_run_and_no_other():
    strings = [list("abcab"), list("cabd"), list("aaa")]
    auto = op.SuffixAutomaton(strings)
    runs = {tuple(s[i:j]) for s in strings for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    seen, open_ = set(), [(0, ())]
    while open_:
        state, run = open_.pop()
        for word, target in auto.next[state].items():
            seen.add((*run, word))
            open_.append((target, (*run, word)))
            ends = {(w, i + len(run) + 1) for w, s in enumerate(strings) for i in range(len(s)) if tuple(s[i : i + len(run) + 1]) == (*run, word)}
            assert set(auto.places[target]) == ends
    assert seen == runs


def test_chain_bridges_gaps_in_order():
    assert op.chain([(0, 5, 5), (7, 12, 10)], 8) == (10, 0, 12)
    assert op.chain([(0, 5, 10), (7, 12, 5)], 8)[0] == 5
    assert op.chain([(0, 5, 5), (50, 55, 10)], 8)[0] == 5


PLAIN = [
    "licensed under the terms",
    "it was released under the old king",
    "Licensed under the BSD license",
    "Released under the Apache License",
    "you may not use this file and you can redistribute it to the people",
    "of the software and to permit persons to whom it is known to do so",
    "the above copyright notice was torn down",
    "you should have received a copy of the book along with this letter",
    "this work is licensed under a new act of the house",
]


def test_plain_english_and_short_notices_add_no_label():
    scan = op.LicenceScanner(op.PHRASES, op.TEMPLATES)
    for text in PLAIN:
        base, spans, _ = scan(words_of(text.encode()))
        assert not spans, text
        assert {label for _, label in base} == ({"apache"} if "Apache License" in text else set())


def test_held_out_broken_notices_are_told_apart():
    """Every sixth word of a notice is lost or replaced, and prose stands before and after it."""
    scan = op.LicenceScanner(op.PHRASES, op.TEMPLATES)
    rng = random.Random(4)
    found = total = 0
    for label, texts in op.TEMPLATES.items():
        for text in texts:
            words = words_of(text.encode())
            if len(words) < 20:
                continue
            at = rng.randrange(6)
            broken = [rng.choice((b"xx", b"")) if i % 6 == at else w for i, w in enumerate(words)]
            said = b"once upon a time there was a river ".split() + [w for w in broken if w] + b"and so on".split()
            labels = {s[2] for s in scan(said)[1]}
            assert labels <= {label}, (label, labels)
            total += 1
            found += labels == {label}
    assert total > 12 and found / total >= 0.9


def test_broken_template_is_covered():
    text = op.TEMPLATES["bsd"][0].replace("binary forms", "xx forms")
    base, spans, score = op.LicenceScanner(op.PHRASES, op.TEMPLATES)(words_of(text.encode()))
    assert not base and [s[2] for s in spans] == ["bsd"] and 0.8 < score < 1


def test_awkward_rows(spark):
    ids, texts = awkward()
    texts[3] = "Released under the MIT License. MIT license"
    rows = op.scan_licences(documents(spark, texts, ids)).collect()
    assert len(rows) == len(texts)
    by = {r["doc_id"]: r["licence"] for r in rows}
    assert (by[4]["n_words"], by[4]["first_word"], by[4]["labels"], by[4]["score"]) == (0, None, [], 0.0)
    assert (by[1]["n_base"], by[1]["first_word"], by[1]["last_word"], by[1]["base_labels"]) == (2, 3, 5, ["mit"])
    docs = clashing(spark, ["n_words", "score", "licence"])
    assert op.scan_licences(docs, keep=("doc_id", "score")).columns == ["doc_id", "score", "licence"]
    assert op.scan_licences(documents(spark, [])).count() == 0
