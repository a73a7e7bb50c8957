import random

import public_tokenizers
import tokenizers

from assay.llm import token_counts as op
from helpers import awkward, clashing, documents, prose

PATH = public_tokenizers.path("byte_bpe_50k.json")


def wanted(texts):
    library = tokenizers.Tokenizer.from_file(PATH)
    return [len(library.encode(t or "", add_special_tokens=False).ids) for t in texts]


def test_counts_are_the_librarys():
    rng = random.Random(1)
    letters = " \n\t'srvtlemd  AÉ9٣!?''日　\xa0\x85\x1cx"
    texts = [
        "".join(rng.choice(letters) if rng.random() > 0.03 else "<|endoftext|>" for _ in range(rng.randint(0, 60)))
        for _ in range(1500)
    ]
    texts += ["a" * 3000, " " * 2000, "!" * 900 + "x", "é" * 900, prose(1, 4000), "it's we'll 'lx 'rex''s"]
    count = op.counter(op.load_vocabulary(PATH))
    assert count([t.encode() for t in texts]) == wanted(texts)


def test_splitter_is_the_same_across_chunks():
    step, emit = op.compile_splitter()
    classes = op.character_classes()
    text = "a  b\n\n c'll 12x " * 50
    kinds = classes[[ord(c) for c in text]]
    whole = op.split_starts(kinds, step, emit).tolist()
    state, slow = op.FRESH, set()
    for i, kind in enumerate(kinds):
        at = (state << 4) + int(kind)
        slow |= {i} if emit[at] & op.HERE else set()
        slow |= {i - 1} if emit[at] & op.BEFORE else set()
        state = int(step[at])
    assert whole == sorted(slow)


def test_awkward_rows(spark):
    ids, texts = awkward()
    rows = op.count_tokens(documents(spark, texts, ids), PATH, limit=100).collect()
    expected = sorted((len((t or "").encode()), n, n > 100) for t, n in zip(texts, wanted(texts), strict=True))
    assert sorted((r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows) == expected
    docs = clashing(spark, ["n_bytes", "c0", "body"])
    assert op.count_tokens(docs, PATH, keep=("doc_id", "c0")).columns == ["doc_id", "c0", "n_bytes", "n_tokens", "over_limit"]
    assert op.count_tokens(documents(spark, []), PATH).count() == 0


def test_few_places_are_tried_for_the_start_of_a_token():
    class Tried(dict):
        n = 0

        def get(self, *key):
            Tried.n += 1
            return super().get(*key)

    merger = op.Merger(op.load_vocabulary(PATH)["merges"])
    merger.id = Tried(merger.id)
    rng = random.Random(2)
    words = [("".join(rng.choice("abcdeghilmnorstu") for _ in range(rng.randint(4, 20)))).encode() for _ in range(500)]
    assert [merger(w) for w in words] == wanted([w.decode() for w in words])
    assert Tried.n < 4 * len(merger.token)
