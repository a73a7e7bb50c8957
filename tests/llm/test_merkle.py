import hashlib
import zlib

import numpy as np
import pytest

from assay.llm import merkle as op
from helpers import SCHEMA, awkward, clashing, documents, prose


def digest(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def written(value):
    if value is None:
        return "-"
    text = str(value)
    return f"{len(text.encode())}:{text}"


def levels_over(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest(below[i : i + 16]) for i in range(0, len(below), 16)])
    return levels


def climb(levels, i, node):
    siblings = []
    for level in levels[:-1]:
        first = i - i % 16
        run = level[first : first + 16]
        others = run[: i - first] + run[i - first + 1 :]
        siblings += others
        node = digest(others[: i - first] + [node] + others[i - first :])
        i //= 16
    return siblings, node


def brute(rows):
    """Rows (doc_id, text, lang, source, n_chars) to sorted result rows."""
    low = str.maketrans(op._UPPER, op._UPPER.lower())

    def leaf(row, text):
        return digest(map(written, (row[0], row[3], row[2], row[4], text)))

    trees = {}
    for row in rows:
        trees.setdefault(row[3], []).append((row[0] is not None, row[0] or 0, leaf(row, row[1]), row))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    for members in trees.values():
        members.sort(key=lambda m: m[:3])
    grown = {s: levels_over([m[2] for m in trees[s]]) for s in order}
    top = levels_over([grown[s][-1][0] for s in order])
    out = []
    for k, source in enumerate(order):
        for i, (_, _, own, row) in enumerate(trees[source]):
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            node = leaf(row, row[1].translate(low)) if tampered and row[1] is not None else own
            one, node = climb(grown[source], i, node)
            two, node = climb(top, k, node)
            out.append((row[0], own, grown[source][-1][0], top[-1][0], digest(one + two), node, node == top[-1][0]))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_layout_is_recursive_and_whole():
    for height in range(1, 5):
        places = [op.address(height, level, np.arange(16**level)) for level in range(height)]
        assert sorted(np.concatenate(places).tolist()) == list(range(op.tree_size(height)))
    # Four levels: the upper two come first, then each lower subtree of two in one piece.
    lower = op.address(4, 3, np.arange(16)) - op.address(4, 2, np.arange(1))
    assert lower.tolist() == list(range(1, 17))
    assert op.address(4, 1, np.arange(16)).tolist() == list(range(1, 17))


def test_siblings_of_a_block():
    leaves = [hashlib.sha256(bytes([i % 256, i // 256])).digest() for i in range(700)]
    block = op.build_block(leaves, 3)
    levels = levels_over([x.hex() for x in leaves])
    inside = op.Siblings(block, 700)
    for leaf in (0, 15, 16, 255, 256, 688, 699):
        wanted, _ = climb(levels, leaf, leaves[leaf].hex())
        assert "".join(others.hex() for _, others in inside.of(leaf)) == "".join(wanted)
    assert block[:32].hex() == levels[-1][0]


@pytest.mark.parametrize("block_levels", [1, op.BLOCK_LEVELS])
def test_manifest(spark, monkeypatch, block_levels):
    """Blocks of one level make several tiers of blocks out of few rows."""
    monkeypatch.setattr(op, "BLOCK_LEVELS", block_levels)
    monkeypatch.setattr(op, "BLOCK_LEAVES", 16**block_levels)
    ids, texts = awkward()
    rows = [(i, t, "en", None if k % 4 == 0 else f"s{k % 3}", None if t is None else len(t)) for k, (i, t) in enumerate(zip(ids, texts))]
    rows += [(1000 + k, prose(k, 3).title(), "de", "big" if k % 2 else f"é{k % 40}", k) for k in range(900)]
    rows += [(5000, "Same Row", "en", "big", 8)] * 40 + [(6000 + k, "X", None, "sixteen", 1) for k in range(16)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(op.manifest(docs)) == brute(rows)


def test_long_text_other_columns_and_no_rows(spark):
    long = prose(9, 1_200_000).title()
    assert len(long.encode()) > 4_000_000
    rows = [(5, long, "en", None, 1)]
    assert found(op.manifest(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    assert op.manifest(clashing(spark, ["tree", "key", "leaf", "number"])).count() == 2
    assert op.manifest(documents(spark, [])).count() == 0
