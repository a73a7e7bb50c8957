"""Operators against plain Python on random, skewed input."""

import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal

import pytest

from assay.operators import densify, identity, lineage, measures
from conftest import rows


@pytest.mark.parametrize("seed", [1, 2])
def test_parties(spark, seed):
    rng = random.Random(seed)

    def email():
        chosen = rng.choice([None, "a@x", "B@x", "b@X", "hot@x", "HOT@x", f"{rng.randrange(30)}@x"])
        return chosen and f" {chosen}"

    pos, web = [(i, email()) for i in range(80)], [(i, email()) for i in range(60)]
    expected = {}
    for system, accounts in ((0, pos), (1, web)):
        for member, address in accounts:
            key = address.strip().lower() if address else f"{('POS', 'WEB')[system]}:{member}"
            expected.setdefault(key, ([], []))[system].append(member)
    sides = [
        identity.members(spark.createDataFrame(side, "id long, email string"), "id", "email") for side in (pos, web)
    ]
    parties = identity.resolve_parties(*sides)
    found = rows(parties, "party_key", "pos_id", "pos_accounts", "web_id", "web_accounts")
    assert found == sorted(
        ((k, min(p, default=None), len(p), min(w, default=None), len(w)) for k, (p, w) in expected.items()), key=repr
    )


@pytest.mark.parametrize("seed", [3, 4])
def test_dense_series(spark, seed):
    rng = random.Random(seed)
    published = {
        (key, dt.date(2024, 1, 1) + dt.timedelta(days=n)): Decimal(rng.randrange(100))
        for key in "abc"
        for n in rng.sample(range(40), 12)
    }
    last = max(day for _, day in published)
    expected = []
    for key in "abc":
        day, value = min(d for k, d in published if k == key), None
        while day <= last:
            value = published.get((key, day), value)
            expected.append((key, day, value, (key, day) not in published))
            day += dt.timedelta(days=1)
    df = spark.createDataFrame([(k, d, v) for (k, d), v in published.items()], "k string, day date, v decimal(10,0)")
    assert rows(densify.densify_daily(df, "k", "day", "v"), "k", "day", "v", "is_carried") == sorted(expected, key=repr)


def test_measures_through_a_hot_relationship(spark):
    rng = random.Random(5)
    facts = [(0 if i % 3 == 0 else rng.randrange(9), rng.randrange(100)) for i in range(500)]
    segment = {key: f"s{key % 3}" for key in range(8)}
    expected = defaultdict(lambda: [0, 0])
    for key, amount in facts:
        expected[segment.get(key)][0] += amount
        expected[segment.get(key)][1] += 1
    model = measures.Model(
        {
            "f": spark.createDataFrame(facts, "k int, amount long"),
            "d": spark.createDataFrame(list(segment.items()), "k int, segment string"),
        },
        {"f": [measures.sum_of("total", "amount"), measures.count_rows("n")]},
        [measures.Relationship("f", "k", "d", "k")],
    )
    assert rows(model.summarize("f", ["d.segment"])) == sorted(
        ((k, total, n) for k, (total, n) in expected.items()), key=repr
    )


def test_trace_distances(spark, folder):
    rng = random.Random(6)
    edges = {(f"n{rng.randrange(14)}", f"n{rng.randrange(14)}") for _ in range(26)}
    expected = set()
    for start in ("n1", "n2", "n3"):
        seen, level, distance = {start}, {start}, 0
        while level:
            distance += 1
            level = {s for s, t in edges if t in level} - seen
            seen |= level
            expected |= {(start, node, distance) for node in level}
    df = spark.createDataFrame(list(edges), "source string, target string")
    starts = spark.createDataFrame([("n1",), ("n2",), ("n3",)], "node string")
    assert rows(lineage.trace_upstream(df, starts, folder)) == sorted(expected, key=repr)


def test_origins_of_repeated_null_and_cyclic_edges(spark, folder):
    rng = random.Random(8)
    # A feeds B feeds C, each also among themselves; nothing feeds the o's.
    edges = [(f"a{rng.randrange(12)}", f"b{rng.randrange(12)}") for _ in range(16)]
    edges += [(f"b{rng.randrange(12)}", f"c{rng.randrange(12)}") for _ in range(16)]
    edges += [(f"{k}{rng.randrange(12)}", f"{k}{rng.randrange(12)}") for k in "abc" for _ in range(5)]
    edges += [(f"o{rng.randrange(4)}", f"{rng.choice('abc')}{rng.randrange(12)}") for _ in range(14)]
    edges += [(None, "a3"), (None, "c1"), ("b1", "c1"), ("a3", "b1"), ("c2", None), ("p", "q"), ("q", "p"), ("q", "c4")]
    edges += edges[::3]
    nodes = [f"c{i}" for i in range(12)] + ["b1", "a3", "o1", "p", "c4", "elsewhere", None]
    fed = {target for _, target in edges} - {None}
    expected = set()
    for start in set(nodes) - {None}:
        seen, level, distance = {start}, {start}, 0
        while level:
            distance += 1
            level = {s for s, t in edges if t is not None and t in level} - seen
            seen |= level
            expected |= {(start, node, distance) for node in level - fed}
    assert any(origin is None for _, origin, _ in expected) and len({d for *_, d in expected}) > 2
    df = spark.createDataFrame(edges, "source string, target string")
    starts = spark.createDataFrame([(node,) for node in nodes], "node string")
    assert rows(lineage.trace_to_sources(df, starts, folder)) == sorted(expected, key=repr)
