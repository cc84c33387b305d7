import collections
import itertools
import random

import pytest

from tidemark.llm.pairs import associations, gather, numbered, pair_counts, wrong_weights

BASKET = "url string, quarter string, items array<string>, item string"


def made(spark, rows):
    return spark.createDataFrame([(u, q, i, "clash") for u, q, i in rows], BASKET)


def brute(rows, least):
    sets = collections.defaultdict(set)
    for u, _, items in rows:
        if u is not None:
            sets[u] |= {i for i in items or [] if i is not None}
    n = collections.Counter(i for s in sets.values() for i in s)
    pairs = collections.Counter(p for s in sets.values() for p in itertools.combinations(sorted(s), 2))
    return len(sets), {(a, b, k, n[a], n[b]) for (a, b), k in pairs.items() if k >= least}


@pytest.mark.parametrize("wide", [1000, 3])
def test_counts_equal_brute_force(spark, wide):
    rnd = random.Random(4)
    names = [f"n{i}" for i in range(12)] + ["Ä", "a, b"]
    rows = [(f"u{rnd.randrange(60)}" if rnd.random() > 0.05 else None, rnd.choice(["q1", "q2", None]), rnd.choice([None, [], [rnd.choice([*names, None]) for _ in range(rnd.randrange(7))]])) for _ in range(200)]
    rows += rows[:20] + [("hot", "q1", [rnd.choice(names)]) for _ in range(30)]
    baskets = gather(made(spark, rows), "url", "quarter", "items", wide=wide)
    numbers, words = numbered(baskets, 3)
    total, want = brute(rows, 3)
    assert baskets.total == total
    got = associations(numbers, words, baskets.total, 3)
    assert {(r.item_a, r.item_b, r.together, r.n_a, r.n_b) for r in got.collect()} == want
    r = got.first()
    assert r.lift == pytest.approx(r.together * total / (r.n_a * r.n_b))


def test_wide_baskets_by_join(spark):
    rows = spark.createDataFrame([(b, i, False) for b in (1, 2) for i in range(6)] + [(3, 0, False), (3, 1, False)], "basket long, item long, several boolean")
    key = lambda r: (r.item_a, r.item_b, r.together)
    assert sorted(map(key, pair_counts(rows, [], wide=3).collect())) == sorted(map(key, pair_counts(rows, []).collect()))


def test_wrong_weights(spark):
    rows = [("u1", "q1", ["A", "B"]), ("u2", "q1", ["B", "A", "C"]), ("u3", "q2", ["A", "B"]), ("u3", "q2", ["A", "B"])]
    edges = [("q1", "A", "B", 2), ("q1", "A", "B", 1), ("q2", "A", "B", 1), ("q1", "A", "C", None), ("q1", "A", "Z", 0), ("q1", "Y", "Z", 4), ("q2", "A", "C", 1)]
    e = spark.createDataFrame(edges, "part string, item_a string, item_b string, weight long")
    baskets = gather(made(spark, rows), "url", "quarter", "items")
    numbers, words = numbered(baskets, 99, e.selectExpr("explode(array(item_a, item_b)) as name"))
    assert {tuple(r) for r in wrong_weights(numbers, words, e).collect()} == {("q1", "A", "B"), ("q1", "A", "C"), ("q1", "Y", "Z"), ("q2", "A", "C")}


def test_empty(spark):
    baskets = gather(made(spark, []), "url", "quarter", "items")
    numbers, words = numbered(baskets, 1)
    assert baskets.total == 0 and associations(numbers, words, 0, 1).count() == 0
