import datetime as dt
import random

import pyarrow as pa
import pytest

from tidemark.operators.finger import FingerTree, add_all
from tidemark.operators.known import attributes_as_known
from tidemark.operators.late import late_corrected

D0 = dt.datetime(2021, 1, 1)


def day(n, hours=0):
    return D0 + dt.timedelta(days=n, hours=hours)


def brute(events, versions, series):
    out = set()
    for e, t in {x for x in events if None not in x}:
        row = []
        for s in series:
            known = [(r1 or dt.datetime.min, r2 or dt.datetime.min, p or "") for ve, vs, k, r1, r2, p in versions if ve == e and vs == s and k is not None and k <= t]
            row.append(max(known)[2] if known else None)
        out.add((e, t, *row))
    return out


@pytest.mark.parametrize("slice_rows", [200_000, 5])
def test_as_known_equals_brute_force(spark, slice_rows):
    rnd = random.Random(5)
    ents = ["A", "B", "hot", "hot", "hot", None]
    events = [(rnd.choice(ents), rnd.choice([None, *[day(rnd.randrange(60), rnd.randrange(24)) for _ in range(9)]])) for _ in range(150)]
    versions = [(rnd.choice(ents), rnd.choice(["x", "y", None]), rnd.choice([None, *[day(rnd.randrange(60))] * 5]), day(rnd.randrange(9)), day(rnd.randrange(60)), f"v{i}") for i in range(120)]
    versions += versions[:10]
    ev = spark.createDataFrame(events, "entity string, at timestamp")
    ve = spark.createDataFrame(versions, "entity string, series string, known timestamp, r1 timestamp, r2 timestamp, payload string")
    got = {tuple(r) for r in attributes_as_known(ev, ve, ["x", "y"], slice_rows).collect()}
    assert got == brute(events, versions, ["x", "y"])


def test_as_known_empty_tables(spark):
    ev = spark.createDataFrame([("A", day(1))], "entity string, at timestamp")
    ve = spark.createDataFrame([], "entity string, series string, known timestamp, r1 timestamp, r2 timestamp, payload string")
    assert [tuple(r) for r in attributes_as_known(ev, ve, ["x"]).collect()] == [("A", day(1), None)]
    assert attributes_as_known(ev.limit(0), ve, ["x"]).count() == 0


def test_finger_tree_against_list():
    rnd = random.Random(3)
    tree, rows, floor = FingerTree(), [], 0
    for i in range(4000):
        t = max(floor, rnd.choice([i, i - rnd.randrange(50), i - rnd.randrange(2000)]))
        tree.insert(t, (1, t * 2))
        rows.append((t, (1, t * 2)))
        if i % 500 == 499:
            floor = i - 1500
            tree.evict(floor)
            rows = [r for r in rows if r[0] >= floor]
            assert tree.left.times[0] == min(t for t, _ in rows) and tree.right.times[-1] == max(t for t, _ in rows)
        if i % 97 == 0:
            lo = rnd.randrange(4000)
            hi = lo + rnd.randrange(600)
            assert tree.total(lo, hi) == add_all([v for t, v in rows if lo <= t < hi])
    tree.evict(10**6)
    assert tree.items() == [] and tree.total(0, 10**7) is None
    tree.insert(5, (1, 1))
    assert tree.total(0, 9) == (1, 1)


LAKE = "entity string, event_time timestamp, knowledge_time timestamp, content_hash string, shares double"


def test_late_hand_case(spark):
    def row(e, et, kt, h, s):
        return (e, et, kt, h, s)

    rows = [
        row("A", day(3), day(4), "aa", 10.0),
        row("A", day(3), day(90), "aa", 10.0),  # sent again: counts once, in time
        row("A", day(5), day(35, 1), "bb", 5.0),  # January ends on day 31: from day 36 on a row corrects
        row("A", day(6), day(36), "cc", 7.0),
        row("A", day(7), day(91), "dd", 1.0),  # from day 91 on it is dropped
        row("A", day(8), day(90, 23), "ee", None),
        row("A", day(9), day(2), "ff", 100.0),  # later than its knowledge
        row(None, day(3), day(40), "0g", 2.0),
        row("B", None, day(40), "0h", 2.0),
        row("B", day(3), day(40), None, 2.0),
        row("B", day(3), day(40), None, 2.0),
    ]
    got = {tuple(r) for r in late_corrected(spark.createDataFrame(rows, LAKE), "month", 5, 60, "shares").fillna(-1.0, ["published_total"]).collect()}
    jan = dt.date(2021, 1, 1)
    assert got == {
        ("A", jan, "final", 4, 22.0, 15.0), ("A", jan, "corrected", 2, 22.0, 15.0), ("A", jan, "dropped", 1, 1.0, got_nan(got)),
        (None, jan, "final", 1, 2.0, 0.0), (None, jan, "corrected", 1, 2.0, 0.0), ("B", jan, "final", 2, 4.0, 0.0), ("B", jan, "corrected", 2, 4.0, 0.0),
    }
    assert late_corrected(spark.createDataFrame([], LAKE), "month", 5, 60, "shares").count() == 0


def got_nan(got):
    return next(r[5] for r in got if r[2] == "dropped")


def test_latest_known_handles_null_ranks():
    from tidemark.operators.known import latest_known

    ev = pa.table({"entity": ["A"], "at": [5]})
    ve = pa.table({"entity": ["A", "A"], "series": ["x", "x"], "known": [1, 2], "r1": pa.array([None, 1], pa.int64()), "r2": [1, 1], "payload": ["a", "b"]})
    assert latest_known(ev, ve, ["x"]).column("x").to_pylist() == ["b"]


def test_late_outcomes_follow_the_tree():
    """Against the rule in closed form; and without eviction nothing is dropped, without the tree's totals nothing corrected."""
    from unittest import mock

    from tidemark.operators.late import period_of, run_entity

    rnd = random.Random(11)
    rows = sorted((d + rnd.choice([0, 3, 20, 40, 45, 70, 95, 200]), d, 1, float(rnd.randrange(9))) for d in (rnd.randrange(900) for _ in range(800)))
    want = {}
    for known, d, n, v in rows:
        start, end = period_of(d, "quarter")
        phase = (known >= end + 46) + (known >= end + 150)
        want.setdefault(start, [[0, 0.0], [0, 0.0], [0, 0.0]])
        want[start][phase][0] += n
        want[start][phase][1] += v
    plain = set()
    for s, ((n0, v0), (n1, v1), (n2, v2)) in want.items():
        plain |= {(s, "final", n0 + n1, v0 + v1, v0)} if n0 + n1 else set()
        plain |= {(s, "corrected", n1, v0 + v1, v0)} if n1 else set()
        plain |= {(s, "dropped", n2, v2)} if n2 else set()
    cut_nan = lambda out: {r[:4] if r[1] == "dropped" else r for r in out}
    assert cut_nan(run_entity(rows, "quarter", 46, 150)) == plain
    with mock.patch.object(FingerTree, "evict", lambda self, before: None):
        assert not [r for r in run_entity(rows, "quarter", 46, 150) if r[1] == "dropped"]
    with mock.patch.object(FingerTree, "total", lambda self, low, high: None):
        assert not [r for r in run_entity(rows, "quarter", 46, 150) if r[1] == "corrected"]


def test_as_known_of_an_entity_with_many_versions_and_few_events(spark):
    """Versions are sliced as well as events; those of one moment are settled before."""
    rnd = random.Random(8)
    events = [("hot", day(60 + i * 5, i)) for i in range(12)] + [("A", day(70))]
    versions = [("hot", rnd.choice("xy"), day(rnd.randrange(120), rnd.choice([0, 7])), day(rnd.randrange(9)), day(rnd.randrange(60)), f"v{i}") for i in range(900)]
    versions += [("hot", "x", day(61), day(3), day(4), f"tie{i}") for i in range(50)] + [("A", "x", day(1), day(1), day(1), "a")]
    ev = spark.createDataFrame(events, "entity string, at timestamp")
    ve = spark.createDataFrame(versions, "entity string, series string, known timestamp, r1 timestamp, r2 timestamp, payload string")
    for slice_rows, buckets in ((40, 3), (200_000, 3)):
        got = {tuple(r) for r in attributes_as_known(ev, ve, ["x", "y"], slice_rows, buckets=buckets).collect()}
        assert got == brute(events, versions, ["x", "y"])


def test_slices_of_a_hot_entity_stay_near_their_size(spark):
    from tidemark.operators.known import _slice_bounds

    times = spark.range(10_000).selectExpr("'hot' as entity", "id * 1000 as t").unionByName(spark.range(50).selectExpr("'A' as entity", "id as t"))
    (row,) = _slice_bounds(times, 1000).collect()
    assert row.entity == "hot" and len(row.starts) == 9
    edges = [0, *row.starts, 10**8]
    assert all(900 <= (b - a) / 1000 <= 1100 for a, b in zip(edges, edges[1:-1]))
