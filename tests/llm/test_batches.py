import datetime as dt
import random

import pytest

from tidemark.llm.batches import PivotHistory, repeats

SCHEMA = "row_id long, entity string, event_time timestamp, knowledge_time timestamp, content_hash string, owner_name string, txn_code string, acq_disp string, is_derivative boolean, security_title string, shares double, price double, shares_after double, key string, p1 double"
D = dt.datetime(2021, 3, 1)


def row(i, h="", entity="T", at=0, known=48, owner="SMITHSON JOHN A", code="S", acq="D", deriv=False, title="Common Stock", shares=1234.0, price=10.1234, after=5000.0):
    return (i, entity, None if at is None else D + dt.timedelta(hours=at), D + dt.timedelta(hours=known), h or f"{i:02x}", owner, code, acq, deriv, title, shares, price, after, "clash", 0.0)


def dups(spark, rows, **kw):
    return {tuple(r) for r in repeats(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_each_difference_of_reporting(spark):
    first = row(1)
    same = [
        row(2, at=-5), row(3, at=17), row(4, at=48, known=900), row(5, shares=None), row(6, shares=1230.0), row(7, price=10.12), row(8, after=None), row(9, after=5050.0), row(10, code="s", acq=None),
        row(11, code=None, title="Com Stk"), row(12, owner="J. A. Smithson"), row(13, owner=None), row(14, h="01"), row(15, shares=None, after=None), row(16, at=12, code="", shares=1200.0, owner="Smihtson John"),
    ]
    assert dups(spark, [first, *same]) == {(1, i) for i in range(2, 17)}


def test_separate_transactions(spark):
    others = [
        row(2, shares=2234.0, after=7000.0), row(3, price=10.2, after=None), row(4, at=24), row(5, owner="SMITHSON MARY B", price=0.0), row(6, owner="JONES PETER", price=0.0, after=100.0), row(7, entity="U"), row(8, deriv=True),
        row(9, title="Restricted Stock Units"), row(10, code="P"), row(11, after=9000.0), row(12, price=None),
    ]
    assert dups(spark, [row(1), *others]) == set()


def test_nulls_and_empty(spark):
    bare = (None,) * 15
    rows = [bare, bare, row(1, entity=None), row(2, entity=None, h="01"), row(3, at=None), row(4, at=None, h="aa"), (5, *bare[1:])]
    assert dups(spark, rows) == {(1, 2)}
    assert dups(spark, []) == set()


def made(n, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(1, n + 1):
        if rows and rnd.random() < 0.3:
            base = list(rnd.choice(rows))
            base[0] = i
            base[4] = rnd.choice([base[4], f"d{i}"])
            if base[4] == f"d{i}":
                base[10] = rnd.choice([base[10], None])
                base[2] = base[2] + dt.timedelta(hours=rnd.choice([0, -5, 12]))
            base[3] = D + dt.timedelta(days=9, hours=i)
            rows.append(tuple(base))
        else:
            rows.append(row(i, at=24 * rnd.randrange(3), known=50 + i, shares=float(rnd.randrange(100, 9999)), price=round(rnd.uniform(9, 11), 4), after=float(rnd.randrange(9999)), owner=rnd.choice(["SMITHSON JOHN A", "JONES PETER B"])))
    return rows


def test_crowded_cells_equal_plain_ones(spark):
    from tidemark.llm.batches import near_links, pivot_table

    table = pivot_table(spark.createDataFrame(made(150, 2), SCHEMA))
    assert sorted(map(tuple, near_links(table, table, crowd=2).collect())) == sorted(map(tuple, near_links(table, table).collect()))


@pytest.mark.parametrize("seed", [1])
def test_batches_equal_bulk(spark, tmp_path, seed):
    rows = made(90, seed)
    history = PivotHistory(spark, f"file://{tmp_path}/history")
    got = set()
    for a in range(0, 90, 30):
        got |= {tuple(r) for r in history.clear(spark.createDataFrame(rows[a : a + 30], SCHEMA)).collect()}
    assert got == dups(spark, rows)
