"""Point-in-time operators on hand-computed cases, and the rule that nothing known later is seen."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import asof, channels, graph, tasks, windows
from tidemark.provenance import SAFE, is_historical_safe, pit_class, registry, strict


def t(text):
    return dt.datetime.fromisoformat(text)


RELEASES = [("GDP", "2021-01-01", "2021-04-29", 2.1), ("GDP", "2021-01-01", "2021-05-27", 1.9), ("GDP", "2021-04-01", "2021-07-29", 6.5)]
AGAIN = [("GDP", "2021-01-01", "2021-09-30", 1.8), ("GDP", "2021-04-01", "2021-09-30", 6.7)]


def releases(spark, rows):
    return spark.createDataFrame([(e, t(a), t(k), v, k) for e, a, k, v in rows], "entity string, event_time timestamp, knowledge_time timestamp, value double, vintage_id string")


def test_vintages(spark):
    df = releases(spark, RELEASES)
    at = lambda day: sorted(r.value for r in asof.latest_vintage(df, day).collect())
    assert (at("2021-04-28"), at("2021-04-29"), at("2021-06-01"), at("2021-08-01")) == ([], [2.1], [1.9], [1.9, 6.5])
    assert sorted(r.value for r in asof.first_release(df).collect()) == [2.1, 6.5]
    assert [r.value for r in asof.latest_per_entity(df, "2021-08-01").collect()] == [6.5]
    assert [r.value for r in asof.latest_per_entity(releases(spark, RELEASES + AGAIN), "2021-10-01").collect()] == [6.7]


@pytest.mark.parametrize("seed", range(3))
def test_no_lookahead(spark, seed):
    rnd = random.Random(seed)
    day = lambda n: t("2021-01-01") + dt.timedelta(days=n)
    rows = [(rnd.choice("ABC"), day(rnd.randrange(20)), day(rnd.randrange(40)), float(i), f"{i:03}") for i in range(80)]
    df = spark.createDataFrame(rows, "entity string, event_time timestamp, knowledge_time timestamp, value double, vintage_id string")
    for cursor in (day(5), day(17), day(39)):
        past = df.where(F.col("knowledge_time") <= F.lit(cursor))
        for op in (asof.latest_vintage, asof.latest_per_entity, asof.latest_by_event):
            assert sorted(op(df, cursor).collect()) == sorted(op(past, cursor).collect())
    grid = asof.cursor_grid(spark, "2021-01-01", "2021-02-09", "1 day")
    swept = {(r.entity, r.cursor): r.value for r in asof.observed_on_grid(df, grid, ["value"]).collect()}
    for cursor in (day(3), day(20), day(39)):
        assert {r.entity: r.value for r in asof.latest_per_entity(df, cursor).collect()} == {e: v for (e, c), v in swept.items() if c == cursor}


def test_trailing_forward_members_fallback(spark):
    df = releases(spark, [("E", "2021-01-01", k, 1.0) for k in ("2021-01-01T00:00:00", "2021-01-01T00:00:01", "2021-01-15T00:00:00", "2021-01-15T00:00:01")])
    assert asof.trailing(df, "2021-01-15", 14).count() == 2
    bars = spark.createDataFrame([("X", t("2021-01-08"), 10.0), ("X", t("2021-01-11"), 12.0), ("X", t("2021-01-10"), None)], "entity string, event_time timestamp, close double")
    moments = spark.createDataFrame([("X", t("2021-01-09T13:00:00")), ("X", t("2021-01-08T09:00:00")), ("X", t("2021-01-12")), ("Y", t("2021-01-01"))], "entity string, at timestamp")
    assert {(r.entity, r.at.day): r.close for r in asof.forward_value(bars, moments).collect()} == {("X", 9): 12.0, ("X", 8): 10.0, ("X", 12): None, ("Y", 1): None}
    moves = spark.createDataFrame([("X", t("2020-03-01"), t("2020-03-01"), "added"), ("X", t("2021-06-01"), t("2021-05-20"), "removed")], "entity string, event_time timestamp, knowledge_time timestamp, action string")
    assert (asof.members(moves, "2021-05-30").count(), asof.members(moves, "2021-06-01").count()) == (1, 0)
    a, b = spark.createDataFrame([("k", 1)], "k string, v int"), spark.createDataFrame([("k", 2), ("m", 3)], "k string, v int")
    assert sorted(map(tuple, asof.fallback([a, b], ["k"]).collect())) == [("k", 1), ("m", 3)]
    clock = asof.Clock(t("2021-01-01"), t("2021-01-02T12:00:00"))
    assert [clock.done, clock.advance(), clock.done, clock.advance(), clock.done, clock.iso()] == [False, t("2021-01-02"), False, t("2021-01-03"), True, "2021-01-03T00:00:00"]


def test_technical(spark):
    bars = spark.createDataFrame([("X", t(f"2021-01-0{i}"), t(f"2021-01-0{i}"), c) for i, c in enumerate((100.0, 110.0, 99.0), 1)], "entity string, event_time timestamp, knowledge_time timestamp, close double")
    a, b, c = windows.technical(bars).orderBy("event_time").collect()
    assert a.ret_1d is None and b.ret_1d == pytest.approx(0.1) and c.ret_1d == pytest.approx(-0.1) and c.sma50 == 103
    assert b.vol_21d is None and c.vol_21d == pytest.approx(0.1414214 * math.sqrt(252), rel=1e-5)
    assert (a.dist_52w_high, b.dist_52w_high, c.dist_52w_high) == (0, 0, pytest.approx(-0.1)) and (a.rsi14, b.rsi14, c.rsi14) == (None, None, pytest.approx(50))
    assert windows.technical(bars.limit(0)).count() == 0


def test_surprise_and_flow(spark):
    rows = [("S", f"2021-0{i}-01", f"2021-0{i}-02", float(v)) for i, v in enumerate((1, 2, 4, 7, 11, 16, 22), 1)]
    got = windows.surprise(releases(spark, rows)).orderBy("event_time").collect()
    assert [r.surprise for r in got] == [1, 2, 3, 4, 5, 6] and [r.surprise_z for r in got[:4]] == [None] * 4
    assert (got[4].surprise_z, got[5].surprise_z) == (pytest.approx(1.26491, abs=1e-5), pytest.approx(1.33631, abs=1e-5))
    month = t("2021-01-05")
    trades = spark.createDataFrame([("X", month, month, "P", "A", 100.0), ("X", month, month, "S", "D", 40.0), ("X", month, month, "P", "A", None), ("X", month, month, "M", "A", 9.0)], "entity string, event_time timestamp, knowledge_time timestamp, txn_code string, acq_disp string, shares double")
    r = windows.insider_flow(trades).first()
    assert (r.net_shares, r.n_sells) == (60, 1)


def test_pct_rank_and_correlation(spark):
    from pyspark.sql import Window

    from tidemark.functions.scalar import correlation, pct_rank

    df = spark.createDataFrame([(1, 3.0, 1.0), (2, 1.0, 1.0), (3, 2.0, 1.0), (4, 2.0, 1.0)], "i int, x double, y double")
    w = Window.partitionBy(F.lit(1)).orderBy("i").rowsBetween(-2, 0)
    got = [r.p for r in df.select("i", pct_rank(F.col("x"), w, 2).alias("p")).orderBy("i").collect()]
    assert got[0] is None and got[1:] == [pytest.approx(v, abs=1e-6) for v in (0.5, 0.666667, 0.833333)]
    assert df.select(correlation(F.col("x"), F.col("y"), w).alias("c")).where("c is not null").count() == 0


def test_co_mention(spark):
    def articles(n):
        rows = [(f"u{i}", "Acme, Beta" if i % 2 else "Beta, Acme") for i in range(n)] + [("v", "Acme")]
        return spark.createDataFrame([(u, o, t("2021-02-03"), t("2021-02-03")) for u, o in rows], "url string, organizations string, event_time timestamp, knowledge_time timestamp")

    r = graph.co_mention(articles(3), 1).collect()
    assert [(x.entity, x.dst, x.weight) for x in r] == [("Acme", "Beta", 3)] and graph.co_mention(articles(2), 1).count() == 0


def test_tasks(spark):
    day = dt.date(2021, 1, 1)
    rows = [(260.0, day), (250.0, day), (39.0, day), (40.0, day), (0.0, day), (100.0, dt.date(2099, 1, 1))]
    df = spark.createDataFrame(rows, "v double, d date")
    assert [r.x for r in df.select(tasks.approve(F.col("v"), F.lit(100.0), F.col("d")).alias("x")).collect()] == ["reject", "approve", "reject", "approve", "reject", "reject"]
    assert tasks.parse_action('{"tool":"onchain"}') == ("tool", "onchain", {}) and tasks.parse_action("{bad")[:2] == ("decide", "{bad") and tasks.parse_action('{"action":"long"}')[:2] == ("decide", "long")
    one = lambda c: df.limit(1).select(c.alias("x")).first().x
    assert [one(tasks.trading_reward(F.lit(d), F.lit(10.0), F.lit(12.0))) for d in ("long", "short", "flat")] == [20.0, -20.0, 0.0]
    assert [one(tasks.forecast_reward(F.lit(d), F.lit(10.0), x)) for d, x in (("up", F.lit(12.0)), ("down", F.lit(12.0)), ("up", F.lit(None).cast("double")))] == [1.0, -1.0, 0.0]
    assert one(tasks.approval_reward(F.lit("approve or reject"), F.lit(True))) == 1.0


class Tables:
    def __init__(self, spark):
        self.spark = spark

    def scan(self, domain, source, kind=None):
        return self.spark.createDataFrame([("X", t("2021-01-02"), t("2021-01-02"), 5.0, 7.0)], "entity string, event_time timestamp, knowledge_time timestamp, close double, volume double")


def test_environment(spark):
    task = lambda text, now, lake: (1.0 if text == "up" else -1.0, {})
    env = tasks.Environment(Tables(spark), task, t("2021-01-04"), t("2021-01-06"), budget=1)
    p = env.step({"tool": "price_history", "args": {"ticker": "X"}})
    assert p["as_of"].startswith("2021-01-04") and p["tool_budget_left"] == 0 and p["tool_results"][0]["rows"][0]["close"] == 5.0
    assert "spent" in env.step({"tool": "price_history", "args": {"ticker": "X"}})["info"]["error"] and "tier" in env.step({"tool": "fundamentals"})["info"]["error"]
    p = env.step("up")
    assert p["reward"] == 1.0 and p["tool_budget_left"] == 1 and not p["done"] and env.step("down")["done"]
    log = env.trajectory(spark, "e1", "a", "t")
    assert log.schema == tasks.TRAJECTORY and log.count() == 5
    assert [r.cum_reward for r in tasks.with_cumulative(log.where("action_type = 'decide'")).orderBy("step").collect()] == [1.0, 0.0]
    assert channels.available("basic") == ["price_history", "macro_series", "get_features", "market_regime"] and len(channels.available("pro")) == 13


def test_provenance(spark):
    assert pit_class("macro", "alfred") == "vintage" and pit_class("no", "such") == "unknown" and not is_historical_safe("crypto_defi", "defillama")
    df = spark.createDataFrame([("macro", "alfred"), ("crypto_defi", "defillama"), (None, "x")], "domain string, source string")
    assert strict(df).count() == 1 and registry(spark).where("safe").where(~F.col("pit_class").isin(*SAFE)).count() == 0
