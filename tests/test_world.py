"""The observation, tasks as objects, agents, and episodes through the environment and all at once."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import episodes, tasks
from tidemark.operators.observe import CHANNELS, Observer


def t(text):
    return dt.datetime.fromisoformat(text)


class World:
    """Prices of two tickers on ten days, known in the evening; quotes, a shock, and a regime; no other source."""

    def __init__(self, spark):
        days = [dt.datetime(2021, 1, d) for d in range(1, 11)]
        bars = [(e, d, d + dt.timedelta(hours=21), float(p + i)) for e, p in (("SPY", 100), ("QQQ", 50)) for i, d in enumerate(days)]
        self.own = {
            ("market", "yahoo"): spark.createDataFrame(bars, "entity string, event_time timestamp, knowledge_time timestamp, close double"),
            ("predictions", "manifold"): spark.createDataFrame([("m", t("2021-01-02"), t("2021-01-02"), "Will it?", 0.25, 9.0)], "entity string, event_time timestamp, knowledge_time timestamp, question string, probability double, volume double"),
            ("events", "usgs"): spark.createDataFrame([(t("2021-01-02"), t("2021-01-02"), 6.5, "sea"), (t("2021-01-09"), t("2021-01-09"), 8.0, "land")], "event_time timestamp, knowledge_time timestamp, magnitude double, place string"),
            ("features", "derived"): spark.createDataFrame([(t("2021-01-02"), t("2021-01-03"), "regime", "risk_on", 0.25, 1, 0.5)], "event_time timestamp, knowledge_time timestamp, kind string, regime string, vix_pct_252 double, curve_inverted int, risk_appetite double"),
            ("positioning", "finra_short"): spark.createDataFrame([("SPY", t("2021-01-02"), t("2021-01-02"), 0.4)], "entity string, event_time timestamp, knowledge_time timestamp, short_ratio double"),
        }

    def scan(self, domain, source, kind=None):
        return self.own[(domain, source)]


@pytest.fixture(scope="module")
def world(spark):
    return World(spark)


def test_observation(world):
    obs = Observer(world)(world, "2021-01-04 00:00:00")
    assert set(obs) == {"as_of", "text", *CHANNELS}
    assert obs["prices"] == [{"entity": "QQQ", "close": 52.0}, {"entity": "SPY", "close": 102.0}] and obs["rates"] == [] == obs["news"] and obs["crypto"] == {}
    assert obs["text"].splitlines() == [
        "=== World state as of 2021-01-04 00:00:00 (only info knowable by now) ===",
        "Regime: risk_on (VIX pct 25%, curve inverted, risk-appetite +0.50)",
        "Equities: QQQ 52.00, SPY 102.00", "Rates: —", "Macro: —", "Credit/conditions: —", "Commodities: —",
        "Crowd beliefs: 25% Will it?", "Recent shocks: quake M6.5 sea",
    ]
    empty = Observer(type("None_", (), {"scan": lambda *a: {}[a]})())
    assert empty(None, "2021-01-04")["prices"] == []


def test_tasks_and_agents_in_the_environment(spark, world):
    env = tasks.Environment(world, episodes.Forecast(horizon_days=2), t("2021-01-04"), t("2021-01-07"), tier="pro", observe=Observer(world))
    p = env.reset()
    assert (p["t"], p["task"], p["prompt"]["item"]) == (0, "forecast", {"target": "SPY", "current_price": 102.0}) and "TASK (forecast)" in p["text"]
    episodes.play(env, episodes.AGENTS["tooluser"], 5)
    log = env.trajectory(spark, "e", "tooluser", "forecast").collect()
    assert [r.action_type for r in log] == ["tool", "decide"] * 3 and [r.reward for r in log if r.scored] == [1.0] * 3 and log[-1].cum_reward == 3.0 and log[-1].done
    assert '"short_ratio": 0.4' in log[0].tool_results_json and '"current_price": 102.0' in log[0].prompt_json
    trade = episodes.Trading(horizon_days=2)
    trade.prompt({"prices": [{"entity": "SPY", "close": 100.0}]}, None)
    assert trade.score("go short", t("2021-01-04"), world)[0] == -5.0 and trade.score("x", t("2031-01-04"), world) == (0.0, {"skipped": "no price"})
    approval = episodes.DataApproval(seed=3)
    for _ in range(20):
        obs = {"as_of": "2021-01-04", "prices": [{"entity": "SPY", "close": 100.0}]}
        packet = {"task": "data_approval", "observation": obs, "prompt": approval.prompt(obs, None)}
        assert approval.score(episodes.baseline(packet, None), None, None)[0] == 1.0 and approval.score("hm", None, None)[0] == -1.0


def test_episodes_at_once_equal_the_environment(spark, world):
    begun = spark.createDataFrame([("a", t("2021-01-03")), ("b", t("2021-01-05")), ("c", t("2030-01-01"))], "episode string, start timestamp")
    bars = world.scan("market", "yahoo")
    for task, action in (("forecast", "up"), ("forecast", "down"), ("trading", "short")):
        log = episodes.played(bars, begun, task, "SPY", F.lit(action), steps=3, step_days=1, horizon=2)
        got = {}
        for r in log.orderBy("episode_id", "step").collect():
            got.setdefault(r.episode_id, []).append((r.reward, round(r.cum_reward, 4), r.done))
        for name, start in (("a", "2021-01-03"), ("b", "2021-01-05")):
            env = tasks.Environment(world, episodes.TASKS[task](horizon_days=2), t(start), t(start) + dt.timedelta(days=3), observe=Observer(world))
            episodes.play(env, lambda packet, draw: action, 3)
            assert got[name] == [(r.reward, round(r.cum_reward, 4), r.done) for r in env.trajectory(spark, name, "x", task).collect()]
        assert [r[0] for r in got["c"]] == [0.0] * 3
    assert {r.action for r in episodes.played(bars, episodes.starts(spark, 30, "2021-01-01", "2021-01-05"), "trading", "SPY", episodes.drawn(episodes.ANSWERS["trading"])).collect()} == {"long", "flat", "short"}
