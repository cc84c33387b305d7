"""Channels and tools on a small lake of files."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.lake import Lake
from tidemark.operators import channels as C

AT = "2021-06-15 00:00:00"
ENV = "event_time timestamp, knowledge_time timestamp, domain string, source string, entity string, vintage_id string, source_url string, content_hash string"


def day(text):
    return dt.datetime.fromisoformat(text)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    lake = Lake(spark, f"file://{tmp_path_factory.mktemp('lake')}")

    def put(domain, source, payload, rows, **keys):
        data = [(day(e), day(k), domain, source, name, v, "", f"{domain}{source}{i}", *rest) for i, (name, e, k, v, *rest) in enumerate(rows)]
        lake.write(spark.createDataFrame(data, f"{ENV}, {payload}"), domain, source, **keys)

    late = "2021-06-20"
    put("market", "yahoo", "close double, volume double", [("X", f"2021-06-{d:02}", f"2021-06-{d:02} 21:00:00", "", float(d), 1.0) for d in range(1, 21)])
    put("macro", "alfred", "value double", [("GDP", "2021-01-01", "2021-04-29", "a", 2.1), ("GDP", "2021-01-01", "2021-05-27", "b", 1.9), ("GDP", "2021-04-01", late, "c", 6.5)])
    put("credit", "fred", "value double", [("HY", "2021-06-01", "2021-06-02", "", 3.5), ("GDP", "2021-06-01", "2021-06-02", "", 99.0)])
    for d in ("commodity", "real_estate"):
        put(d, "fred", "value double", [(f"{d}-1", "2021-06-01", "2021-06-02", "", 1.0)])
    put("fundamentals", "sec_xbrl", "concept string, unit string, value double", [("X", "2021-03-31", "2021-05-01", "a", "Revenues", "USD", 5.0), ("X", "2020-12-31", "2021-06-01", "b", "Revenues", "USD", 4.0), ("X", "2021-03-31", late, "c", "Assets", "USD", 9.0)])
    put("positioning", "finra_short", "short_ratio double", [("X", "2021-06-10", "2021-06-11", "", 0.4), ("X", "2021-06-14", late, "", 0.9)])
    put("filings_text", "edgar", "form string, text string", [("X", "2021-05-01", "2021-05-01", "", "8-K", "t" * 900), ("X", "2021-04-01", "2021-04-01", "", "10-Q", "old")])
    put("onchain", "blockchain", "metric string, value double", [("BTC", "2021-06-01", "2021-06-02", "", "hash-rate", 1.5), ("BTC", "2021-06-14", late, "", "hash-rate", 9.0)])
    put("predictions", "manifold", "question string, probability double, volume double", [("m1", "2021-06-01", "2021-06-01", "", "Will RATES rise?", 0.3, 10.0), ("m1", "2021-06-02", "2021-06-02", "", "Will RATES rise?", 0.4, 10.0), ("m2", "2021-06-01", "2021-06-01", "", "Other", 0.5, 99.0)])
    put("predictions", "polymarket", "question string, probability double, volume double", [("p1", "2021-06-01", "2021-06-01", "", "rates 5% up", 0.6, 7.0)])
    put("predictions", "kalshi", "title string, probability double", [("k1", "2021-06-01", "2021-06-01", "", "Rates cut", 0.7)])
    put("crypto_defi", "defillama", "value double", [("chain-a", "2021-06-01", "2021-06-02", "", 11.0)])
    put("graph", "derived", "rel string, dst string", [("Acme Bank", "2021-06-01", "2021-06-01", "", "owns", "X"), ("Y", "2021-06-01", "2021-06-02", "", "owns", "acme bank ltd"), ("Acme Bank", "2021-06-01", late, "", "owns", "Z")], kind="ownership")
    put("graph", "derived", "name string", [("Acme Bank", "2021-06-01", "2021-06-01", "", "n")], kind="nodes")
    put("features", "derived", "rsi14 double", [("X", "2021-06-14", "2021-06-14 21:00:00", "", 55.0), ("X", "2021-06-15", late, "", 1.0)], kind="technical")
    put("features", "derived", "regime string", [("MARKET", "2021-06-13", "2021-06-14", "", "risk_on"), ("MARKET", "2021-06-15", late, "", "risk_off")], kind="regime")
    title = "A title of more than twenty signs "
    put("news", "gdelt_gkg", "title string, url string, site_domain string, organizations string, tone double", [("s", "2021-06-14", "2021-06-14", "", title + "1", "u1", "s", "Acme Bank", -3.0), ("s", "2021-06-14", "2021-06-14", "", title + "2", "u2", "s", "Beta", 1.0), ("s", "2021-06-01", "2021-06-01", "", "acme", "u3", "s", None, 9.0)])
    put("news", "hackernews", "title string, points long", [("q", "2021-06-10", "2021-06-10", "", "post", 5)])
    put("events", "usgs", "magnitude double, place string", [("q1", "2021-06-10", "2021-06-10", "", 6.12, "sea"), ("q2", "2021-05-20", "2021-05-20", "", 7.0, "land"), ("q3", "2021-06-10", "2021-06-10", "", 5.0, "hill")])
    return lake


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_tools(lake):
    assert [r.close for r in C.price_history(lake, AT, "X", 3).collect()] == [14.0, 13.0, 12.0]
    assert [(r.concept, r.value) for r in C.fundamentals(lake, AT, "X").collect()] == [("Revenues", 4.0)]
    assert C.positioning(lake, AT, "X").first().short_ratio == 0.4
    r = C.filing_text(lake, AT, "X").first()
    assert (r.form, len(r.excerpt)) == ("8-K", 500)
    assert C.onchain(lake, AT, "hash-rate").first().value == 1.5
    assert sorted((r.venue, r.probability, r.volume) for r in C.prediction_market(lake, AT, "Rates").collect()) == [("kalshi", 0.7, 0.0), ("manifold", 0.4, 10.0), ("polymarket", 0.6, 7.0)]
    assert C.prediction_market(lake, AT, "5%").count() == 1 and C.prediction_market(lake, AT, "_").count() == 0
    assert C.defi_tvl(lake, AT, "chain-a").first().value == 11.0
    assert [(r.entity, r.dst) for r in C.related_entities(lake, AT, "ACME").collect()] == [("Y", "acme bank ltd"), ("Acme Bank", "X")]
    assert C.macro_series(lake, AT, "GDP").first().value == 1.9 and C.macro_series(lake, AT, "HY").first().value == 3.5 and C.macro_series(lake, AT, "no").count() == 0
    assert C.get_features(lake, AT, "X").first().rsi14 == 55.0 and C.market_regime(lake, AT).first().regime == "risk_on"
    assert [r.url for r in C.news_search(lake, AT, "acme").collect()] == ["u1", "u3"]
    assert rows(C.recent_shocks(lake, AT)) == [("quake M7.0 land", 7.0), ("quake M6.1 sea", 6.12)]


def test_channels(lake, spark):
    assert rows(C.prices(lake.scan("market", "yahoo"), AT, ["X"])) == [("X", 14.0)]
    assert rows(C.levels(lake.scan("macro", "alfred"), AT, ["GDP"])) == [("GDP", 1.9)]
    news, posts = lake.scan("news", "gdelt_gkg"), lake.scan("news", "hackernews")
    assert [r.strength for r in C.news(news, posts, AT).collect()] == [3.0, 1.0]
    assert [r.title for r in C.news(news.limit(0), posts, AT).collect()] == ["post"]
    assert [r.entity for r in C.markets(lake.scan("predictions", "manifold"), AT, 1).collect()] == ["m2"]
    assert rows(C.shocks(lake.scan("events", "usgs"), AT)) == [("quake M6.1 sea", 6.12)]
    one = lambda name, c, v: spark.createDataFrame([(name, day("2021-06-01"), day("2021-06-02"), v)], f"entity string, event_time timestamp, knowledge_time timestamp, {c} double")
    got = C.crypto(one("BTC", "close", 35_123.6), one("FNG", "fng_value", 40.0), one("BTC-VOL", "dvol_close", 71.239), AT)
    assert sorted(rows(got)) == [("BTC", 35124.0), ("BTC-VOL", 71.24), ("FNG", 40.0)]


def test_filters_reach_the_files(lake):
    from tidemark.operators.asof import as_of

    plan = as_of(lake.scan("macro", "alfred"), AT).select("value")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "domain" in plan and "LessThanOrEqual(knowledge_time" in plan and "source_url" not in plan.split("ReadSchema")[1]
    assert lake.scan("graph", "derived", "nodes").where(F.col("dst").isNotNull()).count() == 0
