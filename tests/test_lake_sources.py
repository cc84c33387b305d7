"""Parsers on landed fixtures, the lake's files, and streams."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark.envelope import COLUMNS
from tidemark.lake import Lake, merge_rows
from tidemark.sources import parsers as P


def t(text):
    return dt.datetime.fromisoformat(text)


def one(df):
    rows = df.collect()
    assert df.columns[:8] == COLUMNS and len(rows) == 1
    return rows[0]


def js(spark, *rows):
    return spark.read.json(spark.sparkContext.parallelize([json.dumps(r) for r in rows], 1))


def test_registry():
    live = [s for s in P.SOURCES.values() if s.shard]
    assert len(live) == 41 and len(P.SOURCES) == 47 and sum(s.parse is not None for s in live) == 38


def test_lag_rules(spark):
    day = "2021-01-04"
    bar = spark.createDataFrame([("X", day, "1.0", "x"), ("X", day, None, None)], "symbol string, date string, close string, volume string")
    r = one(P.market_yahoo(bar))
    assert (r.event_time, r.knowledge_time, r.close, r.volume, r.domain, r.source) == (t(day), t("2021-01-04T21:00:00"), 1.0, None, "market", "yahoo")
    assert one(P.crypto_yahoo(bar)).knowledge_time == t("2021-01-05")
    fred = spark.createDataFrame([("GDP", day, "2.1", "2021-04-29"), ("GDP", day, ".", "2021-04-29")], "series_id string, date string, value string, realtime_start string")
    r = one(P.SOURCES["macro_alfred"].parse(fred))
    assert (r.knowledge_time, r.vintage_id, r.value) == (t("2021-04-29"), "2021-04-29", 2.1)
    assert one(P.SOURCES["credit_fred"].parse(fred.drop("realtime_start"))).knowledge_time == t("2021-01-05")
    short = spark.createDataFrame([("20210104", "X", "5", "1", "0")], "Date string, Symbol string, ShortVolume string, ShortExemptVolume string, TotalVolume string")
    assert one(P.short_finra(short)).short_ratio is None
    fed = spark.createDataFrame([("minutes", "u", day, "<p>a  b</p>")], "doc_type string, url string, date string, html string")
    r = one(P.fed_text(fed))
    assert (r.knowledge_time, r.text, r.char_len) == (t("2021-01-25"), "a b", 3)
    epu = spark.createDataFrame([("2021", "1", "9.5", "8"), ("Source: x", None, None, None)], "Year string, Month string, epu_3component string, epu_news_based string")
    assert one(P.epu_index(epu)).knowledge_time == t("2021-02-01")
    quake = js(spark, {"id": "q", "geometry": {"coordinates": [1.5, 2, 3]}, "properties": {"time": 1609718400000, "mag": 6.1, "place": "sea", "url": "u"}})
    r = one(P.usgs_quakes(quake))
    assert (r.event_time, r.knowledge_time, r.depth_km) == (t(day), t("2021-01-04T00:20:00"), 3.0)


def test_nested(spark):
    facts = {"Revenues": {"units": {"USD": [{"end": "2021-03-31", "val": 5.0, "accn": "a", "fy": "2021", "fp": "Q1", "form": "10-Q", "filed": "2021-05-01"}, {"end": None, "val": 1.0, "filed": "2021-05-01"}]}}}
    r = one(P.fundamentals_sec(spark.createDataFrame([("X", json.dumps(facts))], "ticker string, facts string")))
    assert (r.concept, r.unit, r.value, r.event_time, r.knowledge_time, r.vintage_id) == ("Revenues", "USD", 5.0, t("2021-03-31"), t("2021-05-01"), "a")
    form = """<ownershipDocument><reportingOwner><reportingOwnerId><rptOwnerName>DOE J</rptOwnerName></reportingOwnerId><reportingOwnerRelationship><isDirector>1</isDirector></reportingOwnerRelationship></reportingOwner>
    <nonDerivativeTable><nonDerivativeTransaction><securityTitle><value>Common</value></securityTitle><transactionDate><value>2021-02-03</value></transactionDate><transactionCoding><transactionCode>P</transactionCode></transactionCoding>
    <transactionAmounts><transactionShares><value>10</value></transactionShares><transactionPricePerShare><value>2.5</value></transactionPricePerShare><transactionAcquiredDisposedCode><value>A</value></transactionAcquiredDisposedCode></transactionAmounts></nonDerivativeTransaction></nonDerivativeTable></ownershipDocument>"""
    r = one(P.insider_form4(spark.createDataFrame([("X", "2021-02-05", None, "u", form)], "ticker string, filing_date string, accepted string, url string, xml string")))
    assert (r.event_time, r.knowledge_time, r.owner_name, r.shares, r.price, r.acq_disp, r.is_derivative) == (t("2021-02-03"), t("2021-02-05"), "DOE J", 10.0, 2.5, "A", False)
    info = "<informationTable><infoTable><nameOfIssuer>ACME</nameOfIssuer><cusip>037833100</cusip><value>7</value><shrsOrPrnAmt><sshPrnamt>3</sshPrnamt></shrsOrPrnAmt></infoTable></informationTable>"
    r = one(P.holdings_13f(spark.createDataFrame([("M", "2021-03-31", "2021-05-01", "2021-05-02T10:00:00", "acc", info)], "manager string, report_period string, filing_date string, accepted string, accession string, xml string")))
    assert (r.issuer, r.value_usd_thousands, r.shares, r.put_call, r.knowledge_time) == ("ACME", 7.0, 3.0, "", t("2021-05-02T10:00:00"))


def test_delimited_and_arrays(spark):
    fields = [""] * 27
    fields[1], fields[3], fields[4], fields[13], fields[15], fields[26] = "20210104120000", "site", "u", "acme inc,1;beta,9;acme inc,5", "-1.5,2,x", "<PAGE_TITLE>Hello</PAGE_TITLE>"
    line = "\t".join(fields)
    r = one(P.news_gkg(spark.createDataFrame([(line,), (line,), ("too\tshort",)], "value string")))
    assert (r.organizations, r.tone, r.negative, r.polarity, r.title) == ("Acme Inc, Beta", -1.5, None, None, "Hello")
    r = one(P.edgar_index(spark.createDataFrame([("1|ACME|10-K|2021-01-04|f.txt",), ("CIK|Company|Form|Date|File",), ("x",)], "value string")))
    assert (r.entity, r.form, r.event_time) == ("1", "10-K", t("2021-01-04"))
    v = lambda rows: spark.createDataFrame(rows, "theme string, date string, value string")
    got = P.news_gdelt(v([("a", "2021-01-01", "1")]), v([("a", "2021-01-02", "2")])).orderBy("event_time").collect()
    assert [(r.volume_pct, r.avg_tone) for r in got] == [(1.0, None), (None, 2.0)]
    bets = spark.createDataFrame([("m", "q", 1609718400000 + i * 1000, p, 9.0) for i, p in enumerate((0.1, 0.7, 0.4))], "market_id string, question string, createdTime long, probAfter double, volume double")
    assert one(P.predict_manifold(bets)).probability == 0.4
    moves = P.index_changes(spark.createDataFrame([("2021-01-04", "A", "Acme", "", "", "r"), ("2021-01-05", "B", "Beta", "C", "Gamma", "s")], "date string, added string, added_security string, removed string, removed_security string, reason string"))
    assert sorted((r.entity, r.action) for r in moves.collect()) == [("A", "added"), ("B", "added"), ("C", "removed")]
    prices = [(None, 0.4, None, 0.0, 0.0, 0.4), (None, None, None, 0.4, 0.6, 0.5), (None, None, None, 0.0, 0.6, 0.6), (None, None, None, 0.0, 0.0, None)]
    df = spark.createDataFrame(prices, "c double, m double, p double, b double, a double, want double")
    for r in df.select("want", P.contract_probability(*(F.col(x) for x in "cmpba")).alias("got")).collect():
        assert r.got == pytest.approx(r.want) if r.want is not None else r.got is None
    seed, listed = spark.createDataFrame([("B", 0), ("A", 1)], "ticker string, position int"), spark.createDataFrame([("a", 0), ("C", 1), ("D", 2)], "ticker string, position int")
    assert [r.ticker for r in P.universe(seed, listed, 2).orderBy("position").collect()] == ["B", "A", "C"]


LAKE = "event_time timestamp, knowledge_time timestamp, domain string, source string, entity string, vintage_id string, source_url string, content_hash string, value double"


def rows(spark, *items):
    return spark.createDataFrame([(t("2021-01-01"), t(f"2021-01-{k:02}"), d, s, "E", "", "", h, v) for d, s, h, k, v in items], LAKE)


def test_lake(spark, tmp_path):
    lake = Lake(spark, f"file://{tmp_path}/lake")
    first = rows(spark, ("macro", "alfred", "a", 2, 1.0), ("macro", "alfred", "b", 3, 2.0))
    assert lake.write(first, "macro", "alfred", series="GDP") and not lake.write(first, "macro", "alfred", series="GDP") and lake.write(first, "macro", "alfred", overwrite=True, series="GDP")
    lake.write_many(rows(spark, ("crypto_defi", "defillama", "c", 4, 3.0)).withColumn("series", F.lit("X")), ["series"])
    assert lake.scan().count() == 3 and lake.scan("macro", "alfred").count() == 2 and Lake(spark, lake.root, strict=True).scan().count() == 2
    assert lake.healthy() and lake.read("no", "such") is None and lake.high_water("macro", "alfred") == t("2021-01-01")
    inv = {r.source: (r.files, r.rows, r.pit_class) for r in lake.inventory().collect()}
    assert inv["alfred"][1:] == (2, "vintage") and inv["defillama"][1:] == (1, "revised_soft")
    more = rows(spark, ("macro", "alfred", "b", 9, 2.0), ("macro", "alfred", "d", 9, 4.0), ("macro", "alfred", None, 9, 5.0), ("macro", "alfred", "d", 9, 4.0))
    assert sorted(r.value for r in merge_rows(first, more).collect()) == [1.0, 2.0, 4.0, 5.0]
    assert merge_rows(first, first).count() == 2 == merge_rows(None, first).count()


def test_streams(spark, tmp_path):
    from tidemark.streaming import stream as S

    src = f"file://{tmp_path}/in"
    rows(spark, ("macro", "alfred", "a", 2, 1.0), ("macro", "alfred", "a", 2, 1.0), ("macro", "alfred", "b", 3, 2.0)).coalesce(1).write.parquet(src)
    stream = S.deduplicated(S.read_lake(spark, src, rows(spark).schema))
    S.ingest(stream, f"file://{tmp_path}/out", f"file://{tmp_path}/cp").awaitTermination()
    assert spark.read.parquet(f"file://{tmp_path}/out").count() == 2


def test_late_totals_stream(spark, tmp_path):
    from tidemark.streaming import stream as S

    src, schema = f"{tmp_path}/in", "entity string, event_time timestamp, knowledge_time timestamp, value double"
    batches = [[("A", "1970-01-05", "1970-01-06", 1.0)], [("A", "1970-01-06", "1970-01-20", 2.0)], [("A", "1970-01-07", "1970-03-30", 4.0)]]
    out = []
    for i, b in enumerate(batches):
        spark.createDataFrame([(e, t(a), t(k), v) for e, a, k, v in b], schema).coalesce(1).write.mode("append").parquet(f"file://{src}")
        q = S.late_totals(spark.readStream.schema(schema).parquet(f"file://{src}"), 10, 5, 60, "value").writeStream.outputMode("append").option("checkpointLocation", f"file://{tmp_path}/cp").trigger(availableNow=True)
        q.foreachBatch(lambda df, _: out.extend(map(tuple, df.collect()))).start().awaitTermination()
    assert out == [("A", 0, "corrected", 2, 3.0), ("A", 0, "dropped", 1, 4.0)]


def test_late_totals_stream_counts_a_hash_once(spark, tmp_path):
    from tidemark.streaming import stream as S

    src, schema = f"{tmp_path}/in", "entity string, event_time timestamp, knowledge_time timestamp, content_hash string, value double"
    batches = [[("1970-01-05", "1970-01-06", "a", 1.0), ("1970-01-05", "1970-01-07", "a", 1.0)], [("1970-01-05", "1970-01-21", "a", 1.0), ("1970-01-06", "1970-01-22", "b", 2.0), ("1970-01-06", "1970-01-22", None, 3.0)]]
    out = []
    for b in batches:
        spark.createDataFrame([("A", t(a), t(k), h, v) for a, k, h, v in b], schema).coalesce(1).write.mode("append").parquet(f"file://{src}")
        q = S.late_totals(spark.readStream.schema(schema).parquet(f"file://{src}"), 10, 5, 60, "value").writeStream.outputMode("append").option("checkpointLocation", f"file://{tmp_path}/cp").trigger(availableNow=True)
        q.foreachBatch(lambda df, _: out.extend(map(tuple, df.collect()))).start().awaitTermination()
    assert out == [("A", 0, "corrected", 3, 6.0)]


def test_late_totals_stream_ends_idle_states(spark, tmp_path):
    from tidemark.streaming import stream as S

    src, schema = f"{tmp_path}/in", "entity string, event_time timestamp, knowledge_time timestamp, value double"
    batches = [[("A", "1970-01-05", "1970-01-06")], [("B", "1971-01-05", "1971-01-06")], [("B", "1971-01-05", "1971-01-06")]]
    kept = []
    for e in batches:
        spark.createDataFrame([(n, t(a), t(k), 1.0) for n, a, k in e], schema).coalesce(1).write.mode("append").parquet(f"file://{src}")
        q = S.late_totals(spark.readStream.schema(schema).parquet(f"file://{src}"), 10, 5, 60, "value", "7 days").writeStream.outputMode("append").option("checkpointLocation", f"file://{tmp_path}/cp").trigger(availableNow=True)
        run = q.foreachBatch(lambda df, _: df.count()).start()
        run.awaitTermination()
        kept.append(run.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert kept[0] == 1 and kept[-1] == 1
