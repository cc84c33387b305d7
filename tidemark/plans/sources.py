"""A query for each source: its parser over landed rows, held against the rows that must come out, written by hand as VALUES.

A lake of real files is fetched from the network, which the driver's tables don't have; so each query carries what a source
delivers in a few rows, with the cases that its rules tell apart (nulls, footers, other forms, repeats).
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.parsers import SOURCES, index_changes

KINDS = {"s": "VARCHAR", "d": "DOUBLE", "i": "BIGINT", "b": "BOOLEAN"}
Q: dict[str, Callable] = {}
S: dict[str, str] = {}


def _literal(x) -> str:
    if x is None:
        return "NULL"
    return "'" + x.replace("'", "''") + "'" if isinstance(x, str) else str(x)


def landed(name: str, payload: str, want: list[tuple], *raws: tuple[str, list], parse: Callable | None = None, query: str | None = None, **options) -> None:
    """Registers `source_<name>`.

    payload: names and kinds of its columns (`close d, title s`). want: (entity, event time, knowledge time, vintage,
    *payload) of each row. raws: schema and rows of each landed frame. options: arguments of the parser."""
    columns = [p.split() for p in payload.split(", ")]
    src = SOURCES[name]

    def run(spark: SparkSession, root: str) -> DataFrame:
        frames = [spark.createDataFrame(rows, schema) for schema, rows in raws]
        df = (parse or src.parse)(*frames, **options)
        times = [F.unix_micros(t).alias(t) for t in ("event_time", "knowledge_time")]
        return df.select("domain", "source", "entity", *times, "vintage_id", *(n for n, _ in columns))

    names = ["entity", "event_time", "knowledge_time", "vintage_id", *(n for n, _ in columns)]
    values = ", ".join("(" + ", ".join(map(_literal, row)) + ")" for row in want)
    shown = ", ".join(f"CAST({n} AS {KINDS[k]}) AS {n}" for n, k in columns)
    key = f"source_{query or name}"
    Q[key] = run
    S[key] = f"SELECT '{src.domain}' AS domain, '{src.source}' AS source, CAST(entity AS VARCHAR) AS entity, epoch_us(CAST(event_time AS TIMESTAMP)) AS event_time, epoch_us(CAST(knowledge_time AS TIMESTAMP)) AS knowledge_time, CAST(vintage_id AS VARCHAR) AS vintage_id, {shown} FROM (VALUES {values}) t({', '.join(names)})"


# Prices and levels

BARS = "symbol string, date string, open string, high string, low string, close string, adj_close string, volume string"
PRICES = "open d, high d, low d, close d, adj_close d, volume d"
landed(
    "market_yahoo", PRICES,
    [("AAA", "2021-01-04", "2021-01-04 21:00:00", "", 1.5, 2.0, 1.0, 1.75, 1.7, 1000.0), ("BBB", "2021-01-05", "2021-01-05 21:00:00", "", None, None, None, 9.0, None, 0.0)],
    (BARS, [("AAA", "2021-01-04", "1.5", "2", "1", "1.75", "1.7", "1000"), ("AAA", "2021-01-05", None, None, None, None, None, None), ("BBB", "2021-01-05", None, "", "n/a", "9", None, "0")]),
)
landed("crypto_yahoo", "close d, volume d", [("BTC-USD", "2021-01-04", "2021-01-05", "", 31000.5, 7.0)], ("symbol string, date string, close double, volume double", [("BTC-USD", "2021-01-04", 31000.5, 7.0), ("BTC-USD", "2021-01-05", None, None)]))
FRED = "series_id string, date string, value string, realtime_start string"
for _name in ("macro_alfred", "credit_fred", "real_estate_fred", "commodities_fred"):
    landed(
        _name, "value d",
        [("X", "2021-01-01", "2021-02-10", "2021-02-10", 2.5), ("X", "2021-01-01", "2021-03-10", "2021-03-10", 2.75), ("Y", "2021-01-01", "2021-01-02", "", -1.0)],
        (FRED, [("X", "2021-01-01", "2.5", "2021-02-10"), ("X", "2021-01-01", "2.75", "2021-03-10"), ("X", "2021-02-01", ".", "2021-03-10"), ("Y", "2021-01-01", "-1", None)]),
    )
landed("crypto_onchain", "metric s, value d", [("BTC", "2021-01-04", "2021-01-05", "", "hash-rate", 150.5)], ("metric string, x long, y double", [("hash-rate", 1609718400, 150.5)]))
landed("eia_energy", "series s, value d", [("WCESTUS1", "2021-01-08", "2021-01-12", "", "WCESTUS1", 482.2)], ("series string, period string, value string", [("WCESTUS1", "2021-01-08", "482.2"), ("WCESTUS1", "2021-01-15", None)]))
landed(
    "defillama", "metric s, value d",
    [("all", "2021-01-04", "2021-01-05", "", "tvl_usd", 5.5), ("stablecoins", "2021-01-04", "2021-01-05", "", "stablecoin_mcap_usd", 7.25)],
    ("series string, date long, tvl double, totalCirculatingUSD struct<peggedUSD:double>, totalCirculating struct<peggedUSD:double>",
        [("all", 1609718400, 5.5, None, None), ("all", None, 1.0, None, None), ("all", 1609718400, None, None, None), ("stablecoins", 1609718400,
        None, (7.25,), (7.0,)), ("all", 1514764800, 3.0, None, None)]),
    since="2020-01-01",
)
landed("defillama_flows", "metric s, value_usd d", [("dexs", "2021-01-04", "2021-01-05", "", "dexs", 10.0), ("dexs", "2021-01-05", "2021-01-06", "", "dexs", 12.5)], ("metric string, points array<array<double>>", [("dexs", [[1609718400.0, 10.0], [1609804800.0, 12.5]]), ("fees", [])]))
landed("crypto_funding", "funding_rate d, realized_rate d", [("BTC-USD-SWAP", "2021-01-04 08:00:00", "2021-01-04 08:00:00", "", 0.0001, None)], ("instId string, fundingTime string, fundingRate string, realizedRate string", [("BTC-USD-SWAP", "1609747200000", "0.0001", "")]))
landed("crypto_vol", "dvol_open d, dvol_high d, dvol_low d, dvol_close d", [("BTC", "2021-01-04", "2021-01-05", "", 80.0, 90.0, 75.5, 81.0)], ("currency string, data array<array<double>>", [("BTC", [[1609718400000.0, 80.0, 90.0, 75.5, 81.0]]), ("ETH", None)]))
landed("crypto_fng", "fng_value d, classification s", [("crypto_market", "2021-01-04", "2021-01-05", "", 94.0, "Extreme Greed")], ("timestamp string, value string, value_classification string", [("1609718400", "94", "Extreme Greed")]))
landed(
    "market_fng", "score d, rating s",
    [("headline", "2021-01-04", "2021-01-05", "", 55.5, "greed"), ("vix", "2021-01-04", "2021-01-05", "", 40.0, "fear")],
    ("component string, data array<struct<x:double,y:double,rating:string>>", [("headline", [(1609718400000.0, 55.5, "greed"), (1609754400000.0, 60.0, "greed")]), ("vix", [(1609761600000.0, 40.0, "fear")])]),
)
landed("epu_index", "epu_3component d, epu_news_based d", [("US", "2021-01-01", "2021-02-01", "", 190.5, 260.0), ("US", "2021-02-01",
    "2021-03-01", "", None, 180.0)], ("Year string, Month string, Three_Component_Index string, News_Based_Policy_Uncert_Index string",
    [("2021", "1", "190.5", "260"), ("2021", "2", "", "180"), ("Source: note", None, None, None)]))
landed("wiki_pageviews", "views d", [("Inflation", "2021-01-04", "2021-01-05", "", 1200.0)], ("article string, timestamp string, views long", [("Inflation", "2021010400", 1200)]))

# Filings, holdings, positions

landed(
    "edgar", "company s, form s, filename s", [("320193", "2021-01-04", "2021-01-04", "", "ACME INC", "10-K", "edgar/f.txt")],
    ("value string", [("320193|ACME INC|10-K|2021-01-04|edgar/f.txt",), ("CIK|Company Name|Form Type|Date Filed|Filename",), ("----",), ("1|A|B|10-K|2021-01-04|f.txt",)]),
)
landed(
    "edgar_fulltext", "form s, accession s, text s, char_len i",
    [("AAA", "2021-01-04", "2021-01-04 21:30:00", "", "8-K", "a1", "Item 1 A & B", 12), ("AAA", "2021-01-05", "2021-01-05", "", "10-Q", "a2", "x", 1)],
    ("ticker string, form string, filing_date string, accepted string, accession string, primary_doc string, url string, html string",
        [("AAA", "8-K", "2021-01-04", "2021-01-04T21:30:00", "a1", "d", "u", "<p>Item 1</p><script>x()</script> A &amp;\n B<!-- c -->"), ("AAA",
        "10-Q", "2021-01-05", None, "a2", "d", "u", "x"), ("AAA", "S-1", "2021-01-05", None, "a3", "d", "u", "x")]),
)
landed(
    "fundamentals_sec", "concept s, unit s, value d, form s, fiscal_year s, fiscal_period s, period_start s",
    [("AAA", "2021-03-31", "2021-05-01", "acc1", "Revenues", "USD", 5.0, "10-Q", "2021", "Q1", "2021-01-01"), ("AAA", "2020-12-31", "2021-02-01", "acc2", "Assets", "EUR", 9.5, "10-K", "2020", "FY", None)],
    ("ticker string, facts string", [("AAA", json.dumps({"Revenues": {"units": {"USD": [{"start": "2021-01-01", "end": "2021-03-31",
        "val": 5.0, "accn": "acc1", "fy": "2021", "fp": "Q1", "form": "10-Q", "filed": "2021-05-01"}, {"end": "2021-06-30", "val": None, "filed": "2021-08-01"},
        {"end": None, "val": 1.0, "filed": "2021-08-01"}]}}, "Assets": {"units": {"EUR": [{"end": "2020-12-31", "val": 9.5, "accn": "acc2",
        "fy": "2020", "fp": "FY", "form": "10-K", "filed": "2021-02-01"}]}}}))]),
)
landed(
    "cftc_cot", "open_interest d, noncomm_long d, noncomm_short d, comm_long d, comm_short d, nonrept_long d, nonrept_short d",
    [("GOLD", "2021-01-05", "2021-01-08", "", 500.0, 1.0, 2.0, 3.0, 4.0, 5.0, None)],
    ("contract_market_name string, report_date_as_yyyy_mm_dd string, open_interest_all string, noncomm_positions_long_all string, noncomm_positions_short_all string,"
        " comm_positions_long_all string, comm_positions_short_all string, nonrept_positions_long_all string, nonrept_positions_short_all string",
        [("GOLD", "2021-01-05T00:00:00.000", "500", "1", "2", "3", "4", "5", "n/a"), ("GOLD", "soon", "1", "1", "1", "1", "1", "1", "1")]),
       
)
landed(
    "short_finra", "short_volume d, short_exempt_volume d, total_volume d, short_ratio d",
    [("AAA", "2021-01-04", "2021-01-05", "", 5.0, 1.0, 20.0, 0.25), ("BBB", "2021-01-04", "2021-01-05", "", 0.0, 0.0, 0.0, None)],
    ("Date string, Symbol string, ShortVolume string, ShortExemptVolume string, TotalVolume string", [("20210104", "AAA", "5", "1", "20"), ("20210104", "BBB", "0", "0", "0"), ("20210104", None, "1", "1", "1")]),
)
landed(
    "treasury_auctions", "cusip s, security_term s, maturity_date s, interestRate d, highYield d, highDiscountRate d, bidToCoverRatio d, offeringAmount d, totalAccepted d, totalTendered d",
    [("Bill", "2021-01-04", "2021-01-04", "", "912796XX1", "13-Week", "2021-04-08", None, None, 0.09, 2.9, 54e9, 54.1e9, 157e9)],
    ("type string, auctionDate string, cusip string, securityTerm string, maturityDate string, interestRate string, highYield string, highDiscountRate string, bidToCoverRatio"
        " string, offeringAmount string, totalAccepted string, totalTendered string", [("Bill", "2021-01-04", "912796XX1", "13-Week", "2021-04-08",
        "", None, "0.09", "2.9", "54000000000", "54100000000", "157000000000"), ("Bill", "2019-12-30", "old", "", "", "", "", "", "", "", "",
        ""), ("Bill", None, "none", "", "", "", "", "", "", "", "", "")]),
    since="2020-01-01",
)
_TXN = "<{0}><securityTitle><value>{1}</value></securityTitle><transactionDate><value>{2}</value></transactionDate><transactionCoding><transactionCode>{3}</transactionCode></transactionCoding><transactionAmounts><transactionShares><value>{4}</value></transactionShares><transactionPricePerShare><value>{5}</value></transactionPricePerShare><transactionAcquiredDisposedCode><value>{6}</value></transactionAcquiredDisposedCode></transactionAmounts><postTransactionAmounts><sharesOwnedFollowingTransaction><value>{7}</value></sharesOwnedFollowingTransaction></postTransactionAmounts></{0}>"
_FORM4 = f"<ownershipDocument><reportingOwner><reportingOwnerId><rptOwnerName>DOE JANE</rptOwnerName></reportingOwnerId><reportingOwnerRelationship><isDirector>1</isDirector><isOfficer>0</isOfficer><officerTitle>CFO</officerTitle></reportingOwnerRelationship></reportingOwner><nonDerivativeTable>{_TXN.format('nonDerivativeTransaction', 'Common', '2021-02-03', 'P', 10, 2.5, 'A', 110)}{_TXN.format('nonDerivativeTransaction', 'Common', '', 'S', 4, '', 'D', 106)}</nonDerivativeTable><derivativeTable>{_TXN.format('derivativeTransaction', 'Option', '2021-02-04-05:00', 'M', 5, 1, 'A', '')}</derivativeTable></ownershipDocument>"
landed(
    "insider_form4", "owner_name s, officer_title s, is_director s, is_officer s, is_derivative b, security_title s, txn_code s, shares d, price d, acq_disp s, shares_after d",
    [("AAA", "2021-02-03", "2021-02-05 18:00:00", "", "DOE JANE", "CFO", "1", "0", False, "Common", "P", 10.0, 2.5, "A", 110.0), ("AAA",
        "2021-02-05 18:00:00", "2021-02-05 18:00:00", "", "DOE JANE", "CFO", "1", "0", False, "Common", "S", 4.0, None, "D", 106.0), ("AAA",
        "2021-02-04", "2021-02-05 18:00:00", "", "DOE JANE", "CFO", "1", "0", True, "Option", "M", 5.0, 1.0, "A", None)],
    ("ticker string, filing_date string, accepted string, url string, xml string", [("AAA", "2021-02-05", "2021-02-05T18:00:00", "u", _FORM4)]),
)
_INFO = "<informationTable><infoTable><nameOfIssuer>ACME</nameOfIssuer><cusip>037833100</cusip><value>7</value><shrsOrPrnAmt><sshPrnamt>3</sshPrnamt></shrsOrPrnAmt></infoTable><infoTable><nameOfIssuer>BETA</nameOfIssuer><cusip>11</cusip><value>8</value><shrsOrPrnAmt><sshPrnamt>4</sshPrnamt></shrsOrPrnAmt><putCall>Put</putCall></infoTable></informationTable>"
landed(
    "holdings_13f", "issuer s, cusip s, value_usd_thousands d, shares d, put_call s",
    [("M", "2021-03-31", "2021-05-02 10:00:00", "acc", "ACME", "037833100", 7.0, 3.0, ""), ("M", "2021-03-31", "2021-05-02 10:00:00", "acc", "BETA", "11", 8.0, 4.0, "Put")],
    ("manager string, report_period string, filing_date string, accepted string, accession string, xml string", [("M", "2021-03-31", "2021-05-01", "2021-05-02T10:00:00", "acc", _INFO)]),
)
landed("security_master", "cik s, name s, exchange s, record_type s", [("AAA", "2021-01-04", "2021-01-04", "", "0000320193", "Acme", "NYSE", "identity")], ("ticker string, cik string, name string, exchange string", [("AAA", "0000320193", "Acme", "NYSE")]), collected_at="2021-01-04")
landed(
    "security_master", "index_name s, record_type s, action s, security s, reason s",
    [("A", "2021-01-04", "2021-01-04", "", "SP500", "change", "added", "Acme", "r"), ("B", "2021-01-05", "2021-01-05", "", "SP500", "change", "added", "Beta", "s"), ("C", "2021-01-05", "2021-01-05", "", "SP500", "change", "removed", "Gamma", "s")],
    ("date string, added string, added_security string, removed string, removed_security string, reason string", [("2021-01-04", "A", "Acme", "", "", "r"), ("2021-01-05", "B", "Beta", "C", "Gamma", "s")]), parse=index_changes, query="index_changes",
)

# News, texts, events, predictions

landed(
    "news_gdelt", "volume_pct d, avg_tone d",
    [("ECON", "2021-01-01", "2021-01-01", "", 1.5, -2.0), ("ECON", "2021-01-02", "2021-01-02", "", 2.5, None), ("ECON", "2021-01-03", "2021-01-03", "", None, -1.0)],
    ("theme string, date string, value string", [("ECON", "2021-01-01", "1.5"), ("ECON", "2021-01-02", "2.5")]), ("theme string, date string, value string", [("ECON", "2021-01-01", "-2"), ("ECON", "2021-01-03", "-1")]),
)
landed(
    "news_hn", "title s, url s, author s, points i, num_comments i, story_id s", [("fed", "2021-01-04 00:00:01", "2021-01-04 00:00:01", "", "Rates", "u", "ann", 5, 0, "77"), ("fed", "2021-01-04", "2021-01-04", "", "Ask", None, "bob", 0, 2, "78")],
    ("query string, objectID string, created_at_i long, title string, url string, author string, points long, num_comments long", [("fed",
        "77", 1609718401, "Rates", "u", "ann", 5, None), ("fed", "77", 1609718401, "Rates", "u", "ann", 5, None), ("fed", "78", 1609718400,
        "Ask", None, "bob", None, 2)]),
)


def _gkg(date: str, site: str, url: str, themes: str, persons: str, orgs: str, tone: str, extra: str) -> str:
    f = [""] * 27
    f[1], f[3], f[4], f[7], f[11], f[13], f[15], f[26] = date, site, url, themes, persons, orgs, tone, extra
    return "\t".join(f)


landed(
    "news_gkg", "title s, url s, site_domain s, themes s, organizations s, persons s, tone d, positive d, negative d, polarity d",
    [("site.com", "2021-01-04 12:00:00", "2021-01-04 12:00:00", "", "Hello", "u1", "site.com", "ECON, TAX", "Acme Inc, Beta", "Ann Doe", -1.5, 2.0, None, None)],
    ("value string", [(_gkg("20210104120000", "site.com", "u1", "ECON;TAX;", "ann doe,4", "acme inc,1;beta,9;acme inc,5", "-1.5,2,x",
        "<PAGE_TITLE>Hello</PAGE_TITLE>"),)] * 2 + [("too\tshort",), (_gkg("soon", "site.com", "u2", "", "", "", "", ""),), (_gkg("20210104120000",
        "site.com", "", "", "", "", "", ""),)]),
)
landed(
    "fed_text", "doc_type s, url s, text s, char_len i", [("FOMC", "2021-01-27", "2021-02-17", "", "minutes", "u1", "a b", 3), ("FOMC", "2021-01-27", "2021-01-27", "", "statement", "u2", "", 0)],
    ("doc_type string, url string, date string, html string", [("minutes", "u1", "2021-01-27", "<p>a  b</p>"), ("statement", "u2", "2021-01-27", "<p></p>")]),
)
landed(
    "fed_register", "title s, type s, abstract s, document_number s, agencies s, url s", [("Rule", "2021-01-04", "2021-01-04", "", "T", "Rule", None, "2021-1", "SEC, FDIC", "u")],
    ("document_number string, type string, title string, abstract string, publication_date string, html_url string, agencies array<struct<name:string>>", [("2021-1", "Rule", "T", None, "2021-01-04", "u", [("SEC",), ("FDIC",)]), ("2021-2", "Rule", "T", None, None, "u", [])]),
)
landed(
    "arxiv_papers", "arxiv_id s, title s, abstract s, authors s, primary_category s", [("q-fin.ST", "2021-01-04 10:00:00", "2021-01-04 10:00:00", "", "2101.00001v1", "On A", "We show.", "Ann, Bob", "q-fin.ST")],
    ("id string, title string, summary string, published string, author array<struct<name:string>>, category string", [("http://arxiv.org/abs/2101.00001v1", "On\n  A", " We show. ", "2021-01-04T10:00:00Z", [("Ann",), ("Bob",)], "q-fin.ST")]),
)
landed(
    "usgs_quakes", "magnitude d, place s, longitude d, latitude d, depth_km d, url s", [("EARTHQUAKE", "2021-01-04", "2021-01-04 00:20:00", "", 6.1, "sea", 1.5, 2.0, 3.0, "u")],
    ("id string, geometry struct<coordinates:array<double>>, properties struct<time:long,mag:double,place:string,url:string>", [("q1", ([1.5, 2.0, 3.0],), (1609718400000, 6.1, "sea", "u")), ("q2", ([1.0, 2.0, 3.0],), (None, 5.0, "sea", "u"))]),
)
landed(
    "nasa_events", "category s, title s, longitude d, latitude d, magnitude_value d, magnitude_unit s, event_id s",
    [("wildfires", "2021-01-04", "2021-01-05", "", "wildfires", "Fire", 10.0, 20.0, 5.5, "acres", "E1"), ("wildfires", "2021-01-06", "2021-01-07", "", "wildfires", "Fire", 11.0, 21.0, None, "", "E1")],
    ("id string, title string, categories array<struct<id:string,title:string>>, geometry array<struct<date:string,coordinates:array<double>,magnitudeValue:double,magnitudeUnit:string>>",
        [("E1", "Fire", [("wildfires", "Wildfires")], [("2021-01-04T00:00:00Z", [10.0, 20.0], 5.5, "acres"), ("2021-01-05T00:00:00Z", None,
        None, None), ("2021-01-06T00:00:00Z", [11.0, 21.0], None, None)])]),
)
landed(
    "predict_manifold", "question s, probability d, volume d", [("will-x", "2021-01-04", "2021-01-04", "", "X?", 0.7, 9.0), ("will-x", "2021-01-05", "2021-01-05", "", "X?", 0.4, 9.0), ("m2", "2021-01-04", "2021-01-04", "", "Y?", 0.5, 0.0)],
    ("market_id string, slug string, question string, createdTime long, probAfter double, volume double", [("m1", "will-x", "X?", 1609718400000,
        0.1, 9.0), ("m1", "will-x", "X?", 1609718500000, 0.7, 9.0), ("m1", "will-x", "X?", 1609804800000, 0.4, 9.0), ("m2", None, "Y?", 1609718400000,
        0.5, None)]),
)
landed(
    "predict_polymarket", "question s, probability d, outcome s, volume d", [("will-y", "2021-01-04", "2021-01-04", "", "Y?", 0.25, "Up", 5.0), ("m2", "2021-01-04", "2021-01-04", "", "Z?", 0.5, "Yes", 0.0)],
    ("id string, slug string, question string, volume string, clobTokenIds string, outcomes string", [("m1", "will-y", "Y?", "5", '["t1","t2"]', '["Up","Down"]'), ("m2", None, "Z?", None, '["t3"]', None), ("m3", "none", "N?", "1", None, "[]")]),
    ("token string, t long, p double", [("t1", 1609718400, 0.2), ("t1", 1609718401, 0.25), ("t2", 1609718400, 0.8), ("t3", 1609718400, 0.5)]),
)
landed(
    "predict_kalshi", "title s, probability d, series s", [("K1", "2021-01-04", "2021-01-04", "", "CPI?", 0.75, "CPI"), ("K1", "2021-01-05", "2021-01-05", "", "CPI?", 0.5, "CPI")],
    ("series string, ticker string, title string, volume double, end_period_ts long, close double, mean double, previous double, yes_bid double, yes_ask double",
        [("CPI", "K1", "CPI?", 9.0, 1609718400, 0.6, None, None, 0.0, 0.0), ("CPI", "K1", "CPI?", 9.0, 1609718500, None, 0.75, 0.1, 0.0, 0.0),
        ("CPI", "K1", "CPI?", 9.0, 1609804800, None, None, None, 0.4, 0.6), ("CPI", "K1", "CPI?", 9.0, 1609891200, None, None, None, 0.0, 0.0),
        ("CPI", "K2", "CPI 2?", 1.0, 1609718400, 0.9, None, None, None, None)]),
    top=1,
)
landed(
    "fda_events", "classification s, recalling_firm s, product_description s, reason s, status s", [("Acme", "2021-01-04", "2021-01-04", "", "Class I", "Acme", "pills", "dirt", "Ongoing")],
    ("report_date string, classification string, recalling_firm string, product_description string, reason_for_recall string, status string", [("20210104", "Class I", "Acme", "pills", "dirt", "Ongoing"), ("2021", "Class I", "Acme", "pills", "dirt", "Ongoing")]),
)
landed(
    "clinical_trials", "nct_id s, title s, status s, phase s, sponsor s, sponsor_class s, conditions s", [("Acme", "2021-01-04", "2021-01-04", "", "NCT1", "A trial", "RECRUITING", "PHASE1, PHASE2", "Acme", "INDUSTRY", "Asthma, Cough")],
    ("protocolSection struct<identificationModule:struct<nctId:string,briefTitle:string>,statusModule:struct<overallStatus:string,studyFirstPostDateStruct:struct<date:string>>,designModule:struct<phases:array<string>>,sponsorCollaboratorsModule:struct<leadSponsor:struct<name:string,class:string>>,conditionsModule:struct<conditions:array<string>>>",
        [((("NCT1", "A trial"), ("RECRUITING", ("2021-01-04",)), (["PHASE1", "PHASE2"],), (("Acme", "INDUSTRY"),), (["Asthma", "Cough"],)),
       ), ((("NCT2", "No date"), ("RECRUITING", (None,)), ([],), (("Acme", "INDUSTRY"),), ([],)),)]),
)


def queries() -> dict:
    return dict(Q)


def sql() -> dict:
    return dict(S)
