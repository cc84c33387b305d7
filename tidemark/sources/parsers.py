"""Pure parsers: what a source delivers, as a DataFrame, to rows of the lake (envelope and payload).

Each parser takes the frame that a Spark reader makes of landed files (JSON, CSV, text, XML in a text column) and gives
one projection of it. None fetches anything, cuts a text or leaves out old rows unless it is told to (`most`, `since`). `SOURCES` lists them with their place in the lake and their lag rule.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.envelope import stamp
from tidemark.functions.scalar import collapse, epoch, html_text, number, ratio

c = F.col
ts = lambda x, fmt=None: F.try_to_timestamp(x, F.lit(fmt)) if fmt else F.try_to_timestamp(x)
cut = lambda x, most: F.substring(x, 1, most) if most else x
since_day = lambda df, at, since: df.where(at >= F.lit(since).cast("timestamp")) if since else df.where(at.isNotNull())
num = lambda *names: {n: number(c(n)) for n in names}
txt = lambda *names: {n: c(n).cast("string") for n in names}


@dataclass(frozen=True)
class Source:
    name: str
    domain: str
    source: str
    shard: str
    rule: str
    parse: Callable[..., DataFrame] | None


SOURCES: dict[str, Source] = {}


def source(name: str, domain: str, src: str, shard: str, rule: str):
    """Registers a parser; it is called with `put`, a stamp for its place in the lake, before the raw frame."""

    def register(f):
        def parse(*raw, **kw):
            return f(lambda df, **s: stamp(df, domain=domain, source=src, **s), *raw, **kw)

        parse.__doc__ = f.__doc__
        SOURCES[name] = Source(name, domain, src, shard, rule, parse)
        return parse

    return register


def _bars(put, raw: DataFrame, lag: str) -> DataFrame:
    prices = ["open", "high", "low", "close", "adj_close", "volume"]
    have = [p for p in prices if p in raw.columns]
    df = raw.where(F.coalesce(*(number(c(p)) for p in have)).isNotNull())
    return put(df, entity=c("symbol"), event_time=ts(c("date").cast("string")), lag=lag, payload=num(*have))


@source("market_yahoo", "market", "yahoo", "batch", "event + 21 hours")
def market_yahoo(put, raw):
    """CSV of symbol, date and prices; rows without any number are left out."""
    return _bars(put, raw, "21 HOURS")


@source("crypto_yahoo", "crypto", "yahoo", "asset", "event + 1 day")
def crypto_yahoo(put, raw):
    return _bars(put, raw, "1 DAY")


def _fred(put, raw: DataFrame) -> DataFrame:
    """observations (series_id, date, value, realtime_start?): a release date makes a vintage, else a day's lag."""
    release = ts(c("realtime_start").cast("string")) if "realtime_start" in raw.columns else F.lit(None).cast("timestamp")
    at = ts(c("date").cast("string"))
    df = raw.where((c("value") != ".") & number(c("value")).isNotNull())
    vintage = F.date_format(release, "yyyy-MM-dd")
    return put(df, entity=c("series_id"), event_time=at, knowledge_time=F.coalesce(release, at + F.expr("INTERVAL 1 DAY")), vintage_id=vintage, payload=num("value"))


for _name, _domain, _source in (("macro_alfred", "macro", "alfred"), ("credit_fred", "credit", "fred"), ("real_estate_fred", "real_estate", "fred"), ("commodities_fred", "commodity", "fred")):
    source(_name, _domain, _source, "series", "release date, else event + 1 day")(_fred)


@source("edgar", "events", "edgar", "year, quarter", "filing date")
def edgar_index(put, raw):
    """Lines `cik|company|form|date|file` of the index; others have no four bars or no date."""
    p = F.split("value", r"\|")
    df = raw.where((F.size(p) == 5) & ts(p[3]).isNotNull())
    return put(df, entity=p[0], event_time=ts(p[3]), url=p[4], payload={"company": p[1], "form": p[2], "filename": p[4]})


@source("edgar_fulltext", "filings_text", "edgar", "ticker", "acceptance, else filing date")
def edgar_fulltext(put, raw, forms=("8-K", "10-K", "10-Q"), most=None):
    """Filings with their HTML."""
    df = raw.where(c("form").isin(*forms))
    text = html_text(c("html"), most)
    at = ts(c("filing_date").cast("string"))
    known = F.coalesce(ts(c("accepted").cast("string")), at)
    return put(df, entity=c("ticker"), event_time=at, knowledge_time=known, url=c("url"), payload={**txt("form", "accession", "primary_doc", "url"), "text": text, "char_len": F.length(text).cast("long")})


@source("news_gdelt", "news", "gdelt", "theme", "event")
def news_gdelt(put, volume, tone):
    """Two timelines (theme, date, value), joined in full: a day of either has a row."""
    v, t = (d.select("theme", "date", number(c("value")).alias(n)) for d, n in ((volume, "volume_pct"), (tone, "avg_tone")))
    return put(v.join(t, ["theme", "date"], "full"), entity=c("theme"), event_time=ts(c("date").cast("string")), payload=num("volume_pct", "avg_tone"))


@source("news_hn", "news", "hackernews", "query", "creation")
def news_hn(put, raw):
    df = raw.dropDuplicates(["objectID"])
    count = lambda n: F.coalesce(c(n).cast("long"), F.lit(0))
    return put(df, entity=c("query"), event_time=epoch(c("created_at_i")), url=c("url"), payload={**txt("title", "url", "author"), "points": count("points"), "num_comments": count("num_comments"), "story_id": c("objectID").cast("string")})


@source("wiki_pageviews", "attention", "wikipedia", "article", "event + 1 day")
def wiki_pageviews(put, raw):
    return put(raw, entity=c("article"), event_time=ts(F.substring("timestamp", 1, 8), "yyyyMMdd"), lag="1 DAY", payload=num("views"))


FACTS = "map<string, struct<units: map<string, array<struct<start: string, `end`: string, val: double, accn: string, fy: string, fp: string, form: string, filed: string>>>>>"


@source("fundamentals_sec", "fundamentals", "sec_xbrl", "ticker", "filing date")
def fundamentals_sec(put, raw):
    """ticker and the JSON text of its company facts; points without value, end or filing date are left out."""
    concept = raw.select("ticker", F.explode(F.from_json("facts", FACTS)).alias("concept", "body"))
    unit = concept.select("ticker", "concept", F.explode("body.units").alias("unit", "points"))
    p = unit.select("ticker", "concept", "unit", F.inline("points")).where("val is not null and `end` is not null and filed is not null")
    payload = {"concept": c("concept"), "unit": c("unit"), "value": c("val"), "form": c("form"), "fiscal_year": c("fy"), "fiscal_period": c("fp"), "period_start": c("start")}
    return put(p, entity=c("ticker"), event_time=ts(c("end")), knowledge_time=ts(c("filed")), vintage_id=c("accn"), payload=payload)


#: Column of the source to column of the lake.
COT = {"open_interest_all": "open_interest", "noncomm_positions_long_all": "noncomm_long", "noncomm_positions_short_all": "noncomm_short",
    "comm_positions_long_all": "comm_long", "comm_positions_short_all": "comm_short", "nonrept_positions_long_all": "nonrept_long", "nonrept_positions_short_all": "nonrept_short"}


@source("cftc_cot", "positioning", "cftc", "year", "event + 3 days")
def cftc_cot(put, raw):
    at = ts(c("report_date_as_yyyy_mm_dd").cast("string"))
    return put(raw.where(at.isNotNull()), entity=c("contract_market_name"), event_time=at, lag="3 DAYS", payload={new: number(c(old)) for old, new in COT.items()})


@source("short_finra", "positioning", "finra_short", "year, month", "event + 1 day")
def short_finra(put, raw):
    """Date|Symbol|ShortVolume|ShortExemptVolume|TotalVolume; the ratio is null where nothing was traded."""
    s, e, t = (number(c(n)) for n in ("ShortVolume", "ShortExemptVolume", "TotalVolume"))
    df = raw.where(c("Symbol").isNotNull())
    return put(df, entity=c("Symbol"), event_time=ts(c("Date").cast("string"), "yyyyMMdd"), lag="1 DAY", payload={"short_volume": s, "short_exempt_volume": e, "total_volume": t, "short_ratio": ratio(s, t)})


#: Numeric columns of an auction.
AUCTION = ("interestRate", "highYield", "highDiscountRate", "bidToCoverRatio", "offeringAmount", "totalAccepted", "totalTendered")


@source("treasury_auctions", "macro", "treasury", "type", "auction date")
def treasury_auctions(put, raw, since=None):
    """Auctions with the type they were asked for (`type`); numbers that the source left out are null."""
    at = ts(c("auctionDate").cast("string"))
    numbers = {n: number(c(n)) if n in raw.columns else F.lit(None).cast("double") for n in AUCTION}
    texts = {"cusip": c("cusip"), "security_term": c("securityTerm"), "maturity_date": c("maturityDate")}
    return put(since_day(raw, at, since), entity=c("type"), event_time=at, payload={**{n: x.cast("string") for n, x in texts.items()}, **numbers})


#: Tags of the ownership form.
FORM4_ROW = "struct<securityTitle:struct<value:string>,transactionDate:struct<value:string>,transactionCoding:struct<transactionCode:string>,transactionAmounts:struct<transactionShares:struct<value:string>,transactionPricePerShare:struct<value:string>,transactionAcquiredDisposedCode:struct<value:string>>,postTransactionAmounts:struct<sharesOwnedFollowingTransaction:struct<value:string>>>"
FORM4 = f"reportingOwner struct<reportingOwnerId:struct<rptOwnerName:string>,reportingOwnerRelationship:struct<isDirector:string,isOfficer:string,officerTitle:string>>, nonDerivativeTable struct<nonDerivativeTransaction:array<{FORM4_ROW}>>, derivativeTable struct<derivativeTransaction:array<{FORM4_ROW}>>"


@source("insider_form4", "positioning", "sec_form4", "ticker", "acceptance, else filing date")
def insider_form4(put, raw):
    """ticker, filing_date, accepted, url and the XML; a row per transaction of both tables."""
    x = raw.select("*", F.from_xml("xml", FORM4).alias("d"))
    rows = lambda path, flag: F.transform(F.coalesce(c(path), F.array()), lambda t: F.struct(F.lit(flag).alias("deriv"), t.alias("t")))
    both = F.concat(rows("d.nonDerivativeTable.nonDerivativeTransaction", False), rows("d.derivativeTable.derivativeTransaction", True))
    df = x.select("*", F.inline(both))
    known = F.coalesce(ts(c("accepted").cast("string")), ts(c("filing_date").cast("string")))
    rel, amounts = "d.reportingOwner.reportingOwnerRelationship.", "t.transactionAmounts."
    return put(
        df, entity=c("ticker"), event_time=F.coalesce(ts(F.substring("t.transactionDate.value", 1, 10)), known), knowledge_time=known, url=c("url"),
        payload={
            "owner_name": c("d.reportingOwner.reportingOwnerId.rptOwnerName"), "officer_title": c(rel + "officerTitle"), "is_director": c(rel + "isDirector"), "is_officer": c(rel + "isOfficer"),
            "is_derivative": c("deriv"), "security_title": c("t.securityTitle.value"), "txn_code": c("t.transactionCoding.transactionCode"), "shares": number(c(amounts + "transactionShares.value")),
            "price": number(c(amounts + "transactionPricePerShare.value")), "acq_disp": c(amounts + "transactionAcquiredDisposedCode.value"), "shares_after": number(c("t.postTransactionAmounts.sharesOwnedFollowingTransaction.value")),
        },
    )


@source("fed_text", "policy", "fomc", "all", "minutes + 21 days, statements + 0")
def fed_text(put, raw, most=None):
    """doc_type, url, date and HTML; char_len counts the text before it is cut to `most`."""
    text = html_text(c("html"))
    at = ts(c("date").cast("string"))
    known = at + F.when(c("doc_type") == "minutes", F.expr("INTERVAL 21 DAYS")).otherwise(F.expr("INTERVAL 0 DAYS"))
    return put(raw, entity="FOMC", event_time=at, knowledge_time=known, url=c("url"), payload={**txt("doc_type", "url"), "text": cut(text, most), "char_len": F.length(text).cast("long")})


def fed_links(pages: DataFrame, pattern: str = r'href="([^"]*(?:monetary|fomcminutes)\d{8}[^"]*)"') -> DataFrame:
    """Distinct links of statements and minutes on index pages (column html)."""
    return pages.select(F.explode(F.regexp_extract_all("html", F.lit(pattern), F.lit(1))).alias("url")).distinct()


INFO = "infoTable array<struct<nameOfIssuer:string,cusip:string,value:string,shrsOrPrnAmt:struct<sshPrnamt:string>,putCall:string>>"


@source("holdings_13f", "ownership", "sec_13f", "manager", "acceptance, else filing date")
def holdings_13f(put, raw):
    """manager, report_period, filing_date, accepted, accession and the XML; a row per line of the table."""
    df = raw.select("*", F.inline(F.coalesce(F.from_xml("xml", INFO).getField("infoTable"), F.array())))
    filed = ts(c("filing_date").cast("string"))
    return put(
        df, entity=c("manager"), event_time=F.coalesce(ts(c("report_period").cast("string")), filed), knowledge_time=F.coalesce(ts(c("accepted").cast("string")), filed), vintage_id=c("accession"),
        payload={"issuer": c("nameOfIssuer"), "cusip": c("cusip"), "value_usd_thousands": number(c("value")), "shares": number(c("shrsOrPrnAmt.sshPrnamt")), "put_call": F.coalesce("putCall", F.lit(""))},
    )


@source("crypto_onchain", "onchain", "blockchain", "metric", "event + 1 day")
def crypto_onchain(put, raw):
    return put(raw, entity="BTC", event_time=epoch(c("x")), lag="1 DAY", payload={"metric": c("metric"), "value": number(c("y"))})


@source("eia_energy", "commodity", "eia", "series", "event + 4 days")
def eia_energy(put, raw):
    return put(raw.where(c("value").isNotNull()), entity=c("series"), event_time=ts(c("period").cast("string")), lag="4 DAYS", payload={"series": c("series"), "value": number(c("value"))})


@source("security_master", "reference", "master", "kind", "collection; a change: effective date")
def security_master(put, identities, collected_at):
    """ticker, cik, name, exchange as seen at `collected_at`."""
    at = F.lit(collected_at).cast("timestamp")
    return put(identities, entity=c("ticker"), event_time=at, payload={**txt("cik", "name", "exchange"), "record_type": F.lit("identity")})


def index_changes(changes: DataFrame, index_name: str = "SP500") -> DataFrame:
    """date, added, removed (ticker and security of either, may be empty) and reason: a row for each move."""
    move = lambda action: F.struct(F.lit(action).alias("action"), c(action).alias("ticker"), c(f"{action}_security").alias("security"))
    df = changes.select("date", "reason", F.inline(F.array(move("added"), move("removed")))).where("ticker is not null and trim(ticker) != ''")
    at = ts(c("date").cast("string"))
    return stamp(df, domain="reference", source="master", entity=c("ticker"), event_time=at, payload={"index_name": F.lit(index_name), "record_type": F.lit("change"), "action": c("action"), "security": c("security"), "sector": F.lit(None).cast("string"), "reason": c("reason")})


@source("defillama", "crypto_defi", "defillama", "series", "event + 1 day")
def defillama(put, raw, since=None):
    """series, date and tvl; of the series `stablecoins` totalCirculatingUSD.peggedUSD. Points without date or value are left out."""
    stable = c("series") == "stablecoins"
    value = F.when(stable, number(c("totalCirculatingUSD.peggedUSD"))).otherwise(number(c("tvl")))
    at = epoch(c("date"))
    df = since_day(raw, at, since).where(value.isNotNull())
    return put(df, entity=c("series"), event_time=at, lag="1 DAY", payload={"metric": F.when(stable, "stablecoin_mcap_usd").otherwise("tvl_usd"), "value": value})


@source("defillama_flows", "crypto_defi", "defillama_flows", "metric", "event + 1 day")
def defillama_flows(put, raw):
    """metric and points, pairs of seconds and dollars."""
    df = raw.select("metric", F.explode("points").alias("p"))
    return put(df, entity=c("metric"), event_time=epoch(c("p")[0]), lag="1 DAY", payload={"metric": c("metric"), "value_usd": c("p")[1].cast("double")})


@source("usgs_quakes", "events", "usgs", "year", "event + 20 minutes")
def usgs_quakes(put, raw):
    """GeoJSON features; coordinates by place in their array."""
    p, xyz = "properties.", c("geometry.coordinates")
    at = lambda i: F.get(xyz, F.lit(i)).cast("double")
    return put(raw.where(c(p + "time").isNotNull()), entity="EARTHQUAKE", event_time=epoch(c(p + "time"), "ms"), lag="20 MINUTES", url=c(p + "url"), payload={"magnitude": number(c(p + "mag")), "place": c(p + "place"), "longitude": at(0), "latitude": at(1), "depth_km": at(2), "url": c(p + "url")})


@source("arxiv_papers", "research", "arxiv", "category", "publication")
def arxiv_papers(put, raw, most_authors=None, most=None):
    """Atom entries: id, title, summary, published, author array, category."""
    authors = cut(F.array_join(F.transform("author", lambda a: a["name"]), ", "), most_authors)
    return put(raw, entity=c("category"), event_time=ts(c("published").cast("string")), url=c("id"), payload={"arxiv_id": F.regexp_extract("id", r"abs/(.+)$", 1), "title": collapse(c("title")), "abstract": cut(collapse(c("summary")), most), "authors": authors, "primary_category": c("category")})


def _last_of_day(df: DataFrame, keys: list[str], at: Column, value: Column, keep: dict[str, Column]) -> DataFrame:
    day = F.date_trunc("day", at)
    return df.groupBy(*keys, day.alias("day")).agg(F.max_by(value, at).alias("probability"), *(F.max_by(v, at).alias(n) for n, v in keep.items()))


@source("predict_manifold", "predictions", "manifold", "topic", "day")
def predict_manifold(put, raw):
    """Bets (market_id, slug?, question, createdTime in ms, probAfter, volume): the last of each day; the slug names the market."""
    name = F.coalesce(*(c(n) for n in ("slug", "market_id") if n in raw.columns)).cast("string")
    df = _last_of_day(raw, ["market_id"], epoch(c("createdTime"), "ms"), number(c("probAfter")), {"name": name, "question": c("question"), "volume": F.coalesce(number(c("volume")), F.lit(0.0))})
    return put(df, entity=c("name"), event_time=c("day"), payload={"question": c("question"), **num("probability", "volume")})


@source("predict_polymarket", "predictions", "polymarket", "page", "day")
def predict_polymarket(put, markets, points):
    """Markets (slug, id, question, volume, and JSON lists of outcomes and tokens in strings), and price points by token
    (token, t in seconds, p) of each market's first token. A market without a name for its outcome has `Yes`."""
    tokens, names = F.from_json("clobTokenIds", "array<string>"), F.from_json("outcomes", "array<string>")
    name = F.coalesce(*(c(n).cast("string") for n in ("slug", "id") if n in markets.columns))
    df = markets.select(name.alias("name"), "question", F.coalesce(number(c("volume")), F.lit(0.0)).alias("volume"), F.get(tokens, F.lit(0)).alias("token"), F.coalesce(F.get(names, F.lit(0)), F.lit("Yes")).alias("outcome"))
    daily = _last_of_day(points.join(df, "token"), ["token"], epoch(c("t")), number(c("p")), {n: c(n) for n in ("name", "question", "outcome", "volume")})
    return put(daily, entity=c("name"), event_time=c("day"), payload={**txt("question"), "probability": c("probability"), **txt("outcome"), "volume": c("volume")})


def contract_probability(close: Column, mean: Column, previous: Column, bid: Column, ask: Column) -> Column:
    """The first of close, mean and previous price; else the middle of bid and ask; else the one there is. 0 is no price."""
    b, a = F.nullif(bid, F.lit(0.0)), F.nullif(ask, F.lit(0.0))
    return F.coalesce(close, mean, previous, (a + b) / 2, a, b)


@source("predict_kalshi", "predictions", "kalshi", "category", "day")
def predict_kalshi(put, raw, top=None):
    """Candles of markets; the `top` markets of each series by volume (all if not told), the last candle of each day."""
    from tidemark.operators.asof import ranked

    if top:
        best = ranked(raw.groupBy("series", "ticker").agg(F.max(number(c("volume"))).alias("v")), ["series"], [c("v").desc_nulls_last(), c("ticker").asc()], top)
        raw = raw.join(best.select("ticker"), "ticker", "left_semi")
    p = contract_probability(*(number(c(n)) for n in ("close", "mean", "previous", "yes_bid", "yes_ask")))
    df = _last_of_day(raw.withColumn("_p", p).where("_p is not null"), ["ticker"], epoch(c("end_period_ts")), c("_p"), {"title": c("title"), "series": c("series")})
    return put(df, entity=c("ticker"), event_time=c("day"), payload={"title": c("title"), "probability": c("probability"), "series": c("series")})


@source("nasa_events", "events", "nasa_eonet", "year", "event + 1 day")
def nasa_events(put, raw):
    """Events with an array of dated geometries: a row for each point; polygons (no pair of numbers) are left out."""
    df = raw.select("id", "title", F.coalesce(F.get(c("categories"), F.lit(0))["id"], F.lit("")).alias("category"), F.explode("geometry").alias("g"))
    xy = lambda i: F.get(c("g.coordinates"), F.lit(i)).cast("double")
    at = ts(c("g.date"))
    df = df.where(at.isNotNull() & (F.size("g.coordinates") >= 2))
    return put(df, entity=c("category"), event_time=at, lag="1 DAY", payload={"category": c("category"), "title": c("title"), "longitude": xy(0),
        "latitude": xy(1), "magnitude_value": c("g.magnitudeValue").cast("double"), "magnitude_unit": F.coalesce(c("g.magnitudeUnit").cast("string"),
        F.lit("")), "event_id": c("id")})


@source("crypto_funding", "crypto_deriv", "okx", "instrument", "settlement")
def crypto_funding(put, raw):
    return put(raw, entity=c("instId"), event_time=epoch(c("fundingTime"), "ms"), payload={"funding_rate": number(c("fundingRate")), "realized_rate": number(c("realizedRate"))})


@source("crypto_vol", "crypto_deriv", "deribit", "currency", "event + 1 day")
def crypto_vol(put, raw):
    """currency and data, arrays of ms, open, high, low, close."""
    df = raw.select("currency", F.explode("data").alias("p"))
    return put(df, entity=c("currency"), event_time=epoch(c("p")[0], "ms"), lag="1 DAY", payload={f"dvol_{n}": c("p")[i].cast("double") for i, n in enumerate(("open", "high", "low", "close"), 1)})


@source("crypto_fng", "sentiment", "alt_fng", "all", "event + 1 day")
def crypto_fng(put, raw):
    return put(raw, entity="crypto_market", event_time=epoch(c("timestamp")), lag="1 DAY", payload={"fng_value": number(c("value")), "classification": c("value_classification")})


@source("fed_register", "policy", "federal_register", "year", "publication")
def fed_register(put, raw):
    agencies = F.array_join(F.transform("agencies", lambda a: a["name"]), ", ")
    at = ts(c("publication_date").cast("string"))
    return put(raw.where(at.isNotNull()), entity=c("type"), event_time=at, url=c("html_url"), payload={**txt("title", "type", "abstract", "document_number"), "agencies": agencies, "url": c("html_url")})


@source("fda_events", "events", "openfda", "year", "report date")
def fda_events(put, raw, most=None):
    at = ts(c("report_date").cast("string"), "yyyyMMdd")
    return put(raw.where(at.isNotNull()), entity=c("recalling_firm"), event_time=at, payload={**txt("classification", "recalling_firm"), "product_description": cut(c("product_description"), most), "reason": cut(c("reason_for_recall"), most), **txt("status")})


@source("epu_index", "sentiment", "epu", "region", "event + 1 month")
def epu_index(put, raw):
    """Year, Month and two indices, told by their names; the footer has no month."""
    df = raw.where(number(c("Year")).isNotNull() & number(c("Month")).isNotNull())
    at = F.make_date(number(c("Year")).cast("int"), number(c("Month")).cast("int"), F.lit(1)).cast("timestamp")
    index = lambda *parts: next((number(c(f"`{n}`")) for n in raw.columns if any(x in n for x in parts)), F.lit(None).cast("double"))
    return put(df, entity="US", event_time=at, lag="1 MONTH", payload={"epu_3component": index("Three_Component", "3component"), "epu_news_based": index("News_Based", "news_based")})


@source("clinical_trials", "research", "clinicaltrials", "year", "first post")
def clinical_trials(put, raw, most_conditions=None):
    """protocolSection of studies."""
    p = "protocolSection."
    sponsor = c(p + "sponsorCollaboratorsModule.leadSponsor")
    conditions = c(p + "conditionsModule.conditions")
    conditions = F.array_join(F.slice(conditions, 1, most_conditions) if most_conditions else conditions, ", ")
    at = ts(c(p + "statusModule.studyFirstPostDateStruct.date").cast("string"))
    payload = {"nct_id": c(p + "identificationModule.nctId"), "title": c(p + "identificationModule.briefTitle"), "status": c(p + "statusModule.overallStatus"),
        "phase": F.array_join(c(p + "designModule.phases"), ", "), "sponsor": sponsor["name"], "sponsor_class": sponsor["class"], "conditions": conditions}
    return put(raw.where(at.isNotNull()), entity=sponsor["name"], event_time=at, payload=payload)


@source("news_gkg", "news", "gdelt_gkg", "year, month", "publication")
def news_gkg(put, raw):
    """Tab-separated lines of at least 27 fields; a url once; tone and its parts by place, where they are numbers."""
    f = F.split("value", "\t")
    df = raw.where(F.size(f) >= 27).select(f.alias("f")).withColumn("url", c("f")[4]).where("url != ''").dropDuplicates(["url"])
    names = lambda i: F.array_join(F.array_distinct(F.transform(F.filter(F.split(c("f")[i], ";"), lambda x: x != ""), lambda x: F.initcap(F.split_part(x, F.lit(","), F.lit(1))))), ", ")
    tone = F.split(c("f")[15], ",")
    at = ts(c("f")[1], "yyyyMMddHHmmss")
    parts = {n: F.get(tone, F.lit(i)).try_cast("double") for i, n in enumerate(("tone", "positive", "negative", "polarity"))}
    payload = {"title": F.regexp_extract(c("f")[26], "<PAGE_TITLE>(.*?)</PAGE_TITLE>", 1), "url": c("url"), "site_domain": c("f")[3], "themes": F.array_join(F.filter(F.split(c("f")[7], ";"), lambda x: x != ""), ", "), "organizations": names(13), "persons": names(11), **parts}
    return put(df.where(at.isNotNull()), entity=c("f")[3], event_time=at, url=c("url"), payload=payload)


@source("market_fng", "sentiment", "cnn_fng", "all", "event + 1 day")
def market_fng(put, raw):
    """component, and data as points of ms, score and rating: the first point of a component and day."""
    points = raw.select("component", F.inline("data")).select("component", F.date_trunc("day", epoch(c("x"), "ms")).alias("at"), F.struct("x", c("y").cast("double").alias("score"), "rating").alias("p"))
    df = points.groupBy("component", "at").agg(F.min_by("p", "p.x").alias("p"))
    return put(df, entity=c("component"), event_time=c("at"), lag="1 DAY", payload={"score": c("p.score"), "rating": c("p.rating")})


for _name, _domain, _source in (("features", "features", "derived"), ("entity_graph", "graph", "derived"), ("surprise_index", "derived", "surprise")):
    SOURCES[_name] = Source(_name, _domain, _source, "kind", "greatest of its inputs", None)
for _name, _domain, _source in (("options_polygon", "options", "polygon"), ("intraday_polygon", "market", "polygon_intraday"), ("transcripts_fmp",
    "fundamentals", "fmp_transcripts"), ("estimates_fmp", "fundamentals", "fmp_estimates"), ("news_tiingo", "news", "tiingo"), ("shipping_ais",
    "alt", "shipping_ais")):
    SOURCES[_name] = Source(_name, _domain, _source, "", "needs a key; no data", None)


def universe(seed: DataFrame, listed: DataFrame, top: int | None = None) -> DataFrame:
    """ticker, position: the seed in its order, then listed tickers in theirs (the first `top`), each once."""
    from pyspark.sql import Window

    rows = seed.select("ticker", F.lit(0).alias("p"), "position").unionByName((listed.where(c("position") < top) if top else listed).select("ticker", F.lit(1).alias("p"), "position"))
    first = rows.groupBy(F.upper(F.trim("ticker")).alias("ticker")).agg(F.min(F.struct("p", "position")).alias("o"))
    return first.select("ticker", F.row_number().over(Window.orderBy("o.p", "o.position", "ticker")).alias("position"))
