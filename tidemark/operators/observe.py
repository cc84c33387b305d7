"""The observation of a moment: all channels of a lake as one small frame, as a dict, and as a text.

Each channel is a plan of its own; they come out in one frame `channel, position, name, value, text` and so in one job. A
channel whose source the lake does not have is empty. Nothing known later than the moment is in it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import channels

# Series and tickers that the channels show.
MACRO = ["CPIAUCSL", "UNRATE", "FEDFUNDS", "GDPC1", "PAYEMS"]
RATES = ["DGS2", "DGS10", "T10Y2Y", "MORTGAGE30US", "VIXCLS"]
CREDIT = ["BAMLH0A0HYM2", "BAMLC0A0CM", "NFCI", "STLFSI4"]
COMMODITIES = ["DCOILWTICO", "DCOILBRENTEU", "DHHNGSP"]
WATCHLIST = ["SPY", "QQQ", "IWM", "AAPL", "NVDA", "MSFT", "TLT", "GLD", "HYG"]
COINS = ["BTC", "ETH"]
REGIME = ("regime", "vix_pct_252", "curve_inverted", "risk_appetite")
CHANNELS = ("regime", "prices", "rates", "macro", "credit", "commodities", "market_fng", "crypto", "predictions", "events", "news")


def _rows(df: DataFrame, channel: str, order: list[Column], name: Column, value: Column | None = None, text: Column | None = None) -> DataFrame:
    """Rows of a channel in their order; a channel is small by its limits, so one window numbers it."""
    none = F.lit(None)
    at = F.row_number().over(Window.partitionBy(F.lit(channel)).orderBy(*order))
    return df.select(
        F.lit(channel).alias("channel"), at.alias("position"), name.cast("string").alias("name"),
        (none if value is None else value).cast("double").alias("value"), (none if text is None else text).cast("string").alias("text"),
    )


class Observer:
    def __init__(self, lake, watchlist: list[str] | None = None, series: dict[str, list[str]] | None = None):
        """`series` gives the ids of `rates, macro, credit, commodities, coins, market_fng`, where they are not the usual ones."""
        usual = {"rates": RATES, "macro": MACRO, "credit": CREDIT, "commodities": COMMODITIES, "coins": COINS, "market_fng": ["FNG"]}
        self.lake, self.watchlist, self.series = lake, watchlist or WATCHLIST, usual | (series or {})

    def _levels(self, t, channel: str, domain: str, source: str, value: str = "value", shown=lambda v: v) -> DataFrame:
        df = channels.levels(self.lake.scan(domain, source), t, self.series[channel], value)
        return _rows(df, "crypto" if channel == "coins" else channel, [F.col("entity")], F.col("entity"), shown(F.col(value)))

    def _regime(self, t) -> DataFrame:
        df = channels.market_regime(self.lake, t)
        pairs = [F.struct(F.lit(i).alias("at"), F.lit(n).alias("name"), F.col(n).try_cast("double").alias("v"), F.col(n).cast("string").alias("s")) for i, n in enumerate(REGIME)]
        df = df.select(F.inline(F.array(*pairs)))
        return _rows(df, "regime", [F.col("at")], F.col("name"), F.col("v"), F.when(F.col("name") == "regime", F.col("s")))

    def _single(self, t, domain: str, source: str, entity: str, value: str, name: str, shown) -> DataFrame:
        df = channels.levels(self.lake.scan(domain, source), t, [entity], value)
        return _rows(df, "crypto", [F.col("entity")], F.lit(name), shown(F.col(value)))

    def _news(self, t) -> DataFrame:
        posts = self._try(lambda: self.lake.scan("news", "hackernews"))
        df = channels.news(self.lake.scan("news", "gdelt_gkg"), posts, t)
        return _rows(df, "news", [F.col("strength").desc_nulls_last(), F.col("title")], F.col("outlet"), F.col("strength"), F.col("title"))

    def _predictions(self, t) -> DataFrame:
        df = channels.markets(self.lake.scan("predictions", "manifold"), t)
        return _rows(df, "predictions", [F.col("volume").desc_nulls_last(), F.col("entity")], F.col("entity"), F.col("probability"), F.col("question"))

    @staticmethod
    def _try(make):
        try:
            return make()
        except (FileNotFoundError, KeyError):
            return None

    def frame(self, t) -> DataFrame | None:
        """All channels known at t; None if the lake has no source of any."""
        one, tens, whole = (lambda v: v), (lambda v: F.round(v, 1)), (lambda v: v.cast("long"))
        prices = lambda: _rows(channels.prices(self.lake.scan("market", "yahoo"), t, self.watchlist), "prices", [F.col("entity")], F.col("entity"), F.col("close"))
        events = lambda: _rows(channels.shocks(self.lake.scan("events", "usgs"), t), "events", [F.col("magnitude").desc(), F.col("event")], F.lit("USGS"), F.col("magnitude"), F.col("event"))
        makers = [
            lambda: self._regime(t), prices, lambda: self._levels(t, "rates", "macro", "alfred"), lambda: self._levels(t, "macro", "macro", "alfred"),
            lambda: self._levels(t, "credit", "credit", "fred"), lambda: self._levels(t, "commodities", "commodity", "fred"),
            lambda: self._levels(t, "market_fng", "sentiment", "cnn_fng", "score", one), lambda: self._levels(t, "coins", "crypto", "yahoo", "close", tens),
            lambda: self._single(t, "sentiment", "alt_fng", "crypto_market", "fng_value", "fear_greed", whole),
            lambda: self._single(t, "crypto_deriv", "deribit", "BTC", "dvol_close", "BTC_implied_vol", tens),
            lambda: self._predictions(t), events, lambda: self._news(t),
        ]
        out = None
        for make in makers:
            df = self._try(make)
            if df is not None:
                out = df if out is None else out.unionByName(df)
        return out

    def __call__(self, lake, t) -> dict:
        """The observation as a dict of channels, with `as_of` and `text`; some dozens of rows by the limits of the channels."""
        iso = t if isinstance(t, str) else t.isoformat(sep=" ", timespec="seconds")
        df = self.frame(iso)
        rows = sorted(df.collect(), key=lambda r: (r.channel, r.position)) if df is not None else []
        got: dict = {c: [] for c in CHANNELS}
        for r in rows:
            got[r.channel].append(r)
        pairs = lambda c, v: [{"entity": r.name, v: r.value} for r in got[c]]
        obs = {
            "as_of": iso,
            "regime": [{r.name: r.text if r.name == "regime" else r.value for r in got["regime"]}] if got["regime"] else [],
            "prices": pairs("prices", "close"),
            **{c: pairs(c, "value") for c in ("rates", "macro", "credit", "commodities")},
            "crypto": {r.name: r.value for r in got["crypto"]},
            "market_fng": pairs("market_fng", "value"),
            "predictions": [{"question": r.text, "probability": r.value} for r in got["predictions"]],
            "news": [{"title": r.text, "outlet": r.name, "tone": r.value} for r in got["news"]],
            "events": [{"event": r.text} for r in got["events"]],
        }
        return obs | {"text": rendered(obs)}


def rendered(obs: dict) -> str:
    """The observation as text, a line a channel; the texts of the lines are fixed values."""
    listed = lambda rows: ", ".join(f"{r['entity']}={r['value']:.2f}" for r in rows) or "—"
    lines = [f"=== World state as of {obs['as_of']} (only info knowable by now) ==="]
    for r in obs["regime"]:
        curve = "inverted" if r.get("curve_inverted") else "normal"
        lines.append(f"Regime: {r['regime']} (VIX pct {r['vix_pct_252'] or 0:.0%}, curve {curve}, risk-appetite {r['risk_appetite'] or 0:+.2f})")
    if obs["prices"]:
        lines.append("Equities: " + ", ".join(f"{r['entity']} {r['close']:.2f}" for r in obs["prices"]))
    for title, channel in (("Rates", "rates"), ("Macro", "macro"), ("Credit/conditions", "credit"), ("Commodities", "commodities")):
        lines.append(f"{title}: {listed(obs[channel])}")
    if obs["market_fng"]:
        lines.append(f"Market Fear&Greed: {obs['market_fng'][0]['value']:.0f}")
    if obs["crypto"]:
        lines.append("Crypto: " + ", ".join(f"{k}={v}" for k, v in obs["crypto"].items()))
    if obs["predictions"]:
        lines.append("Crowd beliefs: " + "; ".join(f"{r['probability']:.0%} {r['question'][:60]}" for r in obs["predictions"]))
    if obs["events"]:
        lines.append("Recent shocks: " + "; ".join(r["event"][:50] for r in obs["events"]))
    if obs["news"]:
        lines += ["Top headlines:", *(f"  - ({r['outlet']}) {r['title'][:90]}" for r in obs["news"])]
    return "\n".join(lines)
