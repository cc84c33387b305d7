"""How far each source can be trusted about the past, and reading that enforces it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Classes whose rows show what was known then.
SAFE = ("immutable", "vintage", "derived", "forward_limited")
#: Class of each (domain, source), by class.
CLASSES = {
    "immutable": [
        ("market", "yahoo"), ("crypto", "yahoo"), ("events", "edgar"), ("filings_text", "edgar"), ("news", "gdelt"), ("news", "hackernews"),
        ("attention", "wikipedia"), ("positioning", "cftc"), ("positioning", "finra_short"), ("macro", "treasury"), ("positioning", "sec_form4"),
        ("policy", "fomc"), ("onchain", "blockchain"), ("events", "usgs"), ("research", "arxiv"), ("predictions", "manifold"),
        ("events", "nasa_eonet"), ("predictions", "polymarket"), ("sentiment", "alt_fng"), ("predictions", "kalshi"),
        ("policy", "federal_register"), ("events", "openfda"), ("research", "clinicaltrials"), ("news", "gdelt_gkg"),
        ("options", "polygon"), ("market", "polygon_intraday"), ("fundamentals", "fmp_transcripts"), ("fundamentals", "fmp_estimates"),
        ("news", "tiingo"), ("alt", "shipping_ais"),
    ],
    "vintage": [("macro", "alfred"), ("fundamentals", "sec_xbrl"), ("ownership", "sec_13f"), ("credit", "fred"), ("real_estate", "fred"), ("commodity", "fred")],
    "revised_soft": [("commodity", "eia"), ("crypto_defi", "defillama"), ("crypto_defi", "defillama_flows"), ("sentiment", "epu")],
    "snapshot_forward": [("reference", "master")],
    "forward_limited": [("crypto_deriv", "okx"), ("crypto_deriv", "deribit"), ("sentiment", "cnn_fng")],
    "derived": [("derived", "surprise"), ("graph", "derived"), ("features", "derived"), ("trajectories", "env")],
}
#: Sources that need a key, and so have no data here; their class is what they would guarantee.
PAID = (("options", "polygon"), ("market", "polygon_intraday"), ("fundamentals", "fmp_transcripts"), ("fundamentals", "fmp_estimates"), ("news", "tiingo"), ("alt", "shipping_ais"))
#: Kinds of sources that are never collected as they are, and what would make them usable.
EXCLUDED = {
    "World Bank / IMF / OECD / OWID": "only the latest revision can be had; a vintage endpoint is needed, or a snapshot kept from now on",
    "Weather reanalysis (ERA5/Open-Meteo historical)": "computed after the fact; archived forecasts and observations as reported are needed",
    "Wikidata (current)": "today's state; its revision history is needed, or a snapshot kept from now on",
}
REGISTRY = {key: name for name, keys in CLASSES.items() for key in keys}


def pit_class(domain: str, source: str) -> str:
    return REGISTRY.get((domain, source), "unknown")


def is_historical_safe(domain: str, source: str) -> bool:
    return pit_class(domain, source) in SAFE


def registry(spark: SparkSession) -> DataFrame:
    """domain, source, pit_class, safe, paid: a row for each known source."""
    return spark.createDataFrame([(d, s, c, c in SAFE, (d, s) in PAID) for (d, s), c in REGISTRY.items()], "domain string, source string, pit_class string, safe boolean, paid boolean")


def document(rules: dict[tuple[str, str], str]) -> str:
    """The registry as a Markdown text: a table for each class, with the rule of knowledge time of each source, and what is excluded."""
    out = ["# What was known when", ""]
    for name, keys in CLASSES.items():
        out += [f"## {name} ({'safe' if name in SAFE else 'not safe'} for the past)", "", "| source | known from |", "|-|-|"]
        out += [f"| {d}/{s} | {rules.get((d, s), 'not collected')} |" for d, s in keys] + [""]
    return "\n".join([*out, "## Excluded", "", *(f"* {k}: {v}" for k, v in EXCLUDED.items())])


def strict(df: DataFrame) -> DataFrame:
    """Only rows of sources that are safe about the past; the registry is small and fixed, so it becomes a filter."""
    pairs = [F.struct(F.lit(d), F.lit(s)) for (d, s), c in REGISTRY.items() if c in SAFE]
    return df.where(F.struct("domain", "source").isin(*pairs)) if pairs else df.limit(0)


def by_class(spark: SparkSession) -> DataFrame:
    """The sources of each class, as the documentation lists them."""
    return registry(spark).groupBy("pit_class").agg(F.count("*").alias("n_sources"), F.array_join(F.sort_array(F.collect_list(F.concat_ws("/", "domain", "source"))), ", ").alias("sources"))
