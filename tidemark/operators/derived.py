"""Writers of the derived tables: features, graph and surprises, each kind a shard of its own in the lake.

A kind that is there is not made again unless forced. A kind that cannot be made, as a source is missing, says so and
hinders no other.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.envelope import stamp
from tidemark.operators import graph, windows
from tidemark.operators.channels import CONCEPTS


@dataclass(frozen=True)
class Kind:
    """How a kind is made from a lake, and which of the columns tell its entity and event time."""

    domain: str
    source: str
    make: Callable[..., DataFrame]
    event: str = "event_time"
    entity: str | None = "entity"


def _series(lake, domain: str, source: str, entity: str) -> DataFrame:
    return lake.scan(domain, source).where(F.col("entity") == entity)


# Series that make the regime, and assets whose returns are correlated.
REGIME = (("macro", "alfred", "VIXCLS"), ("macro", "alfred", "T10Y2Y"), ("credit", "fred", "BAMLH0A0HYM2"))
ASSETS = ["SPY", "TLT", "GLD", "HYG"]

KINDS: dict[str, Kind] = {
    "technical": Kind("features", "derived", lambda lake: windows.technical(lake.scan("market", "yahoo"))),
    "regime": Kind("features", "derived", lambda lake: windows.regime(*(_series(lake, *k) for k in REGIME)), entity=None),
    "insider_flow": Kind("features", "derived", lambda lake: windows.insider_flow(lake.scan("positioning", "sec_form4")), "month"),
    "prediction_momentum": Kind("features", "derived", lambda lake: windows.prediction_momentum(lake.scan("predictions", "manifold"))),
    "news_sentiment": Kind("features", "derived", lambda lake: windows.news_sentiment(lake.scan("news", "gdelt_gkg")), "week"),
    "fundamentals_growth": Kind("features", "derived", lambda lake: windows.fundamentals_growth(lake.scan("fundamentals", "sec_xbrl"), list(CONCEPTS))),
    "cross_asset": Kind("features", "derived", lambda lake: windows.cross_asset(lake.scan("market", "yahoo"), ASSETS).withColumn("knowledge_time", F.col("event_time") + F.expr("INTERVAL 21 HOURS")), entity=None),
    "crypto_momentum": Kind("features", "derived", lambda lake: windows.series_momentum(lake.scan("crypto", "yahoo").withColumnRenamed("close", "value"))),
    "graph_centrality": Kind("features", "derived", lambda lake: windows.centrality(lake.scan("graph", "derived", "co_mention"))),
    "nodes": Kind("graph", "derived", lambda lake: graph.nodes(lake.scan("reference", "master"), times=True)),
    "ownership": Kind("graph", "derived", lambda lake: graph.ownership(lake.scan("ownership", "sec_13f"))),
    "insider": Kind("graph", "derived", lambda lake: graph.insider(lake.scan("positioning", "sec_form4"))),
    "co_mention": Kind("graph", "derived", lambda lake: graph.co_mention(lake.scan("news", "gdelt_gkg")).withColumn("rel", F.lit("co_mention")), "quarter"),
    "surprise": Kind("derived", "surprise", lambda lake: windows.surprise(lake.scan("macro", "alfred"))),
}


def made(lake, name: str) -> DataFrame:
    """The rows of a kind as envelope and payload."""
    kind = KINDS[name]
    df = kind.make(lake)
    keep = {c: F.col(c) for c in df.columns if c not in {kind.event, kind.entity, "knowledge_time", "kind"}}
    entity = F.col(kind.entity) if kind.entity else "MARKET"
    return stamp(df, domain=kind.domain, source=kind.source, entity=entity, event_time=F.col(kind.event), knowledge_time=F.col("knowledge_time"), url=f"derived:{kind.domain}/{name}", payload=keep)


def write_derived(source, lake, kinds: list[str] | None = None, force: bool = False) -> list[tuple[str, str]]:
    """(kind, what was done) of each kind: `written`, `skipped` as it is there, or the name of the error. `source` is the lake
    that is read, `lake` the one written to."""
    out = []
    for name in kinds or list(KINDS):
        kind = KINDS[name]
        if not force and lake.exists(lake.path(kind.domain, kind.source, kind=name)):
            out.append((name, "skipped"))
            continue
        try:
            lake.write(made(source, name), kind.domain, kind.source, overwrite=True, kind=name)
            out.append((name, "written"))
        except (FileNotFoundError, KeyError, ValueError, PySparkException) as e:
            out.append((name, type(e).__name__))
    return out
