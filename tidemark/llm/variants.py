"""Variant spellings of names: link all spellings of one person or organisation.

Distinct spellings become nodes (spellings that differ in case, signs and titles only share one). Each node is a vector of
the character n-grams of its own words, weighted by inverse document frequency over all nodes of its field; words of trade,
which tell little, are left out of it. A sparse join gives, within a field and scope, every pair with a cosine of at least
`least_cosine` whose words of trade could be the same (what the check below asks for, pushed into the join): the top-n of a node are all its partners above the threshold, as any smaller n would lose links. The join
meets nodes only on the rarest grams of each, those without which the rest of the vector could not reach the threshold, so
it loses no pair. An exact check of words (`names`) follows and strikes out pairs that contradict each other; average-linkage
clustering of the cosines left groups each connected component. Weak links (one side tells less) join a group only where no
other group could be meant.

Words of trade are a fixed list and, beyond it, the words that a corpus shares: those in at least `SHARED` of its names and
seldom the rarest word of a name. There are at most 1/SHARED times the mean number of words of a name of them.

Defined cases: null and blank names are no spellings; equal spellings are one; names of signs alone are like none but
themselves; ties in linkage go to the pair of clusters that comes first. Scopes may be empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.names import grams, person_words, same_person, trade
from tidemark.session import buckets_for, cut, release, spread

STRONG = 0.7
#: A word is shared if so many of the names have it, and at least so many, and in so many of them it isn't the rarest.
SHARED, SHARED_LEAST, SHARED_LED = 0.004, 12, 0.7
#: Grams weigh log(1 + total / (df + SMOOTH * total)), so that the grams of a typing error don't outweigh all others.
SMOOTH = 0.03
NODES = "field_name string, scope_key string, name string, form string, text string, blocks array<string>"


def _person(name: str) -> tuple[str, str, list[str]]:
    words = person_words(name)
    text = " ".join(w for w in words if len(w) > 1)
    return " ".join(words) or name.lower(), text or name.lower(), []


def _organisation(name: str, shared: tuple[str, ...]) -> tuple[str, str, list[str]]:
    own, kinds, legal = trade(shared).organisation(name)
    text = " ".join(own)
    form = "|".join([text, *sorted("/".join(sorted(k)) for k in kinds), legal])
    return (form, text, sorted(set().union(*kinds))) if text else (name, name, [])


def shared_words(names: DataFrame) -> tuple[str, ...]:
    """The words that many of the distinct names share, most frequent first."""
    text = F.lower(F.regexp_replace(F.regexp_replace("name", r"(?<=\p{Ll})(?=\p{Lu})", " "), r"[.’']", ""))
    named = names.select("name").distinct().select(F.monotonically_increasing_id().alias("id"), F.array_distinct(F.regexp_extract_all(text, F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))).alias("words"))
    words = cut(named.select("id", F.explode("words").alias("word")), "words")
    total = words.select("id").distinct().count()
    df = words.groupBy("word").agg(F.count("*").alias("n"))
    rarest = words.join(df, "word").groupBy("id").agg(F.min("n").alias("least"))
    often = df.where((F.col("n") >= max(SHARED_LEAST, SHARED * total)) & (F.length("word") >= 3) & ~F.col("word").rlike("[0-9]"))
    led = words.join(often, "word").join(rarest, "id").groupBy("word", "n").agg(F.avg((F.col("n") > F.col("least")).cast("double")).alias("led"))
    found = led.where(F.col("led") >= SHARED_LED).orderBy(F.col("n").desc(), "word").collect()
    release(words)
    return tuple(r.word for r in found)


def spelling_nodes(names: DataFrame, persons: bool, shared: tuple[str, ...] = ()) -> DataFrame:
    """Distinct spellings (field_name, scope_key, name) with their form and the text of their vector."""
    describe = _person if persons else lambda n: _organisation(n, shared)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [describe(n) for n in pdf["name"]]
            yield pdf.assign(form=[g[0] for g in got], text=[g[1] for g in got], blocks=[g[2] for g in got])

    return spread(names).mapInPandas(run, NODES)


def similar_pairs(nodes: DataFrame, sizes: tuple[int, ...], least_cosine: float) -> DataFrame:
    """`a, b, cosine` (a < b) of the pairs of nodes `id, field_name, scope_key, text` of a field and scope that are that near.

    A node's grams are taken from the rarest on; once the rest of its vector is shorter than the threshold, no further gram
    can be the rarest common one of a pair that reaches it, so only the grams before that point are join keys. What a pair
    has in common there and the longer of both rests, as all else that it shares lies in the rest of one, bound its cosine;
    it is computed where the bound allows it.

    Where nodes have `blocks`, pairs without a common one are not asked for, unless just one of them has none."""

    @F.pandas_udf("array<string>")
    def cut_up(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: grams(t, sizes))

    blocks = F.array_distinct(F.flatten(F.collect_list("blocks"))) if "blocks" in nodes.columns else F.first(F.array().cast("array<string>"))
    texts = cut(nodes.groupBy("field_name", "scope_key", "text").agg(F.min("id").alias("node"), blocks.alias("blocks")), "texts")
    exploded = cut(texts.select("node", "field_name", F.explode(cut_up("text")).alias("gram")).select("node", "field_name", F.xxhash64("field_name", "gram").alias("gram")), "grams")
    total = texts.groupBy("field_name").agg(F.count("*").alias("total"))
    df = exploded.groupBy("field_name", "gram").agg(F.count("*").alias("df")).join(F.broadcast(total), "field_name")  # one row a field
    weighed = exploded.join(df.select("gram", "df", F.log1p(F.col("total") / (F.col("df") + SMOOTH * F.col("total"))).alias("w")), "gram")
    own = Window.partitionBy("node")
    before = F.coalesce(F.sum(F.col("w") * F.col("w")).over(own.orderBy("df", "gram").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    ranked = weighed.select("node", "gram", "w", F.sum(F.col("w") * F.col("w")).over(own).alias("all"), before.alias("before"))
    unit = ranked.select("node", "gram", (F.col("w") / F.sqrt("all")).alias("w"), (1 - F.col("before") / F.col("all") >= least_cosine**2 - 1e-9).alias("key"))
    rest = F.sqrt(F.greatest(F.lit(0.0), 1 - F.sum(F.when(F.col("key"), F.col("w") * F.col("w")).otherwise(0.0))))
    vectors = unit.groupBy("node").agg(F.collect_list(F.struct("gram", "w", "key")).alias("v"), rest.alias("rest"))
    vectors = cut(vectors.join(texts.select("node", "scope_key", "blocks"), "node"), "vectors")

    def keys(df: DataFrame, n: str, blocks: Column) -> DataFrame:
        rows = df.select("node", "scope_key", "rest", blocks.alias("blocks"), F.explode(F.filter("v", lambda x: x["key"])).alias("x"))
        rows = rows.select("node", "scope_key", "rest", "x.gram", "x.w", F.explode("blocks").alias("block"))
        return rows.select(F.xxhash64("scope_key", "gram", "block").alias("k"), F.col("node").alias(n), F.col("w").cast("float").alias(f"w_{n}"), F.col("rest").cast("float").alias(f"rest_{n}"))

    none = F.size("blocks") == 0
    within = F.when(none, F.array(F.lit(""))).otherwise(F.col("blocks"))
    inner = cut(keys(vectors, "a", within), "keys")
    met = inner.hint("merge").join(inner.withColumnsRenamed({"a": "b", "w_a": "w_b", "rest_a": "rest_b"}), "k").where("a < b")
    if "blocks" in nodes.columns:
        bare, other = keys(vectors.where(none), "x", F.array(F.lit(""))), keys(vectors.where(~none), "y", F.array(F.lit("")))
        across = bare.hint("merge").join(other, "k")
        first = F.col("x") < F.col("y")
        pick = lambda p, q: F.when(first, F.col(p)).otherwise(F.col(q))
        across = across.select("k", pick("x", "y").alias("a"), pick("w_x", "w_y").alias("w_a"), pick("rest_x", "rest_y").alias("rest_a"), pick("y", "x").alias("b"), pick("w_y", "w_x").alias("w_b"), pick("rest_y", "rest_x").alias("rest_b"))
        met = met.unionByName(across)
    # a pair of several common blocks is counted for each, which only raises the bound
    held = met.groupBy("a", "b").agg(F.sum(F.col("w_a") * F.col("w_b")).alias("held"), F.max(F.greatest("rest_a", "rest_b")).alias("rest"))
    held = held.where(F.col("held") + F.col("rest") >= least_cosine - 1e-5).select("a", "b")
    side = lambda n: vectors.select(F.col("node").alias(n), F.transform("v", lambda x: F.struct(x["gram"].alias("gram"), x["w"].alias("w"))).alias(f"v_{n}"))
    both = held.join(side("a"), "a").join(side("b"), "b")
    cosine = F.expr("aggregate(v_a, 0D, (s, x) -> s + x.w * aggregate(v_b, 0D, (t, y) -> if(y.gram = x.gram, y.w, t)))")
    near = cut(both.select("a", "b", cosine.alias("cosine")).where(F.col("cosine") >= least_cosine), "near")
    # from texts back to nodes: those of one text have cosine 1
    own = nodes.join(texts.drop("blocks"), ["field_name", "scope_key", "text"]).select("id", "node")
    x, y = own.select(F.col("node").alias("a"), F.col("id").alias("x")), own.select(F.col("node").alias("b"), F.col("id").alias("y"))
    same = x.join(y.withColumnRenamed("b", "a"), "a").where("x < y").select(F.col("x").alias("a"), F.col("y").alias("b"), F.lit(1.0).alias("cosine"))
    return near.join(x, "a").join(y, "b").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "cosine").unionByName(same)


def linked(names: DataFrame, persons: bool, sizes: tuple[int, ...], least_cosine: float, rows_each: int = 50_000) -> DataFrame:
    """`field_name, scope_key, name, cluster`: each distinct spelling with the group it belongs to."""
    distinct = cut(names.where("name is not null and trim(name) != ''").select("field_name", "scope_key", "name").distinct(), "names")
    shared = () if persons else shared_words(distinct)
    spelled = cut(spelling_nodes(distinct, persons, shared), "spellings")
    nodes = spelled.groupBy("field_name", "scope_key", "form").agg(F.min("name").alias("name"), F.first("text").alias("text"), *([] if persons else [F.first("blocks").alias("blocks")]))
    nodes = cut(nodes.withColumn("id", F.monotonically_increasing_id()), "nodes")
    pairs = similar_pairs(nodes, sizes, least_cosine)
    shown = lambda n: nodes.select(F.col("id").alias(n), F.col("name").alias(f"name_{n}"))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        same = same_person if persons else trade(shared).same
        telling = (lambda n: sum(map(len, person_words(n)))) if persons else (lambda n: (len(trade(shared).organisation(n)[1]), len(n)))
        for pdf in batches:
            got = [same(x, y) for x, y in zip(pdf["name_a"], pdf["name_b"])]
            sim = [-s if s < STRONG and telling(y) < telling(x) else s for s, x, y in zip(got, pdf["name_a"], pdf["name_b"])]
            yield pdf[["a", "b", "cosine"]].assign(sim=sim)[lambda d: d["sim"] != 0]

    edges = spread(pairs.join(shown("a"), "a").join(shown("b"), "b").select("a", "b", "cosine", "name_a", "name_b")).mapInPandas(score, "a long, b long, cosine double, sim double")
    edges = cut(edges, "links")
    grouped = cut(edges.join(components(edges).withColumnRenamed("id", "a"), "a"), "grouped")
    grouped = grouped.withColumn("part", F.pmod(F.xxhash64("component"), F.lit(buckets_for(grouped, rows_each))))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, g in pdf.groupby("component", sort=False):
            out += cluster(list(zip(g["a"].tolist(), g["b"].tolist(), g["sim"].tolist())), cosines=g["cosine"].tolist())
        return pd.DataFrame(out, columns=["id", "cluster"])

    clusters = grouped.groupBy("part").applyInPandas(run, "id long, cluster long")
    told = nodes.join(clusters, "id", "left").select("field_name", "scope_key", "form", F.coalesce("cluster", "id").alias("cluster"))
    return spelled.select("field_name", "scope_key", "name", "form").join(told, ["field_name", "scope_key", "form"]).drop("form")


def cluster(edges: list[tuple[int, int, float]], least: float = 0.15, cosines: list[float] | None = None) -> list[tuple[int, int]]:
    """(node, cluster) of one component: average linkage over strong edges by their cosines, then unambiguous weak ones.

    An edge's third value is how sure the check of words is; it stands for the cosine where none are given. A weak edge
    has its sign turned if its second node tells less than its first. The group that tells less joins the other one if no
    further group fits it as well."""
    ids = sorted({x for e in edges for x in e[:2]})
    at = {x: i for i, x in enumerate(ids)}
    near = cosines or [abs(e[2]) for e in edges]
    group = _average_linkage(len(ids), [(at[a], at[b], c) for (a, b, s), c in zip(edges, near) if s >= STRONG], least)
    choices: dict[int, dict[int, float]] = {}
    for a, b, s in edges:
        less, more = (group[at[a]], group[at[b]])[:: -1 if s < 0 else 1]
        if s < STRONG and less != more:
            choices.setdefault(less, {})[more] = max(abs(s), choices.get(less, {}).get(more, 0))
    parent = {g: g for g in set(group)}

    def root(g: int) -> int:
        while parent[g] != g:
            g = parent[g]
        return g

    for less, c in sorted(choices.items()):
        fits = [o for o, s in c.items() if s == max(c.values())]
        if len(fits) == 1 and root(less) != root(fits[0]):
            parent[root(less)] = root(fits[0])
    named: dict[int, int] = {}
    for i, g in enumerate(group):
        named.setdefault(root(g), ids[i])
    return [(ids[i], named[root(g)]) for i, g in enumerate(group)]


def _average_linkage(n: int, edges: list[tuple[int, int, float]], least: float) -> list[int]:
    """Group of each node; merges the two groups with the greatest mean similarity while it is at least `least`.

    Only pairs of groups with an edge between them are kept, so the work follows the edges."""
    import heapq

    group, size, total = list(range(n)), [1] * n, [dict() for _ in range(n)]
    for a, b, s in edges:
        total[a][b] = total[b][a] = s
    heap = [(-s, a, b, 1, 1) for a in range(n) for b, s in total[a].items() if a < b]
    heapq.heapify(heap)
    alive = [True] * n
    parent = list(range(n))
    while heap:
        s, a, b, na, nb = heapq.heappop(heap)
        if -s < least:
            break
        if not (alive[a] and alive[b]) or size[a] != na or size[b] != nb:
            continue
        alive[b], parent[b] = False, a
        size[a] += size[b]
        total[a].pop(b, None)
        for o, v in total[b].items():
            if o != a:
                total[a][o] = total[a].get(o, 0.0) + v
                total[o][a] = total[a][o]
                total[o].pop(b, None)
        for o, v in total[a].items():
            heapq.heappush(heap, (-v / (size[a] * size[o]), min(a, o), max(a, o), size[min(a, o)], size[max(a, o)]))
    for i in range(n):
        g = i
        while parent[g] != g:
            g = parent[g]
        group[i] = g
    return group


def variant_pairs(clusters: DataFrame) -> DataFrame:
    """`field_name, scope_key, name_a, name_b` (name_a < name_b): all pairs of different spellings of a group."""
    names = clusters.select("field_name", "scope_key", "cluster", "name")
    left, right = names.withColumnRenamed("name", "name_a"), names.withColumnRenamed("name", "name_b")
    return left.join(right, ["field_name", "scope_key", "cluster"]).where("name_a < name_b").drop("cluster")
