"""Matching entities across sources without a key, each match with a confidence.

Candidates come from MinHash blocking over several attributes: the character n-grams of a name's own words, its own words
in whole, and the words of its whole spelling. Spellings that meet no company there go through wider n-gram blocks. Each
pair of a spelling and a company gets similarity features of its names; those of an entity's spellings are averaged with
their counts. The implied price of a holding is held against closing prices of the company's tickers.

Names and prices are two views, and each gets its labels from the other, so neither learns a rule about itself: a logistic
classifier of the names is trained on pairs whose prices agree, or contradict, and calibrated on a held-out
half by isotonic regression; how much prices weigh is counted on pairs whose names are each other's only equal ones, or of
other trades. The confidence is the product of both odds. An entity is matched to its best company if that is the only one
within reach and its probability is at least one half.

Defined cases: entities without a usable name, and companies without a name or key, match nothing; missing prices are a
feature of their own, not a contradiction; ties between companies match neither.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.names import edits, grams, kinds_fit, organisation, plain
from tidemark.operators.asof import ranked
from tidemark.session import cut, spread

HASHES, ROWS = 40, 3
WIDE_ROWS = 2
MOST_TRAINING, LEAST_TRAINING = 100_000, 40
#: What the classifier sees: how alike the names are. Prices are kept from it, as they give its labels.
FEATURES = ("own", "exact", "kinds", "kinds_clash", "legal", "legal_clash", "gram_jaccard")
#: Days with both prices, and the share of them, from which agreeing or contradicting prices label a pair.
LABEL_DAYS, LABEL_SHARE = 1, 0.8


def check_digit_fits(cusip: Column) -> Column:
    """Whether a CUSIP has nine capitals or digits and the right check digit; in the JVM."""
    signs = F.split(F.substring(cusip, 1, 8), "")
    values = F.transform(signs, lambda s, i: F.when(s.rlike("[0-9]"), s.try_cast("int")).otherwise(F.ascii(s) - 55) * (1 + F.pmod(i, F.lit(2))))
    total = F.aggregate(values, F.lit(0), lambda a, v: a + F.floor(v / 10).cast("int") + F.pmod(v, F.lit(10)).cast("int"))
    return cusip.rlike("^[0-9A-Z]{8}[0-9]$") & (F.pmod(10 - F.pmod(total, F.lit(10)), F.lit(10)) == F.substring(cusip, 9, 1).try_cast("int"))


def _signature(items: list[str], seed: np.ndarray) -> np.ndarray:
    import xxhash

    h = np.array([xxhash.xxh64_intdigest(i) for i in items], np.uint64)
    return (h[:, None] * seed[None, :] ^ (h[:, None] >> np.uint64(31))).min(axis=0)


def block_keys(names: DataFrame, wide: bool = False) -> DataFrame:
    """`id, name, key` for each block of each distinct name (`id, name`); wide: n-gram blocks of fewer rows, and no others."""
    rows = WIDE_ROWS if wide else ROWS

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        seed = np.random.default_rng(7).integers(1, 2**63, HASHES * ROWS, dtype=np.uint64) | np.uint64(1)
        for pdf in batches:
            out = []
            for i, name in zip(pdf["id"].tolist(), pdf["name"].tolist()):
                own = organisation(name)[0]
                text = " ".join(own)
                if not text:  # of signs alone
                    continue
                sig = _signature(grams(text), seed)
                keys = [f"g{b}:{sig[rows * b : rows * b + rows].tobytes().hex()}" for b in range(len(sig) // rows)]
                if not wide:
                    keys += [f"o:{text}"]
                words = [] if wide else sorted(set(plain(name).replace(".", "").replace(",", " ").split()))
                if words:
                    keys.append("w:" + _signature(words, seed[:4]).tobytes().hex())
                out += [(i, name, xxhash.xxh64_intdigest(k) - 2**63) for k in keys]
            yield pd.DataFrame(out, columns=["id", "name", "key"])

    return spread(names).mapInPandas(run, "id long, name string, key long")


def name_features(a: str, b: str) -> tuple[float, ...]:
    """own, exact, kinds, kinds_clash, legal, legal_clash, gram_jaccard of two names."""
    (own_a, kinds_a, legal_a), (own_b, kinds_b, legal_b) = organisation(a), organisation(b)
    distance = 9
    if len(own_a) == len(own_b):
        left, distance = list(own_b), 0
        for x in own_a:
            d, hit = min((edits(x, y, 2), y) for y in left)
            distance += d
            left.remove(hit)
    longest = max(1, min(sum(map(len, own_a)), sum(map(len, own_b))))
    own = max(0.0, 1.0 - 3.0 * distance / longest)
    fit = bool(kinds_a and kinds_b) and kinds_fit(kinds_a, kinds_b)
    ga, gb = set(grams(plain(a))), set(grams(plain(b)))
    return (own, float(distance == 0), float(fit), float(bool(kinds_a and kinds_b) and not fit), float(bool(legal_a) and legal_a == legal_b), float(bool(legal_a and legal_b) and legal_a != legal_b), len(ga & gb) / max(1, len(ga | gb)))


def _may_fit(a: Column, b: Column) -> Column:
    """False only for pairs whose `own` cannot exceed 0.3, told in the JVM: single words of which one has at most 12 letters
    need at most two edits for it, and a swap of neighbours counts for two here."""
    single = ~F.contains(a, F.lit(" ")) & ~F.contains(b, F.lit(" "))
    return ~(single & (F.least(F.length(a), F.length(b)) <= 12)) | (F.levenshtein(a, b, 4) >= 0)


def candidate_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """`l, r` and name features of candidate pairs: left and right are `entity, name, n`, names of entities with counts."""
    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(text=[" ".join(organisation(n)[0]) for n in pdf["name"]])

    def ids(df: DataFrame, label: str) -> DataFrame:
        numbered = df.select("name").distinct().withColumn("id", F.monotonically_increasing_id())
        return cut(spread(numbered).mapInPandas(describe, "name string, id long, text string"), label)

    ln, rn = ids(left, "left"), ids(right, "right")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = pd.DataFrame([name_features(a, b) for a, b in zip(pdf["ln"], pdf["rn"])], columns=list(FEATURES), index=pdf.index, dtype=float)
            yield pdf.join(got)[lambda d: (d["own"] > 0.3)]

    def pass_over(ln: DataFrame, wide: bool, name: str) -> DataFrame:
        lk, rk = block_keys(ln.select("id", "name"), wide), block_keys(rn.select("id", "name"), wide)
        # the size of what Python gives is unknown to the planner, so nothing of it may be broadcast
        pairs = lk.select("key", F.col("id").alias("lid")).hint("merge").join(rk.select("key", F.col("id").alias("rid")), "key").select("lid", "rid").distinct()
        named = pairs.join(ln.withColumnsRenamed({"id": "lid", "name": "ln", "text": "lt"}), "lid").join(rn.withColumnsRenamed({"id": "rid", "name": "rn", "text": "rt"}), "rid")
        named = named.where(_may_fit(F.col("lt"), F.col("rt"))).select("ln", "rn")
        return cut(spread(named).mapInPandas(run, "ln string, rn string, " + ", ".join(f"{f} double" for f in FEATURES)), name)

    scored = pass_over(ln, False, "scored")
    without = cut(ln.join(scored.select(F.col("ln").alias("name")).distinct(), "name", "left_anti"), "without")
    scored = scored.unionByName(pass_over(without, True, "scored_wide"))
    l = left.select(F.col("entity").alias("l"), F.col("name").alias("ln"), F.col("n").alias("n"))
    r = right.select(F.col("entity").alias("r"), F.col("name").alias("rn")).distinct()
    full = scored.join(l, "ln").join(r, "rn")
    best = full.groupBy("l", "r", "ln", "n").agg(*(F.max_by(f, F.col("own") + F.col("kinds") - F.col("kinds_clash")).alias(f) for f in FEATURES))
    mean = [(F.sum(F.col(f) * F.col("n")) / F.sum("n")).alias(f) for f in FEATURES]
    return best.groupBy("l", "r").agg(*mean, F.sum("n").alias("support"))


def with_prices(pairs: DataFrame, implied: DataFrame, closes: DataFrame) -> DataFrame:
    """Adds `days`, the number of days with both prices, `price_near` and `price_far`, the shares of them at which implied and
    closing price agree, or not, and `price`, what they tell: near, far (of one day, or of several) or none.

    implied: `l, day, price`. closes: `r, day, close`. Prices a thousandfold off, as by a wrong unit, count as neither."""
    days = pairs.select("l", "r").join(implied, "l").join(closes, ["r", "day"])
    off = F.abs(F.log(F.col("price") / F.col("close")))
    told = days.groupBy("l", "r").agg(F.count("*").alias("days"), F.avg((off < 0.05).cast("double")).alias("price_near"), F.avg(((off > 0.2) & (off < 6.0)).cast("double")).alias("price_far"))
    out = pairs.join(told, ["l", "r"], "left").fillna(0.0, ["price_near", "price_far"]).fillna(0, ["days"])
    return out.withColumn("price", F.when(F.col("price_near") >= 0.5, "near").when(F.col("price_far") <= 0.5, "none").when(F.col("days") == 1, "far once").otherwise("far"))


def price_label() -> Column:
    """1 where prices agree, 0 where they contradict, null for all else; names have no part in it."""
    enough = F.col("days") >= LABEL_DAYS
    return F.when(enough & (F.col("price_near") >= LABEL_SHARE), 1.0).when(enough & (F.col("price_far") >= LABEL_SHARE), 0.0)


def name_label(df: DataFrame) -> DataFrame:
    """`y`: 1 for equal names that are each other's only one, 0 for names of other trades or far apart, null for all else;
    prices have no part in it."""
    equal = (F.col("exact") > 0.5) & (F.col("kinds") > 0.5) & (F.col("legal_clash") < 0.1)
    rivals = df.where(equal)
    once = lambda side: rivals.groupBy(side).agg(F.count("*").alias("n")).where("n = 1").select(side)
    sure = rivals.join(once("l"), "l", "left_semi").join(once("r"), "r", "left_semi").select("l", "r", F.lit(1.0).alias("y"))
    return df.join(sure, ["l", "r"], "left").withColumn("y", F.coalesce("y", F.when((F.col("kinds_clash") > 0.5) | (F.col("own") < 0.5), 0.0)))


def price_evidence(pairs: DataFrame) -> dict[str, float]:
    """How much likelier each reading of the prices is for pairs of one firm than for others, by labels of names alone."""
    counts = {(r.price, r.y): r.n for r in name_label(pairs).where("y is not null").groupBy("price", "y").agg(F.count("*").alias("n")).collect()}
    every = ("near", "far", "far once", "none")
    share = lambda k, y: (counts.get((k, y), 0) + 0.5) / (sum(counts.get((x, y), 0) for x in every) + 2)
    return {k: share(k, 1.0) / share(k, 0.0) for k in every}


class Classifier:
    """Logistic regression with isotonic calibration on a held-out half."""

    def __init__(self, x: np.ndarray, y: np.ndarray, rounds: int = 50):
        half = np.arange(len(y)) % 2 == 0
        if len(y) < 40 or len(set(y[half])) < 2 or len(set(y[~half])) < 2:
            half = np.ones(len(y), bool)
        a = np.c_[np.ones(len(x)), x]
        w = np.zeros(a.shape[1])
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(a[half] @ w, -30, 30)))
            grad = a[half].T @ (p - y[half]) + 1e-2 * len(y) ** 0.5 * w
            hess = (a[half] * (p * (1 - p))[:, None]).T @ a[half] + 1e-2 * len(y) ** 0.5 * np.eye(len(w))
            w -= np.linalg.solve(hess, grad)
        self.weights = w
        held = ~half if (~half).any() else half
        score = a[held] @ w
        order = np.argsort(score, kind="stable")
        blocks: list[list[float]] = []
        for s, v in zip(score[order], y[held][order]):
            blocks.append([v, 1.0, s])
            while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
                v2, n2, s2 = blocks.pop()
                v1, n1, s1 = blocks[-1]
                blocks[-1] = [(v1 * n1 + v2 * n2) / (n1 + n2), n1 + n2, (s1 * n1 + s2 * n2) / (n1 + n2)]
        self.at = np.array([b[2] for b in blocks])
        # no block is sure beyond what its number of pairs can tell
        self.value = np.array([(b[0] * b[1] + 0.5) / (b[1] + 1) for b in blocks])

    def probability(self, x: np.ndarray) -> np.ndarray:
        return np.interp(np.c_[np.ones(len(x)), x] @ self.weights, self.at, np.maximum.accumulate(self.value))


def matched(left: DataFrame, right: DataFrame, implied: DataFrame, closes: DataFrame, least: float = 0.5, seed: int = 0) -> DataFrame:
    """`l, r, confidence, support`: the best company of each entity.

    left, right: `entity, name, n`. implied: `l, day, price`; closes: `r, day, close`. At most `MOST_TRAINING` pairs labelled
    by prices, those of the least hash, train the classifier."""
    pairs = cut(with_prices(candidate_pairs(left, right), implied, closes), "pairs")
    labelled = pairs.withColumn("y", price_label()).where("y is not null")
    sample = labelled.orderBy(F.xxhash64("l", "r", F.lit(seed))).limit(MOST_TRAINING).select(*FEATURES, "y").collect()
    data = np.array([tuple(r) for r in sample], float)
    if len(data) >= LEAST_TRAINING and len(set(data[:, -1])) == 2:
        predict = Classifier(data[:, :-1], data[:, -1]).probability
    else:  # nothing to learn from: equal names alone
        predict = lambda x: np.where((x[:, 1] > 0.5) & (x[:, 3] < 0.5), 0.75, 0.25)
    evidence = price_evidence(pairs)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            p = np.clip(predict(pdf[list(FEATURES)].to_numpy(float)), 1e-6, 1 - 1e-6) if len(pdf) else np.zeros(0)
            odds = p / (1 - p) * pdf["price"].map(evidence).to_numpy(float)
            yield pdf[["l", "r", "support"]].assign(confidence=odds / (1 + odds))

    scored = pairs.select("l", "r", "support", "price", *FEATURES).mapInPandas(run, "l string, r string, support double, confidence double").where(F.col("confidence") >= least)
    two = ranked(scored, ["l"], [F.col("confidence").desc(), F.col("r").asc()], 2)
    best = two.groupBy("l").agg(F.max("confidence").alias("confidence"), F.min("confidence").alias("next"), F.count("*").alias("n"), F.max_by("r", "confidence").alias("r"), F.max_by("support", "confidence").alias("support"))
    return best.where("n = 1 or confidence > next").select("l", "r", "confidence", "support")
