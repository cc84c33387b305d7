"""Mixing, reading levels and matching."""

import random

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm.matching import Classifier, check_digit_fits, matched
from tidemark.llm.mixing import mixed, route
from tidemark.llm.reading import fit, reading_levels, sentences


def test_route_meets_shares_and_caps():
    total, flow = route({("a",): 100, ("b",): 30, ("a", "b"): 10}, {"a": 0.5, "b": 0.5}, {"a": 1, "b": 2})
    assert total in (160, 161) and flow[(("b",), "b")] + flow.get((("a", "b"), "b"), 0) == 80
    total, flow = route({("a",): 100, ("b",): 100}, {"a": 0.9, "b": 0.1}, {"a": 1, "b": 9})
    assert 110 <= total <= 112 and flow[(("a",), "a")] <= 100


def test_mixed(spark):
    rnd = random.Random(1)
    words = "alpha beta gamma delta epsilon zeta".split()
    docs = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randrange(5, 40))), rnd.choice("aaaabbc")) for i in range(400)]
    docs += [(1000, None, "a"), (1001, "", "b"), (1002, "text of nobody", None), (1003, "text", "unlisted"), (1004, docs[0][1], "c"), (None, "x y", "a")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    goal = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.2, 3)], "source string, target_share double, max_repeats int")
    selection, report = mixed(df, goal, ranges=4)
    got = {r.source: r for r in report.collect()}
    assert all(abs(got[s].actual_share - t) < 0.01 for s, t in (("a", 0.5), ("b", 0.3), ("c", 0.2)))
    used = selection.collect()
    assert all(1 <= r.times <= {"a": 1, "b": 2, "c": 3}[r.source] for r in used)
    assert len({(r.doc_id, r.source) for r in used}) == len(used) and not {1000, 1001, 1002, 1003, None} & {r.doc_id for r in used}
    again = mixed(df, goal, ranges=4)[0]
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, used))
    assert mixed(df.limit(0), goal)[1].agg(F.sum("tokens")).first()[0] == 0


def test_sentences():
    assert len(sentences("One two. Three four! Five six?")) == 3
    assert len(sentences("See Ex. 10.3 and cf. Note 7 of the act. It ends here.")) == 2
    assert sentences("") == [] and sentences("word") == []


def test_reading_levels(spark):
    easy, mid, hard = ["The cat sat.", "We had fun.", "It was hot."], ["The firm sold more goods in the spring than it had planned to sell."], ["Notwithstanding heteroskedastic covariance, the securitization vehicles attenuate intertemporal liquidity, insofar as the thresholds remain contingent upon subordinated obligations."]
    docs, labels = [], []
    for i in range(120):
        kind = i % 3
        docs.append((i, " ".join([easy, mid, hard][kind] * 12), "clash"))
        labels.append((i, [1, 3, 5][kind] if i % 17 else 1))
    docs += [(500, None, ""), (501, "", ""), (502, "   ", ""), (503, "Die Bank hat das Jahr mit einem Verlust beendet und die Preise sind hoch. " * 9, ""), (504, hard[0] * 3000, ""), (505, "12 34", ""), (None, "The cat", "")]
    labels += [(9999, 2), (1, None), (None, 3), (3, 9)]
    df = spark.createDataFrame(docs, "doc_id long, text string, level string")
    lab = spark.createDataFrame(labels, "doc_id long, reading_level int")
    got = {r.doc_id: r for r in reading_levels(df, lab).collect()}
    assert {got[i].level for i in range(0, 120, 3)} == {1} and {got[i].level for i in range(1, 120, 3)} == {3} and all(got[i].level >= 4 for i in range(2, 120, 3))
    assert not {500, 501, 502, 505, None} & set(got) and got[503].english < 0.03 and got[504].level >= 4
    bare = {r.doc_id: r.level for r in reading_levels(df, lab.limit(0)).collect()}
    assert set(bare) == set(got) and set(bare.values()) <= {1, 2, 3, 4, 5} and bare[0] < bare[504]
    assert reading_levels(df.limit(0), lab).count() == 0


def test_fit_is_robust():
    rnd = random.Random(3)
    rows = [(0.1 + rnd.random() / 10, 1.5 + 0.4 * k, k) for k in (1, 2, 3) for _ in range(60)] + [(0.8, 2.5 + 0.4 * k, k) for k in (4, 5) for _ in range(60)]
    wrong = [(0.15, 2.7, 5)] * 5
    f = fit(rows + wrong)
    assert 0.2 < f["step"] < 0.8 and len(f["easy"][1]) == 2


def test_check_digit(spark):
    rows = [("037833100", True), ("594918104", True), ("037833101", False), ("03783310", False), ("594918l04", False), ("", False), ("17275R102", True)]
    df = spark.createDataFrame(rows, "c string, ok boolean")
    assert all(r.got == r.ok for r in df.select("ok", check_digit_fits(F.col("c")).alias("got")).collect())


def test_matched(spark):
    rnd = random.Random(7)
    stem = lambda: "".join(rnd.choice("bdfgklmnprstvz") + rnd.choice("aeiou") for _ in range(4))
    kinds = ["Foods", "Motors", "Energy", "Media", "Software"]
    firms = [(f"c{i}", f"{stem().title()} {rnd.choice(kinds)} Inc") for i in range(60)]
    left = [(f"l{i}", n.upper() if i % 2 else n.replace(" Inc", ""), 5) for i, (_, n) in enumerate(firms[:40])] + [("x1", f"{firms[0][1].split()[0]} Genomics", 3), ("x2", "", 1), ("x3", None, 1)]
    l = spark.createDataFrame(left, "entity string, name string, n long").where("name is not null and name != ''")
    r = spark.createDataFrame([(c, n, 1) for c, n in firms], "entity string, name string, n long")
    none = "string, day date, "
    implied, closes = spark.createDataFrame([], f"l {none} price double"), spark.createDataFrame([], f"r {none} close double")
    got = {x.l: x.r for x in matched(l, r, implied, closes).collect()}
    assert got == {f"l{i}": f"c{i}" for i in range(40)}
    assert matched(l.limit(0), r, implied, closes).count() == 0


def test_calibrated_on_held_out():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 2))
    p = 1 / (1 + np.exp(-2 * x[:, 0]))
    y = (rng.random(4000) < p).astype(float)
    model = Classifier(x[:3000], y[:3000])
    guess = model.probability(x[3000:])
    assert abs(guess - p[3000:]).mean() < 0.08 and ((guess > 0.5) == (p[3000:] > 0.5)).mean() > 0.93


def test_copies_within_a_source_count(spark):
    """Three copies of a text in one source supply it three times, two sources share one of them; no document is lost."""
    from tidemark.llm.mixing import units

    docs = spark.createDataFrame([(1, "same words here", "a"), (2, "same words here", "a"), (3, "same words here", "a"), (4, "same words here", "b"), (5, "other", "b"), (6, "", "a"), (7, None, "a"), (8, "x", "c")], "doc_id long, text string, source string")
    got = sorted(tuple(r.ids) for r in units(docs, ["a", "b"], "byte_bpe_50k", "/opt/tokenizers").collect() if r.ids[0] is not None)
    assert got == [(1, 4), (2, None), (3, None)]
    every = [i for r in units(docs, ["a", "b"], "byte_bpe_50k", "/opt/tokenizers").collect() for i in r.ids if i is not None]
    assert sorted(every) == [1, 2, 3, 4, 5]


def test_match_of_signs_alone(spark):
    none = "string, day date, "
    l = spark.createDataFrame([("l1", "---", 1), ("l2", "Gravex Foods Inc", 1)], "entity string, name string, n long")
    r = spark.createDataFrame([("c1", "***", 1), ("c2", "GRAVEX FOODS", 1)], "entity string, name string, n long")
    implied, closes = spark.createDataFrame([], f"l {none} price double"), spark.createDataFrame([], f"r {none} close double")
    assert [(x.l, x.r) for x in matched(l, r, implied, closes).collect()] == [("l2", "c2")]


def test_prices_and_names_label_each_other(spark):
    """Look-alikes of another trade are told apart by what prices teach about names."""
    rnd = random.Random(5)
    stems = ["".join(rnd.choice("bdfgklmnprst") + rnd.choice("aeiou") for _ in range(4)) for _ in range(60)]
    l = spark.createDataFrame([(f"l{i}", f"{s} {k}", 3) for i, s in enumerate(stems) for k in ("Foods",)], "entity string, name string, n long")
    r = spark.createDataFrame([(f"c{i}{k[0]}", f"{s} {k}", 1) for i, s in enumerate(stems) for k in ("Foods", "Motors")], "entity string, name string, n long")
    days = [f"2021-01-{d:02}" for d in (4, 5, 6)]
    implied = spark.createDataFrame([(f"l{i}", d, 10.0 + i) for i in range(0, 60, 2) for d in days], "l string, day string, price double").withColumn("day", F.col("day").cast("date"))
    closes = spark.createDataFrame([(f"c{i}{k}", d, (10.0 + i) * (1 if k == "F" else 2)) for i in range(60) for k in "FM" for d in days], "r string, day string, close double").withColumn("day", F.col("day").cast("date"))
    got = {x.l: (x.r, x.confidence) for x in matched(l, r, implied, closes).collect()}
    assert {k: v[0] for k, v in got.items()} == {f"l{i}": f"c{i}F" for i in range(60)}
    assert min(got[f"l{i}"][1] for i in range(0, 60, 2)) > 0.9
