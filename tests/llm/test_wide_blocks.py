"""Spellings that meet no company in the narrow blocks get candidates from the wide ones."""

import random

from tidemark.llm.matching import candidate_pairs


def test_swapped_letters_lose_no_candidate(spark):
    draw, names, typos = random.Random(3), [], []
    for _ in range(300):
        letters = draw.sample("abcdefghijklmnopqrstuvwxyz", 9)
        at = draw.randrange(2, 6)
        names.append("".join(letters).upper())
        letters[at], letters[at + 1] = letters[at + 1], letters[at]
        typos.append("".join(letters).upper())
    frame = lambda texts: spark.createDataFrame([(str(i), f"{t} PHARM", 1) for i, t in enumerate(texts)], "entity string, name string, n long")
    got = {(r.l, r.r) for r in candidate_pairs(frame(typos), frame(names)).collect()}
    assert [i for i in range(300) if (str(i), str(i)) not in got] == []


def test_the_cheap_filter_loses_no_pair(spark):
    from pyspark.sql import functions as F

    from tidemark.llm.matching import _may_fit, name_features
    from tidemark.llm.names import organisation

    draw, pairs = random.Random(6), []
    for _ in range(1500):
        word = [draw.choice("abcde") for _ in range(draw.randrange(1, 17))]
        other = list(word)
        for _ in range(draw.randrange(5)):
            at = draw.randrange(len(other) + 1)
            kind = draw.randrange(4)
            if kind == 0:
                other.insert(at, draw.choice("abcde"))
            elif kind == 1 and at < len(other) and len(other) > 1:
                del other[at]
            elif kind == 2 and at + 1 < len(other):
                other[at], other[at + 1] = other[at + 1], other[at]
            elif at < len(other):
                other[at] = draw.choice("abcde")
        pairs.append(("".join(word), "".join(other) + draw.choice(["", "", " zed"])))
    pairs = [(a, b, " ".join(organisation(a)[0]), " ".join(organisation(b)[0])) for a, b in pairs]
    df = spark.createDataFrame(pairs, "a string, b string, lt string, rt string")
    kept = {(r.a, r.b) for r in df.where(_may_fit(F.col("lt"), F.col("rt"))).collect()}
    assert not [p for p in pairs if name_features(p[0], p[1])[0] > 0.3 and p[:2] not in kept]
