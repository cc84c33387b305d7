import itertools
import random

import pytest

from tidemark.llm.components import components, roots
from tidemark.llm.names import edits, organisation, same_organisation, same_person
from tidemark.llm.variants import cluster, linked, variant_pairs


def test_edits():
    assert [edits(a, b) for a, b in (("abc", "abc"), ("abc", "acb"), ("abc", "abd"), ("abc", "bc"), ("abcd", "badc"), ("abc", "xyz"), ("", "ab"))] == [0, 1, 1, 1, 2, 3, 2]


@pytest.mark.parametrize(
    "a, b",
    [("GUDEBAN THEODORE B", "Theodore Gudwban"), ("GUDEBAN, THEODORE B.", "T. B. Gudeban"), ("NIWUZER ELIZABETH P", "NIWUXER, BETSY P."), ("Hiro N. Sodroher", "SODROHER HIROSHI N MD"), ("Wm. Vekeric Jr", "Vekeric Bill")],
)
def test_same_person(a, b):
    assert same_person(a, b) > 0.6 and same_person(b, a) > 0.6


@pytest.mark.parametrize("a, b", [("Holiher Anneliese S.", "Holiher Carlos D."), ("Smith John A", "Smith John B"), ("Fazudell Fatima K", "Dowipan Fatima K"), ("Li", "Wu"), ("", "X Y")])
def test_other_person(a, b):
    assert same_person(a, b) == 0


@pytest.mark.parametrize(
    "a, b",
    [("BREMUSIBRU SEMICNDTR", "Semiconductor Bremusibru Inc."), ("FUVIMUBRERFINANCIAL INC.", "The Fuvimubrer Financial  CL A"), ("Univ. of Drilegruroxford", "University of Drilegruroxford"), ("FEPOREBI CHEMICAL LTD PARTNE", "Feporebi Chem L.P."), ("MIHIBROJO PPTYS", "Mihibrojo Properties PLC")],
)
def test_same_organisation(a, b):
    assert same_organisation(a, b) >= 0.7


def test_other_organisation():
    assert same_organisation("Drovadrazia Realty", "Drovadrazis Genomics, Ltd.") == 0
    assert same_organisation("Bafigrabex Motors NV", "Bafigrabex Properties Corp") == 0
    assert organisation("...") == organisation("...")


def test_cluster_average_linkage_and_weak_links():
    strong = [(1, 2, 0.9), (2, 3, 0.9), (1, 3, 0.9), (7, 8, 1.0)]
    got = dict(cluster([*strong, (3, 5, -0.6), (8, 9, -0.6), (3, 9, -0.6)]))
    assert got[1] == got[2] == got[3] == got[5] and got[7] == got[8] != got[1]
    assert got[9] not in (got[1], got[7])  # fits two groups, so it joins neither


def test_linked(spark):
    rows = [("p", "T1", n) for n in ("SMITHSON JOHN A", "Smithson, John A.", "J. A. Smithson", "Smihtson John", "SMITHSON MARY B", "", None, " ", "???")]
    rows += [("p", "T2", "SMITHSON JOHN A"), ("p", "T2", "Smithson Jon A"), ("p", "T1", "SMITHSON JOHN A")]
    df = spark.createDataFrame(rows, "field_name string, scope_key string, name string")
    got = {(r.scope_key, r.name_a, r.name_b) for r in variant_pairs(linked(df, True, (2, 3), 0.2)).collect()}
    john = sorted(["SMITHSON JOHN A", "Smithson, John A.", "J. A. Smithson", "Smihtson John"])
    assert got == {("T1", a, b) for a, b in itertools.combinations(john, 2)} | {("T2", "SMITHSON JOHN A", "Smithson Jon A")}
    orgs = spark.createDataFrame([("o", "", n) for n in ("Gravex Foods Inc", "GRAVEX FDS", "Gravex Motors", "Gravex")], "field_name string, scope_key string, name string")
    assert {(r.name_a, r.name_b) for r in variant_pairs(linked(orgs, False, (3,), 0.2)).collect()} == {("GRAVEX FDS", "Gravex Foods Inc")}
    assert linked(df.limit(0), False, (3,), 0.2).count() == 0


def test_components_and_roots(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    got = {r.id: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
    links = spark.createDataFrame([(i, i - 1) for i in range(1, 30)] + [(50, 40)], "id long, parent long")
    assert {r.id: r.root for r in roots(links).collect()} == {**{i: 0 for i in range(1, 30)}, 50: 40}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_similar_pairs_equal_brute_force(spark):
    """The prefixes of rare grams lose no pair above the threshold, whatever shares a common gram."""
    import math
    import random

    from tidemark.llm.names import grams
    from tidemark.llm.variants import SMOOTH, similar_pairs

    rnd = random.Random(4)
    texts = ["".join(rnd.choice("abc") for _ in range(rnd.randrange(3, 9))) for _ in range(70)]
    texts += [t[:-1] + "x" for t in texts[:20]] + texts[:10] + ["hot " + t for t in texts[:30]]
    rows = [(i, "f", rnd.choice(["", "S"]), t) for i, t in enumerate(texts)]
    nodes = spark.createDataFrame(rows, "id long, field_name string, scope_key string, text string")
    distinct = {(s, t) for _, _, s, t in rows}
    df = {}
    for _, t in distinct:
        for g in grams(t):
            df[g] = df.get(g, 0) + 1
    weight = {g: math.log1p(len(distinct) / (n + SMOOTH * len(distinct))) for g, n in df.items()}
    vector = lambda t: {g: weight[g] for g in grams(t)}
    norm = lambda v: math.sqrt(sum(w * w for w in v.values()))
    want = {}
    for i, _, s, t in rows:
        for j, _, z, u in rows:
            if i < j and s == z:
                a, b = vector(t), vector(u)
                c = sum(w * b.get(g, 0) for g, w in a.items()) / norm(a) / norm(b)
                if c >= 0.4:
                    want[(i, j)] = round(c, 6)
    assert {(r.a, r.b): round(r.cosine, 6) for r in similar_pairs(nodes, (3,), 0.4).collect()} == want


def test_words_that_a_corpus_shares(spark):
    """A trade that no list has is told from names of their own, and parts or joins companies as listed trades do."""
    from tidemark.llm.variants import shared_words

    rnd = random.Random(9)
    own = ["".join(rnd.choice("bcdfglmnprst") + rnd.choice("aeiou") for _ in range(5)) for _ in range(24)]
    names = [n for i, o in enumerate(own) for n in (f"{o} Zeppelins Inc", f"{o.upper()} ZEPPELINS", f"{o} {'Quarries' if i % 2 else 'Foods'} Ltd")]
    df = spark.createDataFrame([("o", "", n) for n in names], "field_name string, scope_key string, name string")
    shared = shared_words(df)
    assert "zeppelins" in shared and not set(own) & set(shared)
    got = {(r.name_a, r.name_b) for r in variant_pairs(linked(df, False, (3,), 0.3)).collect()}
    assert got == {(f"{o.upper()} ZEPPELINS", f"{o} Zeppelins Inc") for o in own}


def test_names_of_signs_alone():
    assert same_organisation("***", "###") == 0 and same_organisation("***", "***") == 1
