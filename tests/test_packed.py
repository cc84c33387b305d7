"""The splitter against a sign-by-sign reader written apart from it."""

import json
import re

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.operators.packed import Marked, Tails, _gather, split_buffer, split_packed, values_of

TAILS = (" Inc.", " Ltd.", " Type 1", " Myeloid, Acute", " Premature, Diseases")


def read_plainly(text, separators=";|,", tails=TAILS):
    text = (text or "").strip(" \t\n\r\f\v")
    if not text:
        return []
    if len(text) > 1 and text[0] == "[" and text[-1] == "]":
        try:
            return [x.strip() for x in json.loads(text) if x.strip()]
        except ValueError:
            text = text[1:-1]
    odd = text.count('"') % 2 == 1
    pieces, now, inside, i = [], "", False, 0
    while i < len(text):
        c = text[i]
        if c == '"' and not odd:
            inside = not inside
        if c in separators and not inside:
            if c == ",":
                hit = None
                for tail in sorted(tails, key=lambda t: -t.count(",")):
                    got = re.match(re.escape(tail) + r"\s*(?=[;|,]|$)", text[i + 1 :])
                    if got:
                        hit = got.group(0)
                        break
                if hit is not None:
                    now += c + hit
                    i += 1 + len(hit)
                    continue
            pieces.append(now)
            now = ""
        else:
            now += c
        i += 1
    pieces.append(now)
    out = []
    for p in (p.strip() for p in pieces):
        if len(p) > 1 and p[0] == p[-1] == '"' and not odd:
            core = p[1:-1].replace('""', "\0")
            if '"' not in core:
                p = core.replace("\0", '"').strip()
        if p:
            out.append(p)
    return out


def split_all(texts, separators=";|,"):
    parents, pos, values = split_buffer(pa.array(texts, pa.string()), separators, frozenset(t.encode() for t in TAILS))
    out = [[] for _ in texts]
    for p, k, v in zip(parents.tolist(), pos.tolist(), values.to_pylist()):
        out[p].append(v)
        assert k == len(out[p])
    return out


def test_hand_cases():
    cases = {
        None: [], "": [], "  ": [], "[]": [], '""': [], " , ; ": [],
        "A;B, Inc. ; C": ["A", "B, Inc.", "C"],
        "Asthma;Leukemia, Myeloid, Acute||Infant, Premature, Diseases;": ["Asthma", "Leukemia, Myeloid, Acute", "Infant, Premature, Diseases"],
        '"Knee ""F"" x", Zed,': ['Knee "F" x', "Zed"],
        '["A, Inc.","B \\"q\\" x"]': ["A, Inc.", 'B "q" x'],
        'a "odd, b': ['a "odd', "b"],
        "é; ü, Inc.|日本": ["é", "ü, Inc.", "日本"],
        "same;same": ["same", "same"],
    }
    assert split_all(list(cases)) == list(cases.values())
    assert split_all(["N/A", "Phase 1 / Phase 2", "NA/"], ";|,/") == [["N/A"], ["Phase 1", "Phase 2"], ["NA"]]


def test_no_rows_and_long_text():
    assert split_all([]) == []
    long = ";".join(f"name {i}, Inc." for i in range(50_000))
    assert len(split_all(["x", long, None])[1]) == 50_000


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.lists(st.sampled_from(["A", "b c", ",", ";", "|", " ", ", Inc.", '"', '""', "é", ", Type 1", "/"]), max_size=12).map("".join)), max_size=6))
def test_same_as_plain_reader(texts):
    assert split_all(texts) == [read_plainly(t) for t in texts]


def test_values_of(spark):
    rows = [("u1", '"Foo, Inc.";Bar', 1), ("u1", '"Foo, Inc.";Bar', 2), ("u2", "Foo, Inc.; Zed", 3), (None, "x", 4), ("u3", None, 5)]
    df = spark.createDataFrame(rows, "url string, organizations string, item_pos int")
    got = sorted(tuple(r) for r in values_of(df, "organizations", "url", "f").collect())
    assert got == [("f", "u1", 1, "Foo, Inc."), ("f", "u1", 2, "Bar"), ("f", "u2", 1, "Foo, Inc."), ("f", "u2", 2, "Zed")]
    assert values_of(df.limit(0), "organizations", "url", "f").count() == 0


def test_lexicon_by_join_equals_broadcast(spark):
    rows = [(str(i), t) for i, t in enumerate(['"Foo, Inc.";B', "Zed, Inc.|C", "A, B", "Leuk, My, Ac;x", '"Leuk, My, Ac"', "Q, Inc."])]
    df = spark.createDataFrame(rows, "k string, f string")
    a = split_packed(df, "f", ["k"]).collect()
    b = split_packed(df, "f", ["k"], tail_bound=0).collect()
    assert sorted(a) == sorted(b)


def test_whole_field_of_the_lake():
    import pyarrow.parquet as pq

    texts = pq.read_table("/root/testdata/sf0.01/clinical_trials.parquet").column("conditions").to_pylist()
    tails = {m.split(",", 1)[1] for t in texts if t for m in re.findall(r'"((?:[^"]|"")*)"', t) if "," in m}
    parents, _, values = split_buffer(pa.array(texts), ";|,", frozenset(t.encode() for t in tails))
    out = [[] for _ in texts]
    for p, v in zip(parents.tolist(), values.to_pylist()):
        out[p].append(v)
    assert out == [read_plainly(t, tails=tuple(tails)) for t in texts]


TAIL_PARTS = [" Inc.", " A", " B", " C", " D", " E", " Type 1", "x"]


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.lists(st.sampled_from(TAIL_PARTS), min_size=1, max_size=5).map(",".join), min_size=1, max_size=4),
    st.lists(st.lists(st.sampled_from(["Foo", "Bar/", ",", ";", "|", "/", " ", '"', ", Inc.", ", A, B, C, D, E", ", A, B", "x"]), max_size=10).map("".join), max_size=8),
    st.sampled_from([";|,", ";|,/"]),
)
def test_own_spans_bind_like_the_whole_lexicon(lexicon, texts, separators):
    """What the join brings to a row, its spans within the lexicon, binds the commas that the whole lexicon binds."""
    tails = Tails(lexicon)
    whole = [c.tolist() for c in split_buffer(pa.array(texts, pa.string()), separators, tails)]
    found = [[], [], []]
    for i, text in enumerate(texts):
        marked = Marked(pa.array([text]), separators)
        _, _, lo, hi = marked.spans(tails.most)
        own = {t for t in _gather(marked.buf, lo, hi).to_pylist() if t in lexicon}
        got = split_buffer(pa.array([text]), separators, Tails(own))
        for out, c in zip(found, (got[0] + i, got[1], got[2])):
            out += c.tolist()
    assert found == whole


def test_long_tails_and_slashes(spark):
    rows = [("a", '"Foo, A, B, C, D, E"'), ("b", "Foo, A, B, C, D, E; Y"), ("c", '"Bar, Inc."'), ("d", "Bar, Inc./Qux"), ("e", None), ("f", "Foo, A, Bee/ Cee")]
    df = spark.createDataFrame(rows, "k string, f string")
    want = {"a": ["Foo, A, B, C, D, E"], "b": ["Foo, A, B, C, D, E", "Y"], "c": ["Bar, Inc."], "d": ["Bar, Inc.", "Qux"], "f": ["Foo", "A", "Bee", "Cee"]}
    for bound in (0, 20_000):
        got = {}
        for r in sorted(split_packed(df, "f", ["k"], ";|,/", tail_bound=bound).collect(), key=lambda r: (r.k, r.item_pos)):
            got.setdefault(r.k, []).append(r.item_value)
        assert got == want
