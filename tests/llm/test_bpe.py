import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.bpe import TOKENIZERS, load, token_count, token_ids

TEXTS = [None, "", " ", "   \n\n\t x", "Hello world's <|endoftext|> end", "日本語です👍🏽", "a" * 9000, "ab" * 3000, "\x00\x01", "é́ß 12345 1,000.5%"]


@pytest.fixture(scope="module")
def known():
    t = Tokenizer.from_file(f"{TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return lambda x: t.encode(x or "", add_special_tokens=False).ids


def ours(texts):
    ids, at = load("byte_bpe_50k").encode(texts)
    return [ids[a:b].tolist() for a, b in zip(at, at[1:])]


def test_same_as_library(known):
    rnd = random.Random(2)
    noise = ["".join(rnd.choice("abcdeist ABC'éß語\n0123-_") for _ in range(rnd.randrange(200))) for _ in range(400)]
    assert ours(TEXTS + noise) == [known(t) for t in TEXTS + noise]


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_any_text(known, text):
    assert ours([text]) == [known(text)]


def test_every_way_gives_the_same_ids():
    v = load("byte_bpe_50k")
    for w in ["internationalization", " heteroskedastic", "aaaaabaaaa", "xyzzyqq", "語語語"]:
        raw = w.encode()
        assert v.merge(raw) == v.merge_long(raw) == list(v.encode_words([w])[0])


def test_column(spark, known):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "ids int, text string").repartition(3)
    got = {r.ids: (r.x, r.n) for r in df.select("ids", token_ids(F.col("text")).alias("x"), token_count(F.col("text")).alias("n")).collect()}
    assert got == {i: (known(t), len(known(t))) for i, t in enumerate(TEXTS)}
    assert df.limit(0).select(token_ids(F.col("text"))).count() == 0
