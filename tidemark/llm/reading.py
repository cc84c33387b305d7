"""Reading level of each document: a familiar-word formula with a step.

A document's measures are the share of its words outside a list of familiar words, and the mean length of its sentences.
Document frequency over the corpus alone cannot make that list: what only a sixth of the corpus uses may be jargon or the
words of a children's story. So the list compares document frequencies in easy and in hard texts: a word is familiar if at
least as large a share of the labelled documents of levels 1 to 3 use it as of levels 4 and 5; words that fewer than
`least_labelled` labelled documents use are familiar if `familiar_share` of the whole corpus use them. As in the classic
formulas of this kind, a share of unfamiliar words beyond a cut-off sets a document apart (levels 4 and 5); the cut-off, and on
either side of it a linear formula of both measures and the thresholds between its levels, are fitted to the labels, robust
against labels given in error.

Words that begin a sentence or are capitalised do not count for familiarity, as names would, unless the text is in
capitals throughout. English is told by the text alone: function words of each language, as shares of its words.

Defined cases: null, empty and blank texts have no level, nor have texts without a word; a text without end marks is one
sentence for each line; repeated documents get the same level; labels that are null, of unknown or non-English documents
are not used; with fewer than five labels, or labels of one side of the cut-off alone, fixed weights take the formula's place.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut

# Frequent function words of each language, none shared with English.
ENGLISH = frozenset("the of and to in that for on with as is was by it are this be its or from which at not an were has have after because while so they when had no if but more may up than".split())
OTHERS = frozenset("der die das und ist nicht ein eine den dem mit von zu für auf im des wurde werden sich bei le la les des et est une dans pour que qui sur pas du au par avec ne sont ont el los las una en por con para del se su fue y al más lo como".split()) - ENGLISH
WORD = re.compile(r"[^\W\d_]+(?:['’\-][^\W\d_]+)*")
SENTENCE_END = regex.compile(r"(?<=[.!?…。！？])[\"'”’)\]]*\s+(?=[\p{Lu}\p{N}\"'“‘(\[*#>\p{S}-])|[。！？]|\n+")
# Abbreviations whose full stop ends no sentence.
SHORT = frozenset("cf ex art no nos fig figs sec secs reg regs note tier ie eg i.e e.g vs per par para ch pt vol pp al approx inc corp ltd co dr mr ms mrs st jr sr u.s see".split())
CAPITAL = re.compile("[A-Z]")
LETTER_STOP = re.compile(r"[^\W\d_]\.\s*\Z")
URL = regex.compile(r"(?i)\b(?:https?://|www\.)\S+")
TAG = regex.compile(r"<[^<>]{1,200}>|&(?:[a-z]{2,8}|#\d+);")


FORMAT = regex.compile(r"\p{Cf}+")


def clean(text: str) -> str:
    """Without markup, addresses and invisible signs, compatibility forms resolved."""
    if "<" in text or "&" in text:
        text = TAG.sub(" ", text)
    if "://" in text or "www." in text.lower():
        text = URL.sub(" ", text)
    return text if text.isascii() else FORMAT.sub("", unicodedata.normalize("NFKC", text))


def sentences(text: str) -> list[list[str]]:
    """Words of each sentence; a piece of abbreviations and numbers alone, or one that ends in an abbreviation, goes on in
    the next piece, and a single word is no sentence."""
    out, open_piece = [], []
    for piece in SENTENCE_END.split(text):
        words = WORD.findall(piece or "")
        if not words:
            continue
        words = open_piece + words
        ends_short = words[-1].lower() in SHORT and LETTER_STOP.search(piece) is not None
        if ends_short or all(w.lower() in SHORT or len(w) < 4 and w.isupper() for w in words):
            open_piece = words
            continue
        out.append(words)
        open_piece = []
    if open_piece:
        out.append(open_piece)
    return [s for s in out if len(s) > 1]


def english_share(counts: dict[str, int], total: int) -> float:
    """Share of English function words less that of other languages', from the counts of words in lower case."""
    return (sum(counts[w] for w in ENGLISH & counts.keys()) - sum(counts[w] for w in OTHERS & counts.keys())) / max(1, total)


def vocabulary(words: list[str], low: list[str], starts: list[int]) -> list[str]:
    """The words that count for familiarity, lower case, with repeats; `starts`: where sentences begin."""
    letters = "".join(words)
    capitals = len(CAPITAL.findall(letters)) if letters.isascii() else sum(map(str.isupper, letters))
    if capitals > 0.5 * max(1, len(letters)):
        return low
    first = dict.fromkeys(starts)
    return [x for i, (w, x) in enumerate(zip(words, low)) if w[0] == x[0] and i not in first]


#: The formula where labels are too few, or of easy or of hard texts alone: only corpus frequency and sentence length tell.
UNFITTED = {"step": 0.5, "easy": ([-1.9, 0.0, 1.75], [1.6, 2.5]), "hard": ([2.4, 2.0, 0.5], [4.6])}
MEASURES = "doc_id long, words long, pieces long, english double, sentences long, counted long, letters long, terms array<string>, term_counts array<int>"


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, counts and distinct words of each document with a word."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for doc, text in zip(pdf["doc_id"].tolist(), pdf["text"].tolist()):
                body = clean(text)
                sents = sentences(body)
                words = list(chain.from_iterable(sents))
                if not words:
                    continue
                low = "\n".join(words).lower().split("\n")
                counts = Counter(vocabulary(words, low, list(accumulate(map(len, sents), initial=0))))
                english = english_share(Counter(low), len(words))
                rows.append((doc, len(words), len(text.split()), english, len(sents), sum(counts.values()), sum(map(len, words)), list(counts), list(counts.values())))
            yield pd.DataFrame(rows, columns=["doc_id", "words", "pieces", "english", "sentences", "counted", "letters", "terms", "term_counts"])

    return docs.where("doc_id is not null and text is not null").select("doc_id", "text").mapInPandas(run, MEASURES)


ENGLISH_FROM = 0.015
HARD = 4


def corpus_words(measures: DataFrame, share: float) -> list[str]:
    """Words that at least `share` of the English documents use: at most 1/share times the mean vocabulary of a document,
    whatever the size of the corpus, so the list can be sent to all tasks."""
    english = measures.where(F.col("english") > ENGLISH_FROM)
    total = english.count()
    df = english.select(F.explode("terms").alias("w")).groupBy("w").agg(F.count("*").alias("n")).where(F.col("n") >= max(2.0, share * total))
    return [r.w for r in df.select("w").collect()]


def labelled_words(labelled: DataFrame, least: int) -> dict[str, bool]:
    """Words of at least `least` labelled documents (terms, hard), and whether they are familiar; bounded by the labels."""
    hard, easy = (labelled.where("hard" if h else "not hard").count() for h in (True, False))
    counts = labelled.select("hard", F.explode("terms").alias("w")).groupBy("w").agg(F.count_if(F.col("hard")).alias("h"), F.count_if(~F.col("hard")).alias("e")).where(F.col("h") + F.col("e") >= least)
    return {r.w: (r.e + 0.5) / (easy + 1) >= (r.h + 0.5) / (hard + 1) for r in counts.collect()}


def features(measures: DataFrame, corpus: list[str], labelled: dict[str, bool]) -> DataFrame:
    """doc_id, pieces, english, and the formula's measures: share of unfamiliar words, log of the mean sentence length."""
    known = frozenset({w for w in corpus if labelled.get(w, True)} | {w for w, familiar in labelled.items() if familiar})

    @F.pandas_udf("double")
    def unfamiliar(terms: pd.Series, counts: pd.Series) -> pd.Series:
        return pd.Series([float(sum(c for t, c in zip(ts, cs) if t not in known)) for ts, cs in zip(terms, counts)], dtype=float)

    return measures.select("doc_id", "pieces", "english", (unfamiliar("terms", "term_counts") / F.greatest("counted", F.lit(1))).alias("unfamiliar"), F.log(F.col("words") / F.col("sentences")).alias("sentence"))


def _between(x: np.ndarray, high: np.ndarray) -> float:
    """The cut of x that parts high from low with the fewest errors; the middle of the best ones."""
    order = np.argsort(x, kind="stable")
    x, high = x[order], high[order]
    wrong = np.concatenate([[np.sum(~high)], np.sum(~high) + np.cumsum(np.where(high, 1, -1))])
    edges = np.concatenate([[x[0] - 1], (x[1:] + x[:-1]) / 2, [x[-1] + 1]])
    best = np.flatnonzero(wrong == wrong.min())
    gaps = np.concatenate([[1e-9], x[1:] - x[:-1], [1e-9]])
    return float(edges[best[np.argmax(gaps[best])]])


def fit(rows: list[tuple[float, float, int]], rounds: int = 30) -> dict:
    """From (unfamiliar, sentence, level): `step`, and for easy and hard texts weights (1, unfamiliar, sentence) and cuts."""
    data = np.array(rows, float)
    step = _between(data[:, 0], data[:, 2] >= HARD)
    out = {"step": step}
    for name, side, levels in (("easy", data[data[:, 0] <= step], (2, 3)), ("hard", data[data[:, 0] > step], (5,))):
        side = side[(side[:, 2] >= HARD) == (name == "hard")]
        x, y = np.c_[np.ones(len(side)), side[:, :2]], side[:, 2]
        w = np.ones(len(y))
        beta = np.zeros(3)
        for _ in range(rounds if len(y) else 0):
            a = x * w[:, None]
            beta = np.linalg.solve(a.T @ x + 1e-6 * np.eye(3), a.T @ y)
            r = np.abs(y - x @ beta)
            scale = max(1e-3, 1.4826 * np.median(r))
            w = np.where(r < 4.685 * scale, (1 - (r / (4.685 * scale)) ** 2) ** 2, 0.0)
        cuts = [_between(x @ beta, y >= level) if len(y) else level - 0.5 for level in levels]
        out[name] = (beta.tolist(), list(np.maximum.accumulate(cuts)))
    return out


def reading_levels(docs: DataFrame, labels: DataFrame, familiar_share: float = 0.1, least_labelled: int = 3, most_labels: int = 50_000, seed: int = 0) -> DataFrame:
    """`doc_id, pieces, english, unfamiliar, sentence, score, level` of each document with a word.

    docs: `doc_id, text`. labels: `doc_id, reading_level` (1 to 5). At most `most_labels` labelled English documents, those
    with the least hash of doc_id and seed, fit the list and the formula; all else covers every document."""
    m = cut(measured(docs), "measures")
    told = m.where(F.col("english") > ENGLISH_FROM).join(labels.where("reading_level between 1 and 5").select("doc_id", "reading_level"), "doc_id")
    told = cut(told.select("*", (F.col("reading_level") >= HARD).alias("hard")).orderBy(F.xxhash64("doc_id", F.lit(seed))).limit(most_labels), "labelled")
    corpus, labelled = corpus_words(m, familiar_share), labelled_words(told, least_labelled)
    rows = features(told, corpus, labelled).join(told.select("doc_id", "reading_level"), "doc_id").select("unfamiliar", "sentence", "reading_level").collect()
    sides = {r.reading_level >= HARD for r in rows}
    f = fit([tuple(r) for r in rows]) if len(rows) >= 5 and len(sides) == 2 else UNFITTED
    hard = F.col("unfamiliar") > f["step"]
    linear = lambda beta: F.lit(beta[0]) + F.lit(beta[1]) * F.col("unfamiliar") + F.lit(beta[2]) * F.col("sentence")
    score = F.when(hard, linear(f["hard"][0])).otherwise(linear(f["easy"][0]))
    above = lambda cuts: sum(((F.col("score") >= c).cast("int") for c in cuts), F.lit(0))
    level = F.when(hard, F.lit(HARD) + above(f["hard"][1])).otherwise(F.lit(1) + above(f["easy"][1]))
    return features(m, corpus, labelled).withColumn("score", score).withColumn("level", level)
