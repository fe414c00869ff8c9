"""Toxicity scores from a weighted lexicon matched by Aho-Corasick.

Texts are lower-cased and folded: homoglyphs to Latin letters, digits and signs
that stand for letters inside words to those letters, everything else that is no
letter or digit to one space.  Lexicon entries are words and word beginnings
(four to six letters); an automaton finds them all in one pass over the text.
At one place the heaviest entry counts, and entries inside an exception phrase do
not.  The score is a logistic function of the weight found and of the weight per
word.

The lexicon is learned from labelled rows: an entry's weight is its log odds
between the places of toxic and other documents (places with the same words
beside them are one, so copies do not count again), and it is kept if the lower
end of the odds' 95 % interval is high enough.  The logistic function is fitted on rows that the
lexicon was not learned from.  Both use a sample of about ``sample`` labelled
rows (the bound), the lexicon at most ``most_entries`` entries; scoring covers
whole texts.

Defined results: null and empty texts are scored like any text without a match;
without labelled rows of both kinds every score is 0; labels other than 0 and 1
are left out; repeated rows come back as often as they came.
"""

from __future__ import annotations

import zlib
from typing import NamedTuple

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import Scratch

# Letters of other scripts that look like Latin ones, and characters that stand for letters.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "е": "e", "ё": "e", "һ": "h", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m", "о": "o", "р": "p",
    "ѕ": "s", "т": "t", "у": "y", "х": "x", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p",
    "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ł": "l", "ø": "o", "ℓ": "l",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "scum line", "stupid question", "sore loser")
_TABLE = str.maketrans(HOMOGLYPHS)
_WITH_DIGITS = str.maketrans(HOMOGLYPHS | SUBSTITUTES)
_OTHER = regex.compile(r"[^\w@$]+|_+")
_MIXED = regex.compile(r"[a-z][0-9@$]|[0-9@$][a-z]")
_SIGNS = regex.compile(r"[@$]+")
BEGINNINGS = (4, 5, 6)
LEAST = 5


class Model(NamedTuple):
    weights: dict[str, float]  # " word " or " begi"
    exceptions: tuple[str, ...]
    slope: tuple[float, float]
    offset: float


def fold(text: str | None) -> str:
    """Folded text with a space before and after each word."""
    folded = " " + _OTHER.sub(" ", (text or "").lower().translate(_TABLE)).strip() + " "
    if _MIXED.search(folded):
        folded = " ".join(w.translate(_WITH_DIGITS) if _MIXED.search(w) else w for w in folded.split(" "))
    return _SIGNS.sub("", folded)


def entries(folded: str) -> set[tuple[str, int]]:
    """Candidate lexicon entries of a folded text with a hash of the words beside them."""
    words = folded.split()
    out = set()
    for before, word, after in zip(["", *words], words, [*words[1:], ""]):
        if len(word) < 40:
            beside = zlib.crc32(f"{before} {after}".encode())
            out.add((f" {word} ", beside))
            out.update([(" " + word[:n], beside) for n in BEGINNINGS if len(word) > n])
    return out


def learn(counts: list[tuple[str, int, int]], toxic: int, clean: int, most_entries: int = 5000, least: int = LEAST,
          margin: float = 1.5) -> dict[str, float]:
    """Weights of the entries (entry, toxic places, clean places) that tell the labels apart."""
    found = []
    for entry, pos, neg in counts:
        odds = np.log((pos + 0.5) / (toxic + 1)) - np.log((neg + 0.5) / (clean + 1))
        lower = odds - 1.96 * np.sqrt(1 / (pos + 0.5) + 1 / (neg + 0.5))
        if pos >= least and lower >= margin:
            found.append((-lower, entry, float(odds)))
    return {entry: odds for _, entry, odds in sorted(found)[:most_entries]}


class Matcher:
    """Aho-Corasick automaton over lexicon entries and exception phrases."""

    def __init__(self, weights: dict[str, float], exceptions: tuple[str, ...]):
        self.automaton = ahocorasick.Automaton()
        for phrase in exceptions:
            self.automaton.add_word(f" {phrase} ", (len(phrase) + 2, 0.0))
        for entry, weight in weights.items():
            self.automaton.add_word(entry, (len(entry), weight))
        self.any = len(self.automaton) > 0
        if self.any:
            self.automaton.make_automaton()

    def measure(self, text: str | None) -> tuple[float, float]:
        """Log of the weight found, and log of the weight per hundred words."""
        folded = fold(text)
        if not self.any:
            return 0.0, 0.0
        best: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        for end, (length, weight) in self.automaton.iter(folded):
            start = end - length + 1
            if weight:
                best[start] = max(weight, best.get(start, 0.0))
            else:
                spared.append((start, end))
        if spared:
            best = {s: w for s, w in best.items() if not any(lo <= s < hi for lo, hi in spared)}
        total = sum(best.values())
        return float(np.log1p(total)), float(np.log1p(100 * total / max(1, folded.count(" ") - 1)))


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2, rounds: int = 50) -> tuple[np.ndarray, float]:
    """Ridge-penalised logistic regression by Newton's method."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w, ridge = np.zeros(a.shape[1]), np.diag([penalty] * x.shape[1] + [1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p) + 1e-9)[:, None]) + ridge, a.T @ (p - y) + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def _halves(h: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("half"), h), F.lit(2)) == 0


def fit(labelled: DataFrame, text_col: str = "text", label_col: str = "toxic", key: Column | None = None, sample: int = 16000,
        exceptions: tuple[str, ...] = EXCEPTIONS, most_entries: int = 5000) -> Model:
    """Learn from rows with a text and a label of 0 or 1."""
    rows = labelled.select(F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("label"),
                           F.xxhash64(F.lit("toxicity sample"), F.col(text_col) if key is None else key).alias("h"))
    rows = rows.where(F.col("label").isin(0, 1))
    count = rows.count()
    if not count:
        return Model({}, exceptions, (0.0, 0.0), -30.0)
    rows = rows.where(F.pmod("h", F.lit(1_000_000)) < 1e6 * min(1.0, sample / count)).withColumn("learn", _halves(F.col("h")))

    def candidates(batches):
        for batch in batches:
            found = {(e, b, int(label)) for text, label in zip(batch["text"], batch["label"]) for e, b in entries(fold(text))}
            yield pd.DataFrame(list(found), columns=["entry", "beside", "label"])

    places = rows.where("learn").select("text", "label").mapInPandas(candidates, "entry string, beside long, label int").distinct()
    counts = places.groupBy("entry").agg(F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg"))
    counts = Scratch(labelled.sparkSession, "toxicity").save(counts, "entries")
    totals = counts.where("endswith(entry, ' ')").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).first()
    if not totals["pos"] or not totals["neg"]:
        return Model({}, exceptions, (0.0, 0.0), -30.0)
    # few of all words can pass, and only they are collected
    kept = counts.where(f"pos >= {LEAST} AND pos / {totals['pos']} > 4 * neg / {totals['neg']}").orderBy(F.desc(F.col("pos") / (F.col("neg") + 1)), "entry")
    kept = kept.limit(20 * most_entries).collect()
    weights = learn([(r["entry"], r["pos"], r["neg"]) for r in kept], totals["pos"], totals["neg"], most_entries)
    measured = rows.where("NOT learn").select(measures(weights, exceptions, F.col("text")).alias("m"), "label").select("m.*", "label").toPandas()
    if measured["label"].nunique() < 2:
        return Model(weights, exceptions, (1.0, 1.0), -4.0)
    slope, offset = fit_logistic(measured[["total", "density"]].to_numpy(), measured["label"].to_numpy(float))
    return Model(weights, exceptions, tuple(map(float, slope)), offset)


def measures(weights: dict[str, float], exceptions: tuple[str, ...], text: Column) -> Column:
    @F.pandas_udf("total double, density double")
    def run(texts: pd.Series) -> pd.DataFrame:
        matcher = Matcher(weights, exceptions)
        return pd.DataFrame([matcher.measure(t) for t in texts], columns=["total", "density"], dtype=float)

    return run(text)


def score(model: Model, text: Column) -> Column:
    """Score column, 0 to 1."""
    m = measures(model.weights, model.exceptions, text)
    z = m["total"] * model.slope[0] + m["density"] * model.slope[1] + model.offset
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))))
