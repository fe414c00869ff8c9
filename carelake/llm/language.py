"""Language identification by averaged hashed subword embeddings.

A text's ASCII letters are lower-cased, other ASCII characters become one space,
and its byte 2-, 3- and 4-grams are hashed into buckets.  The mean of the
buckets' embeddings goes through a linear softmax.  Both are trained in numpy by
stochastic gradient descent on a bounded sample of labelled texts: whole texts
and random passages of them, down to a few words.  Temperature and rejection are
calibrated on a fifth of the sample that training does not see: a text is
rejected when its score is below the ``reject`` quantile of the scores of right
answers there (at most ``ceiling``), or when it has no letter.

Prediction covers whole texts in pieces of bounded size: the mean and the softmax
weights commute, so a bucket's embedding is multiplied with the weights once.

Defined results: a null text, or one without any letter, is ``und`` with score 0;
so is every text if there is nothing to learn from; rows without a language are
predicted like any other; repeated rows come back as often as they came.
"""

from __future__ import annotations

import pickle
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 15
UNKNOWN = "und"
PIECE = 1 << 17  # bytes; a piece's arrays take about a hundred times that
_FOLD = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint8)


class Model(NamedTuple):
    languages: list[str]
    scores: np.ndarray  # bucket x language: embedding times weights
    bias: np.ndarray
    temperature: float
    floor: float


def grams(text: bytes) -> np.ndarray:
    """Bucket of every 2-, 3- and 4-gram of a folded text."""
    b = _FOLD[np.frombuffer(b" " + text + b" ", np.uint8)]
    space = b == 32
    b = b[~(space & np.concatenate([[False], space[:-1]]))].astype(np.uint32)
    if len(b) < 3:
        return np.zeros(0, np.uint32)
    two = b[:-1] * np.uint32(0x9E3779B1) + b[1:] * np.uint32(0x85EBCA77)
    three = two[:-1] * np.uint32(0xC2B2AE3D) + b[2:] * np.uint32(0x27D4EB2F)
    four = three[:-1] * np.uint32(0x165667B1) + b[3:] * np.uint32(0x9E3779B1)
    return np.concatenate([(x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(17) for x in (two, three, four)])


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def gram_counts(text: str, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buckets and their shares for a text and random passages of it."""
    data, words = [text.encode()], text.split()
    random = np.random.default_rng(seed & 0x7FFFFFFF)
    for length in (4, 12, 40):
        if len(words) > length:
            at = int(random.integers(len(words) - length))
            data.append(" ".join(words[at:at + length]).encode())
    out = []
    for d in data:
        total = np.zeros(BUCKETS, np.int64)
        for lo in range(0, len(d), PIECE):
            total += np.bincount(grams(d[lo:lo + PIECE]), minlength=BUCKETS)
        where = np.flatnonzero(total)
        if len(where):
            out.append((where.astype(np.int32), (total[where] / total.sum()).astype(np.float32)))
    return out


def train(examples: list[tuple[np.ndarray, np.ndarray]], labels: list[str], dim: int = 16, epochs: int = 6, rate: float = 0.5,
          seed: int = 0, reject: float = 0.002, ceiling: float = 0.5) -> Model | None:
    """Stochastic gradient descent on (buckets, shares) examples."""
    languages = sorted(set(labels))
    if not languages:
        return None
    random = np.random.default_rng(seed)
    embedding = random.uniform(-1, 1, (BUCKETS, dim)).astype(np.float32) / dim
    weights, bias = np.zeros((dim, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    target = np.array([languages.index(x) for x in labels])
    held = random.random(len(labels)) < 0.2 if len(labels) >= 20 else np.zeros(len(labels), bool)
    fit, steps = np.flatnonzero(~held), 0
    total = epochs * len(fit)
    for _ in range(epochs):
        for k in random.permutation(fit):
            where, share = examples[k]
            mean = share @ embedding[where]
            logits = mean @ weights + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[target[k]] -= 1
            step = rate * (1 - steps / total)
            # a bucket's gradient carries its share; scaled so that usual texts move their buckets at the common rate
            embedding[where] -= step * np.sqrt(share)[:, None] * (weights @ p)[None, :]
            weights -= step * np.outer(mean, p)
            bias -= step * 0.01 * p
            steps += 1
    scores = embedding @ weights
    check = np.flatnonzero(held) if held.any() else fit
    logits = np.array([examples[k][1] @ scores[examples[k][0]] + bias for k in check])
    right = target[check]

    def chances(temperature: float) -> np.ndarray:
        z = logits / temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def loss(temperature: float) -> float:
        return float(-np.log(chances(temperature)[np.arange(len(right)), right] + 1e-12).mean())

    temperature = min(np.geomspace(0.25, 8, 36), key=loss)
    best = chances(temperature)
    good = best.max(axis=1)[best.argmax(axis=1) == right]
    floor = min(ceiling, float(np.quantile(good, reject))) if len(good) else 0.0
    return Model(languages, scores.astype(np.float32), bias, float(temperature), floor)


def predict(model: Model | None, text: str | None) -> tuple[str, float]:
    """Language and calibrated score of a whole text."""
    if model is None or not text or not has_letter(text):
        return UNKNOWN, 0.0
    data, total, count = text.encode(), np.zeros(len(model.languages)), 0
    for lo in range(0, len(data), PIECE):
        where = grams(data[lo:lo + PIECE])
        total += model.scores[where].sum(axis=0, dtype=np.float64)
        count += len(where)
    z = (total / max(count, 1) + model.bias) / model.temperature
    z = np.exp(z - z.max())
    z /= z.sum()
    return model.languages[int(z.argmax())], float(z.max())


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", key: Column | None = None, per_language: int = 400,
        **options) -> Model | None:
    """Train on about ``per_language`` texts of each language (the bound of the sample).

    The sample takes rows by a hash of ``key`` (the text if not given).  Its grams
    are counted where its rows are, training runs in one task on these counts (of
    the bounded sample only), and the driver receives the model.
    """
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"),
                       F.xxhash64(F.lit("language sample"), F.col(text_col) if key is None else key).alias("h"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = rows.groupBy("lang").count().collect()
    if not sizes:
        return None
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], min(1.0, per_language / r["count"]))])
    sample = rows.where(F.pmod("h", F.lit(1_000_000)) < share[F.col("lang")] * 1_000_000)

    def counted(batches):
        for batch in batches:
            out = [(lang, *x) for text, lang, h in zip(batch["text"], batch["lang"], batch["h"]) if has_letter(text)
                   for x in gram_counts(text, h)]
            yield pd.DataFrame({"examples": [pickle.dumps(out)]})

    def trained(batches):
        found = [x for batch in batches for packed in batch["examples"] for x in pickle.loads(packed)]
        found.sort(key=lambda x: (x[0], x[1].tobytes(), x[2].tobytes()))  # the same model in any order of arrival
        yield pd.DataFrame({"model": [pickle.dumps(train([x[1:] for x in found], [x[0] for x in found], **options))]})

    packed = sample.mapInPandas(counted, "examples binary").repartition(1)
    model = packed.mapInPandas(trained, "model binary").first()
    return None if model is None else pickle.loads(model["model"])


def predictions(model: Model | None, text: Column) -> Column:
    """Struct (lang_pred, score, accepted) of a text column."""

    @F.pandas_udf("lang_pred string, score double, accepted boolean")
    def run(texts: pd.Series) -> pd.DataFrame:
        found = [predict(model, t) for t in texts]
        floor = model.floor if model is not None else 0.0
        return pd.DataFrame({"lang_pred": [x[0] for x in found], "score": [x[1] for x in found],
                             "accepted": [x[0] != UNKNOWN and x[1] >= floor for x in found]})

    return run(text)


def accepted(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """Documents whose language the model does not reject, with all their columns."""
    return docs.where(predictions(model, F.col(text_col))["accepted"])
