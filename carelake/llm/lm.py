"""Scores of texts under a log-bilinear neural model and under a unigram base.

Tokens are words (A-Z lower-cased, cut at ASCII white space) and one end token a
text.  The model gives P(word | context) = P(class | context) * P(word | class,
context), and both factors are log-bilinear: the embeddings of the six words
before, each scaled for its position, add up to a vector, whose products with the
class vectors, plus biases, are normalised over all classes, and whose products
with the vectors of the words of one class are normalised within it (batched matrix
products).  Words are classed by their rank: the most frequent ones and the end are
classes of their own, later ones share classes that get larger with the rank.  With
H words there are about sqrt(H) classes, so classes, embeddings and word vectors
grow with the vocabulary.  Words beyond the ``head`` most frequent ones, seen or
not, are classed by their last letters; within such a class the chance of a word
is its smoothed count (c + 1) over the class's sum, which keeps one count for
unseen words.

Training is noise-contrastive estimation in numpy on every position of every
training text: noise classes come from the class counts and are shared by a batch,
noise words evenly from the class of the word, shared by its positions in the batch.  Vectors start at zero and biases
at the logarithms of frequencies, so the untrained model is a unigram model.

Work on Spark: word counts over all training texts (summed before the shuffle);
word ids of every text written once, which training and scoring read; training on
every partition from the same start, whose rows are averaged by how often each was
used, in blocks of rows, so that the tasks send what they touched and the driver
gets one model; one scoring pass.  The ``head`` most frequent words and their
vectors travel with the tasks (the bound of what is broadcast); counts of all other
words reach the texts by a join on the word.

Defined results: null and empty texts are the end token alone; without training
texts every base score is 0 and the model is uniform over classes; rows are
scored one by one, so repeated rows and ids come back as they came.
"""

from __future__ import annotations

import zlib
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import Scratch

ORDER = 6
LETTERS = 64  # classes by last letters
ROWS = 2048  # rows of a block of parameters
_MARKS = b".,;:!?*#%&$()\"'|-"


class Ids(dict):
    """Ids of words: 0 is the end, 1 to H the frequent words, then the classes by last letters."""

    def __missing__(self, word: bytes) -> int:
        return len(self) + 1 + zlib.crc32((word.rstrip(_MARKS) or word)[-3:]) % LETTERS


class Vocabulary(NamedTuple):
    ids: Ids
    counts: np.ndarray  # of the ids 0 to H
    classes: np.ndarray  # class of every id
    start: np.ndarray  # first id of a class
    size: np.ndarray  # number of ids of a class
    total: int  # N
    distinct: int  # V
    texts: int


class Model(NamedTuple):
    context: np.ndarray  # id x dim
    position: np.ndarray  # order x dim
    word: np.ndarray  # id x (dim + bias)
    target: np.ndarray  # class x (dim + bias)


def _counted(batches):
    for batch in batches:
        for lo in range(0, batch.num_rows, 2000):
            counts = Counter()
            for text in batch["text"][lo:lo + 2000].to_pylist():
                counts.update(text.lower().split())
            yield pa.RecordBatch.from_pydict({"word": pa.array(list(counts), pa.binary()), "c": pa.array(list(counts.values()), pa.int64())})


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c) over all texts (binary column ``text``)."""
    return texts.select("text").mapInArrow(_counted, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _most_frequent(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """At most ``most`` words with the highest counts, cut between counts."""
    steps = counts.groupBy(F.floor(F.log2("c") * 16).alias("step")).agg(F.count("*").alias("n"), F.min("c").alias("least")).collect()
    held, least = 0, None
    for s in sorted(steps, key=lambda s: -s["step"]):
        held += s["n"]
        if held > most:
            break
        least = s["least"]
    if least is None:
        return []
    rows = counts.where(F.col("c") >= least).collect()
    return sorted(((bytes(r["word"]), r["c"]) for r in rows), key=lambda x: (-x[1], x[0]))


def class_starts(words: int) -> np.ndarray:
    """First ids of the classes of ``words`` ranked words and of the end: single ones, then ever larger ones."""
    half = int(np.ceil(np.sqrt(words) / 2))
    single = min(words, half)
    shared = single + 1 + np.round((words - single) * (np.arange(half) / max(half, 1)) ** 2)
    return np.unique(np.concatenate([np.arange(single + 1), shared[shared <= words]]).astype(np.int64))


def vocabulary(counts: DataFrame, texts: int, head: int) -> Vocabulary:
    sums = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    frequent = _most_frequent(counts, head)
    start = np.concatenate([class_starts(len(frequent)), len(frequent) + 1 + np.arange(LETTERS)])
    size = np.diff(np.append(start, len(frequent) + 1 + LETTERS))
    return Vocabulary(Ids((w, 1 + k) for k, (w, _) in enumerate(frequent)), np.array([texts, *[c for _, c in frequent]], np.int64),
                      np.repeat(np.arange(len(start)), size).astype(np.int32), start, size,
                      (sums["n"] or 0) + texts, sums["v"] + (texts > 0), texts)


def letter_sums(counts: DataFrame, vocab: Vocabulary) -> np.ndarray:
    """Sum of (count + 1) per class by last letters, with one unseen slot each."""
    ids, first = vocab.ids, len(vocab.counts)

    def summed(batches):
        for batch in batches:
            own = np.fromiter(map(ids.__getitem__, batch["word"].to_pylist()), np.int64, batch.num_rows) - first
            sums = np.bincount(own[own >= 0], batch["c"].to_numpy()[own >= 0] + 1, LETTERS)
            where = np.flatnonzero(sums)
            yield pa.RecordBatch.from_pydict({"k": pa.array(where, pa.int32()), "z": pa.array(sums[where].astype(np.int64))})

    out = np.ones(LETTERS)
    for r in counts.mapInArrow(summed, "k int, z long").groupBy("k").agg(F.sum("z").alias("z")).collect():
        out[r["k"]] += r["z"]
    return out


def first_model(vocab: Vocabulary, letters: np.ndarray, dim: int = 16, seed: int = 0) -> tuple[Model, np.ndarray]:
    """The unigram model, and the chance of every class."""
    weight = np.concatenate([vocab.counts + 1.0, letters])
    sums = np.add.reduceat(weight, vocab.start)
    random, ids = np.random.default_rng(seed), len(weight)
    word, target = np.zeros((ids, dim + 1), np.float32), np.zeros((len(sums), dim + 1), np.float32)
    word[:, dim], target[:, dim] = np.log(weight / sums[vocab.classes]), np.log(sums / sums.sum())
    context = random.normal(0, 0.3, (ids, dim)).astype(np.float32)
    context[0] = 0
    return Model(context, np.full((ORDER, dim), 1.0 / ORDER, np.float32), word, target), sums / sums.sum()


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _added(index: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct entries of ``index``, how often each occurs and the sums of their rows."""
    order = np.argsort(index, kind="stable")
    ordered = index[order]
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    return ordered[starts], np.diff(np.append(starts, len(index))), np.add.reduceat(rows[order], starts)


def vectors(model: Model, parts: np.ndarray) -> np.ndarray:
    """Context vectors, with a one for the bias, of the positions after the first ORDER ones of embeddings ``parts``."""
    n = len(parts) - ORDER
    out = np.ones((n, parts.shape[1] + 1), np.float32)
    own = out[:, :-1]
    own[:] = parts[ORDER - 1:ORDER - 1 + n] * model.position[0]
    for k in range(2, ORDER + 1):
        own += parts[ORDER - k:ORDER - k + n] * model.position[k - 1]
    return out


class Trainer:
    """Noise-contrastive estimation with Adagrad steps over a sequence of word ids."""

    def __init__(self, model: Model, vocab: Vocabulary, chance: np.ndarray, noise: int = 64, inner: int = 4, step: float = 0.1, seed: int = 0):
        self.model = Model(*[x.copy() for x in model])
        self.square = [np.ones(len(x), np.float32) for x in model]
        self.used = [np.zeros(len(x)) for x in model]
        self.classes, self.start, self.size, self.known = vocab.classes, vocab.start, vocab.size, len(vocab.counts)
        self.log_chance, self.upto = np.log(noise * chance).astype(np.float32), np.cumsum(chance)
        self.log_even = np.log(inner / np.maximum(self.size, 1)).astype(np.float32)
        self.noise, self.inner, self.step, self.random, self.seen = noise, inner, step, np.random.default_rng(seed), 0

    def _update(self, k: int, index: np.ndarray, times: np.ndarray, slope: np.ndarray) -> None:
        square = self.square[k][index] + np.square(slope).mean(axis=1)
        self.square[k][index] = square
        self.model[k][index] -= self.step * slope / np.sqrt(square)[:, None]
        self.used[k][index] += times

    def batch(self, ids: np.ndarray, wanted: np.ndarray) -> None:
        """One step on the positions after the first ORDER ones of ``ids``, as far as ``wanted``."""
        context, position, word, target = self.model
        n, parts = len(wanted), context[ids]
        given = vectors(self.model, parts)
        at = np.flatnonzero(wanted)
        vector, next_id = given[at], ids[ORDER:][at]
        kind = self.classes[next_id]
        drawn = np.minimum(np.searchsorted(self.upto, self.random.random(self.noise)), len(target) - 1)
        other = target[drawn]
        good = _sigmoid(np.einsum("nd,nd->n", vector, target[kind]) - self.log_chance[kind]) - 1
        bad = _sigmoid(vector @ other.T - self.log_chance[drawn])
        slope = good[:, None] * target[kind] + bad @ other
        found = [(3, *_added(np.concatenate([kind, drawn]), np.concatenate([good[:, None] * vector, bad.T @ vector])))]
        within = np.flatnonzero((self.size[kind] > 1) & (next_id < self.known))
        if len(within):
            within = within[np.argsort(kind[within].astype(np.uint16), kind="stable")]
            own, names, c = vector[within], next_id[within], kind[within]
            first = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
            group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(c))))
            size = self.size[c[first]][:, None]
            drawn = self.start[c[first]][:, None] + np.minimum((self.random.random((len(first), self.inner)) * size).astype(np.int64), size - 1)
            good_held, bad_held = word[names], word[drawn]
            good = _sigmoid(np.einsum("nd,nd->n", own, good_held) - self.log_even[c])[:, None] - 1
            held = bad_held[group]
            bad = _sigmoid(np.matmul(held, own[:, :, None])[:, :, 0] - self.log_even[c][:, None])
            slope[within] += good * good_held + np.matmul(bad[:, None, :], held)[:, 0]
            of_bad = np.add.reduceat((bad[:, :, None] * own[:, None, :]).reshape(len(c), -1), first).reshape(-1, own.shape[1])
            found.append((2, *_added(np.concatenate([names, drawn.ravel()]), np.concatenate([good * own, of_bad]))))
        back = np.zeros((n, parts.shape[1]), np.float32)
        back[at] = slope[:, :-1]
        of_parts, of_position = np.zeros_like(parts), np.empty_like(position)
        for k in range(1, ORDER + 1):
            of_parts[ORDER - k:ORDER - k + n] += back * position[k - 1]
            of_position[k - 1] = np.einsum("nd,nd->d", back, parts[ORDER - k:ORDER - k + n])
        index, times, rows = _added(ids, of_parts)
        found.append((0, index[index > 0], times[index > 0], rows[index > 0]))  # the end and what precedes a text stay zero
        found.append((1, np.arange(ORDER), np.full(ORDER, len(at)), of_position))
        for k, index, times, rows in found:
            self._update(k, index, times, rows)
        self.seen += len(at)

    def blocks(self):
        """Used rows, multiplied by their use, in blocks: table, first row, rows, uses, values."""
        for k, (values, used) in enumerate(zip(self.model, self.used)):
            for lo in range(0, len(values), ROWS):
                rows = np.flatnonzero(used[lo:lo + ROWS])
                if len(rows):
                    n = used[lo:lo + ROWS][rows]
                    yield k, lo, rows.astype(np.int32), n, (values[lo:lo + ROWS][rows] * n[:, None]).astype(np.float64)


def _sequence(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Texts end to end, ORDER zeros before each (the end of the last one included), and which positions are tokens."""
    pad = np.zeros(ORDER - 1, np.int32)
    ids = np.concatenate([np.zeros(1, np.int32), *[x for text in texts for x in (pad, text)]])
    wanted = np.ones(len(ids), bool)
    starts = 1 + np.cumsum([0, *[len(text) + ORDER - 1 for text in texts[:-1]]])
    wanted[(starts[:, None] + np.arange(ORDER - 1)).ravel()] = False
    return ids, wanted[ORDER:]


def _texts(batch: pa.RecordBatch, rows: int = 256):
    for lo in range(0, batch.num_rows, rows):
        yield lo, [np.frombuffer(x.as_buffer(), "<i4") for x in batch["ids"].slice(lo, rows)]


BLOCK = "part int, first int, rows binary, used binary, values binary"


def _block(part: int, first: int, rows: np.ndarray, used: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([first], pa.int32()),
                                       *[pa.array([x.tobytes()], pa.binary()) for x in (rows, used, values)]], names=["part", "first", "rows", "used", "values"])


def train(encoded: DataFrame, vocab: Vocabulary, chance: np.ndarray, model: Model, turn: int = 0, batch_size: int = 1024) -> tuple[Model, int]:
    """One round over every position of ``encoded`` (column ``ids``): the averaged model and the number of positions seen."""
    widths = [x.shape[1] for x in model]

    def local(batches):
        trainer = Trainer(model, vocab, chance, seed=turn)
        for batch in batches:
            for _, texts in _texts(batch):
                ids, wanted = _sequence(texts)
                for lo in range(0, len(wanted), batch_size):
                    if wanted[lo:lo + batch_size].any():
                        trainer.batch(ids[lo:lo + batch_size + ORDER], wanted[lo:lo + batch_size])
        for block in trainer.blocks():
            yield _block(*block)

    def added(batches):
        held: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for part, first, rows, used, values in zip(*[c.to_pylist() for c in batch.columns]):
                if (part, first) not in held:
                    held[part, first] = np.zeros(ROWS), np.zeros((ROWS, widths[part]))
                rows = np.frombuffer(rows, np.int32)
                held[part, first][0][rows] += np.frombuffer(used)
                held[part, first][1][rows] += np.frombuffer(values).reshape(len(rows), -1)
        for (part, first), (used, values) in held.items():
            rows = np.flatnonzero(used)
            yield _block(part, first, rows.astype(np.int32), used[rows], (values[rows] / used[rows][:, None]).astype(np.float32))

    out, seen = Model(*[x.copy() for x in model]), 0
    found = encoded.select("ids").mapInArrow(local, BLOCK).repartition("part", "first").mapInArrow(added, BLOCK)
    for r in found.toLocalIterator():
        rows = np.frombuffer(r["rows"], np.int32)
        out[r["part"]][r["first"] + rows] = np.frombuffer(r["values"], np.float32).reshape(len(rows), -1)
        if r["part"] == 1:  # every position uses the factors of all distances
            seen = int(np.frombuffer(r["used"])[0])
    return out, seen


def _log_sums(logits: np.ndarray) -> np.ndarray:
    """Logarithm of the sum of exponentials of each row; overwrites ``logits``."""
    most = np.zeros(len(logits), np.float32)
    if max(logits.max(), -logits.min()) > 60:  # else neither overflows nor vanishes
        most = logits.max(axis=1)
        logits -= most[:, None]
    np.exp(logits, out=logits)
    return most + np.log(logits.sum(axis=1).astype(np.float64))


def log_chances(model: Model, vocab: Vocabulary, ids: np.ndarray, rows: int = 512, piece: int = 1 << 17) -> np.ndarray:
    """log10 of the chance of each id after the first ORDER ones; a class by last letters counts as one id."""
    out = np.empty(len(ids) - ORDER)
    for at in range(0, len(out), piece):
        part = ids[at:at + piece + ORDER]
        vector, own = vectors(model, model.context[part]), part[ORDER:]
        kind, found = vocab.classes[own], out[at:at + piece]
        for lo in range(0, len(own), rows):
            logits = vector[lo:lo + rows] @ model.target.T
            mine = logits[np.arange(len(logits)), kind[lo:lo + rows]].astype(np.float64)
            found[lo:lo + rows] = mine - _log_sums(logits)
        inner = np.flatnonzero(vocab.size[kind] > 1)
        inner = inner[np.argsort(kind[inner], kind="stable")]
        for same in np.split(inner, np.flatnonzero(np.diff(kind[inner])) + 1) if len(inner) else []:
            first = int(vocab.start[kind[same[0]]])
            words = model.word[first:first + int(vocab.size[kind[same[0]]])]
            for lo in range(0, len(same), rows):
                some = same[lo:lo + rows]
                logits = vector[some] @ words.T
                mine = logits[np.arange(len(some)), own[some] - first].astype(np.float64)
                found[some] += mine - _log_sums(logits)
    return out / np.log(10)


ENCODED = ("uid long, id long, held_out boolean, n_tokens long, known long, logs double, ids binary, rare array<binary>, times array<int>")


def _encoded(vocab: Vocabulary):
    """Ids of a text's words (four bytes each, little-endian, the end last) and its words beyond the frequent ones."""
    ids, first = vocab.ids, len(vocab.counts)
    logs = np.log10(vocab.counts + 1.0)
    fields = ["uid", "id", "held_out", "n_tokens", "known", "logs", "ids", "rare", "times"]
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int32())]

    def run(batches):
        uid = TaskContext.get().partitionId() << 36
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part, out = batch.slice(lo, 256), []
                for doc_id, text, held in zip(part["id"].to_pylist(), part["text"].to_pylist(), part["held_out"].to_pylist()):
                    words = text.lower().split()
                    own = np.zeros(len(words) + 1, "<i4")
                    own[:-1] = np.fromiter(map(ids.__getitem__, words), "<i4", len(words))
                    rare = Counter([words[k] for k in np.flatnonzero(own >= first).tolist()])
                    frequent = own[own < first]
                    out.append((uid, doc_id, held, len(own), len(frequent) - (vocab.texts == 0), float(logs[frequent].sum()),
                                own.tobytes(), list(rare), list(rare.values())))
                    uid += 1
                yield pa.RecordBatch.from_arrays([pa.array(list(x), kind) for x, kind in zip(zip(*out), kinds)], names=fields)

    return run


def _scored(vocab: Vocabulary, letters: np.ndarray, model: Model):
    """Adds ``model``, the log10 chance of the text without the counts of its words beyond the frequent ones."""
    first, log_letters = len(vocab.counts), np.log10(letters)
    fields = ["uid", "id", "held_out", "n_tokens", "known", "logs"]

    def run(batches):
        for batch in batches:
            for lo, texts in _texts(batch):
                ids, wanted = _sequence(texts)
                chances = log_chances(model, vocab, ids)
                own = ids[ORDER:]
                chances[own >= first] -= log_letters[own[own >= first] - first]
                chances[~wanted] = 0
                starts = np.cumsum([0, *[len(text) + ORDER - 1 for text in texts[:-1]]])
                part = batch.slice(lo, len(texts))
                yield pa.RecordBatch.from_arrays([*[part[c] for c in fields], pa.array(np.add.reduceat(chances, starts))], names=[*fields, "model"])

    return run


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", head: int = 100_000, rounds: int = 1) -> DataFrame:
    """One row per document: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``."""
    scratch = Scratch(docs.sparkSession, "lm")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), held_out.alias("held_out"),
                       F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    learn = rows.where(~F.col("held_out"))
    counts = scratch.save(word_counts(learn), "counts")
    vocab = vocabulary(counts, learn.count(), head)
    letters = letter_sums(counts, vocab)
    model, chance = first_model(vocab, letters)
    encoded = scratch.save(rows.select("id", "text", "held_out").mapInArrow(_encoded(vocab), ENCODED), "encoded")
    for turn in range(rounds if vocab.texts else 0):
        model, _ = train(encoded.where(~F.col("held_out")), vocab, chance, model, turn)
    found = encoded.select("uid", "id", "held_out", "n_tokens", "known", "logs", "ids").mapInArrow(
        _scored(vocab, letters, model), "uid long, id long, held_out boolean, n_tokens long, known long, logs double, model double")
    rare = encoded.select("uid", F.explode(F.arrays_zip(F.col("rare").alias("word"), F.col("times").alias("times"))).alias("x"))
    rare = rare.select("uid", F.col("x.word").alias("word"), F.col("x.times").alias("times")).join(counts, "word")
    rare = rare.groupBy("uid").agg(F.sum("times").alias("rare_known"), F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("rare_logs"))
    joined = found.join(rare, "uid", "left")
    rare_logs = F.coalesce("rare_logs", F.lit(0.0))
    return joined.select(
        F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(vocab.total).cast("long").alias("train_tokens"),
        (F.col("logs") + rare_logs - F.col("n_tokens") * F.lit(float(np.log10(vocab.total + vocab.distinct + 1)))).alias("base_score"),
        (F.col("model") + rare_logs).alias("score"),
    )
