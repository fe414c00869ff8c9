"""Collocations: frequent phrases that say more than their parts.

Texts are lower-cased (A-Z), split into pieces at ``.,;:!?`` and line ends, and
those into words at spaces and tabs.  Counts are per language (null: ``und``).

A buffer of texts has the prefix sums of byte value * B^i modulo 2^64 (the
polynomial of Rabin and Karp, B odd and so with an inverse); the difference of two
prefixes, divided by B^i, is the fingerprint of the bytes between them.  Words
are fingerprinted so, and their fingerprints once more by the same polynomial,
which gives those of all n-grams; no step runs per word in Python.  A task adds up
equal ones before the shuffle and keeps a pointer to an occurrence (the hash of
text and language).  A second polynomial of other values and another base tells
apart phrases whose first fingerprints collide, and the text at the pointer is read and
hashed anew before a phrase counts, so a wrong pointer is noticed.

Lengths are counted one after the other.  A phrase is as rare as its rarest part,
so an n-gram is hashed on only if both its (n - 1)-grams are frequent; frequent
ones are looked up in a bitmap of bounded size, which lets some rare ones pass:
they cost time only, since the counts that follow are exact.  Text is made of
frequent phrases alone.

Defined results: null and empty texts have no words; rows with equal texts all
count; ids are not used.  An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm.common import Scratch
from carelake.llm.passages import _bitmap, _size

BREAK, BLANK = b".", b" "
FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\n\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + BREAK * 9 + BLANK)
BYTES = [np.random.default_rng(k).integers(0, 1 << 64, 256, np.uint64) for k in (1, 2)]
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)  # odd
PIECE, BUFFER, MERGED = 1 << 18, 1 << 19, 1 << 19
COUNTED = "key long, mark long, words int, f long, source long, lang string"


@lru_cache(maxsize=8)
def _powers(k: int, log_n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first 2^log_n powers of a base and of its inverse modulo 2^64."""
    out = []
    for base in (BASES[k], pow(BASES[k], -1, 1 << 64)):
        own = np.full(1 << log_n, base, np.uint64)
        own[0] = 1
        out.append(np.cumprod(own, dtype=np.uint64))
    return out[0], out[1]


class Prefixes:
    """Prefix sums of values * B^i: fingerprints of any of their runs."""

    def __init__(self, values: np.ndarray, k: int):
        powers, self.inverse = _powers(k, max(10, (len(values) + 1).bit_length()))
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * powers[:len(values)], dtype=np.uint64, out=self.sums[1:])

    def runs(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self.inverse[starts]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)
    return x ^ (x >> np.uint64(29))


def language_seeds(lang: str) -> tuple[int, int]:
    return tuple(xxhash.xxh64_intdigest(lang.encode(), 100 + k) for k in (0, 1))


class Grams:
    """The words of texts, and all their n-grams as fingerprints at word places.

    ``bits`` under 64 cut the first fingerprint (only to try collisions).
    """

    def __init__(self, texts: list[bytes], langs: list[str], bits: int = 64):
        self.bits, self.bytes = bits, b"".join(t.translate(FOLD) + BREAK for t in texts)
        raw = np.frombuffer(self.bytes, np.uint8)
        broken = raw == BREAK[0]
        inside = np.concatenate([[False], ~broken & (raw != BLANK[0]), [False]])
        self.starts, self.ends = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:])
        self.piece = np.cumsum(broken, dtype=np.int32)[self.starts]
        limits = np.cumsum([len(t) + 1 for t in texts])
        self.doc = np.searchsorted(limits, self.starts, side="right")
        seeds = np.array([language_seeds(x) for x in langs], np.uint64).reshape(-1, 2)
        self.seeds = [seeds[:, k] for k in (0, 1)]
        self.words = [Prefixes(self._words(raw, k), k) for k in (0, 1)]

    def _words(self, raw: np.ndarray, k: int) -> np.ndarray:
        """Fingerprints of the words, in bounded pieces of the text."""
        out, at = np.empty(len(self.starts), np.uint64), 0
        while at < len(self.starts):
            low = self.starts[at]
            upto = max(at + 1, int(np.searchsorted(self.ends, low + PIECE, side="right")))
            own = Prefixes(BYTES[k][raw[low:self.ends[upto - 1]]], k)
            out[at:upto] = mixed(own.runs(self.starts[at:upto] - low, self.ends[at:upto] - low))
            at = upto
        return out

    def places(self, n: int) -> np.ndarray:
        """Whether an n-gram of one piece starts at each word."""
        out = np.zeros(len(self.starts), bool)
        last = max(0, len(out) - n + 1)
        out[:last] = self.piece[:last] == self.piece[n - 1:]
        return out

    def prints(self, n: int, at: np.ndarray, k: int) -> np.ndarray:
        gram = self.words[k].runs(at, at + n) ^ self.seeds[k][self.doc[at]]
        x = mixed(gram + np.uint64(n * 0xC2B2AE3D27D4EB4F % (1 << 64)))
        return x << np.uint64(64 - self.bits) if k == 0 and self.bits < 64 else x

    def text(self, at: int, n: int) -> str:
        return b" ".join(self.bytes[s:e] for s, e in zip(self.starts[at:at + n], self.ends[at:at + n])).decode("utf-8", "replace")


def _merged(rows: list[np.ndarray]) -> list[np.ndarray]:
    """Rows (key, mark, f, source) with the counts of equal (key, mark) next to each other added up."""
    key, mark, f, source = rows
    order = np.argsort(key, kind="stable")
    key, mark = key[order], mark[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (mark[1:] != mark[:-1])
    starts = np.flatnonzero(new)
    return [key[starts], mark[starts], np.add.reduceat(f[order], starts) if len(starts) else f, source[order][starts]]


def _maybe(keys: np.ndarray, filters: np.ndarray, log_bits: int) -> np.ndarray:
    place = keys >> np.uint64(64 - log_bits)
    return (filters[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _count(n: int, bits: int, filters: np.ndarray | None, log_bits: int):
    """Counts of the n-grams of a task's texts, added up in bounded memory; with n = 1 also words per language (words = 0)."""

    def counted(texts, langs, sources, totals):
        grams = Grams(texts, langs, bits)
        good = grams.places(n)
        if n == 1:
            for doc, words in enumerate(np.bincount(grams.doc, minlength=len(texts)).tolist()):
                totals[langs[doc]] = totals.get(langs[doc], 0) + words
        if filters is not None:
            parts = np.flatnonzero(grams.places(n - 1))
            known = np.zeros(len(good) + 1, bool)
            known[parts] = _maybe(grams.prints(n - 1, parts, 0), filters, log_bits)
            good &= known[:-1] & known[1:]
        at = np.flatnonzero(good)
        return _merged([grams.prints(n, at, 0), grams.prints(n, at, 1), np.ones(len(at), np.int64), np.array(sources, np.int64)[grams.doc[at]]])

    def batches_of(key, mark, f, source, words, langs=None, step=1 << 16):
        for lo in range(0, len(key), step):
            part = slice(lo, lo + step)
            own = pa.nulls(len(key[part]), pa.string()) if langs is None else pa.array(langs[part])
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[part].view(np.int64)), pa.array(mark[part].view(np.int64)), pa.array(np.full(len(key[part]), words, np.int32)),
                 pa.array(f[part]), pa.array(source[part]), own], names=["key", "mark", "words", "f", "source", "lang"])

    def run(batches):
        held, size, totals, buffer, filled = [], 0, {}, ([], [], []), 0
        for batch in batches:
            for text, lang, source in zip(batch["text"], batch["lang"], batch["source"]):
                for own, value in zip(buffer, (text, lang, source)):
                    own.append(value.as_py())
                filled += len(buffer[0][-1])
                if filled < BUFFER:
                    continue
                held.append(counted(*buffer, totals))
                size += len(held[-1][0])
                buffer, filled = ([], [], []), 0
                if size > MERGED:
                    held = [_merged([np.concatenate(x) for x in zip(*held)])]
                    size = len(held[0][0])
                    if size > MERGED // 2:
                        yield from batches_of(*held.pop(), n)
                        size = 0
        if buffer[0]:
            held.append(counted(*buffer, totals))
        if held:
            yield from batches_of(*_merged([np.concatenate(x) for x in zip(*held)]), n)
        if totals:
            none = np.zeros(len(totals), np.int64)
            yield from batches_of(none, none, np.array(list(totals.values()), np.int64), none, 0, list(totals))

    return run


def _phrases(bits: int):
    """Texts of phrases, found in the documents they point to and hashed anew, and the fingerprints of their parts."""
    pair = pa.struct([("key", pa.int64()), ("mark", pa.int64())])
    cut = pa.struct([("k", pa.int32()), ("first", pair), ("rest", pair)])
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.list_(cut), pa.list_(pair)]

    def run(batches):
        for batch in batches:
            rows = {name: [] for name in ("key", "mark", "words", "f", "lang", "phrase", "cuts", "inner")}
            for text, lang, places in zip(batch["text"], batch["lang"].to_pylist(), batch["places"].to_pylist()):
                grams = Grams([text.as_py()], [lang], bits)

                def pairs(n, at, grams=grams):
                    own = [grams.prints(n, at, k).view(np.int64).tolist() for k in (0, 1)]
                    return [{"key": key, "mark": mark} for key, mark in zip(*own)]

                wanted = {(x["key"], x["mark"]): (x["words"], x["f"]) for x in places}
                for n in sorted({words for words, _ in wanted.values()}):
                    at, keys = np.flatnonzero(grams.places(n)), {key for (key, _), (words, _) in wanted.items() if words == n}
                    at = at[np.isin(grams.prints(n, at, 0).view(np.int64), list(keys))]
                    here = {(x["key"], x["mark"]): where for x, where in zip(pairs(n, at), at.tolist())}
                    found = [(x, here[x]) for x in here if wanted.get(x, (0, 0))[0] == n]
                    at = np.array([where for _, where in found], np.int64)
                    part = {(a, m): pairs(m, at + a) for m in range(1, n) for a in range(n - m + 1)}
                    for i, (x, where) in enumerate(found):
                        inner = {tuple(part[a, m][i].values()): part[a, m][i] for a, m in part if m > 1}
                        cuts = [{"k": k, "first": part[0, k][i], "rest": part[k, n - k][i]} for k in range(1, n)]
                        for name, value in zip(rows, (*x, n, wanted[x][1], lang, grams.text(where, n), cuts, list(inner.values()))):
                            rows[name].append(value)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), types)], names=list(rows))

    return run


PHRASES = ("key long, mark long, words int, f long, lang string, phrase string, "
           "cuts array<struct<k:int,first:struct<key:bigint,mark:bigint>,rest:struct<key:bigint,mark:bigint>>>, inner array<struct<key:bigint,mark:bigint>>")


@dataclass
class Counts:
    """``words``: lang, n. ``frequent``: fingerprints (key, mark) with ``f``. ``phrases``: ``PHRASES`` of two words and more."""

    words: DataFrame
    frequent: DataFrame
    phrases: DataFrame


def count(docs: DataFrame, longest: int = 4, least: int = 30, text_col: str = "text", lang_col: str = "lang", bits: int = 64) -> Counts:
    """Words per language and the phrases of up to ``longest`` words that occur ``least`` times or more."""
    scratch = Scratch(docs.sparkSession, "phrases")
    rows = docs.select(
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"))
    rows = rows.select("text", "lang", F.xxhash64("text", "lang").alias("source"))
    frequent, words, filters, log_bits = [], None, None, 0
    for n in range(1, longest + 1):
        local = rows.mapInArrow(_count(n, bits, filters, log_bits), COUNTED)
        # tasks have added up already, so rows go straight to the shuffle instead of through another map-side table
        total = local.repartition("key", "mark").groupBy("key", "mark", "words", "lang").agg(F.sum("f").alias("f"), F.min("source").alias("source"))
        kept = scratch.save(total.where((F.col("f") >= least) | (F.col("words") == 0)), f"frequent-{n}")
        if n == 1:
            words = kept.where("words = 0").select("lang", F.col("f").alias("n"))
            kept = kept.where("words > 0")
        frequent.append(kept.select("key", "mark", "words", "f", "source"))
        if n < longest:
            log_bits = _size(kept.count())
            filters = _bitmap(kept, "key", log_bits)
    every = frequent[0]
    for more in frequent[1:]:
        every = every.unionByName(more)
    pointed = every.where("words > 1").groupBy("source").agg(F.collect_list(F.struct("key", "mark", "words", "f")).alias("places"))
    pointed = scratch.save(pointed, "pointed")
    # one row of each text that is pointed at
    texts = rows.join(pointed.select("source"), "source", "left_semi").dropDuplicates(["source", "text"])
    phrases = texts.join(pointed, "source").select("text", "lang", "places").mapInArrow(_phrases(bits), PHRASES)
    return Counts(words, every.select("key", "mark", "f"), scratch.save(phrases, "phrases"))


def _wide(value: Column) -> Column:
    return value.cast("decimal(20,0)")


def collocations(docs: DataFrame, longest: int = 4, least: int = 30, covered: int = 80, top: int = 2000, **options) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` of each language.

    A phrase is cut in two in every place; its score is floor(2000000 a / (l + r))
    of the lowest cut.  Phrases inside a longer one that makes up ``covered`` % of
    their occurrences or more go.  Products are decimals, so nothing is rounded.
    """
    found = count(docs, longest, least, **options)
    scratch = Scratch(docs.sparkSession, "collocations")
    counts = found.frequent
    cuts = found.phrases.select("key", "mark", F.col("f").alias("a"), F.inline("cuts"))
    for part in ("first", "rest"):
        own = counts.select(F.struct("key", "mark").alias(part), F.col("f").alias(f"f_{part}"))
        cuts = cuts.join(own, part)
    value = F.expr("CAST(CAST(a AS DECIMAL(20,0)) * 2000000 AS DECIMAL(38,0)) div (CAST(f_first AS DECIMAL(20,0)) + f_rest)")
    cuts = cuts.select("key", "mark", F.struct(value.alias("score"), "k", F.col("f_first").alias("l"), F.col("f_rest").alias("r")).alias("cut"))
    lowest = scratch.save(cuts.groupBy("key", "mark").agg(F.min("cut").alias("cut")), "scores")
    around = found.phrases.select(F.col("f").alias("longer"), F.inline("inner")).groupBy("key", "mark").agg(F.max("longer").alias("longer"))
    around = scratch.save(around, "around")
    scored = found.phrases.select("key", "mark", "lang", "phrase", F.col("f").alias("a")).join(lowest, ["key", "mark"])
    scored = scored.join(around, ["key", "mark"], "left").where(
        F.col("longer").isNull() | (_wide(F.col("longer")) * 100 < _wide(F.col("a")) * covered))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    scored = scored.select("lang", "phrase", "a", "cut.l", "cut.r", F.col("cut.score").alias("score"))
    best = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(found.words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
