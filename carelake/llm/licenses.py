"""License scans with a positional index of rare words.

Each template is a run of words with a mandatory key phrase inside.  The index
keeps, for each template, the word of its key phrase that the fewest documents
of the corpus hold (highest IDF) and its offset.  A document that holds none of
these words is done.  Elsewhere each occurrence proposes a start (position less
offset); the start counts if the key phrase stands at its place and at least
``coverage`` of the template's words stand at their relative positions.  Since
the indexed word lies in the mandatory phrase, the index loses no match.

All of it is built-in functions on one row at a time: two scans (document
frequencies, then matches) and no shuffle beyond the frequencies, which have one
row per template word.

Defined results: null and empty texts have no words, no places, empty labels,
score 0; repeated rows come back as often as they came; every place counts,
however many a document holds.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


class Template(NamedTuple):
    label: str
    text: str
    key: str


# The phrases of the base scan, whole phrase mandatory.
BASE = (
    Template("mit", "mit license", "mit license"),
    Template("apache", "apache license", "apache license"),
    Template("gpl", "general public license", "general public license"),
)
# Opening words of well-known licence notices and their key phrases.
NOTICES = (
    Template("agpl", "gnu affero general public license", "affero general public license"),
    Template("apache", "licensed under the apache license version 2 0", "apache license version"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
             "source and binary forms"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("gpl", "licensed under the gnu general public license version 3", "gnu general public license"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose", "modify and or distribute"),
    Template("lgpl", "gnu lesser general public license", "lesser general public license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
             "hereby granted free of charge"),
    Template("mpl", "subject to the terms of the mozilla public license", "mozilla public license"),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             "free and unencumbered software"),
)


def words(text: Column) -> Column:
    """Words of the text with A-Z lower-cased.

    ``lower`` also changes letters beyond ASCII, which no template holds; the two
    that it would turn into ASCII ones are put aside first.
    """
    text = F.coalesce(text, F.lit(""))
    safe = F.when(text.rlike("[Kİ]"), F.translate(text, "Kİ", "ææ")).otherwise(text)
    return F.regexp_extract_all(F.lower(safe), F.lit(WORD), F.lit(0))


def key_offset(template: Template) -> int:
    text, key = template.text.split(), template.key.split()
    return next(k for k in range(len(text)) if text[k:k + len(key)] == key)


def document_frequencies(docs: DataFrame, text_col: str, templates: tuple[Template, ...]) -> dict[str, int]:
    """Documents that hold each key word; one row with a count per key word reaches the driver."""
    vocabulary = sorted({w for t in templates for w in t.key.split()})
    held = F.array_intersect(words(F.col(text_col)), F.array(*map(F.lit, vocabulary)))
    # one pass: exploding the words would add a filter that splits every text twice
    counts = docs.select(held.alias("held")).agg(*[F.count_if(F.array_contains("held", w)).alias(f"c{k}") for k, w in enumerate(vocabulary)])
    return dict(zip(vocabulary, counts.first()))


def rare_words(templates: tuple[Template, ...], frequencies: dict[str, int]) -> list[tuple[str, int]]:
    """Rarest key word of each template and its offset in the template."""
    out = []
    for t in templates:
        key, base = t.key.split(), key_offset(t)
        k = min(range(len(key)), key=lambda k: (frequencies[key[k]], k))
        out.append((key[k], base + k))
    return out


def _starts(t: Template, rare: str, offset: int, coverage: float) -> Column:
    """Structs (at, part) of a template's places: start of the key phrase's template and its covered part."""
    text, key, base = t.text.split(), t.key.split(), key_offset(t)
    proposed = F.transform(F.filter("anchors", lambda p: F.get("words", p) == rare), lambda p: p - offset)
    phrase = F.array(*map(F.lit, key))

    def verified(s: Column) -> Column:
        return (s + base >= 0) & (F.slice("words", F.greatest(s + base + 1, F.lit(1)), len(key)) == phrase)

    places = F.filter(proposed, verified)
    if len(text) == len(key):
        return F.transform(places, lambda s: F.struct(s.alias("at"), F.lit(1.0).alias("part")))

    def part(s: Column) -> Column:
        hits = [F.coalesce((F.get("words", s + k) == w).cast("int"), F.lit(0)) for k, w in enumerate(text)]
        total = hits[0]
        for hit in hits[1:]:
            total = total + hit
        return total / F.lit(float(len(text)))

    covered = F.transform(places, lambda s: F.struct(s.alias("at"), part(s).alias("part")))
    return F.filter(covered, lambda x: x["part"] >= coverage)


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is evaluated once: the optimizer copies expressions into their uses, but not across a generator."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base: tuple[Template, ...] = BASE,
         notices: tuple[Template, ...] = NOTICES, coverage: float = 0.8) -> DataFrame:
    """One row per document: id, ``n_words``, ``base_hits`` and ``notice_hits`` (label, start, covered part).

    A start may lie before the first word when a notice is cut off there.
    """
    templates = (*base, *notices)
    rare = rare_words(templates, document_frequencies(docs, text_col, templates))
    rows = docs.select(F.col(id_col), F.explode(F.array(words(F.col(text_col)))).alias("words"))
    index = F.array(*map(F.lit, sorted({w for w, _ in rare})))
    held = F.array_intersect("words", index)
    anchors = F.when(F.size(held) > 0, F.filter(
        F.sequence(F.lit(0), F.size("words") - 1), lambda p: F.array_contains(F.col("held"), F.get("words", p))))
    rows = _once(_once(rows, "held", held), "anchors", anchors)

    def named(label: str, places: Column) -> Column:
        return F.transform(places, lambda x: F.struct(F.lit(label).alias("label"), x["at"].alias("at"), x["part"].alias("part")))

    def hits(group: tuple[Template, ...], at: int) -> Column:
        found = [named(t.label, _starts(t, *rare[at + k], coverage)) for k, t in enumerate(group)]
        nothing = F.array().cast("array<struct<label:string,at:int,part:double>>")
        return F.when(F.col("anchors").isNotNull(), F.concat(*found)).otherwise(nothing)

    return rows.select(id_col, F.size("words").cast("long").alias("n_words"), hits(base, 0).alias("base_hits"),
                       hits(notices, len(base)).alias("notice_hits"))


def labelled(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, first and last place and labels of ``scan``."""
    every = F.concat("base_hits", "notice_hits")

    def names(hits: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(hits, lambda x: x["label"]))), ",")

    places = F.transform("base_hits", lambda x: x["at"].cast("long"))
    return scanned.select(
        id_col, "n_words", F.size("base_hits").cast("long").alias("n_base"), F.array_min(places).alias("first_word"),
        F.array_max(places).alias("last_word"), names(F.col("base_hits")).alias("base_labels"), names(every).alias("labels"),
        F.coalesce(F.array_max(F.transform(every, lambda x: x["part"])), F.lit(0.0)).alias("score"),
    )
