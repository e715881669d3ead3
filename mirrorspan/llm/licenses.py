"""Licence scan by a positional index of rare words.

The index lists, for the rarest words of every template (by the number of
documents of the corpus that hold them), the templates and the positions they
stand at. A document's words are looked up in it; each hit proposes a template at
one place. The other template words are then compared at their relative positions
from that place: the key words of the template must all be there, and enough of
the rest.

Base templates are single phrases whose words are all key words, so each of their
places is found: it holds the phrase's rarest word. The index and the templates
are literals of the query, a few kilobytes; one pass counts document frequencies,
one pass scans, and nothing is shuffled but the counts.

Defined results: a null or empty text has no words, no places, empty label lists
and score 0; repeated rows and null ids are scanned like others; equally rare
words are taken in alphabetical order; an empty table gives no rows; only
``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Everything that ends a word: ASCII without digits and lower-case letters.
GAP = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


@dataclass(frozen=True)
class Template:
    """``text`` in lower-case words; ``keys`` are the phrases that must be there."""

    label: str
    text: str
    keys: tuple[str, ...] = ()
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    def key_positions(self) -> list[int]:
        words = self.words
        out: set[int] = set()
        for phrase in self.keys or (self.text,):
            own = phrase.split()
            at = next(k for k in range(len(words)) if words[k : k + len(own)] == own)
            out.update(range(at, at + len(own)))
        return sorted(out)


# The base phrases, then wordings of common licence notices.
TEMPLATES = (
    Template("cc-by", "cc by", base=True),
    Template("gpl", "general public license", base=True),
    Template("reserved", "all rights reserved", base=True),
    Template("cc-by-nc", "licensed under cc by nc", ("cc by nc",)),
    Template("cc-by-sa", "licensed under cc by sa", ("cc by sa",)),
    Template("cc-by-nd", "licensed under cc by nd", ("cc by nd",)),
    Template("cc0", "cc0 1 0 universal public domain dedication", ("cc0 1 0 universal",)),
    Template(
        "gpl-3.0",
        "licensed under the gnu general public license version 3",
        ("gnu general public license version 3",),
    ),
    Template(
        "gpl-2.0",
        "licensed under the gnu general public license version 2",
        ("gnu general public license version 2",),
    ),
    Template("lgpl", "gnu lesser general public license"),
    Template("agpl", "gnu affero general public license"),
    Template("apache", "licensed under the apache license", ("apache license",)),
    Template(
        "apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2",)
    ),
    Template("mit", "released under the mit license", ("mit license",)),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files",
        ("permission is hereby granted free of charge",),
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification "
        "are permitted provided that the following conditions are met",
        ("redistribution and use in source and binary forms",),
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose "
        "with or without fee is hereby granted",
        ("permission to use copy modify and or distribute",),
    ),
    Template(
        "mpl-2.0",
        "subject to the terms of the mozilla public license v 2 0",
        ("mozilla public license",),
    ),
    Template(
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        ("free and unencumbered software",),
    ),
)
# Index words per template, and the share of template words at their places.
RAREST = 2
LEAST_MATCH = 0.6


def words_of(text: Column) -> Column:
    lower = F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())
    return F.filter(F.split(lower, GAP), lambda w: w != "")


def document_frequencies(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """In how many rows of ``docs`` each word of ``vocabulary`` occurs."""
    wanted = F.array(*map(F.lit, vocabulary))
    found = docs.select(F.explode(F.array_intersect(words_of(F.col("text")), wanted)).alias("word"))
    return {r["word"]: r["n"] for r in found.groupBy("word").agg(F.count("*").alias("n")).collect()}


def build_index(
    templates: tuple[Template, ...], frequencies: dict[str, int]
) -> dict[str, list[tuple[int, int]]]:
    """Postings (template, position) of the rarest words of every template.

    Words the corpus doesn't have can't be looked up and are passed over.
    """
    index: dict[str, list[tuple[int, int]]] = {}
    for t, template in enumerate(templates):
        known = sorted({w for w in template.words if frequencies.get(w)})
        rarest = sorted(known, key=lambda w: (frequencies[w], w))
        for word in rarest[: 1 if template.base else RAREST]:
            index.setdefault(word, []).extend(
                (t, k) for k, w in enumerate(template.words) if w == word
            )
    return index


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """(doc_id, n_words, places) of every row; a place is a template found in the text."""
    vocabulary = sorted({w for t in templates for w in t.words})
    index = build_index(templates, document_frequencies(docs, vocabulary))
    postings = _array(
        [
            F.struct(F.lit(w).alias("word"), F.lit(t).alias("template"), F.lit(k).alias("at"))
            for w, own in sorted(index.items())
            for t, k in own
        ],
        "array<struct<word:string,template:int,at:int>>",
    )
    models = F.array(*(
        F.struct(
            F.lit(t.label).alias("label"),
            F.lit(t.base).alias("base"),
            F.array(*map(F.lit, t.words)).alias("words"),
            F.array(*map(F.lit, t.key_positions())).alias("keys"),
        )
        for t in templates
    ))
    words = docs.select("doc_id", words_of(F.col("text")).alias("words"))
    numbered = F.transform("words", lambda w, i: F.struct(i.alias("at"), w.alias("word")))
    hits = words.select(
        "doc_id", "words", F.filter(numbered, lambda h: h.word.isin(sorted(index))).alias("hits")
    )

    def proposals(hit: Column) -> Column:
        return F.transform(
            F.filter(postings, lambda p: p.word == hit.word),
            lambda p: F.struct(p.template.alias("template"), (hit.at - p.at).alias("start")),
        )

    proposed = F.filter(
        F.array_distinct(F.flatten(F.transform("hits", proposals))), lambda p: p.start >= 0
    )

    def compared(place: Column) -> Column:
        model = F.get(models, place.template)
        same = F.zip_with(
            F.slice("words", place.start + 1, F.size(model.words)),
            model.words,
            lambda a, b: a.eqNullSafe(b),
        )
        return F.struct(
            model.label.alias("label"),
            model.base.alias("base"),
            place.start.cast("long").alias("start"),
            F.forall(model["keys"], lambda k: F.get(same, k)).alias("whole"),
            (F.size(F.filter(same, lambda x: x)) / F.size(model.words)).alias("match"),
        )

    placed = hits.select("doc_id", "words", F.when(F.size("hits") > 0, proposed).alias("proposed"))
    found = F.filter(
        F.transform("proposed", compared),
        lambda p: p.whole & (p.match >= LEAST_MATCH),
    )
    return placed.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.coalesce(
            found,
            F.array().cast(
                "array<struct<label:string,base:boolean,start:bigint,whole:boolean,match:double>>"
            ),
        ).alias("places"),
    )


def summary(places: DataFrame) -> DataFrame:
    """Counts, labels and score of every row of ``scan``."""
    base = places.withColumn("base", F.filter("places", lambda p: p.base))
    starts = F.transform("base", lambda p: p.start)

    def labels(column: str) -> Column:
        own = F.transform(column, lambda p: p.label)
        return F.array_join(F.array_sort(F.array_distinct(own)), ",")

    return base.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels("base").alias("base_labels"),
        labels("places").alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda p: p.match)), F.lit(0.0)).alias("score"),
    )


def _array(items: list[Column], kind: str) -> Column:
    return (F.array(*items) if items else F.array()).cast(kind)
