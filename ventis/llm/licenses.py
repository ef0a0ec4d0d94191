"""License scan: a positional index of rare words over notice templates, DataFrame functions only.

One pass cuts every text into words and keeps, per document, which words of the templates occur;
the words themselves stay only where the mandatory phrase of a template is complete. Document
frequencies of the template words give their IDF. Then each document looks up its rarest license
words in the postings of the templates: a word's places minus its place in the template are the
possible starts, and the starts of several words are intersected. At a common start the mandatory
phrase is compared word by word, and the share of the template that stands there is weighed by IDF.
Nothing is shuffled but the counts of the template words.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ventis.session import materialize

# Share of a template's IDF mass that has to stand around its mandatory phrase.
MIN_SHARE = 0.8
# Rarest words of the mandatory phrase whose postings are intersected.
LOOKUPS = 3
SHARE_DIGITS = 6

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases that count wherever their words stand together.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
# Public license notices as (label, notice, mandatory phrase within it).
NOTICES = [
    ("agpl-3.0", "gnu affero general public license version 3", "gnu affero general public license"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license",
     "except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are "
     "permitted provided that the following conditions are met",
     "redistribution and use in source and binary forms"),
    ("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    ("cc0-1.0", "to the extent possible under law the author has waived all copyright and related "
     "or neighboring rights to this work", "waived all copyright and related or neighboring rights"),
    ("gpl-2.0", "licensed under the gnu general public license version 2",
     "gnu general public license version 2"),
    ("gpl-3.0", "licensed under the gnu general public license version 3",
     "gnu general public license version 3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or "
     "without fee is hereby granted", "for any purpose with or without fee is hereby granted"),
    ("lgpl", "gnu lesser general public license", "lesser general public license"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this "
     "software and associated documentation files to deal in the software without restriction",
     "permission is hereby granted free of charge"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0",
     "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     "free and unencumbered software"),
]


@dataclass(frozen=True)
class Template:
    """A notice, the place of its mandatory phrase, and whether it is one of the base phrases."""

    label: str
    words: tuple[str, ...]
    key: tuple[str, ...]
    base: bool = False

    @property
    def key_at(self) -> int:
        size = len(self.key)
        for at in range(len(self.words) - size + 1):
            if self.words[at:at + size] == self.key:
                return at
        raise ValueError(f"{self.label}: the mandatory phrase is not part of the notice")

    def lookups(self, idf: dict[str, float]) -> list[tuple[str, list[int]]]:
        """The rarest words of the mandatory phrase with their places in the notice."""
        rarest = sorted(set(self.key), key=lambda word: (-idf[word], word))[:LOOKUPS]
        inside = range(self.key_at, self.key_at + len(self.key))
        return [(word, [at for at in inside if self.words[at] == word]) for word in rarest]


def templates(phrases: dict[str, str] = PHRASES,
              notices: list[tuple[str, str, str]] = NOTICES) -> list[Template]:
    own = [Template(label, tuple(p.split()), tuple(p.split()), True) for p, label in phrases.items()]
    return own + [Template(label, tuple(n.split()), tuple(k.split())) for label, n, k in notices]


def words_of(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; a null text has none."""
    return F.array_remove(
        F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), SEPARATORS), "")


def _strings(values) -> Column:
    return F.array(*(F.lit(v) for v in values))


def license_words(docs: DataFrame, known: list[Template], text_col: str = "text",
                  id_col: str = "doc_id") -> DataFrame:
    """Rows (doc_id, n_words, found, words): the template words that occur; the words of the text
    only where some mandatory phrase may be complete."""
    vocabulary = _strings(sorted({word for t in known for word in t.words}))
    may_hold = F.lit(False)
    for key in sorted({t.key for t in known}):
        may_hold |= F.size(F.array_except(_strings(key), F.col("found"))) == 0
    cut = docs.select(F.col(id_col).cast("long").alias("doc_id"), words_of(F.col(text_col)).alias("words"))
    seen = cut.select("doc_id", "words", F.array_intersect("words", vocabulary).alias("found"))
    return seen.select("doc_id", F.size("words").cast("long").alias("n_words"), "found",
                       F.when(may_hold, F.col("words")).alias("words"))


def inverse_frequencies(seen: DataFrame, known: list[Template]) -> dict[str, float]:
    """IDF of every template word over all documents. As many entries as the templates have words."""
    rows = seen.count()
    counted = seen.select(F.explode("found").alias("word")).groupBy("word").count().collect()
    held = {row["word"]: row["count"] for row in counted}
    return {word: math.log(1 + rows / (1 + held.get(word, 0)))
            for word in sorted({word for t in known for word in t.words})}


def _index(known: list[Template], idf: dict[str, float]) -> Column:
    """The templates with their postings and weights, as one array of structs."""
    def entry(t: Template) -> Column:
        weights = [idf[word] for word in t.words]
        lookups = [F.struct(F.lit(word).alias("word"), F.array(*map(F.lit, ats)).alias("ats"))
                   for word, ats in t.lookups(idf)]
        return F.struct(
            F.lit(t.label).alias("label"), F.lit(t.base).alias("base"),
            _strings(t.words).alias("words"), _strings(t.key).alias("key"),
            F.lit(t.key_at).alias("key_at"), F.array(*map(F.lit, weights)).alias("weights"),
            F.lit(math.fsum(weights)).alias("mass"), F.array(*lookups).alias("lookups"))
    return F.array(*map(entry, known))


_STARTS = """
    flatten(transform(filter(transform(words, (w, i) -> if(w = {look}.word, i, NULL)),
                             p -> p IS NOT NULL),
                      p -> transform({look}.ats, a -> p - a)))"""
# Starts common to all looked-up words, with the mandatory phrase in place, and their share.
_PLACES = f"""
    flatten(transform(
        filter(known, t -> size(array_except(t.key, found)) = 0),
        t -> filter(transform(
            filter(
                aggregate(slice(t.lookups, 2, size(t.lookups)), array_distinct({_STARTS.format(look='t.lookups[0]')}),
                          (common, look) -> array_intersect(common, {_STARTS.format(look='look')})),
                s -> if(s + t.key_at >= 0, slice(words, s + t.key_at + 1, size(t.key)) = t.key, false)),
            s -> struct(
                t.label AS label, t.base AS base, s + t.key_at AS at,
                aggregate(sequence(0, size(t.words) - 1), 0D,
                          (sum, i) -> sum + if(get(words, s + i) <=> t.words[i], t.weights[i], 0D))
                    / t.mass AS share)),
            place -> place.base OR place.share >= {MIN_SHARE}D)))"""


def scan_licenses(docs: DataFrame, known: list[Template] | None = None, text_col: str = "text",
                  id_col: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score, and ``places`` (label, base, at, share) of every notice found.

    A notice is found where its mandatory phrase stands and at least ``MIN_SHARE`` of its IDF mass
    around it; base phrases are mandatory as a whole. ``score`` is the best share, 1 for a whole
    notice or a base phrase, 0 if nothing is found. A null or empty text has no words and no label.
    Repeated rows get equal results, null ids stay null, an empty table gives no row, and further
    columns play no part. Words are never cut off, however long the text.
    """
    known = templates() if known is None else known
    seen = materialize(license_words(docs, known, text_col, id_col), "license-words")
    index = _index(known, inverse_frequencies(seen, known))
    none = F.expr("CAST(array() AS array<struct<label: string, base: boolean, at: int, share: double>>)")
    scanned = seen.withColumn("known", index).withColumn(
        "places", F.when(F.col("words").isNotNull(), F.expr(_PLACES)).otherwise(none))
    base = F.filter("places", lambda place: place["base"])

    def named(places: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(places["label"])), ",")

    found = scanned.select("doc_id", "n_words", "places", base.alias("base"))
    best = F.round(F.array_max(F.col("places")["share"]), SHARE_DIGITS)
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(F.col("base")["at"]).cast("long").alias("first_word"),
        F.array_max(F.col("base")["at"]).cast("long").alias("last_word"),
        named(F.col("base")).alias("base_labels"), named(F.col("places")).alias("labels"),
        F.coalesce(best, F.lit(0.0)).alias("score"), "places")
