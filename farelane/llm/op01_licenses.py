"""Licence scan by a positional index of rare licence words; DataFrame functions only."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base phrases with their labels, and what parts words.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Template:
    """A licence notice: its label, its words, and the phrases in it that must stand in place."""

    label: str
    text: str
    phrases: tuple[str, ...]
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def mandatory(self) -> list[tuple[int, list[str]]]:
        """Each phrase's words with the place of the first in the template."""
        out, words = [], self.words
        for phrase in self.phrases:
            own = phrase.split()
            out.append((next(i for i in range(len(words)) if words[i : i + len(own)] == own), own))
        return out


#: Openings of well-known public licence notices, by their published wording.
NOTICES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", ("permission is hereby granted free of charge", "deal in the software without restriction")),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template("gpl-2.0+", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2", ("gnu general public license", "either version 2")),
    Template("gpl-3.0+", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3", ("gnu general public license", "either version 3")),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", ("general public license version 3",)),
    Template("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation", ("lesser general public license",)),
    Template("agpl", "under the terms of the gnu affero general public license as published by the free software foundation", ("affero general public license",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms", "following conditions are met")),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license v 2 0",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("with or without fee is hereby granted",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software", "public domain")),
    Template("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
)
TEMPLATES = (*[Template(label, text, (text,), True) for text, label in BASE.items()], *NOTICES)

#: Rarest mandatory words of a template that the index lists.
INDEXED = 3
#: Share of a notice's words, by weight, that have to stand in place.
THRESHOLD = 0.8


def words_column(text: Column) -> Column:
    """The words of a text in order, ASCII capitals lowered; null is empty."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(lowered, SEPARATORS), lambda w: w != "")


def _array(values: list) -> Column:
    return F.array(*map(F.lit, values))


def word_weights(words: DataFrame, vocabulary: list[str]) -> dict[str, float]:
    """Inverse document frequency of each licence word over all documents.

    At most one row for each word of the templates comes to the driver, whatever the data.
    """
    present = words.select(F.explode(F.array_intersect("words", _array(vocabulary))).alias("word"))
    counts = {r.word: r.n for r in present.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    most = max(counts.values(), default=0)
    return {w: math.log((most + 1) / (counts.get(w, 0) + 1)) + 1.0 for w in vocabulary}


def index_template(template: Template, weights: dict[str, float]) -> list[tuple[str, int]]:
    """The template's rarest mandatory words with their places in it."""
    places = [(words[i], at + i) for at, words in template.mandatory for i in range(len(words))]
    return sorted(set(places), key=lambda p: (-weights[p[0]], p[1]))[:INDEXED]


def _matches(number: int, template: Template, weights: dict[str, float], threshold: float) -> Column:
    """Where the template stands in a document, as structs of template, start and share."""
    starts = None
    for word, at in index_template(template, weights):
        own = _starts(word, at)
        starts = own if starts is None else F.array_intersect(starts, own)

    def holds(start: Column) -> Column:
        out = F.lit(True)
        for at, words in template.mandatory:
            here = F.slice("words", F.greatest(start + at, F.lit(0)) + 1, len(words))
            out = out & (start + at >= 0) & (here == _array(words))
        return out

    def share(start: Column) -> Column:
        own, worth = _array(template.words), _array([weights[w] for w in template.words])
        parts = F.transform(
            own,
            lambda w, i: F.when(F.get("words", start + i) == w, F.get(worth, i)).otherwise(0.0),
        )
        total = sum(weights[w] for w in template.words)
        return F.round(F.aggregate(parts, F.lit(0.0), lambda a, x: a + x) / total, 9)

    found = F.transform(
        F.filter(starts, holds),
        lambda s: F.struct(F.lit(number).alias("template"), s.alias("start"), share(s).alias("share")),
    )
    return found if template.base else F.filter(found, lambda x: x["share"] >= threshold)


def _starts(word: str, at: int) -> Column:
    """Where a template would start for each place of its word ``word``."""
    return F.transform(F.filter("places", lambda p: p["word"] == word), lambda p: p["at"] - at)


def find_licenses(
    docs: DataFrame,
    templates: tuple[Template, ...] = TEMPLATES,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id``, ``n_words`` and ``found`` for each of ``docs``: template, start word, share in place.

    The index lists each template under the rarest of its mandatory words, by document frequency
    over all of ``docs``, with their places in it. A file looks up its words in the index; the starts
    that the places of a template's listed words imply are intersected, and at each start left the
    mandatory phrases are compared word by word. A notice also needs ``threshold`` of its words, by
    weight, in place; a base phrase is mandatory as a whole. As all listed words are mandatory, no
    place is lost.

    Each document is looked at in its own row: nothing is shuffled but the document frequencies of
    the templates' words. Null and empty texts have no words and no licence. Repeated rows and null
    ids are rows of their own; an empty table gives no row. Other columns are not read.
    """
    rows = docs.select(docs[id_col].alias("doc_id"), words_column(docs[text_col]).alias("words"))
    weights = word_weights(rows, sorted({w for t in templates for w in t.words}))
    listed = sorted({w for t in templates for w, _ in index_template(t, weights)})
    placed = F.filter(
        F.transform("words", lambda w, i: F.when(w.isin(listed), F.struct(i.alias("at"), w.alias("word")))),
        lambda x: x.isNotNull(),
    )
    found = [_matches(n, t, weights, threshold) for n, t in enumerate(templates)]
    return rows.withColumn("places", placed).select(
        "doc_id", F.size("words").cast("long").alias("n_words"), F.flatten(F.array(*found)).alias("found")
    )


def scan_licenses(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, **options) -> DataFrame:
    """What ``find_licenses`` finds, summed for each document: base places, labels and a score.

    ``score`` is the largest share of a template's words, by weight, that stand in place; 0 without
    any. ``first_word`` and ``last_word`` are the smallest and largest start of a base place.
    """
    names = _array([t.label for t in templates])
    base = _array([n for n, t in enumerate(templates) if t.base])

    def labels(found: str) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda x: F.get(names, x["template"])))), ",")

    found = find_licenses(docs, templates, **options)
    found = found.withColumn("base", F.filter("found", lambda x: F.array_contains(base, x["template"])))
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.start").cast("long").alias("first_word"),
        F.array_max("base.start").cast("long").alias("last_word"),
        labels("base").alias("base_labels"),
        labels("found").alias("labels"),
        F.coalesce(F.array_max("found.share"), F.lit(0.0)).alias("score"),
    )
