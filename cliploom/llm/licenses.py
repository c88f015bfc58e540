"""License scan with a positional index of rare words.

Templates are licence texts and notices, of which some phrases are mandatory. One pass over all documents counts in how many of
them each word of these phrases occurs. Of each phrase, the ANCHORS words with the highest inverse document frequency
are indexed with their positions. A second pass looks up which of these words a file has and where; an occurrence minus a
position is where the phrase would begin, and only beginnings on which all of a phrase's anchors agree are compared with the
whole phrase. A template of several phrases is found where all of them stand as far apart as in the template, give or take
SLACK words each. Which words are rare decides how little is compared, not what is found: no phrase that stands in a file is missed.

All of it is one projection over the documents, without Python workers and without a shuffle of texts; the counts are as many rows as
templates have words. Within a file, work grows with its words, however often a phrase recurs.

Defined cases: a null or empty text has no word and no licence; rows are scanned each, so repeated ids and rows get a result each, null
ids too; very long texts are scanned whole; an empty table gives no rows; all columns pass through, and where one has an
output's name, the output gets an underscore more.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh

#: Digits, lower-case ASCII letters and everything beyond ASCII make words.
LICENSE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Labels, and licence words as public licence texts and notices have them. Brackets mark mandatory phrases.
BASE = (
    ("mit", "[mit license]"),
    ("apache", "[apache license]"),
    ("gpl", "[general public license]"),
)
TEMPLATES = (
    ("mit-notice", "[released under the mit license]"),
    (
        "mit-text",
        "[permission is hereby granted free of charge] to any person obtaining a copy of this software and associated documentation files"
        " the software [to deal in the software without restriction] including without limitation [the rights to use copy modify merge publish distribute]",
    ),
    ("apache-2.0", "[licensed under the apache license version 2 0]"),
    ("gpl-2.0", "[gnu general public license version 2]"),
    ("gpl-3.0", "[gnu general public license version 3]"),
    (
        "gpl-notice",
        "[is free software you can redistribute it and or modify it] [under the terms of the gnu general public license] as published by the [free software foundation]",
    ),
    ("lgpl", "[gnu lesser general public license]"),
    ("agpl", "[gnu affero general public license]"),
    ("bsd", "[redistribution and use in source and binary forms] [with or without modification] are permitted provided [that the following conditions are met]"),
    ("isc", "[permission to use copy modify and or distribute this software] for any purpose [with or without fee is hereby granted]"),
    ("mpl-2.0", "[mozilla public license version 2 0]"),
    ("cc-by-4.0", "[cc by 4 0]"),
    ("cc-by-sa-4.0", "[cc by sa 4 0]"),
    ("cc-by-nc-4.0", "[cc by nc 4 0]"),
    ("cc0-1.0", "[cc0 1 0]"),
    ("unlicense", "[this is free and unencumbered software released into the public domain]"),
    ("all-rights-reserved", "[all rights reserved]"),
)

ANCHORS = 3
SLACK = 8
#: Bits of a place in a key of phrase and place.
PLACE_BITS = 40


@dataclass(frozen=True)
class Phrase:
    """A mandatory phrase, the template it belongs to, and how many words of the template stand before it."""

    label: str
    template: int
    start: int
    words: tuple[str, ...]


def phrases(templates: tuple[tuple[str, str], ...]) -> list[Phrase]:
    out = []
    for k, (label, text) in enumerate(templates):
        for m in re.finditer(r"\[([^\]]*)\]", text):
            out.append(Phrase(label, k, len(text[: m.start()].replace("]", "").replace("[", "").split()), tuple(m[1].split())))
    return out


def words_of(text: Column) -> Column:
    """The words of a text, A to Z in lower case."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), ascii_uppercase, ascii_lowercase), F.lit(LICENSE_WORD), F.lit(0))


def document_frequency(docs: DataFrame, text: str, wanted: list[str]) -> dict[str, int]:
    """In how many documents each of the wanted words occurs."""
    held = F.array_intersect(words_of(F.col(text)), F.array(*map(F.lit, wanted)))
    counts = docs.select(F.explode(held).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return {r["word"]: r["n"] for r in counts.collect()}  # a row per wanted word at most


def _anchors(known: list[Phrase], frequency: dict[str, int]) -> list[list[tuple[str, int]]]:
    """By phrase, its rarest words with their first positions, the rarest first."""
    return [sorted({w: p.words.index(w) for w in p.words}.items(), key=lambda a: (frequency.get(a[0], 0), a[0]))[:ANCHORS] for p in known]


def _ints(values: list[int], kind: str) -> Column:
    return F.array(*map(F.lit, values)).cast(f"array<{kind}>")


def scan(docs: DataFrame, text: str = "text", templates: tuple[tuple[str, str], ...] = BASE + TEMPLATES) -> DataFrame:
    """Adds license_words, the number of words, and licenses: array of struct(label, place, words), a row for each place of a
    template, the first word of its first phrase, and how many words are verified; by place and template."""
    known = phrases(templates)
    anchors = _anchors(known, document_frequency(docs, text, sorted({w for p in known for w in p.words})))
    postings: dict[str, list[int]] = {}
    for k, found in enumerate(anchors):
        for word, position in found:
            postings.setdefault(word, []).append((k << PLACE_BITS) - position)
    index = F.create_map(*[c for w, keys in postings.items() for c in (F.lit(w), _ints(keys, "bigint"))])

    taken = list(docs.columns)
    n_words, licenses = fresh("license_words", taken), fresh("licenses", taken)
    words, keys, held = (fresh(x, [*taken, n_words, licenses]) for x in ("_words", "_keys", "_held"))
    rows = docs.select("*", words_of(F.col(text)).alias(words))
    # where the phrases of the file's indexed words would begin
    begins = F.transform(words, lambda w, i: F.when(w.isin(*postings), F.transform(F.element_at(index, w), lambda key: key + i)))
    rows = rows.select("*", F.array_sort(F.flatten(F.array_compact(begins))).alias(keys))

    need = _ints([len(a) for a in anchors], "int")
    lengths = _ints([len(p.words) for p in known], "int")
    whole = F.array(*[F.array(*map(F.lit, p.words)) for p in known])

    def phrase(key: Column) -> Column:
        return F.shiftright(key, PLACE_BITS).cast("int")

    def place(key: Column) -> Column:
        return key.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int")

    def agreed(key: Column, i: Column) -> Column:
        first = (i == 0) | (F.get(keys, i - 1) < key)
        return (key >= 0) & first & (F.get(keys, i + F.get(need, phrase(key)) - 1) == key)

    def verified(key: Column) -> Column:
        return F.slice(words, place(key) + 1, F.get(lengths, phrase(key))) == F.get(whole, phrase(key))

    within = F.filter(F.filter(keys, agreed), lambda key: place(key) < F.size(words))
    rows = rows.select("*", F.filter(within, verified).alias(held))

    def origins(k: int) -> Column:
        """Where the template of a phrase would begin."""
        return F.transform(F.filter(held, lambda key: phrase(key) == k), lambda key: place(key) - known[k].start)

    def near(k: int) -> Column:
        return F.flatten(F.transform(origins(k), lambda at: F.sequence(at - SLACK, at + SLACK)))

    def matches(at: Column, p: Phrase, n: int) -> Column:
        return F.transform(at, lambda x: F.struct((x + p.start).cast("long").alias("place"), F.lit(p.label).alias("label"), F.lit(n).cast("long").alias("words")))

    every = []
    for t in range(len(templates)):
        first, *rest = [k for k, p in enumerate(known) if p.template == t]
        at = origins(first)
        for k in rest:
            at = F.array_intersect(at, near(k))
        every.append(matches(at, known[first], sum(len(p.words) for p in known if p.template == t)))
    none = F.array().cast("array<struct<place:bigint,label:string,words:bigint>>")
    found = F.when(F.size(held) > 0, F.array_sort(F.concat(*every))).otherwise(none)
    return rows.select(*taken, F.size(words).cast("long").alias(n_words), found.alias(licenses))


def oracle(templates: tuple[tuple[str, str], ...] = BASE + TEMPLATES) -> str:
    """The query in DuckDB's SQL, by comparing every phrase at every word."""
    values = ", ".join(f"({k}, {p.template}, '{p.label}', {p.start}, {list(p.words)})" for k, p in enumerate(phrases(templates)))
    labels = ", ".join(f"'{label}'" for label, _ in BASE)
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), p AS (SELECT * FROM (VALUES {values}) v(k, t, label, start, words)
), spot AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d
), held AS (
  SELECT r, k, t, label, i - 1 AS place, i - 1 - start AS origin FROM spot JOIN p ON w[i] = words[1] AND w[i:i + len(words) - 1] = words
), template AS (SELECT t, any_value(label) AS label, min(k) AS first, count(*) AS n_phrases, sum(len(words)) AS n FROM p GROUP BY t
), found AS (
  SELECT h.r, h.label, h.place, any_value(q.n) AS n FROM held h JOIN template q ON h.k = q.first
  LEFT JOIN held o ON o.r = h.r AND o.t = h.t AND o.k <> h.k AND abs(o.origin - h.origin) <= {SLACK}
  GROUP BY h.r, h.label, h.place, h.t, q.n_phrases HAVING count(DISTINCT o.k) = q.n_phrases - 1
), digest AS (
  SELECT r, count(*) FILTER (WHERE label IN ({labels})) AS n_base, min(place) FILTER (WHERE label IN ({labels})) AS first_word,
    max(place) FILTER (WHERE label IN ({labels})) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE label IN ({labels})) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(n / (n + 2.0::DOUBLE)) AS score
  FROM found GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, coalesce(score, 0.0::DOUBLE) AS score
FROM d LEFT JOIN digest USING (r)
"""
