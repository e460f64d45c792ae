"""License scans: an exact set-similarity join of runs of words with templates, with DataFrame functions alone.

A text matches a template when a run of its words, twice as long as the template and wherever its lines break, holds at
least ``containment`` of the template's distinct words: alpha = ceil(containment * size) of them. The words that name
the license (NAMES) have to be among them, in a template of fewer than SHORT words "license" as well where it has that;
such a template without a name has to be held whole. "Attribution" and the restrictions after it (NonCommercial, ShareAlike,
NoDerivatives) count as one word, so a restricted license isn't taken for the free one.
A run ends where the text does; a text of fewer words is one run. Template words are ordered by the number of texts that
hold them, rarest first. Then

- prefix filter: a matching run holds one of the template's first size - alpha + 1 words, so only the places of these
  are looked at;
- length filter: with as many words on either side as a run may reach, and no more;
- positional filter: with the word at place r of the order, at most size - r words of the template can be held besides
  the rarer ones that stand around it;
- these words together hold alpha words of the template, and the names.

Each run of a candidate is then counted exactly, so nothing that matches is missed and nothing else is found. The
templates are a parameter, and what they need (their words and counts) is all that reaches the driver or is broadcast.

Besides the templates, phrases are searched: places where their words stand one after another, over the whole text.
Null texts are empty: no words, no labels (empty strings), score 0. Repeated rows get the same result each. Long texts
are read whole. An empty table gives an empty one.
"""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.common import materialize

#: Words that are searched one after another, and their labels (fixed values).
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Label and text of the templates: notices and sentences of well-known licenses (fixed values).
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2.0"),
    ("apache-2.0", "licensed under the apache license version 2.0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "free software you can redistribute it under the terms of the gnu general public license"),
    ("lgpl", "you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("cc-by-nc", "licensed under cc by nc 4.0"),
    ("cc-by", "this work is licensed under a creative commons attribution license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4.0 international license"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4.0 international license"),
    ("cc-by-nd", "this work is licensed under a creative commons attribution noderivatives 4.0 international license"),
    ("cc-by-nc-sa", "this work is licensed under a creative commons attribution noncommercial sharealike 4.0 international license"),
    ("cc-by-nc-nd", "this work is licensed under a creative commons attribution noncommercial noderivatives 4.0 international license"),
    ("mit", "spdx license identifier mit"),
    ("apache-2.0", "spdx license identifier apache 2.0"),
    ("gpl", "spdx license identifier gpl"),
    ("bsd", "spdx license identifier bsd"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)
CONTAINMENT = 0.8
#: Words of templates without which it is another license; distinct words of a template that is short.
NAMES, SHORT = frozenset(("apache", "2", "mit", "gnu", "lesser", "cc", "nc", "creative", "commons", "attribution", "attributionsa", "attributionnc", "attributionnd", "attributionncsa", "attributionncnd", "mozilla", "unencumbered", "gpl", "bsd")), 10
#: Not a word, after lower-casing.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Restrictions after "attribution", in the order of their names, and what they add to that word.
RESTRICTIONS = tuple((f"(attribution(?:nc)?){GAP}{words}", short) for words, short in ((f"non(?:{GAP})?commercial", "nc"), (f"share(?:{GAP})?alike", "sa"), (f"no(?:{GAP})?deriv(?:ative)?s", "nd")))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value evaluated once a row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def lowered(text: Column) -> Column:
    """Text with A-Z lower-cased, as far as words of ASCII letters and counts of words can tell.

    Spark's lower() changes other letters to other letters, but two of them to ASCII ones: these are replaced before.
    """
    plain = F.coalesce(text, F.lit(""))
    for other in ("İ", "K"):
        plain = F.replace(plain, F.lit(other), F.lit("å"))
    return F.lower(plain)


def joined(text: Column) -> Column:
    """Lower-cased text whose "attribution" and restrictions are one word."""
    out = text
    for pattern, short in RESTRICTIONS:
        out = F.regexp_replace(out, pattern, f"$1{short}")
    return F.when(F.contains(text, F.lit("attribution")), out).otherwise(text)


def template_run(text: str) -> list[str]:
    """Words of a template as they stand, "attribution" and restrictions as one."""
    for pattern, short in RESTRICTIONS:
        text = re.sub(pattern, rf"\g<1>{short}", text)
    return re.findall(r"[a-z0-9]+", text)


def template_words(text: str) -> list[str]:
    return sorted(set(template_run(text)))


def names_of(words: list[str]) -> list[str]:
    """Words of a template that a run can't do without."""
    named = [w for w in words if w in NAMES]
    return [w for w in words if w in NAMES or w == "license"] if named and len(words) < SHORT else named


def alpha_of(words: list[str], containment: float) -> int:
    """Words of a template that a run has to hold."""
    named = any(w in NAMES for w in words)
    return len(words) if not named and len(words) < SHORT else math.ceil(containment * len(words) - 1e-9)


def scan(docs: DataFrame, *, templates: tuple[tuple[str, str], ...] = TEMPLATES, containment: float = CONTAINMENT) -> DataFrame:
    """(doc_id, text_hash, template, label, share): every template that a text matches, with its largest share."""
    sets = [(i, label, template_words(text)) for i, (label, text) in enumerate(templates)]
    vocabulary = sorted({w for _, _, words in sets for w in words})
    spans = [2 * len(template_run(text)) for _, text in templates]
    names = [names_of(words) for _, _, words in sets]
    alphas = [alpha_of(words, containment) for _, _, words in sets]
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.split(joined(lowered(F.col("text"))), GAP).alias("words"))
    held = keyed.select(F.array_intersect(F.array(*map(F.lit, vocabulary)), "words").alias("held")).where(F.size("held") >= min(alphas))
    counts = {r["word"]: r["count"] for r in held.select(F.explode("held").alias("word")).groupBy("word").count().collect()}  # a row for a template word at most
    index, prefix = [], set()
    for i, label, own in sets:
        own = sorted(own, key=lambda w: (counts.get(w, 0), w))
        for r, word in enumerate(own[: len(own) - alphas[i] + 1]):
            prefix.add(word)
            index.append((word, i, label, r, own, own[:r], names[i], len(own), alphas[i], spans[i]))
    table = docs.sparkSession.createDataFrame(index, "word string, template int, label string, r int, own array<string>, rarer array<string>, names array<string>, size int, alpha int, span int")

    # each place of a prefix word, with the words around it: far enough for the longest template
    rare, far = F.array(*map(F.lit, sorted(prefix))), max(spans) - 1
    near = keyed.where(F.arrays_overlap("words", rare))
    around = lambda i: F.slice("words", F.greatest(i - far, F.lit(0)) + 1, F.least(i, F.lit(far)) + far + 1)
    places = F.filter(F.transform("words", lambda w, i: F.struct(w.alias("word"), i.alias("at"))), lambda x: F.array_contains(rare, x["word"]))
    anchors = near.select("doc_id", "text_hash", F.explode(F.transform(places, lambda x: F.struct(x["word"].alias("word"), F.least(x["at"], F.lit(far)).alias("at"), around(x["at"]).alias("around")))).alias("x"))
    met = anchors.select("doc_id", "text_hash", "x.word", "x.at", "x.around").join(F.broadcast(table), "word")  # of the templates' size
    first = F.greatest(F.col("at") - F.col("span") + 1, F.lit(0))
    met = met.withColumn("around", F.slice("around", first + 1, F.col("at") - first + F.col("span")))
    met = met.where(F.size(F.array_intersect("rarer", "around")) + F.col("size") - F.col("r") >= F.col("alpha"))
    met = met.where(F.size(F.array_intersect("own", "around")) >= F.col("alpha")).where(F.size(F.array_intersect("names", "around")) == F.size("names"))

    def share(i: Column) -> Column:
        """Words of the template in the run that starts at i, or 0 where a name is missing."""
        run = F.slice("around", i, F.col("span"))
        return F.when(F.size(F.array_intersect("names", run)) == F.size("names"), F.size(F.array_intersect("own", run))).otherwise(0)

    starts = F.sequence(F.lit(1), F.greatest(F.size("around") - F.col("span") + 1, F.lit(1)))
    counted = met.withColumn("common", F.array_max(F.transform(starts, share))).where("common >= alpha")
    return counted.groupBy("doc_id", "text_hash", "template", "label").agg(F.max(F.col("common") / F.col("size")).alias("share"))


def phrases(docs: DataFrame, found: dict[str, str] = PHRASES) -> DataFrame:
    """doc_id, text_hash, n_words, n_base, first_word, last_word and base_array (sorted labels) of each row."""
    flat = F.regexp_replace(lowered(F.col("text")), GAP, " ")
    spaced = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.trim(flat).alias("flat"))
    count = F.when(F.col("flat") == "", 0).otherwise(F.length("flat") - F.length(F.replace("flat", F.lit(" "), F.lit(""))) + 1)
    around = F.concat(F.lit(" "), F.col("flat"), F.lit(" "))
    any_phrase = functools.reduce(lambda x, y: x | y, [F.contains(around, F.lit(f" {phrase} ")) for phrase in found])

    def stands(words: Column, parts: list[str]) -> Callable[[Column], Column]:
        def test(i: Column) -> Column:
            same = [F.coalesce(F.get(words, i + k) == part, F.lit(False)) for k, part in enumerate(parts)]
            return functools.reduce(lambda x, y: x & y, same)

        return test

    def named(label: str) -> Callable[[Column], Column]:
        return lambda i: F.struct(i.cast("long").alias("place"), F.lit(label).alias("label"))

    def places(words: Column) -> Column:
        every = F.sequence(F.lit(0), F.size(words) - 1)
        return F.concat(*[F.transform(F.filter(every, stands(words, phrase.split(" "))), named(label)) for phrase, label in found.items()])

    none = F.array().cast("array<struct<place: bigint, label: string>>")
    hits = F.when(any_phrase, let(F.split("flat", " "), places)).otherwise(none)
    out = spaced.select("doc_id", "text_hash", count.cast("long").alias("n_words"), hits.alias("hits"))
    return out.select(
        "doc_id", "text_hash", "n_words",
        F.size("hits").cast("long").alias("n_base"),
        F.array_min("hits.place").alias("first_word"),
        F.array_max("hits.place").alias("last_word"),
        F.array_sort(F.array_distinct("hits.label")).alias("base_array"),
    )


def license_report(docs: DataFrame, **options) -> DataFrame:
    """A row for each of docs: doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score.

    score is the largest containment of a template in a run of words, and 1 where a phrase stands.
    """
    base = phrases(docs)
    matched = materialize(scan(docs, **options), "matches").groupBy("doc_id", "text_hash").agg(F.collect_set("label").alias("more"), F.max("share").alias("share"))
    both = base.join(matched.withColumnRenamed("doc_id", "id_").withColumnRenamed("text_hash", "hash_"), F.col("doc_id").eqNullSafe(F.col("id_")) & (F.col("text_hash") == F.col("hash_")), "left")
    none = F.array().cast("array<string>")
    labels = F.array_sort(F.array_union("base_array", F.coalesce("more", none)))
    score = F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0)))
    return both.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_array", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), score.alias("score"))


def report_sql() -> str:
    """license_report for DuckDB: every run of every text that has the words is compared with every template."""
    upper, lower = "".join(map(chr, range(65, 91))), "".join(map(chr, range(97, 123)))
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    rows = []
    for i, (label, text) in enumerate(TEMPLATES):
        own = template_words(text)
        rows.append(f"({i}, '{label}', {own!r}, {names_of(own)!r}::VARCHAR[], {alpha_of(own, CONTAINMENT)}, {2 * len(template_run(text))})")
    one = "t"
    for pattern, short in RESTRICTIONS:
        one = f"regexp_replace({one}, '{pattern}', '\\1{short}', 'g')"
    hits = []
    for phrase, label in PHRASES.items():
        test = " AND ".join(f"ws[i + {k}] = '{p}'" for k, p in enumerate(phrase.split(" ")))
        hits.append(f"list_transform(list_filter(range(1, len(ws) + 1), lambda i: coalesce({test}, false)), lambda i: {{'place': i - 1, 'label': '{label}'}})")
    return f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{upper}', '{lower}') AS t FROM documents),
w AS (SELECT doc_id, regexp_extract_all(t, '{word}') AS ws, regexp_extract_all({one}, '{word}') AS js FROM d),
b AS (SELECT doc_id, len(ws) AS n_words, list_concat({hits[0]}, list_concat({hits[1]}, {hits[2]})) AS hits FROM w),
templates(template, label, words, names, alpha, span) AS (VALUES {", ".join(rows)}),
near AS (SELECT doc_id, ws, t.* FROM (SELECT doc_id, js AS ws, list_distinct(js) AS own FROM w) JOIN templates t ON len(list_intersect(own, words)) >= alpha),
runs AS (SELECT doc_id, label, words, names, alpha, list_distinct(ws[i : i + span - 1]) AS run FROM (SELECT *, unnest(range(1, greatest(len(ws) - span + 1, 1) + 1)) AS i FROM near)),
m AS (SELECT doc_id, label, len(list_intersect(run, words)) / len(words)::DOUBLE AS share FROM runs WHERE len(list_intersect(run, words)) >= alpha AND list_has_all(run, names)),
g AS (SELECT doc_id, list(DISTINCT label) AS more, max(share) AS share FROM m GROUP BY doc_id)
SELECT b.doc_id, n_words::BIGINT AS n_words, len(hits)::BIGINT AS n_base,
  list_min(list_transform(hits, lambda h: h.place))::BIGINT AS first_word, list_max(list_transform(hits, lambda h: h.place))::BIGINT AS last_word,
  coalesce(array_to_string(list_sort(list_distinct(list_transform(hits, lambda h: h.label))), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(list_transform(hits, lambda h: h.label), coalesce(more, []::VARCHAR[])))), ','), '') AS labels,
  CASE WHEN len(hits) > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0::DOUBLE) END AS score
FROM b LEFT JOIN g ON b.doc_id = g.doc_id"""
