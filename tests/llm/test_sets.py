"""Similarity join, license scan, line rules and mixing against brute force."""

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomgraph.llm import jaccard, licenses, line_rules, mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = {i: i + 32 for i in range(65, 91)}


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, k):
    w = words_of((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(rows, k, percent):
    sets = [shingles(t, k) for _, t in rows]
    label = list(range(len(rows)))
    changed = True
    links = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            m = min(label[a], label[b])
            changed |= label[a] != m or label[b] != m
            label[a] = label[b] = m
    least = {}
    for (i, _), x in zip(rows, label, strict=True):
        least[x] = min(least.get(x, i), i)
    return sorted((i, len(s), least[x]) for (i, _), s, x in zip(rows, sets, label, strict=True))


def near_copies(seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = [(900, None), (901, ""), (902, " \n"), (903, "one two"), (904, "ONE two"), (905, "é É"), (906, "solo")]
    for g in range(6):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([8, 12, 60, 150, 400]))]
        for _ in range(25):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 9])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            if rng.random() < 0.2:
                copy = copy[: len(copy) - rng.randrange(4)]
            rows.append((len(rows) + 1000 * g, " ".join(copy)))
    rows += [(rows[-1][0], rows[-1][1]), (5000, "long " * 20000)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80)])
def test_components(spark, k, percent):
    rows = near_copies(k)
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, node string, band string").repartition(3)
    found = jaccard.similar_components(docs, jaccard.Measure(k, percent))
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, k, percent)


def test_components_by_blocks_alone(spark, monkeypatch):
    """Without the likeliest candidates, and with blocks of three sets."""
    monkeypatch.setattr(jaccard, "LIKELY", 0)
    monkeypatch.setattr(jaccard, "BLOCK", 3)
    rows = near_copies(7)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = jaccard.similar_components(docs, jaccard.Measure(5, 80))
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, 5, 80)


def test_one_of_each_group_stays(spark):
    rows = [(1, "a b c d e f g"), (2, "A b c d e f g"), (2, "A b c d e f g"), (3, ""), (4, None), (5, "other words here stand alone"), (None, "a b c d e f g")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA)
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.collect() if r.doc_id) == [(False, 1), (False, 3), (False, 4), (False, 5)]
    assert jaccard.similar_components(docs.limit(0)).count() == 0


def test_texts_that_share_a_doc_id_stay_apart(spark):
    first, second, third = ("a b c d e f g h i j k", "l m n o p q r s t u v", "other words here stand quite alone")
    rows = [(1, first), (1, second), (1, second), (2, first.upper()), (2, third), (3, third), (1, first.title()), (4, ""), (4, ""), (None, first)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA)
    kept = collections.Counter((r.doc_id, (r.text or "").lower()) for r in jaccard.keep_one(docs).collect())
    assert kept == {(1, first): 1, (1, second): 1, (2, third): 1, (4, ""): 2, (None, first): 1}


def test_band_plan_covers_every_pair():
    for measure in (jaccard.Measure(3, 90), jaccard.Measure(5, 80)):
        starts, counts, spares = jaccard._bands(measure)
        band = lambda x: int((starts <= x).sum()) - 1
        for a in (1, 2, 9, 10, 57, 300, 5000):
            for b in range(a, a * 100 // measure.percent + 1):
                own = band(b)  # the larger set's band, where the smaller one takes part as well
                assert band(a) <= own <= band(a * 100 // measure.percent)
                apart = measure.apart(a + b)
                assert apart == 0 or counts[own] - apart > spares[own]


def test_linked_sets_share_a_key():
    rng = np.random.default_rng(5)
    for percent in (80, 90):
        measure = jaccard.Measure(5, percent)
        for n in (5, 9, 12, 40, 300, 2000):
            for _ in range(20):
                base = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)
                gone = rng.integers(0, max(1, measure.apart(2 * n)) + 1)
                other = np.concatenate((base[gone // 2 :], rng.integers(0, 1 << 63, gone - gone // 2, dtype=np.uint64)))
                sets = [np.unique(base), np.unique(other)]
                common = len(np.intersect1d(*sets))
                if 100 * common >= percent * (len(sets[0]) + len(sets[1]) - common) and common < max(map(len, sets)):
                    keys = [set(), set()]
                    with np.errstate(over="ignore"):
                        for key, of in jaccard._piece_keys(sets, measure):
                            for k, i in zip(key.tolist(), of.tolist(), strict=True):
                                keys[i].add(k)
                    assert keys[0] & keys[1]


def test_licenses(spark):
    rows = [
        (1, "Released under the MIT License.\nx"), (2, "This work is licensed under the GNU General Public License, version 3."), (3, "All Rights Reserved. all rights reserved"), (4, "Licensed under CC BY-NC 4.0."),
        (5, "public license general"), (6, None), (7, ""), (8, "the " * 5000 + "cc by"), (9, "KK cc İby cc by"), (9, "KK cc İby cc by"), (10, "licensed under the apache license version 2"), (11, "licensed under the apache license"),
    ]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, label string")
    found = sorted(licenses.license_report(docs).collect(), key=lambda r: (r.doc_id, r.n_words))
    for r in found:
        text = dict(rows)[r.doc_id]
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        hits = [(i, label) for phrase, label in licenses.PHRASES.items() for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
        assert (r.n_words, r.n_base) == (len(w), len(hits))
        assert (r.first_word, r.last_word) == ((min(hits)[0], max(hits)[0]) if hits else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in hits})) and set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
    by = {r.doc_id: r for r in found}
    assert by[1].labels == "mit" and by[2].labels == "gpl" and by[4].labels == "cc-by,cc-by-nc" and by[10].labels == "apache-2.0" and by[5].labels == by[11].labels == ""
    assert len(found) == len(rows) and licenses.license_report(docs.limit(0)).count() == 0


def test_licenses_over_lines_and_by_name(spark):
    bsd = "# Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that"
    gpl = "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License"
    filler = " ".join(f"w{i}" for i in range(300))
    rows = [
        (1, bsd, "bsd", 1.0), (2, f"{filler}\n{bsd}\n{filler}", "bsd", 1.0), (3, "Licensed under the\n\nApache License,\nVersion 2.0", "apache-2.0", 1.0), (4, gpl, "gpl", 1.0),
        (5, "Released under the Apache License.", "", 0.0), (6, "Licensed under the Eclipse Public License, Version 2.0", "", 0.0), (7, "Licensed under the Apache License, Version 1.0", "", 0.0),
        (8, f" {filler} ".join("released under the mit license".split()), "", 0.0), (9, "free software you can redistribute it under the terms of the Eclipse Public License", "", 0.0), (10, "released under MIT license", "mit", 0.8), (11, f"mit {filler} released under the mit license", "mit", 1.0),
    ]
    docs = spark.createDataFrame([(i, t) for i, t, *_ in rows], "doc_id long, text string")
    found = sorted((r.doc_id, r.labels, round(r.score, 2)) for r in licenses.license_report(docs).collect())
    assert found == [(i, label, score) for i, _, label, score in rows]


def test_licenses_of_sentences(spark):
    """Labels as a reader would give them: written from the sentences, not from the templates."""
    cc = "This work is licensed under a Creative Commons "
    rows = [
        (cc + "Attribution 4.0 International License", "cc-by"), (cc + "Attribution-ShareAlike 4.0 International License.", "cc-by-sa"), (cc + "Attribution-NonCommercial 4.0 International License", "cc-by-nc"),
        (cc + "Attribution-NonCommercial-NoDerivatives\n4.0 International License", "cc-by-nc-nd"), (cc + "Attribution Non-Commercial Share Alike 4.0 International License", "cc-by-nc-sa"), (cc + "Attribution-NoDerivs 4.0 International License", "cc-by-nd"),
        ("She released the album under the MIT studio banner in spring.", ""), ("the rights were released under MIT, the institute said", ""), ("Released under the MIT license.", "mit"),
        ("# SPDX-License-Identifier: MIT", "mit"), ("// SPDX-License-Identifier: Apache-2.0", "apache-2.0"), ("SPDX-License-Identifier: GPL-3.0-or-later", "gpl"), ("SPDX-License-Identifier: BSD-3-Clause", "bsd"), ("the license identifier of the MIT", ""),
    ]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    found = {r.doc_id: r.labels for r in licenses.license_report(docs).collect()}
    assert [(t, found[i]) for i, (t, _) in enumerate(rows)] == rows


def brute_labels(text):
    """Labels and share of every run of words against every template."""
    gap = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
    one = lambda t: re.sub(rf"(attribution(?:nc)?){gap}+no{gap}*deriv(?:ative)?s", r"\1nd", re.sub(rf"(attribution(?:nc)?){gap}+share{gap}*alike", r"\1sa", re.sub(rf"attribution{gap}+non{gap}*commercial", "attributionnc", t)))
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", one((text or "").translate(LOWER)))
    labels, best = set(), 0.0
    for label, template in licenses.TEMPLATES:
        own, span = set(re.findall("[a-z0-9]+", one(template))), 2 * len(re.findall("[a-z0-9]+", one(template)))
        names = own & licenses.NAMES
        names |= {"license"} & own if names and len(own) < licenses.SHORT else set()
        least = len(own) if not names and len(own) < licenses.SHORT else -(-len(own) * 8 // 10)
        for i in range(max(1, len(words) - span + 1)):
            common = own & set(words[i : i + span])
            if len(common) >= least and names <= common:
                labels.add(label)
                best = max(best, len(common) / len(own))
    return labels, best


def test_licenses_against_brute_force(spark):
    rng = random.Random(8)
    filler = [f"w{i}" for i in range(50)]
    rows = [
        (1, "She was released under a new contract; the band kept the license plate."), (2, "Licensed under CC BY 4.0."), (3, "the rights all were reserved, under no license"),
        (4, "Permission is hereby granted, free of charge, to any person obtaining\na copy of this software and associated documentation files"), (5, None), (6, ""), (7, "mit"),
    ]
    for _, template in licenses.TEMPLATES:
        for _ in range(6):
            words = template.split()
            for _ in range(rng.randrange(len(words) // 3 + 2)):
                rng.choice([lambda: words.pop(rng.randrange(len(words))), lambda: words.insert(rng.randrange(len(words)), rng.choice(filler)), lambda: words.__setitem__(rng.randrange(len(words)), rng.choice(filler))])()
            gap = rng.choice([" ", "\n", ", "])
            rows.append((len(rows) + 1, " ".join(rng.choices(filler, k=rng.randrange(80))) + gap + gap.join(words) + gap + " ".join(rng.choices(filler, k=rng.randrange(80)))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in licenses.license_report(docs).collect()}
    for i, text in rows:
        labels, best = brute_labels(text)
        base = set(found[i].base_labels.split(",")) - {""}
        assert set(found[i].labels.split(",")) - {""} == labels | base, text
        assert base or abs(found[i].score - best) < 1e-12
    assert found[1].labels == "" and found[2].labels == "cc-by" and found[3].labels == "" and found[4].labels == "mit"


def test_line_rules(spark):
    rng = random.Random(4)
    body = lambda: " ".join(f"u{rng.randrange(10**6)}" for _ in range(60))
    menu = "Home 12 About  Contact"
    rows = [(i, f"{body()}\n{menu}\nhome 77 about contact", "h") for i in range(12)] + [(20, f"{menu}\n" * 20, "h"), (21, f"{menu}\n" * 20, "other"), (22, None, None), (23, "", "h"), (24, "a b c a b c x " * 20, "h"), (25, "#$% a\n\nb\nb", "h")]
    docs = spark.createDataFrame([(i, t, "en", s, 1) for i, t, s in rows], SCHEMA)
    found = {r.doc_id: r for r in line_rules.quality(docs, least_docs=5, share=0.0).collect()}
    for i, text, _ in rows:
        w, lines, r = words_of(text), [x for x in (text or "").split("\n") if words_of(x)], found[i]
        windows = collections.Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        covered = {k + j for k in range(len(w) - 2) if windows[tuple(w[k : k + 3])] > 1 for j in range(3)}
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(w), sum(map(len, w)), len(covered))
        assert (r.n_symbols, r.n_dup_lines) == (sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)))
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
    assert all(found[i].kept and found[i].removed_words == 8 for i in range(12))
    assert not found[20].kept and found[21].removed_words == 0 and not found[22].kept
    cleaned = {r.doc_id: r.text for r in line_rules.without_frequent_lines(docs, least_docs=5, share=0.0).collect()}
    assert cleaned[0] == rows[0][1].split("\n")[0] and cleaned[21] == rows[13][1] and cleaned[22] is None
    assert line_rules.quality(docs.limit(0)).count() == 0


def test_line_limits(spark):
    """Lines in as many documents as the limit stay, lines in one more go; repeated rows are one document."""
    rng = random.Random(6)
    body = lambda n=60: " ".join(f"u{rng.randrange(10**6)}" for _ in range(n))
    rows = []
    for i in range(100):  # of 100 documents, a share of 0.1 allows 10
        lines = [body()] + [line for line, n in (("at the limit", 10), ("above the LIMIT", 11), ("below it", 9)) if i < n]
        rows.append((i, "\n".join(lines), "en", "h", 1))
    rows += [(200 + i, "\n".join(["few here"] + [body()]), "en", "small", 1) for i in range(5)]  # least_docs 5: stays
    rows += [(300 + i, "\n".join(["many here"] + [body()]), "en", "small2", 1) for i in range(6)]  # goes
    rows += [rows[0], rows[0]] + [(400, f"{body(20)}\n" + "above  the\tlimit\n" * 15, "en", "h", 1), (401, "", "en", "h", 1), (None, None, "en", "h", 1)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("line", F.lit(1)).withColumn("id_", F.lit(2))
    found = collections.defaultdict(list)
    for r in line_rules.quality(docs, least_docs=5, share=0.1).collect():
        found[r.doc_id].append(r)
    assert sum(map(len, found.values())) == len(rows)
    assert {r.removed_words for i in range(11) for r in found[i]} == {3} and len(found[0]) == 3
    assert all(r.removed_words == 0 for i in range(11, 100) for r in found[i])
    assert all(found[200 + i][0].removed_words == 0 for i in range(5)) and all(found[300 + i][0].removed_words == 2 for i in range(6))
    assert found[400][0].removed_words == 45 and not found[400][0].kept and found[1][0].kept and not found[None][0].kept
    cleaned = {r.doc_id: r.text for r in line_rules.without_frequent_lines(docs, least_docs=5, share=0.1).collect()}
    assert cleaned[0].split("\n")[1:] == ["at the limit", "below it"] and cleaned[None] is None and cleaned[401] == ""
    assert line_rules.without_frequent_lines(docs).columns == docs.columns
    long = docs.limit(1).withColumn("text", F.lit("word " * 300000 + "\nlast line"))
    assert line_rules.quality(long).first()["n_words"] == 300002


def test_targets(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 500), ("d", 5), (None, 300)], "source string, size long")
    found = {r.source: (r.source_size, r.target) for r in mixing.targets(sizes).collect()}
    weights = dict(zip(["a", "b", "c", "d", None], [5, 2, 1, 5, 2], strict=True))
    total, capped = sum(s for s, _ in found.values()), set()
    while True:  # by hand: share, cap, share the excess again
        left = total - sum(3 * found[s][0] for s in capped)
        free = [s for s in weights if s not in capped]
        share = {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * found[s][0]}
        if not over:
            break
        capped |= over
    for s, (size, target) in found.items():
        assert target == pytest.approx(3 * size if s in capped else share[s])


def test_mix(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(["w"] * rng.choice([0, 5, 30, 80])), rng.choice(["a", "b", "b", "b", "c", None])) for i in range(3000)] + [(9000, None, "a"), (9001, "x y", "a"), (9001, "x y", "a")]
    docs = spark.createDataFrame([(i, t, "en", s, 1) for i, t, s in rows], SCHEMA)
    found = mixing.mix(docs).collect()
    assert len(found) == len(rows)
    sums = collections.defaultdict(lambda: [0, 0.0, 0])
    for r in found:
        assert r.taken <= 3 * r.size and r.taken == r.copies * r.size
        own = sums[r.source]
        own[0], own[1], own[2] = r.source_size, r.target, own[2] + r.taken
    for size, target, taken in sums.values():
        assert 0 <= target - taken < 5 and target <= 3 * size + 1e-6  # 2 and 5 are the fewest words of a document
    again = sorted(tuple(r) for r in mixing.mix(docs.repartition(7)).select("doc_id", "taken").collect())
    assert again == sorted((r.doc_id, r.taken) for r in found)
    many = mixing.mixed_documents(docs.withColumn("copies", F.lit(1)))
    assert many.columns == [*docs.columns, "copies"] and sum(len(words_of(r.text)) for r in many.collect()) == sum(r.taken for r in found)
    assert mixing.mix(docs.limit(0)).count() == 0


def test_inclusion_follows_the_weights(spark):
    """Over many seeds a document is taken about as often as min(1, c * size / (size + half)) says."""
    rng = random.Random(3)
    sizes = [rng.choice([3, 10, 40, 200, 900]) for _ in range(300)]
    rows = [(i, " ".join(["w"] * n), "en", "ab"[i % 2], 1) for i, n in enumerate(sizes)]
    docs = spark.createDataFrame([*rows, (None, "one two three", "en", "a", 1)], SCHEMA)
    taken, rounds = collections.Counter(), 6
    for seed in range(rounds):
        for r in mixing.mix(docs, seed=seed).collect():
            if r.source == "b":
                taken[r.size] += r.copies
    own = [n for i, n in enumerate(sizes) if i % 2]
    total, all_words = sum(own), sum(sizes) + 3
    due = 2 / 7 * all_words
    whole = int(due / total)
    due -= whole * total
    low, high = 0.0, 100.0
    for _ in range(60):
        c = (low + high) / 2
        low, high = (c, high) if sum(min(1, c * n / (n + 50)) * n for n in own) < due else (low, c)
    for n in set(own):
        share = taken[n] / rounds / own.count(n) - whole
        assert abs(share - min(1, c * n / (n + 50))) < 0.15, n


def test_repeated_rows_share_their_copies(spark):
    rows = [(1, "a b c", "en", "x", 1)] * 5 + [(2, "d e f", "en", "x", 1), (3, "g " * 50, "en", "y", 1)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("copies_", F.lit("k"))
    want = collections.Counter()
    for r in mixing.mix(docs).collect():
        want[r.doc_id] += r.copies
    many = mixing.mixed_documents(docs)
    got = collections.Counter(r.doc_id for r in many.collect())
    assert many.columns == docs.columns and +got == +want and mixing.mixed_documents(docs.limit(0)).count() == 0


def test_mixed_rows_that_differ_in_another_column(spark):
    """Which of the rows with one doc_id and text takes what is left over depends on the rows alone, not on their place."""
    rows = [(i % 3, "one two three", "en", "ab"[i % 2], i) for i in range(30)] + [(50 + i, f"x y{i}", "en", "a", 1) for i in range(20)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("more.of", F.create_map(F.lit("k"), F.lit(1)))
    taken = lambda df: sorted((r.doc_id, r.source, r.n_chars) for r in mixing.mixed_documents(df).collect())
    first = taken(docs)
    assert taken(docs.repartition(7)) == first and taken(docs.orderBy(F.desc("n_chars")).coalesce(1)) == first
    share = collections.Counter(first)
    assert all(max(n) - min(n) <= 1 for n in ([share[(i, "ab"[k % 2], k)] for k in range(30) if k % 3 == i] for i in range(3)))
