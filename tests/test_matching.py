"""References to files by names that hold each other."""

import random

from pyspark.sql import functions as F

from loomgraph.operators import matching, postings


def test_short_names_of_references(spark):
    names = [(1, "scan_a.tif"), (2, "b.csv"), (3, "A.TIF"), (4, "long_name_of_a_file.lis"), (5, "x"), (6, "b.csv"), (7, "other long name.dat"), (8, None)]
    refs = ["a.tif", "can_a.t", "see b.csv there", "B.cs", "lis", "xy", "q", "long_name_of_a_file", "long", "12345678", "b.csv?"]
    files = spark.createDataFrame(names, "record_id long, name string")
    for asked in (refs, [*refs, ""], [""]):
        found, missing = matching.resolve_file_refs(spark.createDataFrame([(r,) for r in asked], "ref string"), files)
        want = {}
        for r in asked:
            fits = [(n.lower() != r.lower(), -len(n), i) for i, n in names if n is not None and (r.lower() in n.lower() or n.lower() in r.lower())]
            want[r] = min(fits)[2] if fits else None
        assert {r.ref: r.record_id for r in found.collect()} == {r: i for r, i in want.items() if i is not None}
        assert sorted(r.ref for r in missing.collect()) == sorted(r for r, i in want.items() if i is None)
    empty = spark.createDataFrame([(1, ""), (2, "ab")], "record_id long, name string")
    found, _ = matching.resolve_file_refs(spark.createDataFrame([("zzz",), ("a long reference",), ("xab",)], "ref string"), empty)
    assert {r.ref: r.record_id for r in found.collect()} == {"zzz": 1, "a long reference": 1, "xab": 2}


def holds(refs, names):
    want = {}
    for r in set(refs):
        fits = [(n.lower() != r.lower(), -len(n), i) for i, n in names if n is not None and (r.lower() in n.lower() or n.lower() in r.lower())]
        want[r] = min(fits)[2] if fits else None
    return want


def test_containment_equals_all_pairs(spark):
    """Few letters, so that tiles repeat and overlap; characters of one to four bytes; repeated names and nulls."""
    rng = random.Random(4)
    word = lambda n: "".join(rng.choices("abÄ🙂", weights=(5, 5, 1, 1), k=n))
    names = [(i, word(rng.randrange(40))) for i in range(120)] + [(200, None), (201, "ab" * 200), (202, "ab" * 200)]
    refs = [n[a : a + rng.randrange(1, 30)] for _, n in names if n for a in (rng.randrange(len(n)),)] + [word(5) + n + word(3) for _, n in names[:30]] + [word(12) for _ in range(30)] + ["ab" * 30]
    found, missing = matching.resolve_file_refs(spark.createDataFrame([(r,) for r in [*refs, None]], "ref string"), spark.createDataFrame(names, "record_id long, name string"))
    want = holds(refs, names)
    assert {r.ref: r.record_id for r in found.collect()} == {r: i for r, i in want.items() if i is not None}
    assert sorted(r.ref for r in missing.collect()) == sorted(r for r, i in want.items() if i is None)


def test_runs_of_a_long_text_are_linear(spark):
    """A name of 100,000 words: every place once, and postings that carry no text."""
    words = [f"w{i % 977}ü" for i in range(100_000)]
    text = " ".join(words)
    texts = spark.createDataFrame([(1, text), (2, "short"), (3, "")], "id long, text string")
    runs = postings.grams(texts, 8)
    assert runs.columns == ["id", "place", "g"]
    assert runs.agg(F.count("*"), F.countDistinct("place"), F.max(F.length("g"))).first() == (len(text) - 7, len(text) - 7, 8)
    some = {r.place: r.g for r in runs.where("place % 99991 < 3").collect()}
    assert some and all(text[p : p + 8] == g for p, g in some.items())
    files = spark.createDataFrame([(1, text), (2, "another name")], "record_id long, name string")
    refs = [" ".join(words[50_000:50_040]), text + "!", words[3] + "  " + words[4], text[-60:]]
    found, missing = matching.resolve_file_refs(spark.createDataFrame([(r,) for r in refs], "ref string"), files)
    assert {r.ref for r in found.collect()} == {refs[0], refs[1], refs[3]} and [r.ref for r in missing.collect()] == [refs[2]]


def test_affiliations_of_a_large_record(spark):
    """3,000 authors and export rows of one record: no product of both, and the same as comparing them one by one elsewhere."""
    creators = [(1, i, f"Author {i:05d}", None) for i in range(3000)] + [(2, 0, " LI ", None), (2, 1, "", "0000-0001-0000-0001"), (2, 2, None, None), (2, 3, "Li, Wei", None), (None, 4, "x", None)]
    exports = [(1, i, f"Dr. Author {i:05d} of somewhere", None, 0, 0, "ror", f"r{i}") for i in range(3000)]
    exports += [(2, 0, "Kelim", None, 0, 0, "grid", "g"), (2, 1, "Kelim", None, 1, 0, "ror", "b"), (2, 1, "Kelim", None, 0, 1, "ror", "a"), (2, 2, "Someone", "https://orcid.org/0000-0001-0000-0001", 0, 0, "ror", "c"), (2, 3, "li, wei", None, 0, 0, "ror", "d"), (None, 0, "x", None, 0, 0, "ror", "n")]
    c = spark.createDataFrame(creators, "recid long, pos long, name string, orcid string")
    e = spark.createDataFrame(exports, "recid long, exp_pos long, name string, orcid string, aff_pos int, id_pos int, scheme string, identifier string")
    found = {(r.recid, r.pos): r.ror.rpartition("/")[2] for r in matching.ror_from_export(c, e).collect()}
    assert found == {(1, i): f"r{i}" for i in range(3000)} | {(2, 0): "a", (2, 1): "c", (2, 3): "d"}


def test_history_of_one_busy_researcher(spark):
    """One ORCID with 100,000 creators and 1,000 stays; years that are null, at the edges, and stays without ends."""
    orcid = "0000-0001-0000-0001"
    stays = [(orcid, i, f"institute {i % 40}", f"h{i}", None if i % 11 == 0 else str(1950 + i % 60), None if i % 7 == 0 else str(1950 + i % 60 + i % 5)) for i in range(1000)] + [(None, 1, "institute 1", "n", None, None), (orcid, 1, "institute 1", "", None, None)]
    creators = spark.range(100_000).select(F.col("id").alias("key"), F.lit(orcid).alias("orcid"), F.concat(F.lit("Institute "), F.col("id") % 45, F.when(F.col("id") % 3 == 0, ", Berlin").otherwise("")).alias("affiliation"), F.when(F.col("id") % 13 > 0, 1940 + F.col("id") % 80).alias("year"))
    found = {r.key: r.ror for r in matching.ror_from_history(creators, spark.createDataFrame(stays, "orcid string, seq long, organization string, organization_id string, start_date string, end_date string")).collect()}
    known = {}

    def answer(key):
        own, year = f"institute {key % 45}" + (", berlin" if key % 3 == 0 else ""), 1940 + key % 80 if key % 13 else None
        if (own, year) not in known:
            fits = [s[1] for s in stays[:1000] if (s[2] in own or own in s[2]) and (year is None or ((s[4] is None or int(s[4]) <= year + 1) and (s[5] is None or int(s[5]) >= year - 1)))]
            known[own, year] = f"https://ror.org/h{min(fits)}" if fits else None
        return known[own, year]

    assert found == {k: answer(k) for k in range(100_000) if answer(k)}
