"""Matching by keys, by contained names and by intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.functions.columns import normalize_orcid, year_of
from loomgraph.functions.shared import materialize
from loomgraph.operators.postings import contained, grams, holders_of, numbered


def folded(c: Column) -> Column:
    return F.lower(F.trim(c))


def ror_from_export(creators: DataFrame, exports: DataFrame) -> DataFrame:
    """recid, pos and ror of creators (recid, pos, name, orcid) that an export row of the same record names.

    exports: recid, exp_pos, name, orcid, aff_pos, id_pos, scheme, identifier. A creator's name equals an export name or
    stands in it, or both have one ORCID; the first row with an organisation identifier wins. Empty names match nothing.

    Export rows are reduced to the first of each name and of each ORCID of a record. Names meet by postings of their runs
    within the record (``postings.holders_of``), so a record with thousands of authors costs its names' lengths and the
    matches there are.
    """
    own = creators.select("recid", "pos", folded(F.col("name")).alias("text"), normalize_orcid(F.col("orcid")).alias("orcid"))
    row = F.struct("exp_pos", "aff_pos", "id_pos", "identifier")
    known = exports.where("scheme = 'ror' and identifier <> '' and recid is not null").select("recid", row.alias("row"), folded(F.col("name")).alias("text"), normalize_orcid(F.col("orcid")).alias("orcid"))
    by_orcid = known.where("orcid is not null").groupBy("recid", "orcid").agg(F.min("row").alias("of_orcid"))
    held = numbered(own.where("text <> '' and recid is not null").select(F.col("recid").alias("scope"), "text").distinct())
    holders = numbered(known.where("text is not null").groupBy(F.col("recid").alias("scope"), "text").agg(F.min("row").alias("row")))
    met = holders_of(held, holders).join(holders.select(F.col("id").alias("holder"), "row"), "holder").groupBy("held").agg(F.min("row").alias("of_name"))
    by_name = held.join(met, held["id"] == met["held"]).select(F.col("scope").alias("recid"), "text", "of_name")
    found = own.join(by_orcid, ["recid", "orcid"], "left").join(by_name, ["recid", "text"], "left").groupBy("recid", "pos").agg(F.min(F.least("of_orcid", "of_name")).alias("row"))
    return found.where("row is not null").select("recid", "pos", F.concat(F.lit("https://ror.org/"), "row.identifier").alias("ror"))


def ror_from_history(creators: DataFrame, affiliations: DataFrame) -> DataFrame:
    """key and ror of creators (key, orcid, affiliation, year) from researchers' organisations at that time.

    affiliations: orcid, seq, organization, organization_id, start_date, end_date. One name holds the other; the stay
    overlaps the year give or take one, unreadable years don't count; the first organisation with an identifier wins.

    Names of one ORCID are reduced to the distinct ones and meet by postings. Then stays are dealt to the decades that they
    touch, within the years that are asked for, and a distinct (name, year) meets the stays of its decade alone; creators
    get the answer of their name and year. So one ORCID's creators and stays never meet one by one.
    """
    own = creators.select("key", normalize_orcid(F.col("orcid")).alias("scope"), F.lower("affiliation").alias("own"), F.col("year").cast("int").alias("year")).where("scope is not null and own is not null")
    known = affiliations.where("organization <> '' and organization_id <> ''").select(normalize_orcid(F.col("orcid")).alias("scope"), F.struct("seq", "organization_id").alias("stay"), F.lower("organization").alias("org"), (year_of(F.col("start_date")) - 1).alias("lo"), (year_of(F.col("end_date")) + 1).alias("hi")).where("scope is not null")
    names, orgs = numbered(own.select("scope", F.col("own").alias("text")).distinct()), numbered(known.select("scope", F.col("org").alias("text")).distinct())
    one = holders_of(names, orgs).select(F.col("held").alias("name_id"), F.col("holder").alias("org_id"))
    other = holders_of(orgs, names).select(F.col("holder").alias("name_id"), F.col("held").alias("org_id"))
    pairs = one.union(other).distinct()
    asked = own.select("scope", F.col("own").alias("text"), "year").distinct().join(names, ["scope", "text"]).select(F.col("id").alias("name_id"), "year")
    asked = materialize(asked.join(pairs, "name_id"), "asked")  # a name's organisations, not its stays
    stays = known.withColumnRenamed("org", "text").join(orgs, ["scope", "text"]).select(F.col("id").alias("org_id"), "stay", "lo", "hi")
    span = asked.agg(F.min("year").alias("first"), F.max("year").alias("last"))  # one row
    dealt = stays.crossJoin(F.broadcast(span)).withColumns({"from": F.greatest("lo", "first"), "to": F.least("hi", "last")}).where("from <= to")
    decade = lambda c: F.floor(F.col(c) / 10)
    binned = dealt.select("org_id", "stay", "from", "to", F.explode(F.sequence(decade("from"), decade("to"))).alias("decade"))
    dated = asked.where("year is not null").withColumn("decade", decade("year")).join(binned, ["org_id", "decade"]).where("year between from and to")
    undated = asked.where("year is null").join(stays.groupBy("org_id").agg(F.min("stay").alias("stay")), "org_id")
    best = dated.select("name_id", "year", "stay").union(undated.select("name_id", "year", "stay")).groupBy("name_id", "year").agg(F.min("stay").alias("stay"))
    answers = best.join(names.select(F.col("id").alias("name_id"), "scope", F.col("text").alias("own")), "name_id").withColumn("same_year", F.coalesce("year", F.lit(-1))).drop("year")
    met = own.withColumn("same_year", F.coalesce("year", F.lit(-1))).join(answers, ["scope", "own", "same_year"])
    return met.groupBy("key").agg(F.min("stay").alias("stay")).select("key", F.concat(F.lit("https://ror.org/"), "stay.organization_id").alias("ror"))


def first_source(rows: DataFrame, first: DataFrame, second: DataFrame, key: str = "key", value: str = "ror") -> DataFrame:
    """rows with value: the first source's, else the second's, else null. Both have key and value."""
    a, b = (t.select(key, F.col(value).alias(f"{value}_{i}")) for i, t in enumerate((first, second)))
    return rows.join(a, key, "left").join(b, key, "left").withColumn(value, F.coalesce(f"{value}_0", f"{value}_1")).drop(f"{value}_0", f"{value}_1")


def without(rows: DataFrame, done: DataFrame, key: str = "key") -> DataFrame:
    """The rows that a cheap source hasn't answered: what a dear one should see."""
    return rows.join(done.select(key), key, "left_anti")


def resolve_file_refs(refs: DataFrame, files: DataFrame, *, by: str | None = None, min_length: int = 8) -> tuple[DataFrame, DataFrame]:
    """(resolved, unresolved) of refs (ref) against file records (record_id, name): names that are equal, or hold each other.

    by names a column of both, if a ref may only mean files of its own collection; it comes along.
    Equal names are joined first. Only the rest is compared by containment: texts of at least min_length characters by
    the postings of their runs (``postings.contained``), shorter ones as runs of their own length of the other side.
    Names are reduced to the record that wins before they meet, and pairs are ids, so no text is written more often than
    it has characters. Empty texts stand in all, null ones in none. Ties: the longest name, then the smallest record.
    """
    scope = (F.col(by) if by else F.lit("")).alias("scope")
    asked = refs.select(scope, "ref").where("ref is not null").distinct().withColumn("low", F.lower("ref"))
    known = files.select(scope, "record_id", "name").where("name is not null").withColumn("low", F.lower("name"))
    winner = F.min_by(F.struct("size", "record_id"), F.struct((-F.col("size")).alias("l"), "record_id")).alias("best")
    of_name = known.withColumn("size", F.length("name")).groupBy("scope", "low").agg(winner)
    equal = asked.join(of_name, ["scope", "low"]).select("scope", "ref", "best")
    rest = materialize(asked.join(equal.select("scope", "ref"), ["scope", "ref"], "left_anti"), "open")
    names, lows = numbered(of_name.withColumnRenamed("low", "text")), numbered(rest.select("scope", F.col("low").alias("text")).distinct())
    best = names.select("id", "best")

    long = F.length("text") >= min_length
    held_refs = contained(lows.where(long), names.where(long), min_length).select(F.col("held").alias("id"), F.col("holder").alias("name_id"))
    held_names = contained(names.where(long), lows.where(long), min_length).select(F.col("holder").alias("id"), F.col("held").alias("name_id"))
    found = held_refs.unionByName(held_names).join(best.withColumnRenamed("id", "name_id"), "name_id").select("id", "best")

    again = F.min_by("best", F.struct((-F.col("best.size")).alias("l"), "best.record_id")).alias("best")
    sizes = [t.where(~long).select(F.length("text")).distinct().collect() for t in (lows, names)]  # min_length lengths at most
    of_refs, of_names = ([r[0] for r in rows] for rows in sizes)
    short_refs, short_names = (t.where(~long).withColumnRenamed("text", "g") for t in (lows, names))
    if of_refs:
        in_names = grams(names, *of_refs).join(short_refs.select("scope", "g"), ["scope", "g"], "left_semi").select("scope", "id", "g").distinct().join(best, "id").groupBy("scope", "g").agg(again)
        found = found.unionByName(short_refs.join(in_names, ["scope", "g"]).select("id", "best"))
    if of_names:
        found = found.unionByName(grams(lows, *of_names).select("scope", "id", "g").join(short_names.select("scope", "g", "best"), ["scope", "g"]).groupBy("id").agg(again))
    of_low = found.groupBy("id").agg(again).join(lows.withColumnRenamed("text", "low"), "id").select("scope", "low", "best")
    hit = equal.unionByName(rest.join(of_low, ["scope", "low"]).select("scope", "ref", "best"))
    hit = materialize(hit.select("scope", "ref", "best.record_id"), "resolved")
    missing = asked.join(hit, ["scope", "ref"], "left_anti")
    own = [F.col("scope").alias(by)] if by else []
    return hit.select(*own, "ref", "record_id"), missing.select(*own, "ref")


def not_yet_linked(links: DataFrame, attributes: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """links (record_id, value) whose record doesn't point at the value by one of these keys already."""
    return links.join(attributes.where(F.col("key").isin(*keys)).select("record_id", "value"), ["record_id", "value"], "left_anti")


def salted_join(left: DataFrame, right: DataFrame, key: str, *, how: str = "inner", rows: int = 1_000_000) -> DataFrame:
    """left and right by key, a hot key in parts: of a key with more than ``rows`` rows on the left, each part of about that
    many meets a copy of the key's right rows. Null keys meet nothing. how: inner or left."""
    salt, salts = "salt_", "salts_"
    hot = left.groupBy(key).agg(F.ceil(F.count("*") / rows).alias(salts)).where(f"{salts} > 1")
    hot = materialize(hot, "hot-keys")  # few: each stands for so many rows
    parts = F.coalesce(F.col(salts), F.lit(1).cast("long"))
    dealt = left.join(hot, key, "left").withColumn(salt, F.pmod(F.xxhash64(*left.columns), parts)).drop(salts)
    copied = right.join(hot, key, "left").withColumn(salt, F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop(salts)
    return dealt.join(copied, [key, salt], how).drop(salt)


def fill_common(tests: DataFrame, common: DataFrame, columns: tuple[str, ...], key: str = "collection") -> DataFrame:
    """tests whose blank columns take the collection's common value. common: one row for each collection."""
    shared = common.select(key, *[F.col(c).alias(f"common_{c}") for c in columns])
    met = salted_join(tests, shared, key, how="left")
    for c in columns:
        met = met.withColumn(c, F.coalesce(F.nullif(F.col(c), F.lit("")), F.col(f"common_{c}"))).drop(f"common_{c}")
    return met


def resolve_names(attributes: DataFrame, names: DataFrame, *, to: str = "pid") -> DataFrame:
    """attributes with keys as identifiers (to="pid") or as names (to="name"); unknown keys stay. names: name, pid; small, and broadcast."""
    other = "name" if to == "pid" else "pid"
    met = attributes.join(F.broadcast(names.select(F.col(other).alias("key"), F.col(to).alias("new_key"))), "key", "left")
    return met.select("record_id", F.coalesce("new_key", "key").alias("key"), "value", "value_type")
