"""Postings of character runs: where each run of n characters stands in which text, and containment joins by them.

A posting is (run, id, place) and never carries its text, so what is written is linear in the texts' lengths. Texts may belong to a scope, and then meet those of
their own alone. They are first cut into chunks that overlap by n - 1 characters, so a run costs its chunk's length at most, however long the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.functions.shared import materialize

#: Characters of a chunk; a run is cut out of one by counting characters from its start.
CHUNK = 128
#: Characters of a block of ``near``; a text of twice as many, less one, holds a whole block wherever it starts.
BLOCK = 32


def numbered(rows: DataFrame) -> DataFrame:
    """rows with an id, written so that an id stays with its row."""
    return materialize(rows.withColumn("id", F.monotonically_increasing_id()), "texts")


def grams(texts: DataFrame, *sizes: int) -> DataFrame:
    """id, place (from 0) and g: all runs of these numbers of characters of texts (id, text, perhaps scope). Texts that are shorter have
    none; for 0 each text has the empty run once."""
    large, scope = [n for n in sizes if n], [c for c in texts.columns if c == "scope"]
    empty = texts.where("text is not null").select(*scope, "id", F.lit(0).cast("long").alias("place"), F.lit("").alias("g"))
    if not large:
        return empty if sizes else empty.limit(0)
    # the look-ahead takes what a chunk shares with the next one
    chunks = F.regexp_extract_all("text", F.lit(f"(?s)(?=(.{{1,{CHUNK + max(large) - 1}}})).{{1,{CHUNK}}}"), F.lit(1))
    cut = texts.where(F.length("text") >= min(large)).select(*scope, "id", F.posexplode(chunks).alias("k", "chunk"))
    runs = cut.select(*scope, "id", "k", "chunk", F.explode(F.sequence(F.lit(1), F.least(F.lit(CHUNK), F.length("chunk")))).alias("i"))
    n = F.lit(large[0])
    if len(large) > 1:
        runs, n = runs.select("*", F.explode(F.array(*map(F.lit, large))).alias("n")), F.col("n")
    runs = runs.where(F.col("i") + n - 1 <= F.length("chunk"))
    found = runs.select(*scope, "id", (F.col("k").cast("long") * CHUNK + F.col("i") - 1).alias("place"), F.substring("chunk", F.col("i"), n).alias("g"))
    return found.unionByName(empty) if 0 in sizes else found


def tiles(texts: DataFrame, n: int) -> DataFrame:
    """The runs of ``grams`` that cover a text: every n-th, and the last."""
    lengths = texts.select("id", F.length("text").cast("long").alias("size"))
    own = grams(texts, n).join(lengths, "id")
    return own.where((F.col("place") % n == 0) | (F.col("place") == F.col("size") - n)).drop("size")


def near(held: DataFrame, holders: DataFrame) -> DataFrame:
    """The holders that may hold any of the held texts, of 2 * BLOCK - 1 characters at least: those of which a block, of the
    ones laid end to end from the start, is a run of a held text. Hashes stand for both, so a few may come in vain."""
    runs = materialize(grams(held, BLOCK).select("scope", F.xxhash64("g").alias("h")).distinct(), "runs")
    blocks = F.array_distinct(F.transform(F.regexp_extract_all("text", F.lit(f"(?s).{{{BLOCK}}}"), F.lit(0)), lambda b: F.xxhash64(b)))
    hit = holders.select("scope", "id", F.explode(blocks).alias("h")).join(runs, ["scope", "h"], "left_semi").select("id").distinct()
    return holders.join(materialize(hit, "near"), "id", "left_semi")


def contained(held: DataFrame, holders: DataFrame, n: int) -> DataFrame:
    """held and holder: ids of texts of which one stands in the other. Both have scope, id and text; held texts
    have at least n characters.

    A held text is covered by tiles of n characters. Holders' runs that are no tile are left out before anything is
    written. The tile that stands in the fewest places gives the places where the text may start; there it does if, and
    only if, each of its tiles stands at its own distance from that place. So places are compared, and no text is.

    Long held texts that are few beside their holders look for them by blocks first (``near``), so that a holder costs a
    row for each of its blocks, and one for each of its characters only if it may hold something."""
    size, wide = F.length("text"), F.length("text") >= 2 * BLOCK - 1
    longest, chars = holders.agg(F.max(size), F.sum(size)).first()
    held = held.where(size <= (longest or 0))
    asked = held.agg(F.sum(F.when(wide, size)), F.count_if(~wide)).first()
    if not asked[0] or asked[0] * BLOCK > chars:
        return _contained(held, holders, n)
    found = _contained(held.where(wide), near(held.where(wide), holders), n)
    return found.unionByName(_contained(held.where(~wide), holders, n)) if asked[1] else found


def _contained(held: DataFrame, holders: DataFrame, n: int) -> DataFrame:
    """As ``contained``, by postings of all holders."""
    own = materialize(tiles(held, n), "tiles")
    postings = materialize(grams(holders, n).join(own.select("scope", "g").distinct(), ["scope", "g"], "left_semi"), "postings")
    counts = postings.groupBy("scope", "g").agg(F.count("*").alias("n"))
    seen = own.join(counts, ["scope", "g"], "left").groupBy("scope", "id").agg(F.min_by(F.struct("g", "place"), F.struct("n", "place")).alias("best"), F.count("*").alias("tiles"), F.count("n").alias("hits"))
    rarest = seen.where("tiles = hits").select("scope", F.col("id").alias("held"), "tiles", F.col("best.g").alias("g"), F.col("best.place").alias("at"))
    starts = rarest.join(postings, ["scope", "g"]).select("held", "tiles", F.col("id").alias("holder"), (F.col("place") - F.col("at")).alias("start")).where("start >= 0")
    wanted = starts.join(own.select(F.col("id").alias("held"), "place", "g"), "held").select("held", "tiles", F.col("holder").alias("id"), "start", (F.col("start") + F.col("place")).alias("place"), "g")
    met = wanted.join(postings, ["id", "place", "g"]).groupBy("held", F.col("id").alias("holder"), "start").agg(F.count("*").alias("n"), F.first("tiles").alias("tiles"))
    return met.where("n = tiles").select("held", "holder").distinct()


def holders_of(held: DataFrame, holders: DataFrame, n: int = 8) -> DataFrame:
    """held and holder: as ``contained``, with held texts of any length: those of fewer than n characters meet the runs of
    their own length. An empty text stands in all of its scope."""
    long = F.length("text") >= n
    found = contained(held.where(long), holders.where(long), n)
    sizes = [r[0] for r in held.where(~long).select(F.length("text")).distinct().collect()]  # n lengths at most
    if not sizes:
        return found
    short = held.where(~long).select("scope", F.col("id").alias("held"), F.col("text").alias("g"))
    runs = grams(holders, *sizes).select("scope", F.col("id").alias("holder"), "g").join(short.select("scope", "g").distinct(), ["scope", "g"], "left_semi").distinct()
    return found.unionByName(short.join(runs, ["scope", "g"]).select("held", "holder"))
