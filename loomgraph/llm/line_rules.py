"""Quality rules with cross-document line frequency, with DataFrame functions alone.

Lines are normalised (lower case, digits to 0, white space to one blank between words), hashed, and counted by distinct
documents of the same host. A line is removed where it stands in more than ``share`` of its host's documents, and in more
than ``least_docs`` (so few that only tiny hosts are ruled by it: below that, a line isn't a pattern of the host). A
document that loses words is rejected if it is depleted: most of its words are gone, or too few are left.

Each text is read and split once: its rules and its lines' hashes are written together, and all else goes on from
there. Counts are aggregated before they are shuffled, and a line that a third of the documents share meets its count in
a join that Spark splits. Rules within a document use whole texts: words, characters, symbols, repeated lines, and words
in 3-word windows that occur twice or more (windows are compared by 64-bit hashes).

Null and empty texts have no words and fail the base rules. Null hosts are one host. Rows that repeat a doc_id are
documents of their own if their texts differ, else one document; each row gets a result. A line at its limit stays. An
empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.common import WHITE, discard, free_names, materialize
from loomgraph.llm.licenses import let

#: White space of words, one by one.
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = r"[#*$%&|<>]"
LEAST_DOCS, SHARE = 5, 0.05
#: Rejected: more than this share of the words removed, or fewer words than this kept.
MOST_REMOVED, LEAST_KEPT = 0.5, 50


def repeated_words(words: Column) -> Column:
    """Words of an array that stand in 3-word windows found twice or more."""

    def count(h: Column) -> Column:
        def covered(s: Column) -> Column:
            same = lambda e, at: F.coalesce(F.get(s, at).getField("h") == e.getField("h"), F.lit(False))
            again = F.filter(s, lambda e, j: same(e, j - 1) | same(e, j + 1))
            return F.size(F.array_distinct(F.flatten(F.transform(again, lambda e: F.array(e.getField("i"), e.getField("i") + 1, e.getField("i") + 2)))))

        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(h) == F.size(F.array_distinct(h)), F.lit(0)).otherwise(let(ordered, covered))

    windows = lambda w: F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    return F.when(F.size(words) < 3, F.lit(0)).otherwise(let(words, lambda w: let(windows(w), count))).cast("long")


def split_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text that isn't null."""
    return let(F.btrim(text, F.lit(BLANKS)), lambda flat: F.when(flat == "", F.array().cast("array<string>")).otherwise(F.split(flat, WHITE + "+")))


def normal(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), "[0-9]", "0")


def hashed_lines(text: Column) -> Column:
    """array of struct(line, words) for the lines of a text with words: the hash of its normal words, and their number."""
    each = F.transform(F.split(normal(text), "\n"), lambda x: let(split_words(x), lambda w: F.struct(F.xxhash64(w).alias("line"), F.size(w).alias("words"))))
    return F.filter(each, lambda x: x.getField("words") > 0)


def text_rules(docs: DataFrame) -> DataFrame:
    """doc_id, host (null-safe), text_hash, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and hashed (lines)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    flat = F.btrim(text, F.lit(BLANKS))
    words = F.when(flat == "", F.array().cast("array<string>")).otherwise(F.split(flat, WHITE + "+"))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    own = docs.select("doc_id", host(F.col("source")).alias("host"), F.xxhash64("text").alias("text_hash"), text.alias("text"), words.alias("words"), lines.alias("lines"))
    return own.select(
        "doc_id", "host", "text_hash",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        hashed_lines(F.col("text")).alias("hashed"),
    )


def host(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), source), F.lit(""))


def document_lines(rules: DataFrame) -> DataFrame:
    """doc_id, text_hash, host, line and words (in all its places) of each document's distinct lines.

    rules: doc_id, text_hash, host and hashed, a row for each row of the documents."""
    each = rules.select("doc_id", "text_hash", "host", F.explode("hashed").alias("l")).select("doc_id", "text_hash", "host", "l.line", "l.words")
    return each.groupBy("doc_id", "text_hash", "host", "line").agg(F.sum("words").alias("words"))


def frequent_lines(lines: DataFrame, *, least_docs: int = LEAST_DOCS, share: float = SHARE, hosts: DataFrame) -> DataFrame:
    """host and line of the lines in more documents than the host's limit. hosts: host and docs (documents)."""
    counts = lines.groupBy("host", "line").agg(F.count("*").alias("n"))
    many = counts.where(F.col("n") > least_docs)  # as the limit is at least that
    return many.join(hosts, "host").where(F.col("n") > F.greatest(F.lit(float(least_docs)), F.col("docs") * share)).select("host", "line")


def quality(docs: DataFrame, *, least_docs: int = LEAST_DOCS, share: float = SHARE, most_removed: float = MOST_REMOVED, least_kept: int = LEAST_KEPT) -> DataFrame:
    """doc_id, text_hash, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, removed_words, base_failed, kept."""
    rules = materialize(text_rules(docs), "rules")
    lines = materialize(document_lines(rules), "lines")
    one = rules.groupBy("host", "doc_id", "text_hash").agg(F.count("*").alias("rows"))
    hosts = one.groupBy("host").agg(F.count("*").alias("docs"))
    often = frequent_lines(lines, least_docs=least_docs, share=share, hosts=hosts)
    gone = lines.join(often, ["host", "line"]).groupBy("host", "doc_id", "text_hash").agg(F.sum("words").alias("removed"))
    gone = gone.withColumnRenamed("host", "h_").withColumnRenamed("text_hash", "t_").withColumnRenamed("doc_id", "d_")
    same = (F.col("host") == F.col("h_")) & (F.col("text_hash") == F.col("t_")) & F.col("doc_id").eqNullSafe(F.col("d_"))
    # rows that repeat a document have its lines summed over all of them
    gone = materialize(gone.join(one, same).select("h_", "t_", "d_", F.floor(F.col("removed") / F.col("rows")).alias("removed")), "removed")
    discard(lines)
    both = rules.join(gone, same, "left")
    removed = F.coalesce("removed", F.lit(0)).cast("long")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    depleted = (removed > F.col("n_words") * most_removed) | (F.col("n_words") - removed < least_kept)
    columns = ("doc_id", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return both.select(*columns, removed.alias("removed_words"), failed.alias("base_failed"), (~failed & ~((removed > 0) & depleted)).alias("kept"))


def without_frequent_lines(docs: DataFrame, *, least_docs: int = LEAST_DOCS, share: float = SHARE) -> DataFrame:
    """docs with the lines above the limits taken out of text; all columns are kept."""
    hashed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), host(F.col("source")).alias("host"), hashed_lines(F.coalesce("text", F.lit(""))).alias("hashed"))
    lines = materialize(document_lines(hashed), "lines")
    hosts = docs.select(host(F.col("source")).alias("host"), "doc_id", F.xxhash64("text").alias("text_hash")).distinct().groupBy("host").agg(F.count("*").alias("docs"))
    often = frequent_lines(lines, least_docs=least_docs, share=share, hosts=hosts)
    id_, hash_, host_, gone_ = free_names(docs, "id_", "hash_", "host_", "gone_")
    # a document's own lines at most
    gone = lines.join(often, ["host", "line"]).groupBy("host", "doc_id", "text_hash").agg(F.collect_set("line").alias(gone_))
    gone = gone.withColumnRenamed("doc_id", id_).withColumnRenamed("text_hash", hash_).withColumnRenamed("host", host_)
    same = docs["doc_id"].eqNullSafe(gone[id_]) & (F.xxhash64(docs["text"]) == gone[hash_]) & (host(docs["source"]) == gone[host_])
    both = docs.join(gone, same, "left")
    line_hash = lambda x: F.xxhash64(split_words(normal(x)))
    kept = F.filter(F.split(docs["text"], "\n"), lambda x: ~F.array_contains(gone[gone_], line_hash(x)))
    text = F.when(gone[gone_].isNull(), docs["text"]).otherwise(F.array_join(kept, "\n"))
    return both.select(*[text.alias(c) if c == "text" else docs[c] for c in docs.columns])


def quality_sql() -> str:
    """The columns of op10 for DuckDB."""
    word = r"[^\x20\x09-\x0D]+"
    return rf"""
WITH d AS (SELECT doc_id, coalesce('s' || source, '') AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '{word}') AS ws, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{word}')) AS ls FROM d),
win AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS win FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, win) AS c FROM win) WHERE c > 1) GROUP BY doc_id),
raw AS (SELECT doc_id, host, unnest(string_split(text, chr(10))) AS l FROM d),
lines AS (SELECT doc_id, host, trim(regexp_replace(regexp_replace(lower(l), '[0-9]', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS line, sum(len(regexp_extract_all(l, '{word}'))) AS words
  FROM raw WHERE regexp_matches(l, '{word}') GROUP BY ALL),
hosts AS (SELECT host, count(*) AS docs FROM d GROUP BY host),
often AS (SELECT c.host, c.line FROM (SELECT host, line, count(*) AS n FROM lines GROUP BY ALL) c JOIN hosts USING (host) WHERE n > greatest({float(LEAST_DOCS)}, docs * {SHARE})),
gone AS (SELECT doc_id, sum(words) AS removed FROM lines JOIN often USING (host, line) GROUP BY doc_id),
r AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
  (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
  coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(removed, 0)::BIGINT AS removed_words
  FROM w LEFT JOIN rep USING (doc_id) LEFT JOIN gone USING (doc_id))
SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT (removed_words > 0 AND (removed_words > n_words * {MOST_REMOVED} OR n_words - removed_words < {LEAST_KEPT})) AS kept
FROM r"""
