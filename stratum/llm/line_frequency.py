"""Quality rules with cross-document line frequency, in DataFrame functions only.

Per text: words are runs without ``[\\x20\\x09-\\x0D]``; their code points, symbols, repeated lines and words inside repeated
3-word windows are counted inside the row (arrays, no shuffle). A repeated window is found by its 64-bit hash: windows
are sorted by (hash, place), neighbours with one hash are repeats, and only texts that have any are sorted at all.

Across texts, per host:

1. Every line that holds a word is normalised (A-Z lower-cased, digits to 0, runs of blanks to one space, none at
   its ends) and hashed. The rows' figures and line hashes are written once, without the texts (16 bytes a line).
2. A line's frequency is the number of distinct texts of its host that hold it: exact copies of a text count once, so a
   group of copies does not make its own lines frequent. Two-phase distinct count: no task gets a whole hot line.
3. A line is above the limit when more than ``min_texts`` texts and more than ``share`` of the host's distinct texts hold
   it. Only those lines are joined back; a text that loses more than ``lost`` of its word code points is depleted.

``verdicts`` returns the figures and the verdict per row, ``cleaned`` the documents that are kept, without the lines.

Defined results: a null or empty text has no words, no lines and fails the base rules. Rows are documents, also
repeated rows and rows without a doc_id. Rows without a host are together one host. Other columns of the input do not
matter, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, written

BLANK = r"[\x20\x09-\x0D]+"
LONG_BLANK = r"[\x20\x09\x0B-\x0D]{2,}|[\x09\x0B-\x0D]"     # what is not one space already, inside a line
SYMBOL = r"[#*$%&|<>]"
MIN_WORDS, MOST_REPEATED = 50, 50        # fewer words, or a larger percentage of words in repeated windows, fail
MIN_TEXTS, SHARE, LOST = 20, 0.01, 0.5
FIGURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _following(array: str) -> Column:
    """The array without its first element: with ``zip_with`` every element meets its neighbour (the last one, null)."""
    return F.expr(f"slice({array}, 2, greatest(size({array}) - 1, 0))")


def figures(texts: DataFrame) -> DataFrame:
    """``texts`` (a column ``text`` that is never null, others stay) with ``FIGURES``."""
    others = [F.col(c) for c in texts.columns]
    words = texts.select("*", F.filter(F.split("text", BLANK), lambda w: w != "").alias("words"),
                         F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines_with"))
    hashed = words.select(*others, F.size("words").cast("long").alias("n_words"),
                          F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
                          F.regexp_count("text", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
                          (F.size("lines_with") - F.size(F.array_distinct("lines_with"))).cast("long").alias("n_dup_lines"),
                          F.expr("""CASE WHEN size(words) < 3 THEN array() ELSE
                              transform(sequence(0, size(words) - 3), i -> xxhash64(words[i], words[i + 1], words[i + 2]))
                              END""").alias("windows"))
    done = ["n_words", "word_chars", "n_symbols", "n_dup_lines"]
    by_hash = hashed.select(*others, *done, F.expr("""
        CASE WHEN size(array_distinct(windows)) < size(windows)
             THEN sort_array(transform(windows, (h, i) -> struct(h, i))) ELSE array() END""").alias("by_hash"))
    twins = F.zip_with("by_hash", _following("by_hash"),
                       lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    places = by_hash.select(*others, *done, F.sort_array(F.array_distinct(F.flatten(F.filter(
        twins, lambda x: x.isNotNull())))).alias("places"))
    covered = F.zip_with("places", _following("places"), lambda p, q: F.least(F.coalesce(q - p, F.lit(3)), F.lit(3)))
    return places.select(*others, *done, F.aggregate(covered, F.lit(0).cast("long"), lambda s, x: s + x)
                         .alias("n_repeat_words"))


def line_array(text: Column) -> Column:
    """Per line of the text the hash of its normalised form and its code points that are no blanks."""
    plain = F.regexp_replace(F.translate(text, UPPER + "123456789", LOWER + "0" * 9), LONG_BLANK, " ")
    return F.transform(F.split(plain, "\n"), lambda x: F.struct(
        F.xxhash64(F.trim(x)).alias("h"), F.length(F.replace(x, F.lit(" "), F.lit(""))).alias("chars")))


def _texts(docs: DataFrame, host: str) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id"), F.col(host).alias("host"), text.alias("text"),
                       F.xxhash64(text).alias("t1"), F.crc32(text).alias("t2"))     # a text's identity: 96 bits


def _lines(table: DataFrame) -> DataFrame:
    """One row per line with a word: the table's keys, ``pos``, ``h``, ``chars``."""
    keys = [c for c in ("row", "host", "t1", "t2") if c in table.columns]
    return (table.select(*keys, F.posexplode("lines").alias("pos", "line"))
            .select(*keys, "pos", "line.h", "line.chars").filter("chars > 0"))


def frequent_lines(table: DataFrame, min_texts: int = MIN_TEXTS, share: float = SHARE) -> DataFrame:
    """(f_host, f_h): the lines above the limit."""
    held = (_lines(table).groupBy("host", "h").agg(F.countDistinct("t1", "t2").alias("n")).filter(F.col("n") > min_texts))
    hosts = table.groupBy("host").agg(F.countDistinct("t1", "t2").alias("of")).filter(F.col("of") > min_texts)
    both = held.join(hosts.withColumnRenamed("host", "of_host"), F.col("host").eqNullSafe(F.col("of_host")))
    return both.filter(F.col("n") > share * F.col("of")).select(F.col("host").alias("f_host"), F.col("h").alias("f_h"))


def _gone(table: DataFrame, frequent: DataFrame) -> DataFrame:
    lines = _lines(table)
    return lines.join(frequent, (lines["h"] == frequent["f_h"]) & lines["host"].eqNullSafe(frequent["f_host"]))


def base_failed(min_words: int = MIN_WORDS, most_repeated: int = MOST_REPEATED) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))


def verdicts(docs: DataFrame, host: str = "source", min_texts: int = MIN_TEXTS, share: float = SHARE,
             lost: float = LOST) -> DataFrame:
    """Per row of ``docs``: doc_id, ``FIGURES``, base_failed, kept, n_lines (with a word), n_removed, chars_removed."""
    rows = figures(_texts(docs, host).withColumn("lines", line_array(F.col("text"))))
    table = written(rows.drop("text").withColumn("row", F.monotonically_increasing_id()), "line_hashes")
    frequent = written(frequent_lines(table, min_texts, share), "frequent_lines")
    gone = (_gone(table, frequent).groupBy("row").agg(F.sum("chars").alias("chars_removed"),
                                                      F.count(F.lit(1)).alias("n_removed")))
    count = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    scalars = table.select("row", "doc_id", *FIGURES, base_failed().alias("base_failed"),
                           F.size(F.filter("lines", lambda x: x["chars"] > 0)).cast("long").alias("n_lines"))
    return (scalars.join(gone, "row", "left")
            .select("doc_id", *FIGURES, "base_failed", "n_lines", count("n_removed"), count("chars_removed"))
            .withColumn("kept", ~F.col("base_failed") & (F.col("chars_removed") <= lost * F.col("word_chars"))))


def cleaned(docs: DataFrame, host: str = "source", min_texts: int = MIN_TEXTS, share: float = SHARE,
            lost: float = LOST) -> DataFrame:
    """The documents that are kept, with all their columns; ``text`` without the lines above the limit, ``n_chars``, if
    there is one, follows."""
    rows = figures(_texts(docs, host).withColumn("lines", line_array(F.col("text"))))
    table = written(rows.drop("text"), "line_hashes")
    frequent = written(frequent_lines(table, min_texts, share), "frequent_lines")
    texts = table.dropDuplicates(["host", "t1", "t2"])
    gone = (_gone(texts, frequent).groupBy("host", "t1", "t2")
            .agg(F.collect_set("pos").alias("__gone"), F.sum("chars").alias("chars_removed")))
    good = (texts.select("host", "t1", "t2", *FIGURES).join(
                gone.select(F.col("host").alias("g_host"), F.col("t1").alias("g1"), F.col("t2").alias("g2"), "__gone",
                            "chars_removed"),
                F.col("host").eqNullSafe(F.col("g_host")) & (F.col("t1") == F.col("g1")) & (F.col("t2") == F.col("g2")), "left")
            .filter(~base_failed() & (F.coalesce("chars_removed", F.lit(0)) <= lost * F.col("word_chars")))
            .select(F.col("host").alias("__host"), F.col("t1").alias("__t1"), F.col("t2").alias("__t2"), "__gone"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    kept = (docs.withColumn("__x", F.xxhash64(text)).withColumn("__c", F.crc32(text))
            .join(good, F.col(host).eqNullSafe(F.col("__host")) & (F.col("__x") == F.col("__t1"))
                  & (F.col("__c") == F.col("__t2"))))
    split = kept.withColumn("__lines", F.when(F.col("__gone").isNotNull(), F.split("text", "\n")))
    stay = F.expr("array_join(transform(array_except(sequence(0, size(__lines) - 1), __gone), p -> __lines[p]), '\\n')")
    new_text = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(stay)
    out = split.withColumn("__text", new_text)
    new = {"text": F.col("__text"), "n_chars": F.length("__text").cast("long")}
    return out.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])
