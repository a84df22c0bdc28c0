"""URL filters: host and path rules, and a blocked Bloom filter of listed URLs with an exact join behind it.

Everything here is DataFrame functions.

* Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased. Path: from there up to ``?``,
  ``#`` or the end. A URL that is null or has no ``://`` has neither (both are empty strings).
* A rule names a host and a path prefix. It fits its host and all subdomains if the URL's path starts with the
  rule's; of the rules that fit, the longest decides.
* Where no rule fits, the list decides. The canonical URL is host without ``www.``, without port 80 or 443, and the
  path without a trailing ``/``. The Bloom filter has one 64-bit word per block and ``BITS`` bits per URL, all in
  one block; it is a table (block, word) of at most ``MAX_BLOCKS`` rows (16 MB), which is the proven bound
  for broadcasting it. URLs whose bits are all set go on to an equi-join with the whole list; the others cannot
  be listed. Hot URLs do no harm: the list is distinct, so the join is many to one, and AQE splits hot keys.

Defined results: a URL without host is never listed. Repeated rows are judged one by one. Empty tables give empty
results, an empty list blocks nothing.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, written

BITS, URLS_PER_BLOCK, MAX_BLOCKS = 4, 4, 1 << 20


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """The form under which URLs are listed; empty without a host."""
    plain = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www\.", "")
    return F.when(plain == "", F.lit("")).otherwise(F.concat(plain, F.regexp_replace(path, "/+$", "")))


def fitting(rules: list[Rule], host: Column, path: Column) -> Column:
    """The longest rule that fits, as a struct (rule, verdict); null if none does. Rules are a short list."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.host + r.path), r)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(blocks)).cast("int")


def _mask(url: Column) -> Column:
    """``BITS`` bits of one 64-bit word."""
    h = F.xxhash64(F.lit(1), url)
    one = F.lit(1).cast("long")
    out = F.call_function("shiftleft", one, h.bitwiseAND(F.lit(63)).cast("int"))
    for k in range(1, BITS):
        out = out.bitwiseOR(F.call_function("shiftleft", one, F.shiftrightunsigned(h, 6 * k).bitwiseAND(F.lit(63)).cast("int")))
    return out


def bloom(listed: DataFrame, blocks: int) -> DataFrame:
    """(block, word): the blocked Bloom filter of the column ``canonical``; at most ``blocks`` rows."""
    return (listed.select(_block(F.col("canonical"), blocks).alias("block"), _mask(F.col("canonical")).alias("mask"))
            .groupBy("block").agg(F.bit_or("mask").alias("word")))


def filter_blocks(n_urls: int) -> int:
    blocks = 1
    while blocks < MAX_BLOCKS and blocks * URLS_PER_BLOCK < n_urls:
        blocks *= 2
    return blocks


def judge(pages: DataFrame, listed: DataFrame, rules: list[Rule]) -> DataFrame:
    """(page_id, host, path, rule, verdict, possible, listed) of every page.

    ``listed`` has the canonical URLs in its column ``canonical``; ``possible`` says what the Bloom filter says."""
    list_ = written(listed.select("canonical").filter("canonical IS NOT NULL AND canonical <> ''").distinct(), "list")
    blocks = filter_blocks(list_.count())
    words = bloom(list_, blocks)
    parts = (pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
             .withColumn("canonical", canonical(F.col("host"), F.col("path")))
             .withColumn("fit", fitting(rules, F.col("host"), F.col("path"))))
    tested = (parts.withColumn("own_block", _block(F.col("canonical"), blocks))
              .join(F.broadcast(words), F.col("own_block") == F.col("block"), "left")   # at most MAX_BLOCKS rows
              .withColumn("mask", _mask(F.col("canonical")))
              .withColumn("possible", F.coalesce((F.col("canonical") != "")
                                                 & (F.col("word").bitwiseAND(F.col("mask")) == F.col("mask")), F.lit(False)))
              .drop("own_block", "block", "word", "mask"))
    tested = written(tested, "tested")
    sure = list_.select(F.col("canonical").alias("listed_url"))
    hits = (tested.filter("possible").join(sure, F.col("canonical") == F.col("listed_url"), "left")
            .withColumn("listed", F.col("listed_url").isNotNull()).drop("listed_url"))
    out = hits.unionByName(tested.filter("NOT possible").withColumn("listed", F.lit(False)))
    method = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", F.col("fit.rule").alias("rule"),
                      F.coalesce("fit.verdict", method).alias("verdict"), "possible", "listed")


SPAM_WORDS = "spam-farm casino cheap-pills free-bets adult-x ads-track".split()


def spam_list(pages: DataFrame, words: list[str] = SPAM_WORDS) -> DataFrame:
    """The canonical URLs of the pages on hosts with a label that starts with one of ``words``."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    labels = F.split(host, r"\.")
    spam = F.exists(labels, lambda x: F.greatest(*[x.startswith(w) for w in words]))
    return pages.filter(spam).select(canonical(host, path).alias("canonical"))
