"""Secret scans with character Markov models, in DataFrame functions only.

Base spans, leftmost and non-overlapping per kind: ``assign`` (a keyword, a separator and a value of at least 8
characters), ``access`` (AKIA keys of at least 16 characters), ``hex`` (at least 32 lower-case hexadecimal digits).

The method adds ``markov`` spans: of each token of ``TOKEN`` the run of at least ``MIN_RUN`` characters that is likeliest
under a first-order Markov model of random strings against one of ordinary identifiers, if by ``MIN_RATIO`` nats or more, and
if it overlaps no base span; so a random value behind words joined to it by hyphens is found, and not the words. Both models
are trained from labelled samples: ordinary are the words that at least two of ``MAX_TRAIN_DOCS`` distinct texts (those with
the smallest hashes; copies count once) have outside base spans; random are those texts' base spans and digests of their
hashes in base64, hexadecimal and capital letters and digits. Only the counts of character pairs, a table of fixed size,
reach the driver; the log-likelihood ratios go back as one literal array.

Positions are code points, ends exclusive. They come from the lengths of the pieces between the matches, so each
pattern is matched by Java's regular expressions on the executors and nothing else runs there.

Defined results: a null text is an empty one: no spans, and the digest of the empty string. Repeated rows are
scanned one by one. An empty table gives an empty result; with nothing to learn from, no ``markov`` spans.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed patterns of the base kinds, in the order in which equal starts are listed.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"      # the same matches as AKIA[A-Z0-9]+ of at least 16 characters
HEX = r"[0-9a-f]{32,}"             # the same matches as [0-9a-f]+ of at least 32 characters
KINDS = ("assign", "access", "hex", "markov")
MIN_VALUE = 8
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
MIN_RATIO = 12.0
MIN_RUN = 16                   # characters of a random run
CHUNK = 256
MAX_TRAIN_DOCS = 1000
DIGESTS = 8
BACK_OFF = 2.0
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SPANS = "array<struct<start:int,kind:int,end:int>>"


def _matches(df: DataFrame, name: str, pattern: str, group: int = 0, text: str = "text") -> DataFrame:
    """``df`` with the array ``name``: per match of ``pattern`` in the column ``text`` the lengths of the text before it (since the match
    before), of the match and of its ``group``, and the match. Every expression is a column of its own, so each pattern runs
    once over a text."""
    found, rest = f"{name}_found", f"{name}_rest"
    some = df.withColumn(found, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else F.col(found)
    both = F.when(F.size(found) > 0, F.arrays_zip(F.split(text, pattern, -1).alias("before"), F.col(found).alias("all"),
                                                  value.alias("value")))
    return (some.withColumn(rest, F.coalesce(both, F.array().cast("array<struct<before:string,all:string,value:string>>")))
            .withColumn(name, F.transform(F.filter(rest, lambda x: x["all"].isNotNull()), lambda x: F.struct(
                F.length(x["before"]).alias("gap"), F.length(x["all"]).alias("size"), F.length(x["value"]).alias("value"),
                x["all"].alias("text")))).drop(found, rest))


def _placed(df: DataFrame, name: str) -> DataFrame:
    """The array ``name`` of ``_matches`` with where each match starts. Running sums are taken chunk by chunk, as an array
    that grows by one element is copied each time."""
    sums, offsets = f"{name}_sums", f"{name}_offsets"
    chunk = lambda c: F.slice(F.col(name), c * CHUNK + 1, CHUNK)
    numbers = F.when(F.size(name) > 0, F.sequence(F.lit(0), F.floor((F.size(name) - 1) / CHUNK).cast("int")))
    summed = df.withColumn(sums, F.transform(numbers, lambda c: F.aggregate(
        chunk(c), F.lit(0), lambda at, x: at + x["gap"] + x["size"])))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
    with_offsets = summed.withColumn(offsets, F.aggregate(
        F.col(sums), start, lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
        lambda acc: acc["out"]))

    def walk(offset, c):
        none = F.struct(offset.alias("at"), F.array().cast("array<int>").alias("out"))
        starts = F.aggregate(chunk(c), none, lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + x["size"]).alias("at"), F.concat(acc["out"], F.array(acc["at"] + x["gap"])).alias("out")),
            lambda acc: acc["out"])
        return F.zip_with(chunk(c), starts, lambda x, at: F.struct(at.alias("start"), (at + x["size"]).alias("end"),
                                                                     x["value"].alias("value"), x["text"].alias("text")))

    placed = F.flatten(F.transform(F.col(offsets), walk))
    kind = "array<struct<start:int,end:int,value:int,text:string>>"
    return with_offsets.withColumn(name, F.coalesce(placed, F.array().cast(kind))).drop(sums, offsets)


def _as_spans(name: str, kind: int, least: int = 0) -> Column:
    return F.transform(F.filter(name, lambda x: x["value"] >= least), lambda x: F.struct(
        x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end")))


def with_base(docs: DataFrame) -> DataFrame:
    """``docs`` (a column ``text`` without nulls) with ``base``, the sorted base spans."""
    df = docs
    for name, pattern, group in (("assign", ASSIGN, 2), ("access", ACCESS, 0), ("hex", HEX, 0)):
        df = _placed(_matches(df, name, pattern, group), name)
    return df.withColumn("base", F.sort_array(F.concat(_as_spans("assign", 0, MIN_VALUE), _as_spans("access", 1),
                                                       _as_spans("hex", 2)))).drop("assign", "access", "hex")


def written_out(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def pair_ratios(docs: DataFrame, max_docs: int = MAX_TRAIN_DOCS) -> list[float] | None:
    """Log-likelihood ratios log P(b | a, random) / P(b | a, ordinary), at (number of a) * size + number of b."""
    texts = docs.select("text").filter("text IS NOT NULL").withColumn("doc_id", F.xxhash64("text"))
    ids = texts.select("doc_id").distinct().orderBy("doc_id").limit(max_docs)       # of each distinct text one
    sample = texts.join(F.broadcast(ids), "doc_id").dropDuplicates(["doc_id"])
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.col("text"), ASSIGN, " "), ACCESS, " "), HEX, " ")
    # a word of one document only may be a secret that no pattern knows; words that recur are ordinary
    ordinary = (sample.select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all(
        plain, F.lit("[A-Za-z0-9+/_=-]{4,}"), F.lit(0)))).alias("word"))
        .groupBy("word").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi")
        .select(F.lit(0).alias("random"), "word"))
    digest = lambda k: F.sha2(F.concat_ws("/", F.col("doc_id").cast("string"), F.lit(k)), 512)
    base64 = lambda k: F.regexp_replace(F.base64(F.unhex(digest(k))), "[^A-Za-z0-9+/]", "")
    digests = [made(f"{made.__name__}{k}") for k in range(DIGESTS) for made in (base64, base64, digest)]
    digests += [F.upper(F.regexp_replace(base64(f"capitals{k}"), "[+/]", "")) for k in range(DIGESTS)]
    random = sample.select(F.lit(1).alias("random"), F.explode(F.concat(
        F.array(*digests), F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)),
        F.regexp_extract_all("text", F.lit(ACCESS), F.lit(0)),
        F.regexp_extract_all("text", F.lit(HEX), F.lit(0)))).alias("word"))
    pairs = (ordinary.union(random).filter(F.length("word") > 1)
             .select("random", F.split("word", "").alias("c"))
             .select("random", F.explode(F.zip_with(F.col("c"), F.expr("slice(c, 2, size(c))"),
                                                    lambda a, b: F.concat(a, b))).alias("pair"))
             .groupBy("random", "pair").agg(F.count(F.lit(1)).alias("n")))
    counts: tuple[dict[str, int], dict[str, int]] = ({}, {})
    for r in pairs.collect():            # at most 2 * len(ALPHABET) ** 2 rows
        if r["pair"] and len(r["pair"]) == 2:
            counts[r["random"]][r["pair"]] = r["n"]
    if not all(counts):
        return None
    once = [{b: sum(n for pair, n in c.items() if pair[1] == b) + 0.5 for b in ALPHABET} for c in counts]
    logs = []
    for c, o in zip(counts, once, strict=True):     # unseen pairs fall back on how common the second character is
        every = sum(o.values())
        before = {a: sum(n for pair, n in c.items() if pair[0] == a and pair[1] in o) for a in ALPHABET}
        logs.append([math.log((c.get(a + b, 0) + BACK_OFF * o[b] / every) / (before[a] + BACK_OFF))
                     for a in ALPHABET for b in ALPHABET])
    return [r - o for o, r in zip(*logs, strict=True)]


def with_markov(df: DataFrame, ratios: list[float] | None) -> DataFrame:
    """``df`` (with ``text`` and ``base``) with ``extra``, the likeliest run of each token that is random and overlaps no base
    span."""
    if ratios is None:
        return df.withColumn("extra", F.array().cast(SPANS))
    table = F.from_json(F.lit("[" + ",".join(f"{x:.6f}" for x in ratios) + "]"), "array<double>")
    size = len(ALPHABET)

    def best_run(token):
        """(sum, first pair, last pair) of the run of character pairs with the largest sum of ratios."""
        codes = F.transform(F.filter(F.split(token, ""), lambda c: c != ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
        pairs = F.zip_with(F.slice(codes, 1, F.size(codes) - 1), F.slice(codes, 2, F.size(codes) - 1),
                           lambda a, b: F.get(table, a * size + b))
        zero = F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("from"), F.lit(0).alias("at"), F.lit(0.0).alias("best"),
                        F.lit(0).alias("first"), F.lit(-1).alias("last"))

        def step(acc, x):
            total = F.greatest(acc["sum"], F.lit(0.0)) + x
            begin = F.when(acc["sum"] > 0, acc["from"]).otherwise(acc["at"])
            better = total > acc["best"]
            return F.struct(total.alias("sum"), begin.alias("from"), (acc["at"] + 1).alias("at"), F.greatest(total, acc["best"]).alias("best"),
                            F.when(better, begin).otherwise(acc["first"]).alias("first"),
                            F.when(better, acc["at"]).otherwise(acc["last"]).alias("last"))
        return F.aggregate(pairs, zero, step)

    # tokens are looked for outside base spans, which become as many blanks
    base = f"(?:{ASSIGN})|{ACCESS}|{HEX}"
    pieces = F.arrays_zip(F.split("text", base, -1).alias("before"), F.regexp_extract_all("text", F.lit(base), F.lit(0)).alias("all"))
    blanked = F.array_join(F.transform(pieces, lambda x: F.concat(
        x["before"], F.rpad(F.lit(""), F.coalesce(F.length(x["all"]), F.lit(0)), " "))), "")
    df = df.withColumn("masked", F.when(F.size("base") > 0, blanked).otherwise(F.col("text")))
    tokens = _placed(_matches(df, "tokens", TOKEN, text="masked"), "tokens")
    runs = tokens.withColumn("runs", F.transform("tokens", lambda t: F.struct(t["start"].alias("start"), best_run(t["text"]).alias("run"))))
    likely = F.filter("runs", lambda r: (r["run"]["best"] >= MIN_RATIO) & (r["run"]["last"] - r["run"]["first"] + 2 >= MIN_RUN))
    spans = F.transform(likely, lambda r: F.struct((r["start"] + r["run"]["first"]).alias("start"), F.lit(3).alias("kind"),
                                                   (r["start"] + r["run"]["last"] + 2).alias("end")))
    found = runs.withColumn("likely", spans)
    return found.withColumn("extra", F.filter("likely", lambda s: ~F.exists(
        "base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))).drop("masked", "tokens", "runs", "likely")


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, base, spans) of every row: the base spans and all spans, as sorted arrays of (start, kind, end)."""
    ratios = pair_ratios(docs)
    based = with_base(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    return (with_markov(based, ratios)
            .select("doc_id", "base", F.sort_array(F.concat("base", "extra")).alias("spans")))
