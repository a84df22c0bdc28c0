"""Spelling variant grouping: words that differ by one edit, found with a variable-length gram index.

``word_counts`` counts the words of the documents (pre-aggregated in each task). ``near_words`` finds all pairs of words
one inserted, deleted or replaced code point apart, ``forms`` gives each word its form and root.

1. Dictionary. Words are written ``^word$``. A gram has ``MIN_GRAM`` to ``MAX_GRAM`` characters; the dictionary is pruned
   by frequency: a gram is extended by one character only where it stands at more than ``frequent`` places of words. Only
   those frequent grams are kept as a table.
2. Decomposition. At every place of a word stands the shortest gram that is not frequent (or the longest allowed). It is
   decided by its own characters alone, so an edit changes only the grams that touch it.
3. Affected grams. ``affected`` is the largest number of a word's grams that touch one place, the bound of what one
   edit can change. A gram left of the edit keeps its place and everything before it; a gram right of the edit keeps its
   distance to the end and everything behind it. So each gram gives two keys, (start, text from ``^`` through the gram) and
   (text from the gram through ``$``), and of a word's keys at least ``grams - affected`` are shared with each near word.
4. Lists. With keys ordered alike for all words (longest first: the rarest), two words that share so many keys share one
   among the first ``keys - (grams - affected) + 1`` of each. Only those keys' lists are merged; a list of one word is
   dropped. A list of more than ``LIST`` words is dealt into blocks, each pair of blocks is one unit of work of
   bounded size. Near pairs are verified inside the unit; other pairs of a list never leave it.
5. Words of more than ``LONG`` code points take the keys of a few grams around their middle instead: with a gram that ends
   before another one starts, no edit touches both sides. Words of ``LONG`` and ``LONG + 1`` take part in both ways.
6. A form has at least twice its word's count, so chains are short; roots are found by doubling: each round replaces
   a word's root by that root's root.

Defined results: null and empty texts have no words. A null doc_id is written as nothing before the colon. Every row
counts, also repeated rows. Words with equal counts: the smallest in code-point order is the form. Other columns of
the input do not matter. An empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, written

MIN_CHARS, MIN_COUNT = 5, 3
DELETE_ONE_IN = 97
MIN_GRAM, MAX_GRAM = 2, 5
FREQUENT = 64             # places that a gram may stand at before it is extended
LIST = 1024               # words of one list that are compared in one unit
LONG = 64
COUNTER = 1 << 19         # words that a task counts before it hands them on
CELLS = 1 << 23           # characters compared at a time
FEW = 12                  # words that are compared one by one: numpy's fixed cost is larger


# --- words ------------------------------------------------------------------------------------------

def damaged(doc_id: int | None, runs: Counter, min_chars: int) -> Counter:
    """The words of one document: lower-cased runs, some of them with one code point deleted."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out = Counter()
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), start)
        if h % DELETE_ONE_IN == 0:
            k = h % len(run)
            run = run[:k] + run[k + 1:]
            if len(run) < min_chars:
                continue
        out[run] += n
    return out


def _count(min_chars: int):
    runs = re.compile(r"[a-zÀ-ÿ]{%d,}" % min_chars)

    def batch_of(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())],
                                          names=["word", "n"])

    def run(batches):
        held: Counter = Counter()
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    if text:       # bytes.lower changes A-Z only
                        held.update(damaged(doc_id, Counter(runs.findall(text.encode().lower().decode())), min_chars))
                if len(held) > COUNTER:
                    yield batch_of(held)
                    held = Counter()
        if held:
            yield batch_of(held)
    return run


def word_counts(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of all words of at least ``min_chars`` code points that occur at least ``min_count`` times."""
    some = map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), _count(min_chars), "word string, n long")
    return some.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


# --- the gram index ---------------------------------------------------------------------------------

def middle(length: int) -> tuple[range, range]:
    """The starts of the left and the right grams that a long word of ``length`` code points is found by. Left ones
    count from ``^``, right ones end the same distance from ``$`` in every near word; left ones end before right ones start."""
    half = length // 2
    right = length + 2 - (half - MAX_GRAM)                   # distance half - MAX_GRAM to the end
    return range(half - MAX_GRAM - 3, half - MAX_GRAM), range(right - 2, right + 1)


def places(length: int) -> list[int]:
    """The starts, within ``^word$``, of the grams that a word's keys need."""
    if length <= LONG + 1:
        return list(range(length + 1))
    left, right = middle(length)
    return [*left, *right]


def _grams(batches):
    """Every gram that may be extended, once per place."""
    for batch in batches:
        ids, at, grams = [], [], []

        def out():
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(at, pa.int64()),
                                               pa.array(grams, pa.string())], names=["id", "at", "gram"])

        for i, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            padded = f"^{word}$"
            for p in places(len(word)):
                for q in range(MIN_GRAM, min(MAX_GRAM, len(padded) - p + 1)):
                    ids.append(i)
                    at.append(p * 256 + q)
                    grams.append(padded[p:p + q])
            if len(ids) > 1 << 16:
                yield out()
                ids, at, grams = [], [], []
        yield out()


def decompose(word: str, extended: dict[int, int]) -> dict[int, int]:
    """{start in ``^word$``: length of the gram there}; ``extended[start]`` is the length of the longest frequent gram."""
    size = len(word) + 2
    return {p: min(extended[p] + 1 if p in extended else MIN_GRAM, size - p) for p in places(len(word))}


def affected(grams: dict[int, int], size: int) -> int:
    """The largest number of grams that touch one place of a padded word of ``size`` characters."""
    change = np.zeros(size + 1, dtype=np.int64)
    for p, q in grams.items():
        change[p] += 1
        change[p + q] -= 1
    return int(np.cumsum(change)[1:size - 1].max())


def _hashes(text: str, cuts: set[int], side: bytes) -> dict[int, int]:
    """Hash of ``text[:cut]`` for every cut, taken as the text grows."""
    h, out, at = xxhash.xxh3_64(side), {}, 0
    for cut in sorted(cuts):
        h.update(text[at:cut].encode())
        out[cut], at = h.intdigest(), cut
    return out


def keys(word: str, grams: dict[int, int]) -> list[int]:
    """64-bit hashes of the keys whose lists a word takes part in; a key that is the whole word is never shared."""
    padded = f"^{word}$"
    size = len(padded)
    through = _hashes(padded, {p + q for p, q in grams.items()}, b"<")
    back = _hashes(padded[::-1], {size - p for p in grams}, b">")
    taken = set()
    if len(word) <= LONG + 1:
        left = [(p + q, "<", p, through[p + q]) for p, q in grams.items() if p + q < size]
        right = [(size - p, ">", 0, back[size - p]) for p in grams if p > 0]
        ordered = sorted(left + right, key=lambda k: (-k[0], k[1:]))
        sure = len(grams) - affected(grams, size)
        taken |= {(h, p) for _, _, p, h in ordered[:len(ordered) - sure + 1]}
    if len(word) >= LONG:
        left, right = middle(len(word))
        taken |= {(through[p + grams[p]], p) for p in left} | {(back[size - p], 0) for p in right}
    return [xxhash.xxh3_64_intdigest(h.to_bytes(8, "little"), seed=p) for h, p in taken]


def _postings(batches):
    for batch in batches:
        for k in range(0, batch.num_rows, 4096):
            part = batch.slice(k, 4096)
            out: list[list] = [[], [], []]
            for word, n, found in zip(*(part.column(c).to_pylist() for c in ("word", "n", "found")), strict=True):
                extended: dict[int, int] = {}
                for x in found or ():
                    extended[x >> 8] = max(extended.get(x >> 8, 0), x & 255)
                own = keys(word, decompose(word, extended))
                out[0] += own
                out[1] += [word] * len(own)
                out[2] += [n] * len(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(out[0], dtype=np.uint64).astype(np.int64)), pa.array(out[1], pa.string()),
                 pa.array(out[2], pa.int64())], names=["key", "word", "n"])


# --- verification -----------------------------------------------------------------------------------

def _matrix(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common start of every row of ``a`` with every row of ``b``."""
    width = min(a.shape[1], b.shape[1])
    differs = np.ones((len(a), len(b), width + 1), dtype=bool)
    differs[:, :, :width] = a[:, None, :width] != b[None, :, :width]
    return differs.argmax(axis=2)


def one_edit(a: str, b: str) -> bool:
    """Whether two distinct words are one edit apart. The place where they part is found by halving."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    lo, hi = 0, len(a)                      # a[:lo] == b[:lo]; they part at hi or before
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid - 1
    return a[lo + (len(a) == len(b)):] == b[lo + 1:]


def near_in(words: list[str]) -> list[tuple[int, int]]:
    """The pairs of places of distinct words one edit apart."""
    if len(words) <= FEW:
        return [(i, j) for j in range(len(words)) for i in range(j) if one_edit(words[i], words[j])]
    by_length: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        by_length.setdefault(len(w), []).append(k)
    out = []
    for length, own in by_length.items():
        a = _matrix([words[k] for k in own])
        for other in (length, length + 1):
            if other not in by_length:
                continue
            them = by_length[other]
            b = a if other == length else _matrix([words[k] for k in them])
            step = max(1, CELLS // (len(them) * (length + 1)))
            for s in range(0, len(own), step):
                part = a[s:s + step]
                same = _common(part, b) + _common(part[:, ::-1], b[:, ::-1])
                close = (same >= other - 1) & (same < 2 * length if other == length else True)
                for i, j in zip(*(x.tolist() for x in np.nonzero(close)), strict=True):
                    if other > length or own[s + i] < them[j]:
                        out.append((own[s + i], them[j]))
    return out


def _verified(batches):
    """Rows come sorted by unit; a unit holds at most a few thousand words."""
    def rows():
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in ("key", "lo", "hi", "word", "n")), strict=True)

    out: list[tuple] = []

    def batch_of():
        cols = list(zip(*out, strict=True)) or [(), (), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            cols, (pa.string(), pa.int64(), pa.string(), pa.int64()), strict=True)], names=["word", "n", "near", "near_n"])

    for _, unit in itertools.groupby(rows(), key=lambda r: r[:3]):
        counts = {word: n for _, _, _, word, n in unit}
        words = list(counts)
        if len(words) > 1:
            for i, j in near_in(words):
                a, b = sorted((words[i], words[j]))
                out.append((a, counts[a], b, counts[b]))
        if len(out) > 1 << 14:
            yield batch_of()
            out.clear()
    yield batch_of()


def near_words(words: DataFrame, frequent: int = FREQUENT, list_size: int = LIST) -> DataFrame:
    """(word, n, near, near_n): every ordered pair of distinct words of ``words`` (word, n; each word once, of at least
    ``MAX_GRAM`` code points) that are one edit apart."""
    table = written(words.select("word", "n", F.monotonically_increasing_id().alias("id")), "words")
    grams = map_arrow(table.select("id", "word"), _grams, "id long, at long, gram string")
    dictionary = written(grams.groupBy("gram").agg(F.count(F.lit(1)).alias("times"))
                         .filter(F.col("times") > frequent).select("gram"), "dictionary")
    found = grams.join(dictionary, "gram").groupBy("id").agg(F.collect_list("at").alias("found"))
    postings = written(map_arrow(table.join(found, "id", "left"), _postings, "key long, word string, n long"), "postings")
    lists = (postings.groupBy(F.col("key").alias("list")).agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
             .select("list", F.ceil(F.col("size") / list_size).cast("int").alias("blocks")))
    dealt = (postings.join(written(lists, "lists"), F.col("key") == F.col("list"))
             .withColumn("own", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "word", "n"))
    units = dealt.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    pairs = map_arrow(units, _verified, "word string, n long, near string, near_n long").distinct()
    there, back = F.struct("word", "n", "near", "near_n"), F.struct("near", "near_n", "word", "n")
    return pairs.select(F.inline(F.array(there, back.cast(pairs.schema))))


# --- forms ------------------------------------------------------------------------------------------

def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every row of ``forms`` (word, form): the last word that forms lead to."""
    table = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = table.select(F.col("word").alias("w2"), F.col("root").alias("r2"))
        table = written(table.join(further, F.col("root") == F.col("w2"), "left")
                        .select("word", F.coalesce("r2", "root").alias("root"), F.col("r2").isNotNull().alias("moved")), "roots")
        if table.filter("moved").isEmpty():
            return table.drop("moved")
        table = table.drop("moved")


def variants(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, frequent: int = FREQUENT,
             list_size: int = LIST) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``docs``."""
    if min_chars < MAX_GRAM:
        raise ValueError(f"words need at least {MAX_GRAM} code points: an edit could change all grams of shorter ones")
    words = written(word_counts(docs, min_chars, min_count), "counts")
    best = (near_words(words, frequent, list_size).groupBy(F.col("word").alias("own"))
            .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("top")))
    table = written(
        words.join(best, F.col("word") == F.col("own"), "left")
        .withColumn("leads", F.coalesce(-F.col("top.minus") >= 2 * F.col("n"), F.lit(False)))
        .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                F.when(F.col("leads"), F.col("top.near")).alias("form"),
                F.when(F.col("leads"), -F.col("top.minus")).alias("form_n")), "forms")
    last = roots(table.filter("form IS NOT NULL")).select(F.col("word").alias("own"), F.col("root"))
    return (table.join(last, F.col("word") == F.col("own"), "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
