"""Benchmark decontamination by templates.

Texts become token templates: numbers, names and units turn into typed placeholders, all other words stay
(A-Z lower-cased). Windows of ``WINDOW`` words of the documents are hash-joined with those of the benchmark items,
whatever the words are: these are exact hits and count in any case. Windows of ``WINDOW`` template tokens with at
least ``MIN_LITERALS`` literal ones are joined as well. Each of these hits carries the values of its slots; slots of
an item must map one to one, per type, onto the document's values over all windows of one alignment, which catches
re-parameterised questions ("12 apples" against "15 apples") and refuses windows that merely have the same shape:
a window with a value that clashes with another one does not count.

Windows of more than ``FEW`` families of items (a family: items that differ in slot values only) are boilerplate, such as
a preamble that many items share: they make no document a candidate. A window that a family shares stands for the family
once, by its smallest item_id. Only where a document holds a window of an item's own are the item's other windows, boilerplate
too, looked up in that document; so the rows grow with the documents that hold an item, not with documents times items. An
item that is made of boilerplate alone counts by all its windows, one item for each. Of an item's words outside boilerplate
at least ``OWN`` (or ``SHARE`` of them, where it has fewer) have to be covered.

A document is contaminated by an item if the windows that hold cover at least ``COVER`` of its tokens, or
``SHARE`` of them where the item is shorter. An item of fewer than ``MIN_ITEM`` words ("Paris", "Yes") says nothing about a
longer text: it counts only in documents of at most twice its words. Windows of several alignments count together, as in a copy with a word put
in, if the alignments lie within the item's length of each other and their slot maps agree.

* number: a word of digits, with its decimals and thousands ("3.5", "1,000"). * unit: a word of ``UNITS`` after a
  number, also without a blank ("5kg"); singular and plural are one value. * name: a word with a capital first letter
  and not a capital second one. At the start of a sentence or line it may be either, so windows over such a word are
  hashed both with it as a literal and with it as a name.

A fixed-size Bloom bitmap of the benchmark's window hashes (``BLOOM_BITS``, whatever the benchmark's size) is
broadcast, so that only windows that may hit are shuffled; the join decides.

Defined results: null and empty texts and rows with a null doc_id or item_id match nothing. An item shorter
than the window is one window; documents make windows of each width that occurs among the items (at most ``WINDOW``),
so it is found anywhere in a document. Repeated rows of an item or a document count once. Empty tables give no rows.
"""

from __future__ import annotations

import functools
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, row_groups, text_buffer, written
from .words import LOWERED, _hash_runs, mix, windows, words

WINDOW, MIN_LITERALS = 8, 4
COVER, SHARE = 13, 0.6
FEW, MIN_ITEM, OWN = 3, 5, 4
BLOOM_BITS = 1 << 23            # 1 MB
UNITS = ("mm cm m km in ft mi mg g kg lb oz ml l s sec min h hr hrs ms hz khz mhz ghz kb mb gb tb w kw v a k c f "
         "percent meter meters metre metres kilometer kilometers kilometre kilometres mile miles foot feet inch inches "
         "gram grams kilogram kilograms pound pounds ounce ounces liter liters litre litres second seconds minute "
         "minutes hour hours day days week weeks month months year years dollar dollars euro euros cent cents degree "
         "degrees").split()
LITERAL, NUMBER, NAME, UNIT = 0, 1, 2, 3
_SLOT = np.array([0, 0x5851F42D4C957F2D, 0x14057B7EF767814F, 0x369DEA0F31A53F85], dtype=np.uint64)
_STOPS = np.zeros(256, dtype=bool)
_STOPS[list(b".!?\n:;|\"")] = True


@functools.lru_cache(maxsize=1)
def _unit_hashes() -> tuple[np.ndarray, np.ndarray]:
    """(sorted hashes of ``UNITS``, those of their singulars)."""
    singular = {u: u[:-1] for u in UNITS if len(u) > 2 and u.endswith("s") and u[:-1] in UNITS} | {"feet": "foot", "inches": "inch"}
    raw, off = text_buffer(pa.array(UNITS))
    plain = words(raw, off).hashes
    raw, off = text_buffer(pa.array([singular.get(u, u) for u in UNITS]))
    order = np.argsort(plain)
    return plain[order], words(raw, off).hashes[order]


class Templates(NamedTuple):
    words: np.ndarray    # word hashes
    first: np.ndarray    # index of each text's first word, and one more
    values: np.ndarray   # of each token: hash of its type and value
    kinds: np.ndarray    # (2, tokens): names at starts as literals, as names
    tokens: np.ndarray   # (2, tokens): hash of the literal or the placeholder
    begin: np.ndarray    # index of each text's first token, and one more
    lo: np.ndarray       # first and last word of each token
    hi: np.ndarray


def templates(raw: np.ndarray, offsets: np.ndarray) -> Templates:
    """Words and template tokens of texts lying one after the other in ``raw``."""
    w = words(raw, offsets)
    n = len(w.hashes)
    if not n:
        none = np.zeros(0, dtype=np.int64)
        two = np.zeros((2, 0), dtype=np.uint64)
        return Templates(w.hashes, w.first, w.hashes, two.astype(np.int8), two, w.first, none, none)
    begins_text = np.zeros(n, dtype=bool)
    begins_text[w.first[:-1][np.diff(w.first) > 0]] = True
    is_digit = (raw >= 48) & (raw <= 57)
    digit = np.concatenate([[0], np.cumsum(is_digit)])
    number = digit[w.ends] - digit[w.starts] == w.ends - w.starts
    units, singular = _unit_hashes()

    def unit_at(hashes):
        at = np.minimum(np.searchsorted(units, hashes), len(units) - 1)
        return units[at] == hashes, singular[at]

    # a number and its unit in one word
    mixed = np.flatnonzero(is_digit[w.starts] & ~number)
    rest = np.append(np.flatnonzero(~is_digit), len(raw))
    cut = rest[np.searchsorted(rest, w.starts[mixed])]
    low = LOWERED[raw]
    is_unit, unit = unit_at(_hash_runs(low, cut, w.ends[mixed]))
    mixed, cut, unit = mixed[is_unit], cut[is_unit], unit[is_unit]
    compound = np.zeros(n, dtype=bool)
    compound[mixed] = True
    number_end = w.ends.copy()
    number_end[mixed] = cut
    value = w.hashes.copy()
    value[mixed] = _hash_runs(low, w.starts[mixed], cut)
    # decimals and thousands go on with the number before them
    size = number_end - w.starts
    mark = raw[w.starts - 1]
    goes_on = np.zeros(n, dtype=bool)
    goes_on[1:] = (number[:-1] & (number | compound)[1:] & ~begins_text[1:] & (w.starts[1:] - w.ends[:-1] == 1)
                   & ((mark[1:] == 46) | ((mark[1:] == 44) & (size[1:] == 3) & (size[:-1] <= 3))))
    # capital: A-Z, or a Latin-1 capital letter (UTF-8 C3 80..9E)
    nxt = np.append(raw, 0)[w.starts + 1]
    capital = ((raw[w.starts] >= 65) & (raw[w.starts] <= 90)) | ((raw[w.starts] == 0xC3) & (nxt >= 0x80) & (nxt <= 0x9E))
    second = w.starts + np.where(raw[w.starts] == 0xC3, 2, 1)
    inside = second < w.ends
    then = np.append(raw, 0)[np.minimum(second, len(raw))]
    name = capital & inside & ~((then >= 65) & (then <= 90))
    stops = np.concatenate([[0], np.cumsum(_STOPS[raw])])
    begins = begins_text.copy()
    begins[1:] |= stops[w.starts[1:]] - stops[w.ends[:-1]] > 0
    after = np.zeros(n, dtype=bool)
    after[1:] = number[:-1] & ~begins_text[1:]
    is_unit, one = unit_at(w.hashes)
    after &= is_unit
    value[after] = one[after]
    kinds = np.zeros((2, n), dtype=np.int8)
    kinds[0, name & ~begins] = NAME
    kinds[1, name] = NAME
    kinds[:, number | compound] = NUMBER
    kinds[:, after] = UNIT
    # words to tokens
    head = np.flatnonzero(~goes_on)
    depth = np.arange(n) - head[np.cumsum(~goes_on) - 1]
    joined = np.add.reduceat(mix(value + depth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), head)
    ends = np.concatenate([[0], np.cumsum((~goes_on).astype(np.int64) + compound)])
    main = ends[head]
    extra = ends[mixed] + ~goes_on[mixed]
    m = int(ends[-1])
    values, lo, hi = np.zeros(m, dtype=np.uint64), np.zeros(m, dtype=np.int64), np.zeros(m, dtype=np.int64)
    kind, literal = np.zeros((2, m), dtype=np.int8), np.zeros(m, dtype=np.uint64)
    values[main], values[extra] = joined, unit
    literal[main] = w.hashes[head]
    lo[main], hi[main] = head, np.append(head[1:], n) - 1
    lo[extra] = hi[extra] = mixed
    kind[:, main] = kinds[:, head]
    kind[:, extra] = UNIT
    values = mix(values ^ _SLOT[kind[1]])
    return Templates(w.hashes, w.first, values, kind, np.where(kind == LITERAL, literal, _SLOT[kind]), ends[w.first], lo, hi)


def _bloom_bits(h: np.ndarray) -> np.ndarray:
    two = mix(h ^ np.uint64(0x2545F4914F6CDD1D))
    return np.stack([h % np.uint64(BLOOM_BITS), two % np.uint64(BLOOM_BITS)], axis=1).astype(np.int64)


EXACT, TEMPLATE, NAMED = 0, 1, 2      # word windows; template windows; those with a word at a start as a name


def families(t: Templates) -> np.ndarray:
    """A hash per text that is the same for texts which differ in the values of their slots only: of its template with all
    names as names, and of which of its slots hold the same value."""
    out = np.empty(len(t.begin) - 1, dtype=np.uint64)
    for k, (b, e) in enumerate(zip(t.begin, t.begin[1:])):
        _, first, same = np.unique(t.values[b:e][t.kinds[1][b:e] != LITERAL], return_index=True, return_inverse=True)
        out[k] = xxhash.xxh3_64_intdigest(t.tokens[1][b:e].tobytes() + b"|" + first[same].astype("<i8").tobytes())
    return out


def _window_rows(widths, items: bool, passes=None):
    """Rows (id, at, lo, hi, n_tokens, width, form, key, slots, family) of every window, or of those ``passes`` lets
    through; documents have no family.

    ``at`` counts the tokens before the window, ``lo`` and ``hi`` are its first and last word.
    Texts of at least ``width`` tokens have windows of each width; items shorter than the largest one, of their own."""
    def rows(ids, t, kin, width, form):
        first = t.first if form == EXACT else t.begin
        tokens = t.words if form == EXACT else t.tokens[form - TEMPLATE]
        counts = np.diff(first)
        fits = counts == width if items and width < max(widths) else counts >= width
        grams, at = windows(tokens, first, width)
        doc = np.repeat(np.arange(len(ids)), np.diff(at))
        place = np.arange(len(grams)) - at[doc]
        begin = first[doc] + place
        end = np.minimum(begin + width, len(tokens))
        take = fits[doc]
        keys = mix(grams ^ np.uint64(width * 2 + (form == EXACT)))
        if form != EXACT:       # without a slot, the exact window says the same
            literal = np.concatenate([[0], np.cumsum(t.kinds[form - TEMPLATE] == LITERAL)])
            n_literal = literal[end] - literal[begin]
            take &= (n_literal >= min(MIN_LITERALS, width)) & (n_literal < width)
        if form == NAMED:       # the others have been hashed
            either = np.concatenate([[0], np.cumsum(t.kinds[0] != t.kinds[1])])
            take &= either[end] > either[begin]
        if passes is not None:
            take &= passes(keys)
        at = np.flatnonzero(take)
        if form == EXACT and width < max(widths) and len(at):   # one place of a short item in a document is enough
            order = np.lexsort((at, keys[at], doc[at]))
            at = at[order]
            new = np.ones(len(at), dtype=bool)
            new[1:] = (doc[at][1:] != doc[at][:-1]) | (keys[at][1:] != keys[at][:-1])
            at = at[new]
        begin, doc, start = begin[at], doc[at], t.first[:-1][doc[at]]
        if form == EXACT:
            lo, hi, slots = begin, begin + width - 1, [[]] * len(at)
        else:
            lo, hi = t.lo[begin], t.hi[begin + width - 1]
            kinds = t.kinds[form - TEMPLATE]
            slots = [t.values[b:b + width][kinds[b:b + width] != LITERAL].view(np.int64) for b in begin]
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[doc], pa.int64()), pa.array(place[at], pa.int32()), pa.array(lo - start, pa.int32()),
             pa.array(hi - start, pa.int32()), pa.array(np.diff(t.first)[doc], pa.int32()),
             pa.array(np.full(len(at), width), pa.int32()), pa.array(np.full(len(at), form), pa.int32()),
             pa.array(keys[at].view(np.int64)), pa.array(slots, pa.list_(pa.int64())),
             pa.array(kin[doc].view(np.int64)) if items else pa.nulls(len(at), pa.int64())],
            names=["id", "at", "lo", "hi", "n_tokens", "width", "form", "key", "slots", "family"])

    def run(batches):
        for batch in batches:
            raw, off = text_buffer(batch.column(1))
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for i, j in row_groups(off):
                t = templates(raw[off[i]:off[j]], off[i:j + 1] - off[i])
                kin = families(t) if items else None
                for width in widths:
                    for form in (EXACT, TEMPLATE, NAMED):
                        yield rows(ids[i:j], t, kin, width, form)
    return run


ROWS = "id long, at int, lo int, hi int, n_tokens int, width int, form int, key long, slots array<long>, family long"


def boilerplate(items: DataFrame, few: int = FEW) -> tuple[DataFrame, DataFrame]:
    """(t_key, t_slots, item_id, t_tokens): the windows that make a document a candidate for an item, each for as few items
    as possible; and (p_item, plain): the places of an item's words that lie in boilerplate."""
    common = written(items.groupBy(F.col("key").alias("of")).agg(F.countDistinct("family").alias("kin"))
                     .filter(F.col("kin") > few).select("of"), "boilerplate")
    own = items.join(common, F.col("key") == F.col("of"), "left_anti")
    has = own.select(F.col("id").alias("has")).distinct()
    rest = items.join(has, F.col("id") == F.col("has"), "left_anti")
    size = F.size("slots").alias("t_slots")
    both = (own.groupBy("key", size, "family").agg(F.min(F.struct("id", "n_tokens")).alias("one")).drop("family")
            .unionByName(rest.groupBy("key", size).agg(F.min(F.struct("id", "n_tokens")).alias("one"))))
    tell = both.select(F.col("key").alias("t_key"), "t_slots", F.col("one.id").alias("item_id"),
                       F.col("one.n_tokens").alias("t_tokens")).distinct()
    plain = (items.join(common, F.col("key") == F.col("of"), "left_semi").join(has, F.col("id") == F.col("has"), "left_semi")
             .groupBy(F.col("id").alias("p_item"))
             .agg(F.array_distinct(F.flatten(F.collect_set(F.sequence("lo", "hi")))).alias("plain")))
    return written(tell, "telling"), written(plain, "plain")


def _bloom(items: DataFrame) -> np.ndarray:
    """The packed bitmap of the items' window hashes, made of 64-bit words on the executors."""
    def words_of(batches):
        for b in batches:
            bits = _bloom_bits(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(bits >> 6, pa.int64()),
                                              pa.array(np.left_shift(np.uint64(1), (bits & 63).astype(np.uint64)).view(np.int64))],
                                             names=["word", "bits"])
    got = (map_arrow(items.select("key"), words_of, "word long, bits long")
           .groupBy("word").agg(F.bit_or("bits").alias("bits")))
    out = np.zeros(BLOOM_BITS // 64, dtype=np.int64)
    for r in got.toLocalIterator():     # at most BLOOM_BITS / 64 words
        out[r["word"]] = r["bits"]
    return out.view(np.uint64)


def contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, cover: int = COVER,
                 share: float = SHARE, few: int = FEW, min_item: int = MIN_ITEM) -> DataFrame:
    """(doc_id, item_id, n_matched, n_tokens, kind) of every document and item that it contains.

    ``n_matched`` of the item's ``n_tokens`` words lie in windows that hold; ``kind`` is ``exact`` if all slots
    are equal, else ``template``."""
    items = written(map_arrow(benchmark.filter("item_id IS NOT NULL").select(F.col("item_id").cast("long"), "text"),
                              _window_rows(range(1, width + 1), True), ROWS).distinct(), "items")
    widths = sorted({r["width"] for r in items.select("width").distinct().collect()} | {width})   # at most ``width``
    bitmap = docs.sparkSession.sparkContext.broadcast(_bloom(items))

    def passes(keys):
        bits = _bloom_bits(keys)
        return ((bitmap.value[bits >> 6] >> (bits & 63).astype(np.uint64)) & np.uint64(1)).all(axis=1)

    found = written(map_arrow(docs.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), "text"),
                              _window_rows(widths, False, passes), ROWS).drop("family"), "windows")
    tell, plain = boilerplate(items, few)
    candidates = (found.join(tell, (F.col("key") == F.col("t_key")) & (F.size("slots") == F.col("t_slots")))
                  .filter((F.col("t_tokens") >= min_item) | (F.col("n_tokens") <= 2 * F.col("t_tokens")))
                  .select(F.col("id").alias("c_doc"), F.col("item_id").alias("c_item")).distinct())
    items = items.select(F.col("id").alias("item_id"), F.col("at").alias("item_at"), "lo", "hi", "n_tokens",
                         F.col("width").alias("item_width"), F.col("form").alias("item_form"), F.col("key").alias("k"),
                         F.col("slots").alias("item_slots"))
    wanted = items.join(written(candidates, "candidates"), F.col("item_id") == F.col("c_item"))
    # keys of word windows and of template windows differ; a name at a start may meet one inside a sentence
    hits = (found.select(F.col("id").alias("doc_id"), "at", F.col("lo").alias("doc_lo"), "width", "form", "key", "slots")
            .join(wanted, (F.col("doc_id") == F.col("c_doc")) & (F.col("key") == F.col("k"))
                  & (F.col("width") == F.col("item_width"))
                  & ((F.col("form") == EXACT) == (F.col("item_form") == EXACT)) & (F.size("slots") == F.size("item_slots")))
            .select("doc_id", "item_id", "n_tokens", (F.col("at") - F.col("item_at")).alias("shift"),
                    (F.col("doc_lo") - F.col("lo")).alias("offset"), "lo", "hi", F.greatest("form", "item_form").alias("form"),
                    F.expr("zip_with(item_slots, slots, (a, b) -> struct(a AS i, b AS d))").alias("pairs")))

    def one_to_one(pairs):
        return ((F.size(F.array_distinct(pairs["i"])) == F.size(pairs))
                & (F.size(F.array_distinct(pairs["d"])) == F.size(pairs)))

    def clash(p, q):
        return (p["i"] == q["i"]) != (p["d"] == q["d"])

    def places(found):
        return F.array_distinct(F.flatten(F.transform(found, lambda w: F.sequence(w["lo"], w["hi"]))))

    window = F.struct("lo", "hi", "pairs")
    # one alignment: a shift between document and item, of words in exact hits, else of tokens. Its rows are at most the
    # item's windows. Names at starts are literals first, then names: what holds in the first case is not lost to a
    # clash in the second.
    aligned = (hits.withColumn("named", F.explode(F.when(F.col("form") == EXACT, F.array(F.lit(-1)))
                                                  .when(F.col("form") == TEMPLATE, F.array(F.lit(0), F.lit(1)))
                                                  .otherwise(F.array(F.lit(1)))))
               .groupBy("doc_id", "item_id", "n_tokens", "shift", "named")
               .agg(F.min("offset").alias("offset"), F.collect_set(window).alias("found"))
               .withColumn("pairs", F.array_distinct(F.flatten("found.pairs")))
               .withColumn("wrong", F.when(one_to_one(F.col("pairs")), F.slice("pairs", 1, 0)).otherwise(
                   F.filter("pairs", lambda p: F.exists("pairs", lambda q: clash(p, q)))))
               .withColumn("held", F.filter("found", lambda w: ~F.arrays_overlap(w["pairs"], F.col("wrong"))))
               .withColumn("pairs", F.array_distinct(F.flatten("held.pairs")))
               .withColumn("places", places(F.col("held"))).filter(F.size("places") > 0)
               .withColumn("same", F.when(F.col("named") < 0, F.col("places")).otherwise(F.slice("places", 1, 0))))
    # with each alignment, those at most the item's length behind it whose values agree with it, longest first
    several = F.expr("""sort_array(collect_list(struct(-size(places) AS size, offset, named, places, same, pairs)) OVER (
        PARTITION BY doc_id, item_id ORDER BY offset / n_tokens RANGE BETWEEN CURRENT ROW AND 1.000001D FOLLOWING))""")

    def unite(so_far, one):
        both = F.array_union(so_far["pairs"], one["pairs"])
        return F.when(one_to_one(both), F.struct(
            F.array_union(so_far["places"], one["places"]).alias("places"),
            F.array_union(so_far["same"], one["same"]).alias("same"), both.alias("pairs"))).otherwise(so_far)

    outside = F.size(F.array_except("all.places", "plain"))
    held = (aligned.withColumn("near", several)
            .withColumn("all", F.aggregate("near", F.struct("places", "same", "pairs"), unite))
            .join(plain, F.col("item_id") == F.col("p_item"), "left")
            .filter(F.col("plain").isNull()
                    | (outside >= F.least(F.lit(OWN), F.ceil((F.col("n_tokens") - F.size("plain")) * share).cast("int"))))
            .groupBy("doc_id", "item_id", "n_tokens")
            .agg(F.max(F.struct(F.size("all.places").alias("n_matched"), F.size("all.same").alias("n_same"))).alias("best"))
            .select("doc_id", "item_id", "n_tokens", "best.*"))
    need = F.least(F.lit(cover), F.ceil(F.col("n_tokens") * share).cast("int"))
    return (held.filter(F.col("n_matched") >= need)
            .select("doc_id", "item_id", "n_matched", "n_tokens",
                    F.when(F.col("n_same") == F.col("n_matched"), F.lit("exact")).otherwise(F.lit("template"))
                    .alias("kind")))


def without_benchmark(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """Pipeline stage: the rows of ``docs``, all columns, that contain no benchmark item."""
    lost = contaminated(docs, benchmark, **how).select(F.col("doc_id").alias("__lost")).distinct()
    return docs.join(lost, docs["doc_id"] == lost["__lost"], "left_anti")
