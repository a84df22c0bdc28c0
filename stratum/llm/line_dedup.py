"""Line dedup with two Bloom filters.

Texts are split at ``\\n``. A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends and with A-Z
lower-cased. A key of at least ``min_chars`` code points found in at least two documents loses all its
lines except those in the smallest doc_id that holds it. Other lines stay, joined by ``\\n``.

1. Every task fills two Bloom bitmaps, "seen in a document" and "seen in a second one", from the hashes
   of its lines. The bitmaps of all tasks are merged piece by piece on the executors
   (``twice = twice1 | twice2 | once1 & once2``). Their size follows the number of bytes of text
   up to ``MAX_BITS`` (64 MB, the proven bound of what is broadcast). Beyond some tens of GB of text the
   filter fills up and lets more and more lines pass; the result stays the same.
2. Only lines whose bits are all in the second bitmap are shuffled. They are grouped by the key itself
   (pre-aggregated in each task: smallest and largest doc_id), which is the exact confirmation.
3. The confirmed keys, written to shared storage, are joined with the suspected lines; each document gets
   the list of keys that it loses.

Defined results: a null or empty text is one empty line and becomes an empty text. Rows with one doc_id
are one document; each row is returned. Rows with a null doc_id are together one document, after all
others. Other columns of the input do not matter, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_udf, map_arrow, written

MIN_CHARS = 10
BITS_PER_BYTE = 1 / 4          # bits of each bitmap per byte of text: about 16 per line of 64 bytes
MIN_BITS, MAX_BITS = 1 << 16, 1 << 29    # 64 MB at most
PIECE_BITS = 1 << 16           # bitmaps travel in pieces, as lists of places or as bitmaps of 8 KB
PIECE_BYTES = PIECE_BITS // 8
BLANKS = b" \t\n\x0b\x0c\r"
N_HASHES = 3
ROWS_AT_A_TIME = 256          # rows of a batch that are Python objects at one time


def line_key(line: bytes) -> bytes:
    return line.strip(BLANKS).lower()   # bytes.lower changes A-Z only


def long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode("utf-8")) >= min_chars)


def _keys(text: str | None, min_chars: int) -> set[bytes]:
    if not text:
        return set()
    return {k for k in map(line_key, text.encode("utf-8").split(b"\n")) if long_enough(k, min_chars)}


def _bits(keys, n_bits: int) -> np.ndarray:
    """``N_HASHES`` bit positions of every key, one row per key."""
    h = np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), dtype=np.uint64, count=len(keys))
    lo, hi = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return ((lo[:, None] + np.arange(N_HASHES, dtype=np.uint64) * hi[:, None]) % np.uint64(n_bits)).astype(np.int64)


def _sent(at: np.ndarray) -> bytes:
    """Places in a piece: as 16-bit numbers while that is shorter, else as the piece's bitmap."""
    if len(at) * 2 < PIECE_BYTES:
        return at.astype("<u2").tobytes()
    bits = np.zeros(PIECE_BITS, dtype=bool)
    bits[at] = True
    return np.packbits(bits).tobytes()


def _bitmap(sent: bytes) -> np.ndarray:
    if len(sent) == PIECE_BYTES:
        return np.frombuffer(sent, np.uint8)
    bits = np.zeros(PIECE_BITS, dtype=bool)
    bits[np.frombuffer(sent, "<u2")] = True
    return np.packbits(bits)


def _fill(n_bits: int, min_chars: int):
    """One task's two bitmaps, as the places of their set bits, piece by piece."""
    def run(batches):
        once, twice = [], []        # places set by a document of this task, sorted; those set by two

        def settle():
            every, counts = np.unique(np.concatenate(once), return_counts=True)
            twice.append(every[counts > 1])
            once[:] = [every]

        held = 0
        for batch in (whole.slice(k, ROWS_AT_A_TIME) for whole in batches for k in range(0, whole.num_rows, ROWS_AT_A_TIME)):
            for text in batch.column(0).to_pylist():
                keys = _keys(text, min_chars)
                if keys:
                    once.append(np.unique(_bits(keys, n_bits)))
                    held += len(once[-1])
            if held > 1 << 20:
                settle()
                held = 0
        if not once:
            return
        settle()
        one, two = once[0], np.unique(np.concatenate(twice))
        pieces = np.unique(one // PIECE_BITS)
        for k in range(0, len(pieces), 1024):
            some = pieces[k:k + 1024]
            cols = [[_sent(x[np.searchsorted(x, p * PIECE_BITS):np.searchsorted(x, (p + 1) * PIECE_BITS)] - p * PIECE_BITS)
                     for p in some] for x in (one, two)]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), *(pa.array(c, pa.binary()) for c in cols)],
                                             names=["piece", "once", "twice"])
    return run


def _merge(batches):
    """The merged pieces of this partition: at most as many as there are pieces, twice ``PIECE_BYTES`` each."""
    have: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for piece, once, twice in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            one, two = _bitmap(once), _bitmap(twice)
            if piece in have:
                had = have[piece]
                had[1] = had[1] | two | (had[0] & one)
                had[0] = had[0] | one
            else:
                have[piece] = [one, two]
    for piece, (one, two) in have.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([piece], pa.int32()), *(pa.array([_sent(np.flatnonzero(np.unpackbits(x)))], pa.binary()) for x in (one, two))],
            names=["piece", "once", "twice"])


PIECES = "piece int, once binary, twice binary"


def twice_filter(docs: DataFrame, n_bits: int, min_chars: int = MIN_CHARS) -> np.ndarray:
    """The second bitmap (bits seen in at least two documents), packed: ``n_bits / 8`` bytes."""
    pieces = map_arrow(docs.select("text"), _fill(n_bits, min_chars), PIECES)
    salted = pieces.repartition(F.col("piece"), F.pmod(F.xxhash64("once"), F.lit(16)))   # two levels: no task merges
    some = map_arrow(salted, _merge, PIECES)                                            # all copies of a piece
    merged = map_arrow(some.repartition("piece"), _merge, PIECES)
    out = np.zeros(max(n_bits // 8, PIECE_BYTES), dtype=np.uint8)
    for r in merged.select("piece", "twice").toLocalIterator():   # at most MAX_BITS / 8 bytes in all
        at = r["piece"] * PIECE_BYTES
        out[at:at + PIECE_BYTES] = _bitmap(r["twice"])
    return out


def filter_bits(docs: DataFrame) -> int:
    """Bits of each bitmap: a power of two that follows the bytes of text, within fixed bounds."""
    n = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = MIN_BITS
    while bits < MAX_BITS and bits < n * BITS_PER_BYTE:
        bits *= 2
    return bits


def lost_keys(docs: DataFrame, min_chars: int = MIN_CHARS, n_bits: int | None = None) -> DataFrame:
    """(doc_id, keys): for each document that loses lines, the keys of those lines."""
    n_bits = n_bits or filter_bits(docs)
    twice = docs.sparkSession.sparkContext.broadcast(twice_filter(docs, n_bits, min_chars))   # at most MAX_BITS / 8 bytes

    def suspects(batches):
        for batch in (whole.slice(k, ROWS_AT_A_TIME) for whole in batches for k in range(0, whole.num_rows, ROWS_AT_A_TIME)):
            ids, keys = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = list(_keys(text, min_chars))
                if own:
                    bits = _bits(own, n_bits)
                    hit = ((twice.value[bits >> 3] >> (7 - (bits & 7)).astype(np.uint8)) & 1).all(axis=1)
                    for k in np.flatnonzero(hit):
                        ids.append(doc_id)
                        keys.append(own[k].decode("utf-8"))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.string())],
                                             names=["doc_id", "line"])

    lines = written(map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), suspects,
                              "doc_id long, line string"), "suspects")
    # a null doc_id is a document after all others
    some = lines.groupBy("line").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"),
                                     F.max(F.col("doc_id").isNull()).alias("without"))
    repeated = written(some.filter(F.col("lo").isNotNull() & ((F.col("lo") < F.col("hi")) | F.col("without")))
                       .select(F.col("line").alias("repeated"), F.col("lo").alias("keeper")), "repeated")
    lost = (lines.join(repeated, F.col("line") == F.col("repeated"))
            .filter(~F.col("doc_id").eqNullSafe(F.col("keeper"))).select("doc_id", "line"))
    return lost.groupBy("doc_id").agg(F.collect_set("line").alias("lost"))


def _kept_udf():
    @arrow_udf("struct<text:string,n_lines:long,n_dropped:long>")
    def kept(text: pa.Array, lost: pa.Array) -> pa.Array:
        text = text.fill_null("")
        lines = pc.add(pc.count_substring(text, "\n").cast(pa.int64()), 1)
        hit = np.flatnonzero(lost.is_valid().to_numpy(zero_copy_only=False))    # most documents lose nothing
        parts, dropped, at = [], np.zeros(len(text), dtype=np.int64), 0
        for k in hit.tolist():
            gone = {x.encode("utf-8") for x in lost[k].as_py()}
            own = text[k].as_py().encode("utf-8").split(b"\n")
            stay = [x for x in own if line_key(x) not in gone]
            dropped[k] = len(own) - len(stay)
            parts += [text.slice(at, k - at), pa.array([b"\n".join(stay).decode("utf-8")], text.type)]
            at = k + 1
        whole = pa.concat_arrays([*parts, text.slice(at)])
        return pa.StructArray.from_arrays([whole.cast(pa.string()), lines, pa.array(dropped)],
                                          names=["text", "n_lines", "n_dropped"])
    return kept


def _with_kept(docs: DataFrame, min_chars: int) -> DataFrame:
    """``docs`` with the struct ``__kept`` (text, n_lines, n_dropped)."""
    lost = lost_keys(docs, min_chars).select(F.col("doc_id").alias("__id"), F.col("lost").alias("__lost"))
    joined = docs.join(lost, docs["doc_id"].eqNullSafe(lost["__id"]), "left")
    return joined.withColumn("__kept", _kept_udf()(F.col("text"), F.col("__lost"))).drop("__id", "__lost")


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Every row of ``docs`` as (doc_id, text, n_lines, n_dropped), text without its dropped lines."""
    return _with_kept(docs.select("doc_id", "text"), min_chars).select("doc_id", "__kept.*")


def without_repeats(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Pipeline stage: ``docs`` with all its columns, repeated lines taken out of ``text``; ``n_chars``, if
    there is one, follows."""
    out = _with_kept(docs, min_chars)
    new = {"text": F.col("__kept.text"), "n_chars": F.length("__kept.text").cast("long")}
    return out.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])
