"""Best-fit packing: tokenised documents in as few sequences of fixed length as best-fit decreasing makes.

1. Each task tokenises its documents and cuts the longer ones into pieces of exactly ``capacity`` tokens
   (the first piece takes the remainder). Pieces are written to shared storage with the task's number and
   the piece's rank among the task's pieces of the same length.
2. Best-fit decreasing over all pieces needs only how many pieces there are of each length: at most
   ``capacity`` counts. A segment tree over the remaining capacities 0..capacity holds which of them have
   open sequences and finds the tightest that fits in logarithmic time; equal pieces and equal sequences
   are placed as one run. The plan is a list of runs whose number depends on ``capacity``, not on the
   number of pieces.
3. A piece's place follows from its length and its rank among all pieces of that length: the counts per
   task give each task's first rank, so no group of equal lengths is ever sorted or put together.

Defined results: a null or empty text is the single end token. Texts of millions of blanks, line breaks or letters have
the ids of the tokenizers library. Every row is packed, also repeated rows and
rows without a doc_id. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import json
import re
import zlib
from collections import defaultdict, deque
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, written

CAPACITY = 1024
END_TOKEN = 2
SAFE_BLANKS = 20_000           # characters of one run of blanks that tiktoken is given
LONG_BLANKS = re.compile(r"(?<!\s)\s{%d}" % SAFE_BLANKS)


# --- tokens -----------------------------------------------------------------------------------------

def _byte_letters() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies write for the 256 byte values."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, n = {chr(b): b for b in plain}, 0
    for b in range(256):
        if b not in plain:
            letters[chr(256 + n)] = b
            n += 1
    return letters


def has_long_blank_run(text: str) -> bool:
    """A run of blanks that tiktoken's pattern matcher may not survive: it backtracks over the run, one stack frame a
    character, and a run of a million ends the process."""
    return len(text) > SAFE_BLANKS and LONG_BLANKS.search(text) is not None


@functools.lru_cache(maxsize=4)
def encoder(path: str, special_as_text: bool = False):
    """A function from a text to its ids under the tokenizer file at ``path`` (special tokens not added).

    A plain byte-level BPE file is run by tiktoken, which gives the same ids several times faster: there
    a token's id is its merge rank. Texts with a very long run of blanks, texts that hold the string of a special
    token (unless ``special_as_text``), and any other kind of file, go to the tokenizers library."""
    from tokenizers import Tokenizer
    slow = Tokenizer.from_file(path)
    slow.encode_special_tokens = special_as_text
    by_file = lambda text: slow.encode(text, add_special_tokens=False).ids
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
    letters = _byte_letters()
    special = [t["content"] for t in spec.get("added_tokens", [])]
    apart = [] if special_as_text else special
    plain = {t: i for t, i in model.get("vocab", {}).items() if t not in special} if model["type"] == "BPE" else {}
    if (pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or pre.get("use_regex") is False
            or spec.get("normalizer") or model.get("dropout") or model.get("ignore_merges") or not plain
            or any(c not in letters for t in plain for c in t)
            or sorted(plain.values()) != list(range(len(plain)))):
        return by_file
    import tiktoken
    ranks = {bytes(letters[c] for c in t): i for t, i in plain.items()}
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # of byte-level BPE
    fast = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return lambda text: (by_file(text) if any(s in text for s in apart) or has_long_blank_run(text)
                         else fast.encode_ordinary(text))


def cut(n_ids: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n_ids`` ids: full ones, the remainder first."""
    if n_ids <= capacity:
        return [(0, n_ids)]
    first = n_ids % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n_ids, capacity)]


def _pieces(path: str, capacity: int, end: int, keep_ids: bool):
    def run(batches):
        encode, task = encoder(path), TaskContext.get().partitionId()
        ranks = np.zeros(capacity + 1, dtype=np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                out = defaultdict(list)
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    ids = np.array([*encode(text or ""), end], dtype="<u4")
                    for k, (start, length) in enumerate(cut(len(ids), capacity)):
                        own = ids[start:start + length]
                        for name, value in (("doc_id", doc_id), ("piece", k), ("start", start), ("length", length),
                                            ("ids_crc32", zlib.crc32(own.tobytes())), ("task", task),
                                            ("rank", int(ranks[length]))):
                            out[name].append(value)
                        if keep_ids:
                            out["ids"].append(own.astype(np.int32))
                        ranks[length] += 1
                kinds = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(),
                         "ids_crc32": pa.int64(), "task": pa.int32(), "rank": pa.int64()}
                if keep_ids:
                    kinds["ids"] = pa.list_(pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(out[n], t) for n, t in kinds.items()], names=list(kinds))
    return run


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END_TOKEN,
           keep_ids: bool = False) -> DataFrame:
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, rank long"
    return map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), _pieces(path, capacity, end, keep_ids),
                     schema + ", ids array<int>" * keep_ids)


# --- the plan ---------------------------------------------------------------------------------------

class OpenCapacities:
    """Segment tree over the remaining capacities 0..n: which of them have open sequences."""

    def __init__(self, n: int):
        self.size = 1 << n.bit_length()
        self.tree = [False] * (2 * self.size)

    def set(self, capacity: int, is_open: bool) -> None:
        k = self.size + capacity
        self.tree[k] = is_open
        while k > 1:
            k //= 2
            self.tree[k] = self.tree[2 * k] or self.tree[2 * k + 1]

    def tightest(self, need: int) -> int | None:
        """The smallest open capacity that is at least ``need``."""
        k = self.size + need
        if self.tree[k]:
            return need
        while k > 1:                       # up, to the first right sibling that holds an open capacity
            if k % 2 == 0 and self.tree[k + 1]:
                k += 1
                break
            k //= 2
        else:
            return None
        while k < self.size:               # down to its leftmost open leaf
            k = 2 * k if self.tree[2 * k] else 2 * k + 1
        return k - self.size


class Run(NamedTuple):
    """Pieces ``first .. first + n - 1`` of one length: ``per`` to a sequence, from sequence ``sequence``."""
    length: int
    first: int
    n: int
    per: int
    sequence: int
    offset: int


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> tuple[list[Run], int]:
    """The runs that best-fit decreasing makes of ``counts[length]`` pieces, and the number of sequences.

    Equal pieces that meet an open sequence fill it before the next one is opened, as its remainder is then
    the tightest; so whole groups of sequences with one remainder are filled at a time."""
    open_at: dict[int, deque[tuple[int, int]]] = defaultdict(deque)   # remainder -> (first sequence, how many)
    tree, runs, used = OpenCapacities(capacity), [], 0
    for length in sorted(counts, reverse=True):
        left, first = counts[length], 0
        made: list[tuple[int, int, int]] = []
        while left:
            room = tree.tightest(length)
            if room is None:
                per = capacity // length
                group = (used, -(-left // per))
                used += group[1]
                room = capacity
            else:
                group = open_at[room].popleft()
                if not open_at[room]:
                    tree.set(room, False)
                per = room // length
            n = min(left, per * group[1])
            runs.append(Run(length, first, n, per, group[0], capacity - room))
            full, rest = divmod(n, per)
            made.append((room - per * length, group[0], full))
            if rest:
                made.append((room - rest * length, group[0] + full, 1))
            if (spare := group[1] - full - bool(rest)) > 0:
                made.append((room, group[0] + full + bool(rest), spare))
            left, first = left - n, first + n
        for room, sequence, n in made:      # what these pieces leave open, for shorter pieces
            if n and room:
                open_at[room].append((sequence, n))
                tree.set(room, True)
    return runs, used


class Places(NamedTuple):
    """Runs as arrays, sorted by length and first rank: a piece finds its run by binary search."""
    key: np.ndarray
    per: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, runs: list[Run]) -> Places:
        runs = sorted(runs)
        col = lambda f: np.array([f(r) for r in runs], dtype=np.int64)
        return cls(col(lambda r: r.length) * (1 << 48) + col(lambda r: r.first), col(lambda r: r.per),
                   col(lambda r: r.sequence), col(lambda r: r.offset), col(lambda r: r.first))

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k = np.searchsorted(self.key, length * (1 << 48) + rank, side="right") - 1
        step, within = np.divmod(rank - self.first[k], self.per[k])
        return self.sequence[k] + step, self.offset[k] + within * length


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END_TOKEN,
         keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids]) of every piece."""
    if capacity >= 1 << 15:
        raise ValueError("capacity must be below 32768")
    table = written(pieces(docs, path, capacity, end, keep_ids), "pieces")
    per_task = written(table.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "lengths")
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = docs.sparkSession.sparkContext.broadcast(Places.of(best_fit_decreasing(counts, capacity)[0]))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = per_task.select(F.col("length").alias("l"), F.col("task").alias("t"),
                           F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = (table.join(base, (table["length"] == base["l"]) & (table["task"] == base["t"]))
              .withColumn("rank", F.col("rank") + F.col("base")).drop("l", "t", "base", "task"))

    def place(batches):
        for b in batches:
            length, rank = (b.column(n).to_numpy(zero_copy_only=False) for n in ("length", "rank"))
            sequence, offset = places.value.find(length, rank)
            cols = {n: b.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")}
            cols |= {"sequence_id": pa.array(sequence, pa.int64()), "offset": pa.array(offset, pa.int64())}
            if keep_ids:
                cols["ids"] = b.column("ids")
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return map_arrow(ranked, place, schema + ", ids array<int>" * keep_ids)
