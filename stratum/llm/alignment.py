"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

A text is encoded by tokenizer A (a byte-level BPE file) and by tokenizer B (a SentencePiece model, which puts a space
before the text; A gets it too). Tokens of A and B overlap when their byte ranges do; the connected components of
that relation are the groups.

1. Pointer jumping (``terminals``): every token points to its farthest-right overlapping token, that is to the token of
   the other side that holds its last byte, and a token of B that ends where a token of A ends points to itself. Squaring
   the successor array (``to = to[to]``) doubles the jumps of all tokens at once until nothing moves: after as many rounds
   as the logarithm of the longest chain every token has its component's terminal token as its label.
2. A task works on blocks of about ``BLOCK_BYTES`` of text (a longer text is a block of its own). Both tokenizers only
   ever look at one stretch between "a character that is no blank, then a space" at a time (``Tokenizers.splits`` says
   whether the two files allow that; else a stretch is the whole text), so each distinct stretch of a block is encoded
   and aligned once.
3. A block is written as one row: its documents' digests, the distinct id pairs that it links with the number of its
   documents that hold each (pre-aggregated counts), and every document's links as places in that list.
4. The pairs' counts over all documents are an aggregate over the blocks' lists, and so is the highest count of every A
   id. They go back to the blocks by a join on the pair: a pair travels once per block, not once per link.

Defined results: every row is one document, also repeated rows and rows without a doc_id. Null and empty texts, and
texts whose tokens do not spell space+text (U+2581 inside a text, for example), have no tokens: zeros and ''. Other
columns of the input do not matter. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, text_buffer, tokenizer_path, written
from .packing import _byte_letters, encoder

BLOCK_BYTES = 4 << 20
SPACE = "▁"
# last bytes of the UTF-8 forms of blanks beyond ASCII, by the bytes before them; a space after one of these
# characters, or after any other character that starts alike, does not end a stretch
BLANK_LEADS = {(0xC2,), (0xE1, 0x9A), (0xE2, 0x80), (0xE2, 0x81), (0xE3, 0x80)}


class Side(NamedTuple):
    """The bytes of every token of one tokenizer: ``data[first[i]:first[i + 1]]``."""
    data: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, tokens: list[bytes]) -> Side:
        return cls(np.frombuffer(b"".join(tokens), np.uint8),
                   np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int64))

    def sizes(self, ids: np.ndarray) -> np.ndarray:
        return self.first[ids + 1] - self.first[ids]

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        return self.data[ragged(self.first[ids], self.sizes(ids))]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices ``starts[0], starts[0] + 1, ...`` (``lengths[0]`` of them), then those of ``starts[1]``, and so on."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total, dtype=np.int64)


class Tokenizers(NamedTuple):
    encode_a: object     # list of texts -> list of id lists, the text as it is
    encode_b: object     # the same, a space put before each text
    a: Side
    b: Side
    digits: np.ndarray   # row i: the decimal digits of i, left-aligned
    n_digits: np.ndarray
    splits: bool         # both encode a stretch that starts with a space after a non-blank alone as within its text


@functools.lru_cache(maxsize=2)
def tokenizers(path_a: str, path_b: str) -> Tokenizers:
    import json

    import sentencepiece
    with open(path_a, encoding="utf-8") as f:
        spec = json.load(f)
    vocab, letters = spec["model"]["vocab"], _byte_letters()
    special = {t["id"] for t in spec.get("added_tokens", [])}
    of_a = [b""] * (1 + max([*vocab.values(), *special]))
    for token, i in vocab.items():
        if i not in special:
            of_a[i] = bytes(letters[c] for c in token)
    model = sentencepiece.SentencePieceProcessor(model_file=path_b)
    of_b = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            of_b.append(bytes([int(piece[3:5], 16)]))
        else:
            of_b.append(b"" if model.is_control(i) else piece.replace(SPACE, " ").encode("utf-8"))
    ids = np.arange(max(len(of_a), len(of_b)))
    n_digits = np.array([len(str(i)) for i in ids])
    digits = np.zeros((len(ids), int(n_digits.max()) + 1), dtype=np.uint8)
    for i in ids:
        digits[i, :n_digits[i]] = np.frombuffer(str(i).encode(), np.uint8)
    one = encoder(path_a, special_as_text=True)
    pre = spec.get("pre_tokenizer") or {}
    splits = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not spec.get("normalizer")
              and not any(re.search(f"[^{SPACE}]{SPACE}", model.id_to_piece(i)) for i in range(model.get_piece_size())))
    return Tokenizers(lambda texts: [one(t) for t in texts], lambda texts: model.encode(texts, num_threads=1),
                      Side.of(of_a), Side.of(of_b), digits, n_digits, splits)


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(itertools.chain.from_iterable(lists), np.int64, int(counts.sum())), counts


def _encoded_a(texts: list[str], tok: Tokenizers) -> tuple[np.ndarray, np.ndarray]:
    """A's ids of all texts one after the other, and how many each text has. Where stretches split, those that end with
    no blank can follow each other in one call without a token across their border."""
    if not tok.splits:
        return _flat(tok.encode_a(texts))
    joins = np.fromiter((not t[-1:].isspace() for t in texts), bool, len(texts))
    together = [t for t, j in zip(texts, joins, strict=True) if j]
    apart, n_apart = _flat(tok.encode_a([t for t, j in zip(texts, joins, strict=True) if not j]))
    ids = np.array(tok.encode_a(["".join(together)])[0], dtype=np.int64)
    borders = np.cumsum(np.fromiter((len(t.encode()) for t in together), np.int64, len(together)))
    upto = np.searchsorted(np.cumsum(tok.a.sizes(ids)), borders, side="right")
    counts = np.empty(len(texts), dtype=np.int64)
    counts[joins], counts[~joins] = np.diff(upto, prepend=0), n_apart
    first = np.cumsum(counts) - counts
    out = np.empty(int(counts.sum()), dtype=np.int64)
    out[ragged(first[joins], counts[joins])] = ids
    out[ragged(first[~joins], n_apart)] = apart
    return out, counts


def terminals(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """The label of every token, A's first, then B's: the index of its component's terminal token, by pointer jumping.

    ``ends_a`` and ``ends_b`` are the rising byte offsets at which tokens end; both sides cover the same bytes."""
    n = len(ends_a)
    over_a = np.searchsorted(ends_b, ends_a)        # the token of B that holds the last byte of a token of A
    over_b = np.searchsorted(ends_a, ends_b)
    to = np.concatenate([n + over_a, np.where(ends_a[over_b] > ends_b, over_b, n + np.arange(len(ends_b)))]) \
        if n else np.zeros(0, np.int64)
    while True:
        further = to[to]
        if np.array_equal(further, to):
            return to
        to = further


class Aligned(NamedTuple):
    """Texts aligned one by one; a text whose tokens do not spell it has ``ok`` False and nothing else."""
    ok: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    written: list[bytes]      # `a1,a2|b1;` of all groups
    link_first: np.ndarray    # text i's links are ``link_pair[link_first[i]:link_first[i + 1]]``
    link_pair: np.ndarray     # id of A * number of ids of B + id of B


def align(texts: list[str], tok: Tokenizers) -> Aligned:
    """``texts`` start with a space; A encodes them as they are, B without that space, which it puts there itself."""
    ids_a, count_a = _encoded_a(texts, tok)
    ids_b, count_b = _flat(tok.encode_b([t[1:] for t in texts]))
    n = len(texts)
    raw, first = text_buffer(pa.array(texts, pa.large_string()))
    size_a, size_b = tok.a.sizes(ids_a), tok.b.sizes(ids_b)
    of_a, of_b = np.repeat(np.arange(n), count_a), np.repeat(np.arange(n), count_b)
    total = np.diff(first)
    ok = ((np.bincount(of_a, size_a, n).astype(np.int64) == total)
          & (np.bincount(of_b, size_b, n).astype(np.int64) == total))
    fits = np.repeat(ok, total)
    where = np.repeat(np.arange(n), total)[fits]
    for side, ids, of in ((tok.a, ids_a, of_a), (tok.b, ids_b, of_b)):
        ok[where[side.spelled(ids[ok[of]]) != raw[fits]]] = False
        fits = np.repeat(ok, total)
        where = np.repeat(np.arange(n), total)[fits]
    keep_a, keep_b = ok[of_a], ok[of_b]
    ids_a, of_a, ends_a = ids_a[keep_a], of_a[keep_a], np.cumsum(size_a[keep_a])
    ids_b, of_b, ends_b = ids_b[keep_b], of_b[keep_b], np.cumsum(size_b[keep_b])
    label = terminals(ends_a, ends_b)
    last = np.flatnonzero(label == np.arange(len(label)))                 # one terminal per group, in byte order
    group_a, group_b = np.searchsorted(last, label[:len(ids_a)]), np.searchsorted(last, label[len(ids_a):])
    n_groups = np.bincount(of_b[last - len(ids_a)], minlength=n)

    # groups written out: place every token, then let its digits and its separator follow each other
    of_group_a, of_group_b = np.bincount(group_a, minlength=len(last)), np.bincount(group_b, minlength=len(last))
    before_b = np.cumsum(of_group_b) - of_group_b
    place_a = np.arange(len(ids_a)) + before_b[group_a]
    place_b = np.arange(len(ids_b)) + np.cumsum(of_group_a)[group_b]
    ids = np.empty(len(ids_a) + len(ids_b), dtype=np.int64)
    mark = np.full(len(ids), ord(","), dtype=np.uint8)
    ids[place_a], ids[place_b] = ids_a, ids_b
    mark[place_a[np.flatnonzero(np.diff(group_a, append=-1))]] = ord("|")
    mark[place_b[np.flatnonzero(np.diff(group_b, append=-1))]] = ord(";")
    wide = tok.n_digits[ids]
    letters = tok.digits[ids]
    letters[np.arange(len(ids)), wide] = mark
    out = letters[np.arange(letters.shape[1]) <= wide[:, None]].tobytes()
    of_token = np.empty(len(ids), dtype=np.int64)
    of_token[place_a], of_token[place_b] = of_a, of_b
    ends = np.cumsum(np.bincount(of_token, wide + 1, n).astype(np.int64)).tolist()
    texts_out = [out[s:e] for s, e in zip([0, *ends], ends)]

    # links: between two neighbouring offsets at which any token ends, one token of A meets one of B
    cuts = np.union1d(ends_a, ends_b)
    pair = ids_a[np.searchsorted(ends_a, cuts)] * (len(tok.b.first) - 1) + ids_b[np.searchsorted(ends_b, cuts)]
    n_links = np.bincount(of_a[np.searchsorted(ends_a, cuts)], minlength=n)
    return Aligned(ok, np.bincount(of_a, minlength=n), np.bincount(of_b, minlength=n), n_groups, texts_out,
                   np.concatenate([[0], np.cumsum(n_links)]), pair)


def stretches(raw: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where the stretches of the texts ``raw[first[i]:first[i + 1]]`` start: at each text's start, and at each space
    after a character that surely is no blank, unless the space is its text's last character."""
    space = np.flatnonzero(raw == 0x20)
    last = np.zeros(len(raw) + 1, dtype=bool)
    last[first[1:] - 1] = True
    start = np.zeros(len(raw) + 1, dtype=bool)
    start[first] = True
    space = space[(space > 2) & ~last[space]]
    b1, b2, b3 = raw[space - 1], raw[space - 2], raw[space - 3]
    blank = np.zeros(len(space), dtype=bool)
    for lead in BLANK_LEADS:
        blank |= (b2 == lead[0]) if len(lead) == 1 else (b3 == lead[0]) & (b2 == lead[1])
    ends_word = ((b1 > 0x20) & (b1 < 0x7F)) | ((b1 >= 0x80) & ~blank)
    start[space[ends_word]] = True
    return np.flatnonzero(start[:-1])


def _packed(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(x.astype("<u4").tobytes() for x in arrays))


def _unpacked(data: bytes, n: int) -> list[np.ndarray]:
    whole = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "<u4").astype(np.int64)
    return [whole[:n], *np.split(whole[n:], 2)]


class Block(NamedTuple):
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    sha: list[str]
    pairs: np.ndarray      # the distinct pairs of the block
    holds: np.ndarray      # how many of its documents hold each
    links: bytes           # per document: number of its distinct pairs; then their places (as differences) and their links


def block_of(texts: list[str | None], tok: Tokenizers) -> Block:
    n = len(texts)
    raw, first = text_buffer(pa.array([" " + t if t else None for t in texts], pa.large_string()))
    has = np.diff(first) > 0
    at = stretches(raw, first) if tok.splits else first[:-1][has]
    words = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(np.append(at, len(raw)).astype(np.int64)),
                                             pa.py_buffer(raw)).dictionary_encode()
    word, distinct = words.indices.to_numpy().astype(np.int64), words.dictionary.to_pylist()
    al = align(distinct, tok)
    doc = np.searchsorted(first, at, side="right") - 1      # empty texts have no stretch
    whole = np.bincount(doc, ~al.ok[word], n) == 0
    word, doc = word[whole[doc]], doc[whole[doc]]
    totals = [np.bincount(doc, x[word], n).astype(np.int64)
              for x in (al.n_a, al.n_b, al.n_groups, np.diff(al.link_first))]
    bounds, sha = np.searchsorted(doc, np.arange(n + 1)), []
    for s, e in zip(bounds, bounds[1:]):
        text = b"".join(map(al.written.__getitem__, word[s:e].tolist()))[:-1]
        sha.append(hashlib.sha256(text).hexdigest() if text else "")
    held, times = np.unique(doc * max(len(distinct), 1) + word, return_counts=True)     # distinct stretches of a document
    doc, word = np.divmod(held, max(len(distinct), 1))
    size = np.diff(al.link_first)[word]
    pairs, local = np.unique(al.link_pair, return_inverse=True)
    key = np.repeat(doc, size) * max(len(pairs), 1) + local[ragged(al.link_first[word], size)]
    order = np.argsort(key, kind="stable")
    key, weight = key[order], np.repeat(times, size)[order]
    new = np.flatnonzero(np.diff(key, prepend=-1))
    weight = np.add.reduceat(weight, new) if len(new) else weight
    doc, place = np.divmod(key[new], max(len(pairs), 1))
    holds = np.bincount(place, minlength=len(pairs))
    seen = holds > 0                                          # pairs of texts that do not count have no holder
    place = (np.cumsum(seen) - 1)[place]
    step = np.diff(place, prepend=0)
    per_doc = np.bincount(doc, minlength=n)
    heads = (np.cumsum(per_doc) - per_doc)[per_doc > 0]
    step[heads] = place[heads]
    return Block(*totals, sha, pairs[seen], holds[seen], _packed(per_doc, step, weight))


DOC = "doc_id:long,n_a:long,n_b:long,n_groups:long,n_links:long,groups_sha256:string"
BLOCK = f"block long, docs array<struct<{DOC}>>, pairs array<long>, holds array<long>, links binary"


def _blocks(path_a: str, path_b: str, block_bytes: int):
    def run(batches):
        tok, task, made = tokenizers(path_a, path_b), TaskContext.get().partitionId(), 0
        ids, texts, size = [], [], 0

        def row():
            b = block_of(texts, tok)
            docs = [dict(zip(("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"), d))
                    for d in zip(ids, *(x.tolist() for x in (b.n_a, b.n_b, b.n_groups, b.n_links)), b.sha, strict=True)]
            kind = pa.list_(pa.struct([(k, pa.int64()) for k in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
                                      + [("groups_sha256", pa.string())]))
            one = lambda x: pa.array([x], pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays(
                [pa.array([(task << 32) + made], pa.int64()), pa.array([docs], kind), one(b.pairs), one(b.holds),
                 pa.array([b.links], pa.binary())], names=["block", "docs", "pairs", "holds", "links"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                more = len(text or "")
                if ids and size + more > block_bytes:
                    yield row()
                    ids, texts, size, made = [], [], 0, made + 1
                ids.append(doc_id)
                texts.append(text)
                size += more
        if ids:
            yield row()
    return run


def _summed(batches):
    for batch in batches:
        for docs, links, found in zip(*(batch.column(n) for n in ("docs", "links", "found")), strict=True):
            docs = docs.as_py()
            per_doc, step, weight = _unpacked(links.as_py(), len(docs))
            count, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
            if found.is_valid:
                place, value = (found.values.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
                order = np.argsort(place)
                count, best = value[order] >> 1, value[order] & 1
            doc = np.repeat(np.arange(len(docs)), per_doc)
            upto = np.cumsum(step)
            heads = (np.cumsum(per_doc) - per_doc)[per_doc > 0]
            at = upto - np.repeat((upto[heads] - step[heads]), per_doc[per_doc > 0])
            sums = np.zeros((2, len(docs)), dtype=np.int64)
            np.add.at(sums[0], doc, weight * best[at])
            np.add.at(sums[1], doc, weight * count[at])
            cols = {k: pa.array([d[k] for d in docs], pa.string() if k == "groups_sha256" else pa.int64())
                    for k in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
            cols |= {"n_best": pa.array(sums[0]), "count_sum": pa.array(sums[1])}
            yield pa.RecordBatch.from_arrays([cols[k] for k in COLUMNS], names=list(COLUMNS))


COLUMNS = {"doc_id": "long", "n_a": "long", "n_b": "long", "n_groups": "long", "n_links": "long", "n_best": "long",
           "count_sum": "long", "groups_sha256": "string"}


def blocks(docs: DataFrame, path_a: str, path_b: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    return map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), _blocks(path_a, path_b, block_bytes), BLOCK)


def pair_counts(table: DataFrame, size_b: int) -> DataFrame:
    """(pair, n, best): how many documents hold an id pair linked, and whether no pair of its A id is held by more."""
    pairs = (table.select(F.explode(F.arrays_zip("pairs", "holds")).alias("p"))
             .groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.holds").alias("n")))
    of_a = Window.partitionBy(F.expr(f"pair div {size_b}"))          # at most as many rows as B has ids
    return pairs.withColumn("best", F.col("n") == F.max("n").over(of_a))


def alignments(docs: DataFrame, path_a: str | None = None, path_b: str | None = None,
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``COLUMNS``."""
    import sentencepiece
    path_a, path_b = path_a or tokenizer_path(), path_b or tokenizer_path("piece_bpe_32k.model")
    size_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    table = written(blocks(docs, path_a, path_b, block_bytes), "blocks")
    counts = written(pair_counts(table, size_b), "pairs")
    wanted = table.select("block", F.posexplode("pairs").alias("place", "pair"))
    found = (wanted.join(counts, "pair")
             .groupBy("block").agg(F.collect_list(F.struct(
                 "place", (F.col("n") * 2 + F.col("best").cast("long")).alias("value"))).alias("found")))
    whole = table.select("block", "docs", "links").join(found, "block", "left").drop("block")
    return map_arrow(whole, _summed, ", ".join(f"{k} {t}" for k, t in COLUMNS.items()))
