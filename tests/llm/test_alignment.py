"""Cross-tokenizer alignment against a brute-force version that encodes whole texts and joins tokens with a union-find."""

import collections
import hashlib

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from stratum.llm import alignment, queries
from stratum.llm.common import load, tokenizer_path
from stratum.llm.packing import _byte_letters

SF = "/root/testdata/sf0.001"
A, B = tokenizer_path(), tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def files():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    letters = _byte_letters()
    bytes_a = {i: bytes(letters.get(c, 0) for c in t) for t, i in a.get_vocab().items()}
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    bytes_b = {i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
               for i in range(b.get_piece_size())}
    return a, bytes_a, b, bytes_b


def tokens_of(text, files):
    a, bytes_a, b, bytes_b = files
    if not text:
        return None
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    whole = (" " + text).encode()
    if b"".join(bytes_a[i] for i in ids_a) != whole or b"".join(bytes_b[i] for i in ids_b) != whole:
        return None
    spans = []
    for ids, of in ((ids_a, bytes_a), (ids_b, bytes_b)):
        at, own = 0, []
        for i in ids:
            own.append((i, at, at + len(of[i])))
            at += len(of[i])
        spans.append(own)
    return spans


def brute(rows, files):
    parsed = []
    for doc_id, text in rows:
        spans = tokens_of(text, files)
        if spans is None:
            parsed.append((doc_id, 0, 0, 0, [], ""))
            continue
        sa, sb = spans
        parent = list(range(len(sa) + len(sb)))

        def find(x, parent=parent):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        links, j = [], 0
        for i, (_, s, e) in enumerate(sa):
            while sb[j][2] <= s:
                j += 1
            k = j
            while k < len(sb) and sb[k][1] < e:
                links.append((sa[i][0], sb[k][0]))
                parent[find(i)] = find(len(sa) + k)
                k += 1
        groups = collections.OrderedDict()
        for i in range(len(sa)):
            groups.setdefault(find(i), ([], []))[0].append(str(sa[i][0]))
        for k in range(len(sb)):
            groups[find(len(sa) + k)][1].append(str(sb[k][0]))
        text_out = ";".join(",".join(x) + "|" + ",".join(y) for x, y in groups.values())
        parsed.append((doc_id, len(sa), len(sb), len(groups), links, hashlib.sha256(text_out.encode()).hexdigest()))
    count = collections.Counter(p for *_, links, _ in parsed for p in set(links))
    most = collections.Counter()
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    return sorted(((d, na, nb, ng, len(links), sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links), sha)
                   for d, na, nb, ng, links, sha in parsed), key=str)


def result(df):
    return sorted((tuple(r) for r in df.select(*alignment.COLUMNS).collect()), key=str)


def test_terminals_label_components():
    rng = np.random.default_rng(5)
    for _ in range(200):
        length = int(rng.integers(1, 60))
        sides = [np.append(np.flatnonzero(rng.random(length - 1) < p) + 1, length) for p in rng.random(2)]
        label = alignment.terminals(*sides)
        common = np.intersect1d(*sides)
        for side, own in zip(sides, np.split(label, [len(sides[0])])):
            groups = np.searchsorted(common, side)             # tokens between the same two common offsets
            assert [sides[1][x - len(sides[0])] for x in own] == common[groups].tolist()


def test_a_long_chain_converges():
    n = 100_000        # every token overlaps two of the other side: one component
    a, b = np.append(np.arange(2, 2 * n, 2), 2 * n), np.append(np.arange(1, 2 * n, 2), 2 * n)
    assert len(set(alignment.terminals(a, b).tolist())) == 1


AWKWARD = [(1, None), (2, ""), (3, " \n\t"), (4, "word"), (4, "word"), (None, "a text without an id"), (None, None),
           (5, "é 日本語 ü 😀 naïve\n" * 3), (6, "a ▁ b"), (7, "<|endoftext|> and <s> </s> <unk> <0x41>"), (8, "ends with a space "),
           (9, "  two  spaces   three　wide   nbsp  em  "), (10, "x\n y\n  z\t q \r\n  "), (11, "x" * 50_000),
           (12, "\n" * 60_000 + " end"), (13, "don't we'll I'M 12,345.67 ﬁne é"), (14, " "), (15, "  "), (16, "\x00 nul \x1c sep")]


def test_awkward_rows_match_brute_force(spark, files):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in AWKWARD], "doc_id long, text string, n_a int, pair string")
    assert result(alignment.alignments(df)) == brute(AWKWARD, files)
    assert result(alignment.alignments(df, block_bytes=20)) == brute(AWKWARD, files)      # many blocks


def test_whole_table_matches_brute_force(spark, files):
    rows = [(r["doc_id"], r["text"]) for r in load(spark, SF, "documents").collect()]
    out = queries.op11_cross_tokenizer_alignment(spark, SF)
    assert [f"{n} {t}" for n, t in out.dtypes] == [f"{k} {'bigint' if t == 'long' else t}" for k, t in alignment.COLUMNS.items()]
    assert result(out) == brute(rows, files)


def test_stretches_do_not_change_results(files):
    tok = alignment.tokenizers(A, B)
    assert tok.splits
    texts = [t for _, t in AWKWARD if t]
    whole = alignment.block_of(texts, tok._replace(splits=False))
    parts = alignment.block_of(texts, tok)
    for x, y in zip(whole, parts):
        assert np.array_equal(x, y) if isinstance(x, np.ndarray) else x == y


def test_empty_table(spark):
    assert alignment.alignments(spark.createDataFrame([], "doc_id long, text string")).count() == 0
