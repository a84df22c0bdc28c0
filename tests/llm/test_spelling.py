"""Spelling variants against brute force: words counted one by one, near words found by deleting code points."""

import collections
import random
import re
import zlib

import pytest

from stratum.llm import queries, spelling
from stratum.llm.common import load

SF = "/root/testdata/sf0.001"
RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_counts(rows, min_count=3):
    n = collections.Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            word = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 97 == 0:
                k = h % len(word)
                word = word[:k] + word[k + 1:]
            n[word] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= min_count}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute_near(words):
    """Words that share a form with one code point deleted (or are one), checked pair by pair."""
    spots, near = collections.defaultdict(set), collections.defaultdict(set)
    for w in words:
        for x in {w, *(w[:k] + w[k + 1:] for k in range(len(w)))}:
            spots[x].add(w)
    for own in spots.values():
        for a in own:
            near[a] |= {b for b in own if one_edit(a, b)}
    return near


def brute(n):
    near, form = brute_near(n), {}
    for w, k in n.items():
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * k else None
    out = []
    for w, k in n.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, k, len(near[w]), n.get(form[w])))
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_whole_table_matches_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in load(spark, SF, "documents").collect()]
    want = brute(brute_counts(rows))
    assert result(queries.op13_spelling_variant_grouping(spark, SF)) == want
    assert sum(r[4] for r in want) > 100 and any(r[1] and r[1] != r[2] for r in want)


def test_awkward_rows(spark):
    rng = random.Random(3)
    long = "".join(rng.choice("abcdeé") for _ in range(3000))
    rows = [(1, None), (2, ""), (3, " 1 \n"), (None, "Größe größe GRÖßE GROssE naïve naive naives"), (None, None)]
    rows += [(k, f"Center centre CENTRE centres centrex {long} {long[1:]} x{long} {long[:70]} {long[:69]} ×÷×÷×") for k in range(5, 9)]
    rows += [(9, "hello " * 40 + "hallo " * 9 + "hullo " * 4 + "hell-o helloo helloo helloo"), (9, "hello " * 40), (10, "x" * 200_000)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, n int")
    out = result(spelling.variants(df))
    assert out == brute(brute_counts(rows)) and len(out) > 10


@pytest.mark.parametrize("frequent,list_size,alphabet", [(0, 1024, "ab"), (3, 4, "ab"), (1000, 7, "abc"), (10, 64, "aéß")])
def test_near_words_lose_no_pair(spark, frequent, list_size, alphabet):
    rng = random.Random(frequent + list_size)
    words = set()
    while len(words) < 900:
        base = "".join(rng.choice(alphabet) for _ in range(rng.choice((5, 6, 7, 9, 12, 63, 64, 65, 66, 67, 90))))
        words.add(base)
        k = rng.randrange(len(base) + 1)
        words |= {x for x in (base[:k] + base[k + 1:], base[:k] + rng.choice(alphabet) + base[k:],
                              base[:k] + rng.choice(alphabet) + base[k + 1:]) if len(x) >= 5}
    df = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    got = collections.defaultdict(set)
    for r in spelling.near_words(df, frequent, list_size).collect():
        assert r["near"] not in got[r["word"]]
        got[r["word"]].add(r["near"])
    want = {w: x for w, x in brute_near(words).items() if x}
    assert {w: x for w, x in got.items() if x} == want


def test_an_edit_changes_only_grams_that_touch_it():
    rng = random.Random(8)
    for _ in range(300):
        word = "".join(rng.choice("abc") for _ in range(rng.randint(5, 12)))
        extended = {p: q for p in range(len(word) + 1) if (q := rng.choice((0, 2, 3, 4))) and p + q <= len(word) + 2}
        grams = spelling.decompose(word, extended)
        assert len(grams) - spelling.affected(grams, len(word) + 2) >= 1
        assert all(2 <= q <= 5 and p + q <= len(word) + 2 for p, q in grams.items())


def test_roots_of_a_long_chain(spark):
    chain = [(f"w{k:02d}", f"w{k + 1:02d}") for k in range(60)]
    out = {r["word"]: r["root"] for r in spelling.roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert out == {w: "w60" for w, _ in chain}


def test_short_words_and_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(empty).count() == 0
    with pytest.raises(ValueError):
        spelling.variants(empty, min_chars=4)
