"""Quality rules with cross-document line frequency against brute force, the SQL oracle and planted boilerplate."""

import collections
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from stratum.llm import line_frequency, queries

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", "abcdefghijklmnopqrstuvwxyz000000000")
COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_lines",
           "n_removed", "chars_removed", "kept"]


def key(line):
    return re.sub(r"[\x20\x09-\x0D]+", " ", line.translate(LOWER)).strip(" ")


def brute(rows, min_texts, share, lost):
    """rows of (doc_id, text, host)"""
    lines_of = lambda t: [x for x in (t or "").split("\n") if WORD.search(x)]
    held, texts = collections.defaultdict(set), collections.defaultdict(set)
    for _, text, host in rows:
        texts[host].add(text or "")
        for x in lines_of(text):
            held[host, key(x)].add(text or "")
    out = []
    for doc_id, text, host in rows:
        words, lines = WORD.findall(text or ""), lines_of(text)
        windows = list(zip(words, words[1:], words[2:]))
        times = collections.Counter(windows)
        repeated = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
        gone = [x for x in lines if (n := len(held[host, key(x)])) > min_texts and n > share * len(texts[host])]
        chars = sum(len("".join(WORD.findall(x))) for x in gone)
        total = len("".join(words))
        failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
        out.append((doc_id, len(words), total, sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
                    len(repeated), failed, len(lines), len(gone), chars, not failed and chars <= lost * total))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def filler(seed, n=60):
    return " ".join(f"w{seed}x{i}" for i in range(n))


BOILER = "Follow US on  Channel 7 |\tterms & conditions " * 4
ROWS = ([(i, f"{BOILER.strip()}\n{filler(chr(97 + i), 5)}", "a") for i in range(6)]                        # short and depleted
        + [(20 + i, f"{filler(chr(97 + i))}\n{BOILER.upper().replace('7', str(i))}\n", "a") for i in range(6)]   # loses one line
        + [(40 + i, BOILER, "b") for i in range(6)]                              # copies of one text: not frequent
        + [(50 + i, f"{BOILER}\n{filler('z', 60)}", None) for i in range(2)]
        + [(60, None, "a"), (61, "", None), (62, " \n\t\n", "b"), (62, " \n\t\n", "b"), (None, filler("n"), "c"),
           (63, "a b c " * 40, "c"), (64, filler("q") + " a b c a b c", "c"), (65, "a a a a a", "c"),
           (66, "é ü ß 日本 # * $ % & | < >\n" * 3, "c"), (67, "x y\nx y\n x y\nX Y\n", "c"), (68, "y" * 400_000, "c"),
           (69, filler("long", 60_000), "c")])


@pytest.mark.parametrize("limits", [(3, 0.0, 0.5), (3, 0.9, 0.5), (0, 0.0, 0.1), (20, 0.01, 0.5)])
def test_matches_brute_force(spark, limits):
    df = spark.createDataFrame([(*r, 0, "x", 1.0) for r in ROWS],
                               "doc_id long, text string, source string, row int, h string, lines double")
    assert result(line_frequency.verdicts(df, min_texts=limits[0], share=limits[1], lost=limits[2])) == brute(ROWS, *limits)


def test_cleaned_takes_the_lines_out(spark):
    df = spark.createDataFrame([(*r, -1) for r in ROWS], "doc_id long, text string, source string, n_chars long")
    out = line_frequency.cleaned(df, min_texts=3, share=0.0)
    assert out.columns == df.columns
    kept = {r["doc_id"]: r for r in out.collect()}
    assert sorted(map(str, kept)) == sorted(str(r[0]) for r in brute(ROWS, 3, 0.0, 0.5) if r[-1])
    for i in range(6):
        assert kept[20 + i]["text"] == filler(chr(97 + i)) + "\n" and kept[20 + i]["n_chars"] == len(kept[20 + i]["text"])
    assert kept[50]["text"] == f"{BOILER}\n{filler('z', 60)}"


@pytest.mark.parametrize("min_texts", [20, 2])
def test_whole_table_matches_sql(spark, min_texts):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    sql = queries.ORACLE_SQL["op12_quality_rules"].replace("held > 20", f"held > {min_texts}")
    want = sorted(db.execute(f"SELECT {', '.join(COLUMNS)} FROM ({sql})").fetchall(), key=str)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = queries.op12_quality_rules(spark, SF) if min_texts == 20 else line_frequency.verdicts(docs, min_texts=min_texts)
    assert result(out) == want
    assert min_texts == 20 or sum(r[8] for r in want) > 100       # at this size only the lower limit takes lines


def test_clean_documents_stay(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    good = (queries.op12_quality_rules(spark, SF).join(labels.filter("quality = 1"), "doc_id").filter(~F.col("base_failed")))
    n, kept = good.agg(F.count(F.lit(1)), F.sum(F.col("kept").cast("int"))).first()
    assert n > 100 and kept >= 0.99 * n


def test_no_python_in_the_plan(spark):
    out = queries.op12_quality_rules(spark, SF)
    assert not re.search("Python|Arrow|Pandas", out._jdf.queryExecution().toString())


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert line_frequency.verdicts(empty).count() == 0 and line_frequency.cleaned(empty).count() == 0
