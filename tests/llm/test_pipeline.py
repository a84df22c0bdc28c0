"""The corpus pipeline on whole small tables, and the registered SQL of the training-data queries."""

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from stratum.llm import decontam, line_dedup, ngram_join, queries
from stratum.llm.common import load

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.mark.parametrize("key", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = E.queries()[key](spark, SF)
    want = con.execute(E.oracle_sql()[key])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    cols = sorted(names)
    assert sorted(tuple(str(r[c]) for c in cols) for r in got.collect()) == \
        sorted(tuple(str(r[names.index(c)]) for c in cols) for r in want.fetchall())


def test_every_operator_is_registered():
    numbers = sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES)
    assert numbers == list(range(1, 14)) and "pipeline" in E.queries()


def test_pipeline_stage_by_stage(spark, tmp_path):
    docs = load(spark, SF, "documents")
    stages = dict(corpus_pipeline.STAGES)
    assert [k for k, _ in corpus_pipeline.STAGES] == ["quality_classifier", "line_dedup", "ngram_jaccard_join",
                                                      "benchmark_decontamination", "best_fit_packing"]

    def stored(df, name):
        df.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    good = stored(stages["quality_classifier"](spark, docs, SF), "a")
    predicted = {r["doc_id"] for r in queries.op1_quality_classifier(spark, SF).filter("predicted = 1").collect()}
    assert good.columns == docs.columns and {r["doc_id"] for r in good.collect()} == predicted

    lines = stored(stages["line_dedup"](spark, good, SF), "b")
    assert lines.columns == docs.columns and lines.count() == good.count()
    assert line_dedup.lost_keys(lines).count() == 0              # nothing is left to drop

    single = stored(stages["ngram_jaccard_join"](spark, lines, SF), "c")
    assert single.columns == docs.columns
    assert ngram_join.near_duplicates(single).filter("n_links > 0").count() == 0

    clean = stored(stages["benchmark_decontamination"](spark, single, SF), "d")
    assert clean.columns == docs.columns
    assert decontam.contaminated(clean, load(spark, SF, "benchmark")).count() == 0
    hit = {r["doc_id"] for r in decontam.contaminated(single, load(spark, SF, "benchmark")).collect()}
    assert single.count() - clean.count() == len(hit)

    packed = stages["best_fit_packing"](spark, clean, SF)
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in clean.collect()}
    whole = corpus_pipeline.run(spark, SF)
    same = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(tuple(r[c] for c in same) for r in whole.collect()) == sorted(tuple(r[c] for c in same) for r in packed.collect())


def test_pipeline_of_an_empty_table(spark):
    docs = load(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
