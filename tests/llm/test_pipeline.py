"""The pipeline's stages on the small tables, and the registered queries that have SQL."""

import duckdb
import pytest

import corpus_pipeline
from salesmart.llm import decontaminate, kneser_ney, oracle, queries, simhash
from salesmart.llm.common import stored, table
from tests.conftest import SF_SMALL


def test_stages(spark):
    docs = table(spark, SF_SMALL, "documents")
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stored(stage(spark, docs, SF_SMALL), "t-stage")
        assert docs.columns == before.columns and docs.dtypes == before.dtypes
        assert docs.join(before, "doc_id", "left_anti").count() == 0
        kept.append((name, docs.count(), docs))
    by = {n: (c, d) for n, c, d in kept}
    all_docs = table(spark, SF_SMALL, "documents")
    good = kneser_ney.classify(all_docs, table(spark, SF_SMALL, "labels")).where("kept").count()
    assert by["quality"][0] == good
    classes = simhash.near_duplicates(by["quality"][1]).select("root").distinct().count()
    assert by["near_duplicates"][0] == classes
    assert decontaminate.leaks(by["decontamination"][1], table(spark, SF_SMALL, "benchmark")).count() == 0
    assert by["secrets"][0] == by["decontamination"][0]
    assert by["secrets"][1].where("text rlike '[0-9a-f]{16}'").count() == 0
    assert by["secrets"][1].where("length(text) <> n_chars").count() == by["decontamination"][1].where(
        "length(text) <> n_chars").count()
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL)
    assert pieces.select("doc_id").distinct().count() == docs.count()


@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("pages", "documents", "benchmark", "labels", "embeddings"):
        con.execute(f"create view {t} as select * from '{SF_SMALL}/{t}.parquet'")
    res = con.execute(oracle.ORACLE[name])
    columns = [d[0] for d in res.description]
    got = queries.QUERIES[name](spark, SF_SMALL).select(*columns).collect()
    assert sorted(map(str, res.fetchall())) == sorted(str(tuple(r)) for r in got)
