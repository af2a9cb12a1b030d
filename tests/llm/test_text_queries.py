"""Registered text queries against their SQL, and the pipeline's stages against its promises."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tableload.llm import mixing, quality_rules, registered, simhash

from ..conftest import SF_SMALL
from ..test_registered import _multiset


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


def test_all_operators_are_registered():
    names = set(registered.QUERIES) | {"pipeline"}
    assert names <= set(entry.queries()) and {n.split("_")[0] for n in registered.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(registered.ORACLES) == {"op4_source_mixing", "op9_onebit_ann", "op10_quality_rules", "op11_hard_negatives",
                                       "op12_winnowing", "op13_filter_audit"}


@pytest.mark.parametrize("name", sorted(registered.ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    got, want = registered.QUERIES[name](spark, SF_SMALL).toPandas(), duck.sql(registered.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and _multiset(got) == _multiset(want)


def test_pipeline_stages(spark, tmp_path):
    import sentencepiece
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, kept = docs.columns, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_SMALL).write.parquet(f"{tmp_path}/{k}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{k}")
        kept.append(docs)
        if k < 4:
            assert docs.columns == columns
        if k == 0:
            good = quality_rules.judge(before).where("kept").count()
            assert 0 < docs.count() == good < before.count()
        if k == 1:
            assert docs.count() == simhash.near_duplicates(before).select("root").distinct().count()
        if k == 2:
            assert docs.count() == before.count()
        if k == 3:
            assert docs.count() == mixing.mix(before).selectExpr("sum(size(positions))").first()[0]
    lib = sentencepiece.SentencePieceProcessor(model_file=corpus_pipeline.PIECE_MODEL)
    texts = {r["doc_id"]: r["text"] for r in kept[3].collect()}
    rows = docs.collect()
    assert len(rows) == kept[3].count() and all(r["token_ids"] == lib.encode(texts[r["doc_id"]]) for r in rows)
