"""Each query over its whole tables, against its SQL; and the stages of the pipeline, each judged on its own input."""

from collections import Counter

import pytest

import corpus_pipeline
from cohortlens.llm import compression, exact, jaccard, mixing, packing, queries

duckdb = pytest.importorskip("duckdb")
OPERATORS = range(1, 14)


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES if n.startswith("op")) == list(OPERATORS)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_copies", "near_copies", "mixture", "packing"]


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, data, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{data}/documents.parquet')")
    want = con.execute(queries.SQL[name])
    names = [d[0] for d in want.description]
    got = queries.QUERIES[name](spark, data)
    assert sorted(got.columns) == sorted(names)
    assert Counter(tuple(r) for r in got.select(*names).collect()) == Counter(want.fetchall())


def test_op4_returns_every_document(spark, docs, rows, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.QUERIES["op4_remove_repeats"](spark, str(tmp_path)).collect()
    assert Counter(r["doc_id"] for r in out) == Counter(r[0] for r in rows)
    kept = [r for r in out if not r["n_removed"]]
    assert kept and all(r["removed"] == [] and r["n_sentences"] is not None for r in kept)
    assert not Counter((r["doc_id"], r["text"]) for r in kept) - Counter((r[0], r[1] or "") for r in rows)


def test_stages_keep_the_columns_and_take_effect(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, data)
        rows = after.collect()
        if name == "quality":
            score = {r["id"]: r["score"] for r in compression.classify(before, spark.read.parquet(f"{data}/labels.parquet")).collect()}
            assert {r["doc_id"] for r in rows} == {i for i, s in score.items() if s >= corpus_pipeline.QUALITY_FLOOR}
        if name == "exact_copies":
            last = {}
            for r in before.collect():
                last[r["text"]] = max(r["doc_id"], last.get(r["text"], -1))
            assert sorted(r["doc_id"] for r in rows) == sorted(last.values())
        if name == "near_copies":
            least = Counter(r["component_id"] for r in jaccard.components(before).collect())
            assert sorted(r["doc_id"] for r in rows) == sorted(least)
        if name == "mixture":
            assert Counter(r["doc_id"] for r in rows) == +Counter({r["id"]: r["times"] + (r["part"] > 0) for r in mixing.mix(before).collect()})
        if name == "packing":
            assert sum(r["length"] for r in rows) == sum(r["n"] for r in packing.encoded(before, "doc_id", "text", "source", packing.tokenizer_path(), packing.END).collect())
            return
        assert after.columns == docs.columns
        before = spark.createDataFrame(rows, docs.schema)


def test_the_pipeline_runs_on_empty_tables_and_odd_rows(spark, docs, none, data, tmp_path):
    for i, table in enumerate((none, docs)):
        folder = str(tmp_path / str(i))
        table.write.parquet(f"{folder}/documents.parquet")
        spark.read.parquet(f"{data}/labels.parquet").limit(0 if i == 0 else 1000).write.parquet(f"{folder}/labels.parquet")
        out = corpus_pipeline.run(spark, folder)
        assert "sequence_id" in out.columns and (out.count() == 0) == (i == 0)
    assert exact.kept(none).columns == none.columns
