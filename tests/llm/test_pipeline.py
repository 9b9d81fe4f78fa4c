"""The pipeline, and every registered query that has SQL, on the smallest tables."""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from starloom.llm import common, queries

SF_DIR = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test data")


@needs_data
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in os.listdir(SF_DIR):
        con.execute(f"CREATE VIEW {table.split('.')[0]} AS SELECT * FROM '{SF_DIR}/{table}'")
    expected = con.execute(queries.ORACLES[name])
    columns = [d[0] for d in expected.description]
    found = queries.QUERIES[name](spark, SF_DIR).select(*columns)
    assert sorted(map(tuple, found.collect())) == sorted(expected.fetchall())


def test_all_operators_and_the_pipeline_are_registered():
    names = __spark_entry__.queries()
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14))
    assert "pipeline" in names


@pytest.fixture
def small(spark, odd, tmp_path):
    """A folder of odd documents, near copies among them, and labels."""
    from pyspark.sql import functions as F

    docs = odd.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"))
    more = spark.range(100, 130).selectExpr(
        "id AS doc_id",
        "concat(array_join(transform(sequence(1, 80), k -> concat('w', k * (id % 3 + 1) % 61)), ' '), ' end', id) AS text",
        "'en' AS lang",
        "'s' AS source",
    )
    docs = docs.union(more).withColumn("n_chars", F.length("text").cast("long"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    more.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic")).write.parquet(
        str(tmp_path / "labels.parquet")
    )
    return str(tmp_path)


def test_stages_get_small_batches(spark, tmp_path, monkeypatch):
    """Long texts reach Python a few MB at a time; the session's own setting is back afterwards."""
    import pyarrow as pa

    spark.range(0, 3_000, 1, 1).selectExpr("id AS doc_id", "repeat('long text ', 500) AS text").coalesce(1).write.parquet(
        str(tmp_path / "documents.parquet")
    )

    def sizes(spark, docs, sf_dir):
        def run(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["size"])

        return docs.mapInArrow(run, "size long")

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("sizes", sizes)])
    found = [r.size for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert sum(found) > 3_000 * 5_000 and max(found) < 5_000_000
    assert spark.conf.get(key, None) == before


def test_stages_take_any_column_names(spark, small):
    names = ["_gone", "gone", "Gone_", "_row", "_key", "_id", "_text", "_cut", "a.b", "c`d", "digest", "vertex", "label"]
    docs = spark.read.parquet(f"{small}/documents.parquet")
    plain = {n: sorted(map(tuple, stage(spark, docs, small).collect()), key=str) for n, stage in corpus_pipeline.STAGES[:-1]}
    for k, name in enumerate(names):
        docs = docs.withColumn(name, docs["doc_id"] + k)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, small)
        assert after.columns == docs.columns, name
        assert sorted((tuple(r)[:5] for r in after.collect()), key=str) == plain[name], name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, small).count() > 0


def test_stages_keep_the_columns_and_take_effect(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "line_dedup", "ngram_jaccard_join", "substring_dedup", "best_fit_packing"]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        after = stage(spark, docs, small)
        assert after.dtypes == docs.dtypes
        path = f"{small}/out-{k}"
        after.write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        if k == 2:  # three families of near copies, of which the smallest doc_id stays
            assert sorted(r.doc_id for r in docs.where("doc_id >= 100").collect()) == [100, 101, 102]
            # a copy without an id goes like any other; texts without words stay
            assert before.where("doc_id is null and length(trim(text)) > 0").count() == 1
            assert [r.text for r in docs.where("doc_id is null").collect()] == [None]
            assert docs.where("doc_id = 2").count() == 0 and docs.where("doc_id = 1").count() == 1
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, small)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_run_equals_the_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, small).write.parquet(f"{small}/step-{k}")
        docs = spark.read.parquet(f"{small}/step-{k}")
    columns = ["doc_id", "piece", "length", "ids_crc32"]
    run = corpus_pipeline.run(spark, small).select(*columns)
    assert sorted(map(str, run.collect())) == sorted(map(str, docs.select(*columns).collect()))


def test_pipeline_over_no_documents(spark, small, tmp_path):
    folder = tmp_path / "none"
    spark.read.parquet(f"{small}/documents.parquet").where("false").write.parquet(str(folder / "documents.parquet"))
    spark.read.parquet(f"{small}/labels.parquet").write.parquet(str(folder / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(folder)).count() == 0


@needs_data
def test_pipeline_over_the_smallest_tables(spark):
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    fill = {}
    for r in rows:
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert rows and max(fill.values()) <= queries.SEQUENCE_TOKENS


def test_a_stage_by_itself_hands_small_batches_to_python(spark, tmp_path):
    """The stage's result is run by its caller, after the stage has returned."""
    rows = [(i, f"words of text {i} " * 200, "en", "s", 0) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING, source STRING, n_chars INT")
    spark.createDataFrame([(i, i % 2, 0) for i in range(300)], "doc_id LONG, quality INT, toxic INT").write.parquet(
        str(tmp_path / "labels.parquet")
    )
    before = spark.conf.get(common.BATCH_KEY, None)
    try:
        for name, stage in corpus_pipeline.STAGES:
            spark.conf.unset(common.BATCH_KEY)
            stage(spark, docs, str(tmp_path))
            if name != "line_dedup":  # it has no Python
                assert spark.conf.get(common.BATCH_KEY, None) == str(common.BATCH_BYTES)
            spark.conf.set(common.BATCH_KEY, "12345")  # the caller's own choice stays
            stage(spark, docs, str(tmp_path))
            assert spark.conf.get(common.BATCH_KEY) == "12345"
    finally:
        spark.conf.unset(common.BATCH_KEY) if before is None else spark.conf.set(common.BATCH_KEY, before)
