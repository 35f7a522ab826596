"""The registered queries as wholes: against SQL, brute force, or planted cases."""

import corpus_pipeline
import pytest
from compare import difference, duck

import __spark_entry__ as entry
from loanlens.llm import catalog, decontaminate, set_join, toxicity

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    numbers = [n.split("_")[0] for n in catalog.QUERIES]
    assert numbers == sorted(numbers, key=lambda n: int(n[2:])) and len(set(numbers)) == len(numbers)
    assert set(catalog.QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_equals_sql(spark, name):
    assert difference(catalog.QUERIES[name](spark, "/root/testdata/sf0.01"), duck("/root/testdata/sf0.01"), catalog.ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE)))
def test_one_row_per_row(spark, name):
    sources = {"op1": None, "op5": None, "op10": "pages", "op12": None, "op13": None}
    rows = catalog.QUERIES[name](spark, SF).count()
    source = sources.get(name.split("_")[0], "documents")
    assert rows > 0 and (source is None or rows == catalog.table(spark, SF, source).count())


def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    benchmark = spark.read.parquet(f"{sf}/benchmark.parquet")
    stage = dict(corpus_pipeline.STAGES)
    assert list(stage) == ["toxicity", "near_duplicates", "decontamination", "secrets", "mixing"]

    calm = stage["toxicity"](spark, docs, sf).cache()
    scored = toxicity.score(docs, toxicity.train(docs, labels))
    assert {r.doc_id for r in calm.collect()} == {r.doc_id for r in scored.where("score < 0.5").collect()}
    single = stage["near_duplicates"](spark, calm, sf).cache()
    groups = set_join.link_groups(calm, 5, 80, 100).collect()
    assert {r.doc_id for r in single.collect()} == {r.doc_id for r in groups if r.doc_id == r.component_id}
    clean = stage["decontamination"](spark, single, sf).cache()
    hit = {r.doc_id for r in decontaminate.find_overlaps(single, benchmark).collect()}
    assert {r.doc_id for r in single.collect()} - {r.doc_id for r in clean.collect()} == hit != set()
    safe = stage["secrets"](spark, clean, sf).cache()
    assert safe.count() == clean.count() and safe.where(r"text rlike '[0-9a-f]{32}'").count() == 0
    mixed = stage["mixing"](spark, safe, sf)
    assert mixed.groupBy("doc_id").count().where("count > 2").count() == 0
    for frame in (calm, single, clean, safe):
        assert frame.columns == docs.columns


def test_pipeline_on_an_empty_table(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{sf}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_pipeline_hands_python_small_batches(spark, tmp_path):
    limit, stage = "spark.sql.execution.arrow.maxBytesPerBatch", dict(corpus_pipeline.STAGES)["decontamination"]
    before = spark.conf.get(limit)
    spark.createDataFrame([(1, "x")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.range(40, numPartitions=1).selectExpr("id doc_id", "repeat(id || ' a ', 250000) text")
    largest = lambda: docs.mapInArrow(
        lambda batches: (b.select(["doc_id"]).slice(0, 1).set_column(0, "doc_id", [b.num_rows]) for b in batches), "doc_id long"
    ).agg({"doc_id": "max"}).first()[0]
    try:
        spark.conf.set(limit, "64m")
        stage(spark, docs, str(tmp_path))
        assert spark.conf.get(limit) == str(corpus_pipeline.BATCH_BYTES)
        assert largest() <= 8
        spark.conf.set(limit, "1m")
        stage(spark, docs, str(tmp_path))
        assert spark.conf.get(limit) == "1m"
    finally:
        spark.conf.set(limit, before)
    corpus_pipeline.run(spark, SF)
    assert spark.conf.get(limit) == before
