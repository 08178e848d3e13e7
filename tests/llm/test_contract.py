"""The registered queries of this subpackage against their SQL, and the pipeline."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from jobweft.llm import catalog, decontaminate, mixing, near_dedup

NAMES = [
    "op1_near_dedup", "op2_line_dedup", "op3_decontamination", "op4_pseudonyms", "op5_main_text", "op6_quality",
    "op7_sharding", "op8_fingerprints", "op9_url_lists", "op10_mixing", "op11_lexical_search", "op12_bpe", "op13_manifest",
]


def test_all_are_registered():
    assert list(catalog.registered()) == NAMES
    assert set(NAMES) | {"pipeline"} <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(catalog.equivalent_sql()))
def test_query_equals_sql(spark, sf_dir, name):
    db = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    frame = catalog.registered()[name](spark, sf_dir)
    cursor = db.execute(catalog.equivalent_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(frame.columns)
    want = sorted(cursor.fetchall(), key=repr)
    assert sorted(map(tuple, frame.select(*columns).collect()), key=repr) == want


@pytest.mark.parametrize("name", ["op2_line_dedup", "op8_fingerprints", "op9_url_lists", "op10_mixing"])
def test_native_queries_run_no_python(spark, sf_dir, name):
    plan = catalog.registered()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "InArrow" not in plan


def test_pipeline_applies_its_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = {}
    for name, stage in corpus_pipeline.STAGES:
        held[name] = before = docs
        docs = stage(spark, docs, sf_dir)
        if name != "sharding":
            assert docs.columns == before.columns
            docs = spark.createDataFrame(docs.collect(), docs.schema)
    ids = {name: [r.doc_id for r in rows.select("doc_id").collect()] for name, rows in held.items()}
    scores = {r.doc_id: r.score for r in catalog.op6_quality(spark, sf_dir).collect()}
    assert sorted(ids["near_duplicates"]) == sorted(k for k, v in scores.items() if v >= 0.7)
    kept = near_dedup.near_duplicates(held["near_duplicates"], percent=80).where("kept")
    assert sorted(ids["decontamination"]) == sorted(r.doc_id for r in kept.collect())
    found = decontaminate.contaminations(held["decontamination"], spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    gone = {r.doc_id for r in found.collect()}
    assert gone and sorted(ids["mixing"]) == sorted(set(ids["decontamination"]) - gone)
    copies = mixing.copies(held["mixing"]).where("copies > 0").select(F.explode(F.array_repeat("id", F.col("copies").cast("int"))))
    assert sorted(ids["sharding"]) == sorted(r[0] for r in copies.collect())
    assert sorted(r.doc_id for r in docs.collect()) == sorted(ids["sharding"])


def test_pipeline_run(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir)
    assert set(spark.read.parquet(f"{sf_dir}/documents.parquet").columns) < set(rows.columns)
    assert rows.count() > 0
