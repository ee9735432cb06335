"""The pipeline's stages and the registered corpus queries on small tables."""

import os
from collections import Counter

import corpus_pipeline
from lakecare.llm import langid, mixing, packing, queries, secret_scan, simhash
from lakecare.session import shared_folder, stage
from tests.compare import connect, difference

SMALL = "/root/testdata/sf0.001"


def test_stages_follow_each_other(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, SMALL), f"test-{name}")
        kept[name] = docs
        assert name == "packing" or docs.columns == columns
    all_docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert kept["language_id"].count() >= 0.98 * all_docs.count()
    groups = simhash.near_duplicates(kept["language_id"]).select("component_id").distinct().count()
    assert kept["simhash_near_dedup"].count() == groups
    assert kept["secret_scan"].count() == groups
    left = secret_scan.digest(secret_scan.secret_report(kept["secret_scan"]))
    assert left.where("n_assign + n_access + n_hex > 0").count() == 0
    times = {r["doc_id"]: r["copies"] for r in mixing.mix(kept["secret_scan"]).collect()}
    got = Counter(r["doc_id"] for r in kept["mixing"].collect())
    assert got == Counter({k: n for k, n in times.items() if n})
    tokens = {}
    for p in kept["packing"].collect():
        tokens[p["doc_id"]] = tokens.get(p["doc_id"], 0) + p["length"]
        assert p["length"] <= packing.CAPACITY
    assert tokens.keys() == got.keys()


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for name, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, SMALL), f"test-{name}")
    assert docs.count() == 0


def test_unlabelled_documents_stay(spark):
    rows = [(1, "abc", None, None, 3), (2, "123", None, None, 3), (3, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert [r["doc_id"] for r in corpus_pipeline.known_language(spark, docs, SMALL).collect()] == [1]


def test_queries_match_their_sql(spark):
    con = connect(SMALL)
    for name, sql in queries.ORACLE.items():
        assert difference(queries.QUERIES[name](spark, SMALL), con, sql) is None, name


def test_languages_on_held_out_rows(spark):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    held = [r for r in queries.op2_language_id(spark, SMALL).collect() if r["held_out"]]
    assert sum(truth[r["doc_id"]] == r["lang_pred"] for r in held) >= 0.98 * len(held)
    assert langid.UNKNOWN not in {r["lang_pred"] for r in held}


def test_a_run_leaves_its_result_alone(spark):
    scratch = f"{shared_folder(spark).removeprefix('file:').replace('//', '/', 1)}/lakecare-scratch"
    before = set(os.listdir(scratch)) if os.path.isdir(scratch) else set()
    out = corpus_pipeline.run(spark, SMALL)
    left = set(os.listdir(scratch)) - before
    assert len(left) == 1 and out.count() > 0 and out.columns[0] == "doc_id"
