"""Columns whose names clash with an operator's own, repeated rows, and what the operators keep over several runs."""

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from lakecare.llm import ann, fingerprints, langid, mixing, secret_scan, simhash, urlfilter
from lakecare.session import scratch_path
from tests.llm.test_corpus import documents

CLASHING = (
    "id unnamed text_hash doc blob block w0 w7 possible spans stitched kind start score ambiguous lang_pred rate copies copy "
    "place digest of size source_size target _id _unnamed _text_hash _blob _spans _copies _copy _source bucket halo h col"
).split()


def clashing(spark, extra=()):
    return documents(spark, extra).withColumns({c: F.concat(F.lit(f"{c} "), F.coalesce("text", F.lit(""))) for c in CLASHING})


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_stages_keep_clashing_columns(spark):
    docs = clashing(spark, ["La vie est belle et le monde est grand.", "The world is large and life is good."] * 3)
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, docs, "")
        assert out.columns == docs.columns, name
        for r in out.collect():
            if name != "secret_scan":
                assert all(r[c] == f"{c} {r['text'] or ''}" for c in CLASHING), name


def test_identify_gives_its_names_to_the_results(spark):
    docs = clashing(spark)
    model = langid.fit(np.eye(3, langid.FEATURES), ["a", "b", "c"])
    out = langid.identify(docs.select("doc_id", "score", "lang_pred", "text"), model)
    assert out.columns == ["doc_id", "lang_pred", "score", "ambiguous"] and out.count() == docs.count()


def test_redaction_with_clashing_columns(spark):
    docs = clashing(spark, ["token=abcdefgh12 and more"])
    out = secret_scan.redact(docs, scratch_path(spark, "ledger"))
    assert out.columns == docs.columns and out.count() == docs.count()
    texts = [r["text"] for r in out.collect()]
    assert not any("abcdef" in t for t in texts if t) and texts.count(None) == 1


def test_emitted_rows_are_whole(spark):
    docs = clashing(spark)
    out, mixed = mixing.emit(docs), mixing.mix(docs)
    assert out.columns == docs.columns
    assert sum(rows(out).values()) == mixed.agg(F.sum("copies")).first()[0]
    assert rows(out).keys() <= rows(docs).keys()


def test_equal_rows_are_drawn_one_by_one(spark):
    equal = spark.createDataFrame([(None, "some words here", "s", 0)] * 600 + [(1, "w " * 600, "t", 0)], "doc_id long, text string, source string, n int")
    targets = {r["source"]: r for r in mixing.mix(equal).select("source", "target", "source_size").distinct().collect()}
    taken = mixing.mix(equal).groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("n")).collect()
    of = {r["source"]: r["n"] for r in taken}
    assert abs(of["s"] / targets["s"]["target"] - 1) < 0.15
    assert rows(mixing.emit(equal)) == rows(mixing.emit(equal.repartition(7)))


def test_no_rows_of_a_source_without_ids_are_all_or_nothing(spark):
    docs = spark.createDataFrame([(None, f"text number {i}", f"s{i % 3}") for i in range(900)], "doc_id long, text string, source string")
    for r in mixing.mix(docs).groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("n"), F.first("target").alias("t")).collect():
        assert abs(r["n"] / r["t"] - 1) < 0.15


def test_more_languages_than_a_byte_holds():
    languages = [f"l{i:03d}" for i in range(300)]
    model = langid.fit(np.eye(300, langid.FEATURES), languages, rounds=30)
    best, _, _ = model.predict(np.eye(300, langid.FEATURES))
    assert [model.languages[b] for b in best] == languages


def test_decoding_against_brute_force():
    random = np.random.default_rng(4)
    model = langid.fit(random.standard_normal((60, langid.FEATURES)), [f"l{i % 9}" for i in range(60)], rounds=20)
    vectors = random.standard_normal((40, langid.FEATURES))
    best, score, close = model.predict(vectors)
    for x, b, s, c in zip(vectors, best, score, close, strict=True):
        losses = []
        for word in model.code:
            loss = 0.0
            for bit in range(model.code.shape[1]):
                margin = float(x @ model.weights[:, bit] + model.bias[bit])
                loss += model.trust[bit] * float(np.logaddexp(0, -margin * word[bit]))
            losses.append(loss)
        ranked = sorted(losses)
        assert losses.index(ranked[0]) == b
        assert abs(s - 1 / sum(np.exp(ranked[0] - v) for v in losses)) < 1e-6
        assert c == (ranked[1] - ranked[0] < langid.CLOSE * (ranked[1] + ranked[0]))


def test_findings_reach_every_path_that_ever_held_the_text(spark):
    ledger = scratch_path(spark, "ledger")
    layout = "doc_id long, text string"
    first = [(1, "token=abcdefgh12"), (2, "clean"), (3, "token=abcdefgh12"), (None, "secret: zzzzzzzz")]
    second = [(1, "cleaned now"), (4, "token=abcdefgh12"), (3, "token=abcdefgh12")]
    for version in (first, second, second):
        secret_scan.scan(spark.createDataFrame(version, layout), ledger)
    found = secret_scan.exposures(spark, ledger).select("path", "scan", "rule", "start", "end").collect()
    assert sorted(map(tuple, found), key=repr) == sorted(
        [("1", 1, "assign", 0, 16), ("3", 1, "assign", 0, 16), ("4", 2, "assign", 0, 16), (None, 1, "assign", 0, 16)], key=repr
    )
    assert spark.read.parquet(f"{ledger}/scanned").groupBy("blob", "rule").count().where("count > 1").count() == 0


def test_repeated_vectors_and_unequal_lengths(spark):
    random = np.random.default_rng(5)
    data = [(i, random.standard_normal(6).tolist()) for i in range(300)]
    data += [data[0], data[0], data[100], (0, [9.0] * 6), (301, [1.0]), (302, [1.0, 0.0]), (303, [])]
    got = ann.nearest(spark.createDataFrame(data, "vec_id long, embedding array<double>").repartition(3), F.col("vec_id") % 100 == 0)
    found = {}
    for r in got.collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    distinct = {(i, tuple(v + [0.0] * (6 - len(v)))) for i, v in data if any(v)}
    hits = 0
    for q, near in found.items():
        own = min(v for i, v in distinct if i == q)
        truth = sorted((float(np.linalg.norm(np.subtract(v, own))), i) for i, v in distinct if i != q)[:10]
        assert [n[0] for n in sorted(near)] == list(range(1, 11)) and len({n[1] for n in near}) == 10
        hits += len({i for _, i in truth} & {n[1] for n in near})
    assert set(found) == {0, 100, 200, 300} - {300} | ({300} if any(i == 300 for i, _ in data) else set())
    assert hits >= 0.9 * 10 * len(found)


def test_merging_sketches_is_associative():
    random = np.random.default_rng(6)
    for size in (3, 40, 400):
        parts = [fingerprints.sketch_of([int(x) for x in random.integers(0, 2**63, size)], 1 / 8) for _ in range(3)]
        a, b, c = parts
        whole = fingerprints.sketch_of([int(x) for p in parts for x in p.kept], 1 / 8)
        assert a.merge(b).merge(c).text() == a.merge(b.merge(c)).text() == c.merge(a).merge(b).text()
        assert a.merge(a).text() == a.text() and len(whole.kept)


def test_short_texts_have_sketches_and_likeness():
    of = lambda t: fingerprints.Document.of(t, 5, 1 / 8).sketch
    one, two = of("a b c d e f g h"), of("x b c d e f g h")
    assert len(one.kept) == 4 and one.contained_in(two) == 0.75 and one.contained_in(one) == 1.0
    assert of("").contained_in(of("")) == 1.0 and of("").contained_in(one) == 0.0 and one.contained_in(of("")) == 0.0


def test_rows_without_ids_are_dealt_over_many_tasks(spark):
    docs = spark.createDataFrame([(None, f"text {i}") for i in range(3000)] + [(1, "x"), (2, "y")], "doc_id long, text string")
    dealt = fingerprints.with_next(docs, bucket_rows=100).groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in dealt) < 300 and len(dealt) > 20
    out = fingerprints.document_fingerprints(docs, bucket_rows=100)
    assert out.count() == 3002


def test_first_of_a_group_keeps_the_rows_columns(spark):
    docs = clashing(spark)
    out = simhash.keep_first(docs)
    assert out.columns == docs.columns and rows(out).keys() <= rows(docs).keys()


def test_listed_urls_fit_every_spelling(spark):
    spellings = [
        ("u:p@Bad.Example.:80", "/a/./b/../c%7ex"), ("bad.example", "/a/c~x"), ("bad.example:443", "/a/c%7Ex"), ("bad.example", "/%61/c%7ex"),
        ("bad.example", "/x/../../a/c~x"), ("bad.example", "/a/%2e/c~x"),
    ]
    others = [("bad.example:8080", "/a/c~x"), ("bad.example", "/a/c~X"), ("sub.bad.example", "/a/c~x"), ("bad.example", "/a%2fc~x"), ("bad.example", "/a/c~x/")]
    pages = spark.createDataFrame([(i, f"http://{h}{p}?q#f", "x") for i, (h, p) in enumerate(spellings + others)], "page_id int, url string, _host string")
    rules = spark.createDataFrame([("other.example", "/", "allow")], "host string, path string, action string")
    for host, path in (spellings[0][0].lower(), spellings[0][1]), spellings[1]:
        listed = spark.createDataFrame([(host, path)], "host string, path string")
        found = {r["page_id"]: r for r in urlfilter.url_filter(pages, rules, listed).collect()}
        assert [found[i]["verdict"] for i in range(11)] == ["block"] * 6 + ["allow"] * 5
        assert found[0]["host"] == "u:p@bad.example.:80" and found[0]["path"] == "/a/./b/../c%7ex" and found[0]["_host"] == "x"


def test_canonical_paths(spark):
    cases = {"": "/", "/": "/", "/a": "/a", "/a/": "/a/", "/.": "/", "/..": "/", "/a/..": "/", "/a/b/..": "/a/", "/a/.": "/a/", "/..a/b.": "/..a/b.",
             "/%41%2F%zz%": "/A%2F%ZZ%", "/a//b": "/a//b", "/%e9": "/%E9", "/a/%2E%2e/b": "/b"}
    df = spark.createDataFrame([(k, v) for k, v in cases.items()], "path string, wanted string")
    for r in df.withColumn("got", urlfilter.canonical_path(F.col("path"))).collect():
        assert r["got"] == r["wanted"], r["path"]
