"""The gapped subsequence kernel against explicit enumeration, and held-out toxic texts."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from lakecare.llm import queries, toxicity

LARGER = "/root/testdata/sf0.1"


def explicit(word):
    """Weight of every gapped subsequence of three characters, the word's edges included, at norm one."""
    padded = "\x01" + word + "\x01"
    found = {}
    for i in range(len(padded)):
        for a, b in toxicity.OFFSETS:
            if i + b < len(padded):
                key = (padded[i], padded[i + a], padded[i + b])
                found.setdefault(key, []).append(toxicity.DECAY ** (b - 2))
    norm = np.sqrt(sum(v * v for vs in found.values() for v in vs))
    return {k: sum(vs) / norm for k, vs in found.items()} if norm else {}


def test_kernel_rows_equal_the_explicit_gram_matrix():
    words = ["idiot", "idi0t", "i-d-i-o-t", "stupid", "stuupid", "a", "ab", "été", "😀😀😀", "aaaa", ""]
    maps = [explicit(w) for w in words]
    gram = np.array([[sum(v * two.get(k, 0) for k, v in one.items()) for two in maps] for one in maps])
    assert np.allclose(toxicity._rows(words, words), gram, atol=1e-6)
    assert gram[3, 4] > gram[3, 0]


def test_folded_table_equals_the_machine_over_landmarks():
    marks, words = ["idiot", "clown", "scum"], ["idiots", "clowning", "calm", "id1ot"]
    alpha = np.array([0.7, -0.2, 1.1])
    mark, key, value = toxicity.subsequences(marks)
    table = np.bincount(key, alpha[mark] * value, minlength=1 << toxicity.TABLE_BITS)
    direct = [sum(a * sum(v * explicit(m).get(k, 0) for k, v in explicit(w).items()) for a, m in zip(alpha, marks, strict=True)) for w in words]
    assert np.allclose(toxicity.ToxicityModel(table, 0.25, np.zeros(0)).raw(words), np.array(direct) + 0.25, atol=1e-6)


def test_every_common_insult_is_learnt():
    rng = np.random.default_rng(3)
    plain = ["".join(rng.choice(list("abcdefghik"), int(rng.integers(3, 8)))) for _ in range(400)]
    insults = ["grumph", "bloxtwit", "snarvel", "quibzock", "drozzle"]
    words, number, bags = [], {}, []
    for i in range(300):
        units = set(rng.choice(plain, 20).tolist()) | (set(rng.choice(insults, 3, replace=False).tolist()) if i % 2 else set())
        at = [number.setdefault(w, len(number)) for w in sorted(units)]
        bags.append(toxicity.Bag(np.array(at), np.ones(len(at), int), i % 2))
    words = list(number)
    model = toxicity.fit(words, bags)
    assert (model.raw(insults) > 0).all() and (model.raw(plain) > 0).mean() < 0.02


def test_held_out_toxic_texts_are_found(spark):
    scored = queries.op5_toxicity(spark, LARGER).where("held_out")
    labels = spark.read.parquet(f"{LARGER}/labels.parquet").select("doc_id", "toxic")
    rows = scored.join(labels, "doc_id").collect()
    assert all((zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) == r["held_out"] for r in rows)
    toxic = [r["predicted"] for r in rows if r["toxic"] == 1]
    clean = [r["predicted"] for r in rows if r["toxic"] == 0]
    assert len(toxic) > 90 and np.mean(toxic) >= 0.9 and np.mean(clean) <= 0.01


def test_columns_named_like_the_results_give_way(spark):
    docs = spark.createDataFrame([(1, "text", 5, "x"), (2, None, 6, "y")], "doc_id long, text string, score int, predicted string")
    out = toxicity.score(docs.withColumn("more", F.lit(1)), None)
    assert out.columns == ["doc_id", "more", "score", "predicted"] and {r["predicted"] for r in out.collect()} == {0}
