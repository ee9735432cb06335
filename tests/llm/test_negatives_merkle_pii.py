"""Hard negatives, Merkle manifest and personal data against brute force, and on awkward rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakecare.llm import merkle, negatives, pii
from tests.llm.test_corpus import DOCS, LONG, by_id, documents, empty

SMALL = "/root/testdata/sf0.001"

# Hard negatives --------------------------------------------------------------------------

VECTORS = "vec_id long, label int, vector array<double>, row string, score int, block int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, label, v, "x", 1, 2) for i, label, v in rows], VECTORS).repartition(3)


def brute_negatives(rows, step, positives=5, found=10):
    taking = {}
    for i, label, v in rows:
        if label is None or v is None or any(x is None or not math.isfinite(256 * x) for x in v):
            continue
        taking[(i, label, tuple(math.floor(256 * x) for x in v))] = None
    taking = list(taking)
    order = lambda s: (-s[0], s[1] is None, s[1] or 0)
    out = []
    for a in taking:
        if a[0] is None or a[0] % step:
            continue
        scored = [(sum(x * y for x, y in zip(a[2], r[2])), r[0], r[1]) for r in taking if r is not a]
        for ps, pid, _ in sorted((s for s in scored if s[2] == a[1]), key=order)[:positives]:
            inside = sorted((s for s in scored if s[2] != a[1] and 30 * ps <= 100 * s[0] <= 90 * ps), key=order)
            out += [(a[0], pid, rank, nid, ps, ns) for rank, (ns, nid, _) in enumerate(inside[:found], 1)]
    return Counter(out)


def mined(df):
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return Counter(tuple(r[n] for n in names) for r in df.collect())


def clustered(count, width, seed=3, labels=4):
    random = np.random.default_rng(seed)
    centres = random.standard_normal((6, width))
    near = centres[random.integers(0, 6, count)] + 0.6 * random.standard_normal((count, width))
    return [(i, int(random.integers(0, labels)), near[i].tolist()) for i in range(count)]


def test_negatives_against_brute_force(spark):
    rows = clustered(400, 20)
    got = negatives.hard_negatives(vectors(spark, rows), F.col("vec_id") % 20 == 0, block_rows=60)
    assert mined(got) == brute_negatives(rows, 20)


def test_negatives_of_a_hot_label_and_of_equal_vectors(spark):
    rows = [(i, 1 if i % 3 else 2, [1.0, 0.5, 0.25 * (i % 4)]) for i in range(120)]
    got = negatives.hard_negatives(vectors(spark, rows), F.col("vec_id") % 30 == 0, block_rows=16)
    assert mined(got) == brute_negatives(rows, 30)


def test_negatives_of_awkward_rows(spark):
    rows = clustered(60, 5)
    rows += [rows[0], rows[7], (0, 2, [0.3, 0.1, 0.9, 0.0, 0.0]), (None, 1, [1.0] * 5), (None, 2, [2.0] * 5)]
    rows += [(61, None, [1.0] * 5), (62, 1, None), (63, 1, [None, 1.0, 1.0, 1.0, 1.0]), (64, 1, [math.nan] * 5)]
    rows += [(65, 1, [math.inf] * 5), (66, 1, [1e307] * 5), (67, 1, []), (68, 2, [0.0] * 5), (69, 1, [1.0, 1.0]), (70, 3, [-1.0] * 9)]
    got = negatives.hard_negatives(vectors(spark, rows), F.col("vec_id") % 10 == 0, block_rows=8)
    assert mined(got) == brute_negatives(rows, 10)


def test_negatives_of_huge_components_stay_exact(spark):
    rows = [(i, i % 2, [float(2**22 + i), float(2**21 - 3 * i), 0.5 * i]) for i in range(40)]
    got = negatives.hard_negatives(vectors(spark, rows), F.col("vec_id") % 10 == 0)
    assert mined(got) == brute_negatives(rows, 10)


def test_no_negatives(spark):
    none = negatives.hard_negatives(vectors(spark, []), F.col("vec_id") % 10 == 0)
    assert none.count() == 0 and none.columns[:2] == ["anchor_id", "positive_id"]
    assert negatives.hard_negatives(vectors(spark, [(1, 1, [1.0])]), F.col("vec_id") % 10 == 0).count() == 0
    assert negatives.hard_negatives(vectors(spark, [(0, 1, [1.0]), (1, 1, [1.0])]), F.col("vec_id") % 10 == 0).count() == 0


@pytest.mark.parametrize("width", [1, 4, 7, 64])
def test_segment_bounds_hold_and_narrow(width):
    random = np.random.default_rng(width)
    a, b = (random.standard_normal((50, width)) + random.standard_normal((50, 1)) for _ in range(2))
    exact = (a * b).sum(1)
    before = np.full(50, np.inf)
    for one, two in zip(*(negatives.levels_of(*negatives.segment_summaries(x)) for x in (a, b)), strict=True):
        middle = one.length * (one.means * two.means).sum(1)
        spread = (one.deviations * two.deviations).sum(1)
        assert (np.abs(exact - middle) <= spread + 1e-9).all()
        assert (spread <= before + 1e-9).all()
        before = spread


# Merkle manifest -------------------------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def brute_tree(digests, fanout):
    paths, own, nodes = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(nodes) > 1:
        for k, path in enumerate(paths):
            first = own[k] // fanout * fanout
            run = nodes[first : first + fanout]
            path.append(("".join(run[: own[k] - first]), "".join(run[own[k] - first + 1 :])))
            own[k] //= fanout
        nodes = [sha("".join(nodes[i : i + fanout])) for i in range(0, len(nodes), fanout)]
    return nodes[0], paths


def brute_proofs(rows, fanout=16):
    def place(r):
        return r[1] is not None, (r[1] or "").encode(), r[0] is not None, r[0] or 0, brute_leaf(r)

    groups = {}
    for r in sorted(rows, key=place):
        groups.setdefault(r[1], []).append(r)
    trees = [brute_tree([brute_leaf(r) for r in g], fanout) for g in groups.values()]
    root, tops = brute_tree([t[0] for t in trees], fanout)
    out = []
    for (subroot, paths), top, group in zip(trees, tops, groups.values(), strict=True):
        for path, r in zip(paths, group, strict=True):
            steps = path + top
            changed = r[4]
            if r[0] is not None and changed and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                changed = re.sub("[A-Z]+", lambda m: m[0].lower(), changed)
            folded = brute_leaf((*r[:4], changed))
            for left, right in steps:
                folded = sha(left + folded + right)
            out.append((r[0], brute_leaf(r), subroot, root, sha("".join(a + b for a, b in steps)), folded, folded == root))
    return Counter(out)


def tampered():
    condition = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return F.when(condition, merkle.lower_ascii(F.col("text"))).otherwise(F.col("text"))


def proved(df, fanout=16):
    return Counter(tuple(r) for r in merkle.checked(merkle.proofs(df, changed=tampered(), fanout=fanout)).collect())


def five(df):
    return [tuple(r) for r in df.select(*merkle.COLUMNS).collect()]


@pytest.mark.parametrize("fanout", [2, 16])
def test_proofs_of_awkward_rows(spark, fanout):
    docs = documents(spark, ["AbC É", "AbC É", "", None, "x" * 10])
    assert proved(docs, fanout) == brute_proofs(five(docs), fanout)


def test_proofs_of_one_large_group_and_many_small_ones(spark):
    rows = [(i, f"Text {i}", None, "hot" if i % 3 else f"s{i}", 1, "x", "y", 0) for i in range(700)]
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    got = proved(docs)
    assert got == brute_proofs(five(docs))
    assert got == proved(docs.orderBy(F.desc("text")))  # the order of the input changes nothing


def test_proofs_of_one_row_and_of_none(spark):
    docs = documents(spark).where("doc_id = 3")
    assert proved(docs) == brute_proofs(five(docs))
    row = merkle.checked(merkle.proofs(docs)).first()
    assert row["leaf"] == row["subroot"] == row["root"] == row["folded_root"] and row["verified"]
    assert row["proof_sha256"] == sha("")
    none = merkle.checked(merkle.proofs(empty(spark)))
    assert none.count() == 0 and none.columns[0] == "doc_id"


def test_repeated_rows_are_leaves_of_their_own(spark):
    rows = [(1, "A", "en", "s", 1, "x", "y", 0)] * 40
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    got = proved(docs)
    assert got == brute_proofs(five(docs)) and sum(got.values()) == 40


# Personal data ---------------------------------------------------------------------------

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_base(text):
    out = [(0, m.start(), m.end(), "email:" + m[0].lower()) for m in EMAIL.finditer(text)]
    out += [(1, m.start(), m.end(), "ip:" + m[0]) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = [int(c) for c in m[0] if c in "0123456789"]
        odd = sum(digits[-1::-2]) + sum(sum(divmod(2 * d, 10)) for d in digits[-2::-2])
        if 16 <= len(digits) <= 19 and odd % 10 == 0:
            out.append((2, m.start(), m.end(), "card:" + "".join(map(str, digits))))
    for m in PHONE.finditer(text):
        digits = re.sub(r"[^0-9]", "", m[0])
        if 8 <= len(digits) <= 15:
            out.append((3, m.start(), m.end(), "phone:" + digits))
    return sorted(out)


def brute_words(text, base):
    words = re.finditer(r"[^\W_]+", text)
    low = lambda w: re.sub("[A-Z]", lambda m: m[0].lower(), w)
    return [(m.start(), m.end(), low(m[0])) for m in words if all(m.end() <= a or b <= m.start() for _, a, b, _ in base)]


def brute_terms(texts, support=3, bits=(0.25, 0.5), window=8):
    """{term: action} from every pair of term and entity, by plain counting."""
    near, known, spread = {}, Counter(), Counter()
    for n, text in enumerate(texts):
        base = brute_base(text)
        words = brute_words(text, base)
        known.update({e for *_, e in base})
        spread.update({w[2] for w in brute_words(text, [])})
        pairs = set()
        for _, a, b, e in base:
            left = [w[2] for w in words if w[0] < a][-window:]
            right = [w[2] for w in words if w[0] >= b][:window]
            pairs |= {(e, t) for t in left + right}
        for pair in pairs:
            near.setdefault(pair, []).append(text)
    chosen = {}
    for (e, t), where in near.items():
        information = math.log2(len(texts) / known[e])
        pmi = math.log2(len(texts) * len(where) / (spread[t] * known[e]))
        if len(set(where)) >= support and information - pmi <= bits[1] + 1e-12:
            action = "remove" if information - pmi <= bits[0] + 1e-12 else "generalise"
            chosen[t] = max(chosen.get(t, ""), action)
    return chosen


def brute_pii(rows):
    terms = brute_terms([t or "" for _, t in rows])
    out = Counter()
    for doc_id, text in rows:
        base = brute_base(text or "")
        listed = [f"{pii.KINDS[k]}:{a}:{b}" for k, a, b, _ in base]
        added = [f"term:{a}:{b}" for a, b, w in brute_words(text or "", base) if w in terms]
        counts = Counter(k for k, *_ in base)
        out[(doc_id, *(counts[k] for k in range(4)), sha(",".join(listed)), ",".join(listed + added))] += 1
    return out, terms


PRIVATE = [
    "a@b.c@d.e x@y z..z@-.-.- .@a.b @c.d a@b@c.de %+-@h-.i-x_w@q.r",
    "1.2.3.4.5.6.7.8 256.1.1.1 1.1.1.01 0000001.2.3.4 1.2.3 1.2.3. 1..2.3.4 99999999999.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111111111111112 4111  1111 1111 1111 411111111111111 5500000000000000004",
    "+1 (499) 555-6503 +1 2 +12345678 +1-2-3-4-5-6-7-8. ++49 30 1234567 +1234567890123456 +1.2.3.4.5.6.7.8",
    "é😀 a@b.co 😀 10.0.0.1 ٣٤٥@x.y １.2.3.4 +٣٤٥٦٧٨٩٠١",
    "9" * 5000 + " " + "a" * 5000 + "@" + "b" * 3000 + " " + "1." * 4000,
]


def leaking():
    rows = [f"Doctor Zebulon sees patient{i} reach zeb@clinic.example.com the ward is open {i}" for i in range(4)]
    rows += [f"The ward of Zebulon and nothing private {i}" for i in range(1)]
    rows += [f"the quick office phone +49 30 1234567 belongs to Quentin {i}" for i in range(5)]
    rows += [f"the the plain words of a clean text number {i}" for i in range(9)]
    return rows


def test_private_spans_against_brute_force(spark):
    docs = documents(spark, [*PRIVATE, *leaking(), leaking()[0], LONG + " zeb@clinic.example.com Zebulon"])
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    wanted, terms = brute_pii(rows)
    got = Counter(tuple(r) for r in pii.digest(pii.private_spans(docs)).collect())
    assert got == wanted
    assert {"zebulon", "quentin"} <= set(terms) and "the" not in terms and "clean" not in terms


def test_measures_of_disclosing_terms(spark):
    docs = spark.createDataFrame(list(enumerate(leaking())), "doc_id long, text string")
    texts = docs.withColumn("blob", F.sha2("text", 256))
    rows = pii.disclosing_terms(texts, pii.find_base(texts, pii.WINDOW)).collect()
    for r in rows:
        assert 0 <= r["information"] - r["pmi"] + 1e-9 and r["information"] - r["pmi"] <= pii.GENERALISE_BITS + 1e-9
    of = {r["term"]: r for r in rows}
    assert (of["zebulon"]["together"], of["zebulon"]["spread"], of["zebulon"]["known"]) == (4, 5, 4)
    assert of["zebulon"]["action"] == "generalise" and of["quentin"]["action"] == "remove"
    assert of["quentin"]["pmi"] == pytest.approx(of["quentin"]["information"])


def test_sanitised_texts(spark):
    docs = documents(spark, leaking()).withColumn("blob", F.lit("own")).withColumn("_may", F.lit(True))
    before = by_id(docs)
    after = pii.sanitise(docs)
    assert after.columns == docs.columns
    for doc_id, rows in by_id(after).items():
        assert len(rows) == len(before[doc_id])
        for r in rows:
            old = next(b for b in before[doc_id] if b["batch"] == r["batch"])
            assert {k: v for k, v in r.items() if k != "text"} == {k: v for k, v in old.items() if k != "text"}
            if old["text"] is None or not pii.base_spans(old["text"]) and "Zebulon" not in old["text"]:
                assert r["text"] == old["text"]
    texts = [r["text"] for rows in by_id(after).values() for r in rows if r["text"]]
    assert not any("Quentin" in t or "Zebulon" in t or "@clinic" in t or "+49" in t for t in texts)
    assert any("[email]" in t and "[name]" in t for t in texts) and any("[phone]" in t for t in texts)


def test_no_private_data(spark):
    assert pii.digest(pii.private_spans(empty(spark))).count() == 0
    assert pii.sanitise(empty(spark)).count() == 0
    clean = spark.createDataFrame([(1, "nothing here"), (2, None)], "doc_id long, text string")
    assert {r["spans"] for r in pii.digest(pii.private_spans(clean)).collect()} == {""}


@pytest.mark.parametrize("text", PRIVATE)
def test_patterns_against_the_plain_ones(text):
    text = text[:2500]  # the plain patterns are quadratic
    assert [s[:3] for s in pii.base_spans(text)] == [s[:3] for s in brute_base(text)]
